"""Fetch-log analytics: failures, running server health, retry planning.

The running state of a host is sequential, and one host may hold a third of the
log. A host with more than ``CHUNK`` rows is therefore cut into chunks of about
equal size by quantiles of its sequence number, which may be dense or sparse. A
chunk is windowed on its own; what it needs from before is a small carry (counts,
last success and the last 19 flags) computed over one summary row per chunk, at
most ``MOST_CHUNKS`` per host.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry import constants as C
from docketry.functions.text import WS, let, strip
from docketry.session import scratch

CHUNK, MOST_CHUNKS = 200_000, 1024
_TAIL = C.HEALTH_RECENT - 1


# ------------------------------------------------------------- per-event flags (map-only)
def status_retry(status: Column) -> Column:
    return F.coalesce(status.isin(C.RETRY_STATUS), F.lit(False))


def content_failure(status: Column, html: Column) -> Column:
    """A 200 page with an error phrase, almost no body or almost no text.

    One unbroken run of text is enough to see that a page is not empty, so tags
    are only stripped from pages that lack such a run.
    """
    solid = "[^<>" + WS[1:]
    run = f"{solid}[^<>]{{{C.MIN_TEXT_CHARS - 2},}}{solid}"
    body = f"(?s)[^{WS[1:]}.{{{C.MIN_BODY_CHARS - 2},}}[^{WS[1:]}"

    def bad(low: Column) -> Column:
        phrase = reduce(Column.__or__, [F.contains(low, F.lit(p)) for p in C.FAILURE_PHRASES])
        # past the last '>' no tag can end: leaving that part out keeps the scan linear
        tail = F.substring_index(low, ">", -1)
        head = F.substring(low, F.lit(1), F.length(low) - F.length(tail))
        shown = strip(F.concat(F.regexp_replace(head, r"<[^>]++>", ""), tail))
        return phrase | ~low.rlike(body) | (~low.rlike(run) & (F.length(shown) < C.MIN_TEXT_CHARS))

    page = F.lower(F.coalesce(html, F.lit("")))
    return F.when(status == 200, let(page, bad)).otherwise(False)


def with_flags(log: DataFrame) -> DataFrame:
    """Log with ``content_failed`` and ``failed``; an exception is always a failure."""
    ok_status = (F.col("status") >= 200) & (F.col("status") < 400)
    return log.withColumn(
        "content_failed", content_failure(F.col("status"), F.col("html"))
    ).withColumn(
        "failed",
        F.when(F.col("exception").isNotNull(), True).otherwise(
            ~(F.coalesce(ok_status, F.lit(False)) & ~F.col("content_failed"))
        ),
    )


def fetch_failures(log: DataFrame) -> DataFrame:
    """Per response: retry decision and success flag."""
    responses = with_flags(log.where(F.col("exception").isNull()))
    retry = status_retry(F.col("status"))
    return responses.select(
        "host",
        "seq",
        "status",
        retry.alias("status_retry"),
        F.col("content_failed").alias("content_failure"),
        (~F.col("failed")).alias("success"),
        F.when(retry, "status").when(F.col("content_failed"), "content").otherwise("none").alias("retry_reason"),
    )


def exception_class(log: DataFrame) -> DataFrame:
    """Per exception: retryable or not; every one counts as a failure."""
    return log.where(F.col("exception").isNotNull()).select(
        "host",
        "seq",
        "exception",
        F.col("exception").isin(C.RETRYABLE_EXCEPTIONS).alias("retryable"),
        F.lit(True).alias("is_failure"),
    )


# ------------------------------------------------------------------------ running state
def _host() -> Column:
    return F.coalesce("host", F.lit(""))


def _bounds(log: DataFrame, chunk: int) -> DataFrame | None:
    """(host, bounds): first sequence numbers of the chunks after the first, for hosts above ``chunk`` rows; None without such hosts.

    Reads two columns of the log. Quantiles may differ from run to run, so they are
    written once and both uses of the rows see the same chunks.
    """
    keys = log.select(_host().alias("host"), F.coalesce("seq", F.lit(0)).alias("seq"))
    busy = keys.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") > chunk)
    path = scratch(log.sparkSession, "health-busy")
    busy.write.parquet(path)
    busy = log.sparkSession.read.schema(busy.schema).parquet(path)
    if busy.isEmpty():
        return None
    steps = [i / MOST_CHUNKS for i in range(1, MOST_CHUNKS)]
    cuts = keys.join(busy, "host").groupBy("host").agg(F.percentile_approx("seq", steps, 10 * MOST_CHUNKS).alias("cuts"), F.max("n").alias("n"))
    # every stride-th quantile, so that a chunk holds about `chunk` rows where that many chunks are allowed
    stride = F.greatest(F.lit(1), F.floor(F.lit(MOST_CHUNKS * chunk) / F.col("n"))).cast("int")
    thinned = F.array_distinct(F.filter("cuts", lambda c, i: (i + 1) % F.col("stride") == 0))
    path = scratch(log.sparkSession, "health-bounds")
    bounds = cuts.withColumn("stride", stride).select(F.col("host").alias("_bound_host"), F.transform(thinned, lambda c: c + 1).alias("bounds"))
    bounds.write.parquet(path)
    return log.sparkSession.read.schema(bounds.schema).parquet(path)


def _chunk_of(seq: Column) -> Column:
    """Number of bounds not above ``seq``, by halving steps."""
    steps = [1 << i for i in reversed(range(MOST_CHUNKS.bit_length()))]

    def step(low: Column, width: Column) -> Column:
        return F.when(F.get("bounds", low + width - 1) <= seq, low + width).otherwise(low)

    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)
    return F.when(F.col("bounds").isNull(), 0).otherwise(found)


def _chunked(flagged: DataFrame, chunk: int, keep: tuple[str, ...]) -> DataFrame:
    """Narrow rows with everything a chunk can know about itself."""
    # keys that cannot be NULL: no filter is inferred on either use of these rows,
    # so both uses stay equal and share one shuffle
    narrow = flagged.select(_host().alias("host"), "seq", "ts", "failed", *keep)
    bounds, number = _bounds(flagged, chunk), F.lit(0)
    if bounds is not None:
        narrow = narrow.join(bounds, F.col("host") == F.col("_bound_host"), "left")
        number = F.coalesce(_chunk_of(F.coalesce("seq", F.lit(0))), F.lit(0))
    narrow = narrow.select("host", "seq", "ts", "failed", number.alias("chunk"), *keep)
    w = Window.partitionBy("host", "chunk").orderBy("seq")
    to_here = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("host", "chunk")
    ok = ~F.col("failed")
    return (
        narrow.withColumn("rn", F.row_number().over(w).cast("bigint"))
        .withColumn("fail_local", F.count_if("failed").over(w.rowsBetween(-_TAIL, 0)))
        .withColumn("ok_rn", F.max(F.when(ok, F.col("rn"))).over(to_here))
        .withColumn("ok_ts", F.last(F.when(ok, F.col("ts")), ignorenulls=True).over(to_here))
        .withColumn("rows_in_chunk", F.count("*").over(whole))
    )


def _summaries(chunks: DataFrame) -> DataFrame:
    """One row per (host, chunk); the flag list holds at most the last 19 rows."""
    in_tail = F.col("rn") > F.col("rows_in_chunk") - _TAIL
    return (
        chunks.groupBy("host", "chunk")
        .agg(
            F.max("rows_in_chunk").alias("n"),
            F.max("ok_rn").alias("ok_rn"),
            F.max_by("ok_ts", "rn").alias("ok_ts"),
            F.min_by("ts", "rn").alias("first_ts"),
            F.collect_list(F.when(in_tail, F.struct("rn", "failed"))).alias("tail"),
        )
        .withColumn("tail", F.transform(F.array_sort("tail"), lambda x: x["failed"]))
    )


def _carry(summaries: DataFrame, start: DataFrame | None) -> DataFrame:
    """State before each chunk, from the summaries before it (and a start state)."""
    w = Window.partitionBy("host").orderBy("chunk")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    s = summaries.withColumn("n_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    s = s.withColumn("ok_global", F.col("ok_rn") + F.col("n_before"))
    s = s.select(
        "host",
        "chunk",
        "n_before",
        F.max("ok_global").over(before).alias("ok_rn_before"),
        F.last("ok_ts", ignorenulls=True).over(before).alias("ok_ts_before"),
        F.first("first_ts").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("started"),
        # every chunk has a row, so the 19 chunks before hold at least 19 flags if that many exist
        F.flatten(F.collect_list("tail").over(w.rowsBetween(-_TAIL, -1))).alias("tail_before"),
    )
    if start is None:
        return s.withColumn("tail_before", _last(F.col("tail_before"), _TAIL))
    st = start.select(
        F.col("host").alias("_h"),
        F.col("n").alias("_n"),
        F.col("ok_rn").alias("_ok_rn"),
        F.col("ok_ts").alias("_ok_ts"),
        F.col("started").alias("_started"),
        F.col("tail").alias("_tail"),
    )
    prior = F.coalesce("_n", F.lit(0))
    return s.join(st, F.col("host") == F.col("_h"), "left").select(
        "host",
        "chunk",
        (F.col("n_before") + prior).alias("n_before"),
        F.coalesce(F.col("ok_rn_before") + prior, F.col("_ok_rn")).alias("ok_rn_before"),
        F.coalesce("ok_ts_before", "_ok_ts").alias("ok_ts_before"),
        F.coalesce("_started", "started").alias("started"),
        _last(
            F.concat(F.coalesce("_tail", F.array().cast("array<boolean>")), F.col("tail_before")), _TAIL
        ).alias("tail_before"),
    )


def _last(arr: Column, n: int) -> Column:
    return F.slice(arr, F.greatest(F.size(arr) - (n - 1), F.lit(1)), F.lit(n))


def server_health(
    log: DataFrame,
    start: DataFrame | None = None,
    started_at: Column | None = None,
    chunk: int = CHUNK,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """State after every event of a host.

    ``started_at`` replaces the host's first timestamp as the time of the last
    success before any was seen. ``start`` is a state table of ``health_state``
    from which the log goes on. ``keep`` passes further log columns through.
    """
    flagged = log if "failed" in log.columns else with_flags(log)
    chunks = _chunked(flagged, chunk, keep)
    carry = _carry(_summaries(chunks), start).select(
        F.col("host").alias("_host"),
        F.col("chunk").alias("_chunk"),
        "n_before",
        "ok_rn_before",
        "ok_ts_before",
        (started_at if started_at is not None else F.col("started")).alias("started"),
        "tail_before",
    )
    joined = chunks.join(
        carry, (F.col("host") == F.col("_host")) & (F.col("chunk") == F.col("_chunk"))
    )
    n = F.col("rn") + F.col("n_before")
    # flags of earlier chunks that are still among the last 20
    reach = F.greatest(F.lit(C.HEALTH_RECENT) - F.col("rn"), F.lit(0))
    earlier = F.when(
        reach > 0,
        F.size(
            F.filter(
                F.col("tail_before"),
                lambda f, i: f & (i >= F.size("tail_before") - reach),
            )
        ),
    ).otherwise(0)
    ok_rn = F.coalesce(F.col("ok_rn") + F.col("n_before"), F.col("ok_rn_before"), F.lit(0))
    last_ok = F.coalesce("ok_ts", "ok_ts_before", "started")
    state = joined.select(
        "host",
        "chunk",
        "seq",
        "ts",
        "failed",
        n.alias("n"),
        (F.col("fail_local") + earlier).alias("recent_failures"),
        F.least(n, F.lit(C.HEALTH_RECENT)).alias("recent_total"),
        (n - ok_rn).alias("consecutive_failures"),
        last_ok.alias("last_success"),
        "started",
        ok_rn.alias("ok_rn"),
        *keep,
    )
    rate = F.col("recent_failures") / F.col("recent_total")
    silence = F.unix_micros("ts") - F.unix_micros("last_success")
    return state.withColumn("failure_rate", rate).withColumn(
        "degraded",
        (F.col("n") >= C.HEALTH_MIN_EVENTS)
        & (
            (rate > C.HEALTH_MAX_RATE)
            | (F.col("consecutive_failures") > C.HEALTH_MAX_CONSECUTIVE)
            | (silence > C.HEALTH_MAX_SILENCE_SEC * 1_000_000)
        ),
    )


def chunk_states(health: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """State of a host at the end of each of its chunks, to continue from with ``server_health(start=...)``.

    Only the last 19 rows of a chunk are grouped: the rank limit is applied before the
    shuffle (window group limit), so a busy host sends few rows per task. Flags older
    than a chunk come from the chunks before it, and from the ``start`` of the log.
    """
    newest = Window.partitionBy("host", "chunk").orderBy(F.desc("n"))
    ends = (
        health.withColumn("back", F.row_number().over(newest))
        .where(F.col("back") <= _TAIL)
        .groupBy("host", "chunk")
        .agg(
            F.max("n").alias("n"),
            F.max("ok_rn").alias("ok_rn"),
            F.max_by(F.when(F.col("ok_rn") > 0, F.col("last_success")), "n").alias("ok_ts"),
            F.max_by("started", "n").alias("started"),
            F.max_by("degraded", "n").alias("degraded"),
            F.max("seq").alias("last_seq"),
            F.array_sort(F.collect_list(F.struct("n", "failed"))).alias("tail"),
        )
        .withColumn("tail", F.transform("tail", lambda x: x["failed"]))
    )
    # every chunk has a row, so 19 chunks hold at least 19 flags if that many exist
    chunks = Window.partitionBy("host").orderBy("chunk").rowsBetween(1 - _TAIL, 0)
    tail = F.flatten(F.collect_list("tail").over(chunks))
    if start is None:
        return ends.withColumn("tail", _last(tail, _TAIL))
    old = start.select(F.col("host").alias("_h"), F.col("tail").alias("_old"))
    joined = ends.withColumn("tail", tail).join(old, F.col("host") == F.col("_h"), "left")
    known = F.coalesce("_old", F.array().cast("array<boolean>"))
    return joined.withColumn("tail", _last(F.concat(known, F.col("tail")), _TAIL)).drop("_h", "_old")


def health_state(states: DataFrame) -> DataFrame:
    """Closing state per host among ``chunk_states`` (partial aggregation)."""
    fields = [c for c in states.columns if c != "host"]
    last = states.groupBy("host").agg(F.max_by(F.struct(*fields), "n").alias("s"))
    return last.select("host", *[F.col(f"s.{c}").alias(c) for c in fields])


def health_transitions(health: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Events at which a host became degraded or recovered (it starts healthy).

    Looks back inside a chunk; the first row of a chunk compares with the last
    row of the host's chunk before it. ``before`` (host, degraded) gives the
    state ahead of the first chunk when the log continues an earlier one.
    """
    w = Window.partitionBy("host", "chunk").orderBy("seq")
    inner = health.select(
        "host",
        "chunk",
        "seq",
        "ts",
        "degraded",
        F.lag("degraded").over(w).alias("prev"),
    )
    ends = health.groupBy("host", "chunk").agg(F.max_by("degraded", "seq").alias("end"))
    edge = ends.select(
        F.col("host").alias("_host"),
        F.col("chunk").alias("_chunk"),
        F.lag("end").over(Window.partitionBy("host").orderBy("chunk")).alias("edge"),
    )
    if before is not None:
        old = before.select(F.col("host").alias("_h0"), F.col("degraded").alias("_d0"))
        edge = edge.join(old, F.col("_host") == F.col("_h0"), "left").select(
            "_host", "_chunk", F.coalesce("edge", "_d0").alias("edge")
        )
    rows = inner.join(
        edge, (F.col("host") == F.col("_host")) & (F.col("chunk") == F.col("_chunk"))
    )
    previous = F.coalesce("prev", "edge", F.lit(False))
    return rows.where(F.col("degraded") != previous).select(
        "host", "seq", "ts", F.when(F.col("degraded"), "degraded").otherwise("recovered").alias("change")
    )


def health_snapshot(health: DataFrame, hosts: DataFrame | None = None) -> DataFrame:
    """Latest state per host (partial aggregation, no sort of a host).

    With a list of ``hosts`` (one column), those without events are "unknown".
    """
    if hosts is not None:
        listed = hosts.select(F.col("host").alias("_listed")).distinct()
        found = health_snapshot(health)
        return listed.join(found, F.col("_listed") == F.col("host"), "left").select(
            F.col("_listed").alias("host"),
            F.coalesce("status", F.lit("unknown")).alias("status"),
            *[c for c in found.columns if c not in ("host", "status")],
        )
    fields = ["n", "degraded", "failure_rate", "consecutive_failures", "last_success", "recent_failures", "recent_total"]
    return (
        health.groupBy("host")
        .agg(F.max_by(F.struct(*fields), "seq").alias("s"))
        .select(
            "host",
            F.when(F.col("s.degraded"), "degraded").otherwise("healthy").alias("status"),
            F.col("s.failure_rate").alias("failure_rate"),
            F.col("s.consecutive_failures").alias("consecutive_failures"),
            F.col("s.last_success").alias("last_success"),
            F.least(F.col("s.n"), F.lit(C.HEALTH_SAMPLE)).alias("sample_size"),
            F.col("s.recent_failures").alias("recent_failures"),
            F.col("s.recent_total").alias("total_requests"),
        )
    )


def _endpoint_value(position: int, default: float) -> Column:
    value = F.lit(default)
    for name, values in C.ENDPOINTS.items():
        value = F.when(F.col("endpoint") == name, F.lit(values[position])).otherwise(value)
    return value


#: Failed attempts that can stand before an attempt that is still planned: the largest number of allowed retries.
REACH = max(C.RETRY_DEFAULT_MAX, *(values[0] for values in C.ENDPOINTS.values()))


def _request() -> Column:
    """One request over its attempts: host, url and endpoint, nulls read as empty."""
    return F.concat_ws("\n", _host(), F.coalesce("url", F.lit("")), F.coalesce("endpoint", F.lit("")))


def _after(attempt: Column, current: Column) -> Column:
    """Timeout that a retry carries after an attempt with `current`."""
    return F.when(attempt["degraded"], F.least(current * attempt["factor"], F.lit(C.TIMEOUT_CAP))).otherwise(current)


def _carried(earlier: Column, times: Column) -> Column:
    """Timeout that attempt `times` gets from the attempts of its request before it, oldest first; null without a chain."""

    def step(state: Column, attempt: Column) -> Column:
        handed = F.when(state["next"] == attempt["times"], state["timeout"])
        current = F.coalesce(attempt["logged"], handed, F.lit(C.TIMEOUT_SEC))
        return F.struct(
            F.when(attempt["goes_on"], attempt["times"] + 1).otherwise(-1).alias("next"),
            _after(attempt, current).alias("timeout"),
        )

    start = F.struct(F.lit(-1).alias("next"), F.lit(C.TIMEOUT_SEC).alias("timeout"))
    return F.aggregate(earlier, start, step, lambda s: F.when(s["next"] == times, s["timeout"]))


def with_timeouts(rows: DataFrame, log: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Attempts (request, seq, attempt) with `current`, the timeout each was sent with.

    The logged timeout counts. Without one an attempt carries what the attempt right before
    it in the log of its request handed on, if that was retried and its number is one less;
    else the default. At most `REACH` attempts stand before one, so a window of as many rows
    is folded. A request of more than `chunk` rows (a form has one url) is cut by quantiles
    of its sequence numbers; a chunk gets the last attempts of the chunks before it.
    """
    bounds, number = _bounds(log.select(_request().alias("host"), "seq"), chunk), F.lit(0)
    if bounds is not None:
        rows = rows.join(bounds, F.col("request") == F.col("_bound_host"), "left")
        number = F.coalesce(_chunk_of(F.coalesce("seq", F.lit(0))), F.lit(0))
        rows = rows.withColumn("part", number).drop("_bound_host", "bounds")
    by = ["request"] if bounds is None else ["request", "part"]
    w = Window.partitionBy(*by).orderBy("seq")
    rows = rows.withColumn("earlier", F.collect_list("attempt").over(w.rowsBetween(-REACH, -1)))
    if bounds is not None:
        tails = rows.groupBy(*by).agg(F.max_by(F.concat("earlier", F.array("attempt")), "seq").alias("tail"))
        before = Window.partitionBy("request").orderBy("part").rowsBetween(-REACH, -1)  # a chunk has a row, so as many chunks hold as many attempts
        tails = tails.select(F.col("request").alias("_request"), F.col("part").alias("_part"), F.flatten(F.collect_list("tail").over(before)).alias("tail"))
        rows = rows.join(tails, (F.col("request") == F.col("_request")) & (F.col("part") == F.col("_part")))
        rows = rows.withColumn("earlier", _last(F.concat("tail", "earlier"), REACH)).drop("_request", "_part", "tail", "part")
    current = F.coalesce("attempt.logged", _carried(F.col("earlier"), F.col("attempt.times")), F.lit(C.TIMEOUT_SEC))
    return rows.withColumn("current", current).drop("earlier")


def retry_plan(log: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Per failed retryable attempt: give-up flag, delay bounds and timeout.

    Bounds replace a random draw. The state used is the one after the event, so
    the attempt's columns travel with the health rows and nothing is joined back.
    A request carries its timeout from attempt to attempt (`with_timeouts`), so
    repeated scaling compounds up to the cap, with a logged timeout or without.
    """
    retryable = F.when(
        F.col("exception").isNotNull(), F.col("exception").isin(C.RETRYABLE_EXCEPTIONS)
    ).otherwise(status_retry(F.col("status")) | F.col("content_failed"))
    events = with_flags(log).withColumns({"retryable": F.coalesce(retryable, F.lit(False)), "request": _request()})
    rows = server_health(events, chunk=chunk, keep=("endpoint", "retry_times", "retryable", "download_timeout", "request"))
    times = F.coalesce("retry_times", F.lit(0))
    attempt = times + 1
    allowed = _endpoint_value(0, C.RETRY_DEFAULT_MAX).cast("int")
    go_on = attempt <= allowed
    rows = rows.withColumn(
        "attempt",
        F.struct(
            times.alias("times"),
            (F.col("retryable") & go_on).alias("goes_on"),
            "degraded",
            _endpoint_value(2, 1.0).alias("factor"),
            F.col("download_timeout").alias("logged"),
        ),
    ).select("request", "host", "seq", "endpoint", "retry_times", "retryable", "degraded", "attempt")
    rows = with_timeouts(rows, log, chunk)
    base = F.least(
        F.lit(C.BACKOFF_BASE) * F.pow(F.lit(C.BACKOFF_MULTIPLIER), attempt - 1) * _endpoint_value(1, 1.0),
        F.lit(C.BACKOFF_CAP),
    )
    slow = F.when(F.col("degraded"), C.DEGRADED_FACTOR).otherwise(1.0)
    return rows.where("retryable").select(
        "host",
        "seq",
        "endpoint",
        attempt.alias("attempt"),
        allowed.alias("max_retries"),
        (~go_on).alias("give_up"),
        "degraded",
        F.when(go_on, base * C.JITTER_LOW * slow).alias("delay_lo"),
        F.when(go_on, base * C.JITTER_HIGH * slow).alias("delay_hi"),
        F.when(go_on, _after(F.col("attempt"), F.col("current"))).alias("timeout_sec"),
    )
