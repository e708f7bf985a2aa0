"""Chunked health against a plain loop, with one host holding most rows."""

import random
from datetime import datetime, timedelta

import pytest

from docketry import constants as C
from docketry.operators import health
from docketry.schemas import FETCH_LOG
from docketry.streaming import health as sh
from docketry.streaming.pages import stream_name

OK = "<html><body>" + "conteudo " * 20 + "</body></html>"


def make_log(seed=7, n=1500, scale=1):
    """Bursts of failures; host h0 has two thirds of the rows, h2 appears late."""
    rnd = random.Random(seed)
    now, rows, bad = datetime(2024, 1, 1), [], 0.1
    for seq in range(0, n * 3, 3):
        now += timedelta(seconds=rnd.choice([1, 5, 20, 90]))
        if rnd.random() < 0.03:
            bad = rnd.choice([0.05, 0.4, 0.9])
        host = "h0" if rnd.random() < 0.66 else ("h2" if seq > 2 * n and rnd.random() < 0.3 else "h1")
        status, html, exc = 200, OK, None
        if rnd.random() < bad:
            status, html, exc = rnd.choice(
                [(503, OK, None), (404, OK, None), (200, "<p>Erro 500</p>" + OK, None), (200, "curto", None),
                 (200, "<b></b>" * 60, None), (None, None, "TimeoutError"), (None, None, "ValueError")]
            )
        rows.append((host, seq * scale, now, "u", rnd.choice(["form", "detalhe", "list"]), status, html, exc, rnd.randrange(7), None))
    return rows


def failed(row):
    status, html, exc = row[5], row[6], row[7]
    return exc is not None or status != 200 or html != OK


def loop(rows):
    """The same states, one event after another."""
    state, out = {}, {}
    for row in rows:
        host, seq, ts = row[0], row[1], row[2]
        s = state.setdefault(host, {"flags": [], "cons": 0, "last": ts, "deg": False})
        f = failed(row)
        s["flags"].append(f)
        s["cons"] = s["cons"] + 1 if f else 0
        if not f:
            s["last"] = ts
        recent = s["flags"][-20:]
        if len(s["flags"]) >= 10:
            s["deg"] = sum(recent) / len(recent) > 0.5 or s["cons"] > 5 or ts - s["last"] > timedelta(minutes=5)
        out[(host, seq)] = (f, len(s["flags"]), sum(recent), s["cons"], s["last"], s["deg"])
    return out


def states(df):
    return {
        (r.host, r.seq): (r.failed, r.n, r.recent_failures, r.consecutive_failures, r.last_success, r.degraded)
        for r in df.collect()
    }


def changes(expected):
    last, out = {}, set()
    for (host, seq), s in sorted(expected.items(), key=lambda x: x[0][1]):
        if s[5] != last.get(host, False):
            out.add((host, seq, "degraded" if s[5] else "recovered"))
        last[host] = s[5]
    return out


@pytest.mark.parametrize("chunk", [1, 7, 100, 1_000_000])
def test_chunks_do_not_change_the_state(spark, chunk):
    rows = make_log()
    log = spark.createDataFrame(rows, FETCH_LOG)
    expected = loop(rows)
    result = health.server_health(log, chunk=chunk)
    assert states(result) == expected
    got = {(r.host, r.seq, r.change) for r in health.health_transitions(result).collect()}
    assert got == changes(expected)
    assert len(got) > 10


def test_sparse_sequence_numbers_make_few_even_chunks(spark):
    """Numbers like clock ticks: chunks follow the rows, not the numbers, and no task holds a host."""
    rows = make_log(5, 4000, scale=10**6)
    for i, row in enumerate(rows[:40]):  # far away from the others
        rows[i] = (row[0], row[1] - 10**15, *row[2:])
    log, expected = spark.createDataFrame(rows, FETCH_LOG), loop(rows)
    result = health.server_health(log, chunk=100)
    assert states(result) == expected
    sizes = [r["count"] for r in result.groupBy("host", "chunk").count().collect()]
    assert max(sizes) <= 400 and len(sizes) < len(rows) / 20
    got = {(r.host, r.seq, r.change) for r in health.health_transitions(result).collect()}
    assert got == changes(expected)


def test_unknown_hosts_are_listed(spark):
    snap = health.health_snapshot(
        health.server_health(spark.createDataFrame(make_log(3, 300), FETCH_LOG)),
        spark.createDataFrame([("h0",), ("h9",), ("h9",)], "host string"),
    )
    got = {r.host: (r.status, r.sample_size) for r in snap.collect()}
    assert set(got) == {"h0", "h9"} and got["h9"] == ("unknown", None) and got["h0"][0] != "unknown"


@pytest.mark.parametrize("seed,size,chunk", [(1, 60, 25), (2, 7, 1_000_000), (3, 150, 1)])
def test_any_order_of_arrival_ends_in_the_batch_rows(spark, tmp_path, seed, size, chunk):
    """Whole parts in random order, and single rows far behind; small batches keep their hosts' last flags."""
    rnd = random.Random(seed)
    rows = make_log(20 + seed, size * 4)
    expected = loop(rows)
    strays = rnd.sample(rows, len(rows) // 10)
    inside = [r for r in rows if r not in strays]
    parts = [inside[i : i + size] for i in range(0, len(inside), size)]
    if seed == 1:
        rnd.shuffle(parts)
    parts[-1] += strays[::2]
    parts.append(strays[1::2])
    table = str(tmp_path / "table")
    for i, part in enumerate(parts):
        sh.apply_batch(spark.createDataFrame(part, FETCH_LOG), i, table, chunk=chunk)
        if i == 2:  # the states so far are those of the rows so far, in order
            so_far = sorted((r for p in parts[:3] for r in p), key=lambda r: r[1])
            assert states(sh.read_health(spark, table)) == loop(so_far)
    assert states(sh.read_health(spark, table)) == expected
    got = [(r.host, r.seq, r.change) for r in sh.read_transitions(spark, table).collect()]
    assert set(got) == changes(expected) and len(got) == len(set(got))


def test_a_late_row_recomputes_only_what_follows(spark, tmp_path):
    rows = make_log(11, 600)
    late = next(r for r in rows[400:] if r[0] == "h0")
    table = str(tmp_path / "table")
    sh.apply_batch(spark.createDataFrame([r for r in rows if r is not late], FETCH_LOG), 0, table, chunk=20)
    sh.apply_batch(spark.createDataFrame([late], FETCH_LOG), 1, table)
    assert states(sh.read_health(spark, table)) == loop(rows)
    again = spark.read.parquet(f"{table}/health/version=1").collect()
    behind = [r for r in rows if r[0] == "h0" and r[1] >= late[1]]
    assert {r.host for r in again} == {"h0"} and len(behind) <= len(again) <= len(behind) + 80


def test_a_new_stream_over_the_same_table_goes_on(spark, tmp_path):
    """Two checkpoints are two writers: batch 0 of the second is not taken for a replay."""
    rows = make_log(11, 300)
    table = str(tmp_path / "table")
    for name, part in (("a", rows[100:]), ("b", rows[:100])):
        spark.createDataFrame(part, FETCH_LOG).write.parquet(str(tmp_path / name))
        sh.stream_health(spark, str(tmp_path / name), table, str(tmp_path / f"mark-{name}"), chunk=40).awaitTermination()
    assert states(sh.read_health(spark, table)) == loop(rows)


def test_snapshot_is_the_last_state(spark):
    rows = make_log(3, 300)
    expected = loop(rows)
    last = {}
    for (host, seq), s in expected.items():
        last[host] = s
    snap = health.health_snapshot(health.server_health(spark.createDataFrame(rows, FETCH_LOG), chunk=50)).collect()
    assert {r.host: (r.sample_size, r.recent_failures, r.consecutive_failures, r.last_success) for r in snap} == {
        h: (min(s[1], 100), s[2], s[3], s[4]) for h, s in last.items()
    }


def test_stream_equals_batch_and_survives_a_replay(spark, tmp_path):
    rows = make_log(11, 900)
    expected = loop(rows)
    src, table, mark = (str(tmp_path / n) for n in ("in", "table", "mark"))
    for lo, hi in ((0, 5), (5, 400), (400, 900)):
        part = spark.createDataFrame(rows[lo:hi], FETCH_LOG)
        part.write.mode("append").parquet(src)
        sh.stream_health(spark, src, table, mark, chunk=40).awaitTermination()
        if hi == 400:
            # the batch is run once more, as after a lost driver
            sh.apply_batch(part, 1, table, chunk=40, writer=stream_name(spark, mark))
    assert states(sh.read_health(spark, table)) == expected
    got = {(r.host, r.seq, r.change) for r in sh.read_transitions(spark, table).collect()}
    assert got == changes(expected)


def test_retry_plan_bounds(spark):
    now = datetime(2024, 1, 1)
    rows = [
        ("h", 1, now, "u", "form", 503, OK, None, 0, None),
        ("h", 2, now, "u", "form", 503, OK, None, 3, None),
        ("h", 3, now, "u", "list", None, None, "TimeoutError", 4, 70.0),
        ("h", 4, now, "u", "detalhe", 429, OK, None, None, None),
        ("h", 5, now, "u", "list", None, None, "ValueError", 0, None),
        ("h", 6, now, "u", "list", 404, OK, None, 0, None),
    ] + [("h", 7 + i, now, "u", "stable_route", 500, OK, None, 5, None) for i in range(5)]
    # a degraded host scales the timeout a request already has, up to the cap
    rows += [("h", 20, now, "u", "list", 500, OK, None, 1, 45.0), ("h", 21, now, "u", "list", 500, OK, None, 1, 101.25)]
    plan = {r.seq: r for r in health.retry_plan(spark.createDataFrame(rows, FETCH_LOG)).collect()}
    assert sorted(plan) == [1, 2, 3, 4, 7, 8, 9, 10, 11, 20, 21]
    assert (plan[3].timeout_sec, plan[20].timeout_sec, plan[21].timeout_sec) == (70.0, 67.5, 120.0)
    assert (plan[1].delay_lo, plan[1].delay_hi, plan[1].timeout_sec) == (0.75, 2.25, 30.0)
    assert plan[2].give_up and plan[2].delay_lo is None
    assert (plan[3].attempt, plan[3].delay_lo, plan[3].delay_hi) == (5, 16.0, 48.0)
    assert (plan[4].max_retries, plan[4].delay_lo) == (5, 0.5)
    # ten events, all failed: degraded doubles the delay and scales the timeout
    assert plan[11].degraded and plan[11].delay_lo == pytest.approx(25.6) and plan[11].timeout_sec == pytest.approx(27.0)


def _planned_timeouts(rows, states):
    """Attempt by attempt: what each retry of a request carries."""
    out, carried = {}, {}
    for host, seq, _, url, endpoint, status, _, exception, times, logged in sorted(rows, key=lambda r: (r[0], r[1])):
        allowed, _, factor = C.ENDPOINTS.get(endpoint, (C.RETRY_DEFAULT_MAX, 1.0, 1.0))
        times = times or 0
        number, timeout = carried.get((host, url, endpoint), (None, None))
        current = logged if logged is not None else timeout if number == times else C.TIMEOUT_SEC
        retried = exception in C.RETRYABLE_EXCEPTIONS if exception else status in C.RETRY_STATUS
        after = min(current * factor, C.TIMEOUT_CAP) if states[host, seq] else current
        carried[host, url, endpoint] = (times + 1, after) if retried and times + 1 <= allowed else (None, None)
        if retried:
            out[host, seq] = after if times + 1 <= allowed else None
    return out


def test_timeouts_compound_along_a_request_without_a_log_of_them(spark):
    rng, now, rows = random.Random(3), datetime(2024, 1, 1), []
    live = {}
    for seq in range(600):
        host, url = rng.choice("ab"), rng.choice(["form", "form", "u1", "u2"])
        endpoint = "list" if url == "form" else rng.choice(["stable_route", "detalhe"])
        times = live.get((host, url, endpoint), 0)
        status = rng.choice([200, 404, 503, 503, 503, 500])
        live[host, url, endpoint] = rng.choice([times + 1, times + 1, times + 1, 0, 3]) if status in (500, 503) else 0
        rows.append((host, seq, now, url, endpoint, status, OK, None, times or None, rng.choice([None] * 8 + [40.0])))
    log = spark.createDataFrame(rows, FETCH_LOG)
    states = {(r.host, r.seq): r.degraded for r in health.server_health(log).collect()}
    expected = _planned_timeouts(rows, states)
    assert max(t for t in expected.values() if t) == C.TIMEOUT_CAP and len(set(expected.values())) > 15
    for chunk in (health.CHUNK, 40, 3):
        got = {(r.host, r.seq): r.timeout_sec for r in health.retry_plan(log, chunk=chunk).collect()}
        assert got == pytest.approx(expected), chunk


def test_failure_reasons(spark):
    now = datetime(2024, 1, 1)
    pages = [
        (503, OK, "status", False),
        (200, "ACESSO NEGADO" + OK, "content", False),
        (200, " " * 200, "content", False),
        (200, "<i>" * 80, "content", False),
        (200, "<i>" * 80 + "a " * 24 + "b", "content", False),
        (200, "<i>" * 80 + "a " * 24 + "bc", "none", True),
        (200, ("<i>" * 8 + "abcde") * 10, "none", True),
        (200, "\u00a0" + "a" * 99 + "\n", "content", False),
        (200, "\u00a0" + "a" * 100 + "\n", "none", True),
        (302, "", "none", True),
        (404, OK, "none", False),
        (200, OK, "none", True),
    ]
    rows = [("h", i, now, "u", "form", s, h, None, 0, None) for i, (s, h, _, _) in enumerate(pages)]
    got = health.fetch_failures(spark.createDataFrame(rows, FETCH_LOG)).orderBy("seq").collect()
    assert [(r.retry_reason, r.success) for r in got] == [(p[2], p[3]) for p in pages]
