"""Query catalog: every operator over whole tables, with flat result columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions.text import content_hash
from docketry.operators import (
    classify,
    extract,
    frontier,
    health,
    intake,
    pagination,
    reports,
    upsert,
    validate,
)
from docketry.plans import ingest
from docketry.session import scratch
from docketry.sources import pages as pg
from docketry.sources import rendered as R
from docketry.sources import snapshots
from docketry.streaming import health as sh
from docketry.streaming import pages as sp

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ----------------------------------------------------------------------------- inputs
def _records(spark: SparkSession, sf: str) -> DataFrame:
    """The case table after all captures."""
    return upsert.reduce_records(R.captures(spark, sf)).select(*upsert.FIELDS)


def _old_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """An earlier table: the finished and pending orders, as re-extracted once."""
    old = R.captures(spark, sf).where(F.col("status").isin("F", "P"))
    return upsert.reduce_records(old).select(
        *[
            F.lit("old").alias(f) if f in ("relator", "reprocessed_from_doc") else F.col(f)
            for f in upsert.FIELDS
        ]
    )


def _batch(spark: SparkSession, sf: str) -> DataFrame:
    return R.captures(spark, sf).where(F.col("status").isin("F", "O"))


def _flat(records: DataFrame) -> DataFrame:
    """Records with both arrays as text, so results are scalar."""
    return records.select(
        *[c for c in upsert.FIELDS if c not in ("envolvidos", "movimentacoes")],
        F.array_join(
            F.transform("envolvidos", lambda p: F.concat_ws("=", p["papel"], p["nome"])), ";"
        ).alias("envolvidos"),
        F.array_join(
            F.transform("movimentacoes", lambda m: F.concat_ws("=", m["data"], m["texto"])), ";"
        ).alias("movimentacoes"),
    )


def _form_listed(spark: SparkSession, sf: str) -> DataFrame:
    return R.list_pages(spark, sf).where(classify.page_class(F.col("html")) == "list")


def _stable_listed(spark: SparkSession, sf: str) -> DataFrame:
    return R.list_pages(spark, sf).where(classify.stable_list_class(F.col("html")) == "list")


def _stable_links(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.frontier_stable(_stable_listed(spark, sf), R.crawl_limit_rows(spark, sf), R.PLAIN_SITE)


def _details(spark: SparkSession, sf: str) -> DataFrame:
    return R.detail_pages(spark, sf)


# ---------------------------------------------------------------- sources, sinks, layout
@_query
def land_raw_pages(spark: SparkSession, sf: str) -> DataFrame:
    landed = pg.land_raw_pages(R.site_pages(spark, sf))
    return landed.select(
        "page_id", "url", "method", "status", F.col("headers")["Content-Type"].alias("content_type"),
        F.length("html").alias("n_chars"), "payload", "context.tipo", "context.busca", "context.numero",
        "context.cnpj", "context.page_idx", "context.endpoint", "fetched_at", "hash_html",
    )


@_query
def select_raw_pages(spark: SparkSession, sf: str) -> DataFrame:
    landed = pg.land_raw_pages(R.site_pages(spark, sf))
    return pg.select_raw_pages(landed, tipo="lista", busca="cnpj", skip=5, limit=20).select(
        "page_id", "url", "fetched_at"
    )


@_query
def select_deep_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page of the selection far behind its start: found by its keys, not by sorting what is skipped."""
    return pg.select_raw_pages(R.mixed_pages(spark, sf), tipo="detalhe", skip=1200, limit=1500).select("page_id", "url", "fetched_at")


@_query
def upsert_processos(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(upsert.upsert_processos(_old_snapshot(spark, sf), snapshots.staged(_batch(spark, sf))))


@_query
def upsert_actions(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.upsert_actions(_old_snapshot(spark, sf), _batch(spark, sf))


@_query
def compact_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches as deltas, folded into a base version and read back."""
    path = scratch(spark, "processos")
    captures = R.captures(spark, sf)
    snapshots.write_delta(captures.where(F.col("status") != "O"), path, 0)
    snapshots.write_delta(captures.where(F.col("status") == "O"), path, 1)
    snapshots.compact(spark, path)
    return _flat(snapshots.read_records(spark, path))


@_query
def layout_write(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "layout")
    pg.write_pages_layout(pg.land_raw_pages(R.mixed_pages(spark, sf)), f"{path}/pages")
    return (
        pg.read_pages(spark, f"{path}/pages")
        .groupBy("tipo")
        .agg(
            F.count("*").alias("n"),
            F.min("fetched_at").alias("first_at"),
            F.max("fetched_at").alias("last_at"),
            F.count("context.numero").alias("n_numero"),
        )
    )


@_query
def layout_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Lookups of a key per customer by url+method, number, tax id and judge, and of the records of the last day."""
    path = scratch(spark, "lookup")
    pg.write_url_layout(pg.land_raw_pages(R.mixed_pages(spark, sf)), path)
    pg.write_records_layout(_records(spark, sf), path)
    q = F.col("c_custkey")
    wanted = R.table(spark, sf, "customer").select(
        F.concat(F.lit(f"{R.SITE}/pagina/"), q.cast("string")).alias("url"),
        R.case_number(q, F.lit(1995) + q % 7).alias("numero"),
        F.lpad(q.cast("string"), 14, "0").alias("cnpj"),
        F.col("c_name").alias("relator"),
    )

    def found(name: str, rows: DataFrame, key: str, value: str) -> DataFrame:
        return rows.select(F.lit(name).alias("lookup"), F.col(key).alias("key"), F.col(value).cast("string").alias("found"))

    keyed = {"by_url": ("url", "page_id"), "by_numero": ("numero", "page_id"), "by_cnpj": ("cnpj", "page_id"), "by_judge": ("relator", "_id")}
    parts = [
        found(name, spark.read.parquet(f"{path}/{name}").join(wanted.select(key), key), key, value)
        for name, (key, value) in keyed.items()
    ]
    written = spark.read.parquet(f"{path}/by_scraped_at")
    day = written.agg(F.substring(F.max("scraped_at"), 1, 10)).first()[0]
    parts.append(found("by_scraped_at", written.where(F.col("scraped_at") >= F.lit(day)), "scraped_at", "_id"))
    return reduce(DataFrame.unionByName, parts)


@_query
def page_integrity(spark: SparkSession, sf: str) -> DataFrame:
    landed = pg.land_raw_pages(R.site_pages(spark, sf))
    stored = F.when(F.col("page_id") % 4 == 0, content_hash(F.col("url"))).otherwise(F.col("hash_html"))
    return pg.page_integrity(landed.withColumn("hash_html", stored))


@_query
def repeated_captures(spark: SparkSession, sf: str) -> DataFrame:
    return pg.repeated_captures(pg.land_raw_pages(R.mixed_pages(spark, sf)))


@_query
def processos_by_judge(spark: SparkSession, sf: str) -> DataFrame:
    return reports.processos_by_judge(_records(spark, sf), top=3)


# ------------------------------------------------------------------- validation, intake
@_query
def request_intake(spark: SparkSession, sf: str) -> DataFrame:
    return intake.request_intake(R.crawl_requests(spark, sf)).select(
        "req_id", "modo", "valor", "valor_normalizado", "reject_reason"
    )


@_query
def seed_requests(spark: SparkSession, sf: str) -> DataFrame:
    return intake.seed_requests(intake.request_intake(R.crawl_requests(spark, sf)), f"{R.SITE}/cp/", R.ROUTE)


@_query
def crawl_limits(spark: SparkSession, sf: str) -> DataFrame:
    return intake.crawl_limits(R.crawl_requests(spark, sf))


def _checked_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Captures as given by the fetcher, with some fields the store refuses."""
    k = F.col("page_id")
    landed = pg.land_raw_pages(R.mixed_pages(spark, sf))
    return validate.validate_raw_pages(
        landed.withColumn("method", F.when(k % 10 == 3, "PUT").when(k % 10 != 4, F.col("method")))
        .withColumn("status", F.when(k % 14 == 5, 999).when(k % 14 != 6, F.col("status")))
        .withColumn("url", F.when(k % 15 != 7, F.col("url")))
        .withColumn(
            "fetched_at", F.when(k % 16 == 8, F.concat("fetched_at", F.lit("Z"))).when(k % 16 != 9, F.col("fetched_at"))
        )
        .withColumn("hash_html", F.when(k % 18 == 10, "sha256:xyz").otherwise(F.col("hash_html")))
    )


def _checked_records(spark: SparkSession, sf: str) -> DataFrame:
    return validate.validate_processos(_records(spark, sf))


@_query
def validate_raw_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _checked_pages(spark, sf).select("page_id", F.array_join("violations", ",").alias("violations"))


@_query
def validate_processos(spark: SparkSession, sf: str) -> DataFrame:
    return _checked_records(spark, sf).select("_id", F.array_join("violations", ",").alias("violations"))


@_query
def quarantine_processos(spark: SparkSession, sf: str) -> DataFrame:
    return validate.quarantine(_checked_records(spark, sf)).select("_id", F.size("violations").alias("n"))


@_query
def violation_summary(spark: SparkSession, sf: str) -> DataFrame:
    return validate.violation_summary(_checked_records(spark, sf))


# ----------------------------------------------------------------- scalar expression jobs
@_query
def date_normalize(spark: SparkSession, sf: str) -> DataFrame:
    k, d = F.col("k"), F.col("d")
    day = F.date_format(d, "d/M/yyyy")
    raw = (
        F.when(k % 5 == 0, day)
        .when(k % 5 == 1, F.concat(day, F.lit(" 3:5")))
        .when(k % 5 == 2, F.concat(F.lit(" "), F.date_format(d, "dd/MM/yyyy"), F.lit("  23:59:58 fim")))
        .when(k % 5 == 3, F.concat(F.lit("31/02/"), F.year(d).cast("string")))
        .otherwise(F.concat(day, F.lit(" 25:99")))
    )
    return extract.date_normalize(
        R.cases(spark, sf).select(F.floor(k / 1000).alias("batch_id"), raw.alias("raw"))
    )


@_query
def judge_directory(spark: SparkSession, sf: str) -> DataFrame:
    k, nm = F.col("k"), F.col("nm")
    raw = (
        F.when(k % 6 == 0, F.concat(F.lit("DESEMBARGADOR FEDERAL "), nm))
        .when(k % 6 == 1, F.concat(F.lit("  Des.\n"), nm))
        .when(k % 6 == 2, F.concat(F.lit("juiza federal Dra. "), nm))
        .when(k % 6 == 3, F.concat(F.lit("JUÍZA FEDERAL "), nm))
        .when(k % 6 == 4, F.concat(F.lit("Des. Desembargadora Dr. "), nm))
        .otherwise(nm)
    )
    return extract.judge_directory(R.cases(spark, sf).select(raw.alias("raw")))


# ------------------------------------------------------------------------ classification
@_query
def page_signals(spark: SparkSession, sf: str) -> DataFrame:
    return classify.page_signals(R.site_pages(spark, sf))


@_query
def page_signals_mixed(spark: SparkSession, sf: str) -> DataFrame:
    return classify.page_signals(R.mixed_pages(spark, sf))


@_query
def classify_pages(spark: SparkSession, sf: str) -> DataFrame:
    return classify.classify_pages(R.mixed_pages(spark, sf)).select("page_id", "page_class")


@_query
def classify_site_pages(spark: SparkSession, sf: str) -> DataFrame:
    return classify.classify_pages(R.site_pages(spark, sf)).groupBy("page_class").agg(F.count("*").alias("n"))


@_query
def page_rules(spark: SparkSession, sf: str) -> DataFrame:
    html = F.col("html")
    return R.mixed_pages(spark, sf).select(
        "page_id",
        classify.is_detail(html).alias("is_detail"),
        classify.is_list(html).alias("is_list"),
        classify.is_error(html).alias("is_error"),
    )


@_query
def classify_stable_list(spark: SparkSession, sf: str) -> DataFrame:
    sources = {"list": R.list_pages(spark, sf), "mixed": R.mixed_pages(spark, sf)}
    listed, mixed = (df.select("page_id", "html", F.lit(n).alias("source")) for n, df in sources.items())
    return classify.classify_stable_list(listed.unionByName(mixed)).select("source", "page_id", "page_class")


@_query
def classify_listed(spark: SparkSession, sf: str) -> DataFrame:
    return classify.classify_pages(R.list_pages(spark, sf)).select("page_id", "page_class")


@_query
def label_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return classify.label_confusion(R.mixed_pages(spark, sf))


@_query
def page_indicator_report(spark: SparkSession, sf: str) -> DataFrame:
    return classify.page_indicator_report(R.site_pages(spark, sf))


@_query
def page_indicator_report_mixed(spark: SparkSession, sf: str) -> DataFrame:
    return classify.page_indicator_report(R.mixed_pages(spark, sf))


# ---------------------------------------------------------------------------- extraction
@_query
def page_cells(spark: SparkSession, sf: str) -> DataFrame:
    return extract.page_cells(_details(spark, sf)).select("page_id", "row_idx", "cell_idx", "text")


@_query
def page_cells_nested(spark: SparkSession, sf: str) -> DataFrame:
    return extract.page_cells(R.nested_pages(spark, sf)).select("page_id", "row_idx", "cell_idx", "raw", "text")


@_query
def extract_envolvidos_nested(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_envolvidos(R.nested_pages(spark, sf))


@_query
def extract_relator_nested(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_relator(R.nested_pages(spark, sf))


@_query
def extract_numero(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_numero(_details(spark, sf))


@_query
def extract_legado(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_legado(_details(spark, sf))


@_query
def extract_data_autuacao(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_data_autuacao(_details(spark, sf))


@_query
def extract_data_autuacao_offline(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_data_autuacao(_details(spark, sf), "offline")


@_query
def extract_relator(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_relator(_details(spark, sf))


@_query
def extract_relator_offline(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_relator(_details(spark, sf), "offline")


@_query
def extract_envolvidos(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_envolvidos(_details(spark, sf))


@_query
def extract_envolvidos_offline(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_envolvidos(_details(spark, sf), "offline")


@_query
def extract_movimentacoes(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_movimentacoes(_details(spark, sf))


@_query
def extract_movimentacoes_offline(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_movimentacoes(_details(spark, sf), "offline")


@_query
def extract_movimentacoes_long(spark: SparkSession, sf: str) -> DataFrame:
    """Whole document texts as movements: length and hash of every extracted text."""
    return extract.extract_movimentacoes(R.text_pages(spark, sf)).select(
        "page_id", "pos", "data", F.length("texto").alias("n_chars"), F.sha2("texto", 256).alias("digest")
    )


@_query
def extract_processos(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(extract.extract_processos(_details(spark, sf)))


@_query
def extract_processos_offline(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(extract.extract_processos(_details(spark, sf), "offline", "2025-01-01T00:00:00"))


@_query
def form_fields(spark: SparkSession, sf: str) -> DataFrame:
    fields = extract.form_fields(R.form_pages(spark, sf))
    return fields.select("page_id", F.explode("fields").alias("name", "value"))


@_query
def inputs_by_keyword(spark: SparkSession, sf: str) -> DataFrame:
    return extract.inputs_by_keyword(R.form_pages(spark, sf), ["processo", "npu"])


@_query
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    return extract.page_links(R.site_pages(spark, sf)).select("page_id", "pos", "href", "npu")


@_query
def page_links_rendered(spark: SparkSession, sf: str) -> DataFrame:
    return extract.page_links(R.list_pages(spark, sf)).select("page_id", "pos", "href", "text", "npu")


# ------------------------------------------------------------- links, pagination, frontier
@_query
def best_detail_link(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.best_detail_link(R.link_pages(spark, sf))


@_query
def frontier_form(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.frontier_form(_form_listed(spark, sf), R.crawl_limit_rows(spark, sf))


@_query
def frontier_stable(spark: SparkSession, sf: str) -> DataFrame:
    return _stable_links(spark, sf)


def _repeated_lists(spark: SparkSession, sf: str) -> DataFrame:
    return R.repeated_list_pages(spark, sf).where(classify.stable_list_class(F.col("html")) == "list")


def _repeated_links(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.frontier_stable(_repeated_lists(spark, sf), R.second_limit_rows(spark, sf), R.PLAIN_SITE)


@_query
def frontier_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Two requests per tax id, pages captured again."""
    return _repeated_links(spark, sf)


@_query
def list_totals(spark: SparkSession, sf: str) -> DataFrame:
    return pagination.list_totals(R.list_pages(spark, sf))


@_query
def stable_totals(spark: SparkSession, sf: str) -> DataFrame:
    return pagination.stable_totals(R.list_pages(spark, sf))


@_query
def nav_links(spark: SparkSession, sf: str) -> DataFrame:
    return pagination.nav_links(R.list_pages(spark, sf)).withColumn(
        "page_numbers", F.array_join(F.col("page_numbers").cast("array<string>"), ",")
    )


@_query
def page_ranges(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("c_custkey")
    states = R.table(spark, sf, "customer").select(
        q.alias("state_id"),
        (q % 4 - 1).alias("current_page"),
        F.when(q % 5 > 0, q % 13 - 1).alias("last_page"),
        (q % 6 + 1).alias("max_pages"),
    )
    return pagination.page_ranges(states)


@_query
def next_pages_form(spark: SparkSession, sf: str) -> DataFrame:
    return pagination.next_pages_form(_form_listed(spark, sf), R.crawl_limit_rows(spark, sf))


@_query
def next_pages_stable(spark: SparkSession, sf: str) -> DataFrame:
    return pagination.next_pages_stable(_stable_listed(spark, sf), R.crawl_limit_rows(spark, sf), R.ROUTE)


@_query
def next_pages_repeated(spark: SparkSession, sf: str) -> DataFrame:
    return pagination.next_pages_stable(_repeated_lists(spark, sf), R.second_limit_rows(spark, sf), R.ROUTE)


def _captured(spark: SparkSession, sf: str) -> DataFrame:
    return R.cases(spark, sf).where(F.col("status") != "P").select(F.col("npu").alias("numero"))


@_query
def frontier_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.frontier_coverage(_stable_links(spark, sf), _captured(spark, sf))


@_query
def frontier_coverage_repeated(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.frontier_coverage(_repeated_links(spark, sf), _captured(spark, sf))


@_query
def missing_details(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.missing_details(_stable_links(spark, sf), _captured(spark, sf))


@_query
def done_details(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.done_details(_stable_links(spark, sf), _captured(spark, sf))


# ------------------------------------------------------------------------------- health
def _micros(c: str) -> Column:
    return F.unix_micros(c).alias(c)


def _health_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "host", "seq", _micros("ts"), "failed", "n", "recent_failures", "consecutive_failures",
        _micros("last_success"), F.round("failure_rate", 6).alias("failure_rate"), "degraded",
    )


@_query
def fetch_failures(spark: SparkSession, sf: str) -> DataFrame:
    return health.fetch_failures(R.fetch_log(spark, sf))


@_query
def exception_class(spark: SparkSession, sf: str) -> DataFrame:
    return health.exception_class(R.fetch_log(spark, sf))


@_query
def server_health(spark: SparkSession, sf: str) -> DataFrame:
    return _health_columns(health.server_health(R.fetch_log(spark, sf)))


@_query
def health_transitions(spark: SparkSession, sf: str) -> DataFrame:
    changes = health.health_transitions(health.server_health(R.fetch_log(spark, sf)))
    return changes.select("host", "seq", _micros("ts"), "change")


@_query
def health_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    snap = health.health_snapshot(health.server_health(R.fetch_log(spark, sf)))
    return snap.withColumn("last_success", F.unix_micros("last_success")).withColumn(
        "failure_rate", F.round("failure_rate", 6)
    )


@_query
def health_snapshot_hosts(spark: SparkSession, sf: str) -> DataFrame:
    """A list of hosts, some of which have no events."""
    hosts = R.table(spark, sf, "customer").select(F.concat(F.lit("h"), (F.col("c_custkey") % 6).cast("string")).alias("host"))
    snap = health.health_snapshot(health.server_health(R.fetch_log(spark, sf)), hosts)
    return snap.withColumn("last_success", F.unix_micros("last_success")).withColumn(
        "failure_rate", F.round("failure_rate", 6)
    )


@_query
def retry_plan(spark: SparkSession, sf: str) -> DataFrame:
    return health.retry_plan(R.fetch_log(spark, sf)).withColumns(
        {c: F.round(c, 6) for c in ("delay_lo", "delay_hi", "timeout_sec")}
    )


@_query
def retry_chains(spark: SparkSession, sf: str) -> DataFrame:
    """Requests retried up to seven times, whose timeouts the log mostly lacks."""
    return health.retry_plan(R.chained_log(spark, sf)).select("host", "seq", "endpoint", "attempt", "give_up", "degraded", F.round("timeout_sec", 6).alias("timeout_sec"))


# ------------------------------------------------------------------------------ reports
def _stored_pages(spark: SparkSession, sf: str) -> DataFrame:
    return R.mixed_pages(spark, sf)


@_query
def collection_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.collection_counts(
        {
            "crawl_requests": R.crawl_requests(spark, sf),
            "fetch_log": R.fetch_log(spark, sf),
            "processos": _records(spark, sf),
            "raw_pages": _stored_pages(spark, sf),
        }
    )


@_query
def pages_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return reports.pages_by_type(_stored_pages(spark, sf))


@_query
def field_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return reports.field_coverage(_records(spark, sf))


@_query
def recent_pages(spark: SparkSession, sf: str) -> DataFrame:
    return reports.recent_pages(pg.land_raw_pages(R.site_pages(spark, sf)))


@_query
def recent_processos(spark: SparkSession, sf: str) -> DataFrame:
    return reports.recent_processos(_records(spark, sf))


def _watchlist(spark: SparkSession, sf: str) -> DataFrame:
    """A number per customer: customer keys are order keys too, but the year differs
    for most, so some are in the table and some are not."""
    q = F.col("c_custkey")
    return R.table(spark, sf, "customer").select(R.case_number(q, F.lit(1995) + q % 7).alias("npu"))


@_query
def watchlist_check(spark: SparkSession, sf: str) -> DataFrame:
    return reports.watchlist_check(_watchlist(spark, sf), _records(spark, sf))


@_query
def watchlist_totals(spark: SparkSession, sf: str) -> DataFrame:
    return reports.watchlist_totals(reports.watchlist_check(_watchlist(spark, sf), _records(spark, sf)))


@_query
def watchlist_missing(spark: SparkSession, sf: str) -> DataFrame:
    return reports.watchlist_missing(_watchlist(spark, sf), _records(spark, sf))


@_query
def missing_fields(spark: SparkSession, sf: str) -> DataFrame:
    return reports.missing_fields(_records(spark, sf))


@_query
def non_iso_dates(spark: SparkSession, sf: str) -> DataFrame:
    return reports.non_iso_dates(_records(spark, sf))


@_query
def untitled_check(spark: SparkSession, sf: str) -> DataFrame:
    return reports.untitled_check(_records(spark, sf))


@_query
def party_stats(spark: SparkSession, sf: str) -> DataFrame:
    return reports.party_stats(_records(spark, sf))


@_query
def movement_stats(spark: SparkSession, sf: str) -> DataFrame:
    return reports.movement_stats(_records(spark, sf))


@_query
def cnpj_discovery(spark: SparkSession, sf: str) -> DataFrame:
    return reports.cnpj_discovery(_stored_pages(spark, sf), _records(spark, sf))


@_query
def run_report(spark: SparkSession, sf: str) -> DataFrame:
    """Runs = fetched pages in batches of a thousand; a run succeeds with a record."""
    runs = R.mixed_pages(spark, sf).select(
        F.floor(F.col("page_id") / 1000).alias("batch_id"),
        ((classify.page_class(F.col("html")) == "detail") & extract.numero(F.col("html"), F.col("html")).isNotNull()).alias("ok"),
    )
    return reports.run_report(runs)


@_query
def idempotency_check(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.idempotency_check(upsert.upsert_actions(_old_snapshot(spark, sf), _batch(spark, sf)))


@_query
def reprocess_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.reprocess_report(ingest.reprocess_outcomes(R.mixed_pages(spark, sf), limit=None))


# ---------------------------------------------------------------------- flows, streaming
@_query
def reprocess_pages(spark: SparkSession, sf: str) -> DataFrame:
    landed = pg.land_raw_pages(R.detail_pages(spark, sf))
    return _flat(
        ingest.reprocess_pages(landed, _old_snapshot(spark, sf), scraped_at="2025-01-01T00:00:00", limit=None)
    )


@_query
def reprocess_delta(spark: SparkSession, sf: str) -> DataFrame:
    """The same cases ingested, re-extracted offline, compacted, and some re-extracted online after that."""
    path = scratch(spark, "reprocess-delta")
    landed = pg.land_raw_pages(R.detail_pages(spark, sf))
    snapshots.write_delta(ingest.detail_records(landed), path, 0)
    snapshots.write_delta(ingest.rerun_records(landed, scraped_at="2025-01-01T00:00:00"), path, 1)
    snapshots.compact(spark, path)
    even = landed.where(F.col("page_id") % 2 == 0)
    snapshots.write_delta(ingest.rerun_records(even, "online", "2025-02-01T00:00:00"), path, 2)
    return _flat(snapshots.read_records(spark, path))


@_query
def ingest_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(ingest.ingest_pages(R.detail_pages(spark, sf), _old_snapshot(spark, sf)))


@_query
def stream_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The pages arrive in two appends; each is processed as it lands."""
    path = scratch(spark, "stream-pages")
    fetched = R.detail_pages(spark, sf)
    stored = F.col("context.tipo").isNotNull()
    for arrived in (stored, ~stored):
        pg.append_raw_pages(pg.land_raw_pages(fetched.where(arrived)), f"{path}/in")
        sp.stream_pages(spark, f"{path}/in", f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return _flat(snapshots.read_records(spark, f"{path}/table"))


@_query
def stream_after_compact(spark: SparkSession, sf: str) -> DataFrame:
    """A stream, a compaction, a second stream with a fresh checkpoint, an offline re-extraction of all, new captures.

    A third of the cases is streamed by each stream and the rest by the first; the second
    one then gets its third again, after the re-extraction, and folds at every second delta.
    """
    path = scratch(spark, "stream-after-compact")
    landed = pg.land_raw_pages(R.detail_pages(spark, sf))
    third = F.col("page_id") % 3 == 2

    def arrive(pages: DataFrame, name: str, fold_every: int | None = None) -> None:
        pg.append_raw_pages(pages, f"{path}/{name}")
        sp.stream_pages(spark, f"{path}/{name}", f"{path}/table", f"{path}/mark-{name}", fold_every=fold_every).awaitTermination()

    arrive(landed.where(~third), "first")
    snapshots.compact(spark, f"{path}/table")
    arrive(landed.where(third), "second", 2)
    snapshots.write_delta(ingest.rerun_records(landed, scraped_at="2025-01-01T00:00:00"), f"{path}/table", 0, "rerun")
    arrive(landed.where(third), "second", 2)
    return _flat(snapshots.read_records(spark, f"{path}/table"))


def _streamed_health(spark: SparkSession, sf: str, order: tuple[int, ...] = (0, 1, 2)) -> str:
    """The log arrives in three appends, its thirds in this order; returns the table folder."""
    path = scratch(spark, "stream-health")
    log = R.fetch_log(spark, sf)
    bounds = log.agg(F.min("seq").alias("lo"), (F.max("seq") + 1).alias("hi")).first()
    third = (bounds["hi"] - bounds["lo"]) // 3
    cuts = [bounds["lo"], bounds["lo"] + third, bounds["lo"] + 2 * third, bounds["hi"]]
    for lo, hi in [(cuts[i], cuts[i + 1]) for i in order]:
        log.where((F.col("seq") >= lo) & (F.col("seq") < hi)).write.mode("append").parquet(f"{path}/in")
        sh.stream_health(spark, f"{path}/in", f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return f"{path}/table"


@_query
def stream_health(spark: SparkSession, sf: str) -> DataFrame:
    return _health_columns(sh.read_health(spark, _streamed_health(spark, sf)))


@_query
def stream_health_transitions(spark: SparkSession, sf: str) -> DataFrame:
    changes = sh.read_transitions(spark, _streamed_health(spark, sf))
    return changes.select("host", "seq", _micros("ts"), "change")


@_query
def stream_health_late(spark: SparkSession, sf: str) -> DataFrame:
    """The last third of the log comes first: what it said is restated twice."""
    return _health_columns(sh.read_health(spark, _streamed_health(spark, sf, (2, 0, 1))))


@_query
def stream_transitions_late(spark: SparkSession, sf: str) -> DataFrame:
    changes = sh.read_transitions(spark, _streamed_health(spark, sf, (1, 2, 0)))
    return changes.select("host", "seq", _micros("ts"), "change")
