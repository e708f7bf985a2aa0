"""Fixed reports over the two tables. None of them reads ``html``.

Counts use one partial aggregation per table; lists use top-k, which keeps k
rows per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry import constants as C
from docketry.functions.text import js_round, rx


def _filled(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def _filled_list(c: str) -> Column:
    return F.coalesce(F.size(c), F.lit(0)) > 0


def _or_na(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("N/A"))


def collection_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("collection"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def pages_by_type(pages: DataFrame) -> DataFrame:
    """Pages per type in type order, then the total."""
    by_type = pages.groupBy(F.coalesce("context.tipo", F.lit("undefined")).alias("tipo")).agg(
        F.count("*").alias("n")
    )
    total = by_type.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("Total").alias("tipo"), "n")
    return (
        by_type.withColumn("ord", F.lit(0))
        .unionByName(total.withColumn("ord", F.lit(1)))
        .orderBy("ord", "tipo")
        .drop("ord")
    )


def field_coverage(records: DataFrame) -> DataFrame:
    flags = {
        "relator": _filled("relator"),
        "envolvidos": _filled_list("envolvidos"),
        "movimentacoes": _filled_list("movimentacoes"),
    }
    counts = records.agg(
        F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in flags.items()]
    ).unpivot("total", list(flags), "field", "n")
    # an empty table has no percentages
    return counts.where(F.col("total") > 0).withColumn(
        "pct", js_round(F.col("n") * 100 / F.col("total")).cast("bigint")
    )


def recent_pages(pages: DataFrame, n: int = 10) -> DataFrame:
    ctx = "context."
    return (
        pages.select("page_id", "context", "url", "fetched_at")
        .orderBy(F.desc("page_id"))
        .limit(n)
        .select(
            "page_id",
            _or_na(F.col(ctx + "tipo")).alias("tipo"),
            _or_na(F.col(ctx + "busca")).alias("busca"),
            F.coalesce(
                F.nullif(F.col(ctx + "numero"), F.lit("")), F.nullif(F.col(ctx + "cnpj"), F.lit("")), F.lit("N/A")
            ).alias("identificador"),
            F.col(ctx + "page_idx").alias("page_idx"),
            _or_na(F.col("url")).alias("url"),
            _or_na(F.col("fetched_at")).alias("fetched_at"),
        )
    )


def recent_processos(records: DataFrame, n: int = 5) -> DataFrame:
    """Highest case numbers first; "last" movement is the first of the page."""
    party = F.get("envolvidos", F.lit(0))
    return (
        records.select(
            "_id", "numero_processo", "relator", "data_autuacao", "envolvidos", "movimentacoes", "scraped_at"
        )
        .orderBy(F.desc("_id"))
        .limit(n)
        .select(
            F.coalesce(F.nullif(F.col("numero_processo"), F.lit("")), F.col("_id")).alias("numero"),
            _or_na(F.col("relator")).alias("relator"),
            _or_na(F.col("data_autuacao")).alias("data_autuacao"),
            F.coalesce(F.concat(party["papel"], F.lit(" - "), party["nome"]), F.lit("N/A")).alias("primeiro_envolvido"),
            F.coalesce(F.get("movimentacoes", F.lit(0))["data"], F.lit("N/A")).alias("ultima_movimentacao"),
            _or_na(F.col("scraped_at")).alias("scraped_at"),
        )
    )


def watchlist_check(watchlist: DataFrame, records: DataFrame) -> DataFrame:
    """Status of each watched case number.

    The records are first cut to the watched numbers by an inner join, which
    Spark broadcasts only if the measured list is small; the outer join then
    sees matches only.
    """
    watched = watchlist.select("npu").distinct()
    hits = (
        records.select("_id", "relator", "data_autuacao")
        .join(watched.withColumnRenamed("npu", "_id"), "_id")
    )
    return watched.join(hits, F.col("npu") == F.col("_id"), "left").select(
        "npu",
        F.when(F.col("_id").isNotNull(), "OK").otherwise("FALTANDO").alias("situacao"),
        F.when(F.col("_id").isNotNull(), _or_na(F.col("relator"))).alias("relator"),
        F.when(F.col("_id").isNotNull(), _or_na(F.col("data_autuacao"))).alias("data_autuacao"),
    )


def watchlist_totals(status: DataFrame) -> DataFrame:
    return status.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("situacao") == "OK").alias("encontrados"),
        F.count_if(F.col("situacao") != "OK").alias("faltantes"),
    )


def watchlist_missing(watchlist: DataFrame, records: DataFrame) -> DataFrame:
    hits = records.select("_id").join(
        watchlist.select(F.col("npu").alias("_id")).distinct(), "_id", "left_semi"
    )
    return watchlist.select("npu").distinct().join(hits, F.col("npu") == F.col("_id"), "left_anti")


def missing_fields(records: DataFrame) -> DataFrame:
    flags = {
        "numero_processo": _filled("numero_processo"),
        "relator": _filled("relator"),
        "data_autuacao": _filled("data_autuacao"),
        "envolvidos": _filled_list("envolvidos"),
        "movimentacoes": _filled_list("movimentacoes"),
    }
    return (
        records.agg(F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in flags.items()])
        .unpivot("total", list(flags), "field", "filled")
        .withColumn("missing", F.col("total") - F.col("filled"))
    )


def non_iso_dates(records: DataFrame) -> DataFrame:
    c = F.col("data_autuacao")
    return records.agg(
        F.count("*").alias("total"),
        F.count_if(c.isNotNull() & ~c.rlike(C.ISO_DATE_PREFIX)).alias("non_iso"),
    )


def untitled_check(records: DataFrame, samples: int = 3) -> DataFrame:
    """Judges that still carry a title: their number, and the first few by ``_id``."""
    titled = records.select("_id", "relator").where(F.col("relator").rlike(rx(C.TITLE_LEFT, "i")))
    count = titled.agg(F.count("*").alias("n")).select(
        F.lit("count").alias("kind"), F.lit(None).cast("string").alias("_id"), F.lit(None).cast("string").alias("relator"), "n"
    )
    first = titled.orderBy("_id").limit(samples)
    return count.unionByName(
        first.select(F.lit("sample").alias("kind"), "_id", "relator", F.lit(None).cast("bigint").alias("n"))
    )


def _size_stats(records: DataFrame, column: str) -> DataFrame:
    n = F.size(column)
    return (
        records.where(n > 0)
        .agg(
            F.count("*").alias("total"),
            F.avg(n).alias("mean"),
            F.max(n).alias("maximo"),
            F.min(n).alias("minimo"),
        )
        .where(F.col("total") > 0)
        .select("total", (js_round(F.col("mean") * 100) / 100).alias("media"), "maximo", "minimo")
    )


def party_stats(records: DataFrame) -> DataFrame:
    return _size_stats(records, "envolvidos")


def movement_stats(records: DataFrame) -> DataFrame:
    return _size_stats(records, "movimentacoes")


def cnpj_discovery(pages: DataFrame, records: DataFrame) -> DataFrame:
    """Pages found by tax id: by type, list pages, indexed ones, highest index."""
    by_type = (
        pages.where(F.col("context.busca") == "cnpj")
        .select(F.coalesce("context.tipo", F.lit("undefined")).alias("tipo"), F.col("context.page_idx").alias("i"))
        .groupBy("tipo")
        .agg(F.count("*").alias("n"), F.count("i").alias("n_idx"), F.max("i").alias("max_idx"))
    )
    metric = F.array(
        F.struct(F.concat(F.lit("tipo:"), F.col("tipo")).alias("metric"), F.col("n").alias("value")),
        F.struct(F.lit("paginas_cnpj").alias("metric"), F.col("n").alias("value")),
        F.struct(
            F.when(F.col("tipo") == "lista", "paginas_lista").alias("metric"), F.col("n").alias("value")
        ),
        F.struct(
            F.when(F.col("tipo") == "lista", "com_indice").alias("metric"), F.col("n_idx").alias("value")
        ),
    )
    sums = (
        by_type.select(F.inline(metric))
        .where(F.col("metric").isNotNull())
        .groupBy("metric")
        .agg(F.sum("value").alias("value"))
    )
    last = by_type.where((F.col("tipo") == "lista") & (F.col("n_idx") > 0)).select(
        F.lit("ultimo_indice").alias("metric"), F.col("max_idx").cast("bigint").alias("value")
    )
    total = records.agg(F.count("*").alias("value")).select(
        F.lit("processos").alias("metric"), "value"
    )
    return sums.unionByName(last).unionByName(total)


def processos_by_judge(records: DataFrame, judge: str | None = None, top: int | None = None) -> DataFrame:
    """Records of one judge, or the newest ``top`` per judge, newest filing first."""
    rows = records.select("relator", "data_autuacao", "_id").where(F.col("relator").isNotNull())
    if judge is not None:
        rows = rows.where(F.col("relator") == judge)
    if top is not None:
        newest = Window.partitionBy("relator").orderBy(F.desc_nulls_last("data_autuacao"), "_id")
        rows = rows.withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= top)
    return rows.orderBy("relator", F.desc_nulls_last("data_autuacao"), "_id")


def run_report(runs: DataFrame) -> DataFrame:
    """Executions, successes, failures and whole percent per batch."""
    ok = F.count_if("ok")
    return runs.groupBy("batch_id").agg(
        F.count("*").alias("executions"),
        ok.alias("successes"),
        (F.count("*") - ok).alias("failures"),
        F.expr("count_if(ok) * 100 div count(*)").alias("success_pct"),
    )


def reprocess_report(outcomes: DataFrame) -> DataFrame:
    """Processed, succeeded, failed: only a detail without a record fails."""
    failed = F.count_if((F.col("tipo") == "detalhe") & ~F.col("has_record"))
    return outcomes.agg(
        F.count("*").alias("processed"),
        (F.count("*") - failed).alias("succeeded"),
        failed.alias("failed"),
    )
