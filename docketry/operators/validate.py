"""Store rules for both tables. Map-only; the summary aggregates rule names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry import constants as C

_NPU_EXACT = f"^{C.NPU}$"


def _unless(ok: Column, c: Column) -> Column:
    """Violated when a value is present and the rule does not hold."""
    return c.isNotNull() & ~ok


def _violations(rules: dict[str, Column]) -> Column:
    return F.filter(
        F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]),
        lambda v: v.isNotNull(),
    )


def _enum(name: str, values: list[str]) -> Column:
    return _unless(F.col(name).isin(values), F.col(name))


def _shape(name: str, pattern: str) -> Column:
    return _unless(F.col(name).rlike(pattern), F.col(name))


def validate_raw_pages(pages: DataFrame) -> DataFrame:
    """Pages with ``violations``. Fields the writer always sets must not be NULL."""
    rules = {
        "url:required": F.col("url").isNull(),
        "html:required": F.col("html").isNull(),
        "context.tipo:required": F.col("context.tipo").isNull(),
        "fetched_at:required": F.col("fetched_at").isNull(),
        "method:enum": F.col("method").isNull() | ~F.col("method").isin(C.METHODS),
        "status:range": F.col("status").isNull() | ~F.col("status").between(100, 599),
        "context.tipo:enum": _enum("context.tipo", C.PAGE_TYPES),
        "context.busca:enum": _enum("context.busca", C.SEARCH_MODES),
        "context.numero:pattern": _shape("context.numero", _NPU_EXACT),
        "context.cnpj:pattern": _shape("context.cnpj", r"^\d{14}$"),
        "context.page_idx:minimum": _unless(F.col("context.page_idx") >= 0, F.col("context.page_idx")),
        "fetched_at:pattern": _shape("fetched_at", C.ISO_SECONDS),
        "hash_html:pattern": _shape("hash_html", C.HASH),
    }
    return pages.withColumn("violations", _violations(rules))


def validate_processos(records: DataFrame) -> DataFrame:
    """Records with ``violations``, elements of both arrays included."""
    parties, moves = F.col("envolvidos"), F.col("movimentacoes")
    rules = {
        "_id:required": F.col("_id").isNull(),
        "numero_processo:required": F.col("numero_processo").isNull(),
        "fonte_url:required": F.col("fonte_url").isNull(),
        "scraped_at:required": F.col("scraped_at").isNull(),
        "_id:pattern": _shape("_id", _NPU_EXACT),
        "data_autuacao:pattern": _shape("data_autuacao", C.ISO_DATE_OR_SECONDS),
        "scraped_at:pattern": _shape("scraped_at", C.ISO_SECONDS),
        "envolvidos:type": parties.isNull(),
        "envolvidos.papel:required": F.exists(parties, lambda p: p["papel"].isNull()),
        "envolvidos.nome:required": F.exists(parties, lambda p: p["nome"].isNull()),
        "movimentacoes:type": moves.isNull(),
        "movimentacoes.data:required": F.exists(moves, lambda m: m["data"].isNull()),
        "movimentacoes.texto:required": F.exists(moves, lambda m: m["texto"].isNull()),
        "movimentacoes.data:pattern": F.exists(
            moves, lambda m: m["data"].isNotNull() & ~m["data"].rlike(C.ISO_DATE_OR_SECONDS)
        ),
    }
    return records.withColumn("violations", _violations(rules))


def valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("violations") == 0).drop("violations")


def quarantine(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("violations") > 0)


def violation_summary(checked: DataFrame) -> DataFrame:
    return (
        checked.select(F.explode("violations").alias("rule"))
        .groupBy("rule")
        .agg(F.count("*").alias("n"))
    )
