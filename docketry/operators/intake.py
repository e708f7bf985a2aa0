"""Crawl requests: normalise, validate, limits. Map-only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry import constants as C
from docketry.functions.text import cnpj_digits, npu_digits, npu_hyphenated, strip


def request_intake(requests: DataFrame) -> DataFrame:
    """Normalised value and ``reject_reason`` (NULL = accepted) per request."""
    value = F.nullif(strip(F.col("valor")), F.lit(""))
    mode = F.nullif(F.col("modo"), F.lit(""))
    reason = (
        F.when(mode.isNull() | value.isNull(), "missing_parameter")
        .when(~mode.isin(C.SEARCH_MODES), "invalid_mode")
        .when((mode == "numero") & (F.length(npu_digits(value)) != C.NPU_DIGITS), "invalid_npu")
        .when((mode == "cnpj") & (F.length(cnpj_digits(value)) != C.CNPJ_DIGITS), "invalid_cnpj")
    )
    shaped = F.when(mode == "numero", npu_hyphenated(value)).when(
        mode == "cnpj", cnpj_digits(value)
    )
    return requests.select(
        "req_id",
        "modo",
        value.alias("valor"),
        F.when(value.isNotNull(), shaped).alias("valor_normalizado"),
        reason.alias("reject_reason"),
        "max_pages",
        "max_details_per_page",
    )


def accepted(intake: DataFrame) -> DataFrame:
    return intake.where(F.col("reject_reason").isNull())


def rejected(intake: DataFrame) -> DataFrame:
    return intake.where(F.col("reject_reason").isNotNull())


def seed_requests(intake: DataFrame, form_url: str, route: str) -> DataFrame:
    """First page to fetch per accepted request: the form, or list page 0 of a tax id."""
    value, by_number = F.col("valor_normalizado"), F.col("modo") == "numero"
    return accepted(intake).select(
        "req_id",
        F.when(by_number, form_url)
        .otherwise(F.concat(F.lit(route.rstrip("/") + "/"), value, F.lit("/0")))
        .alias("url"),
        F.when(by_number, "form").otherwise("lista").alias("tipo"),
        F.col("modo").alias("busca"),
        F.when(by_number, value).alias("numero"),
        F.when(~by_number, value).alias("cnpj"),
        F.when(~by_number, 0).alias("page_idx"),
        F.when(by_number, "form").otherwise("stable_route").alias("endpoint"),
    )


def _limit(c: Column, default: int, cap: int) -> Column:
    return F.when(c.isNull() | (c <= 0), F.lit(default)).otherwise(F.least(c, F.lit(cap)))


def crawl_limits(requests: DataFrame, *keep: str) -> DataFrame:
    """Effective limits per request; NULL or non-positive values take the default.

    ``keep`` names further request columns to pass through.
    """
    pages = _limit(F.col("max_pages"), C.DEFAULT_MAX_PAGES, C.CAP_MAX_PAGES)
    details = _limit(F.col("max_details_per_page"), C.DEFAULT_MAX_DETAILS, C.CAP_MAX_DETAILS)
    return requests.select(
        "req_id",
        *keep,
        pages.alias("max_pages"),
        details.alias("max_details_per_page"),
        (pages * details).alias("max_total_details"),
    )
