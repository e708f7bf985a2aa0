"""Totals, navigation links, page ranges and next list pages.

Page work is map-only; next pages add one small shuffle per crawl and URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry import constants as C
from docketry.functions import markup as M
from docketry.functions.text import first_group, rx, strip
from docketry.functions.urls import page_url, url_join
from docketry.operators.frontier import crawl_of, first_captures, largest_limits, request_of, with_limits


def total_of(html: Column) -> Column:
    """First total by pattern order, NULL when no pattern matches."""
    return F.coalesce(*[first_group(html, p, "i") for p in C.TOTAL_PATTERNS]).try_cast("bigint")


def last_page_of(total: Column, page_size: int = C.PAGE_SIZE) -> Column:
    """Zero-based last page; no page size means no answer."""
    if page_size <= 0:
        return F.lit(None).cast("bigint")
    return F.greatest(F.ceil(total / F.lit(page_size)) - 1, F.when(total.isNotNull(), F.lit(0)))


def list_totals(pages: DataFrame, page_size: int = C.PAGE_SIZE) -> DataFrame:
    return pages.select("page_id", total_of(F.col("html")).alias("total")).select(
        "page_id",
        "total",
        F.lit(page_size).alias("page_size"),
        last_page_of(F.col("total"), page_size).cast("bigint").alias("last_page"),
    )


def stable_totals(pages: DataFrame) -> DataFrame:
    """Total shown in the query text, else in any text node."""
    mk = F.col("mk")
    pattern = rx(C.TOTAL_PATTERNS[0], "i")

    def shown(texts: Column) -> Column:
        hit = F.get(F.filter(texts, lambda t: t.rlike(pattern)), F.lit(0))
        return F.regexp_extract(hit, pattern, 1)

    total = F.coalesce(
        shown(M.class_texts(M.block_of_class(mk, "consulta_paginas"), "texto_consulta")),
        shown(M.class_texts(mk, "texto_consulta")),
        shown(M.text_nodes_with(mk, "Total:")),
    )
    return pages.select("page_id", M.markup(F.col("html")).alias("mk")).select(
        "page_id", total.try_cast("bigint").alias("total")
    )


# a link that holds nothing but text; a tag holds no '<', so the scan is linear
_TEXT_LINK = r"(?i)<a\b[^<>]*+>(?:[^<]*+|\s*+<{1,2}\s*+)</a>"
_HREF = r"""(?is)^.*href=["']([^"']*)["']"""


def text_links(html: Column) -> Column:
    """array<struct<href, text>> of the links that hold only text, in page order."""

    def parse(a: Column) -> Column:
        return F.struct(
            F.regexp_extract(F.regexp_extract(a, r"^<[^<>]*+>", 0), _HREF, 1).alias("href"),
            strip(F.regexp_replace(F.regexp_replace(a, r"^<[^<>]*+>", ""), "(?i)</a>$", "")).alias("text"),
        )

    return F.transform(F.regexp_extract_all(html, F.lit(rx(_TEXT_LINK)), F.lit(0)), parse)


def _page_of(href: Column) -> Column:
    return first_group(href, C.PAGE_PARAM, "i").try_cast("bigint")


def nav_columns(links: Column) -> dict[str, Column]:
    """Target page per kind of link: of the first text pattern that any link matches; later ones are not tried."""

    def first_with(text: str) -> Column:
        pattern = rx(f"^(?:{text})$", "iu")
        return F.get(F.filter(links, lambda a: a["text"].rlike(pattern)), F.lit(0))["href"]

    def target(kind: str) -> Column:
        return _page_of(F.coalesce(*[first_with(text) for text in C.NAV_TEXT[kind]]))

    numbered = F.filter(links, lambda a: a["text"].rlike(r"^\d+$") & _page_of(a["href"]).isNotNull())
    numbers = F.array_sort(F.array_distinct(F.transform(numbered, lambda a: a["text"].try_cast("bigint"))))
    return {**{f"{kind}_page": target(kind) for kind in C.NAV_TEXT}, "page_numbers": numbers}


def nav_links(pages: DataFrame) -> DataFrame:
    """Navigation targets; a missing or zero last page falls back to the largest number."""
    linked = pages.select("page_id", text_links(F.col("html")).alias("links"))
    staged = linked.select("page_id", *[c.alias(n) for n, c in nav_columns(F.col("links")).items()])
    fallback = (F.size("page_numbers") > 0) & (F.coalesce("last_page", F.lit(0)) == 0)
    return staged.select(
        "page_id",
        "next_page",
        F.when(fallback, F.array_max("page_numbers")).otherwise(F.col("last_page")).alias("last_page"),
        "first_page",
        "prev_page",
        "page_numbers",
        F.col("next_page").isNotNull().alias("has_next"),
        F.col("prev_page").isNotNull().alias("has_prev"),
        (fallback | F.col("last_page").isNotNull()).alias("has_last"),
        F.col("first_page").isNotNull().alias("has_first"),
    )


def page_range(current: Column, last: Column, max_pages: Column, clip: bool = False) -> Column:
    """Pages to visit. Without ``clip`` a start past the end still yields itself."""
    start = F.greatest(current, F.lit(0))
    end = F.greatest(F.least(current + max_pages - 1, last), start)
    pages = F.when(last.isNull() | (last < 0), F.array(start)).otherwise(F.sequence(start, end))
    if clip:
        return F.filter(pages, lambda p: last.isNull() | (last < 0) | (p <= last))
    return pages


def page_ranges(states: DataFrame, clip: bool = False) -> DataFrame:
    """One row per page to visit for each (current_page, last_page, max_pages)."""
    pages = page_range(
        F.col("current_page").cast("bigint"),
        F.col("last_page").cast("bigint"),
        F.col("max_pages").cast("bigint"),
        clip,
    )
    return states.select("state_id", F.explode(pages).alias("page_idx"))


def _current_page() -> Column:
    return F.coalesce(F.col("context.page_idx"), F.lit(0)).cast("bigint")


def _within_limits(pages: DataFrame, limits: DataFrame) -> DataFrame:
    """Pages that any crawl may go on from; the content of others is not read."""
    return pages.where(_current_page() + 1 < largest_limits(limits)[0])


def next_pages_form(pages: DataFrame, limits: DataFrame) -> DataFrame:
    """Next list URLs of the form route, per list page of a crawl in page order.

    Pages done so far are ``page_idx + 1``. With a total the remaining range is
    planned, otherwise the "next" link is followed. A page captured again plans once.
    """
    req_id = request_of(pages)
    read = _within_limits(pages, limits).select(
        crawl_of(req_id).alias("crawl"),
        "url",
        "page_id",
        req_id.alias("req_id"),
        F.col("context.cnpj").alias("cnpj"),
        _current_page().alias("cur"),
        total_of(F.col("html")).alias("total"),
        text_links(F.col("html")).alias("links"),
    )
    read = read.withColumn("next_page", nav_columns(F.col("links"))["next_page"]).drop("links")
    limited = with_limits(first_captures(read), limits).withColumn("lim", F.col("max_pages").cast("bigint"))
    after = F.col("cur") + 1
    planned = F.transform(
        page_range(after, last_page_of(F.col("total")).cast("bigint"), F.col("lim") - after),
        lambda p: F.struct(p.alias("page_idx"), page_url(F.col("url"), p).alias("next_url")),
    )
    followed = F.array(
        F.struct(
            after.alias("page_idx"),
            url_join(F.col("url"), F.concat(F.lit("?page="), F.col("next_page").cast("string"))).alias("next_url"),
        )
    )
    nexts = F.when(F.col("total").isNotNull(), planned).when(F.col("next_page").isNotNull(), followed)
    return (
        limited.where(after < F.col("lim"))
        .select("page_id", "crawl", "cnpj", F.explode(nexts).alias("n"))
        .select("page_id", "crawl", "cnpj", "n.page_idx", "n.next_url")
    )


def next_pages_stable(pages: DataFrame, limits: DataFrame, route: str) -> DataFrame:
    """Next sequential URL below ``route``: on a next link, or freely on early pages."""
    texts = F.transform(
        M.anchors(M.block_of_class(M.markup(F.col("html")), "consulta_paginas")),
        lambda a: F.lower(strip(a["text"])),
    )
    says_next = F.exists(texts, lambda t: t.rlike("|".join(C.STABLE_NEXT_WORDS)))
    req_id = request_of(pages)
    read = _within_limits(pages, limits).select(
        crawl_of(req_id).alias("crawl"),
        "url",
        "page_id",
        req_id.alias("req_id"),
        F.col("context.cnpj").alias("cnpj"),
        _current_page().alias("cur"),
        F.when(_current_page() < C.STABLE_FREE_PAGES, True).otherwise(says_next).alias("goes_on"),
    )
    after = F.col("cur") + 1
    return (
        with_limits(first_captures(read), limits)
        .where(F.col("goes_on") & (after < F.col("max_pages")))
        .select(
            "page_id",
            "crawl",
            "cnpj",
            after.alias("page_idx"),
            F.concat(F.lit(route.rstrip("/") + "/"), F.col("cnpj"), F.lit("/"), after.cast("string")).alias("next_url"),
        )
    )
