"""Detail links to follow and how much of them has been captured.

A crawl is one request (``context.req_id``); a page fetched for no request is a
crawl of its own and shares no budget. Choice within a page uses arrays of that
page and never shuffles; only short link lists leave the page, never its content.
A page captured again counts once per crawl. A crawl may hold a third of all
pages, but every page with a link emits at least one, so no more pages decide
than the largest crawl may emit links. That rank limit comes from the limits
table and is applied before the shuffle (window group limit).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry import constants as C
from docketry.functions import markup as M
from docketry.functions.text import let, present
from docketry.functions.urls import url_join


def _has(c: Column, text: str) -> Column:
    return F.contains(c, F.lit(text))


def request_of(pages: DataFrame) -> Column:
    """The request a page was fetched for, NULL where none is known."""
    known = "req_id" in pages.schema["context"].dataType.names
    return (F.col("context.req_id") if known else F.lit(None)).cast("bigint")


def crawl_of(req_id: Column) -> Column:
    """Key of a page's crawl: its request, else the page itself."""
    return F.coalesce(
        F.concat(F.lit("r"), req_id.cast("string")), F.concat(F.lit("p"), F.col("page_id").cast("string"))
    )


def largest_limits(limits: DataFrame) -> tuple[int, int, int]:
    """Largest number of pages, details per page and details per crawl any request may have."""
    known = limits.agg(
        F.max("max_pages"),
        F.max("max_details_per_page"),
        F.max(F.col("max_pages").cast("bigint") * F.col("max_details_per_page")),
    ).first()
    default = (C.DEFAULT_MAX_PAGES, C.DEFAULT_MAX_DETAILS, C.DEFAULT_MAX_PAGES * C.DEFAULT_MAX_DETAILS)
    return tuple(max(d, k or 0) for d, k in zip(default, known))


def with_limits(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Add the limits of the crawl to rows with ``req_id``; one row per request is used."""
    known = limits.groupBy(F.col("req_id").alias("_req")).agg(
        F.max("max_pages").alias("_pages"), F.max("max_details_per_page").alias("_details")
    )
    return rows.join(known, F.col("req_id") == F.col("_req"), "left").select(
        *rows.columns,
        F.coalesce("_pages", F.lit(C.DEFAULT_MAX_PAGES)).alias("max_pages"),
        F.coalesce("_details", F.lit(C.DEFAULT_MAX_DETAILS)).alias("max_details_per_page"),
    )


def first_captures(rows: DataFrame) -> DataFrame:
    """One row per crawl and URL, the first captured (reduced on the map side)."""
    values = [c for c in rows.columns if c not in ("crawl", "url")]
    first = F.min_by(F.struct(*values), "page_id").alias("first")
    return rows.groupBy("crawl", "url").agg(first).select("crawl", "url", "first.*")


def best_link(links: Column, target: Column) -> Column:
    """Best detail link struct(href, score) of a page for a target case number.

    The first exact link in (tier, position) order wins outright; otherwise the
    highest score, first in the same order on ties. Score must be positive.
    """

    def scored(a: Column, i: Column) -> Column:
        h = a["href"]
        no_movements = ~_has(h, "/movimentacao/")
        tier = (
            F.when(M.has_class(a["cls"], "linkar") & h.startswith("/processo/") & no_movements, 1)
            .when(h.startswith("/cp/processo/") & no_movements, 2)
            .when(_has(h, "/processo/") & no_movements & ~_has(h, "/movimento/"), 3)
            .when(_has(h, "processo") & ~_has(h, "movimentacao") & ~_has(h, "movimento"), 4)
        )
        exact = F.coalesce(F.contains(h, target), F.lit(False))
        detail_path = _has(h, "/processo/") & ~(
            _has(h, "/movimentacao/") | _has(h, "/movimento/") | _has(h, "/lista")
        )
        score = (
            F.when(exact, C.SCORE_EXACT).otherwise(0)
            + F.when(a["npu"].isNotNull(), C.SCORE_NPU).otherwise(0)
            + F.when(detail_path, C.SCORE_DETAIL_PATH).otherwise(0)
            + F.when(~_has(h, "?") & ~_has(h, "&"), C.SCORE_NO_QUERY).otherwise(0)
        )
        usable = (h != "") & (h != "/") & ~h.startswith("#") & ~h.startswith("javascript:")
        return F.struct(
            (-F.when(exact, C.SCORE_EXACT).otherwise(score)).alias("rank"),
            F.when(usable, tier).alias("tier"),
            i.alias("pos"),
            h.alias("href"),
            score.alias("score"),
        )

    candidates = F.filter(
        F.transform(links, scored), lambda s: s["tier"].isNotNull() & (s["score"] > 0)
    )
    return F.array_min(candidates)


def best_detail_link(pages: DataFrame) -> DataFrame:
    """Per list page with a target number: the link to follow, resolved."""
    best = best_link(M.anchors(M.markup(F.col("html")), "processo"), F.col("context.numero"))
    return pages.select(
        "page_id", "url", F.col("context.numero").alias("numero"), present(best).alias("b")
    ).select(
        "page_id",
        "numero",
        F.col("b.href").alias("href"),
        F.col("b.score").alias("score"),
        url_join(F.col("url"), F.col("b.href")).alias("detail_url"),
    )


def _requests(pages: DataFrame, links: Column, limits: DataFrame, plain_host: str | None = None) -> DataFrame:
    """Page cap by slicing the page's links, crawl cap by rank in page order."""
    _, most_details, most_links = largest_limits(limits)
    usable = F.transform(
        F.slice(F.filter(links, lambda a: a["href"] != ""), F.lit(1), F.lit(most_details)),
        lambda a: F.struct(a["href"].alias("href"), a["npu"].alias("npu")),
    )
    req_id = request_of(pages)
    listed = pages.select(
        crawl_of(req_id).alias("crawl"),
        "url",
        "page_id",
        req_id.alias("req_id"),
        F.col("context.cnpj").alias("cnpj"),
        F.coalesce(F.col("context.page_idx"), F.lit(0)).alias("page_idx"),
        present(usable, lambda x: F.size(x) > 0).alias("links"),
    )
    page_order = Window.partitionBy("crawl").orderBy("page_idx", "page_id")
    deciding = first_captures(listed).withColumn("nth", F.row_number().over(page_order)).where(
        F.col("nth") <= most_links
    )
    flat = with_limits(deciding.drop("nth"), limits).select(
        "crawl",
        "page_id",
        "url",
        "req_id",
        "cnpj",
        "page_idx",
        (F.col("max_pages") * F.col("max_details_per_page")).alias("crawl_cap"),
        F.posexplode(F.slice("links", F.lit(1), F.col("max_details_per_page"))).alias("pos", "a"),
    )
    link_order = Window.partitionBy("crawl").orderBy("page_idx", "page_id", "pos")
    joined = url_join(F.col("url"), F.col("a.href"))
    if plain_host:
        joined = let(
            joined,
            lambda u: F.when(
                u.startswith(plain_host), F.replace(u, F.lit("http://"), F.lit("https://"))
            ).otherwise(u),
        )
    return (
        flat.withColumn("rn", F.row_number().over(link_order))
        .where(F.col("rn") <= F.col("crawl_cap"))
        .select(
            "page_id",
            "crawl",
            "req_id",
            "cnpj",
            "page_idx",
            "pos",
            F.col("a.npu").alias("numero"),
            joined.alias("detail_url"),
        )
    )


def frontier_form(pages: DataFrame, limits: DataFrame) -> DataFrame:
    """Detail requests of form-route list pages, with page and crawl caps."""
    links = F.filter(M.anchors(M.markup(F.col("html")), "processo"), lambda a: _has(a["href"], "processo"))
    return _requests(pages, links, limits)


def frontier_stable(pages: DataFrame, limits: DataFrame, plain_host: str | None = None) -> DataFrame:
    """Detail requests of stable-route list pages: first link tier that has any link.

    ``plain_host`` (``http://host``) names the site whose links are forced to https.
    """

    def first_tier(links: Column) -> Column:
        tiers = [
            F.filter(
                links, lambda a: M.has_class(a["cls"], "linkar") & a["href"].startswith("/processo/")
            ),
            F.filter(links, lambda a: _has(a["href"], "/processo/")),
            F.filter(links, lambda a: _has(a["href"], "processo")),
        ]
        return F.coalesce(*[let(t, lambda x: F.when(F.size(x) > 0, x)) for t in tiers])

    links = let(M.anchors(M.markup(F.col("html")), "processo"), first_tier)
    return _requests(pages, links, limits, plain_host)


def frontier_coverage(links: DataFrame, captured: DataFrame) -> DataFrame:
    """Per crawl: distinct cases discovered, captured and still missing.

    Both sides are reduced to distinct numbers first, so repeated links or
    captures of one case cost one row each in the join.
    """
    wanted = links.where(F.col("numero").isNotNull()).select("crawl", "cnpj", "numero").distinct()
    done = captured.select(F.col("numero").alias("_done")).distinct()
    return (
        wanted.join(done, F.col("numero") == F.col("_done"), "left")
        .groupBy("crawl", "cnpj")
        .agg(
            F.count("*").alias("discovered"),
            F.count("_done").alias("fetched"),
            F.count_if(F.col("_done").isNull()).alias("missing"),
        )
    )


def missing_details(links: DataFrame, captured: DataFrame) -> DataFrame:
    """Cases with a discovered link and no capture."""
    wanted = links.where(F.col("numero").isNotNull()).select("crawl", "cnpj", "numero").distinct()
    return wanted.join(captured.select("numero").distinct(), "numero", "left_anti")


def done_details(links: DataFrame, captured: DataFrame) -> DataFrame:
    wanted = links.where(F.col("numero").isNotNull()).select("crawl", "cnpj", "numero").distinct()
    return wanted.join(captured.select("numero"), "numero", "left_semi")
