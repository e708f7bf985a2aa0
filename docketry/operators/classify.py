"""Page signals and the detail / list / error cascade. Map-only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry import constants as C
from docketry.functions.text import any_of, let, rx, strip


def _present(html: Column) -> Column:
    return F.coalesce(html, F.lit("")) != ""


def _is_detail(upper: Column, html: Column) -> Column:
    classic = (
        upper.rlike(rx(C.CASE_HEADER))
        & F.contains(upper, F.lit("RELATOR"))
        & upper.rlike(any_of(C.PARTY_WORDS))
        & upper.rlike(any_of(C.TIMELINE_WORDS))
    )
    # nearly every detail page names a judge: look for that word before the others
    wide = html.rlike(C.NPU) & (
        F.contains(upper, F.lit(C.JUDGE_WORDS[0]))
        | upper.rlike(any_of(C.JUDGE_WORDS[1:] + C.PARTY_WORDS_WIDE + C.TIMELINE_WORDS))
    )
    return wide | classic


def _complete(upper: Column, tag: str) -> Column:
    """An end tag somewhere behind the first start tag. Found by position: a pattern would try every start tag."""

    def closed(rest: Column) -> Column:
        behind = F.substr(rest, F.instr(rest, ">") + 1)
        return F.contains(rest, F.lit(">")) & F.contains(behind, F.lit(f"</{tag}>"))

    start = F.locate(f"<{tag}", upper)
    return F.when(start > 0, let(F.substr(upper, start), closed)).otherwise(False)


def _is_list(upper: Column, html: Column) -> Column:
    complete = [_complete(upper, tag) for tag in C.TABLE_TAGS]
    return upper.rlike(any_of([C.TOTAL_MARK] + C.PAGER_WORDS)) | (
        html.rlike(rf"(?s){C.NPU}.*?{C.NPU}") & reduce(Column.__or__, complete)
    )


def _error_marks(upper: Column) -> Column:
    return (
        upper.rlike(any_of(C.ERROR_WORDS))
        | (F.length(strip(upper)) < C.MIN_PAGE_CHARS)
        | ~F.contains(upper, F.lit("<HTML"))
        | ~F.contains(upper, F.lit("<BODY"))
    )


def is_detail(html: Column) -> Column:
    return _present(html) & let(F.upper(html), lambda u: _is_detail(u, html))


def is_list(html: Column) -> Column:
    return _present(html) & let(F.upper(html), lambda u: _is_list(u, html))


def is_error(html: Column) -> Column:
    """Error on its own marks, or an HTML page that is neither detail nor list."""

    def marks(u: Column) -> Column:
        return _error_marks(u) | (
            ~_is_detail(u, html) & ~_is_list(u, html) & F.contains(u, F.lit("<HTML"))
        )

    return ~_present(html) | let(F.upper(html), marks)


def page_class(html: Column) -> Column:
    """detail / list / error.

    A page that is neither detail nor list is an error whether or not it has an
    ``<html`` tag, so the error marks need no evaluation here.
    """
    return let(
        F.upper(html),
        lambda u: F.when(~_present(html), "error")
        .when(_is_detail(u, html), "detail")
        .when(_is_list(u, html), "list")
        .otherwise("error"),
    )


def page_tipo(html: Column) -> Column:
    """The class under its stored label."""
    return let(
        page_class(html),
        lambda cls: F.when(cls == "detail", "detalhe").when(cls == "list", "lista").otherwise("erro"),
    )


def page_signals(pages: DataFrame) -> DataFrame:
    """One boolean per signal, plus the three rules."""
    staged = pages.select(
        "page_id",
        F.coalesce("html", F.lit("")).alias("html"),
        F.upper(F.coalesce("html", F.lit(""))).alias("u"),
    )
    u, html = F.col("u"), F.col("html")
    named = {"sig_case_header": u.rlike(rx(C.CASE_HEADER)), "sig_npu": html.rlike(C.NPU)}
    for prefix, patterns in (
        ("sig_judge", C.JUDGE_WORDS),
        ("sig_party", C.PARTY_WORDS_WIDE),
        ("sig_timeline", C.TIMELINE_WORDS),
        ("sig_total", [C.TOTAL_MARK]),
        ("sig_pager", C.PAGER_WORDS),
        ("sig_error", C.ERROR_WORDS),
    ):
        for i, pattern in enumerate(patterns, 1):
            named[f"{prefix}_{i}"] = u.rlike(rx(pattern))
    named |= {f"sig_table_{i}": _complete(u, tag) for i, tag in enumerate(C.TABLE_TAGS, 1)}
    named["sig_many_npu"] = html.rlike(rf"(?s){C.NPU}.*?{C.NPU}")
    named["sig_html_tag"] = F.contains(u, F.lit("<HTML"))
    named["sig_body_tag"] = F.contains(u, F.lit("<BODY"))
    named["sig_short"] = F.length(strip(u)) < C.MIN_PAGE_CHARS
    return staged.select("page_id", *[c.alias(n) for n, c in named.items()])


def classify_pages(pages: DataFrame) -> DataFrame:
    return pages.withColumn("page_class", page_class(F.col("html")))


def stable_list_class(html: Column) -> Column:
    upper = F.upper(html)
    return (
        F.when(~_present(html) | F.contains(upper, F.lit(C.STABLE_INVALID)), "error")
        .when(
            F.contains(html, F.lit(C.STABLE_RESULTS))
            | html.rlike(rx(C.STABLE_TAX_ID_HEADER, "i")),
            "list",
        )
        .otherwise("error")
    )


def classify_stable_list(pages: DataFrame) -> DataFrame:
    return pages.withColumn("page_class", stable_list_class(F.col("html")))


def label_confusion(pages: DataFrame) -> DataFrame:
    """Stored label x computed class counts."""
    return (
        pages.select(
            F.coalesce("context.tipo", F.lit("undefined")).alias("stored"),
            page_class(F.col("html")).alias("computed"),
        )
        .groupBy("stored", "computed")
        .agg(F.count("*").alias("n"))
    )


def page_indicator_report(pages: DataFrame) -> DataFrame:
    """Per indicator, how many of the pages not classified as detail show it."""
    html, u = F.col("html"), F.col("u")

    def holds(words: list[str]) -> Column:
        return u.rlike("|".join(words))

    flags = {
        "npu": html.rlike(C.NPU),
        "processo_ref": F.contains(u, F.lit("PROCESSO")),
        "relator": F.contains(u, F.lit("RELATOR")),
        "desembargador": F.contains(u, F.lit("DESEMBARGADOR")),
        "envolvidos": holds(C.PARTY_INDICATORS),
        "movimentacao": holds(C.TIMELINE_INDICATORS),
        "data_formato": html.rlike(C.DATE_ANYWHERE),
        "autuacao": F.contains(u, F.lit("AUTUADO")),
    }
    counts = (
        pages.where(page_class(html) != "detail")
        .select(F.coalesce("html", F.lit("")).alias("html"), F.upper(F.coalesce("html", F.lit(""))).alias("u"))
        .agg(F.count("*").alias("pages"), *[F.count_if(c).alias(n) for n, c in flags.items()])
    )
    return counts.unpivot("pages", list(flags), "indicator", "hits")
