"""Case records from detail pages. Map-only over pages.

Profiles: ``online`` reads everything; ``offline`` is the reduced re-extraction
(no legacy number, no movement anchors, parties unfiltered).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry import constants as C
from docketry.functions import markup as M
from docketry.functions.nesting import FIELDS, NESTED, may_be_deep, may_nest, nested_rows, too_deep, with_deep_rows
from docketry.functions.text import (
    WS,
    br_date_to_iso,
    clean_text,
    first_group,
    let,
    non_empty,
    present,
    rx,
    strip_judge_title,
)


#: fields of table rows that judge and parties read, and movements
PARTY_FIELDS = ("pair", "second")
MOVEMENT_FIELDS = ("raw", "last", "below")


def _first(values: Column) -> Column:
    return F.get(values, F.lit(0))


# ------------------------------------------------------------------ single fields
# ``html`` is the raw page, ``mk`` its markup without comments and scripts, ``rows``
# its table rows; callers stage the last two as columns.
def numero(html: Column, mk: Column, profile: str = "online") -> Column:
    """First case number of the raw page, else of decoded labelled text."""

    def in_texts(texts: Column) -> Column:
        return first_group(_first(F.filter(texts, lambda t: t.rlike(C.NPU))), C.NPU, group=0)

    labelled = F.filter(
        M.text_nodes_with(mk, "PROCESSO", "Processo:"),
        lambda t: F.contains(t, F.lit("Nº")) | F.contains(t, F.lit("Processo:")),
    )
    hidden = [in_texts(labelled)]
    if profile == "online":
        hidden += [in_texts(M.class_texts(mk, name)) for name in C.NUMBER_CLASSES]
    return F.coalesce(
        first_group(html, C.NPU, group=0),
        # only character references can hide a number from the raw scan
        F.when(F.contains(html, F.lit("&")), F.coalesce(*hidden)),
    )


def legado(html: Column, profile: str = "online") -> Column:
    if profile == "offline":
        return F.lit(None).cast("string")
    return first_group(html, C.LEGACY_NUMBER)


def data_autuacao(html: Column, mk: Column, profile: str = "online") -> Column:
    def first_date(texts: Column) -> Column:
        dated = _first(F.filter(texts, lambda t: t.rlike(C.DATE_ANYWHERE)))
        return first_group(dated, C.DATE_ANYWHERE, group=0)

    marked = first_date(M.text_nodes_with(mk, *C.FILED_ON_NODE_MARKS))
    if profile == "offline":
        return br_date_to_iso(marked)
    by_class = [first_date(M.class_texts(mk, name)) for name in C.FILED_ON_CLASSES]
    return br_date_to_iso(F.coalesce(first_group(html, C.FILED_ON, "i"), marked, *by_class))


# -------------------------------------------------------------------------- judge
def _judge_from_rows(rows: Column) -> Column:
    def named(r: Column) -> Column:
        cell = F.coalesce(r["second"], F.get(r["cells"], F.lit(1)))
        texts = [M.cell_texts(r)[2]] + [M.tag_text(cell, tag) for tag in C.JUDGE_CELL_TAGS]
        return F.coalesce(
            *[non_empty(F.regexp_replace(clean_text(t), rf"^{WS}*[:;]{WS}*", "")) for t in texts]
        )

    def labels(r: Column) -> Column:
        n, first, _ = M.cell_texts(r)
        # most rows lack the word in the whole cell
        whole = F.coalesce(F.get(r["pair"], F.lit(0)), F.get(r["cells"], F.lit(0)))
        named = F.contains(F.lower(whole), F.lit("relator"))
        return (n >= 2) & named & F.contains(F.lower(clean_text(first)), F.lit("relator"))

    names = F.transform(F.filter(rows, labels), named)
    return _first(F.filter(names, lambda n: n.isNotNull()))


def _judge_from_elements(mk: Column) -> Column:
    labelled = rx(C.JUDGE_LABEL, "i")
    after_label = M.text_of_next(mk, "div", "RELATOR")
    sources = (
        [M.class_texts(mk, name) for name in C.JUDGE_CLASSES_FIRST]
        + [after_label]
        + [M.own_texts(mk, "span", "RELATOR"), M.own_texts(mk, "p", "RELATOR")]
        + [M.class_texts(mk, name) for name in C.JUDGE_CLASSES_LAST]
    )

    def is_labelled(t: Column) -> Column:
        return F.contains(F.lower(t), F.lit("relator"))

    def named(texts: Column) -> Column:
        """First usable text: a label needs a name after it, other text is the name."""
        usable = F.filter(
            F.transform(texts, clean_text),
            lambda t: (t != "") & (~is_labelled(t) | t.rlike(labelled)),
        )
        return let(
            _first(usable),
            lambda t: F.when(is_labelled(t), F.regexp_extract(t, labelled, 1)).otherwise(t),
        )

    return F.coalesce(*[named(texts) for texts in sources])


def _judge_from_text(html: Column) -> Column:
    def long_match(pattern: str) -> Column:
        found = F.transform(
            F.regexp_extract_all(html, F.lit(rx(pattern, "i")), F.lit(1)), clean_text
        )
        return _first(F.filter(found, lambda t: F.length(t) > 3))

    # the second pattern equals the first when case is ignored
    return F.coalesce(*[long_match(p) for p in C.JUDGE_TEXT[:1] + C.JUDGE_TEXT[2:]])


def relator(html: Column, mk: Column, rows: Column, profile: str = "online") -> Column:
    """Ordered strategies; a strategy whose stripped name is empty yields to the next."""
    strategies = [_judge_from_rows(rows)]
    if profile == "online":
        strategies.append(_judge_from_elements(mk))
    strategies.append(_judge_from_text(html))
    return F.coalesce(*[non_empty(strip_judge_title(s)) for s in strategies])


# ------------------------------------------------------------- parties, movements
def envolvidos(rows: Column, profile: str = "online") -> Column:
    def pair(r: Column) -> Column:
        role, name = (clean_text(t) for t in M.cell_texts(r)[1:])
        if profile == "online":
            name = F.regexp_replace(name, rf"^{WS}*:{WS}*", "")
        return F.struct(role.alias("papel"), name.alias("nome"))

    pairs = F.transform(F.filter(rows, lambda r: M.cell_texts(r)[0] >= 2), pair)

    def kept(p: Column) -> Column:
        filled = (p["papel"] != "") & (p["nome"] != "")
        if profile == "offline":
            return filled
        return filled & (p["papel"] != "RELATOR") & (F.length(F.trim(p["nome"])) > 1)

    return F.filter(pairs, kept)


def _dated(entries: Column) -> Column:
    iso = F.transform(
        entries, lambda m: F.struct(br_date_to_iso(m["data"]).alias("data"), m["texto"].alias("texto"))
    )
    return F.filter(iso, lambda m: m["data"].isNotNull())


def _anchored_movements(rows: Column) -> Column:
    anchor = r"""(?i)<a\b(?=[^<>]*[\s"']name\s*=\s*["']?(?-i:mov_))[^<>]*+>([^<]*+(?:<(?!/a)[^<]*+)*+)"""

    def of_row(r: Column, i: Column) -> Column:
        links = F.when(
            F.contains(r["raw"], F.lit("mov_")), F.regexp_extract_all(r["raw"], F.lit(anchor), F.lit(1))
        ).otherwise(F.array().cast("array<string>"))
        below = F.coalesce(r["below"], F.when(~r["last"], F.get(rows, i + 1)["raw"]))
        text = clean_text(M.first_text(M.second_cell(below)))
        text = clean_text(F.regexp_replace(text, C.RECEIPT_TAIL, ""))
        return F.transform(
            links,
            lambda a: F.struct(
                first_group(clean_text(M.first_text(a)), C.MOVEMENT_DATE).alias("data"),
                text.alias("texto"),
            ),
        )

    found = F.flatten(F.transform(rows, of_row))
    return _dated(F.filter(found, lambda m: m["data"].isNotNull() & (F.length(m["texto"]) > 5)))


def _listed_movements(mk: Column) -> Column:
    sections = M.class_blocks(mk, *C.MOVEMENT_SECTIONS)
    items = F.flatten(F.transform(sections, lambda s: M.class_blocks(s, *C.MOVEMENT_ITEMS)))
    entries = F.transform(
        items,
        lambda x: F.struct(
            _first(M.class_texts(x, *C.MOVEMENT_DATE_CLASSES)).alias("data"),
            clean_text(_first(M.class_texts(x, *C.MOVEMENT_TEXT_CLASSES))).alias("texto"),
        ),
    )
    return _dated(F.filter(entries, lambda m: m["data"].isNotNull() & (m["texto"] != "")))


def movimentacoes(mk: Column, rows: Column, profile: str = "online") -> Column:
    listed = _listed_movements(mk)
    if profile == "offline":
        return listed
    # no anchor on the page means no anchored entries: skip that scan
    anchored = F.when(F.contains(mk, F.lit("mov_")), _anchored_movements(rows))
    return let(anchored, lambda got: F.when(F.size(got) > 0, got).otherwise(listed))


# ------------------------------------------------------------------- table operators
def page_cells(pages: DataFrame) -> DataFrame:
    """One row per table cell: page, row, cell position, raw content and first text.

    A cell counts to the row it stands in; the text is the first one below it, tables
    inside included, which raw leaves to their own rows.
    """
    return (
        _staged(pages, "cells", "texts").select("page_id", F.posexplode("rows").alias("row_idx", "r"))
        .select("page_id", "row_idx", "r.texts", F.posexplode("r.cells").alias("cell_idx", "raw"))
        .withColumn("text", clean_text(F.coalesce(F.get("texts", F.col("cell_idx")), M.first_text(F.col("raw")))))
        .drop("texts")
    )


def _parsed(pages: DataFrame) -> DataFrame:
    return pages.withColumn("mk", M.markup(F.col("html")))


def _nests(html: Column) -> Column:
    """Test of the page as it came that needs no decoding: nested, or so without its hidden parts.

    References may only matter where one stands in the name of a tag.
    """
    bare = F.regexp_replace(html, M.HIDDEN, "")
    return may_nest(html) & (html.rlike(NESTED) | bare.rlike(NESTED) | bare.rlike("(?i)<[/a-z]{0,6}&"))


def _staged(pages: DataFrame, *wanted: str, keep: Column | None = None) -> DataFrame:
    """Pages with markup and rows as columns, each computed once per page.

    A page is read once, whether its tables are nested or not; only one of more levels than
    there are letters takes a way of its own. ``wanted``: the fields of a row that are read,
    without them all. ``keep``: the pages that are read, without it all.
    """
    html, mk = F.col("html"), F.col("mk")
    nests = lambda m: F.coalesce(m.rlike(NESTED), F.lit(False)) & _nests(html)
    fields = wanted or FIELDS
    rows = F.when(nests(mk), nested_rows(mk, M.first_text, fields)).otherwise(M.table_rows(mk, fields))
    kept = F.lit(True) if keep is None else keep
    parsed = pages.where(kept).select("*", F.explode(F.array(M.markup(html))).alias("mk"))
    usual = parsed.select("*", F.inline(F.filter(F.array(F.struct(rows.alias("rows"))), lambda x: x["rows"].isNotNull() | mk.isNull())))
    # the cheap test goes first
    deep = pages.where(may_be_deep(html) & kept).select("*", present(M.markup(html), lambda m: nests(m) & too_deep(m)).alias("mk"))
    return usual.unionByName(with_deep_rows(deep, M.first_text))


def extract_numero(pages: DataFrame, profile: str = "online") -> DataFrame:
    found = numero(F.col("html"), F.col("mk"), profile)
    return _parsed(pages).select("page_id", found.alias("numero"))


def extract_legado(pages: DataFrame, profile: str = "online") -> DataFrame:
    return pages.select("page_id", legado(F.col("html"), profile).alias("numero_legado"))


def extract_data_autuacao(pages: DataFrame, profile: str = "online") -> DataFrame:
    filed = data_autuacao(F.col("html"), F.col("mk"), profile)
    return _parsed(pages).select("page_id", filed.alias("data_autuacao"))


def extract_relator(pages: DataFrame, profile: str = "online") -> DataFrame:
    judge = relator(F.col("html"), F.col("mk"), F.col("rows"), profile)
    return _staged(pages, *PARTY_FIELDS).select("page_id", judge.alias("relator"))


def extract_envolvidos(pages: DataFrame, profile: str = "online") -> DataFrame:
    """One row per party, ``pos`` in page order."""
    return (
        _staged(pages, *PARTY_FIELDS)
        .select("page_id", F.posexplode(envolvidos(F.col("rows"), profile)).alias("pos", "p"))
        .select("page_id", "pos", "p.papel", "p.nome")
    )


def extract_movimentacoes(pages: DataFrame, profile: str = "online") -> DataFrame:
    """One row per movement, ``pos`` in page order."""
    return (
        _staged(pages, *MOVEMENT_FIELDS)
        .select(
            "page_id",
            F.posexplode(movimentacoes(F.col("mk"), F.col("rows"), profile)).alias("pos", "m"),
        )
        .select("page_id", "pos", "m.data", "m.texto")
    )


def extract_processos(
    pages: DataFrame,
    profile: str = "online",
    scraped_at: str | None = None,
    rerun: bool = False,
    keep: Column | None = None,
) -> DataFrame:
    """Nested records, one per page (that passes ``keep``) that shows a case number, with ``seq`` = page_id.

    ``scraped_at`` is the write time of the run; without it the capture time is
    kept. Only re-extraction (``rerun``, always with the offline profile) sets
    ``reprocessed_*``.
    """
    html, mk, rows = F.col("html"), F.col("mk"), F.col("rows")
    again = rerun or profile == "offline"
    nothing = F.lit(None).cast("string")
    return (
        _staged(pages, *PARTY_FIELDS, *MOVEMENT_FIELDS, keep=keep)
        .select("*", present(numero(html, mk, profile)).alias("_id"))
        .select(
            F.col("page_id").alias("seq"),
            "_id",
            F.col("_id").alias("numero_processo"),
            legado(html, profile).alias("numero_legado"),
            data_autuacao(html, mk, profile).alias("data_autuacao"),
            relator(html, mk, rows, profile).alias("relator"),
            envolvidos(rows, profile).alias("envolvidos"),
            movimentacoes(mk, rows, profile).alias("movimentacoes"),
            F.col("url").alias("fonte_url"),
            (F.lit(scraped_at) if scraped_at else F.col("fetched_at")).alias("scraped_at"),
            (F.col("fetched_at") if again else nothing).alias("reprocessed_at"),
            (F.col("page_id").cast("string") if again else nothing).alias("reprocessed_from_doc"),
        )
    )


def form_fields(pages: DataFrame) -> DataFrame:
    """Submission fields of each form page: hidden inputs, then search type and value."""
    forced = [C.FORM_TYPE_FIELD, C.FORM_VALUE_FIELD]
    named = F.filter(
        M.input_tags(M.markup(F.col("html"))), lambda x: (x["type"] == "hidden") & (x["name"] != "")
    )
    names_from_end = F.reverse(F.transform(F.col("hidden"), lambda x: x["name"]))
    last_of_each = F.filter(
        F.col("hidden"),
        lambda x, i: (F.size("hidden") - F.array_position(names_from_end, x["name"]) == i)
        & ~x["name"].isin(forced),
    )
    mode = F.col("context.busca")
    search_type = F.when(mode == "numero", C.FORM_TYPE["numero"]).when(
        mode == "cnpj", C.FORM_TYPE["cnpj"]
    )
    value = F.when(mode == "numero", F.col("context.numero")).otherwise(F.col("context.cnpj"))
    entries = F.concat(
        F.transform(last_of_each, lambda x: F.struct(x["name"].alias("key"), x["value"].alias("value"))),
        F.array(
            F.struct(F.lit(forced[0]).alias("key"), search_type.alias("value")),
            F.struct(F.lit(forced[1]).alias("key"), value.alias("value")),
        ),
    )
    # a generator: as a column of its own it would be merged into each place that uses it
    return pages.select("*", F.explode(F.array(named)).alias("hidden")).select(
        "page_id", F.map_from_entries(entries).alias("fields")
    )


def inputs_by_keyword(pages: DataFrame, keywords: list[str]) -> DataFrame:
    """First input whose name contains a keyword, NULL when there is none."""
    low = [k.lower() for k in keywords]
    hits = F.filter(
        M.input_tags(M.markup(F.col("html"))),
        lambda x: F.exists(
            F.array(*[F.lit(k) for k in low]), lambda k: F.contains(F.lower(x["name"]), k)
        ),
    )
    return pages.select("page_id", F.get(hits, F.lit(0))["name"].alias("input_name"))


def page_links(pages: DataFrame) -> DataFrame:
    """All anchors: page, position, href, first text and case number in the href."""
    return pages.select(
        "page_id", F.posexplode(M.anchors(M.markup(F.col("html")))).alias("pos", "a")
    ).select("page_id", "pos", "a.href", clean_text(F.col("a.text")).alias("text"), "a.npu")


def date_normalize(dates: DataFrame) -> DataFrame:
    """Per batch: how many date texts parse to a date, to a date-time, or fail."""
    return (
        dates.withColumn("iso", br_date_to_iso(F.col("raw")))
        .groupBy("batch_id")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.length("iso") == 10).alias("n_date"),
            F.count_if(F.length("iso") > 10).alias("n_datetime"),
            F.count_if(F.col("iso").isNull()).alias("n_failed"),
            F.min("iso").alias("first_iso"),
            F.max("iso").alias("last_iso"),
        )
    )


def judge_directory(judges: DataFrame) -> DataFrame:
    """Raw judge texts grouped by stripped name, with the number of spellings.

    Two-step: count per spelling first, so a judge on a third of the cases is
    reduced on the map side and no distinct set is held.
    """
    spellings = judges.groupBy("raw").agg(F.count("*").alias("n"))
    return (
        spellings.withColumn("relator", strip_judge_title(F.col("raw")))
        .groupBy("relator")
        .agg(F.sum("n").alias("n_cases"), F.count("*").alias("n_spellings"))
    )
