"""Rows and cells of nested tables, as intervals of a page's table tags.

An element ends where the next tag of its nesting level starts, however many tables lie
between. ``nested_rows`` writes the level of each table, row and cell tag in front of it
as a letter, and patterns then find the element by that letter: some passes over the
page, and one more over its part for each level that a row or cell lies below.

A page of more levels than letters goes to ``with_deep_rows``. It is cut in front of every
table, row and cell tag; the pieces keep page order and each belongs to a level. Sorted by
(level, position) an element ends at the next one of its level; sorted back by position,
the cells inside of a row are a slice, and so are its own cells in the order of levels.
Levels and counts are running sums in chunks, so a page of n tags takes about n times the
root of n cheap steps, without a stack. The steps are columns of their
own, for as one expression they would take minutes to plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.markup import FIELDS
from docketry.functions.text import let

#: a table that starts inside of another one
NESTED = r"(?i)<table\b[^<>]*+>[^<]*+(?:<(?!/?table\b)[^<]*+)*+<table\b"
_TAG = r"</?(?:table|t[rdh])\b[^<>]*+>"
_CUT = rf"(?i)(?={_TAG})"
_HIDDEN = r"(?i)<(?:!--|script\b|style\b)"
_NAME = r"^<(/?[A-Za-z]++)"
_HEAD = r"^<[^<>]*+>"
_PART_END = r"(?i)</t(?:body|head|foot)\s*+>"
_KINDS = {"table": "T", "/table": "X", "tr": "R", "/tr": "r", "td": "C", "th": "H", "/td": "c", "/th": "c"}


def _kind(piece: Column) -> Column:
    """T table, X its end, R row, r its end, C cell, H header cell, c the end of either, P the text before."""
    name = F.lower(F.regexp_extract(piece, _NAME, 1))
    kinds = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    return F.coalesce(F.try_element_at(kinds, name), F.lit("P"))


def _onto(start: Column, items: Column) -> Column:
    """start, then the sums up to each item."""
    return F.aggregate(items, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0), lambda acc, x: acc + x)


def _in_chunks(a: Column) -> Column:
    """Chunks of about the root of the number of values: a lambda copies what it adds to."""
    size = F.ceil(F.sqrt(F.size(a))).cast("int")
    return F.transform(F.sequence(F.lit(0), F.size(a) - 1, size), lambda at: F.slice(a, at + 1, size))


def _leveled(kinds: Column, levels: Column, inside: bool) -> Column:
    """Tags sorted by level and place; the end of a table counts to its inside or to what follows it."""

    def of(kind: Column, i: Column) -> Column:
        level = F.get(levels, i)
        return F.struct(
            (level + F.when(kind == "X", 1).otherwise(0) if inside else level).alias("level"), i.alias("pos"), kind.alias("kind")
        )

    return F.array_sort(F.transform(kinds, of))


def _bodies(pieces: Column, after: Column, mark: str, kinds: tuple[str, ...]) -> Column:
    """Contents from each tag of these kinds up to the next one of its level, in the order of `after`, behind a first value."""

    def part(x: Column) -> Column:
        piece = F.get(pieces, x["pos"])
        return (
            F.when(x["kind"] == "X", F.regexp_replace(piece, _HEAD, ""))
            .when(x["kind"].isin(*kinds), F.concat(F.lit(mark), piece))
            .otherwise(piece)
        )

    return F.split(F.array_join(F.transform(after, part), ""), mark)


def _contents(after: Column, bodies: Column, kinds: tuple[str, ...], wanted: str) -> Column:
    """struct<pos, kind, raw> of the tags of one kind, in page order."""
    marked = F.filter(after, lambda x: x["kind"].isin(*kinds))
    placed = F.transform(
        marked, lambda x, i: F.struct(x["pos"].alias("pos"), x["kind"].alias("kind"), F.get(bodies, i + 1).alias("raw"))
    )
    return F.array_sort(F.filter(placed, lambda x: x["kind"] == wanted))


def _ends(inner: Column, n: Column, wanted: str) -> Column:
    """struct<pos, kind, level, at, till, end, next, then> of the tags of one kind, in page order: next tags of the level.

    at, till: places in the order of levels, of the tag and of the next one there.
    """

    def of(x: Column, i: Column) -> Column:
        def at(step: int) -> Column:
            y = F.get(inner, i + step)
            return F.when(y["level"] == x["level"], y)

        return F.struct(
            x["pos"].alias("pos"),
            x["kind"].alias("kind"),
            x["level"].alias("level"),
            x["at"].alias("at"),
            F.coalesce(F.get(inner, i + 1)["at"], n).alias("till"),
            F.coalesce(at(1)["pos"], n).alias("end"),
            at(1).alias("next"),
            at(2).alias("then"),
        )

    return F.array_sort(F.filter(F.transform(inner, of), lambda x: x["kind"] == wanted))


def may_nest(html: Column) -> Column:
    """Cheap test of the page as it came: nested, or with parts that ``markup`` takes out, so that it may be."""
    return F.coalesce(html.rlike(NESTED) | html.rlike(_HIDDEN), F.lit(False))


#: levels of a page that have a letter
LETTERS = 25
_TABLE_CUT = r"(?i)(?=</?table\b[^<>]*+>)"
# in a marked page \x01 and the letter of its level stand in front of each table, row and cell tag, and nowhere else
_TABLE_INSIDE = r"\x01(.)<table\b[^\x01]*+(?:\x01(?!\1</table\b)[^\x01]*+)*+(?:\x01.</table\b[^<>]*+>)?"
_TO_ROW_TAG = r"[^\x01]*+(?:\x01(?!\2</?t(?:r|able)\b)[^\x01]*+)*+"
_ROW = rf"(?i)(?=(\x01(.)<tr\b{_TO_ROW_TAG})AFTER)\x01.<tr\b"
_ROW_END = r"(\x01\2[^\x01]*+)?"
_SIBLING = rf"(?:\x01\2</tr\b{_TO_ROW_TAG})?(\x01\2<tr\b{_TO_ROW_TAG})?"
_CELL = r"(?i)\x01(.)<td\b[^\x01]*+(?:\x01(?!\1)[^\x01]*+)*+"
_SECOND_CELL = (
    r"(?i)\x01.<td\b[^\x01]*+(?:\x01(?!.<td\b)[^\x01]*+)*+"
    r"(\x01(.)<td\b[^\x01]*+(?:\x01(?!\2)[^\x01]*+)*+)"
)
# a '<' that starts no tag hides the text up to the next table, row or cell tag
_MARKED_TEXT = r"^(?:(?:\x01.)?<[^<>]*+>|<[^\x01]*+)*+([^<\x01]++)"


def _clean(mk: Column) -> Column:
    clean = F.replace(F.replace(mk, F.lit("\x01"), F.lit(" ")), F.lit("\x02"), F.lit(" "))
    return F.when(F.contains(mk, F.lit("\x01")) | F.contains(mk, F.lit("\x02")), clean).otherwise(mk)


def _marked(mk: Column) -> Column:
    """The page with the letters of its levels, the outermost one as A; NULL where they do not suffice."""

    def with_ends(parts: Column) -> Column:
        ends = F.transform(parts, lambda x, i: F.when(i == 0, "").when(x.startswith("</"), "X").otherwise("T"))
        return let(F.array_join(ends, ""), lambda e: with_levels(parts, e))

    def with_levels(parts: Column, ends: Column) -> Column:
        def level(_: Column, i: Column) -> Column:
            return F.length(F.replace(F.substring(ends, F.lit(1), i), F.lit("X"), F.lit(""))) * 2 - i

        return let(F.transform(parts, level), lambda levels: let(F.array_min(levels), lambda low: lettered(parts, levels, low)))

    def lettered(parts: Column, levels: Column, low: Column) -> Column:
        def mark(level: Column) -> Column:
            return F.concat(F.lit("\x01"), F.char(level - low + ord("A")))

        def part(x: Column, i: Column) -> Column:
            level = F.get(levels, i)
            marked = F.regexp_replace(x, F.lit(f"(?i){_TAG}"), F.concat(mark(level), F.lit("$0")))
            # the end of a table belongs to its inside
            return F.when(x.startswith("</"), F.concat(mark(level + 1), F.substr(marked, F.lit(3)))).otherwise(marked)

        return F.when(F.array_max(levels) - low < LETTERS, F.array_join(F.transform(parts, part), ""))

    return let(F.split(F.concat(F.lit(" "), _clean(mk)), _TABLE_CUT), with_ends)


def too_deep(mk: Column) -> Column:
    """Page of more levels than ``nested_rows`` knows."""
    return mk.isNotNull() & _marked(mk).isNull()


def may_be_deep(html: Column) -> Column:
    """Cheap test of the page as it came for ``too_deep``: many table tags, or a name of a tag that decoding may make one."""
    tags = F.size(F.regexp_extract_all(html, F.lit(r"(?i)</?table\b"), F.lit(0)))
    joined = r"(?i)<[/a-z]{0,6}+(?:&|<(?:!--|script\b|style\b))"
    return F.coalesce((tags >= LETTERS) | html.rlike(joined), F.lit(False))


def nested_rows(mk: Column, first_text: Callable[[Column], Column], wanted: tuple[str, ...] = FIELDS) -> Column:
    """Rows of a page whose tables are nested, as of ``with_deep_rows``; NULL for a page that is too deep.

    Fields that are not wanted are NULL.
    """

    def every(c: Column, pattern: str, group: int) -> Column:
        return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))

    def text(cell: Column) -> Column:
        return first_text(F.regexp_extract(cell, _MARKED_TEXT, 1))

    def content(cell: Column) -> Column:
        return F.regexp_replace(cell, rf"(?i)^\x01.<[^<>]*+>|{_TABLE_INSIDE}", "")

    def raw(row: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(row, f"(?i){_TABLE_INSIDE}", ""), r"\x01.", "")

    def cells(row: Column) -> Column:
        """Its own cells, with the tables inside."""
        return F.filter(every(row, _CELL, 0), lambda c: F.substring(c, 2, 1) == F.substring(row, 2, 1))

    def first_two(row: Column) -> Column:
        """The first two cells at any depth below."""
        found = F.array(F.regexp_extract(row, _CELL, 0), F.regexp_extract(row, _SECOND_CELL, 1))
        return F.filter(found, lambda c: c != "")

    def row(r: Column, own: Column, two: Column, end: Column, sibling: Column) -> Column:
        part_ends = end.rlike(_PART_END) | r.rlike(rf"{_PART_END}[^\x01]*+$")
        given = {
            "raw": raw(r),
            "last": F.lit(True),
            "cells": F.transform(own, content),
            "texts": F.transform(own, text),
            "pair": F.transform(two, text),
            "second": content(F.get(two, F.lit(1))),
            "below": F.when(~part_ends & (sibling != ""), raw(sibling)),
        }
        kinds = {"last": "boolean", "cells": "array<string>", "texts": "array<string>", "pair": "array<string>"}
        nothing = {n: F.lit(None).cast(kinds.get(n, "string")) for n in FIELDS}
        return F.struct(*[(given if n in wanted else nothing)[n].alias(n) for n in FIELDS])

    def with_ends(page: Column, ends: Column, siblings: Column) -> Column:
        def of(r: Column, i: Column) -> Column:
            return let(cells(r), lambda own: let(first_two(r), lambda two: row(r, own, two, F.get(ends, i), F.get(siblings, i))))

        return F.transform(every(page, _ROW.replace("AFTER", ""), 1), of)

    def rows(page: Column) -> Column:
        if "below" not in wanted:
            return with_ends(page, F.array(), F.array())
        following = (every(page, _ROW.replace("AFTER", x), 3) for x in (_ROW_END, _SIBLING))
        return let(next(following), lambda ends: let(next(following), lambda siblings: with_ends(page, ends, siblings)))

    return let(_marked(mk), rows)


def with_deep_rows(pages: DataFrame, first_text: Callable[[Column], Column]) -> DataFrame:
    """pages (with ``mk``, whose tables are nested) and ``rows``, in page order.

    array<struct<raw, last, cells, texts, pair, second, below>>. raw, cells: content of the
    row and of its own cells, without tables inside; texts: the first text below each own
    cell, those tables included; pair: the same of the first two cells at any depth below
    the row, and second the content of the latter; below: raw of the next row of the same
    table part.
    """
    given = pages.columns

    def stage(**values: Column) -> Callable[[str], Column]:
        """Computed once per page: a generator is not merged into the lambdas that use it."""
        nonlocal pages
        at = len(pages.columns)
        names = {n: f"_{n}{at}" for n in values}
        fields = F.struct(*[v.alias(names[n]) for n, v in values.items()])
        pages = pages.select("*", F.inline(F.array(fields)))
        return lambda name: F.col(names[name])

    pieces = stage(pieces=F.split(F.concat(F.lit(" "), _clean(F.col("mk"))), _CUT))("pieces")
    tags = stage(kinds=F.transform(pieces, _kind), texts=F.transform(pieces, first_text))
    kinds, found = tags("kinds"), tags("texts")
    steps = {
        "levels": F.transform(kinds, lambda k: F.when(k == "T", 1).when(k == "X", -1).otherwise(0)),
        "cells": F.transform(kinds, lambda k: F.when(k == "C", 1).otherwise(0)),
        "rows": F.transform(kinds, lambda k: F.when(k == "R", 1).otherwise(0)),
        "texts": F.transform(found, lambda t: F.when(t != "", 1).otherwise(0)),
    }
    with_text = F.filter(F.transform(found, lambda t, i: F.when(t != "", i)), lambda i: i.isNotNull())
    listed = stage(places=with_text, **steps)

    def running(values: dict[str, Column]) -> Callable[[str], Column]:
        """Sums up to and including each value."""
        parts = stage(**{n: _in_chunks(v) for n, v in values.items()})
        starts = stage(**{n: _onto(F.lit(0), F.transform(parts(n), _sum)) for n in values})

        def sums(n: str) -> Column:
            chunk = lambda p, i: F.slice(_onto(F.get(starts(n), i), p), F.lit(2), F.size(p))
            return F.flatten(F.transform(parts(n), chunk))

        return stage(**{n: sums(n) for n in values})

    run = running({n: listed(n) for n in steps})
    order = stage(inner=_leveled(kinds, run("levels"), True), after=_leveled(kinds, run("levels"), False))
    after = order("after")
    placed = F.transform(order("inner"), lambda x, i: F.struct(x["level"], x["pos"], x["kind"], i.alias("at")))
    inner = stage(inner=placed)("inner")
    in_levels = stage(cells=F.transform(inner, lambda x: F.when(x["kind"] == "C", 1).otherwise(0)))
    before_in_level = running({"cells": in_levels("cells")})
    of_cells, of_rows = ("P", "T", "R", "r", "C", "H", "c"), ("P", "T", "R", "r")
    bodies = stage(
        cells=_bodies(pieces, after, "\x01", of_cells),
        rows=_bodies(pieces, after, "\x02", of_rows),
        row_tags=F.filter(inner, lambda x: x["kind"].isin("T", "X", "R", "r")),
    )
    tagged = stage(
        cell_ends=_ends(inner, F.size(pieces), "C"),
        cell_raws=_contents(after, bodies("cells"), of_cells, "C"),
        row_ends=_ends(bodies("row_tags"), F.size(pieces), "R"),
        row_raws=_contents(after, bodies("rows"), of_rows, "R"),
    )

    def cell(c: Column, body: Column) -> Column:
        place = F.get(listed("places"), F.coalesce(F.get(run("texts"), c["pos"] - 1), F.lit(0)))
        return F.struct(
            c["level"].alias("level"),
            c["pos"].alias("pos"),
            F.when(place < c["end"], F.get(found, place)).otherwise("").alias("text"),
            F.regexp_replace(body["raw"], _HEAD, "").alias("content"),
        )

    cells = stage(all=F.zip_with(tagged("cell_ends"), tagged("cell_raws"), cell))("all")
    level_cells = stage(cells=F.array_sort(cells))("cells")

    def raw_at(pos: Column) -> Column:
        return F.get(tagged("row_raws"), F.get(run("rows"), pos) - 1)["raw"]

    def row(r: Column) -> Column:
        part_ends = F.get(pieces, r["end"]).rlike(_PART_END) | F.get(pieces, r["end"] - 1).rlike(_PART_END)
        sibling = F.when(r["next"]["kind"] == "R", r["next"]["pos"]).when(
            (r["next"]["kind"] == "r") & (r["then"]["kind"] == "R"), r["then"]["pos"]
        )

        first = F.get(run("cells"), r["pos"])
        n_below = F.get(run("cells"), r["end"] - 1) - first
        two = F.slice(cells, first + 1, F.least(n_below, F.lit(2)))
        start = F.get(before_in_level("cells"), r["at"])
        near = F.slice(level_cells, start + 1, F.get(before_in_level("cells"), r["till"] - 1) - start)
        own = F.filter(near, lambda c: c["level"] == r["level"])
        return F.struct(
            raw_at(r["pos"]).alias("raw"),
            F.lit(True).alias("last"),
            F.transform(own, lambda c: c["content"]).alias("cells"),
            F.transform(own, lambda c: c["text"]).alias("texts"),
            F.transform(two, lambda c: c["text"]).alias("pair"),
            F.get(two, F.lit(1))["content"].alias("second"),
            F.when(~F.coalesce(part_ends, F.lit(False)), raw_at(sibling)).alias("below"),
        )

    done = stage(rows=F.transform(tagged("row_ends"), row))
    return pages.select(*given, done("rows").alias("rows"))
