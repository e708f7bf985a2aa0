"""Table rows, cells, text nodes, anchors and class lookups from raw HTML.

These are lexical scans with Java regex over one page at a time: they stay in
the JVM, keep document order in arrays and never shuffle. Element ends are not
tracked but for nested tables (``nesting``): text is taken up to the next tag, items up to the next item. A tag ends
at '>' and holds no '<', which keeps every scan linear in the page. Element
lookups expect ``markup(html)``, computed once per page by the caller.
"""

from __future__ import annotations

from functools import reduce
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketry import constants as C
from docketry.functions.text import first_group, let, strip

# possessive groups: linear time, and no recursion however long a page is
# a comment, script or style that is never closed hides the rest of the page
HIDDEN = (
    r"(?i)<(?:!--[^-]*+(?:-(?!->)[^-]*+)*+(?:-->)?"
    r"|(script|style)\b[^<>]*+>[^<]*+(?:<(?!/\1\s*+>)[^<]*+)*+(?:</\1\s*+>)?)"
)
_ROW = (
    r"(?i)<tr\b[^<>]*+>[^<]*+(?:<(?!/?tr\b|/table\b)[^<]*+)*+"
    r"(?:</tr\s*+>(?:\s*+</t(?:able|body|head|foot)\s*+>)?|</table\s*+>)?"
)
_LAST_ROW = r"(?i)</t(?:able|body|head|foot)\s*>$"
_CELL = r"(?i)<td\b[^<>]*+>([^<]*+(?:<(?!/?t[dhr]\b|/table\b)[^<]*+)*+)"
_FIRST_TEXT = r"^(?:<[^<>]*+>)*+([^<]++)"
#: fields of a row; who reads only some of them spares the others
FIELDS = ("raw", "last", "cells", "texts", "pair", "second", "below")
_ANCHOR = r"(?i)<a\s[^<>]*+>[^<]*+(?:<(?!/a\s*>|a\s)[^<]*+)*+"
_TAG_HEAD = r"^<[^<>]*+>"
# an element with its content, or a lone tag. Void elements have no content; a paragraph or item that is
# not closed ends where the next one starts, any other element at the end of the fragment
_CHILD = (
    r"(?i)<(p|li|t[dhr]|option)\b[^<>]*+>[^<]*+(?:<(?!/?\1\b)[^<]*+)*+(?:</\1\s*+>)?"
    r"|<(?!(?:br|hr|img|input|link|meta|wbr)\b)([a-z][a-z0-9]*)\b[^<>]*+>[^<]*+(?:<(?!/\2\s*+>)[^<]*+)*+(?:</\2\s*+>)?"
    r"|<[^<>]*+>"
)
# names that need no ';', unless a name or a parameter goes on behind them
_LEGACY = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
_ENTITY = (
    r"^(?:(?:#[0-9]++|#[xX][0-9a-fA-F]++|[A-Za-z][A-Za-z0-9]*+);|#[0-9]++|#[xX][0-9a-fA-F]++"
    rf"|(?:{'|'.join(_LEGACY)})(?![A-Za-z0-9=]))"
)

# references that stand for markup characters stay escaped until text is cut out
_ESCAPED = {"quot": '"', "apos": "'", "lt": "<", "gt": ">", "amp": "&"}


def _pairs(items) -> Column:
    """Map constant (folded by the optimizer)."""
    return F.str_to_map(
        F.lit("\x01".join(f"{k}\x02{v}" for k, v in items)), F.lit("\x01"), F.lit("\x02")
    )


def decode_references(page: Column) -> Column:
    """Character references -> characters, except those of markup characters.

    One pass over the '&' pieces of a page. Markup characters keep a named
    reference, so tags and attributes can still be cut; see ``unescape``.
    """
    # looked up in order: the accented letters come first
    by_point = sorted(name2codepoint.items(), key=lambda x: x[1])
    names = _pairs([(n, f"&{n};" if n in _ESCAPED else chr(p)) for n, p in by_point] + [(n, f"&{n.lower()};") for n in ("LT", "GT", "AMP", "QUOT")])
    kept = _pairs((str(ord(c)), f"&{n};") for n, c in _ESCAPED.items())

    def from_point(n: Column) -> Column:
        return F.coalesce(
            F.try_element_at(kept, n.cast("string")),
            F.when(
                n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF),
                F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"),
            ),
        )

    def char_of(ref: Column) -> Column:
        # more than six significant digits are no character
        hexadecimal = let(
            F.regexp_replace(ref, "^#[xX]0*+", ""), lambda h: F.when(F.length(h).between(1, 6), F.conv(h, 16, 10))
        )
        number = F.when(ref.startswith("#x") | ref.startswith("#X"), hexadecimal).otherwise(F.substr(ref, F.lit(2)))
        return F.when(
            ref.startswith("#"), let(number.try_cast("bigint"), from_point)
        ).otherwise(F.try_element_at(names, ref))

    def piece(p: Column, i: Column) -> Column:
        def decoded(ref: Column) -> Column:
            return let(
                char_of(F.rtrim(ref, F.lit(";"))),
                lambda x: F.when(x.isNotNull(), F.concat(x, F.substr(p, F.length(ref) + 1))).otherwise(
                    F.concat(F.lit("&"), p)
                ),
            )

        return F.when(i == 0, p).otherwise(let(F.regexp_extract(p, _ENTITY, 0), decoded))

    joined = F.array_join(F.transform(F.split(page, "&"), piece), "")
    return F.when(F.contains(page, F.lit("&")), joined).otherwise(page)


def markup(html: Column) -> Column:
    """HTML without comments, scripts and styles and with decoded references."""
    return let(F.regexp_replace(html, HIDDEN, ""), decode_references)


def unescape(c: Column) -> Column:
    """Text or attribute cut from ``markup`` -> plain characters."""

    def plain(text: Column) -> Column:
        chars = text
        for name, char in _ESCAPED.items():
            chars = F.replace(chars, F.lit(f"&{name};"), F.lit(char))
        # a replacement compares at each place, a look for one character does not
        return F.when(F.contains(text, F.lit("&")), chars).otherwise(text)

    return let(c, plain)


def first_text(c: Column) -> Column:
    """First text run below a fragment (whitespace counts as text)."""
    return unescape(F.regexp_extract(c, _FIRST_TEXT, 1))


def table_rows(mk: Column, wanted: tuple[str, ...] = FIELDS) -> Column:
    """array<struct<raw, last, cells, texts, pair, second, below>>: rows in page order.

    ``last`` = ends its table part. This is for pages without nested tables, where all
    follows from raw and cells; the fields behind ``cells`` are NULL, and those that no wanted
    one follows from. See ``nesting``.
    """
    none, of_cells = F.lit(None), {"cells", "texts", "pair", "second"}

    def row(r: Column) -> Column:
        cells = F.regexp_extract_all(r, F.lit(_CELL), F.lit(1))
        moves = not {"raw", "last", "below"}.isdisjoint(wanted)
        return F.struct(
            (r if moves else none.cast("string")).alias("raw"),
            (r.rlike(_LAST_ROW) if moves else none.cast("boolean")).alias("last"),
            (none.cast("array<string>") if of_cells.isdisjoint(wanted) else cells).alias("cells"),
            none.cast("array<string>").alias("texts"),
            none.cast("array<string>").alias("pair"),
            none.cast("string").alias("second"),
            none.cast("string").alias("below"),
        )

    return F.transform(F.regexp_extract_all(mk, F.lit(_ROW), F.lit(0)), row)


def cell_texts(row: Column) -> tuple[Column, Column, Column]:
    """Number of cells below a row, and the first texts of the first two."""
    first, second = (
        F.coalesce(F.get(row["pair"], F.lit(i)), first_text(F.get(row["cells"], F.lit(i)))) for i in (0, 1)
    )
    return F.coalesce(F.size(row["pair"]), F.size(row["cells"])), first, second


def second_cell(row: Column) -> Column:
    """Content of a row's second cell, NULL when that is a header cell or missing."""
    head_and_content = F.get(
        F.regexp_extract_all(row, F.lit(_CELL.replace("<td", "<t[dh]", 1)), F.lit(0)), F.lit(1)
    )
    return let(
        head_and_content, lambda x: F.when(x.rlike("(?i)^<td"), F.regexp_replace(x, _TAG_HEAD, ""))
    )


def text_nodes_with(mk: Column, *words: str) -> Column:
    """Text nodes holding one of the words."""
    pattern = r">([^<>]*?(?:" + "|".join(words) + r")[^<]*+)<"
    return _if_named(mk, words, F.transform(F.regexp_extract_all(mk, F.lit(pattern), F.lit(1)), unescape))


def tag_text(c: Column, tag: str) -> Column:
    """Text right after the first ``<tag>`` that is followed by text."""
    return unescape(F.regexp_extract(c, rf"(?i)<{tag}\b[^<>]*+>([^<]++)", 1))


def class_attr(*tokens: str) -> str:
    """Regex for a class attribute holding one of the tokens."""
    any_token = "(?:" + "|".join(tokens) + ")"
    return (
        rf"""\b(?i:class)\s*=\s*(?:"(?:[^"<>]*\s)?{any_token}(?:\s[^"<>]*)?\""""
        rf"""|'(?:[^'<>]*\s)?{any_token}(?:\s[^'<>]*)?'|{any_token}(?=[\s>]))"""
    )


def _if_named(c: Column, tokens: tuple[str, ...], found: Column) -> Column:
    """Skip the regex scan of a page that does not hold the class names at all."""
    named = reduce(Column.__or__, [F.contains(c, F.lit(t)) for t in tokens])
    return F.when(named, found).otherwise(F.array().cast("array<string>"))


def _direct_texts(contents: Column) -> Column:
    """Text nodes directly below elements, given the elements' contents."""
    nodes = F.transform(contents, lambda b: F.split(F.regexp_replace(b, _CHILD, "<"), "<"))
    return F.transform(F.filter(F.flatten(nodes), lambda t: t != ""), unescape)


def _plain(content: Column) -> Column:
    return F.regexp_replace(content, r"<[^<>]*+>", "")


def class_texts(c: Column, *tokens: str) -> Column:
    """Direct text nodes of the elements of the given classes."""
    pattern = (
        rf"<([a-zA-Z][a-zA-Z0-9]*)\b[^<>]*?{class_attr(*tokens)}[^<>]*+>"
        r"([^<]*+(?:(?!</\1\s*+>)<[^<]*+)*+)"
    )
    return _if_named(c, tokens, _direct_texts(F.regexp_extract_all(c, F.lit(pattern), F.lit(2))))


def class_blocks(c: Column, *tokens: str) -> Column:
    """For every element of the classes, the page from it to the next one."""
    head = rf"<[a-zA-Z][^<>]*?{class_attr(*tokens)}[^<>]*+>"
    body = rf"([^<]*+(?:(?!{head})<[^<]*+)*+)"
    return _if_named(c, tokens, F.regexp_extract_all(c, F.lit(head + body), F.lit(1)))


def own_texts(c: Column, tag: str, containing: str) -> Column:
    """Direct text nodes of the ``tag`` elements whose text holds a word."""
    blocks = F.regexp_extract_all(
        c, F.lit(rf"(?i)<{tag}\b[^<>]*+>([^<]*+(?:<(?!/?{tag}\b)[^<]*+)*+)"), F.lit(1)
    )
    hits = F.filter(blocks, lambda b: F.contains(_plain(b), F.lit(containing)))
    return _if_named(c, (containing,), _direct_texts(hits))


def text_of_next(c: Column, tag: str, containing: str) -> Column:
    """Leading text of the ``tag`` element that follows one whose text holds a word."""
    pair = F.lit(
        rf"(?i)<{tag}\b[^<>]*+>([^<]*+(?:<(?!/?{tag}\b)[^<]*+)*+)</{tag}\s*+>"
        rf"(?=\s*+<{tag}\b[^<>]*+>([^<]++))"
    )
    after = F.zip_with(
        F.regexp_extract_all(c, pair, F.lit(1)),
        F.regexp_extract_all(c, pair, F.lit(2)),
        lambda before, text: F.when(F.contains(_plain(before), F.lit(containing)), unescape(text)),
    )
    return _if_named(c, (containing,), F.filter(after, lambda t: t.isNotNull()))


def attribute(tag: Column, name: str) -> Column:
    """Attribute value of a start tag, '' when absent."""
    quoted = F.regexp_extract(
        tag, rf"""(?is)[\s"']{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", 1
    )
    return unescape(F.regexp_replace(quoted, r"""^["']|["']$""", ""))


def anchors(mk: Column, containing: str = "") -> Column:
    """array<struct<href, cls, text, npu>> of all anchors in document order.

    ``containing`` leaves out anchors without a word before their parts are read.
    """
    raw = F.regexp_extract_all(mk, F.lit(_ANCHOR), F.lit(0))
    if containing:
        raw = F.filter(raw, lambda a: F.contains(a, F.lit(containing)))

    def parse(a: Column) -> Column:
        tag = F.regexp_extract(a, _TAG_HEAD, 0)
        return F.struct(
            attribute(tag, "href").alias("href"),
            attribute(tag, "class").alias("cls"),
            first_text(F.regexp_replace(a, _TAG_HEAD, "")).alias("text"),
        )

    parsed = F.transform(raw, parse)
    return F.transform(
        parsed,
        lambda a: F.struct(
            a["href"].alias("href"),
            a["cls"].alias("cls"),
            a["text"].alias("text"),
            first_group(a["href"], C.NPU, group=0).alias("npu"),
        ),
    )


def has_class(cls: Column, token: str) -> Column:
    return F.array_contains(F.split(cls, r"\s+"), token)


def input_tags(mk: Column) -> Column:
    """array<struct<name, type, value>> of all inputs in document order."""
    tags = F.regexp_extract_all(mk, F.lit(r"(?i)<input\b[^<>]*+>"), F.lit(0))
    return F.transform(
        tags,
        lambda t: F.struct(
            strip(attribute(t, "name")).alias("name"),
            attribute(t, "type").alias("type"),
            attribute(t, "value").alias("value"),
        ),
    )


def block_of_class(c: Column, token: str) -> Column:
    """Content of the first element of a class, up to its first same-name end tag."""
    return F.regexp_extract(
        c, rf"<([a-zA-Z][a-zA-Z0-9]*)\b[^<>]*?{class_attr(token)}[^<>]*+>([^<]*+(?:(?!</\1\s*>)<[^<]*+)*+)", 2
    )


