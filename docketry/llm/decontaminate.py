"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, one scan per text.

Texts and items are normalised alike (A-Z lowered, everything but a-z, 0-9 and
characters from U+0080 on is a separator). The automaton reads words, not letters: a word of the items is a code of
two symbols, so a window has two nodes per word, and a word that no item holds ends
every match. The places of hits are word numbers of the text, mapped to code points of
the original.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import map_batches, numbered, renamed, stored

#: UTF-8 bytes: letters lowered, digits and bytes of non-ASCII characters kept, others a space
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


UNKNOWN = "\0\0"


def code_of(number: int) -> str:
    """First and second symbol have ranges of their own, so a match starts at a word; no node has over 512 second symbols."""
    return chr(0x10000 + number // 512) + chr(1 + number % 512)


@dataclass
class Windows:
    """Automaton over the windows of items; its values are (number of words, numbers of the items in `names`)."""

    automaton: ahocorasick.Automaton
    codes: dict[bytes, str]
    names: list[str]


def automaton_of(items: list[tuple[str, str]], width: int) -> Windows | None:
    """None if no item has a word."""
    codes: dict[bytes, str] = {}
    names: dict[str, int] = {}
    automaton = ahocorasick.Automaton()
    for name, text in items:
        words = [codes.get(w) or codes.setdefault(w, code_of(len(codes))) for w in words_of(text)]
        for i in range(max(1, len(words) - width + 1) if words else 0):
            part = words[i : i + width]
            window = "".join(part)
            of = names.setdefault(name, len(names))
            known = automaton.get(window, None)
            if known is None:
                automaton.add_word(window, (len(part), (of,)))
            elif of not in known[1]:
                automaton.add_word(window, (len(part), (*known[1], of)))
    if not codes:
        return None
    automaton.make_automaton()
    return Windows(automaton, codes, list(names))


def scan(text: str | None, windows: Windows | None) -> tuple[int, np.ndarray, set[str]]:
    """Number of words, sorted numbers of the hit words, names of the items found."""
    words = words_of(text)
    if windows is None or not words:
        return len(words), np.empty(0, np.int64), set()
    coded = "".join([windows.codes.get(w, UNKNOWN) for w in words])
    change = np.zeros(len(words) + 1, np.int64)
    items: set[int] = set()
    for at, (n, found) in windows.automaton.iter(coded):
        end = at // 2
        change[end + 1] -= 1
        change[end + 1 - n] += 1
        items.update(found)
    return len(words), np.flatnonzero(np.cumsum(change[:-1]) > 0), {windows.names[i] for i in items}


def original_spans(text: str, hits: np.ndarray) -> list[tuple[int, int]]:
    """Code points (start, end) in the original text of the runs of hit words."""
    raw = np.frombuffer(text.encode(), np.uint8)
    inside = np.frombuffer(text.encode().translate(NORMAL), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    point = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    cut = np.flatnonzero(np.diff(hits) > 1) + 1
    return [(int(point[starts[run[0]]]), int(point[stops[run[-1]]])) for run in np.split(hits, cut) if len(run)]


def listed(text: str | None, hits: np.ndarray) -> str:
    return ",".join(f"{a}:{b}" for a, b in original_spans(text, hits)) if len(hits) else ""


def item_blocks(benchmark: DataFrame, item: str, text: str, most: int) -> tuple[int, Iterator[list[tuple[str, str]]]]:
    """Number of blocks and the items as (name, text) block by block; one block in the usual case.

    An automaton takes some 160 MB of a Python worker per MB of items.

    The benchmark is a stated query set. A block holds about `most` bytes of text (or one
    longer item), and the driver holds one block at a time.
    """
    items = benchmark.where(F.col(f"`{text}`").isNotNull())
    items = items.select(F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("null")).alias("name"), F.col(f"`{text}`").alias("item"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("item")), F.lit(0))).first()[0]
    n = 1 if total <= most else 2 * -(-int(total) // most)
    part = F.pmod(F.xxhash64("name", "item"), F.lit(n))
    return n, ([(r[0], r[1]) for r in items.where(part == i).collect()] for i in range(n))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    text: str = "text",
    key: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    most: int = 4_000_000,
) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_hit, n_items, item_ids, items_sha256, contaminated, spans.

    A window is `width` consecutive words of an item; an item of fewer words is one
    window. item_ids are the sorted names (ids as strings) of items with an occurring
    window, spans the hit code points "start:end" of the original text, comma-joined.
    Null and empty texts have no words; items without words are never found; an item
    without an id is named "null"; repeated items and rows count as they stand; other
    columns are not read. A benchmark above `most` bytes is scanned for in blocks, whose
    results are united per document; one more pass over the contaminated texts gives the
    spans of the united hits.
    """
    n_blocks, blocks = item_blocks(benchmark, item, item_text, most)
    context = docs.sparkSession.sparkContext

    def scanner(shared):
        def make(keys, marks, texts):
            if not held:
                held.append(automaton_of(shared.value, width))
            out = ([], [], [], [], [], [])
            for doc, mark, t in zip(keys, marks, texts, strict=True):
                n, hits, names = scan(t, held[0])
                for column, value in zip(out, (doc, mark, n, hits.tolist(), sorted(names), listed(t, hits)), strict=True):
                    column.append(value)
            return out

        held: list = []
        return make

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(f"`{key}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"), F.col(f"`{text}`").alias("text"))
    schema = f"doc_id {kind}, text_key long, n_words long, hits array<long>, item_ids array<string>, spans string"
    parts = []
    for items in blocks:
        shared = context.broadcast(items)
        part = map_batches(narrow, ["doc_id", "text_key", "text"], "text", scanner(shared), schema)
        if n_blocks > 1:
            part = stored(part, "contamination-block")
            shared.unpersist()
        parts.append(part)
    found = parts[0]
    if n_blocks > 1:
        every = parts[0].select("doc_id", "text_key", "n_words", "hits", "item_ids")
        rows = every.groupBy("doc_id", "text_key").count()
        for p in parts[1:]:
            every = every.unionByName(p.select("doc_id", "text_key", "n_words", "hits", "item_ids").where("size(item_ids) > 0"))
        every = every.groupBy("doc_id", "text_key").agg(
            F.max("n_words").alias("n_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("hits")))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"),
        )
        every = stored(every, "contamination-united")

        def spans_of(keys, marks, hits, texts):
            return keys, marks, [listed(t, np.array(h, np.int64)) for t, h in zip(texts, hits, strict=True)]

        hit = every.where("size(hits) > 0").select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "hits")
        again = narrow.join(hit, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")))
        spans = map_batches(again, ["doc_id", "text_key", "hits", "text"], "text", spans_of, f"d {kind}, t long, spans string")
        spans = spans.groupBy("d", "t").agg(F.max("spans").alias("spans"))  # repeated rows have equal spans
        every = every.join(spans, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left").drop("d", "t")
        every = every.withColumn("spans", F.coalesce("spans", F.lit("")))
        every = every.join(rows.withColumnsRenamed({"doc_id": "d", "text_key": "t"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")))
        found = every.select("*", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy"))
    return found.select(
        "doc_id",
        "text_key",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        "item_ids",
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        "spans",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", **settings) -> DataFrame:
    """Documents without a hit, columns as given. Equal rows share their verdict."""
    bad = contamination(docs, benchmark, text=text, key=key, **settings).where("contaminated").select("doc_id", "text_key").distinct()
    rows, (of_key, of_text) = numbered(docs, key, text)
    same = F.col(of_key).eqNullSafe(F.col("doc_id")) & (F.xxhash64(of_text) == F.col("text_key"))
    return renamed(rows.join(stored(bad, "contaminated"), same, "left_anti"), docs)
