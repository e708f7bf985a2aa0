"""Ranked lexical search: blocks of inverted lists, searched by summed accumulators and skipping.

The index has one row per block of documents: its vocabulary, and for each term the
documents of the block that hold it, with counts. Building it moves no row. A search
takes its items in packs of bounded size; each block is searched on its own:

* the lists of an item that are short in the block are summed term at a time into one
  accumulator, sorted by document, whose largest score bounds it;
* the accumulator then is one iterator beside the long lists, and windows of documents
  are visited document at a time: a window whose bounds cannot reach the k-th score is
  skipped, in the others only iterators that could lift a document over it propose
  candidates, and the rest is probed for these.

A few blocks are searched first; their k-th scores start the search of all others.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docketry.llm.blocks import per_block
from docketry.llm.common import small_batches, stored

#: A-Z to a-z; ASCII that is no letter or digit to a space. Other characters stay.
TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
PIECE = 4_000_000
WINDOW = 512


def pieces(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    flat, at = (text or "").encode().translate(TERMS), 0
    while at < len(flat):
        end = flat.find(b" ", at + PIECE)
        end = len(flat) if end < 0 else end
        yield flat[at:end].split()
        at = end


class Lists:
    """Inverted lists of a block under construction."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.sizes: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, text: str | None) -> None:
        doc, size, numbers = len(self.sizes), 0, self.numbers
        for words in pieces(text):
            size += len(words)
            for w in set(words).difference(numbers):
                numbers[w] = len(numbers)
            found = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
            self.waiting.append((found << 24) | doc)
            self.n_waiting += len(words)
            if self.n_waiting > 1_000_000:
                self.settle()
        self.sizes.append(size)

    def settle(self) -> None:
        if self.n_waiting:
            keys, counts = np.unique(np.concatenate(self.waiting), return_counts=True)
            self.keys.append(keys)
            self.counts.append(counts)
            self.waiting, self.n_waiting = [], 0

    def columns(self) -> list:
        """sizes, vocabulary in sorted order, lengths of its lists, and the lists: documents and counts."""
        self.settle()
        pack = zstandard.ZstdCompressor(level=1).compress
        words = sorted(self.numbers)
        if not words:
            return [self.sizes, b"", b"", b"", b""]
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        rank = np.empty(len(words), np.int64)
        rank[np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))] = np.arange(len(words))
        keys = (rank[keys >> 24] << 24) | (keys & 0xFFFFFF)
        order = np.argsort(keys, kind="stable")
        keys, first = np.unique(keys[order], return_index=True)
        counts = np.add.reduceat(counts[order], first)
        lengths = np.bincount(keys >> 24, minlength=len(words)).astype("<i4")
        docs, tf = (keys & 0xFFFFFF).astype("<i4"), counts.astype("<i8")
        gaps = np.diff(docs, prepend=np.int32(0))
        return [self.sizes, pack(b" ".join(words)), pack(lengths.tobytes()), pack(gaps.tobytes()), pack(tf.tobytes())]


def build_index(docs: DataFrame, text: str = "text", key: str = "doc_id", most: int = 8_000_000, most_rows: int = 65_536) -> DataFrame:
    """The inverted index of a table, written below spark.checkpoint.dir: a row per block of about `most` bytes of text.

    block, doc_ids, sizes (terms of each document), n_docs (documents with a term), n_terms,
    and compressed: vocabulary, lengths, gaps, counts. Every row of docs is indexed; a null
    text has no terms; a longer text is a block alone.
    """
    kind = docs.schema[key].dataType
    names = ["block", "doc_ids", "sizes", "n_docs", "n_terms", "vocabulary", "lengths", "gaps", "counts"]
    ids = to_arrow_type(kind)
    types = [pa.int64(), pa.list_(ids), pa.list_(pa.int64()), pa.int64(), pa.int64(), *[pa.binary()] * 4]
    schema = f"block long, doc_ids array<{kind.simpleString()}>, sizes array<long>, n_docs long, n_terms long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, keys, lists = TaskContext.get().partitionId() << 32, 0, [], Lists()

        def row() -> pa.RecordBatch:
            sizes, *rest = lists.columns()
            out = [number, keys, sizes, sum(n > 0 for n in sizes), sum(sizes), *rest]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(out, types, strict=True)], names=names)

        for batch in small_batches(batches, "__text", most):
            size = batch.column(1).nbytes
            if keys and (held + size > most or len(keys) + batch.num_rows > most_rows):
                yield row()
                number, held, keys, lists = number + 1, 0, [], Lists()
            held += size
            keys += batch.column(0).to_pylist()
            for t in batch.column(1):
                lists.add(t.as_py())
        if keys:
            yield row()

    narrow = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("__text"))
    return stored(narrow.mapInArrow(run, f"{schema}, vocabulary binary, lengths binary, gaps binary, counts binary"), "lexical-index")


def unpacked(payload: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), kind) if payload else np.empty(0, kind)


def places(vocabulary: bytes, asked: dict[bytes, int]) -> list[tuple[int, int]]:
    """(number of an asked term, its place in the vocabulary of a block)."""
    words = zstandard.ZstdDecompressor().decompress(vocabulary).split() if vocabulary else []
    return [(asked[w], i) for i, w in enumerate(words) if w in asked]


class Iter:
    """Documents in ascending order with scores; per window where it starts and its largest score."""

    def __init__(self, docs: np.ndarray, scores: np.ndarray, edges: np.ndarray) -> None:
        self.docs, self.scores = docs, scores
        self.cuts = np.searchsorted(docs, edges)
        self.most = np.zeros(len(edges) - 1, np.int64)
        full = np.flatnonzero(np.diff(self.cuts))
        if len(full):
            self.most[full] = np.maximum.reduceat(scores, self.cuts[full])

    def times(self, factor: int) -> Iter:
        new = object.__new__(Iter)
        new.docs, new.cuts, new.scores, new.most = self.docs, self.cuts, self.scores * factor, self.most * factor
        return new


def summed(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: one list of documents with the sums of their scores."""
    docs = np.concatenate([d for d, _ in lists])
    order = np.argsort(docs, kind="stable")
    docs, first = np.unique(docs[order], return_index=True)
    return docs, np.add.reduceat(np.concatenate([s for _, s in lists])[order], first)


def skipping(iters: list[Iter], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of at least the k-th best score, and of `least`, with their scores; equal scores stay."""
    bounds = np.array([i.most for i in iters])
    docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    for w in np.flatnonzero(bounds.sum(axis=0) >= least).tolist():
        here = bounds[:, w]
        if here.sum() < least:
            continue
        order = np.argsort(-here, kind="stable")
        after = np.append(np.cumsum(here[order][::-1])[::-1], 0)  # what the iterators from a place on can add
        total = np.zeros(WINDOW, np.int64)
        near = np.empty(0, np.int64)
        for at, n in enumerate(order.tolist()):
            it = iters[n]
            a, b = it.cuts[w], it.cuts[w + 1]
            if a == b:
                break
            if after[at] >= least:  # may still lift a document of its own: it proposes
                total[it.docs[a:b] - w * WINDOW] += it.scores[a:b]
                near = np.flatnonzero(total)
                near = near[total[near] + after[at + 1] >= least]
            else:  # probed for the candidates only
                near = near[total[near] + after[at] >= least]
                if not len(near):
                    break
                to = np.searchsorted(it.docs[a:b], near + w * WINDOW)
                hit = to < b - a
                hit[hit] = it.docs[a:b][to[hit]] == near[hit] + w * WINDOW
                total[near[hit]] += it.scores[a:b][to[hit]]
        near = near[total[near] >= least]
        if len(near):
            docs, scores = np.append(docs, near + w * WINDOW), np.append(scores, total[near])
            if len(scores) >= k:
                least = max(least, int(np.partition(scores, -k)[-k]))
                docs, scores = docs[scores >= least], scores[scores >= least]
    return docs, scores


def search_block(row: dict, asked: dict[bytes, int], items: list[Counter], weights: list[int], least: list[int], k: int, n_docs: int, n_terms: int, short: float):
    """(item number, document of the block, score) lists: the k best documents of a block for each item."""
    lengths = unpacked(row["lengths"].as_py(), "<i4")
    found = places(row["vocabulary"].as_py(), asked)
    if not found:
        return [], [], []
    starts = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    docs = np.cumsum(unpacked(row["gaps"].as_py(), "<i4"), dtype=np.int64)
    tf = unpacked(row["counts"].as_py(), "<i8")
    sizes, which = np.unique(np.array(row["sizes"].as_py(), np.int64), return_inverse=True)
    m = np.array([75 + 25 * int(n) * n_docs // n_terms for n in sizes], np.int64)[which]
    edges = np.arange(0, len(m) + WINDOW, WINDOW)
    lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for number, place in found:
        if weights[number]:
            a, b = starts[place], starts[place + 1]
            lists[number] = docs[a:b], weights[number] * (10**9 * tf[a:b] // (1000 * tf[a:b] + 12 * m[docs[a:b]]))
    long = {n: Iter(d, s, edges) for n, (d, s) in lists.items() if len(d) > short * len(m)}
    out: tuple[list, list, list] = ([], [], [])
    for number, item in enumerate(items):
        iters = [long[t].times(c) for t, c in item.items() if t in long]
        few = [(lists[t][0], lists[t][1] * c) for t, c in item.items() if t in lists and t not in long]
        if few:
            iters.append(Iter(*summed(few), edges))
        if iters:
            near, scores = skipping(iters, k, least[number])
            out[0].extend([number] * len(near))
            out[1].extend(near.tolist())
            out[2].extend(scores.tolist())
    return out


def packs(items: DataFrame, item: str, text: str, most: int) -> Iterator[list[tuple[object, str]]]:
    """Distinct (id, text) of the items with a text, in packs of about `most` bytes (or one longer item)."""
    rows = items.select(F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").alias("text")).where("text is not null").distinct()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = 1 if total <= most else 2 * -(-int(total) // most)
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for i in range(n):
        yield sorted(((r[0], r[1]) for r in rows.where(part == i).collect()), key=lambda r: (str(r[0]), r[1]))


def search(
    index: DataFrame, items: DataFrame, k: int = 20, item: str = "item_id", text: str = "text", short: float = 0.02, probe: int = 4, most: int = 4_000_000
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of the index for each item, equal scores by ascending doc_id.

    A term weighs floor(1000 ln((2N + 2) / (2 df + 1))); a document scores weight x
    (10^9 tf div (1000 tf + 12 m)), summed over the item's terms, repeats included, with
    m = 75 + 25 n N div L. Only scores above 0 count, so fewer than k rows are possible, and
    none for an item that is null or has no known term. Items of equal id and text are one
    question; an id with several texts is answered for each. Documents without an id rank
    behind those with one; repeated documents are documents. Items are searched in packs
    of about `most` bytes, of which the driver holds one, with the counts of its terms; a
    list is short up to the share `short` of a block's documents.
    """
    spark = index.sparkSession
    sums = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    n_docs, n_terms = int(sums[0]), int(sums[1])
    kind, ids = items.schema[item].dataType.simpleString(), index.schema["doc_ids"].dataType.elementType.simpleString()
    found = spark.createDataFrame([], f"item_id {kind}, ask long, doc_id {ids}, score long")
    best = Window.partitionBy("ask").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    first = [r[0] for r in index.select("block").orderBy(F.xxhash64("block")).limit(probe).collect()]
    base = 0
    for pack in packs(items, item, text, most):
        counted = [Counter(w for words in pieces(t) for w in words) for _, t in pack]
        asked = {w: i for i, w in enumerate(sorted(set().union(*counted)))}
        if not asked or not n_terms:
            continue
        names = spark.sparkContext.broadcast(asked)

        def frequencies(row, names=names):
            here = places(row["vocabulary"].as_py(), names.value)
            lengths = unpacked(row["lengths"].as_py(), "<i4")
            return [n for n, _ in here], [int(lengths[i]) for _, i in here]

        df = per_block(index.select("vocabulary", "lengths"), frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
        weights = [0] * len(asked)
        for term, n in df.select("term", F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).alias("w")).collect():
            weights[term] = int(n)
        number = [Counter({asked[w]: c for w, c in item.items()}) for item in counted]

        def top(blocks: DataFrame, least: list[int], base=base, pack=pack, names=names, weights=weights, number=number) -> DataFrame:
            shared = spark.sparkContext.broadcast(([i for i, _ in pack], number, weights, least))

            def run(row):
                item_ids, asks, w, low = shared.value
                at, near, scores = search_block(row, names.value, asks, w, low, k, n_docs, n_terms, short)
                keys = row["doc_ids"].as_py()
                return [item_ids[a] for a in at], [base + a for a in at], [keys[d] for d in near], scores

            rows = per_block(blocks, run, f"item_id {kind}, ask long, doc_id {ids}, score long")
            return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

        ahead = stored(top(index.where(F.col("block").isin(first)), [1] * len(pack)), "ranked-first")
        least = [1] * len(pack)
        for ask, score in ahead.where(F.col("rank") == k).select("ask", "score").collect():
            least[ask - base] = int(score)
        rest = top(index.where(~F.col("block").isin(first)), least)
        found = found.unionByName(ahead.drop("rank")).unionByName(rest.drop("rank"))
        base += len(pack)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, text: str = "text", key: str = "doc_id", **settings) -> DataFrame:
    """The k best documents of docs for each item, see `search`. Other columns are not read; an empty table gives no rows."""
    return search(build_index(docs, text, key), items, k, **settings)
