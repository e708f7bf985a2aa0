"""Exact vector search over shards: integer vectors, shards of bounded size, waves of questions.

Distinct vectors are filed in cells of a partition fitted on a bounded sample; a cell
above the shard size is cut into pieces by hash, so a shard is bounded whatever the data
are like. Each shard holds a tree of its own. Questions travel in messages to those
shards that may hold an answer, in three waves: their home shard, an eighth of the
others, the rest. After each wave the k-th score of every question goes ahead to the
next one. A task streams each shard once, followed by its messages.

The partition, the trees and their bounds are the methods' (`kdtree`, `gnat`).
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.common import stored

KEYS = ["dim", "cell", "piece"]
NONE = -(2**62)  # below every score: no lower end
BLOCK = 1024  # questions of a message at most
LONG = 2**63 - 1


def to_bytes(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def from_bytes(payload: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(payload), allow_pickle=False) as z:
        return {k: z[k] for k in z.files}


def quantised(table: DataFrame, scale: int, key: str = "vec_id", vector: str = "embedding", label: str | None = None) -> DataFrame:
    """(vec_id, label, dim, v): components as floor(scale x), four bytes each.

    Left out: rows without an id, without a vector, or (where a label column is named)
    without a label, and vectors with a null or non-finite component or one that exceeds
    four bytes after scaling.
    """
    rows = table.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"),
        (F.col(f"`{label}`") if label else F.lit(0)).cast("int").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("x"),
    ).where("vec_id is not null and label is not null and x is not null")
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int32()), ("dim", pa.int32()), ("v", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values[offsets[0] : offsets[-1]] if len(batch) else lists.values
            offsets = offsets - (offsets[0] if len(offsets) else 0)
            x = np.floor(scale * flat.to_numpy(zero_copy_only=False).astype(np.float64))  # nulls become NaN
            with np.errstate(invalid="ignore"):
                bad = np.concatenate(([0], np.cumsum(~(np.abs(x) < 2**31))))
                raw = np.where(np.abs(x) < 2**31, x, 0).astype("<i4").tobytes()
            good = np.flatnonzero(bad[offsets[1:]] == bad[offsets[:-1]])
            v = [raw[4 * offsets[i] : 4 * offsets[i + 1]] for i in good.tolist()]
            dims = np.diff(offsets)[good].astype(np.int32)
            at = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(dims), pa.array(v, pa.binary())], schema=schema)

    return rows.mapInArrow(run, "vec_id long, label int, dim int, v binary")


def matrix(vectors: list[bytes], dim: int) -> np.ndarray:
    """Vectors of one length as rows of doubles, all whole numbers."""
    return np.frombuffer(b"".join(vectors), "<i4").reshape(len(vectors), dim).astype(np.float64)


def products(rows: np.ndarray, questions: np.ndarray) -> np.ndarray:
    """Exact inner products, rows by questions; beyond 53 bits in whole numbers of any size, held within a long."""
    if not rows.size or not questions.size or rows.shape[1] * np.abs(rows).max() * max(np.abs(questions).max(), 1.0) < 2**53:
        return (rows @ questions.T).astype(np.int64)
    asks, held = [[int(c) for c in q] for q in questions.tolist()], range(-LONG, LONG + 1)
    exact = [[sum(int(a) * b for a, b in zip(r, q, strict=True)) for q in asks] for r in rows.tolist()]
    return np.array([[min(max(s, held[0]), held[-1]) for s in line] for line in exact], np.int64)


def kth(scores: np.ndarray, copies: np.ndarray, k: int) -> int:
    """The score of the k-th row, a vector counting as many rows as it has copies; NONE if there are fewer."""
    order = np.argsort(-scores, kind="stable")
    at = int(np.searchsorted(np.cumsum(copies[order]), k))
    return int(scores[order[at]]) if at < len(order) else NONE


class Found:
    """The best k rows of one window, as they come."""

    def __init__(self, low: int, high: int, k: int) -> None:
        self.low, self.high, self.k = low, high, k
        self.scores, self.rows, self.copies = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, rows: np.ndarray, copies: np.ndarray) -> None:
        near = (scores >= self.low) & (scores <= self.high)
        if near.any():
            self.scores = np.append(self.scores, scores[near])
            self.rows = np.append(self.rows, rows[near])
            self.copies = np.append(self.copies, copies[near])
            self.low = max(self.low, kth(self.scores, self.copies, self.k))
            good = self.scores >= self.low
            self.scores, self.rows, self.copies = self.scores[good], self.rows[good], self.copies[good]

    def best(self, starts: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
        """(minus score, id), the k first ones; equal scores by id."""
        pairs = [(-s, i) for s, r in zip(self.scores.tolist(), self.rows.tolist(), strict=True) for i in ids[starts[r] : starts[r + 1]].tolist()]
        return sorted(pairs)[: self.k]


class Block:
    """The questions of a message, asked of one tree together.

    A tree opens its nodes in the order of the best bound that any question has; a question
    takes part in a node only while a window of its own can gain from it.
    """

    def __init__(self, tree: dict[str, np.ndarray], message: dict[str, np.ndarray], k: int, same: bool | None) -> None:
        self.tree, self.x, self.ask = tree, message["x"].astype(np.float64), message["ask"]
        self.labels, self.same = message["label"], same
        ends, lows, highs = (message[c].tolist() for c in ("ends", "lows", "highs"))
        self.wins = [[Found(lo, hi, k) for lo, hi in zip(lows[a:b], highs[a:b], strict=True)] for a, b in zip(ends, ends[1:], strict=False)]
        width = max((len(w) for w in self.wins), default=0)
        self.low, self.high = np.full((len(self.wins), width), np.inf), np.full((len(self.wins), width), -np.inf)
        for n, wins in enumerate(self.wins):
            self.low[n, : len(wins)], self.high[n, : len(wins)] = [w.low for w in wins], [w.high for w in wins]

    def open(self, asks: np.ndarray, largest: np.ndarray, smallest: np.ndarray | float = -np.inf) -> np.ndarray:
        """Those of the questions for which scores from smallest to largest meet a window of theirs."""
        floor = smallest[:, None] if isinstance(smallest, np.ndarray) else smallest
        return ((largest[:, None] >= self.low[asks]) & (floor <= self.high[asks])).any(axis=1)

    def score(self, a: int, b: int, asks: np.ndarray) -> None:
        """Rows a to b of the tree, exactly, for some of the questions."""
        tree = self.tree
        scores = products(tree["x"][a:b], self.x[asks])
        near = (scores >= self.low[asks].min(axis=1)) & (scores <= self.high[asks].max(axis=1))
        if self.same is not None:
            near &= (tree["labels"][a:b, None] == self.labels[asks]) == self.same
        for column in np.flatnonzero(near.any(axis=0)).tolist():
            n, rows = asks[column], np.flatnonzero(near[:, column])
            for w, win in enumerate(self.wins[n]):
                win.add(scores[rows, column], a + rows, tree["copies"][a + rows])
                self.low[n, w] = win.low

    def answers(self) -> list[list[int]]:
        """Columns ask, win, score, vec_id."""
        starts, ids = self.tree["starts"], self.tree["ids"]
        rows = [(ask, w, -s, i) for ask, wins in zip(self.ask.tolist(), self.wins, strict=True) for w, win in enumerate(wins) for s, i in win.best(starts, ids)]
        return [list(c) for c in zip(*rows, strict=True)] or [[], [], [], []]


def distinct(rows: DataFrame, keep: int) -> DataFrame:
    """(dim, v, label, ids): distinct vectors of a label with their `keep` smallest ids, ascending, each once.

    The rank limit runs before the shuffle, so a vector that a third of the rows share
    sends `keep` rows a task.
    """
    by = ["dim", "v", "label"]
    few = rows.withColumn("n", F.dense_rank().over(Window.partitionBy(*by).orderBy("vec_id"))).where(F.col("n") <= keep)
    return few.groupBy(*by).agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))


@dataclass
class Shards:
    """An index: one stored row per shard, and what is bounded by the number of cells."""

    rows: DataFrame  # dim, cell, piece, kind, payload
    method: Any
    tops: dict[int, Any]  # the partition by length of vectors
    pieces: dict[tuple[int, int], int]
    ends: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # cells of a length and their bounds

    def placed(self, rows: DataFrame) -> DataFrame:
        """rows (dim, v, ...) with the cell and piece that hold their vector."""
        return _pieces(_cells(rows, self.tops), self.pieces)


def _cells(rows: DataFrame, tops: dict[int, Any]) -> DataFrame:
    names, schema = [*rows.columns, "cell"], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(batch.schema.get_field_index("dim")).to_numpy()
            v = batch.column(batch.schema.get_field_index("v"))
            cell = np.zeros(len(batch), np.int32)
            for dim in np.unique(dims).tolist():
                if dim in tops:
                    at = np.flatnonzero(dims == dim)
                    cell[at] = tops[dim].cells(matrix(v.take(pa.array(at)).to_pylist(), dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=names)

    return rows.mapInArrow(run, f"{schema}, cell int")


def _pieces(rows: DataFrame, pieces: dict[tuple[int, int], int]) -> DataFrame:
    cut = [(d, c, n) for (d, c), n in pieces.items() if n > 1]
    if not cut:
        return rows.withColumn("piece", F.lit(0))
    small = rows.sparkSession.createDataFrame(cut, "dim int, cell int, n int")  # bounded by the cells
    of = F.pmod(F.xxhash64("v"), F.coalesce("n", F.lit(1))).cast("int")
    return rows.join(F.broadcast(small), ["dim", "cell"], "left").withColumn("piece", of).drop("n")


def build(found: DataFrame, method: Any, shard_rows: int, sample_bytes: int = 16_000_000) -> Shards:
    """Index of distinct vectors (dim, v, label, ids), a stored table.

    The partition is fitted, per length of vectors, on a sample in hash order: 8192
    vectors at most, fewer where they exceed `sample_bytes`. All vectors are indexed.
    Vectors are assumed to have few different lengths.
    """
    sizes = {r["dim"]: r["n"] for r in found.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    tops = {}
    for dim, n in sizes.items():
        most = max(64, min(8192, sample_bytes // (4 * dim + 1)))
        sample = [bytes(r["v"]) for r in found.where(F.col("dim") == dim).select("v").orderBy(F.xxhash64("v"), "v").limit(most).collect()]
        tops[dim] = method.Top(matrix(sample, dim), -(-n // shard_rows))
    filed = stored(_cells(found, tops), "vectors")
    counts = filed.groupBy("dim", "cell").agg(F.count("*").alias("n")).collect()
    pieces = {(r["dim"], r["cell"]): -(-r["n"] // shard_rows) for r in counts}

    def tree(key, group):
        dim, cell, piece = (k.as_py() for k in key)
        v, ids = group["v"].to_pylist(), group["ids"].to_pylist()
        x = matrix(v, dim)
        order, arrays = method.build(x)
        lo, hi = tops[dim].edges(x)
        flat = np.fromiter((i for r in order.tolist() for i in ids[r]), np.int64)
        starts = np.concatenate(([0], np.cumsum([len(ids[r]) for r in order.tolist()]))).astype(np.int64)
        labels = group["label"].to_numpy()[order]
        payload = to_bytes(x=x[order].astype("<i4"), labels=labels, starts=starts, ids=flat, **arrays)
        return pa.table({"dim": pa.array([dim], pa.int32()), "cell": pa.array([cell], pa.int32()), "piece": pa.array([piece], pa.int32()), "payload": pa.array([payload], pa.binary()), "lo": pa.array([lo.tolist()], pa.list_(pa.float64())), "hi": pa.array([hi.tolist()], pa.list_(pa.float64()))})

    grouped = _pieces(filed, pieces).select(*KEYS, "v", "label", "ids").groupBy(*KEYS)
    rows = stored(grouped.applyInArrow(tree, "dim int, cell int, piece int, payload binary, lo array<double>, hi array<double>"), "shards")
    ends = rows.select("dim", "cell", F.posexplode(F.arrays_zip("lo", "hi")).alias("i", "e"))
    ends = ends.groupBy("dim", "cell", "i").agg(F.min("e.lo").alias("lo"), F.max("e.hi").alias("hi")).orderBy("dim", "cell", "i").collect()
    bounds: dict[int, tuple] = {}
    for dim in sizes:
        cells = sorted(c for d, c in pieces if d == dim)
        lo, hi = ([[r[side] for r in ends if (r["dim"], r["cell"]) == (dim, c)] for c in cells] for side in ("lo", "hi"))
        bounds[dim] = np.array(cells), np.array(lo, np.float64).reshape(len(cells), -1), np.array(hi, np.float64).reshape(len(cells), -1)
    return Shards(rows.select(*KEYS, F.lit(0).alias("kind"), "payload"), method, tops, pieces, bounds)


def early(cell: int, piece: int) -> bool:
    """Whether a shard is one of the eighth that is asked before the rest."""
    return zlib.crc32(f"{cell},{piece}".encode()) % 8 == 0


def early_rows() -> Column:
    return F.crc32(F.concat_ws(",", "cell", "piece")) % 8 == 0


def _messages(shards: Shards, asks: DataFrame, wave: int) -> DataFrame:
    """Questions (ask, dim, v, label, lows, highs, cell, piece) packed for the shards that this wave visits."""
    tops, pieces, ends = shards.tops, shards.pieces, shards.ends
    names = ["ask", "dim", "v", "label", "lows", "highs", "cell", "piece"]
    schema = pa.schema([("dim", pa.int32()), ("cell", pa.int32()), ("piece", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())])

    def pack(dim, block):
        ask, v, label, lows, highs, cells, homes = block
        x = matrix(v, dim)
        least = np.array([min(w, default=LONG) for w in lows], np.float64)
        most = np.array([max(w, default=-LONG) for w in highs], np.float64)
        known, lo, hi = ends[dim]
        reach = tops[dim].reach(x, least, most, lo, hi) & (least <= most)[:, None]
        for c, cell in enumerate(known.tolist()):
            if wave == 0 and cell not in cells:
                continue
            for piece in range(pieces[dim, cell]):
                home = (cells == cell) & (homes == piece)
                if wave and early(cell, piece) != (wave == 1):
                    continue
                to = np.flatnonzero(home & (least <= most) if wave == 0 else reach[:, c] & ~home)
                if len(to):
                    at = to.tolist()
                    flat = lambda w, at=at: np.array([e for i in at for e in w[i]], np.int64)
                    ends_at = np.concatenate(([0], np.cumsum([len(lows[i]) for i in at])))
                    yield dim, cell, piece, 1, to_bytes(ask=ask[to], x=x[to].astype("<i4"), label=label[to], lows=flat(lows), highs=flat(highs), ends=ends_at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(dims)) + 1).tolist(), len(batch)]
            for a, b in zip(edges, edges[1:], strict=False):
                for s in range(a, b, BLOCK):
                    part = batch.slice(s, min(BLOCK, b - s))
                    block = [part.column(0).to_numpy(), part.column(2).to_pylist(), part.column(3).to_numpy(), part.column(4).to_pylist(), part.column(5).to_pylist(), part.column(6).to_numpy(), part.column(7).to_numpy()]
                    for row in pack(int(dims[s]), block):
                        yield pa.RecordBatch.from_arrays([pa.array([c], t.type) for c, t in zip(row, schema, strict=True)], schema=schema)

    together = asks.select(*names).repartitionByRange("dim", "cell", "piece").sortWithinPartitions("dim", "cell", "piece", "ask")
    return together.mapInArrow(run, "dim int, cell int, piece int, kind int, payload binary")


def _answers(shards: Shards, messages: DataFrame, wave: int, k: int, same: bool | None) -> DataFrame:
    """(ask, win, score, vec_id): at most k rows per question, window and shard."""
    rows = shards.rows if wave == 0 else shards.rows.where(early_rows() if wave == 1 else ~early_rows())
    both = rows.unionByName(messages).repartition(*KEYS).sortWithinPartitions(*KEYS, "kind")
    method = shards.method

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            for i in range(len(batch)):
                kind, payload = batch.column(3)[i].as_py(), batch.column(4)[i].as_py()
                if kind == 0:
                    tree = None
                    held = payload  # opened with the first message
                    continue
                if tree is None:
                    tree = from_bytes(held)
                    tree["x"] = tree["x"].astype(np.float64)
                    tree["copies"] = np.diff(tree["starts"])
                block = Block(tree, from_bytes(payload), k, same)
                method.visit(block)
                out = block.answers()
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())], names=["ask", "win", "score", "vec_id"])

    return both.mapInArrow(run, "ask long, win int, score long, vec_id long")


def search(shards: Shards, asks: DataFrame, k: int, same: bool | None = None) -> DataFrame:
    """(ask, win, score, vec_id): the k best rows of each window of each question, equal scores by ascending id.

    asks: ask, dim, v, label, lows, highs (arrays: a window takes scores from low to high),
    cell, piece; a stored table. `same` asks for rows of the question's label (True), of
    other labels (False) or for any.
    """
    first = Window.partitionBy("ask", "win").orderBy(F.desc("score"), "vec_id")
    best = None
    for wave in range(3):
        now = asks
        if best is not None:
            full = best.groupBy("ask", "win").agg(F.count("*").alias("n"), F.min("score").alias("low")).where(F.col("n") == k)
            known = full.groupBy("ask").agg(F.map_from_entries(F.collect_list(F.struct("win", "low"))).alias("known"))
            raised = F.transform("lows", lambda low, i: F.greatest(low, F.try_element_at("known", i)))
            now = asks.join(known, "ask", "left").withColumn("lows", F.when(F.col("known").isNull(), F.col("lows")).otherwise(raised))
        got = _answers(shards, stored(_messages(shards, now, wave), "messages"), wave, k, same)
        every = got if best is None else best.unionByName(got)
        best = stored(every.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k).drop("n"), "best")
    return best
