"""Hard-negative mining: a GNAT-style multiway hyperplane tree per shard.

A node has up to eight split points; each of its vectors goes to the nearest one. Split
point i knows the range of its distances to the vectors of each sibling subtree j. With
the distance of a question to all split points, the triangle inequality bounds the
distances, and so the scores, that subtree j can hold. A window of scores is an annulus
around the question: a subtree whose range meets no window's annulus is eliminated.
Subtrees are opened best first, leaves are scored exactly, and a window's inner end
follows its k-th score. The cells of `vectors` are those of split points of a sample.
"""

from __future__ import annotations

import heapq
import sys

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm import vectors
from docketry.llm.common import stored

LEAF = 128
DEGREE = 8
MOST_CELLS = 64


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances, rows by points."""
    squares = (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None] - 2 * (x @ points.T)
    return np.sqrt(np.maximum(squares, 0))


def spread_points(x: np.ndarray, n: int) -> np.ndarray:
    """Up to n different vectors far from each other, chosen one by one from an even choice of rows."""
    some = x[np.unique(np.linspace(0, len(x) - 1, min(len(x), 16 * n)).astype(int))] if len(x) else x
    chosen: list[int] = [0] if len(some) else []
    near = distances(some, some[chosen]).min(axis=1) if chosen else np.empty(0)
    while chosen and len(chosen) < n and near.max() > 1e-6:
        chosen.append(int(np.argmax(near)))
        near = np.minimum(near, distances(some, some[chosen[-1:]])[:, 0])
    return some[chosen]


def score_range(square: np.ndarray, away: np.ndarray, lo: np.ndarray, hi: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest score of subtrees with distances lo to hi from each point, by the triangle inequality.

    square: squared length of the question; away: its distances to the points (last axis
    of lo and hi); least, most: squared lengths of the subtree's vectors. Widened by more
    than the rounding of distances.
    """
    nearest = np.maximum(np.maximum(lo - away, away - hi).max(axis=-1), 0)
    farthest = (away + hi).min(axis=-1)
    slack = 1 + 1e-6 * (square + most)
    return (square + least - farthest * farthest) / 2 - slack, (square + most - nearest * nearest) / 2 + slack


class Top:
    """Cells: the nearest of at most 64 split points of a sample."""

    def __init__(self, sample: np.ndarray, cells: int) -> None:
        self.points = spread_points(sample, max(1, min(cells, MOST_CELLS)))

    def cells(self, x: np.ndarray) -> np.ndarray:
        return np.argmin(distances(x, self.points), axis=1).astype(np.int32)

    def edges(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the distances to all split points, and of the squared lengths."""
        all_ = np.column_stack([distances(x, self.points), (x * x).sum(axis=1)])
        return all_.min(axis=0), all_.max(axis=0)

    def reach(self, q: np.ndarray, least: np.ndarray, most: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        away = distances(q, self.points)[:, None]
        smallest, largest = score_range((q * q).sum(axis=1)[:, None], away, lo[None, :, :-1], hi[None, :, :-1], lo[None, :, -1], hi[None, :, -1])
        return (largest >= least[:, None]) & (smallest <= most[:, None])


def build(x: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Rows in tree order, and the nodes: first and last row, first child and number of children (0: a leaf).

    Per child: its split point, its ranges of distance to all split points of the node
    (padded to DEGREE), and the squared lengths of its vectors.
    """
    order, squares = np.arange(len(x)), (x * x).sum(axis=1)
    spans, kids = [(0, len(x))], [(0, 0)]
    points, lo, hi = [np.zeros(x.shape[1])], [np.zeros(DEGREE)], [np.full(DEGREE, np.inf)]
    at = 0
    while at < len(spans):
        a, b = spans[at]
        rows = order[a:b]
        split = spread_points(x[rows], DEGREE) if b - a > LEAF else np.empty((0, x.shape[1]))
        if len(split) > 1:
            away = distances(x[rows], split)
            side = np.argmin(away, axis=1)
            by = np.argsort(side, kind="stable")
            order[a:b], away, cuts = rows[by], away[by], np.searchsorted(side[by], np.arange(len(split) + 1))
            kids[at] = (len(spans), len(split))
            for j, (s, e) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):  # none is empty: it holds its split point
                spans.append((a + s, a + e))
                kids.append((0, 0))
                points.append(split[j])
                pad = DEGREE - len(split)
                lo.append(np.pad(away[s:e].min(axis=0), (0, pad)))
                hi.append(np.pad(away[s:e].max(axis=0), (0, pad), constant_values=np.inf))
        at += 1
    lengths = np.array([(squares[order[a:b]].min(), squares[order[a:b]].max()) for a, b in spans])
    return order, {"spans": np.array(spans), "kids": np.array(kids), "points": np.array(points).astype("<i4"), "lo": np.array(lo), "hi": np.array(hi), "lengths": lengths}


def visit(block: vectors.Block) -> None:
    """Searches a tree for all windows: subtrees best first, eliminated where their scores meet no window."""
    tree, squares = block.tree, (block.x * block.x).sum(axis=1)
    spans, kids, lengths = tree["spans"].tolist(), tree["kids"].tolist(), tree["lengths"]
    away = distances(block.x, tree["points"].astype(np.float64))
    every = np.arange(len(block.x))
    heap = [(-np.inf, 0, every, np.full(len(every), np.inf), np.full(len(every), -np.inf))]
    while heap:
        _, node, asks, largest, smallest = heapq.heappop(heap)
        asks = asks[block.open(asks, largest, smallest)]
        first, number = kids[node]
        if not len(asks):
            continue
        if not number:
            block.score(*spans[node], asks)
            continue
        of = slice(first, first + number)
        low, high = score_range(squares[asks, None], away[asks, None, of], tree["lo"][of, :number], tree["hi"][of, :number], lengths[of, 0], lengths[of, 1])
        for j in range(number):
            to = block.open(asks, high[:, j], low[:, j])
            if to.any():
                heapq.heappush(heap, (-high[to, j].max(), first + j, asks[to], high[to, j], low[to, j]))


def hard_negatives(
    table: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    every: int = 100,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    relabel: int | None = None,
    shard_rows: int = 8192,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by `every`; an anchor's positives are its
    first `positives` other rows of its label, and for each of them the first `negatives`
    rows of other labels with a score from `least` percent of the positive's up to all of
    it are given. Scores are integer inner products of floor(scale x); higher come first,
    equal ones by ascending id. Where `relabel` divides an id, its label counts as
    (label + 1) % 10. Rows without a label, and those that `vectors.quantised` leaves out,
    take no part; vectors of different lengths do not meet. Rows repeated with equal id,
    vector and label count once. An id with several vectors or labels is a candidate and an
    anchor with each; its own id is taken out of its first `positives` + 1 rows. A positive
    without a negative in its window, or with a negative score, gives no row. Other columns
    are not read; an empty table gives no rows.
    """
    rows = vectors.quantised(table, scale, key, vector, label)
    if relabel:
        rows = rows.withColumn("label", F.when(F.col("vec_id") % relabel == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    shards = vectors.build(vectors.distinct(rows, max(positives + 1, negatives)), sys.modules[__name__], shard_rows)
    by = ["dim", "v", "label"]
    anchors = stored(rows.where(F.col("vec_id") % every == 0).select("vec_id", *by).distinct(), "anchors")
    asks = stored(anchors.select(*by).distinct().withColumn("ask", F.monotonically_increasing_id()), "asked")
    low, high = F.array(F.lit(vectors.NONE)), F.array(F.lit(vectors.LONG))
    asks = stored(shards.placed(asks.select("ask", *by, low.alias("lows"), high.alias("highs"))), "asks")
    alike = vectors.search(shards, asks, positives + 1, same=True)
    near = alike.groupBy("ask").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("alike"))
    ends = F.array_distinct(F.transform(F.filter("alike", lambda p: p["minus"] <= 0), lambda p: -p["minus"]))
    windows = asks.drop("lows", "highs").join(near, "ask").withColumn("highs", ends)
    windows = windows.withColumn("lows", F.expr(f"transform(highs, s -> ({least} * s + 99) div 100)"))
    windows = stored(windows, "windows")
    unlike = vectors.search(shards, windows.where("size(highs) > 0").drop("alike"), negatives, same=False)
    far = unlike.groupBy("ask", "win").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("unlike"))
    far = far.groupBy("ask").agg(F.map_from_entries(F.collect_list(F.struct("win", "unlike"))).alias("far"))
    of = windows.join(far, "ask").select(*by, "alike", "highs", "far")
    own = anchors.withColumnRenamed("vec_id", "anchor_id").join(of, by)
    others = F.slice(F.filter("alike", lambda p: p["vec_id"] != F.col("anchor_id")), 1, positives)
    own = own.select("anchor_id", "highs", "far", F.explode(others).alias("p"))
    win = (F.array_position("highs", -F.col("p.minus")) - 1).cast("int")
    own = own.select("anchor_id", "p", F.posexplode(F.try_element_at("far", win)).alias("at", "n"))
    return own.select(
        "anchor_id",
        F.col("p.vec_id").alias("positive_id"),
        (F.col("at") + 1).alias("rank"),
        F.col("n.vec_id").alias("negative_id"),
        (-F.col("p.minus")).alias("positive_score"),
        (-F.col("n.minus")).alias("negative_score"),
    )
