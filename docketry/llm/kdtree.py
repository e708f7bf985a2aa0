"""Exact top-k by inner product: a KD-tree per shard, searched best first.

Median splits of the widest component down to small leaves, each node with the tight
box of its vectors. A box's largest inner product with a question is the sum over the
components of the better of its two ends. Nodes are opened in descending order of that
bound until it falls below the k-th score, which comes along from the shards asked
before. The cells of `vectors` are the leaves of a KD-tree over a sample.
"""

from __future__ import annotations

import heapq
import sys

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm import vectors
from docketry.llm.common import stored

LEAF = 256
MOST_CELLS = 256


def halves(x: np.ndarray, rows: np.ndarray) -> tuple[int, np.ndarray] | None:
    """The widest component of some vectors and the rows in order around its median; None if all are equal."""
    part = x[rows]
    spread = part.max(axis=0) - part.min(axis=0) if part.size else np.zeros(1)
    widest = int(np.argmax(spread))
    if not spread[widest]:
        return None
    return widest, rows[np.argpartition(part[:, widest], len(rows) // 2)]


def boxes_reach(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The largest inner product of each question with each box, never too small."""
    plus, minus = np.maximum(q, 0), np.maximum(-q, 0)
    bound = plus @ hi.T - minus @ lo.T
    return bound + 1e-9 * (plus @ np.abs(hi).T + minus @ np.abs(lo).T)


class Top:
    """Cells: median splits of a sample, as deep as `cells` asks for."""

    def __init__(self, sample: np.ndarray, cells: int) -> None:
        self.splits: list[tuple[int, float, int, int]] = []  # component, median, left, right; a cell as -1 - number
        self.n = 0
        cells = min(cells, MOST_CELLS, max(1, len(sample) // 16))
        self.root = self._split(sample, np.arange(len(sample)), cells)

    def _split(self, x: np.ndarray, rows: np.ndarray, cells: int) -> int:
        cut = halves(x, rows) if cells > 1 else None
        if cut is None:
            self.n += 1
            return -self.n
        component, order = cut
        at = len(self.splits)
        self.splits.append((component, float(x[order[len(order) // 2], component]), 0, 0))
        left = self._split(x, order[: len(order) // 2], cells // 2)
        right = self._split(x, order[len(order) // 2 :], cells - cells // 2)
        self.splits[at] = (*self.splits[at][:2], left, right)
        return at

    def cells(self, x: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(x), np.int32), [(self.root, np.arange(len(x)))]
        while open_:
            node, rows = open_.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                component, median, left, right = self.splits[node]
                below = x[rows, component] < median
                open_ += [(left, rows[below]), (right, rows[~below])]
        return out

    def edges(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x.min(axis=0), x.max(axis=0)

    def reach(self, q: np.ndarray, least: np.ndarray, most: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return boxes_reach(q, lo, hi) >= least[:, None]


def build(x: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Rows in tree order, and the nodes: first and last row, children (0: a leaf), boxes."""
    order = np.arange(len(x))
    spans, kids = [(0, len(x))], [(0, 0)]
    at = 0
    while at < len(spans):
        a, b = spans[at]
        cut = halves(x, order[a:b]) if b - a > LEAF else None
        if cut:
            order[a:b] = cut[1]
            middle = a + (b - a) // 2
            kids[at] = (len(spans), len(spans) + 1)
            spans += [(a, middle), (middle, b)]
            kids += [(0, 0), (0, 0)]
        at += 1
    lo = np.array([x[order[a:b]].min(axis=0) for a, b in spans])
    hi = np.array([x[order[a:b]].max(axis=0) for a, b in spans])
    return order, {"spans": np.array(spans), "kids": np.array(kids), "lo": lo, "hi": hi}


def visit(block: vectors.Block) -> None:
    """Best-first search of a tree: nodes in descending order of their bounds, until none reaches a k-th score."""
    tree, every = block.tree, np.arange(len(block.x))
    bounds = boxes_reach(block.x, tree["lo"], tree["hi"])
    spans, kids = tree["spans"].tolist(), tree["kids"].tolist()
    heap = [(-np.inf, 0)]
    while heap:
        _, node = heapq.heappop(heap)
        asks = every[block.open(every, bounds[:, node])]
        if not len(asks):
            continue
        if not kids[node][0]:
            block.score(*spans[node], asks)
            continue
        for kid in kids[node]:
            heapq.heappush(heap, (-bounds[asks, kid].max(), kid))


def exact_topk(table: DataFrame, k: int = 20, every: int = 20, scale: int = 64, key: str = "vec_id", vector: str = "embedding", shard_rows: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row whose id is divisible by `every`.

    Components count as floor(scale x); the score is the integer inner product, equal scores
    go by ascending id. Rows that `vectors.quantised` leaves out take no part; vectors of
    different lengths do not meet. Rows repeated with equal id and vector count once. An id
    with several vectors is a candidate and a question with each; a question's own id is
    taken out of its k + 1 best, so such an id may get fewer than k. Equal vectors are
    searched once, as candidates and as questions, with their k + 1 smallest ids. Other
    columns are not read; an empty table gives no rows.
    """
    rows = vectors.quantised(table, scale, key, vector)
    shards = vectors.build(vectors.distinct(rows, k + 1), sys.modules[__name__], shard_rows)
    queries = stored(rows.where(F.col("vec_id") % every == 0).select("vec_id", "dim", "v").distinct(), "queries")
    asks = queries.select("dim", "v").distinct().withColumn("ask", F.monotonically_increasing_id())
    low, high = F.array(F.lit(vectors.NONE)), F.array(F.lit(vectors.LONG))
    asks = asks.select("ask", "dim", "v", F.lit(0).alias("label"), low.alias("lows"), high.alias("highs"))
    asks = stored(shards.placed(stored(asks, "asked")), "asks")
    best = vectors.search(shards, asks, k + 1)
    lists = best.groupBy("ask").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("best"))
    of = asks.select("ask", "dim", "v").join(lists, "ask").select("dim", "v", "best")
    own = queries.withColumnRenamed("vec_id", "query_id").join(of, ["dim", "v"])
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    ranked = own.select("query_id", F.posexplode(others).alias("at", "b"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), "b.vec_id", (-F.col("b.minus")).alias("score"))
