"""Ranked lexical search, exact top-k search and hard-negative mining against plain loops."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.llm import gnat, kdtree, ranked, vectors

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(TERM, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(w for _, c in counted for w in c)
    out = Counter()
    for item_id, text in set(items):
        scored = []
        for (doc, c), n in zip(counted, sizes, strict=True):
            score = 0
            for w, times in Counter(terms(text)).items():
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    score += times * weight * (10**9 * c[w] // (1000 * c[w] + 12 * (75 + 25 * n * n_docs // n_terms)))
            if score > 0:
                scored.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1):
            out[item_id, rank, doc, -score] += 1
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["Élan", "über", "x1", "9", "do-re", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.choice([0, 1, 5, 40, 200])))) for i in range(700)]
    rows += [rows[3], rows[3], (None, "w1 w2 über"), (None, None), (900, None), (901, ""), (902, "; \n\t-"), (903, "w5 " * 50_000)]
    rows += [(1000 + i, "w0 w1 w2 w3") for i in range(60)]  # ties
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 30)))) for i in range(25)]
    items += [items[0], (0, "w9 w9 W9"), (30, None), (31, ""), (32, "absent"), (None, "über x1"), (33, "w0 w1 w2 w3"), (34, "w5")]
    return rows, items


def test_ranked_search_equals_a_plain_loop(spark, corpus, monkeypatch):
    rows, items = corpus
    docs = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], "doc_id long, text string, rank string, score int").repartition(6)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    want = plain_search(rows, items, 20)
    for settings in ({"most": 20_000}, {"most": 20_000_000}):
        index = ranked.build_index(docs, **settings)
        for choice in ({}, {"short": 0.0}, {"short": 1.0, "probe": 1}, {"most": 300}):
            got = ranked.search(index, asked, 20, **choice)
            assert got.columns == ["item_id", "rank", "doc_id", "score"]
            assert Counter(map(tuple, got.collect())) == want, (settings, choice)


def test_ranked_search_of_little_or_nothing(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one two"), (2, None), (3, "alpha X")], "item_id long, text string")
    got = Counter(map(tuple, ranked.ranked_search(odd_docs, items).collect()))
    assert got == plain_search([(r.doc_id, r.text) for r in odd_docs.collect()], [(1, "one two"), (2, None), (3, "alpha X")], 20)
    assert ranked.ranked_search(no_docs, items).count() == 0
    assert ranked.ranked_search(odd_docs, items.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, " ;")], "doc_id long, text string")
    assert ranked.ranked_search(blank, items).count() == 0


def test_windows_are_skipped_and_the_result_stays(monkeypatch):
    rng = np.random.default_rng(3)
    edges = np.arange(0, 60 * ranked.WINDOW + 1, ranked.WINDOW)
    iters = []
    for share in (0.5, 0.3, 0.02, 0.01):
        at = np.flatnonzero(rng.random(edges[-1]) < share)
        scores = rng.integers(1, 100, len(at)) * int(1 / share)
        iters.append(ranked.Iter(at, scores, edges))
    total = np.zeros(edges[-1], np.int64)
    for it in iters:
        total[it.docs] += it.scores
    for k in (1, 5, 20):
        low = np.sort(total)[-k]
        docs, scores = ranked.skipping(iters, k, 1)
        assert sorted(docs.tolist()) == np.flatnonzero(total >= low).tolist() and (total[docs] == scores).all()
    docs, _ = ranked.skipping(iters, 5, int(total.max()) + 1)
    assert not len(docs)


def test_lists_of_a_long_text_are_reduced_on_the_way():
    lists = ranked.Lists()
    lists.add("a b a " * 700_000)
    assert lists.n_waiting <= 1_000_000 or len(lists.keys) >= 1
    lists.add("b")
    sizes, vocabulary, lengths, gaps, counts = lists.columns()
    assert sizes == [2_100_000, 1]
    assert ranked.unpacked(lengths, "<i4").tolist() == [1, 2]
    assert np.cumsum(ranked.unpacked(gaps, "<i4")).tolist() == [0, 0, 1]
    assert ranked.unpacked(counts, "<i8").tolist() == [1_400_000, 700_000, 1]


def whole(vector, scale):
    if vector is None or any(c is None or not math.isfinite(c) for c in vector):
        return None
    return [math.floor(scale * c) for c in vector]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True))


def plain_topk(rows, k, every, scale):
    known = {(i, tuple(w)) for i, v, _ in rows if i is not None and (w := whole(v, scale)) is not None}
    out = Counter()
    for q, v in known:
        if q % every:
            continue
        best = sorted((-dot(v, w), i) for i, w in known if len(w) == len(v))[: k + 1]
        best = [b for b in best if b[1] != q][:k]
        out.update((q, rank, i, -s) for rank, (s, i) in enumerate(best, 1))
    return out


def plain_negatives(rows, every, relabel, scale=256):
    known = set()
    for i, v, label in rows:
        w = whole(v, scale)
        if i is not None and w is not None and label is not None:
            known.add((i, tuple(w), (label + 1) % 10 if relabel and i % relabel == 0 else label))
    out = Counter()
    for a, v, label in known:
        if a % every:
            continue
        scored = sorted((-dot(v, w), i, la) for i, w, la in known if len(w) == len(v))
        for s, p, _ in [x for x in [x for x in scored if x[2] == label][:6] if x[1] != a][:5]:
            fit = [(n, i) for n, i, la in scored if la != label and -80 * s <= -100 * n <= -100 * s][:5]
            out.update((a, p, rank, i, -s, -n) for rank, (n, i) in enumerate(fit, 1))
    return out


def vector_rows(seed, n, dim=8):
    """Clusters, a vector that a third of the rows share under several labels, coarse ties, and odd rows."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        kind = i % 6
        v = centers[0] if kind < 2 else centers[kind] + 0.1 * rng.normal(size=dim) if kind < 5 else np.round(rng.normal(size=dim)) / 2
        rows.append((i, [float(np.float32(c)) for c in v], int(rng.integers(0, 4))))
    rows += [(0, rows[0][1], rows[0][2]), (200, rows[5][1], rows[5][2]), (None, rows[1][1], 1), (5001, None, 1), (5100, rows[2][1], None)]
    rows += [(6000, [1.0] * (dim - 1) + [None], 2), (6100, [1.0] * (dim - 1) + [math.nan], 2), (6200, [math.inf] * dim, 2), (6300, [0.0] * dim, 3)]
    rows += [(7000, [0.5, 0.25], 1), (7100, [0.5, 0.5], 1), (7001, [0.5, 0.75], 2), (7200, [], 1), (7003, [], 2), (7300, [-1.0] * dim, 0)]
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score int"


@pytest.mark.parametrize("shard_rows", [60, 8192])
def test_exact_topk_equals_a_plain_loop(spark, shard_rows, monkeypatch):
    monkeypatch.setattr(kdtree, "LEAF", 16)
    rows = vector_rows(1, 900)
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    got = kdtree.exact_topk(table, 20, 20, shard_rows=shard_rows)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(map(tuple, got.collect())) == plain_topk(rows, 20, 20, 64)
    few = kdtree.exact_topk(table, 3, 100, 1000, shard_rows=shard_rows)
    assert Counter(map(tuple, few.collect())) == plain_topk(rows, 3, 100, 1000)
    assert kdtree.exact_topk(table.limit(0)).count() == 0


@pytest.mark.parametrize("shard_rows", [60, 8192])
def test_hard_negatives_equal_a_plain_loop(spark, shard_rows, monkeypatch):
    monkeypatch.setattr(gnat, "LEAF", 16)
    rows = vector_rows(2, 700)
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    got = gnat.hard_negatives(table, relabel=7, every=20, shard_rows=shard_rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain_negatives(rows, 20, 7)
    assert Counter(map(tuple, got.collect())) == want and len(want) > 100
    plain = gnat.hard_negatives(table, shard_rows=shard_rows)
    assert Counter(map(tuple, plain.collect())) == plain_negatives(rows, 100, None)
    assert gnat.hard_negatives(table.limit(0)).count() == 0


def test_components_beyond_53_bits_score_exactly(spark):
    rows = [(i, [float(2**22 + i), float(-(2**21) + i), 2.0**22], 0) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert Counter(map(tuple, kdtree.exact_topk(table, 5).collect())) == plain_topk(rows, 5, 20, 64)


def one_question(method, x, q, low, high, k, monkeypatch):
    """The scores found in one tree for one window, and the share of the rows that were scored."""
    order, arrays = method.build(x)
    tree = arrays | {"x": x[order], "labels": np.zeros(len(x), int), "copies": np.ones(len(x), np.int64)}
    ask = {"x": q[None], "ask": np.array([7]), "label": np.array([0]), "lows": np.array([low]), "highs": np.array([high]), "ends": np.array([0, 1])}
    seen = []
    exact = vectors.products
    monkeypatch.setattr(vectors, "products", lambda rows, asks: seen.append(len(rows)) or exact(rows, asks))
    block = vectors.Block(tree, ask, k, None)
    method.visit(block)
    monkeypatch.setattr(vectors, "products", exact)
    return sorted(block.wins[0][0].scores.tolist())[-k:], sum(seen) / len(x)


@pytest.mark.parametrize("method", [kdtree, gnat])
def test_bounds_leave_out_most_of_clustered_vectors(method, monkeypatch):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(40, 16))
    centers *= 400 / np.linalg.norm(centers, axis=1)[:, None]
    x = np.floor(centers[rng.integers(0, 40, 8000)] + rng.normal(size=(8000, 16)))
    shares = []
    for i in range(0, 8000, 400):
        found, share = one_question(method, x, x[i], vectors.NONE, vectors.LONG, 20, monkeypatch)
        assert found == sorted((x @ x[i]).astype(int).tolist())[-20:]
        shares.append(share)
    assert np.mean(shares) < 0.3


def test_a_window_eliminates_inner_and_outer_subtrees(monkeypatch):
    """Scores near the question's own and far below both lie outside of a window in the middle."""
    rng = np.random.default_rng(6)
    angle = rng.uniform(0, math.pi, 6000)
    x = np.floor(1000 * np.column_stack([np.cos(angle), np.sin(angle)]))
    q = np.array([1000.0, 0.0])
    found, share = one_question(gnat, x, q, 400_000, 500_000, 5, monkeypatch)
    scores = (x @ q).astype(int)
    assert found == sorted(scores[(scores >= 400_000) & (scores <= 500_000)].tolist())[-5:] and share < 0.2


def test_equal_vectors_send_few_ids(spark):
    rows = spark.range(5000).select(F.col("id").alias("vec_id"), F.lit(0).alias("label"), F.lit(1).alias("dim"), F.lit(b"\x01\0\0\0").alias("v"))
    got = vectors.distinct(rows.repartition(7), 21).collect()
    assert [r["ids"] for r in got] == [list(range(21))]


def test_a_cell_above_the_shard_size_is_cut(spark):
    rng = np.random.default_rng(8)
    x = np.column_stack([np.arange(3000), rng.integers(0, 2, 3000)]).astype("<i4")
    x[200:, 0] += 100_000  # one far cluster holds most
    rows = spark.createDataFrame([(2, bytearray(v.tobytes()), 0, [i]) for i, v in enumerate(x)], "dim int, v binary, label int, ids array<long>")
    for method in (kdtree, gnat):
        shards = vectors.build(rows, method, 100)
        sizes = defaultdict(int)
        for r in shards.rows.collect():
            sizes[r["cell"], r["piece"]] = len(vectors.from_bytes(r["payload"])["x"])
        assert sum(sizes.values()) == 3000 and max(sizes.values()) <= 180 and len(sizes) >= 20
