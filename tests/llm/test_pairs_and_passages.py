"""SimHash near-dedup, substring dedup and decontamination against plain loops."""

import hashlib
import random
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from docketry.llm import decontaminate, passages, simhash

SPACES = r"[^\x20\x09-\x0D]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_print(text):
    words = re.findall(SPACES, lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest doc_id reachable, per position, by links of at most 3 bits."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(prints):
        groups.setdefault(find(i), []).append(doc)
    return [min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(prints))]


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n):
        words = rng.choices(vocabulary, k=rng.randint(1, 160))
        out.append(" ".join(words))
        for _ in range(rng.randint(0, 2)):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "changed"
            out.append(" ".join(copy))
    return out


def test_fingerprints_and_components_equal_plain_loops(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()] + [(100 + i, t) for i, t in enumerate(texts(1, 120))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = simhash.near_duplicates(docs).collect()
    prints = [(d, plain_print(t)) for d, t in rows]
    want = Counter(zip((d for d, _ in prints), (p for _, p in prints), plain_components(prints), strict=True))
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == want


def test_links_of_chosen_fingerprints(spark):
    """Distances 0 to 4 in every split over the segments, and a dense group around one point."""
    rng = random.Random(2)
    points = []
    for _ in range(150):
        base = rng.getrandbits(64)
        points.append(base)
        for bits in (1, 2, 3, 4):
            other = base
            for b in rng.sample(range(64), bits):
                other ^= 1 << b
            points.append(other)
    center = rng.getrandbits(64)
    points += [center ^ sum(1 << b for b in rng.sample(range(20, 44), rng.randint(0, 6))) for _ in range(300)]
    points = sorted(set(points))
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long")).collect()
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 3 and r.a != r.b for r in edges)
    assert len(edges) <= 66 * len(points)
    roots = {r.node: r.root for r in simhash.components(spark.createDataFrame([(r.a, r.b) for r in edges], "a long, b long")).collect()}
    want = plain_components([(s, p) for s, p in zip(signed, points, strict=True)])
    assert [roots.get(s, s) for s in signed] == want


def test_a_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert {roots[i] for i in range(1, 201)} == {0} and roots[501] == 500


def test_one_document_of_each_group_stays(spark, odd_docs, no_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    want = plain_components([(r.doc_id, plain_print(r.text)) for r in odd_docs.collect()])
    assert sorted(r.doc_id for r in rows) == sorted(set(want))
    assert simhash.keep_one(no_docs).count() == 0
    nameless = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "p q r s t")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.keep_one(nameless).collect()) == ["a b c d", "p q r s t"]


def plain_dedup(rows, size):
    words = [(d, re.findall(SPACES, t or "")) for d, t in rows]
    count = Counter(tuple(w[i : i + size]) for _, w in words for i in range(len(w) - size + 1))
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_substring_dedup_equals_plain_windows(spark, odd_docs, no_docs):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(60)]
    shared = [rng.choices(vocabulary, k=rng.randint(30, 90)) for _ in range(6)]
    rows = [(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id != 5]
    for i in range(80):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            words += rng.choice(shared)[rng.randint(0, 10) :] + rng.choices(vocabulary, k=3)
        rows.append((100 + i, "\n ".join(words)))
    rows += [(900, "same " * 34), (901, "same " * 36), (902, " ".join(shared[0] * 3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for size, seed in ((35, 18), (12, 5)):
        got = passages.substring_dedup(docs, size=size, seed=seed, most=4000)
        assert Counter(tuple(r) for r in got.drop("kept").collect()) == Counter(plain_dedup(rows, size))
    long = passages.substring_dedup(odd_docs.where("doc_id = 5")).first()
    assert (long.n_words, long.n_removed, long.kept) == (120_000, 120_000, "")
    assert passages.substring_dedup(no_docs).count() == 0


NORMAL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_hits(text, items, width):
    words = re.findall(NORMAL, lower(text))
    hit, names = set(), set()
    for name, item in items:
        target = re.findall(NORMAL, lower(item))
        n = min(width, len(target))
        for s in range(len(target) - n + 1 if target else 0):
            for i in range(len(words) - n + 1):
                if words[i : i + n] == target[s : s + n]:
                    hit |= set(range(i, i + n))
                    names.add(name)
    return len(words), len(hit), sorted(names)


def test_contamination_equals_plain_windows(spark, odd_docs, no_docs):
    rng = random.Random(6)
    vocabulary = ["The", "cat", "élan", "x1", "9", "über", "do-re", "mi", "a"]
    items = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, k=rng.randint(1, 9)))) for i in range(12)]
    items += [(12, None), (13, " .,! "), (10, "cat mi"), (None, "one two THREE")]
    rows = [(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id != 5]
    rows += [(50 + i, rng.choice(["; ", " "]).join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id int, text string").withColumn("doc_id", F.lit(1))
    named = [("null" if i is None else str(i), t) for i, t in items]
    want = Counter()
    for d, t in rows:
        n, hits, names = plain_hits(t, named, 4)
        want[(d, n, hits, len(names), tuple(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hits > 0)] += 1
    for most in (16_000_000, 60):  # one automaton, several
        got = decontaminate.contamination(docs, bench, width=4, most=most).drop("text_key", "spans").collect()
        assert Counter((*r[:4], tuple(r[4]), *r[5:]) for r in got) == want
    assert decontaminate.contamination(no_docs, bench).count() == 0
    assert not decontaminate.contamination(docs, bench.limit(0)).where("contaminated").count()
    clean = decontaminate.drop_contaminated(docs, bench, width=4).collect()
    assert len(clean) == sum(n for k, n in want.items() if not k[-1])


def test_contaminated_spans_lie_in_the_original(spark):
    text = "Prefix: ÉLAN the  Quick-brown... fox; end"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([("q", "the quick BROWN fox")], "item_id string, text string")
    spans = decontaminate.contamination(docs, bench).first().spans
    a, b = map(int, spans.split(":"))
    assert text[a:b] == "the  Quick-brown... fox"
