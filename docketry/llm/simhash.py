"""Near-duplicates by SimHash: fingerprints, multi-index hashing over Hamming balls, connected components.

Two fingerprints within 3 bits differ in at most 1 bit in one of their two 32-bit
segments. Each distinct fingerprint is filed under all keys within 1 bit of each
segment (66 rows of 13 bytes). In a key's bucket the complete distances decide,
and only a spanning forest of the links leaves the bucket, so that a group of
copies gives as many rows as it has members, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import map_batches, numbered, renamed, stored

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of one text, unsigned; 0 for a text without words."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 8192):  # bounded memory for very long texts
        ones += np.unpackbits(hashes[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, text_key, fp): the fingerprint as a signed 64-bit number, one row per input row. Null text: 0.

    text_key tells rows of one doc_id with different texts apart.
    """

    def make(keys, marks, texts):
        prints = np.array([fingerprint(t, shingle, seed) for t in texts], dtype=np.uint64).view(np.int64)
        return keys, marks, prints.tolist()

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(f"`{key}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"), F.col(f"`{text}`").alias("text"))
    return map_batches(narrow, ["doc_id", "text_key", "text"], "text", make, f"doc_id {kind}, text_key long, fp long")


def _forest(members: np.ndarray, exact: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links within `bits` between the exact members of a bucket and all its members.

    Breadth first: a reached member is compared with those not yet reached only. In a
    group of near copies that is most of them after the first steps.
    """
    names = members.view(np.int64)
    edges: list[tuple[int, int]] = []
    left = np.arange(len(members))
    for hub in np.flatnonzero(exact).tolist():
        at = int(np.searchsorted(left, hub))
        if at == len(left) or left[at] != hub:
            continue  # reached already
        left = np.delete(left, at)
        reached = [hub]
        while reached and len(left):
            i = reached.pop()
            pool = left if exact[i] else left[exact[left]]
            near = pool[np.bitwise_count(members[pool] ^ members[i]) <= bits]
            if len(near):
                edges += zip([int(names[i])] * len(near), names[near].tolist(), strict=True)
                reached += near.tolist()
                left = left[~np.isin(left, near, assume_unique=True)]
    return edges


def links(prints: DataFrame, bits: int = 3) -> DataFrame:
    """(a, b): links between distinct fingerprints that hold all groups together.

    Every pair within `bits` is connected by a path of such links; each link is
    itself within `bits`. `bits` of up to 3 need balls of 1 bit in two segments.
    """
    if not 0 <= bits <= 3:
        raise ValueError("bits must be 0 to 3")
    ball = F.explode(F.sequence(F.lit(0), F.lit(65)))
    low = F.lit(0xFFFFFFFF)
    filed = prints.select("fp").distinct().select("fp", ball.alias("n"))
    filed = filed.select(
        "fp",
        F.expr("n div 33").cast("byte").alias("part"),
        (F.col("n") % 33).alias("flip"),
    )
    segment = F.when(F.col("part") == 0, F.col("fp").bitwiseAND(low)).otherwise(F.shiftrightunsigned("fp", 32).bitwiseAND(low))
    flipped = F.when(F.col("flip") == 0, segment).otherwise(segment.bitwiseXOR(F.expr("shiftleft(1L, flip - 1)")))
    filed = filed.select("part", flipped.alias("key"), (F.col("flip") == 0).alias("exact"), "fp")
    dealt = filed.repartition("part", "key").sortWithinPartitions("part", "key", "fp")

    def run(batches):
        rest = None

        def forests(key, exact, fp):
            cut = np.flatnonzero(np.diff(key)) + 1
            starts, stops = np.concatenate(([0], cut)), np.concatenate((cut, [len(key)]))
            known = np.concatenate(([0], np.cumsum(exact)))
            live = (stops - starts > 1) & (known[stops] > known[starts])
            out = []
            for a, b in zip(starts[live].tolist(), stops[live].tolist(), strict=True):
                out += _forest(fp[a:b], exact[a:b], bits)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

        for batch in batches:
            part, key, exact, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            now = [part.astype(np.int64) * (1 << 32) + key, exact, fp.view(np.uint64)]
            if rest:
                now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
            last = np.searchsorted(now[0], now[0][-1])  # the last bucket may go on in the next batch
            rest = [x[last:] for x in now]
            if last:
                yield forests(*[x[:last] for x in now])
        if rest:
            yield forests(*rest)

    return dealt.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root): smallest node of each connected component, by alternating large and small stars.

    Each round is one shuffle with partial aggregation per star; the edges are written
    between rounds. A hub's star is aggregated by min, never gathered.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    pairs = stored(pairs, "edges")

    def state(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    before = state(pairs)
    for _ in range(rounds if before[0] else 0):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
        least = stored(least, "least")
        # large star: larger neighbours move to the smallest neighbour
        large = pairs.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v"))
        large = stored(large.unionByName(least.where("u <> m").select("u", F.col("m").alias("v"))).distinct(), "large")
        # small star: smaller neighbours of a node meet at the smallest
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        pairs = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = state(pairs)
        if now == before:
            break
        before = now
    else:
        if before[0]:
            raise RuntimeError("components did not settle")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, bits: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id), one row per input row.

    root is the smallest fingerprint of the component, component_id its smallest
    doc_id. Null text counts as empty; texts without words share fingerprint 0 and so
    one component; repeated rows and equal texts share a fingerprint; a null doc_id is
    never smallest unless the component has no other (then null). Other columns,
    whatever their names, are not read. An empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, text, key, shingle, seed), "prints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    roots = components(links(distinct, bits))
    of = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    of = stored(of, "roots")
    ids = stored(of.groupBy("root").agg(F.min("low").alias("component_id")), "ids")
    named = stored(of.select("fp", "root").join(ids, "root"), "named")
    return prints.join(named, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", **settings) -> DataFrame:
    """The rows of docs that stand for their component: the one with the smallest doc_id.

    Where several texts have that doc_id, or a component has no ids, the text of smallest
    hash stays; among rows repeated with equal id and text, the one with the smallest
    values of the other columns. Columns are those of docs. Texts move once, in the join,
    or not at all where the keepers are few; only repeated rows are grouped.
    """
    found = near_duplicates(docs, text, key, **settings).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    texts = found.groupBy("root", "text_key", "doc_id").agg(F.count("*").alias("copies"))
    one = texts.groupBy("root").agg(F.min(F.struct("text_key", "doc_id", "copies")).alias("k"))
    keepers = stored(one.select("k.*"), "keepers")
    rows, (of_key, of_text) = numbered(docs, key, text)
    same = F.col(of_key).eqNullSafe(F.col("doc_id")) & (F.xxhash64(of_text) == F.col("text_key"))
    kept = rows.join(keepers, same)
    order = [of_text, *[c for c in rows.columns if c != of_text]]
    repeated = kept.where("copies > 1").groupBy("doc_id", "text_key").agg(F.min(F.struct(*order)).alias("r")).select("r.*")
    return renamed(kept.where("copies = 1").select(*order).unionByName(repeated.select(*order)), docs)
