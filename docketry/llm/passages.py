"""Substring dedup by repeated-phrase automata.

Every window of 35 words is known by its seed, the 18-word phrase of least hash in it
(so equal windows have equal seeds). Seeds that stand at one place only are dropped;
the windows around the others are counted exactly, and those found at two places are
confirmed. Documents are packed into blocks; each block's confirmed passages are
compiled into an Aho-Corasick automaton over word numbers, and all its documents are
streamed through it to locate every occurrence.

A corpus-wide count gets each distinct seed or window of a block once, so a hot
phrase is at most one row per block, and its answer comes back by position.
"""

from __future__ import annotations

from itertools import compress

import ahocorasick
import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketry.llm.blocks import packed, per_block, stored_blocks, unpack_texts
from docketry.llm.common import sha256, stored

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers of the rolling hashes
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LONG = 4096  # bytes from which a word is hashed alone
POWERS = np.cumprod(np.full(LONG + 1, 0xD6E8FEB86659FD93, np.uint64), dtype=np.uint64)


def word_hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray, piece: int = 1 << 16) -> np.ndarray:
    """64-bit hash of each run of bytes: a polynomial over its bytes, mixed with its length."""
    lengths = stops - starts
    out = np.zeros(len(starts), np.uint64)
    for i in np.flatnonzero(lengths > LONG).tolist():
        out[i] = xxhash.xxh64_intdigest(raw[starts[i] : stops[i]].tobytes())
    usual = np.flatnonzero(lengths <= LONG)
    total = np.cumsum(lengths[usual])
    cuts = np.searchsorted(total, np.arange(piece, total[-1] if len(total) else 0, piece))
    for part in np.split(usual, np.unique(cuts)):  # bounded memory
        if not len(part):
            continue
        n = lengths[part]
        first = np.cumsum(n) - n
        inside = np.arange(n.sum()) - np.repeat(first, n)
        values = (raw[np.repeat(starts[part], n) + inside].astype(np.uint64) + np.uint64(1)) * POWERS[inside]
        h = np.add.reduceat(values, first) ^ (n.astype(np.uint64) * np.uint64(BASES[1]))
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        out[part] = h ^ (h >> np.uint64(32))
    return out


class Words:
    """Hashes of all words of some texts in a row, and where each text's words start and end."""

    def __init__(self, texts: list[str]):
        self.raw = [t.encode() for t in texts]
        joined = np.frombuffer(b"\n".join([*self.raw, b""]), np.uint8)
        solid = ~SPACE[joined]
        edge = np.flatnonzero(np.diff(solid.view(np.int8), prepend=np.int8(0)))
        self.hashes = word_hashes(joined, edge[::2], edge[1::2])
        self.ends = np.searchsorted(edge[::2], np.cumsum([len(r) + 1 for r in self.raw]))
        self.starts = np.concatenate(([0], self.ends[:-1]))

    def rolling(self, size: int, base: int) -> np.ndarray:
        """Hash of each run of `size` words, by position of its first word: sum of hash * base^j modulo 2^64."""
        n = len(self.hashes)
        if n < size:
            return np.empty(0, np.uint64)
        powers = np.cumprod(np.full(n, base, np.uint64), dtype=np.uint64)
        back = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64), dtype=np.uint64)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.hashes * powers, dtype=np.uint64)))
        return (sums[size:] - sums[:-size]) * back[: n - size + 1]

    def windows(self, size: int) -> np.ndarray:
        """Positions of windows of `size` words inside one text."""
        counts = np.maximum(self.ends - self.starts - size + 1, 0)
        first = np.repeat(self.starts - (np.cumsum(counts) - counts), counts)
        return first + np.arange(counts.sum())


def seeds(words: Words, size: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window positions, index of each one's seed, distinct seeds, places of each seed up to 2)."""
    at = words.windows(size)
    if not len(at):
        return at, np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    rolled = words.rolling(seed, BASES[0])
    wide = size - seed + 1
    place = np.empty(len(at), np.int64)
    view = np.lib.stride_tricks.sliding_window_view(rolled, wide)
    for i in range(0, len(at), 1 << 16):  # bounded memory for long texts
        part = at[i : i + (1 << 16)]
        place[i : i + (1 << 16)] = part + view[part].argmin(axis=1)
    places, of = np.unique(place, return_inverse=True)
    found, which, counts = np.unique(rolled[places], return_inverse=True, return_counts=True)
    return at, which[of], found, np.minimum(counts, 2)


def window_hashes(words: Words, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first hash, second hash, places up to 2) of the distinct windows at `at`, and the index of each position's."""
    one = words.rolling(size, BASES[0])[at] if len(at) else np.empty(0, np.uint64)
    found, first, which, counts = np.unique(one, return_index=True, return_inverse=True, return_counts=True)
    two = words.rolling(size, BASES[1])[at[first]] if len(at) else one
    return found, two, np.minimum(counts, 2), which


def confirmed(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(block, places): per block the positions whose key has at least two places in the corpus."""
    total = F.sum("n").over(W.partitionBy(*keys))  # a key is one row per block at most
    twice = rows.withColumn("total", total).where("total > 1")
    return stored(twice.groupBy("block").agg(F.collect_list("at").alias("places")), name)  # bounded by the block


def covered(words: Words, at: np.ndarray, size: int) -> np.ndarray:
    """Flag per word: inside an occurrence of a confirmed passage, a run of confirmed windows at positions `at`."""
    inside = np.zeros(len(words.hashes), bool)
    if not len(at):
        return inside
    text = np.searchsorted(words.ends, at, side="right")
    cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(text) > 0)) + 1
    numbers = np.unique(words.hashes, return_inverse=True)[1]
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for run in np.split(at, cut):
        automaton.add_word(tuple(numbers[run[0] : run[-1] + size].tolist()))
    automaton.make_automaton()
    for a, b in zip(words.starts.tolist(), words.ends.tolist(), strict=True):
        if b - a < size:
            continue
        change = np.zeros(b - a + 1, np.int64)
        for end, length in automaton.iter(tuple(numbers[a:b].tolist())):
            change[end + 1 - length] += 1
            change[end + 1] -= 1
        inside[a:b] = np.cumsum(change[:-1]) > 0
    return inside


def substring_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 35, seed: int = 18, most: int = 4_000_000) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256), one row per input row.

    A word goes if it lies in a window of `size` words whose word sequence starts at
    another place too, in any row, the same included. Windows are judged on the input.
    kept holds the other words, unchanged, joined by one space.

    Null text has no words; texts shorter than a window stay whole; repeated rows are
    places of their own, so equal long texts are removed alike; ids may be null; other
    columns are not read; an empty table gives an empty result. Windows are compared by
    two 64-bit hashes.
    """
    kind = docs.schema[key].dataType.simpleString()

    def first(texts):
        _, _, found, places = seeds(Words(texts), size, seed)
        return [found.view(np.int64), places]

    made = packed(docs, {"ids": key}, text, first, "seeds array<bigint>, counts array<int>", most)
    blocks = stored_blocks(made, "passage_blocks")
    rows = blocks.select("block", F.posexplode(F.arrays_zip("seeds", "counts")).alias("at", "s")).select("block", "at", "s.seeds", F.col("s.counts").alias("n"))
    repeated = confirmed(rows, ["seeds"], "passage-seeds")
    texts = blocks.select("block", "ids", "lengths", "payload")

    def values(x) -> np.ndarray:
        return x.values.to_numpy() if x.is_valid else np.empty(0, np.int64)

    def candidates(words: Words, places: np.ndarray) -> np.ndarray:
        at, which, found, _ = seeds(words, size, seed)
        live = np.zeros(len(found), bool)
        live[places] = True
        return at[live[which]]

    def count(row) -> list:
        words = Words(unpack_texts(row["payload"].as_py(), row["lengths"].values.to_pylist()))
        one, two, n, _ = window_hashes(words, candidates(words, values(row["places"])), size)
        return [np.full(len(one), row["block"].as_py()), np.arange(len(one), dtype=np.int32), one.view(np.int64), two.view(np.int64), n]

    wide = per_block(texts.join(repeated, "block"), count, "block bigint, at int, one bigint, two bigint, n int")
    found = confirmed(wide, ["one", "two"], "passage-windows")

    def cut(row) -> list:
        words = Words(unpack_texts(row["payload"].as_py(), row["lengths"].values.to_pylist()))
        near = candidates(words, values(row["places"]))
        *_, which = window_hashes(words, near, size)
        live = np.zeros(which.max(initial=-1) + 1, bool)
        live[values(row["windows"])] = True
        gone = covered(words, near[live[which]], size)
        kept, removed = [], []
        for raw, a, b in zip(words.raw, words.starts.tolist(), words.ends.tolist(), strict=True):
            left, here = raw.split(), gone[a:b]
            removed.append(int(here.sum()))
            kept.append(b" ".join(compress(left, (~here).tolist()) if removed[-1] else left).decode())
        return [row["ids"].values, words.ends - words.starts, removed, kept, [sha256(k) for k in kept]]

    every = texts.join(repeated, "block", "left").join(found.withColumnRenamed("places", "windows"), "block", "left")
    return per_block(every, cut, f"doc_id {kind}, n_words bigint, n_removed bigint, kept string, kept_sha256 string")
