"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of two hashed rows, of the word and of its first four
bytes. Filters of several widths run over the whole text, max pooling keeps the
strongest response of each, and a logistic layer gives the score. Language is not an
input; it only chooses the calibrated threshold of `flagged`.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.common import map_batches, stored
from docketry.llm.decontaminate import words_of

WORDS, HEADS, SIZE = 1 << 17, 1 << 15, 8
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS) - 1

_seen: dict[bytes, int] = {}


def word_id(word: bytes) -> int:
    """Rows of both tables in one number, 0 kept for padding; remembered per process up to a million words."""
    if len(_seen) > 1_000_000:
        _seen.clear()
    found = (1 + zlib.crc32(word) % (WORDS - 1)) * HEADS + 1 + zlib.crc32(word[:4], 7) % (HEADS - 1)
    _seen[word] = found
    return found


def ids_of(text: str | None) -> np.ndarray:
    """Ids of a text's words, at least one, and padding behind them."""
    get = _seen.get
    ids = [get(w) or word_id(w) for w in words_of(text)] or [0]
    return np.array(ids + [0] * PAD, np.int64)


@dataclass
class Net:
    words: np.ndarray  # (WORDS, SIZE)
    heads: np.ndarray  # (HEADS, SIZE)
    filters: list[np.ndarray]  # per width (width, SIZE, number)
    offsets: list[np.ndarray]  # per width (number,)
    out: np.ndarray
    bias: float
    aside: bool = False  # whether a fifth of the labelled ids was kept for the thresholds

    def embed(self, ids: np.ndarray) -> np.ndarray:
        return self.words[ids // HEADS] + self.heads[ids % HEADS]

    def responses(self, emb: np.ndarray) -> np.ndarray:
        """Filter responses at each position but the padding of the last text."""
        n = len(emb) - PAD
        every = [sum(emb[j : j + n] @ k[j] for j in range(len(k))) + b for k, b in zip(self.filters, self.offsets, strict=True)]
        return np.concatenate(every, axis=1)

    def pooled(self, texts: list[np.ndarray]) -> np.ndarray:
        """(text, filter): largest response of each filter over the whole text."""
        ids = np.concatenate(texts)
        lengths = np.array([len(t) for t in texts])
        r = self.responses(self.embed(ids))
        stops = np.cumsum(lengths)
        for p in range(1, PAD + 1):  # windows that start in padding reach into the next text
            r[stops[:-1] - p] = -np.inf
        return np.maximum.reduceat(r, stops - lengths, axis=0)

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        return np.maximum(self.pooled(texts), 0) @ self.out + self.bias


def start_net(texts: list[np.ndarray], marks: np.ndarray, number: int, rng: np.random.Generator) -> Net:
    """First component of each row: smoothed log-odds of its texts being toxic; the rest small random values."""
    tables = []
    for size, part in ((WORDS, lambda t: t // HEADS), (HEADS, lambda t: t % HEADS)):
        counts = np.zeros((2, size))
        for ids, mark in zip(texts, marks, strict=True):
            counts[int(mark), np.unique(part(ids))] += 1
        odds = np.log((counts[1] + 3) / (counts[0] + 3)) - np.log((marks.sum() + 6) / ((~marks).sum() + 6))
        table = rng.normal(0, 0.02, (size, SIZE)).astype(np.float32)
        table[:, 0] = np.clip(odds, -3, 3) / 3 * (counts.sum(axis=0) > 1)
        table[0] = 0
        tables.append(table)
    filters = [rng.normal(0, 0.3, (w, SIZE, number)).astype(np.float32) for w in WIDTHS]
    for k in filters:
        k[:, 0, : number // 2] += 1
    return Net(*tables, filters, [np.zeros(number, np.float32) for _ in WIDTHS], rng.normal(0.5, 0.1, number * len(WIDTHS)).astype(np.float32), -1.0)


def fit(texts: list[np.ndarray], marks: np.ndarray, number: int = 6, epochs: int = 10, rate: float = 0.05, decay: float = 1e-4, batch: int = 32, seed: int = 3) -> Net:
    """Logistic loss by Adagrad. Max pooling sends each filter's gradient to one window per text."""
    rng = np.random.default_rng(seed)
    net = start_net(texts, marks, number, rng)
    touched = [np.zeros(WORDS, bool), np.zeros(HEADS, bool)]
    sums = {id(p): np.full(p.shape, 1e-3, np.float32) for p in (net.words, net.heads, net.out, *net.filters, *net.offsets)}
    bias_sum = 1e-3

    def step(p, rows, grad):
        s = sums[id(p)]
        if rows is None:
            s += grad * grad
            p -= rate * (grad / np.sqrt(s) + decay * p)
        else:
            uniq, inverse = np.unique(rows, return_inverse=True)
            g = np.zeros((len(uniq), p.shape[1]), np.float32)
            np.add.at(g, inverse, grad)
            s[uniq] += g * g
            p[uniq] -= rate * g / np.sqrt(s[uniq])
            p[0] = 0

    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            group = order[at : at + batch]
            tops, wins = [], []
            for i in group:
                r = net.responses(net.embed(texts[i]))
                where = r.argmax(axis=0)
                tops.append(r[where, np.arange(r.shape[1])])
                wins.append(where)
            top = np.array(tops)
            hidden = np.maximum(top, 0)
            off = (1 / (1 + np.exp(-(hidden @ net.out + net.bias))) - marks[group]) / len(group)
            back = off[:, None] * net.out[None, :] * (top > 0)
            rows_w, rows_h, grads = [], [], []
            slopes = [np.zeros_like(k) for k in net.filters]
            for b, i in enumerate(group):
                for f in np.flatnonzero(back[b]):
                    w, n = divmod(int(f), number)
                    ids = texts[i][wins[b][f] : wins[b][f] + WIDTHS[w]]
                    slopes[w][:, :, n] += back[b, f] * net.embed(ids)
                    rows_w.append(ids // HEADS)
                    rows_h.append(ids % HEADS)
                    grads.append(back[b, f] * net.filters[w][:, :, n])
            step(net.out, None, hidden.T @ off)
            bias_sum += off.sum() ** 2
            net.bias -= rate * off.sum() / np.sqrt(bias_sum)
            for w, k in enumerate(net.filters):
                step(k, None, slopes[w])
                step(net.offsets[w], None, back[:, w * number : (w + 1) * number].sum(axis=0))
            if grads:
                for table, rows, seen in ((net.words, rows_w, touched[0]), (net.heads, rows_h, touched[1])):
                    rows = np.concatenate(rows)
                    step(table, rows, np.concatenate(grads))
                    seen[rows] = True
    for table, seen in ((net.words, touched[0]), (net.heads, touched[1])):
        table[~seen, 1:] = 0  # random starts that no text has moved
    return net


def best_cuts(rows: DataFrame, groups: list[str], limit: float = 20.0, bins: int = 16) -> DataFrame:
    """Per group of rows (groups, z, toxic): the cut of highest F1, midway between the z around it, n_toxic and n_clean.

    Counted over all rows; no cut without both kinds. z is taken within `limit`. Sums
    over parts of z, `bins` per unit, come first, so that no task holds a whole group.
    """
    z = F.greatest(F.least("z", F.lit(limit)), F.lit(-limit)).alias("z")
    sums = rows.select(*groups, z, F.col("toxic").cast("long").alias("y")).groupBy(*groups, "z").agg(F.sum("y").alias("hits"), F.sum(1 - F.col("y")).alias("false"))
    sums = stored(sums.withColumn("bin", F.floor(F.col("z") * bins)), "toxicity-cuts")
    ahead = Window.partitionBy(*groups).orderBy(F.desc("bin"))  # a row per bin: at most 2 * limit * bins + 1
    whole, before = Window.partitionBy(*groups), ahead.rowsBetween(Window.unboundedPreceding, -1)
    parts = sums.groupBy(*groups, "bin").agg(F.sum("hits").alias("h"), F.sum("false").alias("f"), F.max("z").alias("top"))
    parts = parts.select(
        *groups,
        "bin",
        F.coalesce(F.sum("h").over(before), F.lit(0)).alias("h"),
        F.coalesce(F.sum("f").over(before), F.lit(0)).alias("f"),
        F.lead("top").over(ahead).alias("next"),
        F.sum("h").over(whole).alias("n_toxic"),
        F.sum("f").over(whole).alias("n_clean"),
    )
    within = Window.partitionBy(*groups, "bin").orderBy(F.desc("z"))
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    hits, false = F.col("h") + F.sum("hits").over(upto), F.col("f") + F.sum("false").over(upto)
    below = F.coalesce(F.lead("z").over(within), "next", F.lit(-limit))
    cuts = sums.join(parts, [*groups, "bin"]).select(
        *groups, "z", "n_toxic", "n_clean", ((F.col("z") + below) / 2).alias("cut"), (2 * hits / (hits + false + F.col("n_toxic"))).alias("f1")
    )
    best = cuts.where("n_toxic > 0 and n_clean > 0").groupBy(*groups)
    return best.agg(F.max_by("cut", F.struct("f1", "z")).alias("cut"), F.max("n_toxic").alias("n_toxic"), F.max("n_clean").alias("n_clean"))


def held_out(key: str = "doc_id") -> Column:
    """True for the fold that is never learned from; rows without an id belong to it."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{key}`").cast("string")), F.lit(5)) == 0, F.lit(True))


def marked_ids(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(id, t) of all labelled ids outside the held-out fold; ids with contradicting labels are left out."""
    marked = labels.select(F.col(f"`{key}`").alias("id"), F.col("toxic").alias("toxic")).where("id is not null and toxic is not null")
    return marked.where(~held_out("id")).groupBy("id").agg(F.min("toxic").alias("t"), F.max("toxic").alias("most")).where("t = most").select("id", "t")


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", sample: int = 2000, **settings) -> Net | None:
    """Net from at most `sample` labelled ids of each kind, and twice as many distinct texts, in hash order, outside the held-out fold.

    A fifth of the ids, by hash, is left to the thresholds. None without labels of both kinds.
    """
    marked = marked_ids(labels, key)
    picked = [marked.where(F.col("t") == t).orderBy(F.xxhash64("id"), "id").limit(sample) for t in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.join(F.broadcast(chosen), "id").select("id", "text", "lang", "t", F.xxhash64("id").alias("h"))  # at most 2 * sample ids
    data = rows.distinct().orderBy("h", "id", "text", "lang").limit(2 * sample).collect()  # repeated rows are learned from once
    marks = np.array([r["t"] == 1 for r in data], bool)
    if not len(data) or marks.all() or not marks.any():
        return None
    texts = [ids_of(r["text"]) for r in data]
    aside = np.array([r["h"] % 5 == 0 for r in data])
    if marks[~aside].all() or not marks[~aside].any():
        aside[:] = False
    net = fit([t for t, a in zip(texts, aside, strict=True) if not a], marks[~aside], **settings)
    net.aside = bool(aside.any())
    return net


def thresholds(scored: DataFrame, labels: DataFrame, net: Net, key: str = "doc_id", least: int = 10) -> tuple[float, DataFrame]:
    """(cut of all languages, (l, cut) of languages with `least` texts of each kind), from all labelled rows that the net has not seen.

    scored: doc_id, lang, z, digest of the text; repeated rows count once.
    """
    rows = scored.withColumnRenamed("doc_id", "id").join(marked_ids(labels, key).where("t in (0, 1)"), "id")
    if net.aside:
        rows = rows.where(F.pmod(F.xxhash64("id"), F.lit(5)) == 0)
    rows = rows.groupBy("id", "lang", "digest", "t").agg(F.min("z").alias("z"))
    rows = rows.select(F.coalesce("lang", F.lit("")).alias("l"), "z", (F.col("t") == 1).alias("toxic"))
    every = rows.select(F.lit(True).alias("whole"), F.lit("").alias("l"), "z", "toxic").unionByName(rows.select(F.lit(False).alias("whole"), "*"))
    cuts = stored(best_cuts(every, ["whole", "l"]), "toxicity-thresholds")
    whole = cuts.where("whole").first()  # one row
    return whole["cut"] if whole else 0.0, cuts.where(~F.col("whole") & (F.least("n_toxic", "n_clean") >= least)).select("l", "cut")


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", **settings) -> DataFrame:
    """doc_id, lang, held_out, score, predicted, flagged, one row per input row.

    score is 0 to 1 from the words of the whole text alone; predicted is 1 from 0.5 on;
    flagged compares the score with its language's threshold, or with that of all
    languages where one is too rare. Null text counts as empty, whose score is that of
    no words; repeated rows score alike; other columns are not read. Without labels of
    both kinds every score is 0.
    """
    net = train(docs, labels, text, key, lang, **settings)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # tables of fixed size, about 5 MB

    def make(keys, langs, texts):
        net = shared.value
        if net is None:
            return keys, langs, [None] * len(texts), [0] * len(texts)
        logits: list[float] = []
        group: list[np.ndarray] = []
        for t in texts:
            group.append(ids_of(t))
            if sum(map(len, group)) > 100_000:
                logits += net.logits(group).tolist()
                group = []
        if group:
            logits += net.logits(group).tolist()
        return keys, langs, logits, [zlib.crc32((t or "").encode()) << 31 ^ len(t or "") for t in texts]

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    found = map_batches(narrow, ["doc_id", "lang", "text"], "text", make, f"doc_id {kind}, lang string, z double, digest long")
    rows = ["doc_id", "lang", held_out("doc_id").alias("held_out")]
    if net is None:
        return found.select(*rows, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(False).alias("flagged"))
    found = stored(found, "toxicity-scores")  # narrow; read once for the thresholds, once for the result
    shift, by_lang = thresholds(found, labels, net, key)
    score = 1 / (1 + F.exp(shift - F.col("z")))  # 0.5 is the best cut over all languages
    found = found.join(by_lang, F.coalesce("lang", F.lit("")) == F.col("l"), "left")
    return found.select(*rows, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), (F.col("z") >= F.coalesce("cut", F.lit(shift))).alias("flagged"))
