"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of character n-grams.

The model is trained on the texts that labels trust. Counts, contexts and
probabilities are tables, sharded by n-gram or context and joined by key. Texts are
packed into blocks; a block sends each of its distinct n-grams once to the join and
gets their log-probabilities back by position, so the rows that move grow with the
number of blocks, not with the number of characters. Per language, quantiles of the
perplexity of trusted texts that the model has not seen set the accepted range.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.blocks import packed, per_block, stored_blocks, unpack_texts
from docketry.llm.common import stored

# An n-gram is two longs, g and h: of each symbol, the low 12 bits are in g and the high 9 in h, which is 0 for most scripts' text.
BITS, HIGH_BITS = 12, 9
#: An answer is one long: the place of an n-gram in its block, and minus its log-probability (a double above 0 has below 746) in steps of 2**-22.
COST_BITS = 22
CODEC = "zstd"  # of the written tables, which count as disk
#: Keys are nearly all distinct: a dictionary of them would be written beside what it stands for.
PLAIN = {"parquet.enable.dictionary": "false"}
EDGE = 0  # the boundary before and after a text; other symbols are code points plus 1


def symbols(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts with order - 1 boundaries before each and behind the last, and the text's number per event.

    Letters are lowered, digits alike, runs of white space one space. Events are a
    text's symbols and the boundary that ends it; elsewhere the number is -1.
    """
    gap = "\udfff"  # stands for the boundary: half a surrogate pair, which no text holds
    joined = gap + gap.join(t.lower() for t in texts) + gap
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where((code >= 48) & (code <= 57), 48, np.where((code == 32) | ((code >= 9) & (code <= 13)), 32, code))
    code = code[np.concatenate(([True], ~((code[1:] == 32) & (code[:-1] == 32))))]
    edge = code == ord(gap)
    number = np.cumsum(edge) - 1 - edge  # an edge ends the text before it
    sym = np.where(edge, EDGE, 1 + code.astype(np.int32))
    repeat = np.where(edge, order - 1, 1)
    out = np.repeat(sym, repeat)
    first = np.cumsum(repeat) - repeat
    events = np.full(len(out), -1, np.int32)
    events[first] = number
    return out, events


def _numbered(code: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct codes below `size`, index of each code); by a table of flags where it stays small."""
    if size > 1 << 25:
        return np.unique(code, return_inverse=True)
    seen = np.zeros(size, bool)
    seen[code] = True
    found = np.flatnonzero(seen)
    place = np.zeros(size, np.int32)
    place[found] = np.arange(len(found), dtype=np.int32)
    return found, place[code]


def grams(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(g and h of the distinct n-grams, index per event, text number per event). Same texts, same order of n-grams."""
    sym, events = symbols(texts, order)
    names, one = _numbered(sym, 1 << BITS + HIGH_BITS)
    low, high = names & ((1 << BITS) - 1), names >> BITS
    first_low, first_high, dense, size = low, high, one, len(names)
    live = events >= 0
    for k in range(2, order + 1):
        wide = np.int32 if len(low) * size < 1 << 31 else np.int64
        code = one[:-1].astype(wide) * wide(size) + dense[k - 1 :]
        if k == order:
            code = code[live[k - 1 :]]
        found, one = _numbered(code, len(low) * size)
        before, last = found // size, found % size
        low, high = (low[before] << BITS) | first_low[last], (high[before] << HIGH_BITS) | first_high[last]
    return low, high, one, events[order - 1 :][live[order - 1 :]]


def unique_pairs(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(g and h of the distinct n-grams sorted by h, then g; the index of each one given). Those with h = 0 are sorted by g alone."""
    flat = high == 0
    found, at_found = np.unique(low[flat], return_inverse=True)
    order = np.lexsort((low[~flat], high[~flat]))
    g, h = low[~flat][order], high[~flat][order]
    new = np.ones(len(order), bool)
    new[1:] = (g[1:] != g[:-1]) | (h[1:] != h[:-1])
    rest = np.empty(len(order), np.int64)
    rest[order] = np.cumsum(new) - 1
    at = np.empty(len(low), np.int64)
    at[flat], at[~flat] = at_found, len(found) + rest
    return np.concatenate((found, g[new])), np.concatenate((np.zeros(len(found), np.int64), h[new])), at


def places_of(low: np.ndarray, high: np.ndarray, names: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Index of each n-gram given among sorted `names` that hold it."""
    flat, n = high == 0, int(np.searchsorted(names[1], 1))
    at = np.empty(len(low), np.int64)
    at[flat] = np.searchsorted(names[0][:n], low[flat])
    rest = unique_pairs(np.concatenate((names[0][n:], low[~flat])), np.concatenate((names[1][n:], high[~flat])))[2]
    at[~flat] = n + rest[len(names[0]) - n :]
    return at


def pieces(texts: list[str], most: int = 1_500_000) -> Iterator[tuple[int, list[str]]]:
    """(number of the first text, texts) of about `most` characters: bounds the arrays of a block."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield start, texts[start:i]
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, texts[start:]


def distinct_grams(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted g and h of the n-grams of the texts."""
    return gram_counts(texts, order)[:2]


def gram_counts(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted g and h of the n-grams, how often each occurs)."""
    lows, highs, counts = ([np.empty(0, np.int64)] for _ in range(3))
    for _, part in pieces(texts):
        low, high, at, _ = grams(part, order)
        lows.append(low)
        highs.append(high)
        counts.append(np.bincount(at, minlength=len(low)))
    low, high, which = unique_pairs(np.concatenate(lows), np.concatenate(highs))
    return low, high, np.bincount(which, np.concatenate(counts), len(low)).astype(np.int64)


def text_sums(texts: list[str], order: int, names: tuple[np.ndarray, np.ndarray], values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(events, sum of values) per text; `values` belong to the sorted g and h in `names`."""
    events, sums = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    for first, part in pieces(texts):
        low, high, at, number = grams(part, order)
        here = slice(first, first + len(part))
        events[here] = np.bincount(number, minlength=len(part))
        sums[here] = np.bincount(number, values[places_of(low, high, names)][at], len(part))
    return events, sums


def suffix(k: int, g: str = "g", h: str = "h") -> list[Column]:
    """The last k symbols, as columns g and h by the names given."""
    return [F.col("g").bitwiseAND(F.lit((1 << (BITS * k)) - 1)).alias(g), F.col("h").bitwiseAND(F.lit((1 << (HIGH_BITS * k)) - 1)).alias(h)]


def context() -> list[Column]:
    return [F.shiftrightunsigned("g", BITS).alias("ctx"), F.shiftrightunsigned("h", HIGH_BITS).alias("ctx_h")]


def with_high(rows: DataFrame) -> DataFrame:
    """Rows with an h, 0 where there is none."""
    return rows if "h" in rows.columns else rows.withColumn("h", F.lit(0).cast("long"))


def sorted_table(rows: DataFrame, name: str, *keys: str) -> DataFrame:
    """Rows written in the order of their keys, file by file: neighbours share most bytes, in the files and in later shuffles."""
    return stored(rows.sortWithinPartitions(*keys), name, CODEC, **PLAIN)


@dataclass(frozen=True)
class Level:
    """Model tables of one order: counts (g, h, c), contexts (ctx, ctx_h, total, k1, k2, k3), and the three discounts."""

    counts: DataFrame
    contexts: DataFrame
    discounts: tuple[float, float, float]


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the counts of counts; kept within 0 and the count they are taken from."""
    of = counts.agg(*[F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in range(1, 5)]).first()
    n1, n2, n3, n4 = (float(x) for x in of)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw))


def levels(top: DataFrame, order: int) -> list[Level]:
    """Model tables from order 1 to `order`: raw counts at the top, below the number of distinct left neighbours."""
    out = []
    counts = with_high(top)
    for k in range(order, 0, -1):
        if k < order:
            counts = sorted_table(counts.groupBy(*suffix(k)).agg(F.count("*").alias("c")), f"kn-counts-{k}", "h", "g")
        kinds = [F.count(F.when(F.col("c") == i, 1)).alias(f"k{i}") for i in (1, 2)] + [F.count(F.when(F.col("c") > 2, 1)).alias("k3")]
        contexts = counts.groupBy(*context()).agg(F.sum("c").alias("total"), *kinds)
        out.append(Level(counts, sorted_table(contexts, f"kn-contexts-{k}", "ctx_h", "ctx"), discounts(counts)))
    return out[::-1]


def log_probabilities(wanted: DataFrame, model: list[Level]) -> DataFrame:
    """(g, h, logp) for every wanted n-gram: one join with the counts, one with the contexts, one with the order below."""
    order = len(model)
    wanted, below = with_high(wanted), None
    for k, level in enumerate(model, 1):
        asked = wanted if k == order else wanted.select(*suffix(k)).distinct()
        rows = asked.join(level.counts, ["g", "h"], "left").select("*", *context()).join(level.contexts, ["ctx", "ctx_h"], "left")
        if below is None:
            kinds = level.counts.count() + 1
            rows = rows.withColumn("lower", F.lit(1.0 / kinds))
        else:
            lower = below.select(F.col("g").alias("tail"), F.col("h").alias("tail_h"), F.col("p").alias("lower"))
            rows = rows.select("*", *suffix(k - 1, "tail", "tail_h")).join(lower, ["tail", "tail_h"])
        d1, d2, d3 = level.discounts
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        own = F.coalesce((F.col("c") - cut) / F.col("total"), F.lit(0.0))
        spare = (d1 * F.col("k1") + d2 * F.col("k2") + d3 * F.col("k3")) / F.col("total")
        below = rows.select("g", "h", F.when(F.col("total").isNull(), F.col("lower")).otherwise(own + spare * F.col("lower")).alias("p"))
        if k < order:
            below = sorted_table(below, f"kn-order-{k}", "h", "g")
    return below.select("g", "h", F.log("p").alias("logp"))


def _values(x):
    return x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.empty(0)


def perplexities(docs: DataFrame, labels: DataFrame, text: str, key: str, lang: str, order: int, most: int) -> DataFrame:
    """(doc_id, lang, role, n_symbols, logp): role 1 trains, 2 calibrates, 0 neither."""
    kind = docs.schema[key].dataType.simpleString()
    made = packed(docs, {"ids": key, "langs": lang}, text, lambda texts: distinct_grams(texts, order), "grams array<bigint>, highs array<bigint>", most)
    blocks = stored_blocks(made, "kn_blocks", CODEC)

    trusted = labels.where("quality is not null").groupBy(F.col(f"`{key}`").alias("id")).agg(F.min("quality").alias("q")).where("q = 1 and id is not null")
    role = F.when(F.pmod(F.xxhash64("id"), F.lit(5)) == 0, 2).otherwise(1)
    places = blocks.select("block", F.posexplode("ids").alias("at", "id"))
    roles = places.join(trusted.select("id", role.alias("role")), "id").groupBy("block")  # a block's rows are bounded by its size
    roles = roles.agg(F.collect_list(F.struct("at", "role")).alias("r"))
    roles = stored(roles.select("block", F.col("r.at").alias("at"), F.col("r.role").alias("role")), "kn-roles")
    known = blocks.join(roles, "block", "left")

    def roles_of(row) -> np.ndarray:
        out = np.zeros(len(row["lengths"].values), np.int32)
        if row["at"].is_valid:
            out[_values(row["at"]).astype(np.int64)] = _values(row["role"])
        return out

    def texts_of(row) -> list[str]:
        return unpack_texts(row["payload"].as_py(), row["lengths"].values.to_pylist())

    def count(row) -> list:
        return list(gram_counts([t for t, r in zip(texts_of(row), roles_of(row), strict=True) if r == 1], order))

    trained = per_block(known.select("block", "lengths", "payload", "at", "role"), count, "g bigint, h bigint, n bigint")
    top = sorted_table(trained.groupBy("g", "h").agg(F.sum("n").alias("c")), "kn-counts", "h", "g")
    asked = blocks.select("block", F.posexplode(F.arrays_zip("grams", "highs")).alias("at", "s"))
    asked = asked.select("block", "at", F.col("s.grams").alias("g"), F.col("s.highs").alias("h"))
    wanted = sorted_table(asked.select("g", "h").distinct(), "kn-wanted", "h", "g")
    cost = F.round(-F.col("logp") * float(1 << COST_BITS)).cast("long")
    found = stored(log_probabilities(wanted, levels(top, order)).select("g", "h", cost.alias("cost")), "kn-costs", CODEC)

    answers = asked.join(found, ["g", "h"]).groupBy("block")  # bounded by the distinct n-grams of a block
    answers = answers.agg(F.collect_list(F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("cost"))).alias("answers"))

    def score(row) -> list:
        answers = _values(row["answers"])
        logp = np.zeros(len(answers), np.float64)
        logp[answers >> 32] = (answers & 0xFFFFFFFF) / -float(1 << COST_BITS)
        events, sums = text_sums(texts_of(row), order, (row["grams"].values.to_numpy(), row["highs"].values.to_numpy()), logp)
        return [row["ids"].values, row["langs"].values, roles_of(row), events, sums]

    joined = known.join(answers, "block")
    return per_block(joined, score, f"doc_id {kind}, lang string, role int, n_symbols bigint, logp double")


def quality(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    lang: str = "lang",
    order: int = 5,
    quantiles: tuple[float, float] = (0.004, 0.996),
    least: int = 50,
    most: int = 12_000_000,
) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, low, high, kept, one row per input row.

    kept: the perplexity lies within the language's range, the quantiles of trusted texts
    held back from training; a language with fewer than `least` of them, null included,
    takes the range of all. A document is trusted if all its labels are 1.

    Null text counts as empty (one event, its end); repeated rows score alike; ids may
    be null; other columns are not read. Without trusted texts nothing is known: every
    symbol is equally likely and every row is kept. An empty table gives an empty result.
    """
    if not 2 <= order <= 5:
        raise ValueError("order must be 2 to 5: 21 bits a symbol in two longs")
    rows = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{lang}`").cast("string").alias(lang), F.col(f"`{text}`").alias(text))
    scored = stored(perplexities(rows, labels, text, key, lang, order, most), "kn-scores")
    scored = scored.withColumn("perplexity", F.exp(-F.col("logp") / F.col("n_symbols")))
    held = scored.where("role = 2")
    parts = [F.percentile_approx("perplexity", q, 10_000) for q in quantiles]
    by_lang = held.groupBy(F.coalesce("lang", F.lit("")).alias("l")).agg(parts[0].alias("low"), parts[1].alias("high"), F.count("*").alias("n"))
    whole = held.agg(*parts).first()  # two numbers
    by_lang = stored(by_lang.where(F.col("n") >= least).drop("n"), "kn-ranges")
    found = scored.join(by_lang, F.coalesce("lang", F.lit("")) == F.col("l"), "left")
    low, high = (F.coalesce(F.col(c), F.lit(w).cast("double")) for c, w in zip(("low", "high"), whole, strict=True))
    kept = F.coalesce(F.col("perplexity").between(low, high), F.lit(True))
    return found.select("doc_id", "lang", "n_symbols", "perplexity", low.alias("low"), high.alias("high"), kept.alias("kept"))
