"""Quality rules: text statistics, fixed base rules, and a decision list learned by sequential covering.

The list is learned on a bounded sample of labelled rows: rules that predict low
quality are grown condition by condition (information gain), pruned on held-out
rows, and appended while they pay; rows a rule covers leave the training set. The
result is one ordered CASE expression over the statistics, which Spark evaluates.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import SPACES, map_batches, numbered, renamed, small_batches

SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_shouts", "n_lines", "n_distinct"]
#: shares the rules may test, as (name, numerator, denominator)
SHARES = [
    ("symbol_share", "n_symbols", "word_chars"),
    ("word_length", "word_chars", "n_words"),
    ("upper_share", "n_upper", "word_chars"),
    ("shout_share", "n_shouts", "n_words"),
    ("repeat_share", "n_repeat_words", "n_words"),
    ("dup_line_share", "n_dup_lines", "n_lines"),
    ("distinct_share", "n_distinct", "n_words"),
]


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows found at least twice in the text."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    covered = 0  # end of what is counted so far
    total = 0
    for i, w in enumerate(windows):
        if count[w] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def text_counts(text: str | None) -> tuple[int, ...]:
    """Values of COUNTS for one whole text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if not x.isspace() and x]
    bytes_of = np.bincount(np.frombuffer(raw, np.uint8), minlength=128)
    return (
        len(words),
        len(text) - sum(int(bytes_of[ord(c)]) for c in SPACES),
        sum(int(bytes_of[ord(c)]) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        int(bytes_of[65:91].sum()),
        int(bytes_of[ord("!")]),
        len(lines),
        len(set(words)),
    )


def statistics(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, text_key and the counts, one row per input row. Null text counts as empty: all counts 0."""

    def make(keys, marks, texts):
        rows = [text_counts(t) for t in texts]
        return keys, marks, *([r[i] for r in rows] for i in range(len(COUNTS)))

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(f"`{key}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"), F.col(f"`{text}`").alias("text"))
    schema = f"doc_id {kind}, text_key long, " + ", ".join(f"{c} long" for c in COUNTS)
    return map_batches(narrow, ["doc_id", "text_key", "text"], "text", make, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def share(name: str) -> Column:
    _, above, below = next(s for s in SHARES if s[0] == name)
    return F.col(above) / F.greatest(F.col(below), F.lit(1))


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    at: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.name] > self.at if self.above else x[self.name] <= self.at

    def column(self) -> Column:
        return share(self.name) > self.at if self.above else share(self.name) <= self.at

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.at:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _gain(p0: int, n0: int, p: np.ndarray, n: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * (np.log2(np.maximum(p, 1e-9) / np.maximum(p + n, 1)) - np.log2(p0 / (p0 + n0))), -1)


def grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int) -> Rule:
    """Add the condition of highest information gain until no good row is covered."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < most and (n0 := int((inside & ~bad).sum())) and (p0 := int((inside & bad).sum())):
        best = (1e-9, None)
        for name, all_values in x.items():
            values, marks = all_values[inside], bad[inside]
            order = np.argsort(values, kind="stable")
            v, m = values[order], marks[order]
            cut = np.flatnonzero(v[1:] > v[:-1])
            if not len(cut):
                continue
            p_low, n_low = np.cumsum(m)[cut], np.cumsum(~m)[cut]
            for above, p, n in ((False, p_low, n_low), (True, p0 - p_low, n0 - n_low)):
                gain = _gain(p0, n0, p, n)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (float(gain[i]), Condition(name, above, float((v[cut[i]] + v[cut[i] + 1]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= best[1].holds(x)
    return tuple(rule)


def prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Cut conditions from the end while (bad - good) / covered on held-out rows does not fall."""

    def worth(r: Rule) -> float:
        inside = covers(r, x)
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        return (p - n) / max(1, p + n)

    return max((rule[:i] for i in range(len(rule), 0, -1)), key=worth) if rule else rule


def learn(x: dict[str, np.ndarray], bad: np.ndarray, conditions: int = 3, rules: int = 16, precision: float = 0.9) -> list[Rule]:
    """Ordered rules for bad rows. Two thirds of the rows grow a rule, a third prunes it (by position).

    Learning ends when a rule is right on less than `precision` of the pruning rows it covers.
    """
    third = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), bool)
    out: list[Rule] = []
    while len(out) < rules and (left & bad & ~third).any():
        grown = grow({k: v[left & ~third] for k, v in x.items()}, bad[left & ~third], conditions)
        held = left & third
        rule = prune(grown, {k: v[held] for k, v in x.items()}, bad[held])
        inside = covers(rule, x)
        p, n = int((inside & held & bad).sum()), int((inside & held & ~bad).sum())
        if not rule or p == 0 or p < precision * (p + n):
            break
        out.append(rule)
        left &= ~inside
    return out


def verdict(rules: list[Rule]) -> Column:
    """True for rows that no rule covers: ordered CASE over the counts."""
    out = None
    for rule in rules:
        test = rule[0].column()
        for c in rule[1:]:
            test &= c.column()
        out = F.when(test, False) if out is None else out.when(test, False)
    return F.lit(True) if out is None else out.otherwise(True)


def learn_rules(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", sample: int = 9000, **settings) -> list[Rule]:
    """Rules from at most `sample` labelled ids, and as many distinct texts, in hash order; low quality is label 0.

    Ids with contradicting labels, null labels and rows that the base rules reject are
    not learned from. Without labels of both kinds the list is empty: every row passes.
    """
    marked = labels.where("quality is not null").select(F.col(key).alias("doc_id"), "quality").where("doc_id is not null")
    marked = marked.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("most")).where("q = most")
    marked = marked.select("doc_id", "q").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    picked = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    chosen = picked.join(F.broadcast(marked.select("doc_id")), "doc_id", "left_semi")  # at most `sample` ids
    rows = statistics(chosen).join(F.broadcast(marked), "doc_id")
    rows = rows.where(~base_failed()).select("doc_id", "text_key", "q", *[share(s[0]).alias(s[0]) for s in SHARES])
    rows = rows.dropDuplicates(["doc_id", "text_key"]).orderBy(F.xxhash64("doc_id"), "doc_id", "text_key")
    table = rows.limit(sample).toArrow()
    if not table.num_rows:
        return []
    order = np.lexsort((table["text_key"].to_numpy(), table["doc_id"].to_numpy()))
    bad = (table["q"].to_numpy() == 0)[order]
    if bad.all() or not bad.any():
        return []
    return learn({s[0]: table[s[0]].to_numpy()[order] for s in SHARES}, bad, **settings)


def quality(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", **settings) -> DataFrame:
    """One row per input row: doc_id, text_key, the counts, base_failed, failed_rule (1 for the first), kept.

    Null text counts as empty and fails the base rules, as every text of fewer than 50
    words; repeated rows get equal verdicts; other columns are not read; an empty table
    gives an empty result, an empty label table a list without rules.
    """
    rules = learn_rules(docs, labels, text, key, **settings)
    number = F.lit(None).cast("int")
    for i in range(len(rules), 0, -1):
        number = F.when(~verdict([rules[i - 1]]), i).otherwise(number)
    rows = statistics(docs, text, key).withColumn("base_failed", base_failed())
    return rows.withColumn("failed_rule", F.when(~F.col("base_failed"), number)).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def keep_good(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Rows of docs that pass, columns as given: statistics travel beside the row, the verdict filters."""
    rules = learn_rules(docs, labels, **settings)
    return apply_rules(docs, rules)


def apply_rules(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """Filter without a shuffle: the counts are computed beside each whole row."""
    rows, (at,) = numbered(docs, text)
    wide = rows.withColumns({c: F.lit(0).cast("long") for c in COUNTS})
    width = len(docs.columns)

    def run(batches):
        for batch in small_batches(batches, at):
            found = [text_counts(t) for t in batch.column(int(at[1:])).to_pylist()]
            counts = [pa.array([r[i] for r in found], pa.int64()) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *counts], names=batch.schema.names)

    return renamed(wide.mapInArrow(run, wide.schema).where(~base_failed() & verdict(rules)), docs)
