"""Secret scans: fixed base patterns, and a linear-chain conditional random field that adds what they miss.

Every line of a text is a sequence; the field learns from those parts of lines that lie
around digits, very long runs and secret words. Each token is tagged begin, inside or outside of a secret from its shape and length, its
neighbouring words and features of the file; Viterbi decodes the tags, of many lines at a time. The field is
trained in numpy on a bounded sample of documents, tagged by the base patterns.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from docketry.llm.common import map_batches, stored

# fixed values: base patterns and their least lengths
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ["assign", "access", "hex", "crf"]
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

Span = tuple[str, int, int]

OUT, BEGIN, IN = range(3)
TOKEN = re.compile(r"[A-Za-z0-9_+/\-\u0080-\U0010ffff]+|[^\x20\x09-\x0D]")
TOKEN_OR_END = re.compile(r"[A-Za-z0-9_+/\-\u0080-\U0010ffff]+|[^\x20\x09\x0B-\x0D]")
DIGITS = re.compile(r"[0-9]+")
LONG = re.compile(r"[A-Za-z0-9+/_\-]{28,}")
HINTS = ("passw", "passphrase", "secret", "token", "api", "credential", "bearer", "private")
HINT = re.compile(r"passw|passphrase|secret|token|api.?key|credential|bearer|private", re.I | re.A)
NOT_ASCII, REPEATED, RUN = re.compile(r"[^\x00-\x7f]"), re.compile(r"(.)\1+"), re.compile(r"(.)\1*+")
TURN = re.compile(r"[0-9](?=[A-Za-z])")
CLASS = str.maketrans({**{chr(c): "X" for c in range(65, 91)}, **{chr(c): "x" for c in range(97, 123)}, **{str(d): "d" for d in range(10)}})


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Spans of the base patterns by start, then kind; and the secret values inside them."""
    low = text.lower()
    found: list[Span] = []
    values = []
    if any(w in low for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 8:
                found.append(("assign", *m.span()))
                values.append(m.span(2))
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    values += [s[1:] for s in found if s[0] != "assign"]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]))), sorted(values)


def marks_of(text: str) -> np.ndarray:
    """Offsets of digit runs, very long runs and secret words."""
    found = [np.fromiter((m.start() for m in DIGITS.finditer(text)), np.int64)]
    low = text.lower()
    if any(w in low for w in HINTS):
        found.append(np.array([m.start() for m in HINT.finditer(text)], np.int64))
    if len(text) > 1 << 20 or any(len(w) >= 28 for w in text.split()):  # the words of a very long text are not held at once
        found.append(np.array([m.start() for m in LONG.finditer(text)], np.int64))
    return np.sort(np.concatenate(found))


def _ranges(text: str, marks: np.ndarray, margin: int) -> Iterator[tuple[int, int, int, int]]:
    """(first mark, mark after the last, start, end): text around marks of one line, cut at blanks, no two overlapping.

    Line ends and blanks are searched once along the text, so a line with many marks costs its length.
    """
    line, stop, seen, left, blank = 0, -1, 0, 0, -1
    first = last = start = end = -1
    for i, mark in enumerate(marks.tolist()):
        if mark >= stop:
            line, stop = max(line, text.rfind("\n", max(0, stop), mark) + 1), text.find("\n", mark)
            stop = len(text) if stop < 0 else stop
            seen = left = line
            blank = -1
        upto = max(line, mark - margin)
        if upto > seen:
            left, seen = max(left, text.rfind(" ", seen, upto) + 1), upto
        after = min(stop, mark + margin)
        if blank < after:
            blank = text.find(" ", after, stop)
            blank = stop if blank < 0 else blank
        if first >= 0 and left < end and line <= start:
            last, end = i, blank
            continue
        if first >= 0:
            yield first, last + 1, start, end
        first, last, start, end = i, i, left, blank
    if first >= 0:
        yield first, last + 1, start, end


def stretches(text: str, reach: int = 6, margin: int = 200) -> Iterator[np.ndarray]:
    """Token spans (rows of start, end), a stretch at a time: the tokens of one line within `reach` tokens of a marked one.

    Only the text around marks is cut into tokens, since a line may be a whole long text.
    """
    marks = marks_of(text)
    for first, last, start, end in _ranges(text, marks, margin):
        tokens = np.fromiter((x for m in TOKEN.finditer(text, start, end) for x in m.span()), np.int64).reshape(-1, 2)
        at = np.searchsorted(tokens[:, 1], marks[first:last], side="right")
        depth = np.zeros(len(tokens) + 1, np.int64)  # marks that reach a token, as differences
        np.add.at(depth, np.maximum(at - reach, 0), 1)
        np.add.at(depth, np.minimum(at + reach + 1, len(tokens)), -1)
        near = np.cumsum(depth[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.concatenate(([False], near, [False])).astype(np.int8)))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            yield tokens[a:b]


def token_spans(text: str, start: int = 0, end: int | None = None) -> np.ndarray:
    """Rows of start, end."""
    return np.fromiter((x for m in TOKEN.finditer(text, start, len(text) if end is None else end) for x in m.span()), np.int64).reshape(-1, 2)


def line_tokens(text: str) -> Iterator[np.ndarray]:
    """Token spans (rows of start, end) of every line that has any."""
    start = 0
    while start < len(text):
        end = text.find("\n", start)
        end = len(text) if end < 0 else end
        tokens = token_spans(text, start, end)
        if len(tokens):
            yield tokens
        start = end + 1


def cuts(text: str, most: int) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of whole lines of at most `most` characters; a longer line is a run of its own."""
    start = 0
    while start < len(text):
        end = len(text)
        if end - start > most:
            end = text.rfind("\n", start, start + most)
            if end < 0:
                end = text.find("\n", start + most)
                end = len(text) if end < 0 else end
        yield start, end
        start = end + 1


def shape(token: str) -> str:
    """Runs of X (upper), x (lower), d (digit), u (not ASCII) and other characters, at most six."""
    classes = token.translate(CLASS)
    if not classes.isascii():
        classes = NOT_ASCII.sub("u", classes)
    if len(classes) <= 64:
        runs = REPEATED.sub(r"\1", classes)
    else:
        runs = "".join(m[0][0] for m in islice(RUN.finditer(classes), 7))
    return runs if len(runs) <= 6 else runs[:6] + "*"


def file_features(text: str) -> list[str]:
    """Features of the whole text, shared by its tokens."""
    code = sum(text.count(c) for c in "{};=()")
    words = any(w in text.lower() for w in ASSIGN_WORDS)
    return [f"file code {min(3, int(400 * code / max(1, len(text))))}", f"file words {words}"]


def features(tokens: list[str], shared: list[str]) -> list[list[str]]:
    shapes = [shape(t) for t in tokens]
    words = [t.lower() if len(t) <= 12 else s for t, s in zip(tokens, shapes, strict=True)]
    out = []
    for i, token in enumerate(tokens):
        size = min(6, len(token).bit_length())
        near = [words[j] if 0 <= j < len(tokens) else "edge" for j in (i - 3, i - 2, i - 1, i + 1)]
        turns = sum(1 for _ in islice(TURN.finditer(token), 5))
        out.append(
            [
                "bias",
                f"shape {shapes[i]}",
                f"size {size}",
                f"shape {shapes[i]} size {size}",
                f"before {shapes[i - 1] if i else 'edge'}",
                f"after {shapes[i + 1] if i + 1 < len(tokens) else 'edge'}",
                f"word-3 {near[0]}",
                f"word-2 {near[1]}",
                f"word-1 {near[2]}",
                f"word+1 {near[3]}",
                f"pair {near[1]} {near[2]}" if size > 3 else "short",
                f"turns {turns}",
                f"head {token[:4]}" if size > 3 and token[:4].isupper() else "no head",
                f"word {words[i]}" if size <= 3 else "long",
                *shared,
            ]
        )
    return out


def without_separators(tokens: list[str], tags: list[int]) -> tuple[list[str], list[int]] | None:
    """The sequence without = : and quotes beside a secret, so that the field learns to do without them."""
    beside = [
        tag == OUT and token in "=:\"'" and any(t != OUT for t in tags[max(0, i - 3) : i + 4])
        for i, (token, tag) in enumerate(zip(tokens, tags, strict=True))
    ]
    if not any(beside):
        return None
    return [t for t, b in zip(tokens, beside, strict=True) if not b], [t for t, b in zip(tags, beside, strict=True) if not b]


def bounded(tags: list[int], most: int = 256) -> list[tuple[int, int]]:
    """(start, end) of sequences of at most `most` tokens, cut before a token outside of secrets where the later half has one."""
    out, start = [], 0
    while len(tags) - start > most:
        end = next((i for i in range(start + most, start + most // 2, -1) if tags[i] == OUT), start + most)
        out.append((start, end))
        start = end
    return [*out, (start, len(tags))]


@dataclass
class Field:
    """Linear-chain field: weights per feature and tag, per tag pair, and for the first tag."""

    names: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1, 3)))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((3, 3)))
    first: np.ndarray = field(default_factory=lambda: np.zeros(3))
    seen: dict = field(default_factory=dict, repr=False, compare=False)  # tokens looked up by this process

    def __getstate__(self) -> dict:
        return {**self.__dict__, "seen": {}}

    def ids(self, rows: list[list[str]]) -> np.ndarray:
        """Feature numbers, 0 for unknown ones (its weights stay 0)."""
        return np.array([[self.names.get(f, 0) for f in row] for row in rows], np.int32)

    def decode(self, rows: list[list[str]]) -> list[int]:
        """Viterbi: the best tag sequence."""
        return self.decode_parts([rows], len(rows)).tolist()

    def decode_parts(self, parts: Iterable[list[list[str]]], n: int) -> np.ndarray:
        """Viterbi over `n` tokens whose features come in parts."""
        return self.best_tags((self.weights[self.ids(rows)].sum(axis=1) for rows in parts), n)

    def best_tags(self, parts: Iterable[np.ndarray], n: int) -> np.ndarray:
        """Viterbi over `n` tokens whose scores come in parts: the best goes from part to part, back pointers take 3 bytes a token."""
        (oo, ob, oi), (bo, bb, bi), (io, ib, ii) = self.moves.tolist()
        best, back, at = None, bytearray(3 * n), 0
        for scores in parts:
            for so, sb, si in scores.tolist():
                if best is None:
                    o, b, i = best = [s + f for s, f in zip((so, sb, si), self.first.tolist(), strict=True)]
                else:
                    ways = ((o + oo, b + bo, i + io), (o + ob, b + bb, i + ib), (o + oi, b + bi, i + ii))
                    for k, (x, y, z) in enumerate(ways):
                        if y > x:
                            back[3 * at + k] = 2 if z > y else 1
                        elif z > x:
                            back[3 * at + k] = 2
                    o, b, i = max(ways[0]) + so, max(ways[1]) + sb, max(ways[2]) + si
                at += 1
        tags = np.zeros(n, np.int8)
        tag = int(np.argmax([o, b, i]))
        for at in range(n - 1, -1, -1):
            tags[at] = tag
            tag = back[3 * at + tag]
        return tags

    def numbers(self, features: list[str]) -> list[int]:
        return [self.names.get(f, 0) for f in features]

    def known(self, tokens: Iterable[str], seen: dict, most: int = 100_000) -> Shares:
        """Shares in which all `tokens` stand, by their numbers in `seen`, which is emptied above `most` tokens."""
        shares = seen.get("") or Shares(self)
        if len(seen) > most:
            seen.clear()
        if len(seen) < 2:
            seen[""], seen["\n"], shares.size = shares, 0, 1
        new = list(set(tokens).difference(seen))
        seen.update(zip(new, range(shares.size, shares.size + len(new))))
        shares.add(new)
        return shares

    def scores(self, tokens: list[str], shared: list[str], seen: dict) -> np.ndarray:
        """Scores per token and tag of one sequence, as from ``features``: what a token gives is looked up once (`seen`)."""
        shares, n = self.known(tokens, seen), len(tokens)
        at = np.fromiter(map(seen.__getitem__, tokens), np.int64, n)
        return shares.scores(at, np.arange(n), np.arange(n) == n - 1, self.of_file(shared))

    def of_file(self, shared: list[str]) -> np.ndarray:
        return sum((self.weights[k] for k in self.numbers(shared)), np.zeros(3))

    def score_parts(self, text: str, tokens: np.ndarray, shared: list[str], seen: dict, most: int = 4096) -> Iterator[np.ndarray]:
        """Scores of the tokens, `most` at a time, each with the neighbours that the whole line gives it."""
        for lo in range(0, len(tokens), most):
            hi, before = min(lo + most, len(tokens)), max(0, lo - 3)
            yield self.scores([text[a:b] for a, b in tokens[before : hi + 1].tolist()], shared, seen)[lo - before : hi - before]

    def spans(self, text: str, least: int = 8) -> list[tuple[int, int]]:
        """Decoded secrets of every line of a whole text, at least `least` characters long."""
        return self.spans_of([text], least)[0]

    def spans_of(self, texts: list[str], least: int = 8, most: int = 1 << 20) -> list[list[tuple[int, int]]]:
        """The decoded secrets of every text. Lines are decoded many at a time, `most` characters at once; a longer line alone, in parts."""
        found: list[list[tuple[int, int]]] = [[] for _ in texts]
        if not self.names:
            return found
        held, group = 0, []
        for number, text in enumerate(texts):
            files = file_features(text)
            for start, end in cuts(text, most):
                if end - start > most:  # one line
                    tokens = token_spans(text, start, end)
                    if len(tokens):
                        tags = self.best_tags(self.score_parts(text, tokens, files, self.seen), len(tokens))
                        found[number] += secret_spans(tokens, tags, least)
                    continue
                if group and held + end - start > most:
                    self.add_spans(group, found, least)
                    held, group = 0, []
                held += end - start
                group.append((number, start, text[start:end], files))
        if group:
            self.add_spans(group, found, least)
        return [sorted(f) for f in found]

    def add_spans(self, group: list[tuple[int, int, str, list[str]]], found: list[list[tuple[int, int]]], least: int) -> None:
        """Decode the lines of a group of (text number, offset, whole lines, file features) together and add the secrets to `found`."""
        tokens: list[str] = []
        sizes = []
        for _, _, lines, _ in group:
            before = len(tokens)
            tokens += TOKEN_OR_END.findall(lines)
            tokens.append("\n")
            sizes.append(len(tokens) - before)
        shares = self.known(tokens, self.seen)
        at = np.fromiter(map(self.seen.__getitem__, tokens), np.int64, len(tokens))
        lengths = np.diff(np.flatnonzero(at == 0), prepend=-1) - 1
        lengths = lengths[lengths > 0]
        starts = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(group)), sizes)[at > 0]
        at = at[at > 0]
        if not len(at):
            return
        place = np.arange(len(at)) - np.repeat(starts, lengths)
        files = np.stack([self.of_file(files) for *_, files in group])
        scores = shares.scores(at, place, place == np.repeat(lengths, lengths) - 1, files[owner])
        tags = self.best_tags_of(scores, starts, lengths)
        line_of = np.repeat(np.arange(len(starts)), lengths)
        spans, first, mine = np.empty((0, 2), np.int64), 0, -1
        for line in np.unique(line_of[tags != OUT]).tolist():
            a, b = starts[line], starts[line] + lengths[line]
            if owner[a] != mine:
                mine = int(owner[a])
                spans, first = token_spans(group[mine][2]) + group[mine][1], int(np.searchsorted(owner, mine))
            found[group[mine][0]] += secret_spans(spans[a - first : b - first], tags[a:b], least)

    def best_tags_of(self, scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Viterbi over many sequences, a step of all of them at a time; those that few are as long as, one by one."""
        tags = np.zeros(len(scores), np.int8)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        alone = int(np.argmin(np.append(np.cumsum(lengths) - lengths + 12 * lengths, lengths.sum())))  # a step of all costs about 12 single ones
        for a, n in zip(starts[:alone].tolist(), lengths[:alone].tolist(), strict=True):
            tags[a : a + n] = self.best_tags([scores[a : a + n]], n)
        starts, lengths = starts[alone:], lengths[alone:]
        if not len(starts):
            return tags
        scores = np.ascontiguousarray(scores.T)
        live = np.searchsorted(-lengths, -np.arange(int(lengths[0]) + 1), side="left")  # sequences longer than t: the first live[t]
        best = scores[:, starts] + self.first[:, None]
        moves, back, last = self.moves[:, :, None], [], np.zeros(len(starts), np.int8)
        for t in range(1, int(lengths[0]) + 1):
            n = int(live[t])
            if n < best.shape[1]:
                last[n : best.shape[1]] = best[:, n:].argmax(axis=0)
                best = best[:, :n]
            if not n:
                break
            ways = best[:, None, :] + moves
            most = np.maximum(ways[0], ways[1])
            back.append(np.where(ways[2] > most, np.int8(2), (ways[1] > ways[0]).view(np.int8)))
            best = np.maximum(most, ways[2]) + scores[:, starts[:n] + t]
        every = np.arange(len(starts))
        for t in range(int(lengths[0]) - 1, -1, -1):
            n = int(live[t])
            tags[starts[:n] + t] = last[:n]
            if t:
                last[:n] = back[t - 1][last[:n], every[:n]]
        return tags


class Shares:
    """What numbered tokens add to the scores: rows of `table` by place; number 0 is the edge of a line.

    A token's share comes from its word, if the field knows it, its pattern of character classes and its head.
    """

    def __init__(self, model: Field) -> None:
        self.model = model
        pairs = [f.split(" ")[1:] for f in model.names if f.startswith("pair ")]
        alone = [f.split(" ")[1] for f in model.names if f.startswith(("word ", "word-", "word+"))]
        self.words = {w: i for i, w in enumerate(dict.fromkeys([w for p in pairs for w in p] + alone + ["edge"]), 1)}
        every = [[f"word{k} {w}" for k in ("-1", "-2", "-3", "+1", "")] for w in self.words]
        self.of_words = np.stack([self.weights(["no feature"] * 5), *map(self.weights, every)])
        codes = np.array([self.words[a] * (len(self.words) + 1) + self.words[b] for a, b in pairs], np.int64)
        order = np.argsort(codes)
        self.codes, self.of_pairs = codes[order], self.weights([f"pair {a} {b}" for a, b in pairs])[order]
        self.long, self.short = self.weights(["long", "short"])
        self.patterns: dict[str, int] = {}
        self.table = np.zeros((7, 1024, 3))  # a token's own; one, two, three places on; one back; its shape on and back
        self.word, self.is_long, self.size = np.zeros(1024, np.int64), np.zeros(1024, bool), 1
        self.table[1:5, 0], self.word[0] = self.of_words[self.words["edge"], :4], self.words["edge"]
        self.table[5:, 0] = self.weights(["before edge", "after edge"])

    def weights(self, features: list[str]) -> np.ndarray:
        return self.model.weights[self.model.numbers(features)]

    def pattern(self, classes: str, token: str) -> int:
        """Number of a pattern of character classes: its shape, and its shares as a token's own and as that of a neighbour."""
        if not self.patterns:
            self.kinds: list[str] = []
            self.of_patterns: list[np.ndarray] = []
        kind, size, turns = shape(token), min(6, len(token).bit_length()), sum(1 for _ in islice(TURN.finditer(token), 5))
        own = self.weights(["bias", f"shape {kind}", f"size {size}", f"shape {kind} size {size}", f"turns {turns}"]).sum(axis=0)
        self.kinds.append(kind)
        self.of_patterns.append(np.stack((own, *self.weights([f"before {kind}", f"after {kind}"]))))
        self.patterns[classes] = len(self.kinds) - 1
        return len(self.kinds) - 1

    def add(self, tokens: list[str], most: int = 1 << 16) -> None:
        """Give the next numbers to new tokens."""
        size, get, names = self.size + len(tokens), self.words.get, self.model.names
        if size > len(self.word):
            more = max(size, 2 * len(self.word)) - len(self.word)
            self.table = np.concatenate((self.table, np.zeros((7, more, 3))), axis=1)
            self.word, self.is_long = np.append(self.word, np.zeros(more, np.int64)), np.append(self.is_long, np.zeros(more, bool))
        for lo in range(0, len(tokens), 4096):
            if len(self.patterns) > most:
                self.patterns.clear()
            words, patterns, heads, none = [], [], [], names.get("no head", 0)
            for t in tokens[lo : lo + 4096]:
                classes = t.translate(CLASS)
                p = self.patterns.get(classes)
                if p is None:
                    p = self.pattern(classes, t)
                patterns.append(p)
                words.append(get(t.lower() if len(t) <= 12 else self.kinds[p], 0))
                heads.append(names.get(f"head {t[:4]}", 0) if len(t) >= 8 and t[:4].isupper() else none)
            long = np.fromiter((len(t) >= 8 for t in tokens[lo : lo + 4096]), bool, len(words))
            of_words, of_patterns = self.of_words[words], np.stack([self.of_patterns[p] for p in patterns])
            to, first = slice(self.size, self.size + len(words)), of_patterns[:, 0] + self.model.weights[heads]
            self.table[0, to] = np.where(long[:, None], first + self.long, first + of_words[:, 4] + self.short)
            self.table[1:5, to], self.table[5:, to] = of_words[:, :4].transpose(1, 0, 2), of_patterns[:, 1:].transpose(1, 0, 2)
            self.word[to], self.is_long[to] = words, long
            self.size += len(words)

    def scores(self, at: np.ndarray, place: np.ndarray, last: np.ndarray, files: np.ndarray) -> np.ndarray:
        """Scores of tokens by number, of many sequences on end: `place` in the own one, `last` at its end, `files` the shares of file features."""
        wide = np.concatenate((np.zeros(3, np.int64), at, np.zeros(1, np.int64)))
        n = len(at)
        on = [np.where(place >= k, wide[3 - k : 3 - k + n], 0) for k in (1, 2, 3)]
        back = np.where(last, 0, wide[4:])
        part = lambda k, x: self.table[k].take(x, axis=0)
        out = part(0, at) + (part(1, on[0]) + part(2, on[1]) + part(3, on[2])) + part(4, back) + part(5, on[0]) + part(6, back)
        out += files
        if len(self.codes):
            which = np.flatnonzero(self.is_long[at])
            code = self.word[on[1][which]] * (len(self.words) + 1) + self.word[on[0][which]]
            found = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[found] == code
            out[which[hit]] += self.of_pairs[found[hit]]
        return out


def feature_parts(text: str, tokens: np.ndarray, shared: list[str], most: int = 4096) -> Iterator[list[list[str]]]:
    """Features of the tokens, `most` at a time, each with the neighbours that the whole stretch gives it."""
    for lo in range(0, len(tokens), most):
        hi, before = min(lo + most, len(tokens)), max(0, lo - 3)
        yield features([text[a:b] for a, b in tokens[before : hi + 1].tolist()], shared)[lo - before : hi - before]


def secret_runs(tags: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first token, token after the last) of every secret: a begin, or an inside behind an outside, and the insides that follow."""
    ahead = np.concatenate(([OUT], tags[:-1]))
    starts = np.flatnonzero((tags == BEGIN) | ((tags == IN) & (ahead == OUT)))
    breaks = np.flatnonzero(tags != IN)
    ends = np.append(breaks, len(tags))[np.searchsorted(breaks, starts, side="right")]
    return zip(starts.tolist(), ends.tolist(), strict=True)


def secret_spans(tokens: np.ndarray, tags: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, end) of the secrets of one line, at least `least` characters long."""
    found = [(int(tokens[a, 0]), int(tokens[b - 1, 1])) for a, b in secret_runs(tags)]
    return [(a, b) for a, b in found if b - a >= least]


def overlaps(spans: list[tuple[int, int]], others: list[tuple[int, int]]) -> list[bool]:
    """Whether each span meets one of `others`, which are sorted by start."""
    starts = np.array([a for a, _ in others], np.int64)
    ends = np.maximum.accumulate(np.array([b for _, b in others], np.int64))
    at = np.searchsorted(starts, np.array([b for _, b in spans], np.int64))  # others that start before the span's end
    return [k > 0 and ends[k - 1] > a for k, (a, _) in zip(at.tolist(), spans, strict=True)]


def gold_tags(tokens: Iterable[tuple[int, int]], values: list[tuple[int, int]]) -> list[int]:
    """Tags of tokens by the secret values that hold them; both sorted by start."""
    tags, live, at = [], [], 0
    for a, b in tokens:
        while at < len(values) and values[at][0] <= a:
            live.append(values[at])
            at += 1
        live = [v for v in live if v[1] > a]  # one of each kind at most
        inside = next((v for v in live if b <= v[1]), None)
        tags.append(OUT if inside is None else IN if tags and tags[-1] != OUT and a > inside[0] else BEGIN)
    return tags


def train(sequences: list[tuple[list[list[str]], list[int]]], epochs: int = 30, rate: float = 0.1, decay: float = 1e-4, batch: int = 64, seed: int = 5) -> Field:
    """Maximum likelihood by Adam on batches of padded sequences, forward-backward in the log domain."""
    counts = Counter(f for rows, _ in sequences for row in rows for f in row)
    model = Field({f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n > 1), 1)})
    if not any(t != OUT for _, tags in sequences for t in tags):
        return Field()
    model.weights = np.zeros((len(model.names) + 1, 3))
    data = sorted(((model.ids(rows), np.array(tags)) for rows, tags in sequences), key=lambda s: len(s[1]))
    params = [model.weights, model.moves, model.first]
    moment = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    rng, step = np.random.default_rng(seed), 0

    def total(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)

    groups = [data[i : i + batch] for i in range(0, len(data), batch)]
    for _ in range(epochs):
        for g in rng.permutation(len(groups)):
            group = groups[g]
            long = max(len(t) for _, t in group)
            ids = np.zeros((len(group), long, group[0][0].shape[1]), np.int32)
            tags, live = np.zeros((len(group), long), int), np.zeros((len(group), long), bool)
            for i, (x, t) in enumerate(group):
                ids[i, : len(t)], tags[i, : len(t)], live[i, : len(t)] = x, t, True
            score = model.weights[ids].sum(axis=2)
            ahead = np.zeros((len(group), long, 3))
            ahead[:, 0] = score[:, 0] + model.first
            for t in range(1, long):
                now = total(ahead[:, t - 1, :, None] + model.moves, 1) + score[:, t]
                ahead[:, t] = np.where(live[:, t, None], now, ahead[:, t - 1])
            z = total(ahead[:, -1], 1)
            behind = np.zeros((len(group), long, 3))
            for t in range(long - 2, -1, -1):
                now = total(model.moves + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
                behind[:, t] = np.where(live[:, t + 1, None], now, 0)
            one = np.exp(ahead + behind - z[:, None, None]) * live[:, :, None]
            gold = np.eye(3)[tags] * live[:, :, None]
            off = one - gold
            two = np.zeros((3, 3))
            for t in range(1, long):
                pair = ahead[:, t - 1, :, None] + model.moves + (score[:, t] + behind[:, t])[:, None, :] - z[:, None, None]
                two += (np.exp(pair) * live[:, t, None, None]).sum(axis=0)
                np.add.at(two, (tags[live[:, t], t - 1], tags[live[:, t], t]), -1)
            slope = np.zeros_like(model.weights)
            flat = np.repeat(off.reshape(-1, 3), ids.shape[2], axis=0)
            for k in range(3):
                slope[:, k] = np.bincount(ids.reshape(-1), flat[:, k], len(slope))
            step += 1
            for p, (m, v), grad in zip(params, moment, (slope, two, off[:, 0].sum(axis=0)), strict=True):
                grad = grad / len(group) + decay * p
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            model.weights[0] = 0
    return model


def training_rows(docs: DataFrame, text: str = "text", key: str = "doc_id", sample: int = 6000, tokens: int = 200_000) -> list[Row]:
    """Tagged sequences of at most `sample` documents in hash order, about `tokens` tokens in sum.

    Every document's first sequence comes before any document's second one, so a long
    document takes no other's place; a sequence that does not fit is skipped.
    """
    ids = docs.select(F.col(f"`{key}`").alias("id")).where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    chosen = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(ids), "id", "left_semi")

    def make(keys, texts):
        out: tuple[list, ...] = ([], [], [], [], [])
        for k, t in zip(keys, texts, strict=True):
            t, at, held = t or "", 0, 0
            shared, values = file_features(t), base_spans(t)[1]
            for part in stretches(t):
                if held >= tokens:  # what follows cannot come before the budget is spent
                    break
                part = part[: tokens - held + 2 * 256].tolist()
                tags = gold_tags(part, values)
                for a, b in bounded(tags):
                    if held >= tokens:
                        break
                    for column, value in zip(out, (str(k), at, [t[x:y] for x, y in part[a:b]], tags[a:b], shared), strict=True):
                        column.append(value)
                    at, held = at + 1, held + b - a
        return out

    rows = map_batches(chosen, ["id", "text"], "text", make, "id string, at long, words array<string>, tags array<int>, shared array<string>")
    rows = stored(rows.withColumn("mark", F.xxhash64("id")), "secret-sequences")
    held, last = 0, -1
    for r in rows.groupBy("at").agg(F.sum(F.size("words")).alias("n")).orderBy("at").limit(tokens).collect():
        held, last = held + r["n"], r["at"]
        if held >= tokens:
            break
    held, out = 0, []
    for r in sorted(rows.where(F.col("at") <= last).collect(), key=lambda r: (r["at"], r["mark"], r["id"], r["words"])):
        if held + len(r["words"]) <= tokens:
            held += len(r["words"])
            out.append(r)
    return out


def train_on(docs: DataFrame, text: str = "text", key: str = "doc_id", **settings) -> Field:
    """Field from a bounded sample of the documents."""
    sequences = []
    for r in training_rows(docs, text, key, **settings):
        sequences.append((features(r["words"], r["shared"]), r["tags"]))
        if bare := without_separators(r["words"], r["tags"]):
            sequences.append((features(bare[0], r["shared"]), bare[1]))
    return train(sequences)


def secrets(docs: DataFrame, text: str = "text", key: str = "doc_id", model: Field | None = None, **settings) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_crf, base_spans, spans (arrays of kind, start, end), one row per input row.

    Starts and ends are code points of the whole text, ends exclusive. Base spans stay
    as they are; the field adds spans (kind crf) that overlap none of them. Null text
    counts as empty; repeated rows get equal spans; ids may be null; other columns are
    not read. Without base spans in the training sample the field adds nothing.
    """
    trained = train_on(docs, text, key, **settings) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(trained)  # bounded by the training sample

    def make(keys, texts):
        out: tuple[list, ...] = (keys, [], [], [], [], [], [])
        texts = [t or "" for t in texts]
        for t, found in zip(texts, shared.value.spans_of(texts), strict=True):
            base = base_spans(t)[0]
            meets = overlaps(found, [(a, b) for _, a, b in base]) if base else [False] * len(found)
            added = [("crf", a, b) for (a, b), m in zip(found, meets, strict=True) if not m]
            every = sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))
            for column, kind in zip(out[1:5], KINDS, strict=True):
                column.append(sum(s[0] == kind for s in every))
            for column, spans in zip(out[5:], (base, every), strict=True):
                column.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
        return out

    kind = docs.schema[key].dataType.simpleString()
    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    schema = f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_crf long, base_spans {spans}, spans {spans}"
    narrow = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_batches(narrow, ["doc_id", "text"], "text", make, schema)
