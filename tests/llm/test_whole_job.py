"""Cases in which an operator did less than its whole job."""

import inspect
import math
import random

import numpy as np
import zstandard
from pyspark.sql import functions as F
from test_filters_and_models import plain_logp

from docketry.llm import blocks, decontaminate, kneser, pages, secrets, toxicity


def test_the_quality_model_counts_five_characters():
    assert inspect.signature(kneser.quality).parameters["order"].default == 5
    assert all(len(t) == 5 for t in [kneser.symbols(["abcde"], 5)[0][4:9]])


def test_all_code_points_are_kept_apart(spark):
    rng = random.Random(10)
    alphabet = ["a", "b", *(chr(c) for c in (97 + 4095, 98 + 4095, 0x4E00, 0x4E00 + 4095, 0xAC00, 0xE000, 0xE001, 0x1F600, 0x10FFFF))]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 50))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "zh") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    got = {r.doc_id: r for r in kneser.perplexities(docs, labels, "text", "doc_id", "lang", 5, 500).collect()}
    trained = [t for i, t in enumerate(texts) if got[i].role == 1]
    for i, (n, logp) in enumerate(plain_logp(trained, texts, 5)):
        assert got[i].n_symbols == n and math.isclose(got[i].logp, logp, rel_tol=1e-4, abs_tol=1e-4)


PARAGRAPH = "This is a paragraph of the text that is long enough to count as content, number {} of them."
P = [f"<p>{PARAGRAPH.format(i)}</p>" for i in range(9)]
T = [PARAGRAPH.format(i) for i in range(9)]


def test_text_beside_the_largest_container_is_kept():
    for outer in ("blockquote", "table><tr><td", "div", "section"):
        close = "".join(f"</{x}>" for x in reversed(outer.split("><")))
        page = f"<body><ul><li><a href=/>x</a></ul><div id=content><h2>Title</h2>{P[0]}<{outer}>{''.join(P[1:8])}{close}<h3>End</h3>{P[8]}</div></body>"
        assert pages.main_text(page) == " ".join(["Title", *T[:8], "End", T[8]])
    cell = f"<body><h2>Title</h2><table><tr><td><div>{''.join(P)}</div></td></tr></table></body>"
    assert pages.main_text(cell) == " ".join(["Title", *T])
    halves = f"<body><div><h2>One</h2>{''.join(P[:7])}</div><div><h2>Two</h2>{''.join(P[7:])}</div></body>"
    assert pages.main_text(halves) == " ".join(["One", *T[:7], "Two", *T[7:]])
    articles = f"<body><p>x</p><article>{''.join(P[:7])}</article><article>{''.join(P[7:])}</article></body>"
    assert pages.main_text(articles) == " ".join(T)


def test_a_name_on_a_wrapper_does_not_hide_the_content():
    inner = f"<h1>Title</h1>{''.join(P)}<div class=comments><p>Nice.</p></div>"
    for wrapper in ('div class="layout has-sidebar"', 'div id=page class="with-menu"', 'section class="post comments-open"', "form id=aspnetForm"):
        end = f"</{wrapper.split()[0]}>"
        for name in ("article", "main", "div"):
            page = f"<body><div>Site of mine</div><{wrapper}><{name}>{inner}</{name}><div class=sidebar><p>Other things</p></div>{end}</body>"
            assert pages.main_text(page).removeprefix("Site of mine ") == " ".join(["Title", *T])
    remarks = "".join(f"<article>{p}</article>" for p in P[3:])
    page = f"<body><article>{''.join(P[:3])}</article><section class=comments>{remarks}</section></body>"
    assert pages.main_text(page) == " ".join(T[:3])
    parts = "".join(f"<div class=promo>{p}</div>" for p in P)
    assert pages.main_text(f"<body><p>x</p>{parts}</body>").endswith(" ".join(T))


def test_blocks_of_items_give_the_same_spans(spark):
    rng = random.Random(11)
    words = ["The", "cat", "élan", "x1", "9", "über", "do-re", "mi", "a"]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(3, 9)))) for i in range(12)]
    rows = [(i, rng.choice(["; ", " "]).join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(40)]
    rows += [rows[0], (None, rows[1][1]), (50, None), (51, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    one, several = ([tuple(r) for r in decontaminate.contamination(docs, bench, width=4, most=most).collect()] for most in (16_000_000, 60))
    assert sorted(one, key=str) == sorted(several, key=str) and sum(bool(r[-1]) for r in one) > 5


def test_a_long_line_does_not_end_the_training(spark):
    rng = random.Random(12)
    value = lambda: "".join(rng.choices("0123456789abcdef", k=20))
    rows = [(0, " ".join(str(rng.randint(1, 999)) for _ in range(3000)))]
    rows += [(i, f"the name is {rng.randint(1, 99)} and password={value()} in the file") for i in range(1, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = secrets.training_rows(docs, tokens=1500)
    assert {r["id"] for r in found} == {str(i) for i in range(40)}
    assert all(len(r["words"]) <= 256 for r in found) and 1244 <= sum(len(r["words"]) for r in found) <= 1500
    assert secrets.train_on(docs, tokens=1500).names
    assert secrets.bounded([0] * 200 + [1] + [2] * 99, 256) == [(0, 199), (199, 300)]


def test_secret_tags_of_a_long_line_do_not_depend_on_its_parts():
    rng = random.Random(5)
    line = "".join(rng.choice(["1", "a7", "=", " ", "key9 ", "Zz", ",", "token "]) for _ in range(9000))
    (tokens,) = secrets.stretches(line)
    rows = secrets.features([line[a:b] for a, b in tokens.tolist()], [])
    names = {f: i for i, f in enumerate(sorted({f for r in rows for f in r}), 1)}
    noise = np.random.default_rng(1)
    model = secrets.Field(names, noise.normal(size=(len(names) + 1, 3)), noise.normal(size=(3, 3)), noise.normal(size=3))
    whole = model.decode(rows)
    parts = list(secrets.feature_parts(line, tokens, [], most=97))
    assert [r for p in parts for r in p] == rows and model.decode_parts(parts, len(rows)).tolist() == whole
    found = model.spans(line, least=1)
    others = sorted((a, a + rng.randrange(1, 400)) for a in rng.sample(range(len(line)), 60))
    assert secrets.overlaps(found, others) == [any(s < b and a < e for s, e in others) for a, b in found]
    values = sorted(secrets.base_spans("token: abcdef123456 " * 50 + "AKIA" + "B2" * 20)[1])
    spans = [(i, i + 4) for i in range(0, 1000, 4)]
    tags = secrets.gold_tags(spans, values)
    assert [t != secrets.OUT for t in tags] == [any(v[0] <= a and b <= v[1] for v in values) for a, b in spans]


def test_far_marks_of_one_line_share_no_text():
    text = ("x" * 900 + "7") * 40 + "\nab 5"
    found = list(secrets.stretches(text))
    assert [(f[0, 0], f[-1, 1]) for f in found] == [(0, 901 * 40), (901 * 40 + 1, len(text))]
    assert list(secrets.stretches("no mark here")) == []


def test_every_token_of_a_text_is_scored_and_tagged():
    """Before, tokens far from digits, very long runs and secret words were never looked at."""
    rng = random.Random(6)
    text = "\n".join(" ".join(rng.choice(["Ab", "zeta", "Grünwaldheim", "a7=", "abcdefghijklmnop", "é", "key9"]) for _ in range(rng.randrange(40))) for _ in range(30))
    lines = [t.tolist() for t in secrets.line_tokens(text)]
    assert [x for t in lines for x in t] == [[*m.span()] for m in secrets.TOKEN.finditer(text)]
    shared = secrets.file_features(text)
    rows = [secrets.features([text[a:b] for a, b in t], shared) for t in lines]
    names = {f: i for i, f in enumerate(sorted({f for some in rows for r in some for f in r}), 1)}
    noise = np.random.default_rng(2)
    model = secrets.Field(names, noise.normal(size=(len(names) + 1, 3)), noise.normal(size=(3, 3)), noise.normal(size=3))
    model.weights[0] = 0
    seen, want = {}, []
    for tokens, some in zip(lines, rows, strict=True):
        parts = [*model.score_parts(text, np.array(tokens), shared, seen, most=7)]
        assert np.allclose(np.concatenate(parts), model.weights[model.ids(some)].sum(axis=1))
        want += [(tokens[a][0], tokens[b - 1][1]) for a, b in secrets.secret_runs(np.array(model.decode(some)))]
    assert model.spans(text, least=1) == want and len(want) > 50
    field = secrets.Field({"shape x size 5": 1}, np.array([[0.0, 0, 0], [0, 9, 0]]), np.zeros((3, 3)), np.zeros(3))
    plain = "no mark near " * 60 + "correcthorsebattery"
    assert field.spans(plain) == [(780, 799)] and list(secrets.stretches(plain)) == []


def test_lines_are_decoded_together_and_as_one_by_one(monkeypatch):
    """Before, each line was scored and decoded by calls of its own, and its tokens looked up anew for every batch."""
    rng = random.Random(9)
    words = ["Ab", "zeta", "Grünwaldheim", "a7=", "abcdefghijklmnop", "é", "key9", "AKIAQ7X2", "\x0b", "x" * 70, "edge"]
    line = lambda most: " ".join(rng.choice(words) + rng.choice(["", str(rng.randrange(999))]) for _ in range(rng.randrange(most)))
    texts = ["\n".join(line(20) for _ in range(rng.randrange(40))) for _ in range(20)] + ["", "\n", "\n\n a\n", line(3000), line(900) + "\n" + line(5)]
    lines = [[(t, x) for x in secrets.line_tokens(t)] for t in texts]
    rows = [secrets.features([t[a:b] for a, b in x], secrets.file_features(t)) for some in lines for t, x in some]
    names = {f: i for i, f in enumerate(sorted({f for some in rows for r in some for f in r}), 1)}
    noise = np.random.default_rng(3)
    model = secrets.Field(names, noise.normal(size=(len(names) + 1, 3)), noise.normal(size=(3, 3)), noise.normal(size=3))
    model.weights[0] = 0
    want, decoded = [], iter(rows)
    for some in lines:
        found = []
        for _, x in some:
            found += [(x[a, 0], x[b - 1, 1]) for a, b in secrets.secret_runs(np.array(model.decode(next(decoded))))]
        want.append([(a, b) for a, b in found if b - a >= 3])
    calls = []
    alone = secrets.Field.best_tags
    monkeypatch.setattr(secrets.Field, "best_tags", lambda self, parts, n: calls.append(n) or alone(self, parts, n))
    assert model.spans_of(texts, least=3) == want and sum(map(len, want)) > 300
    assert len(calls) < 10 < len(rows) / 20
    assert all(model.spans_of(texts, least=3, most=m) == want for m in (1, 40, 900))
    looked_up = len(model.seen)
    monkeypatch.setattr(secrets.Shares, "pattern", None)
    assert model.spans_of(texts, least=3) == want and len(model.seen) == looked_up


def plain_cut(rows):
    """Best F1 over the cuts between distinct z, the highest of equal ones."""
    every = sorted({z for z, _ in rows}, reverse=True)
    f1 = lambda v: 2 * sum(y for z, y in rows if z >= v) / (sum(z >= v for z, _ in rows) + sum(y for _, y in rows))
    at = max(range(len(every)), key=lambda i: (f1(every[i]), -i))
    return (every[at] + [*every, -20.0][at + 1]) / 2


def test_cuts_equal_a_plain_loop(spark):
    rng = random.Random(4)
    rows = [(g, min(25.0, rng.gauss(3.0 * y, 1.5)) if rng.random() < 0.8 else float(rng.randrange(-3, 4)), y) for g in "abc" for y in [int(rng.random() < 0.3) for _ in range(150)]]
    rows += [("one", 1.0, 1), ("far", -30.0, 0), ("far", 40.0, 1)]
    got = {r.g: r for r in toxicity.best_cuts(spark.createDataFrame(rows, "g string, z double, toxic int"), ["g"]).collect()}
    assert got.keys() == {"a", "b", "c", "far"} and got["far"].cut == 0.0
    for g in "abc":
        mine = [(z, y) for k, z, y in rows if k == g]
        assert math.isclose(got[g].cut, plain_cut(mine)) and got[g].n_toxic == sum(y for _, y in mine)


def test_thresholds_come_from_all_labelled_rows(spark):
    """Before, they came from the rows that the net was trained and held back on: at most `sample` ids of each kind."""
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=8) + ["bad"] * (i % 3 == 0 or rng.random() < 0.1)), rng.choice(["en", "de"])) for i in range(1200)]
    docs = spark.createDataFrame(rows + rows[:50], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(1200)], "doc_id long, toxic int")
    net = toxicity.train(docs, labels, sample=60, epochs=2)
    ids = [r.id for r in toxicity.marked_ids(labels).where("pmod(xxhash64(id), 5) = 0").collect()]
    z = dict(zip(ids, net.logits([toxicity.ids_of(rows[i][1]) for i in ids]).tolist(), strict=True))
    cuts = {lang: plain_cut([(z[i], int(i % 3 == 0)) for i in ids if lang in ("", rows[i][2])]) for lang in ("", "en", "de")}
    assert net.aside and len(ids) > 150
    for r in toxicity.toxicity(docs, labels, sample=60, epochs=2).where(f"doc_id in ({','.join(map(str, ids))})").collect():
        assert math.isclose(r.score, 1 / (1 + math.exp(cuts[""] - z[r.doc_id])), rel_tol=1e-3, abs_tol=1e-4)
        over = z[r.doc_id] - cuts[rows[r.doc_id][2]]
        assert abs(over) < 1e-4 or r.flagged == (over > 0)


def test_blocks_and_tables_of_the_quality_model_take_less_disk(spark):
    """Before, payloads were compressed at the lowest level and n-gram tables written in hash order, with dictionaries of distinct keys."""
    rng = random.Random(11)
    words = ["".join(rng.choices("etaoinshr", k=rng.randint(2, 9))) for _ in range(300)]
    after = {w: rng.choices(words, k=4) for w in words}

    def text():
        out = [rng.choice(words)]
        while len(out) < 200:
            out.append(rng.choice(after[out[-1]]))
        return " ".join(out)

    texts = [text() for _ in range(400)] + ["", "é\n"]
    payload = blocks.pack_texts(texts)
    assert blocks.unpack_texts(payload, [len(t) for t in texts]) == texts
    assert len(payload) < 0.93 * len(zstandard.ZstdCompressor(level=1).compress("".join(texts).encode()))
    rows = spark.range(60_000).select((F.xxhash64("id") % 10**9).alias("g"), (F.col("id") % 2).alias("h")).repartition(2)
    written = kneser.sorted_table(rows, "sorted-rows", "h", "g")
    assert written.exceptAll(rows).count() == 0 and written.count() == 60_000
    for mine in written.withColumn("file", F.input_file_name()).groupBy("file").agg(F.collect_list(F.struct("h", "g")).alias("r")).collect():
        assert mine.r == sorted(mine.r)
