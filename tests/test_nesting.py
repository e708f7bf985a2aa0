"""Rows and cells of nested tables against a plain parse with a stack of tables."""

import random
import re
import time

from pyspark.sql import functions as F

from docketry.functions import markup as M
from docketry.functions.nesting import FIELDS, LETTERS, NESTED, may_be_deep, nested_rows, with_deep_rows
from docketry.operators import extract
from docketry.operators.extract import _staged

TAG = re.compile(r"(?i)<(/?)(table|tr|td|th)\b[^<>]*>")


def plain(html):
    """Rows in page order: own cell texts and contents, first two texts at any depth, next row of the same part."""
    tags, level, events = list(TAG.finditer(html)), 0, []
    for m in tags:
        kind = m[1] + m[2].lower()
        level += kind == "table"
        events.append((level, kind, m.start(), m.end()))
        level -= kind == "/table"
    level = 0

    def end_of(i, kinds):
        return next((j for j in range(i + 1, len(events)) if events[j][0] == events[i][0] and events[j][1] in kinds), len(events))

    def place(j):
        return events[j][2] if j < len(events) else len(html)

    def first(a, b):
        at = next((m.start() for m in re.finditer(r"(?<=>)[^<>]+", html[:b]) if m.start() >= a), None)
        return re.match(r"[^<]+", html[at:b])[0] if at is not None else ""

    def own(i, j):
        """Content between two tags of a level, without tables inside."""
        text, at, k = "", events[i][3], i + 1
        while k < j:
            if events[k][0] > events[i][0]:
                text += html[at : events[k][2]]
                while k < j and events[k][0] > events[i][0]:
                    at, k = events[k][3], k + 1
            else:
                k += 1
        return text + html[at : place(j)]

    every, rows = ("table", "/table", "tr", "/tr", "td", "th", "/td", "/th"), ("table", "/table", "tr", "/tr")
    cells = {i: end_of(i, every) for i, e in enumerate(events) if e[1] == "td"}
    text = {i: first(events[i][3], place(j)) for i, j in cells.items()}
    out = []
    for i, e in enumerate(events):
        if e[1] == "tr":
            end = end_of(i, rows)
            below = [c for c in cells if i < c < end]
            mine = [c for c in below if events[c][0] == e[0]]
            out.append(([own(c, cells[c]) for c in mine], [text[c] for c in mine], [text[c] for c in below[:2]]))
    return out


def page(rng, depth=0):
    """A table of random shape; ends of rows and cells may be missing, tables and cells may be empty."""
    rows = []
    for _ in range(rng.randint(0, 3)):
        cells = ""
        for _ in range(rng.randint(0, 3)):
            body = rng.choice(["", "", f"t{rng.randint(0, 99)}", f"<b>b{rng.randint(0, 99)}</b>", " "])
            if depth < 3 and rng.random() < 0.35:
                body += page(rng, depth + 1) + rng.choice(["", f" a{rng.randint(0, 99)}"])
            name = rng.choice(["td", "td", "td", "th"])
            cells += f"<{name}>{body}" + rng.choice([f"</{name}>", f"</{name}>", ""])
        rows.append(f"<tr>{cells}" + rng.choice(["</tr>", "</tr>", "</tr>\n", ""]))
    return f"<table>{''.join(rows)}</table>"


def test_random_tables_equal_a_plain_parse(spark, make_pages):
    rng = random.Random(3)
    pages = [h for h in (f"<p>x</p>{page(rng)}{page(rng)}<p>z</p>" for _ in range(300)) if re.search(NESTED.replace("*+", "*"), h)]
    assert len(pages) > 100
    got = {r["page_id"]: r["rows"] for r in _staged(make_pages(pages)).select("page_id", "rows").collect()}
    for i, html in enumerate(pages):
        assert [(list(r["cells"]), list(r["texts"]), list(r["pair"])) for r in got[i]] == plain(html), html


def pairs(df):
    return [(r.papel, r.nome) for r in extract.extract_envolvidos(df).orderBy("page_id", "pos").collect()]


def test_a_cell_behind_an_inner_table_is_kept(make_pages):
    html = "<table><tr><td>APTE</td><td><table><tr><td>Nome</td><td>Valor</td></tr></table></td><td>resto</td></tr></table>"
    cells = extract.page_cells(make_pages([html])).orderBy("row_idx", "cell_idx").collect()
    assert [(r.row_idx, r.cell_idx, r.text) for r in cells] == [(0, 0, "APTE"), (0, 1, "Nome"), (0, 2, "resto"), (1, 0, "Nome"), (1, 1, "Valor")]
    assert pairs(make_pages([html])) == [("APTE", "Nome"), ("Nome", "Valor")]


def test_movements_in_nested_tables(make_pages):
    """The anchor's own row and the next one of the same table part count, whatever stands in their cells."""
    anchor = '<tr><td><a name="mov_{}">Em 01/02/2020 03:0{}</a></td></tr>'
    inner = "<table><tr><td>x</td><td>not this one</td></tr></table>"
    html = (
        "<p>0000001-00.2000.4.05.0000</p><table><tr><td>Menu</td><td><table>"
        + anchor.format(1, 1) + f"<tr><td>{inner}</td><td>Primeiro texto</td></tr>"
        + "<tbody>" + anchor.format(2, 2) + "</tbody><tbody><tr><td></td><td>Outra parte</td></tr></tbody>"
        + anchor.format(3, 3) + "</table></td></tr><tr><td></td><td>Outra tabela</td></tr></table>"
    )
    got = extract.extract_movimentacoes(make_pages([html])).collect()
    assert [(r.data, r.texto) for r in got] == [("2020-02-01T03:01:00", "Primeiro texto")]


def test_hostile_nesting_takes_seconds(make_pages):
    deep = "<table><tr><td>aa" * 4000 + "</td></tr></table>" * 4000
    shapes = [deep, "<table><tr><td><table>" * 10_000, "<table><table>" + "</table><td>zz<tr>" * 10_000]
    start = time.time()
    extract.extract_envolvidos(make_pages(shapes)).count()
    assert time.time() - start < 60


def test_only_pages_that_nest_without_their_hidden_parts_are_parsed_as_nested(values):
    """Before, every page with a comment or a script was decoded a second time."""
    flat, nested = "<table><tr><td>a</td></tr></table>", "<table><tr><td><table></table></td></tr></table>"
    pages = ["<!-- x -->" + flat + flat, nested, "<table><!-- </table> --><table>", "<table></t&#97;<!-- -->ble><!--", "<ta<!-- -->ble><table>", None]
    assert values(extract._nests, pages) == [False, True, True, True, True, False]


def test_rows_of_flat_empty_and_nested_pages_of_one_batch(make_pages):
    nested = "<table><tr><td>A</td><td><table><tr><td>b</td><td>c</td></tr></table></td></tr></table>"
    pages = make_pages([nested, None, "", "<table><tr><td>A</td></tr></table>", "&lt;table>" + nested])
    got = {r["page_id"]: r["rows"] for r in _staged(pages).select("page_id", "rows").collect()}
    assert set(got) == set(range(5)) and got[1] is None and got[2] == []
    assert [r["cells"] for r in got[0]] == [["A", ""], ["b", "c"]] == [r["cells"] for r in got[4]]
    assert got[3][0]["cells"] == ["A"] and got[3][0]["pair"] is None and got[0][0]["pair"] == ["A", "b"]


def test_letters_of_levels_give_the_rows_of_the_deep_way_in_less_time(spark, make_pages):
    """Before, every nested page took the deep way, about 1 ms of a core each."""
    rng = random.Random(5)
    ends = ["", "</tbody>", "< x", "<td", '<a name="mov_1">', "&lt;", "</table><table>"]
    pages = [f"{page(rng)}<table><tr><td>a{page(rng)}{rng.choice(ends)}<td>{page(rng)}</tr>{rng.choice(ends)}<tr>{page(rng)}" for _ in range(2000)]
    parsed = make_pages(pages).select("page_id", M.markup(F.col("html")).alias("mk")).repartition(8).cache()
    parsed.count()

    def taken(rows):
        start = time.time()
        got = {r["page_id"]: r["rows"] for r in rows.select("page_id", "rows").collect()}
        return got, time.time() - start

    ways = {"letters": parsed.withColumn("rows", nested_rows(F.col("mk"), M.first_text)), "deep": with_deep_rows(parsed, M.first_text)}
    for rows in ways.values():
        taken(rows)
    (letters, fast), (deep, slow) = (taken(rows) for rows in ways.values())
    assert letters == deep and any(r["below"] for rows in deep.values() for r in rows)
    assert fast * 2 < slow


def test_pages_of_more_levels_than_letters_keep_their_rows(make_pages, values):
    shapes = ["<table><tr><td>a" * n + "</td><td>b</td></tr></table>" * n for n in (2, LETTERS - 2, LETTERS - 1, LETTERS, 60)]
    shapes.append("<p>" + "</ta<!-- -->ble>" * 30 + shapes[0] + "</table>")
    assert values(lambda c: nested_rows(M.markup(c), M.first_text).isNull(), shapes) == [False, False, False, True, True, True]
    assert values(may_be_deep, ["<table><tr><!-- x -->&amp;", None, *shapes[3:]]) == [False, False, True, True, True]
    got = {r["page_id"]: r["rows"] for r in _staged(make_pages(shapes)).select("page_id", "rows").collect()}
    for i, n in enumerate((2, LETTERS - 2, LETTERS - 1, LETTERS, 60, 2)):
        assert [(list(r["cells"]), list(r["texts"]), list(r["pair"])) for r in got[i]][-1] == (["a", "b"], ["a", "b"], ["a", "b"])
        assert len(got[i]) == n


def test_a_consumer_gets_the_fields_it_reads(make_pages):
    nested = "<table><tr><td>A</td><td><table><tr><td>b</td><td>c</td></tr></table></td></tr></table>"
    row = _staged(make_pages([nested]), "pair").select("rows").first()["rows"][0]
    assert row["pair"] == ["A", "b"] and all(row[n] is None for n in FIELDS if n != "pair")


def test_records_search_the_case_number_once_and_classify_behind_the_cheap_test(spark, make_pages, tmp_path):
    """Before, a filter on the number searched it a second time, and each page was classified once per way."""
    from docketry.plans import ingest

    make_pages(["<html><p>PROCESSO Nº 0000001-00.2000.4.05.0000</p>RELATOR</html>"]).write.parquet(str(tmp_path / "pages"))
    records = ingest.detail_records(spark.read.parquet(str(tmp_path / "pages")))
    filters = [x for x in records._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter " in x]
    assert len(filters) == 2 and not any("isnotnull(coalesce(" in x for x in filters)
    assert [x.index("</?table") < x.index("RELATOR") for x in filters if "</?table" in x] == [True]
    assert [r["_id"] for r in records.collect()] == ["0000001-00.2000.4.05.0000"]


def test_whitespace_is_that_of_unicode(spark, values):
    from docketry.functions.text import WS

    some = [chr(c) for c in range(0x3100)]
    assert values(lambda c: c.rlike(f"^{WS}$"), some) == values(lambda c: c.rlike(r"^[\s\x1C-\x1F\x85\p{Z}]$"), some)
    assert values(lambda c: c.rlike(f"^[^<>{WS[1:]}$"), some) == values(lambda c: c.rlike(r"^[^<>\s\x1C-\x1F\x85\p{Z}]$"), some)
