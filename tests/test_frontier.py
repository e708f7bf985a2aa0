"""Link choice, caps and pagination against plain loops."""

import random
import re

import pytest
from pyspark.sql import functions as F

from docketry.operators import frontier, intake, pagination
from docketry.schemas import CRAWL_REQUESTS

NPU = re.compile(r"\d{7}-\d{2}\.\d{4}\.\d\.\d{2}\.\d{4}")
A, B = "0015648-78.1999.4.05.0000", "0012656-90.2012.4.05.0000"


def best(links, target):
    """Visit tiers, then links; keep a strictly better one; an exact one ends it."""
    def tier_has(tier, href, linkar):
        if tier == 1:
            return linkar and href.startswith("/processo/") and "/movimentacao/" not in href
        if tier == 2:
            return href.startswith("/cp/processo/") and "/movimentacao/" not in href
        if tier == 3:
            return "/processo/" in href and not re.search("/movimentacao/|/movimento/", href)
        return "processo" in href and not re.search("movimentacao|movimento", href)

    top, chosen = 0, None
    for tier in (1, 2, 3, 4):
        for href, linkar in links:
            if not tier_has(tier, href, linkar) or href in ("", "/") or href.startswith(("#", "javascript:")):
                continue
            points = 100 * (target in href) + 50 * bool(NPU.search(href))
            points += 25 * ("/processo/" in href and not re.search("/movimentacao/|/movimento/|/lista", href))
            points += 10 * (not re.search("[?&]", href))
            if points > top:
                top, chosen = points, href
                if target in href:
                    return chosen
        if top >= 100:
            return chosen
    return chosen


def test_best_link_agrees_with_a_loop(make_pages):
    rnd = random.Random(5)
    parts = ["/processo/", "/cp/processo/", "/x/processo/", "processo", "/processo/movimento/", "/processo/lista/",
             "/processo/movimentacao/", "#processo", "javascript:processo", "/", "", "outra"]
    cases = []
    for _ in range(400):
        links = []
        for _ in range(rnd.randrange(6)):
            href = rnd.choice(parts) + rnd.choice(["", A, B, "1"]) + rnd.choice(["", "?a=1", "?a=1&b=2"])
            links.append((href, rnd.random() < 0.4))
        cases.append(links)
    html = [
        "".join(f"<a{' class=\"x linkar\"' if k else ''} href=\"{h.replace('&', '&amp;')}\">t</a>" for h, k in links)
        for links in cases
    ]
    pages = make_pages([(h, {"numero": A}) for h in html])
    got = {r.page_id: r.href for r in frontier.best_detail_link(pages).collect()}
    expected = {i: best(links, A) for i, links in enumerate(cases)}
    assert got == {i: h for i, h in expected.items() if h}


LIMITS = "req_id long, max_pages int, max_details_per_page int"


def _crawl_loop(pages, limits):
    """Pages as (page_id, req_id, page_idx, url, hrefs); a crawl reads a URL once, when first captured."""
    out, taken = [], {}
    firsts = {}
    for page in pages:
        if any(page[4]):
            crawl = page[0] if page[1] is None else ("r", page[1])
            key = (crawl, page[3])
            if key not in firsts or page[0] < firsts[key][0]:
                firsts[key] = page
    for (crawl, _), (page_id, req, idx, url, hrefs) in sorted(firsts.items(), key=lambda p: (str(p[0][0]), p[1][2], p[1][0])):
        max_pages, max_details = limits.get(req, (5, 10))
        here = 0
        for h in hrefs:
            if taken.get(crawl, 0) >= max_pages * max_details or here >= max_details:
                break
            if not h:
                continue
            out.append((page_id, req, here, h))
            here += 1
            taken[crawl] = taken.get(crawl, 0) + 1
    return out


def _crawl_pages(make_pages, pages):
    raw = make_pages(
        [("".join(f"<a href='{h}'>t</a>" for h in hrefs), {"page_id": i, "cnpj": "1" * 14, "req_id": r, "page_idx": x, "url": u}) for i, r, x, u, hrefs in pages]
    )
    return raw


def test_caps_with_one_crawl_holding_most_pages(spark, make_pages):
    rnd = random.Random(2)
    pages = []
    for i in range(1600):
        req = 1 if i % 4 else rnd.choice([2, 3, None])
        n = rnd.choice([0, 0, 1, 3, 60]) if i % 5 else 0
        hrefs = ["" if rnd.random() < 0.1 else f"https://o.example/processo/{i}-{j}" for j in range(n)]
        pages.append((i, req, rnd.randrange(2000), f"https://o.example/l/{rnd.randrange(1200)}", hrefs))
    limits = {1: (20, 50), 3: (3, 7)}
    limit_rows = spark.createDataFrame([(c, p, d) for c, (p, d) in limits.items()] * 2, LIMITS)
    raw = _crawl_pages(make_pages, pages)
    expected = _crawl_loop(pages, limits)
    for got in (frontier.frontier_form(raw, limit_rows), frontier.frontier_stable(raw, limit_rows)):
        rows = [(r.page_id, r.req_id, r.pos, r.detail_url) for r in got.collect()]
        assert sorted(rows, key=str) == sorted(expected, key=str)
    assert sum(c == 1 for _, c, _, _ in expected) == 1000


def test_limits_alone_cap_a_crawl(spark, make_pages):
    """Nothing but the limits table cuts links or pages, however high they are."""
    pages = [(i, 7, i, f"https://o.example/l/{i}", [f"https://o.example/processo/{i}-{j}" for j in range(120)]) for i in range(30)]
    raw = _crawl_pages(make_pages, pages)
    wide = spark.createDataFrame([(7, 40, 200)], LIMITS)
    assert frontier.frontier_stable(raw, wide).count() == 3600
    lists = make_pages([("<a href='l?page=26'>próxima</a>", {"req_id": 7, "page_idx": 25})])
    assert [r.page_idx for r in pagination.next_pages_form(lists, wide).collect()] == [26]
    assert pagination.next_pages_form(lists, wide.limit(0)).count() == 0


def test_pages_without_a_request_share_no_budget(spark, make_pages):
    pages = [(i, None, 0, "https://o.example/l", [f"https://o.example/processo/{i}-{j}" for j in range(10)]) for i in range(20)]
    raw = _crawl_pages(make_pages, pages)
    assert frontier.frontier_stable(raw, spark.createDataFrame([], LIMITS)).count() == 200


def test_stable_links_take_the_first_tier_that_exists(spark, make_pages):
    limits = spark.createDataFrame([], LIMITS)
    items = [
        "<a href='/processo/1'>a</a><a class='linkar' href='/processo/2'>b</a>",
        "<a href='http://s.example/cp/processo/3'>a</a><a href='processos'>b</a>",
        "<a href='processos'>b</a><a href='processos?u=http://s.example'>c</a>",
    ]
    pages = make_pages([(h, {"cnpj": str(i)}) for i, h in enumerate(items)], "http://s.example/l/0")
    rows = frontier.frontier_stable(pages, limits, "http://s.example").orderBy("page_id", "pos").collect()
    assert [r.detail_url for r in rows] == [
        "https://s.example/processo/2",
        "https://s.example/cp/processo/3",
        "https://s.example/l/processos",
        "https://s.example/l/processos?u=https://s.example",
    ]


def test_coverage_counts_a_case_once(spark):
    links = spark.createDataFrame([("1", A), ("1", A), ("1", B), ("2", B), ("2", None)], "cnpj string, numero string")
    links = links.withColumn("crawl", F.concat(F.lit("r"), "cnpj"))
    done = spark.createDataFrame([(A,), (A,)], "numero string")
    got = {r.cnpj: (r.discovered, r.fetched, r.missing) for r in frontier.frontier_coverage(links, done).collect()}
    assert got == {"1": (2, 1, 1), "2": (1, 0, 1)}
    assert {(r.cnpj, r.numero) for r in frontier.missing_details(links, done).collect()} == {("1", B), ("2", B)}
    assert {(r.cnpj, r.numero) for r in frontier.done_details(links, done).collect()} == {("1", A)}


def test_totals(make_pages):
    cases = {
        "Resultados: Total: 157 processos": (157, 15),
        "Nenhum resultado": (None, None),
        "TOTAL DE 20": (20, 1),
        "5 resultados e 9 processos": (5, 0),
        "9 processo": (9, 0),
        "encontrado 31": (31, 3),
        "Localizados 0": (0, 0),
        None: (None, None),
    }
    rows = pagination.list_totals(make_pages(list(cases))).orderBy("page_id").collect()
    assert [(r.total, r.last_page) for r in rows] == list(cases.values())


def test_stable_totals_prefer_the_query_text(make_pages):
    items = [
        "<p>Total: 9</p><p class='texto_consulta'>Total: 8</p><div class='consulta_paginas'><i class='texto_consulta'>total: 7</i></div>",
        "<p>Total: 9</p><p class='texto_consulta'>Total: 8</p>",
        "<p>Total: x</p><p>Total: 9</p>",
        "<p>total: 9</p>",
    ]
    rows = pagination.stable_totals(make_pages(items)).orderBy("page_id").collect()
    assert [r.total for r in rows] == [7, 8, 9, None]


def test_nav_links(make_pages):
    items = [
        '<a href="?page=1">Próxima</a> <a href="?page=10">Última</a>',
        '<a href="/x">próxima</a><a href="?page=4">seguinte</a><a href="?page=2">2</a><a href="?page=9">1</a><a href="?page=9">2</a>',
        '<a name="x"><a href="?page=0">última</a><a href="?page=3">3</a><a class="z" href="?a=1&page=0">PRIMEIRA</a><a href="?page=1"> < </a>',
        "<a href='?page=5'>></a><a href='?page=7'>>></a><a href='?page=0'>início</a><a href='?page=2'>anterior</a>",
        "nada",
    ]
    got = [
        (r.next_page, r.last_page, r.first_page, r.prev_page, r.page_numbers, r.has_next, r.has_last)
        for r in pagination.nav_links(make_pages(items)).orderBy("page_id").collect()
    ]
    assert got == [
        (1, 10, None, None, [], True, True),
        (None, 2, None, None, [1, 2], False, True),
        (None, 3, 0, 1, [3], False, True),
        (5, 7, 0, 2, [], True, True),
        (None, None, None, None, [], False, False),
    ]


def test_page_ranges(spark):
    cases = {(0, 10, 3): [0, 1, 2], (0, 1, 5): [0, 1], (1, 0, 4): [1], (2, None, 3): [2], (-1, -1, 3): [0], (3, 9, 0): [3]}
    states = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "state_id int, current_page int, last_page int, max_pages int")
    rows = pagination.page_ranges(states).orderBy("state_id", "page_idx").collect()
    assert [[r.page_idx for r in rows if r.state_id == i] for i in range(len(cases))] == list(cases.values())
    clipped = pagination.page_ranges(states.where("state_id = 2"), clip=True).collect()
    assert clipped == []


def test_next_pages(spark, make_pages):
    limits = spark.createDataFrame([(1, 3, 5), (2, 20, 5)], LIMITS)
    items = [
        ("Total: 95", {"cnpj": "1", "page_idx": 0}),
        ("Total: 95", {"cnpj": "1", "page_idx": 2}),
        ("Total: 15", {"cnpj": "2", "page_idx": 1}),
        ("<a href='l?page=7'>próxima</a>", {"cnpj": "2", "page_idx": 4}),
        ("nada", {"cnpj": "2", "page_idx": 5}),
        ("<div class='consulta_paginas'><a href='x'>Seguinte</a></div>", {"cnpj": "2", "page_idx": 6}),
        ("<a href='x'>Seguinte</a>", {"cnpj": "2", "page_idx": 6}),
        ("<div class='consulta_paginas'><a href='x'>next</a></div>", {"cnpj": "2", "page_idx": 19}),
    ]
    # each its own URL; the first one was captured again
    items = [(h, {**c, "req_id": int(c["cnpj"]), "url": f"https://s.example/l?q={i}"}) for i, (h, c) in enumerate(items)]
    items.append((items[0][0], {**items[0][1], "page_id": 99}))
    pages = make_pages(items)
    form = {(r.page_id, r.page_idx, r.next_url) for r in pagination.next_pages_form(pages, limits).collect()}
    u = "https://s.example/l?q={}&page={}".format
    assert form == {(0, 1, u(0, 1)), (0, 2, u(0, 2)), (2, 2, u(2, 2)), (3, 5, "https://s.example/l?page=7")}
    stable = {(r.page_id, r.page_idx, r.next_url) for r in pagination.next_pages_stable(pages, limits, "https://s.example/r/").collect()}
    r = "https://s.example/r/"
    assert stable == {(0, 1, r + "1/1"), (2, 2, r + "2/2"), (3, 5, r + "2/5"), (5, 7, r + "2/7")}


@pytest.mark.parametrize(
    "given, expected",
    [((2, 5), (2, 5, 10)), ((None, None), (5, 10, 50)), ((99, 99), (20, 50, 1000)), ((0, -1), (5, 10, 50))],
)
def test_crawl_limits(spark, given, expected):
    row = intake.crawl_limits(spark.createDataFrame([(1, "cnpj", "x", *given)], CRAWL_REQUESTS)).first()
    assert (row.max_pages, row.max_details_per_page, row.max_total_details) == expected


def test_intake_splits_requests(spark):
    rows = [
        (1, "numero", A.replace("-", ""), None, None),
        (2, "numero", "123", None, None),
        (3, "cnpj", " 00.000.000/0001-91 ", None, None),
        (4, "cnpj", "1", None, None),
        (5, "nome", "x", None, None),
        (6, None, "x", None, None),
        (7, "cnpj", " ", None, None),
    ]
    result = intake.request_intake(spark.createDataFrame(rows, CRAWL_REQUESTS))
    good = {r.req_id: r.valor_normalizado for r in intake.accepted(result).collect()}
    bad = {r.req_id: r.reject_reason for r in intake.rejected(result).collect()}
    assert good == {1: A, 3: "00000000000191"}
    assert bad == {2: "invalid_npu", 4: "invalid_cnpj", 5: "invalid_mode", 6: "missing_parameter", 7: "missing_parameter"}
