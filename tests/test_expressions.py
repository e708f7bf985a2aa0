from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from docketry.functions import markup as M
from docketry.functions.text import (
    br_date_to_iso,
    clean_text,
    cnpj_digits,
    npu_digits,
    npu_hyphenated,
    strip_judge_title,
)
from docketry.functions.urls import page_url, url_join

WATCHED = [
    "0015648-78.1999.4.05.0000",
    "0012656-90.2012.4.05.0000",
    "0043753-74.2013.4.05.0000",
    "0002098-07.2011.4.05.8500",
    "0460674-33.2019.4.05.0000",
    "0000560-67.2017.4.05.0000",
]


@pytest.mark.parametrize(
    "expr, cases",
    [
        (
            npu_hyphenated,
            {
                "00156487819994050000": "0015648-78.1999.4.05.0000",
                "0015648-78.1999.4.05.0000": "0015648-78.1999.4.05.0000",
                " 0015648 78.1999.4.05.0000": "0015648-78.1999.4.05.0000",
                "123": "123",
                "": "",
                None: "",
            },
        ),
        (npu_digits, {"0015648-78.1999.4.05.0000": "00156487819994050000", None: "", "abc": ""}),
        (cnpj_digits, {"00.000.000/0001-91": "00000000000191", "": ""}),
        (
            br_date_to_iso,
            {
                "15/04/2000": "2000-04-15",
                "06/10/2020 03:13": "2020-10-06T03:13:00",
                "06/10/2020 03:13:45": "2020-10-06T03:13:00",
                " 6/1/2020  3:5 x": "2020-01-06T03:05:00",
                "1/2/20201": "2020-02-01",
                "31/02/2020": None,
                "06/10/2020 25:99": None,
                "01/01/0000": None,
                "01/01/0000 10:10": None,
                "29/02/2020": "2020-02-29",
                "29/02/2019": None,
                "x 01/01/2020": None,
                "x": None,
                "": None,
                None: None,
            },
        ),
        (
            clean_text,
            {
                "  Texto   com    espaços   ": "Texto com espaços",
                "Linha 1\n\n  Linha 2": "Linha 1 Linha 2",
                " a b\u001fc\u0085": "a b c",
                "": "",
                None: "",
            },
        ),
        (
            strip_judge_title,
            {
                "DESEMBARGADOR FEDERAL JOÃO DA SILVA": "JOÃO DA SILVA",
                "Des. Maria Santos": "Maria Santos",
                "JUÍZA FEDERAL ANA OLIVEIRA": "JUÍZA FEDERAL ANA OLIVEIRA",
                "juiza federal dra. Ana": "Ana",
                "DES DESEMBARGADORA DR. X": "X",
                "Dr. Des. Y": "Des. Y",
                "Desiderio": "Desiderio",
                "JUIZ": "JUIZ",
                None: "",
            },
        ),
    ],
)
def test_golden_values(values, expr, cases):
    assert dict(zip(cases, values(expr, list(cases)))) == cases


def test_watched_numbers_have_twenty_digits(values):
    assert values(npu_hyphenated, WATCHED) == WATCHED
    assert all(len(d) == 20 for d in values(npu_digits, WATCHED))


def test_dates_do_not_depend_on_the_session_zone(spark, values):
    # midnight of this day did not exist in this zone
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert values(br_date_to_iso, ["04/11/2018 00:30"]) == ["2018-11-04T00:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


BASES = [
    "https://site.example/cp/busca/lista?x=1#f",
    "https://site.example/cp/",
    "https://site.example",
    "http://site.example/a/b/c",
]
HREFS = [
    "", "/processo/1", "processo/1", "./p", "../p", "../../../p", "../p/./q/../r", "?page=2", "#topo",
    "//outro.example/x", "https://outro.example/y?z=1", "p?a=../b", "p#a/../b", "javascript:void(0)",
    "mailto:a@b.c", "p/", "..", ".", "/a/../b", "/a/./b/", "a//b", "/p;v=1?x#y",
]


def test_url_join_agrees_with_the_standard_library(spark):
    rows = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame(rows, "b string, h string")
    got = df.select("b", "h", url_join(F.col("b"), F.col("h")).alias("u")).collect()
    wrong = [(r.b, r.h, r.u, urljoin(r.b, r.h)) for r in got if r.u != urljoin(r.b, r.h)]
    assert wrong == []


def test_page_url_keeps_an_existing_parameter(values):
    out = values(lambda c: page_url(c, F.lit(3)), ["http://x/l", "http://x/l?page=2"])
    assert out == ["http://x/l?page=3", "http://x/l?page=2&page=3"]


def test_references_decode_once_and_keep_markup(values):
    texts = {
        "Jos&eacute; &#233; &#xE9; &nbsp;x": "José é é  x",
        "a &amp;lt; b": "a &lt; b",
        "&lt;b&gt; &quot;q&#39;": "<b> \"q'",
        "AT&T &foo; & &#0; &#xD800;": "AT&T &foo; & &#0; &#xD800;",
        "&#128512;": "\U0001f600",
        "sem": "sem",
        "Jos&eacute, &#233 &#x000000E9 &#0000000233;": "José, é é é",
        "caf&eacutes ?a=1&copy=2&amp=3 &copy 4 &lt": "caf&eacutes ?a=1&copy=2&amp=3 © 4 <",
        "&#99999999999999999999; &#xFFFFFFFFFFFFFFFFFFFF;": "&#99999999999999999999; &#xFFFFFFFFFFFFFFFFFFFF;",
    }
    got = values(lambda c: M.unescape(M.markup(c)), list(texts))
    assert dict(zip(texts, got)) == texts


def test_rows_cells_and_table_ends(values):
    html = (
        "<TABLE><thead><tr><th>h</th></tr></thead><tr class=x><td>1<td>2</tr>"
        "<tr><td> <b>3</b></td></tr></TABLE><!-- <tr><td>no</td></tr> --><table><tr><td>4</td></table><tr><td>5"
    )
    rows = values(lambda c: M.table_rows(M.markup(c)), [html])[0]
    assert [list(r["cells"]) for r in rows] == [[], ["1", "2"], [" <b>3</b>"], ["4"], ["5"]]
    assert [r["last"] for r in rows] == [True, False, True, True, False]


def test_long_pages_do_not_overflow(values):
    html = "<table>" + "<tr><td>" + "<i>x</i>" * 60_000 + "</td></tr></table>" + "<a href='/p'>" + "<b>y</b>" * 60_000
    n = values(lambda c: F.size(M.table_rows(M.markup(c))), [html])[0]
    links = values(lambda c: F.size(M.anchors(M.markup(c))), [html])[0]
    assert (n, links) == (1, 1)


HOSTILE = [
    '<a href="',
    "<a href='x'",
    "<!--",
    "<script>",
    "<p class='relator'>x<p>",
    "<div class='timeline'><li>",
    "<b>x",
    "</table><table>",
    "<table>",
    "&eacute &#0000000233;",
    "<a <a <a ",
    "<tr><td>x",
    "<b class=",
    "1234567",
    " " * 50,
    "&",
    "<p>RELATOR<br>",
    "<table><i>",
    "<div class='timeline'>",
]


def test_scans_stay_linear_on_large_hostile_pages(spark, make_pages):
    """A large page of each pattern through every page operator, within seconds."""
    import time

    from docketry.operators import classify, extract, frontier, health, pagination

    context = {"numero": "0015648-78.1999.4.05.0000", "cnpj": "1" * 14, "req_id": 1, "page_idx": 1, "busca": "numero"}
    start, end = "0015648-78.1999.4.05.0000 <p class='relator'>", "0012656-90.2012.4.05.0000"
    pages = make_pages([(start + h * (300_000 // len(h)) + end, {**context, "page_id": i}) for i, h in enumerate(HOSTILE)])
    limits = spark.createDataFrame([(1, 20, 50)], "req_id long, max_pages int, max_details_per_page int")
    html = F.col("html")
    results = {
        "records": extract.extract_processos(pages),
        "offline": extract.extract_processos(pages, "offline"),
        "cells": extract.page_cells(pages),
        "links": extract.page_links(pages),
        "forms": extract.form_fields(pages),
        "inputs": extract.inputs_by_keyword(pages, ["processo"]),
        "signals": classify.page_signals(pages),
        "class": classify.classify_pages(pages),
        "stable": classify.classify_stable_list(pages),
        "error": pages.select(classify.is_error(html), health.content_failure(F.lit(200), html)),
        "best": frontier.best_detail_link(pages),
        "form": frontier.frontier_form(pages, limits),
        "stable links": frontier.frontier_stable(pages, limits),
        "totals": pagination.list_totals(pages),
        "stable totals": pagination.stable_totals(pages),
        "navigation": pagination.nav_links(pages),
        "next form": pagination.next_pages_form(pages, limits),
        "next stable": pagination.next_pages_stable(pages, limits, "https://site.example/r"),
    }
    seconds = {}
    for name, result in results.items():
        begun = time.time()
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - begun, 1)
    assert max(seconds.values()) < 30, seconds


def test_class_names_match_whole_tokens(values):
    html = (
        '<p class="x relator y">a</p><p class=relator>b</p><p class="relatora">c</p>'
        "<p class='dados-relator'>d</p><p CLASS='relator'>e</p><p class='RELATOR'>f</p>"
    )
    assert values(lambda c: M.class_texts(c, "relator"), [html])[0] == ["a", "b", "e"]


def test_attributes_quoted_or_not(values):
    html = """<input name = "a" type='hidden' value=x1><input type="text" data-name="no" name=b>"""
    rows = values(lambda c: M.input_tags(M.markup(c)), [html])[0]
    assert [(r["name"], r["type"], r["value"]) for r in rows] == [("a", "hidden", "x1"), ("b", "text", "")]
