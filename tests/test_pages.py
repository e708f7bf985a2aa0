"""Classification and extraction on hand-written pages."""

from pyspark.sql import functions as F

from docketry.operators import classify, extract
from docketry.sources import rendered as R

NPU = "0015648-78.1999.4.05.0000"
PAD = "<p>" + "conteudo " * 20 + "</p>"


def _classes(make_pages, items):
    rows = classify.classify_pages(make_pages(items)).orderBy("page_id").collect()
    return [r["page_class"] for r in rows]


def test_cascade(make_pages):
    cases = {
        "PROCESSO Nº 123 RELATOR APTE AUTOR 15/04/2000": "detail",
        f"<html>{NPU} juiz  federal</html>": "detail",
        f"<html>{NPU} 1/2/2003": "detail",
        f"<html><body>{PAD}{NPU}</body></html>": "error",
        "total: 12": "list",
        "<a>PRÓXIMA</a>": "list",
        "<td> 7 </td>": "list",
        f"<table>{NPU} {NPU.replace('1999', '2001')}\n</table>": "list",
        f"<table>{NPU}</table>": "error",
        "": "error",
        None: "error",
        f"<html><body>{PAD}</body></html>": "error",
    }
    assert _classes(make_pages, list(cases)) == list(cases.values())


def test_is_error_marks(values):
    full = f"<html><body>{PAD}página 3</body></html>"
    cases = {
        full: False,
        full.replace("<body>", "<div>"): True,
        full + "Erro 500": True,
        full + "manutenção": True,
        full + "não foi encontrado": False,
        full + "não foram encontrados": True,
        "página 1": True,
    }
    assert values(classify.is_error, list(cases)) == list(cases.values())


def test_stable_list_class(values):
    cases = {
        "<table class=consulta_resultados>": "list",
        "<th class='x'> cnpj </th>": "list",
        "consulta_resultados: o número do processo informado não é válido": "error",
        "<html>": "error",
        "": "error",
    }
    assert values(classify.stable_list_class, list(cases)) == list(cases.values())


def _judges(make_pages, items, profile="online"):
    rows = extract.extract_relator(make_pages(items), profile).orderBy("page_id").collect()
    return [r["relator"] for r in rows]


def test_judge_strategies_in_order(make_pages):
    cases = {
        "<table><tr><td>Relator</td><td>; <strong>Des. A B</strong></td></tr></table><p class=juiz>Z</p>": "A B",
        "<table><tr><td>RELATOR</td><td>:</td></tr><tr><td>Relatora</td><td>Dra. C D</td></tr></table>": "C D",
        "<div class='juiz'> </div><span class='desembargador'>RELATOR: E F</span>": "E F",
        "<div class=magistrado>G</div><div class=relator>H</div>": "H",
        "<div>RELATOR</div> <div>JUIZ FEDERAL I J</div>": "I J",
        "<p><b>RELATOR</b> <i>x</i> DR. K L</p>": "K L",
        "<div class=info-relator>M N</div>": "M N",
        "<div class='relator'><b>Relator</b> Des. <i>x</i> Xis</div>": "Des.",
        "<div class='relator'><b>Relator</b><br> Des. Xis</div>": "Xis",
        "<div>a</div><div><b>RELATOR</b></div><div>Des. Ypsilon</div>": "Ypsilon",
        "<div class=juiz><p>oculto</p></div><h5>JUIZ FEDERAL Zeta</h5>": "Zeta",
        "<h3>Relator: Oto P</h3>": "Oto P",
        "<h3>RELATORA: Q R</h3>": "A: Q R",
        "<h3>RELATOR: ab</h3><h4>DESEMBARGADOR FEDERAL: Sa T</h4>": "Sa T",
        "<h3>JUIZA FEDERAL Ul V</h3>": "Ul V",
        "<h3>nada</h3>": None,
        "<h3>RELATOR: abc</h3>": None,
    }
    assert _judges(make_pages, list(cases)) == list(cases.values())


def test_offline_judge_skips_elements(make_pages):
    pages = ["<div class=magistrado>Des. X Y</div>", "<h1>RELATOR: Z W Q</h1>"]
    assert _judges(make_pages, pages, "offline") == [None, "Z W Q"]


def test_filing_date_rules(make_pages):
    cases = {
        "AUTUADO  em 1/2/2003 <p>Data: 09/09/2009</p>": ("2003-02-01", "2009-09-09"),
        "AUTUADO EM 31/02/2003 <p>Data: 09/09/2009</p>": (None, "2009-09-09"),
        "<p>Data: x</p><p>Autua&ccedil;&atilde;o em 05/06/2007</p>": ("2007-06-05", "2007-06-05"),
        "<b class='autuacao'>03/04/2005</b><i class='data-autuacao'>01/01/2001</i>": ("2001-01-01", None),
        "<p>01/01/2001</p>": (None, None),
    }
    pages = make_pages(list(cases))
    got = [
        [r[0] for r in extract.extract_data_autuacao(pages, p).orderBy("page_id").select("data_autuacao").collect()]
        for p in ("online", "offline")
    ]
    assert list(zip(*got)) == list(cases.values())


def test_number_hidden_by_references(make_pages):
    items = [
        "<p>Processo: 0015648&#45;78.1999.4.05.0000</p>",
        "<p class='numero-processo'>0015648&#45;78.1999.4.05.0000</p>",
        "<p>0015648&#45;78.1999.4.05.0000</p>",
        f"<script>{NPU}</script>",
    ]
    rows = extract.extract_numero(make_pages(items)).orderBy("page_id").collect()
    assert [r["numero"] for r in rows] == [NPU, NPU, None, NPU]
    rows = extract.extract_numero(make_pages(items), "offline").orderBy("page_id").collect()
    assert [r["numero"] for r in rows] == [NPU, None, None, NPU]


PARTIES = (
    "<table><tr><td>RELATOR</td><td>: <b>X</b></td></tr><tr><td>APTE</td><td>: :A&nbsp;B</td></tr>"
    "<tr><td>APDO</td><td>C</td></tr><tr><td></td><td>D E</td></tr><tr><td>ADV</td><td><b>F G</b></td></tr>"
    "<tr><th>z</th><td>só</td></tr></table>"
)


def test_parties_by_profile(make_pages):
    pages = make_pages([PARTIES])
    online = [(r.papel, r.nome) for r in extract.extract_envolvidos(pages).orderBy("pos").collect()]
    offline = [(r.papel, r.nome) for r in extract.extract_envolvidos(pages, "offline").orderBy("pos").collect()]
    assert online == [("APTE", ":A B"), ("ADV", "F G")]
    assert offline == [("RELATOR", ":"), ("APTE", ": :A B"), ("APDO", "C"), ("ADV", "F G")]


MOVES = (
    "<table><tr><td><a name='mov_1'>Em 11/09/2021 16:50</a></td></tr><tr><td></td><td>Juntada longa [Guia: 1] x</td></tr>"
    "<tr><td><a name='mov_2'>Em 31/02/2021 16:50</a></td></tr><tr><td></td><td>Data ruim aqui</td></tr>"
    "<tr><td><a name='mov_3'>Em 01/01/2021 1:5</a></td></tr><tr><td></td><td>Curto</td></tr>"
    "<tr><td><a name='mov_5'>Em 03/01/2021 10:00</a></td></tr><tr><th>1</th><td class=x>Depois do cabecalho</td><td>z</td></tr>"
    "<tr><td><a name='mov_6'>Em 04/01/2021 10:00</a></td></tr><tr><td>1</td><th>2</th><td>Terceira celula</td></tr>"
    "<tr><td><a name='mov_4'><b>Em 02/01/2021 10:00</b></a></td></tr></table>"
    "<table><tr><td></td><td>Outra tabela nao conta</td></tr></table>"
)
LISTED = (
    "<div class='andamentos'><div class='movimento'><i class='timestamp'>03/04/2005 06:07</i><p class='descricao'>Um  dois</p></div>"
    "<div class='item'><i class='data'>x</i><p class='texto'>sem data</p></div>"
    "<div class='item'><i class='data'>04/04/2005</i><p class='texto'>Outro</p></div></div>"
)


def test_movements_by_anchor_then_by_list(make_pages):
    pages = make_pages([MOVES, LISTED, MOVES + LISTED])
    rows = extract.extract_movimentacoes(pages).orderBy("page_id", "pos").collect()
    anchored = [("2021-09-11T16:50:00", "Juntada longa"), ("2021-01-03T10:00:00", "Depois do cabecalho")]
    listed = [("2005-04-03T06:07:00", "Um dois"), ("2005-04-04", "Outro")]
    by_page = {i: [(r.data, r.texto) for r in rows if r.page_id == i] for i in range(3)}
    assert by_page == {0: anchored, 1: listed, 2: anchored}
    off = extract.extract_movimentacoes(pages, "offline").orderBy("page_id", "pos").collect()
    assert {i: [(r.data, r.texto) for r in off if r.page_id == i] for i in range(3)} == {0: [], 1: listed, 2: listed}


def test_record_needs_a_number(make_pages):
    pages = make_pages([f"<html>{NPU} (99.05.15648-8) AUTUADO EM 15/04/2000{PARTIES}{MOVES}", "<html>APTE 1/2/2003"])
    rows = extract.extract_processos(pages).collect()
    assert [(r["_id"], r["numero_legado"], r["data_autuacao"], r["relator"]) for r in rows] == [
        (NPU, "99.05.15648-8", "2000-04-15", "X")
    ]
    off = extract.extract_processos(pages, "offline", "2025-01-01T00:00:00").first()
    assert (off["numero_legado"], off["data_autuacao"], off["scraped_at"], off["reprocessed_from_doc"]) == (
        None, None, "2025-01-01T00:00:00", "0",
    )


def test_form_fields_last_value_wins(make_pages):
    html = (
        "<input type='hidden' name='a' value='1'><input type='hidden' name='b' value='2'>"
        "<input type='hidden' name='a' value='3'><input type='hidden' name=' ' value='4'>"
        "<input type='HIDDEN' name='c' value='5'><input type='hidden' name='filtro' value='6'>"
    )
    pages = make_pages([(html, {"busca": "cnpj", "cnpj": "00000000000191"})])
    fields = extract.form_fields(pages).first()["fields"]
    assert fields == {"a": "3", "b": "2", "tipo": "xmlcpf", "filtro": "00000000000191"}


def test_indicator_report_counts_only_non_details(make_pages):
    pages = make_pages([f"{NPU} processo", f"{NPU} autor", "andamento 1/2/2003"])
    got = {r.indicator: r.hits for r in classify.page_indicator_report(pages).collect()}
    assert got["npu"] == 1 and got["processo_ref"] == 1 and got["movimentacao"] == 1 and got["envolvidos"] == 0


def test_confusion_of_stored_and_computed(make_pages):
    pages = make_pages([("total: 3", {"tipo": "detalhe"}), ("", {})])
    got = {(r.stored, r.computed): r.n for r in classify.label_confusion(pages).collect()}
    assert got == {("detalhe", "list"): 1, ("undefined", "error"): 1}


def test_signals_are_one_column_each(make_pages):
    row = classify.page_signals(make_pages(["Relator 1/2/2003 total: 4"])).first().asDict()
    on = {k for k, v in row.items() if v is True}
    assert on == {"sig_judge_1", "sig_timeline_4", "sig_total_1", "sig_short"}


def test_pages_are_rendered_in_tasks_of_a_bounded_number_of_rows(spark, sf, monkeypatch):
    monkeypatch.setattr(R, "TASK_ROWS", 40)
    n = R.table(spark, sf, "customer").count()
    assert R.form_pages(spark, sf).rdd.getNumPartitions() == max(spark.sparkContext.defaultParallelism, -(-n // 40))
    orders = R.table(spark, sf, "orders").count()
    assert R.cases(spark, sf).rdd.getNumPartitions() == -(-orders // 40) > spark.sparkContext.defaultParallelism


def test_inputs_of_a_form_are_read_once(make_pages):
    form = '<input type="hidden" name="a" value="1">'
    plan = extract.form_fields(make_pages([form])).select(F.explode("fields"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"(?i)<input\b") == 1
