"""Page tables derived from the test tables.

No captured pages ship with the project, so pages are rendered from ``orders``
and ``customer`` (and the fetch log from ``events``). Every page is a projection
of one order or one customer; list pages group at most ten consecutive order
keys, which are unique. No key of the data can therefore make a page, a group or
a task grow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketry.operators.intake import accepted, crawl_limits, request_intake
from docketry.sources.pages import land_raw_pages

SITE = "https://docket.example"
PLAIN_SITE = "http://docket.example"
ROUTE = f"{SITE}/processo/cpf/porData/ativos"
FILLER = "conteudo " * 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: pages that one task renders and reads
TASK_ROWS = 50_000


def spread(df: DataFrame, *keys: str, like: DataFrame | None = None) -> DataFrame:
    """Deal narrow rows in tasks of about TASK_ROWS, before pages are rendered from them.

    A test table is one small file, however many pages it makes: there are as many tasks
    as its rows (those of ``like``, a stored table that df joins) fill, at least one per core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-(df if like is None else like).count() // TASK_ROWS)), *keys)


def _text(c: Column) -> Column:
    return c.cast("string")


def _cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _iso_second(offset: Column) -> Column:
    """2024-01-01 plus some seconds, as zone-free ISO text."""
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    stamp = base + F.make_dt_interval(secs=(offset % 100_000_000).cast("decimal(18,6)"))
    return F.replace(stamp.cast("string"), F.lit(" "), F.lit("T"))


def case_number(k: Column, year: Column) -> Column:
    """Unique for order keys below 10^11."""
    return _cat(
        F.lpad(_text(k % 10_000_000), 7, "0"), "-", F.lpad(_text(k % 97), 2, "0"), ".", _text(year),
        ".4.05.", F.lpad(_text(F.floor(k / 10_000_000) % 10_000), 4, "0"),
    )


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, nm, d, status, npu, npu2 per order (npu2 = a neighbour's number)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    names = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    named = orders.join(names, F.col("o_custkey") == F.col("c_custkey"))
    return spread(named, "o_orderkey", like=orders).select(
        k.alias("k"),
        F.col("c_name").alias("nm"),
        d.alias("d"),
        F.col("o_orderstatus").alias("status"),
        case_number(k, F.year(d)).alias("npu"),
        case_number(k + 1, F.year(d)).alias("npu2"),
    )


def _br(d: Column) -> Column:
    return F.date_format(d, "dd/MM/yyyy")


def _pages(rows: DataFrame, html: Column, url: Column, page_id: Column, **context: Column) -> DataFrame:
    """Fetched pages. The content goes through a generator so that filters on it
    are applied to the rendered text instead of rendering it once more."""
    return rows.select(
        page_id.cast("bigint").alias("page_id"),
        url.alias("url"),
        F.lit("GET").alias("method"),
        F.lit(200).alias("status"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html")).alias("headers"),
        F.named_struct(*[x for n, c in context.items() for x in (F.lit(n), c)]).alias("context"),
        _iso_second(page_id).alias("fetched_at"),
        F.explode(F.array(html)).alias("html"),
    )


def detail_html() -> Column:
    """Detail page of an order; variants cover the judge, date and movement rules."""
    k, nm, d, npu = F.col("k"), F.col("nm"), F.col("d"), F.col("npu")
    v = k % 6
    filed_text = F.when(k % 50 == 49, _cat("31/02/", _text(F.year(d)))).otherwise(_br(d))
    filed = (
        F.when(k % 3 == 0, _cat("<p>AUTUADO EM ", filed_text, "</p>"))
        .when(k % 3 == 1, _cat("<p>Autua&ccedil;&atilde;o: ", filed_text, "</p>"))
        .otherwise(_cat('<span class="campo data-autuacao">', filed_text, "</span>"))
    )
    judge_row = (
        F.when(v == 0, _cat("<tr><td>RELATOR</td><td>: <b>DESEMBARGADOR FEDERAL ", nm, "</b></td></tr>"))
        .when(v == 3, _cat("<tr><td>Relatora</td><td>JUÍZA FEDERAL ", nm, "</td></tr>"))
        .otherwise("")
    )
    judge_text = (
        F.when(v == 1, _cat('<div class="info magistrado">Des. ', nm, "</div>"))
        .when(v == 2, _cat("<p>RELATOR: DR. ", nm, "</p>"))
        .when(v == 4, _cat("<h3>RELATORA: ", nm, "</h3>"))
        .otherwise("")
    )

    def respondent(j: Column) -> Column:
        name = F.when(j % 3 == 0, "Jos&eacute;&nbsp;&amp;").when(j % 3 == 1, "Jos&eacute &amp").otherwise("Jos&#000000233 &")
        row = _cat("<tr><td>APDO</td><td>: ", name, " Cia ", _text(j), "</td></tr>")
        return F.when(j > 0, row).otherwise("")

    parties = _cat(
        "<table>", judge_row, "<tr><td>APTE</td><td>: ", nm, "</td></tr>",
        F.array_join(F.transform(F.sequence(F.lit(0), k % 4), respondent), ""),
        "<tr><td>ADV</td><td> <b>Fulano</b></td></tr></table>",
    )

    def movement(i: Column) -> Column:
        when = _cat(
            _br(F.date_add(d, i.cast("int"))), " ", F.lpad(_text(k % 24), 2, "0"), ":", F.lpad(_text(k % 60), 2, "0")
        )
        listed = _cat(
            '<div class="item"><span class="data">', when, '</span><p class="texto">Despacho ',
            _text(k), "-", _text(i), "</p></div>",
        )
        lead = F.when(v == 4, _cat("Seq ", _text(i))).otherwise("")
        anchored = _cat(
            '<tr><td><a name="mov_', _text(i), '">Em ', when, "</a></td></tr>\n<tr><td>", lead,
            "</td><td>Juntada de pe&ccedil;a ", _text(k * 10 + i), " [Guia: ", _text(i), "] lixo</td></tr>",
        )
        return F.when(i < 0, "").when(v == 5, listed).otherwise(anchored)

    movements = F.array_join(F.transform(F.sequence(F.lit(0), k % 5), lambda i: movement(i - 1)), "")
    timeline = F.when(v == 5, _cat('<div class="timeline">', movements, "</div>")).otherwise(
        _cat("<table>", movements, "</table>")
    )
    return _cat(
        "<!DOCTYPE html><html><head><title>Consulta</title><!-- <tr><td>X</td><td>Y y</td></tr> -->",
        "</head><body><p>PROCESSO Nº ", npu, "</p><p>(", F.substring(_text(F.year(d)), 3, 2), ".05.", _text(k),
        "-", _text(k % 10), ")</p>", filed, judge_text, parties, timeline, "</body></html>",
    )


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched detail pages, one per order; every seventh lacks its stored type."""
    rows = cases(spark, sf_dir)
    k = F.col("k")
    return _pages(
        rows,
        detail_html(),
        _cat(f"{SITE}/processo/", F.col("npu")),
        k,
        tipo=F.when(k % 7 != 0, "detalhe"),
        busca=F.lit("numero"),
        numero=F.col("npu"),
        endpoint=F.lit("detalhe"),
    )


def nested_html() -> Column:
    """Detail page of an order inside of a layout table, with tables inside of its cells."""
    k, nm, npu = F.col("k"), F.col("nm"), F.col("npu")
    judge = F.when(
        k % 4 == 3, _cat("<table><tr><td>DESEMBARGADOR FEDERAL ", nm, "</td></tr></table>")
    ).otherwise(_cat(": <b>DESEMBARGADOR FEDERAL ", nm, "</b>"))
    others = F.transform(
        F.sequence(F.lit(0).cast("bigint"), k % 3),
        lambda j: F.when(j > 0, _cat("<tr><td>APDO</td><td>: Parte ", _text(j), "</td></tr>")).otherwise(""),
    )
    return _cat(
        "<html><body><p>", npu, '</p><table width="100%"><tr><td>Menu</td><td><table><tr><td>RELATOR</td><td>', judge,
        "</td></tr><tr><td>APTE</td><td><table><tr><td>", nm, "</td><td>Valor ", _text(k),
        "</td></tr></table></td><td>resto ", _text(k), "</td></tr>", F.array_join(others, ""),
        "</table></td><td>Rodape ", _text(k), "</td></tr></table></body></html>",
    )


def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched detail pages built of nested tables, one per order."""
    k, npu = F.col("k"), F.col("npu")
    url = _cat(f"{SITE}/processo/", npu)
    return _pages(cases(spark, sf_dir), nested_html(), url, k, tipo=F.lit("detalhe"), numero=npu)


def text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages whose single movement is a whole document text."""
    text = F.col("text")
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(name))
    npu = case_number(F.col("doc_id"), F.lit(2002))
    html = _cat(
        "<html><body><p>", npu, '</p><table><tr><td><a name="mov_1">Em 01/02/2002 03:04</a></td></tr>',
        "<tr><td></td><td>", text, "</td></tr></table></body></html>",
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _pages(
        spread(documents, "doc_id"), html, _cat(f"{SITE}/processo/", npu), F.col("doc_id"), tipo=F.lit("detalhe"), numero=npu
    )


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched list pages: ten consecutive order keys per page, a hundred per crawl."""
    rows = cases(spark, sf_dir).select("k", "npu")
    tens = rows.groupBy(F.floor(F.col("k") / 10).alias("ten")).agg(
        F.array_sort(F.collect_list(F.struct("k", "npu"))).alias("items")
    )
    # at most ten pages per crawl, as order keys are unique
    crawl_pages = Window.partitionBy("crawl")
    pages = tens.withColumn("crawl", F.floor(F.col("ten") / 10)).withColumn(
        "n", F.sum(F.size("items")).over(crawl_pages)
    )
    c, i, n = F.col("crawl"), F.col("ten") % 10, F.col("n")
    last = F.ceil(n / 10) - 1
    cnpj = F.lpad(_text(c), 14, "0")

    def item(x: Column) -> Column:
        link = F.when(c % 2 == 0, _cat('<a class="btn linkar" href="/processo/', x["npu"])).otherwise(
            _cat(f'<a href="{PLAIN_SITE}/cp/processo/', x["npu"])
        )
        dated = F.when(c % 3 == 1, "<td>12/03/2001</td>").otherwise("")
        return _cat("<tr><td>", link, '">', x["npu"], "</a></td>", dated, "</tr>")

    total = F.when(c % 3 == 2, "").otherwise(
        _cat('<span class="texto_consulta">Total: ', _text(n), "</span>")
    )
    following = F.when(i < last, _cat('<a href="?page=', _text(i + 1), '">Próxima</a>')).otherwise("")
    earlier = F.when(
        i > 0, _cat('<a href="?page=0">Primeira</a><a class="volta" href="?page=', _text(i - 1), '"> &lt; </a><a href="?page=', _text(i - 1), '"> anterior</a>')
    ).otherwise("")
    final = F.when(c % 2 == 0, _cat('<a href="?page=', _text(last), '">>></a>')).otherwise("")
    numbers = F.array_join(
        F.transform(
            F.sequence(F.lit(0).cast("bigint"), last), lambda p: _cat('<a href="?page=', _text(p), '">', _text(p), "</a>")
        ),
        " ",
    )
    html = _cat(
        '<html><body><table class="consulta_resultados"><tr><th>CNPJ:</th><td>', cnpj, "</td></tr>",
        F.array_join(F.transform("items", item), ""), '</table><div class="consulta_paginas">', total,
        earlier, following, final, numbers, "</div></body></html>",
    )
    return _pages(
        pages,
        html,
        _cat(f"{ROUTE}/", cnpj, "/", _text(i)),
        F.col("ten"),
        tipo=F.lit("lista"),
        busca=F.lit("cnpj"),
        cnpj=cnpj,
        page_idx=i.cast("int"),
        endpoint=F.lit("stable_route"),
        req_id=c,
    )


SECOND, AGAIN = 10**12, 2 * 10**12


def repeated_list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List pages of two requests per tax id, every third page of the first captured again."""
    pages = list_pages(spark, sf_dir)
    second = pages.withColumn("page_id", F.col("page_id") + SECOND).withColumn(
        "context", F.col("context").withField("req_id", F.col("context.req_id") + SECOND)
    )
    again = pages.where(F.col("page_id") % 3 == 0).withColumn("page_id", F.col("page_id") + AGAIN)
    return pages.unionByName(second).unionByName(again)


def second_limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits of both requests of a tax id: the second may read 2 pages of 3 details."""
    first = crawl_limit_rows(spark, sf_dir)
    own = {"max_pages": 2, "max_details_per_page": 3, "max_total_details": 6}
    second = first.withColumn("req_id", F.col("req_id") + SECOND).withColumns({n: F.lit(v) for n, v in own.items()})
    return first.unionByName(second)


def link_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages of a number search, one per order, with good and bad links."""
    k, npu, npu2 = F.col("k"), F.col("npu"), F.col("npu2")
    v = k % 4
    noise = _cat(
        '<a href="#processo">topo</a><a href="javascript:processo()">x</a><a href="/">/</a><a href="">vazio</a>',
        '<a class="linkar" href="/processo/movimentacao/', npu, '">mov</a>',
    )
    links = (
        F.when(v == 0, _cat('<a href="/cp/processo/', npu2, '">a</a><a class="x linkar" href="/processo/', npu, '">b</a>'))
        .when(v == 1, _cat('<a href="/cp/processo/', npu2, '?a=1&amp;b=2">a</a><a href="../processo/', npu2, '">b</a>'))
        .when(v == 2, _cat('<a class="linkar" href="/processo/', npu2, '">a</a><a href="/x/processo/', npu, '?a=1">b</a>'))
        .otherwise('<a href="processos.html">a</a><a href="/processo/lista">b</a>')
    )
    html = _cat("<html><body>", noise, links, "</body></html>")
    return _pages(
        cases(spark, sf_dir),
        html,
        _cat(f"{SITE}/cp/busca/q?n=", _text(k)),
        k,
        tipo=F.lit("lista"),
        busca=F.lit("numero"),
        numero=npu,
        page_idx=F.lit(0),
        endpoint=F.lit("form"),
    )


def mixed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per order over all classes, with stored labels that may be wrong."""
    k, npu, npu2 = F.col("k"), F.col("npu"), F.col("npu2")
    kind = k % 12

    def page(*parts: Column | str) -> Column:
        return _cat("<html><body><p>", FILLER, "</p>", *parts, "</body></html>")

    html = (
        F.when(kind == 0, page("<p>", npu, "</p><td>APTE</td>"))
        .when(kind == 1, "")
        .when(kind == 2, "<html><body>oi</body></html>")
        .when(kind == 3, _cat("<body>", FILLER, "</body>"))
        .when(kind == 4, page("Nenhum  resultado encontrado"))
        .when(kind == 5, page("O Número do Processo informado não é válido"))
        .when(kind == 6, page("Total: ", _text(k % 90)))
        .when(kind == 7, page('<a href="?page=2">Próxima</a>'))
        .when(kind == 8, page("<table><tr><td>", npu, "</td></tr><tr><td>", npu2, "</td></tr></table>"))
        .when(kind == 9, page("PROCESSO Nº 123 RELATOR X APTE Y 15/04/2000"))
        .when(kind == 10, page("nada"))
    )
    return _pages(
        cases(spark, sf_dir),
        html,
        _cat(f"{SITE}/pagina/", _text(k)),
        k,
        tipo=F.when(k % 5 == 0, "lista").when(k % 5 == 1, "detalhe").when(k % 5 == 2, "outro"),
        busca=F.when(k % 2 == 0, "numero").otherwise("cnpj"),
        numero=F.when(k % 2 == 0, F.when(k % 9 == 0, "123").otherwise(npu)),
        cnpj=F.when(k % 2 == 1, F.lpad(_text(k), 14, "0")),
        page_idx=F.when(k % 4 == 1, (k % 8 - 4).cast("int")),
        endpoint=F.lit("form"),
    )


def form_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search forms, one per customer, with duplicate and blank hidden names."""
    q = F.col("c_custkey")
    t = _text(q)
    html = _cat(
        '<html><body><form><input type="hidden" name="sessao" value="', t, '">',
        '<input type="hidden" name=" token " value="a&amp;', t, '"><input type="hidden" name="" value="x">',
        "<input type='hidden' name='sessao' value='dup", t, "'><input type=hidden name=vazio>",
        '<input type="hidden" name="tipo" value="velho"><input type="text" name="NumProcesso" value="y">',
        "</form></body></html>",
    )
    return _pages(
        spread(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey"),
        html,
        F.lit(f"{SITE}/cp/"),
        q,
        tipo=F.lit("form"),
        busca=F.when(q % 2 == 0, "numero").otherwise("cnpj"),
        numero=F.when(q % 2 == 0, case_number(q, F.lit(2001))),
        cnpj=F.when(q % 2 == 1, F.lpad(t, 14, "0")),
        endpoint=F.lit("form"),
    )


def crawl_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per customer; some are incomplete or invalid."""
    q = F.col("c_custkey")
    mode = F.when(q % 10 < 4, "cnpj").when(q % 10 < 8, "numero").when(q % 10 == 8, "outro")
    tax_id = F.lpad(_text(q), 14, "0")
    dotted = F.regexp_replace(tax_id, r"^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$", "$1.$2.$3/$4-$5")
    number = case_number(q, F.lit(2001))
    value = (
        F.when(q % 20 == 0, F.substring(tax_id, 1, 13))
        .when(q % 10 < 4, F.when(q % 2 == 0, dotted).otherwise(_cat(" ", tax_id, " ")))
        .when(q % 20 == 4, "123")
        .when(q % 10 < 8, F.when(q % 2 == 0, number).otherwise(F.regexp_replace(number, r"\D", "")))
        .when(q % 20 == 8, "  ")
        .otherwise("1")
    )
    return table(spark, sf_dir, "customer").select(
        q.alias("req_id"),
        mode.alias("modo"),
        value.alias("valor"),
        F.when(q % 4 == 1, 0).when(q % 4 == 2, 3).when(q % 4 == 3, 99).alias("max_pages"),
        F.when(q % 3 == 1, 7).when(q % 3 == 2, 99).alias("max_details_per_page"),
    )


def crawl_limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effective limits per accepted tax id."""
    requests = accepted(request_intake(crawl_requests(spark, sf_dir)))
    by_cnpj = requests.where(F.col("modo") == "cnpj").withColumn("valor", F.col("valor_normalizado"))
    return crawl_limits(by_cnpj, "valor")


def raw_pages(fetched: DataFrame) -> DataFrame:
    return land_raw_pages(fetched)


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case records as applied to the table: one to three captures per order.

    The second capture of an order is a re-extraction (no legacy number).
    """
    rows = cases(spark, sf_dir).select(
        "k", "npu", "nm", "d", "status", F.explode(F.sequence(F.lit(0), F.col("k") % 3)).alias("r")
    )
    k, r = F.col("k"), F.col("r")
    rerun = r == 1
    null = F.lit(None).cast("string")
    return rows.select(
        (k * 4 + r).alias("seq"),
        F.col("npu").alias("_id"),
        F.col("npu").alias("numero_processo"),
        F.when(~rerun, _cat("99.05.", _text(k), "-", _text(k % 10))).alias("numero_legado"),
        F.when(k % 11 == 0, _br(F.col("d"))).when(k % 11 > 1, _text(F.col("d"))).alias("data_autuacao"),
        F.when(k % 13 == 0, null)
        .when(k % 13 == 1, "")
        .when(k % 13 == 2, _cat("Juiz ", F.col("nm"), " ", _text(r)))
        .otherwise(F.col("nm"))
        .alias("relator"),
        F.transform(
            F.slice(F.sequence(F.lit(1), F.lit(4)), F.lit(1), (k % 4).cast("int")),
            lambda j: F.struct(F.when(j != 3, "APTE").alias("papel"), _cat("Parte ", _text(j)).alias("nome")),
        ).alias("envolvidos"),
        F.when(
            k % 17 != 0,
            F.transform(
                F.slice(F.sequence(F.lit(0), F.lit(4)), F.lit(1), (k % 5).cast("int")),
                lambda i: F.struct(
                    F.when(i == 3, _br(F.col("d"))).otherwise(_text(F.date_add(F.col("d"), i))).alias("data"),
                    _cat("Movimento ", _text(i)).alias("texto"),
                ),
            ),
        ).alias("movimentacoes"),
        _cat(f"{SITE}/processo/", F.col("npu")).alias("fonte_url"),
        _iso_second(k * 4 + r).alias("scraped_at"),
        F.when(rerun, _iso_second(k)).alias("reprocessed_at"),
        F.when(rerun, _text(k)).alias("reprocessed_from_doc"),
        F.col("status").alias("status"),
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` read as responses and exceptions of four hosts."""
    kind, user, e = F.col("event_type"), F.col("user_id"), F.col("event_id")
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    failed = kind == "signup"
    body = F.when(
        (kind == "view") & (user % 5 == 0), _cat("<html><body>Service Unavailable ", FILLER, "</body></html>")
    ).otherwise(_cat("<html><body>", FILLER, "</body></html>"))
    endpoint = F.element_at(
        F.array(*[F.lit(x) for x in ("form", "detail", "list", "stable_route", "detalhe")]), (e % 5 + 1).cast("int")
    )
    return spread(table(spark, sf_dir, "events"), "event_id").select(
        _cat("h", _text(user % 4)).alias("host"),
        e.alias("seq"),
        F.timestamp_micros(F.floor(micros / 10).cast("bigint")).alias("ts"),
        _cat(f"{SITE}/fetch/", _text(e)).alias("url"),
        endpoint.alias("endpoint"),
        F.when(~failed, F.when(kind == "error", 503).otherwise(200)).alias("status"),
        F.when(~failed, body).alias("html"),
        F.when(failed, F.when(user % 3 == 0, "ValueError").otherwise("TimeoutError")).alias("exception"),
        (e % 7).cast("int").alias("retry_times"),
        F.when(e % 3 == 1, 45.0).when(e % 3 == 2, 100.0).alias("download_timeout"),
    )


def chained_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fetch log with seven attempts per request, few of them with a logged timeout; every third request is the same form."""
    request = F.floor(F.col("seq") / 7)
    names = F.array(*[F.lit(x) for x in ("list", "form", "stable_route", "detail", "list")])
    return fetch_log(spark, sf_dir).withColumns(
        {
            "host": _cat("h", _text(request % 2)),
            "url": F.when(request % 3 == 0, f"{SITE}/form").otherwise(_cat(f"{SITE}/request/", _text(request))),
            "endpoint": F.element_at(names, (request % 5 + 1).cast("int")),
            "download_timeout": F.when((F.col("seq") % 7 == 0) & (request % 4 == 1), 45.0).when(F.col("seq") % 35 == 17, 20.0),
        }
    )


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` read as fetched pages without any stored type."""
    p = F.col("page_id")
    return spread(table(spark, sf_dir, "pages"), "page_id").select(
        p,
        "url",
        F.lit("GET").alias("method"),
        F.lit(200).alias("status"),
        F.create_map(
            F.encode(F.lit("Content-Type"), "ISO-8859-1"),
            F.array(F.encode(F.lit("text/html; título"), "ISO-8859-1"), F.encode(F.lit("text/plain"), "ISO-8859-1")),
        ).alias("headers"),
        F.struct(
            F.when(p % 3 == 0, "lista").when(p % 3 == 1, "detalhe").alias("tipo"),
            F.when(p % 2 == 0, "numero").otherwise("cnpj").alias("busca"),
            F.when(p % 2 == 1, F.lpad(_text(p), 14, "0")).alias("cnpj"),
            F.when(p % 4 == 0, (p % 8).cast("int")).alias("page_idx"),
            F.lit("dropped").alias("session"),
        ).alias("context"),
        _iso_second(p % 50).alias("fetched_at"),
        "html",
    )
