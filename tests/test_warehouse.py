"""Landing, merge, validation, layout and reports on small tables."""

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from docketry.operators import reports, upsert, validate
from docketry.plans import ingest
from docketry.schemas import PROCESSOS, L, T
from docketry.sources import pages as pg
from docketry.sources import snapshots

N = [f"000000{i}-00.2000.4.05.0000" for i in range(10)]
OK_STAMP = "2024-01-01T00:00:00"
BATCH = T.StructType([T.StructField("seq", L), *PROCESSOS.fields])


def record(key, **over):
    base = dict(
        _id=key, numero_processo=key, numero_legado="99.05.1-1", data_autuacao="2000-04-15", relator="A B",
        envolvidos=[("APTE", "X")], movimentacoes=[("2000-04-15", "Texto")], fonte_url="u", scraped_at=OK_STAMP,
        reprocessed_at=None, reprocessed_from_doc=None,
    )
    base.update(over)
    return tuple(base[f] for f in upsert.FIELDS)


def table(spark, rows):
    return spark.createDataFrame(rows, PROCESSOS)


def batch(spark, rows):
    return spark.createDataFrame([(seq, *r) for seq, r in rows], BATCH)


def as_dict(df):
    return {r["_id"]: tuple(r[f] for f in upsert.FIELDS if f not in ("envolvidos", "movimentacoes")) for r in df.collect()}


def test_merge_equals_applying_records_one_by_one(spark):
    rnd = random.Random(1)
    rows = []
    for seq in range(600):
        key = N[0] if seq % 3 == 0 else rnd.choice(N)
        over = {"relator": rnd.choice([None, f"J{seq}"]), "numero_legado": rnd.choice([None, f"L{seq}"])}
        if rnd.random() < 0.3:
            over.update(reprocessed_at=f"T{seq}", reprocessed_from_doc=str(seq), numero_legado=None)
        rows.append((seq, record(key, **over)))
    rnd.shuffle(rows)
    start = [record(N[1], relator="velho", reprocessed_at="T", reprocessed_from_doc="velho"), record("só-antigo")]
    state, actions = {r[0]: dict(zip(upsert.FIELDS, r)) for r in start}, {}
    for seq, r in sorted(rows):
        item = dict(zip(upsert.FIELDS, r))
        actions[(item["_id"], seq)] = "update" if item["_id"] in state else "insert"
        old = state.setdefault(item["_id"], {})
        for f, v in item.items():
            if not f.startswith("reprocessed") or item["reprocessed_from_doc"] is not None:
                old[f] = v
    expected = {
        k: tuple(s.get(f) for f in upsert.FIELDS if f not in ("envolvidos", "movimentacoes")) for k, s in state.items()
    }
    merged = upsert.upsert_processos(table(spark, start), batch(spark, rows))
    assert as_dict(merged) == expected
    labels = upsert.upsert_actions(table(spark, start), batch(spark, rows))
    assert {(r["_id"], r["seq"]): r["action"] for r in labels.collect()} == actions
    # the same batch once more changes nothing
    assert as_dict(upsert.upsert_processos(merged, batch(spark, rows))) == expected


def test_idempotency_report(spark):
    rows = [(1, record(N[0])), (2, record(N[0])), (3, record(N[1])), (4, record(N[2])), (5, record(N[2]))]
    actions = upsert.upsert_actions(table(spark, [record(N[2])]), batch(spark, rows))
    got = {r["_id"]: (r.n_insert, r.n_update, r.idempotent) for r in upsert.idempotency_check(actions).collect()}
    assert got == {N[0]: (1, 1, True), N[2]: (0, 2, False)}


def test_deltas_merge_replay_and_compact(spark, tmp_path):
    path = str(tmp_path / "t")
    first = batch(spark, [(1, record(N[0])), (2, record(N[1], reprocessed_at="T", reprocessed_from_doc="2"))])
    second = batch(spark, [(3, record(N[1], relator="Novo")), (4, record(N[2], relator=None))])
    snapshots.write_delta(first, path, 0)
    snapshots.write_delta(second, path, 1)
    snapshots.write_delta(second, path, 1)
    now = snapshots.read_records(spark, path)
    got = {r["_id"]: (r.seq, r.relator, r.reprocessed_from_doc) for r in now.collect()}
    assert got == {N[0]: (1, "A B", None), N[1]: (3, "Novo", "2"), N[2]: (4, None, None)}
    snapshots.compact(spark, path)
    again = snapshots.read_records(spark, path)
    assert {r["_id"]: (r.seq, r.relator, r.reprocessed_from_doc) for r in again.collect()} == got


def test_later_batches_win_over_later_captures(spark, tmp_path):
    """A page extracted again keeps its capture number but applies after everything written before."""
    path, rnd, state, sequence = str(tmp_path / "t"), random.Random(4), {}, []
    for batch_id in range(6):
        rows = []
        for key in rnd.sample(N, 4):
            over = {"relator": f"J{batch_id}"}
            if batch_id % 2:
                over.update(reprocessed_at="T", reprocessed_from_doc=str(batch_id), numero_legado=None)
            rows.append((rnd.randrange(100), record(key, **over)))
        sequence.append(rows)
        for _, r in rows:
            item = dict(zip(upsert.FIELDS, r))
            state.setdefault(item["_id"], {}).update(
                {f: v for f, v in item.items() if not f.startswith("reprocessed") or item["reprocessed_from_doc"]}
            )
        snapshots.write_delta(batch(spark, rows), path, batch_id)
        if batch_id in (2, 3):
            snapshots.compact(spark, path)
        expected = {
            k: tuple(s.get(f) for f in upsert.FIELDS if f not in ("envolvidos", "movimentacoes")) for k, s in state.items()
        }
        assert as_dict(snapshots.read_records(spark, path)) == expected
    table_now = table(spark, [])
    for rows in sequence:
        table_now = upsert.upsert_processos(table_now, batch(spark, rows))
    assert as_dict(table_now) == expected


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_small_batch_does_not_move_the_base(spark, tmp_path):
    base = batch(spark, [(i, record(f"k{i}", relator=f"J{i % 50}")) for i in range(3000)])
    path = str(tmp_path / "t")
    snapshots.write_delta(base, path, 0)
    snapshots.compact(spark, path)
    snapshots.write_delta(batch(spark, [(1, record("k7", relator="Z")), (2, record("new"))]), path, 1)
    now = snapshots.read_records(spark, path)
    branches = _plan(now).split("BroadcastHashJoin")
    assert any("LeftAnti" in b for b in branches) and any("LeftSemi" in b for b in branches)
    kept = next(b for b in branches if "LeftAnti" in b.split("\n")[0])
    assert "Exchange hashpartitioning" not in kept.split("BroadcastExchange")[0]
    by_judge = _plan(now.where("relator = 'J3'"))
    assert "EqualTo(relator,J3)" in by_judge
    by_id = _plan(now.where("_id = 'k9'"))
    assert by_id.count("EqualTo(_id,k9)") >= 2
    assert now.where("relator = 'Z'").count() == 1 and now.count() == 3001


def test_landing_keeps_known_context_and_duplicates(spark, make_pages):
    fetched = make_pages(["<p>á</p>", "<p>á</p>"]).withColumn(
        "context", F.struct(F.lit("form").alias("tipo"), F.lit("x").alias("cookie"))
    )
    landed = pg.land_raw_pages(fetched, F.lit("2024-02-02T00:00:00"))
    rows = landed.collect()
    digest = "sha256:" + hashlib.sha256("<p>á</p>".encode()).hexdigest()
    assert [(r.hash_html, r.fetched_at, r.payload) for r in rows] == [(digest, "2024-02-02T00:00:00", None)] * 2
    assert rows[0].context.asDict() == dict(tipo="form", busca=None, numero=None, cnpj=None, page_idx=None, endpoint=None, req_id=None)
    assert pg.repeated_captures(landed).first().n == 2
    assert pg.page_integrity(landed).count() == 0
    broken = landed.withColumn("html", F.when(F.col("page_id") == 1, "<p>b</p>").otherwise(F.col("html")))
    assert [r.page_id for r in pg.page_integrity(broken).collect()] == [1]


def test_landing_takes_the_first_value_of_each_header(spark, make_pages):
    latin = lambda text: text.encode("latin-1")
    many = spark.createDataFrame(
        [(0, {latin("Título"): [latin("á"), latin("b")], latin("Empty"): []}), (1, None)], "page_id long, h map<binary, array<binary>>"
    )
    fetched = make_pages(["x", "y"]).drop("headers").join(many, "page_id").withColumnRenamed("h", "headers")
    got = {r.page_id: r.headers for r in pg.land_raw_pages(fetched).collect()}
    assert got == {0: {"Título": "á", "Empty": None}, 1: None}
    flat = pg.land_raw_pages(make_pages(["x"]).withColumn("headers", F.create_map(F.lit("a"), F.lit("b"))))
    assert flat.first().headers == {"a": "b"}


def test_selection_order_skip_and_limit(make_pages):
    pages = make_pages([("x", {"tipo": "lista"}), ("", {"tipo": "lista"}), ("y", {"tipo": "form"})] + [("z", {"tipo": "lista"})] * 15)
    assert pg.select_raw_pages(pages).count() == 17
    assert len(pg.select_raw_pages(pages, limit=10).collect()) == 10
    rows = pg.select_raw_pages(pages, tipo="lista", skip=2, limit=3).collect()
    assert [r.page_id for r in rows] == [15, 14, 13]
    assert pg.select_raw_pages(pages, limit=None).count() == 17
    rest = pg.select_raw_pages(pages, skip=4, limit=None)
    assert sorted(r.page_id for r in rest.collect()) == [0, 2, *range(3, 14)]


def test_deep_selection_equals_a_full_sort(spark, make_pages):
    rng = random.Random(7)
    days = [None, "", "2024-01-01T00:00:00", "2024-01-01T00:00:01", "2024-01-02", "á", "2024"]
    rows = [(rng.choice(days + ["2024-01-01T00:00:00"] * 20), rng.choice([None, 5, rng.randrange(-(1 << 63), 1 << 63), rng.randrange(60)])) for _ in range(400)]
    base = make_pages(["x"]).drop("fetched_at", "page_id")
    pages = base.crossJoin(F.broadcast(spark.createDataFrame(rows, "fetched_at string, page_id long"))).repartition(5)
    low = -1 << 64
    order = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), low if r[1] is None else r[1]), reverse=True)
    for skip, limit in [(0, 30), (37, 50), (211, 1), (390, 30), (399, 5), (400, 5), (120, None), (397, None), (300, 0)]:
        got = [(r.fetched_at, r.page_id) for r in pg.select_raw_pages(pages, skip=skip, limit=limit, direct=6).collect()]
        expected = order[skip:] if limit is None else order[skip : skip + limit]
        assert Counter(got) == Counter(expected), (skip, limit)
        if limit:
            assert got == expected


def test_deep_selection_sorts_no_skipped_row(make_pages):
    pages = make_pages(["x"] * 300)
    rest = pg.select_raw_pages(pages, skip=200, direct=10)
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "TakeOrdered" not in plan and "Exchange" not in plan and rest.count() == 100


def test_layout_prunes_by_type(spark, make_pages, tmp_path):
    path = str(tmp_path / "pages")
    pages = make_pages([("x", {"tipo": t}) for t in ("lista", "detalhe", None) for _ in range(20)])
    pg.write_pages_layout(pages, path)
    back = spark.read.parquet(path)
    assert {r.tipo: r["count"] for r in back.groupBy("tipo").count().collect()} == {"lista": 20, "detalhe": 20, "undefined": 20}
    plan = back.where("tipo = 'lista'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tipo" in plan


def _scanned(df):
    """Rows that the scan of a collected lookup passed on: those of the files it did not skip."""
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_lookups_skip_the_files_of_other_keys(spark, make_pages, tmp_path):
    path = str(tmp_path)
    pages = make_pages([("x", {"page_id": i, "numero": f"{i:07d}-00.2000.4.05.0000", "url": f"u{i:04d}", "cnpj": f"{i:014d}"}) for i in range(400)])
    records = table(spark, [record(f"k{i:03d}", relator=f"J{i % 20:02d}", scraped_at=f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}") for i in range(400)])
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # a file per partition, however small
    try:
        pg.write_url_layout(pages, path)
        pg.write_records_layout(records, path)
    finally:
        spark.conf.unset(key)
    lookups = [
        ("by_url", "url = 'u0123' and method = 'GET'", 1),
        ("by_numero", "numero = '0000321-00.2000.4.05.0000'", 1),
        ("by_cnpj", "cnpj = '00000000000007'", 1),
        ("by_judge", "relator = 'J03'", 20),
        ("by_scraped_at", "scraped_at >= '2024-01-01T00:06:30'", 10),
    ]
    for name, where, n in lookups:
        found = spark.read.parquet(f"{path}/{name}").where(where)
        assert len(found.collect()) == n and _scanned(found) <= 250, name


def test_page_rules(spark, make_pages):
    pages = pg.land_raw_pages(make_pages([("x", {"tipo": "lista", "numero": "1", "cnpj": "2", "page_idx": -1, "busca": "z"}), ("x", {"tipo": "form"})]))
    pages = pages.withColumn("status", F.when(F.col("page_id") == 0, 99).otherwise(599)).withColumn(
        "method", F.when(F.col("page_id") == 0, F.lit(None)).otherwise("POST")
    )
    rows = {r.page_id: r.violations for r in validate.validate_raw_pages(pages).collect()}
    assert rows[1] == []
    assert rows[0] == [
        "method:enum", "status:range", "context.busca:enum", "context.numero:pattern", "context.cnpj:pattern", "context.page_idx:minimum",
    ]


def test_record_rules_and_quarantine(spark):
    rows = [
        record(N[0]),
        record(N[1], data_autuacao=None, relator=None, numero_legado=None, envolvidos=[], movimentacoes=[]),
        record("x", data_autuacao="15/04/2000", scraped_at="2024", envolvidos=[(None, "a"), ("b", None)], movimentacoes=[("1/1/2000", None), (None, "c")]),
        record(N[2], envolvidos=None, movimentacoes=None, fonte_url=None, scraped_at=None),
    ]
    checked = validate.validate_processos(table(spark, rows))
    got = {r["_id"]: r.violations for r in checked.collect()}
    assert got[N[0]] == [] and got[N[1]] == []
    assert got["x"] == [
        "_id:pattern", "data_autuacao:pattern", "scraped_at:pattern", "envolvidos.papel:required", "envolvidos.nome:required",
        "movimentacoes.data:required", "movimentacoes.texto:required", "movimentacoes.data:pattern",
    ]
    assert got[N[2]] == ["fonte_url:required", "scraped_at:required", "envolvidos:type", "movimentacoes:type"]
    assert validate.valid(checked).count() == 2 and validate.quarantine(checked).count() == 2
    summary = {r.rule: r.n for r in validate.violation_summary(checked).collect()}
    assert summary["_id:pattern"] == 1 and len(summary) == 12


def test_reports_on_a_small_table(spark):
    rows = [
        record(N[3], relator="Juiz C", envolvidos=[("A", "B"), ("C", "D")]),
        record(N[2], relator=None, data_autuacao="15/04/2000", envolvidos=[]),
        record(N[1], relator="", data_autuacao=None, movimentacoes=None),
    ]
    t = table(spark, rows)
    assert {r.field: (r.n, r.pct) for r in reports.field_coverage(t).collect()} == {
        "relator": (1, 33), "envolvidos": (2, 67), "movimentacoes": (2, 67),
    }
    assert {r.field: r.missing for r in reports.missing_fields(t).collect()} == {
        "numero_processo": 0, "relator": 2, "data_autuacao": 1, "envolvidos": 1, "movimentacoes": 1,
    }
    assert reports.non_iso_dates(t).first().non_iso == 1
    assert [(r.kind, r.relator, r.n) for r in reports.untitled_check(t).collect()] == [("count", None, 1), ("sample", "Juiz C", None)]
    assert reports.party_stats(t).first().asDict() == {"total": 2, "media": 1.5, "maximo": 2, "minimo": 1}
    recent = reports.recent_processos(t, 2).collect()
    assert [(r.numero, r.relator, r.primeiro_envolvido) for r in recent] == [(N[3], "Juiz C", "A - B"), (N[2], "N/A", "N/A")]
    watch = spark.createDataFrame([(N[3],), (N[9],), (N[1],)], "npu string")
    status = reports.watchlist_check(watch, t)
    assert {r.npu: (r.situacao, r.relator) for r in status.collect()} == {
        N[3]: ("OK", "Juiz C"), N[9]: ("FALTANDO", None), N[1]: ("OK", "N/A"),
    }
    assert reports.watchlist_totals(status).first().asDict() == {"total": 3, "encontrados": 2, "faltantes": 1}
    assert [r.npu for r in reports.watchlist_missing(watch, t).collect()] == [N[9]]
    assert [r["_id"] for r in reports.processos_by_judge(t, judge="Juiz C").collect()] == [N[3]]


def test_reports_on_an_empty_table(spark):
    t = table(spark, [])
    assert reports.field_coverage(t).count() == 0
    assert reports.party_stats(t).count() == 0
    assert [(r.kind, r.n) for r in reports.untitled_check(t).collect()] == [("count", 0)]


def test_rerun_trusts_the_stored_type(spark, make_pages):
    html = f"<html>{N[0]} (99.05.1-1) APTE <table><tr><td>APTE</td><td>: X Y</td></tr></table></html>"
    pages = make_pages([(html, {"tipo": "lista"}), (html.replace(N[0], N[1]), {}), (html.replace(N[0], N[2]), {"tipo": "detalhe"}), ("nada", {"tipo": "detalhe"})])
    old = table(spark, [record(N[2], relator="velho")])
    merged = ingest.reprocess_pages(pages, old, scraped_at=OK_STAMP, limit=None)
    got = {r["_id"]: (r.numero_legado, r.relator, r.envolvidos[0].nome, r.reprocessed_from_doc) for r in merged.collect()}
    assert got == {N[1]: (None, None, ": X Y", "1"), N[2]: (None, None, ": X Y", "2")}
    full = ingest.reprocess_pages(pages, old, profile="online", limit=None)
    assert {r["_id"]: r.numero_legado for r in full.collect()} == {N[1]: "99.05.1-1", N[2]: "99.05.1-1"}
    report = reports.reprocess_report(ingest.reprocess_outcomes(pages, limit=None)).first()
    assert (report.processed, report.succeeded, report.failed) == (4, 3, 1)
