"""Every catalog query against its oracle, plan properties and the page stream."""

import pytest

import __spark_entry__ as entry
import check_oracle
from docketry.plans import catalog, ingest, oracle
from docketry.schemas import PROCESSOS
from docketry.sources import pages as pg
from docketry.sources import rendered as R
from docketry.sources import snapshots
from docketry.streaming import pages as sp


@pytest.fixture(scope="module")
def duck(sf):
    return check_oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_oracle(spark, duck, sf, name):
    assert check_oracle.compare(spark, duck, name, sf) == ""


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_written_tables_go_to_the_shared_folder(spark):
    from docketry.session import scratch

    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert first.startswith(shared + "/x-") and first != second


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "_id" in df.columns


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = sorted(set(catalog.queries()) - {"stream_pages", "stream_after_compact", "stream_health", "stream_health_transitions", "compact_snapshot", "layout_write", "layout_lookup"})


@pytest.mark.parametrize("name", LAZY)
def test_plans_stay_in_the_jvm_without_cross_joins(spark, sf, name):
    plan = _plan(catalog.queries()[name](spark, sf))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


@pytest.mark.parametrize("operator", ["extract_processos", "extract_relator", "best_detail_link", "classify_pages", "page_cells"])
def test_page_work_does_not_shuffle(spark, sf, tmp_path, operator):
    """On a stored page table the page operators have no exchange at all."""
    path = str(tmp_path / "pages")
    pg.land_raw_pages(R.detail_pages(spark, sf)).write.parquet(path)
    stored = spark.read.parquet(path)
    from docketry.operators import classify, extract, frontier

    op = getattr(extract, operator, None) or getattr(classify, operator, None) or getattr(frontier, operator)
    assert "Exchange" not in _plan(op(stored))


def test_rank_limits_apply_before_the_shuffle(spark, sf):
    for name in ("frontier_form", "frontier_stable", "processos_by_judge"):
        assert "Partial" in _plan(catalog.queries()[name](spark, sf))


def test_reports_never_read_content(spark, sf, tmp_path):
    from docketry.operators import reports

    path = str(tmp_path / "pages")
    pg.land_raw_pages(R.site_pages(spark, sf)).write.parquet(path)
    stored = spark.read.parquet(path)
    records = spark.createDataFrame([], PROCESSOS)
    for df in (reports.pages_by_type(stored), reports.recent_pages(stored), reports.cnpj_discovery(stored, records)):
        assert "html" not in _plan(df)


def test_page_stream_replays_to_the_same_table(spark, sf, tmp_path):
    src, table, mark = (str(tmp_path / n) for n in ("in", "table", "mark"))
    landed = pg.land_raw_pages(R.detail_pages(spark, sf))
    landed.repartition(5).write.parquet(src)
    sp.stream_pages(spark, src, table, mark, max_files=2).awaitTermination()
    streamed = snapshots.read_records(spark, table)
    batch = ingest.ingest_pages(R.detail_pages(spark, sf), spark.createDataFrame([], PROCESSOS))
    keys = ["_id", "relator", "data_autuacao", "numero_legado"]
    expected = sorted(map(str, batch.select(keys).collect()))
    assert sorted(map(str, streamed.select(keys).collect())) == expected
    # without its checkpoint the stream starts over as another writer
    sp.stream_pages(spark, src, table, str(tmp_path / "mark2"), max_files=2).awaitTermination()
    assert sorted(map(str, snapshots.read_records(spark, table).select(keys).collect())) == expected
