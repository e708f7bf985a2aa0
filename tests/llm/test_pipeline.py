"""The corpus pipeline stage by stage against plain code, and its queries."""

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_pairs_and_passages import plain_components, plain_hits, plain_print

import __spark_entry__
import check_oracle
from docketry.llm import lines, queries, rules
from docketry.llm.common import stored, table

SF = "/root/testdata/sf0.001"


def test_stages_are_the_ones_asked_for():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "simhash near-dedup", "benchmark decontamination", "mixing to target weights"]
    assert set(queries.queries()) == {n for n in __spark_entry__.queries() if n.startswith("op")}
    assert len(queries.queries()) == 13 and "pipeline" in __spark_entry__.queries()


def test_stages_on_the_smallest_tables(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    before = docs.collect()
    stages = dict(corpus_pipeline.STAGES)

    kept = stored(stages["quality rules"](spark, docs, SF), "t").collect()
    verdict = {r.doc_id: r.kept for r in rules.quality(docs, table(spark, SF, "labels")).collect()}
    assert Counter(kept) == Counter(r for r in before if verdict[r.doc_id])

    one = spark.createDataFrame(kept, docs.schema)
    cut = stored(stages["line dedup"](spark, one, SF), "t")
    assert cut.columns == columns
    rows = {r.doc_id: r for r in cut.collect()}
    whole = {r.doc_id: r for r in lines.line_dedup(one).collect()}
    assert {d: r.text for d, r in rows.items()} == {d: r.text for d, r in whole.items()}
    assert all(r.n_chars == len(r.text) for r in rows.values())

    prints = [(d, plain_print(r.text)) for d, r in rows.items()]
    left = set(plain_components(prints))
    single = stored(stages["simhash near-dedup"](spark, cut, SF), "t")
    assert single.columns == columns and {r.doc_id for r in single.collect()} == left == {d for d in rows if d in left}
    assert single.count() == len(left)

    items = [(str(r.item_id), r.text) for r in table(spark, SF, "benchmark").collect()]
    clean = stored(stages["benchmark decontamination"](spark, single, SF), "t")
    assert clean.columns == columns
    want = {d for d in left if not plain_hits(rows[d].text, items, 10)[1]} if len(left) * len(items) < 20_000 else None
    if want is not None:
        assert {r.doc_id for r in clean.collect()} == want

    mixed = stages["mixing to target weights"](spark, clean, SF)
    assert mixed.columns == [*columns, "pass", "shard", "words"]
    sizes = {r.doc_id: len(r.text.encode().split()) for r in clean.collect()}
    got = mixed.collect()
    assert all(len(r.text.encode().split()) == r.words <= sizes[r.doc_id] for r in got)
    assert abs(sum(r.words for r in got) - 1.5 * sum(sizes.values())) <= 10
    assert Counter(map(tuple, got)) == Counter(map(tuple, corpus_pipeline.run(spark, SF).collect()))


def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs, tmp_path):
    for name, source in (("odd", odd_docs), ("none", no_docs)):
        folder = str(tmp_path / name)
        source.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 0, 0), (3, 1, 1), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, "one two three"), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        spark.createDataFrame([(1, None, None)], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
        for stage, f in corpus_pipeline.STAGES:
            out = f(spark, source, folder)
            assert out.columns[: len(source.columns)] == source.columns or stage.startswith("mixing")
            out.count()
        corpus_pipeline.run(spark, folder).count()
        n = source.count()
        for query, f in queries.queries().items():
            if query.startswith(("op11", "op12", "op13")):  # rows per question; test_searches has their odd and empty tables
                continue
            found = f(spark, folder)
            assert found.count() == (1 if "html" in query else n), query


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_with_sql_equal_it(spark, name):
    assert check_oracle.compare(spark, check_oracle.connect(SF), name, SF) == ""


def test_ids_pass_as_they_are(spark):
    docs = table(spark, SF, "documents").agg(F.sum("doc_id"), F.count("*")).first()
    for name in ("op3_substring_dedup", "op7_decontamination", "op10_simhash"):
        assert queries.queries()[name](spark, SF).agg(F.sum("doc_id"), F.count("*")).first() == docs
