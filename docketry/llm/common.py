"""Helpers shared by the operators: written tables, tables of a folder, words, Arrow batches."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.session import scratch

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\v\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str, codec: str | None = None, **options: str) -> DataFrame:
    """Write below spark.checkpoint.dir and read again: cuts the lineage, survives lost executors. options: of the Parquet writer."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**options).parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """docs with its columns named c0, c1, ..., so that no name can clash, and the new names of `names`."""
    exact = {c: f"c{i}" for i, c in reversed(list(enumerate(docs.columns)))}
    alike = {c.lower(): n for c, n in reversed(list(exact.items()))}
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), [exact.get(n) or alike[n.lower()] for n in names]


def renamed(rows: DataFrame, docs: DataFrame, *added: str) -> DataFrame:
    """The numbered columns under the names of docs, then `added`, which replace input columns of their names."""
    new = {a.lower() for a in added}
    old = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in new]
    return rows.select(*old, *added)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def n_words(column: str = "text") -> Column:
    """Number of words of a text, 0 for null."""
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one holds about `most` bytes of a text column; a longer text is a batch alone."""
    for batch in batches:
        sizes = batch.column(batch.schema.get_field_index(column))
        lengths = pc.fill_null(pc.binary_length(sizes), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lengths):
            yield batch.slice(start)


def map_batches(df: DataFrame, columns: list[str], text: str, make: Callable, schema: str) -> DataFrame:
    """make(dict of column lists) -> dict of column lists, per batch of bounded text; columns are renamed c0, c1, ...

    Only `columns` leave the JVM. `make` returns lists in the order of `schema`.
    """
    narrow = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    narrow = narrow.withColumn("__text", F.col(f"c{columns.index(text)}")).drop(f"c{columns.index(text)}")
    order = [f"c{i}" if c != text else "__text" for i, c in enumerate(columns)]

    def run(batches):
        for batch in small_batches(batches, "__text"):
            out = make(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in order])
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(schema).fields
    names = [f.name for f in fields]
    types = [to_arrow_type(f.dataType) for f in fields]
    return narrow.mapInArrow(run, schema)
