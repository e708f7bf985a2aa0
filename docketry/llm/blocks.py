"""Documents packed into blocks: one row holds some megabytes of whole texts, compressed.

A block is the unit in which a corpus-wide table meets the texts: it sends each of
its distinct keys once, whatever the number of copies inside, and gets its answers
back by position. Its size bounds the memory of a task and of every group by block.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from docketry.llm.common import small_batches
from docketry.session import scratch


def pack_texts(texts: list[str]) -> bytes:
    """Texts as one compressed payload; their lengths in code points are kept apart."""
    return zstandard.ZstdCompressor(level=6).compress("".join(texts).encode())


def unpack_texts(payload: bytes, lengths: list[int]) -> list[str]:
    whole = zstandard.ZstdDecompressor().decompress(payload).decode()
    out, at = [], 0
    for n in lengths:
        out.append(whole[at : at + n])
        at += n
    return out


def packed(docs: DataFrame, columns: dict[str, str], text: str, make, extra: str, most: int = 12_000_000) -> DataFrame:
    """One row per block: block, an array per column of `columns` (new name -> column), lengths, payload, and make(texts).

    Blocks are cut from the input's partitions in order, at about `most` bytes of text;
    a longer text is a block alone. Null texts are packed as empty. `make` returns the
    values of the fields in `extra` for the texts of a block.
    """
    narrow = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns.values())], F.col(f"`{text}`").alias("__text"))
    arrays = ", ".join(f"{new} array<{docs.schema[c].dataType.simpleString()}>" for new, c in columns.items())
    schema = f"block bigint, {arrays}, lengths array<int>, payload binary, {extra}"
    fields = StructType.fromDDL(schema).fields
    names, types = [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]
    width = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, 0
        values: list[list] = [[] for _ in range(width)]
        texts: list[str] = []

        def row() -> pa.RecordBatch:
            out = [(part << 32) + number, *values, [len(t) for t in texts], pack_texts(texts), *make(texts)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(out, types, strict=True)], names=names)

        for batch in small_batches(batches, "__text", most):
            size = batch.column(width).nbytes
            if texts and held + size > most:
                yield row()
                number, held, values, texts = number + 1, 0, [[] for _ in range(width)], []
            held += size
            for v, c in zip(values, batch.columns[:width], strict=True):
                v += c.to_pylist()
            texts += [t or "" for t in batch.column(width).to_pylist()]
        if texts:
            yield row()

    return narrow.mapInArrow(run, schema)


def stored_blocks(blocks: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Blocks written below spark.checkpoint.dir, bucketed by block: joins on block leave the payloads where they are."""
    spark = blocks.sparkSession
    table, path = f"{name}_{uuid.uuid4().hex}", scratch(spark, name)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = blocks.write.bucketBy(buckets, "block").option("path", path)
    (writer.option("compression", codec) if codec else writer).saveAsTable(table)
    read = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the name only: the files are an external table's
    return read


def per_block(blocks: DataFrame, make, schema: str) -> DataFrame:
    """make(row as dict) -> list of column lists, for each block row; the rows it gives replace the block's."""
    fields = StructType.fromDDL(schema).fields
    names, types = [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                columns = make({name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return blocks.mapInArrow(run, schema)
