"""Running server health, continued from one micro-batch to the next, whatever the order of arrival.

A state operator keyed by host would run a whole host in one task. Here every
micro-batch runs the chunked batch operator with the closing state of the commit
before it as its start, so a busy host is spread over the cluster.

A batch may bring rows that belong before rows already counted. The states at the
ends of a host's chunks are kept per commit; the host goes back to the last of them
before its earliest late row, and what stands behind is computed anew, as part of the
batch. A mark (host, number) tells readers which rows of earlier commits that replaces.

Nothing is written over: a batch writes below ``version=<n>/attempt=<id>`` and is
seen once commit ``n`` names the attempt. The writer of a commit is its stream and the
epoch its batch, so a batch that is replayed adds nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docketry.operators.health import CHUNK, chunk_states, health_state, health_transitions, server_health, with_flags
from docketry.schemas import FETCH_LOG, L, S
from docketry.sources.commits import Commit, DataFile, put_commit, read_log
from docketry.streaming.pages import stream_name

PLAIN, RESTATING = "health", "health-restating"
_B, _TS = T.BooleanType(), T.TimestampType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TABLES = {
    "rows": _schema(host=S, seq=L, ts=_TS, failed=_B),
    "states": _schema(host=S, n=L, ok_rn=L, ok_ts=_TS, started=_TS, degraded=_B, tail=T.ArrayType(_B), last_seq=L),
    "marks": _schema(host=S, after_seq=L),
    "transitions": _schema(host=S, seq=L, ts=_TS, change=S),
    "health": _schema(
        host=S, chunk=T.IntegerType(), seq=L, ts=_TS, failed=_B, n=L, recent_failures=L, recent_total=L, consecutive_failures=L,
        last_success=_TS, started=_TS, ok_rn=L, failure_rate=T.DoubleType(), degraded=_B,
    ),
}
_STATE = TABLES["states"].names
FIRST = -(1 << 63)  # before any number


def _written(df: DataFrame, table: str, name: str, place: str) -> DataFrame:
    """Rows written once, for every later use."""
    schema = TABLES[name]
    path = f"{table}/{name}/{place}"
    df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _committed(spark: SparkSession, table: str, name: str, log: list[Commit]) -> DataFrame:
    """Rows of a table in these commits, with the ``version`` of each."""
    schema = T.StructType([*TABLES[name].fields, T.StructField("version", L), T.StructField("attempt", S)])
    if not log:
        return spark.createDataFrame([], schema).drop("attempt")
    paths = [f"{table}/{name}/{c.files[0].file}" for c in log]
    return spark.read.schema(schema).option("basePath", f"{table}/{name}").parquet(*paths).drop("attempt")


def _valid(spark: SparkSession, table: str, name: str, log: list[Commit], at: str = "seq") -> DataFrame:
    """Rows of a table that no later commit has computed anew.

    Marks are few: one row per host that a batch had late rows of. Per host and commit
    the lowest mark of all later commits counts, so the rows meet one mark at most.
    """
    rows = _committed(spark, table, name, log)
    again = [c for c in log if c.kind == RESTATING]
    if not again:
        return rows
    by_version = Window.partitionBy("host").orderBy("version")
    marks = _committed(spark, table, "marks", again).select(
        F.col("host").alias("_host"),
        F.min("after_seq").over(by_version.rowsBetween(0, Window.unboundedFollowing)).alias("_after"),
        F.sequence(F.coalesce(F.lag("version").over(by_version), F.lit(0)), F.col("version") - 1).alias("_versions"),
    )
    marks = marks.select("_host", "_after", F.explode("_versions").alias("_version"))
    met = rows.join(marks, (F.col("host") == F.col("_host")) & (F.col("version") == F.col("_version")), "left")
    return met.where(F.col("_after").isNull() | (F.col(at) <= F.col("_after"))).drop("_host", "_after", "_version")


def _restart(spark: SparkSession, table: str, log: list[Commit], late: DataFrame) -> DataFrame:
    """(host, from_seq, state...): the last kept state of each late host before its earliest late row; NULLs if there is none."""
    kept = _valid(spark, table, "states", log, "last_seq").join(late.select(F.col("host").alias("_late"), "from_seq"), F.col("host") == F.col("_late"))
    best = health_state(kept.where(F.col("last_seq") < F.col("from_seq")).select(*_STATE))
    return late.join(best.withColumnRenamed("host", "_found"), F.col("host") == F.col("_found"), "left").drop("_found")


def apply_batch(log: DataFrame, batch_id: int, table: str, chunk: int = CHUNK, writer: str = "stream") -> None:
    """Commit one batch; a batch of this writer that is there already adds nothing.

    Html is looked at once, when the narrow rows are written. Without late rows the
    cost of a batch does not depend on what came before it, but for one state per host.
    """
    spark, narrow = log.sparkSession, None
    while True:
        commits = read_log(spark, table)
        if any((c.writer, c.epoch) == (writer, batch_id) for c in commits):
            return
        version = len(commits)
        place = f"version={version}/attempt={uuid.uuid4().hex}"
        if narrow is None:
            flagged = with_flags(log).select(F.coalesce("host", F.lit("")).alias("host"), "seq", "ts", "failed")
            narrow = _written(flagged, table, "rows", place)
        restated = _compute(narrow, table, commits, place, chunk)
        kind = RESTATING if restated else PLAIN
        commit = Commit(version, kind, writer, batch_id, "", files=[DataFile(place, "", "", 0)])
        if put_commit(spark, table, commit):
            return


def _compute(rows: DataFrame, table: str, commits: list[Commit], place: str, chunk: int) -> bool:
    """Write health, transitions and states of a batch; whether it restates earlier rows."""
    spark = rows.sparkSession
    before = health_state(_committed(spark, table, "states", commits[-1:]).select(*_STATE))
    first = rows.groupBy("host").agg(F.min("seq").alias("from_seq"))
    passed = before.select(F.col("host").alias("_passed"), "last_seq")
    late = first.join(passed, (F.col("host") == F.col("_passed")) & (F.col("from_seq") <= F.col("last_seq"))).select("host", "from_seq")
    restated = bool(commits) and not late.isEmpty()
    start = before
    if restated:
        restart = _restart(spark, table, commits, late)
        marks = _written(restart.withColumn("after_seq", F.coalesce("last_seq", F.lit(FIRST))), table, "marks", place)
        start = before.join(marks.select("host"), "host", "left_anti").select(*_STATE).unionByName(
            restart.where(F.col("n").isNotNull()).select(*_STATE)
        )
        counted = _valid(spark, table, "health", commits).select(*rows.columns)
        ahead = marks.select(F.col("host").alias("_marked"), "after_seq")
        again = counted.join(ahead, (F.col("host") == F.col("_marked")) & (F.col("seq") > F.col("after_seq"))).select(*rows.columns)
        rows = rows.unionByName(again)
    health = _written(server_health(rows, start=start, chunk=chunk), table, "health", place)
    _written(health_transitions(health, start), table, "transitions", place)
    after = chunk_states(health, start).select(*_STATE)
    silent = before.join(after.select("host"), "host", "left_anti").select(*_STATE)
    _written(after.unionByName(silent), table, "states", place)
    return restated


def stream_health(
    spark: SparkSession, source: str, table: str, checkpoint: str, chunk: int = CHUNK, max_files: int | None = None
) -> StreamingQuery:
    """Process the log files that arrived in ``source``, in any order, and stop."""
    reader = spark.readStream.schema(FETCH_LOG)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(source)
        .writeStream.foreachBatch(lambda log, batch_id: apply_batch(log, batch_id, table, chunk, stream_name(spark, checkpoint)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_health(spark: SparkSession, table: str) -> DataFrame:
    return _valid(spark, table, "health", read_log(spark, table)).drop("version")


def read_transitions(spark: SparkSession, table: str) -> DataFrame:
    return _valid(spark, table, "transitions", read_log(spark, table)).drop("version")
