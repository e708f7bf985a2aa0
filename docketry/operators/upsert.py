"""Field-wise merge of case records by ``_id`` and its audit labels.

Semantics: every applied record sets all its fields, NULLs included; records
apply in write order, (``batch_id``, ``seq``), so a page extracted again in a
later batch wins over any capture of an earlier one. ``reprocessed_*`` exist only
in re-extracted records, so the latest record that has them keeps providing them.

Only cases a batch touches are merged: their earlier record takes part as the
first one of its key, in one aggregation by ``_id`` that reduces on the map side,
so a case captured in a third of all pages sends one row per task. The rest of the
table passes an anti join, which does not move it when the batch is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.schemas import PROCESSOS

FIELDS = [f.name for f in PROCESSOS.fields]
ALWAYS_SET = [f for f in FIELDS if f != "_id" and not f.startswith("reprocessed")]
RERUN_ONLY = ["reprocessed_at", "reprocessed_from_doc"]


def reduce_records(records: DataFrame) -> DataFrame:
    """Many records per ``_id`` (with ``seq``, or ``batch_id`` and ``seq``) -> the merged one, with its last order."""
    order = ["batch_id", "seq"] if "batch_id" in records.columns else ["seq"]
    is_rerun = F.col("reprocessed_from_doc").isNotNull()
    place = F.struct(*order)
    return (
        records.groupBy("_id")
        .agg(
            F.max(place).alias("place"),
            F.max_by(F.struct(*ALWAYS_SET), place).alias("last"),
            F.max_by(F.when(is_rerun, F.struct(*RERUN_ONLY)), F.when(is_rerun, place)).alias("rerun"),
        )
        .select(
            "_id",
            *[F.col(f"place.{c}").alias(c) for c in order],
            *[F.col(f"last.{f}").alias(f) for f in ALWAYS_SET],
            *[F.col(f"rerun.{f}").alias(f) for f in RERUN_ONLY],
        )
    )


def merge_records(base: DataFrame, later: DataFrame) -> DataFrame:
    """``base`` (one record per case) after ``later`` ones; both with the same columns.

    ``later`` is read several times: a stored table, or small.
    """
    ids = later.select("_id").distinct()
    touched = base.join(ids, "_id", "left_semi").select(*later.columns)
    kept = base.join(ids, "_id", "left_anti")
    merged = reduce_records(touched.unionByName(later))
    return kept.select(*merged.columns).unionByName(merged)


def upsert_processos(snapshot: DataFrame, batch: DataFrame) -> DataFrame:
    """Snapshot after applying a batch: a stored table with ``seq``, or a small one."""
    base = snapshot.select(F.lit(-1).cast("bigint").alias("seq"), *FIELDS)
    return merge_records(base, batch.select("seq", *FIELDS)).select(*FIELDS)


def upsert_actions(snapshot_ids: DataFrame, batch: DataFrame) -> DataFrame:
    """Each applied record labelled insert or update.

    Inserts are the first record of a key the snapshot lacks. They are found by
    aggregation and an anti join on one row per key, then matched back on
    (_id, seq), which is unique, so a hot key does not gather in one task.
    """
    applied = batch.select("_id", "seq")
    firsts = (
        applied.groupBy("_id")
        .agg(F.min("seq").alias("seq"))
        .join(snapshot_ids.select("_id"), "_id", "left_anti")
        .select(F.col("_id").alias("_new_id"), F.col("seq").alias("_new_seq"))
    )
    return applied.join(
        firsts, (F.col("_id") == F.col("_new_id")) & (F.col("seq") == F.col("_new_seq")), "left"
    ).select(
        "_id", "seq", F.when(F.col("_new_id").isNotNull(), "insert").otherwise("update").alias("action")
    )


def idempotency_check(actions: DataFrame) -> DataFrame:
    """Keys applied more than once: one insert, first, and only updates after it."""
    return (
        actions.groupBy("_id")
        .agg(
            F.count("*").alias("n_applied"),
            F.count_if(F.col("action") == "insert").alias("n_insert"),
            F.count_if(F.col("action") == "update").alias("n_update"),
            F.min_by("action", "seq").alias("first_action"),
        )
        .where(F.col("n_applied") > 1)
        .withColumn(
            "idempotent", (F.col("n_insert") == 1) & (F.col("first_action") == "insert")
        )
    )
