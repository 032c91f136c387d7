"""Batch control: which landing batch to process next, and the batch state
machine (IN_PROGRESS → COMPLETED | FAILED, and FAILED → IN_PROGRESS on a
restart).

The control table is small (one row per daily batch) but is still handled as
a DataFrame: the transitions are the merge operators, so the same code runs
against a parquet control table through ``sources.tables``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import constants as K
from shelfwise.operators.merge import merge_insert_only, merge_update_only, update_where

CONTROL_SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_timestamp", T.TimestampType()),
    T.StructField("updated_timestamp", T.TimestampType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("error_message", T.StringType()),
])

ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"


def pending_batches(landing: DataFrame, control: DataFrame | None,
                    batch_col: str = "batch_id") -> DataFrame:
    """Landing batches without a COMPLETED control row (set difference as an anti join)."""
    seen = landing.select(batch_col).distinct()
    if control is None:
        return seen
    done = control.filter(F.col("status") == K.STATUS_COMPLETED).select(batch_col)
    return seen.join(done, batch_col, "left_anti")


def next_batch(landing: DataFrame, control: DataFrame | None,
               batch_col: str = "batch_id") -> DataFrame:
    """One row: the smallest pending batch id (NULL when nothing is pending) and
    the number pending.  ISO day ids sort as dates."""
    p = pending_batches(landing, control, batch_col)
    return p.agg(F.min(batch_col).alias("siguiente_batch"),
                 F.count(F.lit(1)).alias("pendientes"))


def _now() -> Column:
    return F.current_timestamp()


def start_batches(control: DataFrame, batch_ids: DataFrame,
                  restart: tuple[str, ...] = (K.STATUS_FAILED,)) -> DataFrame:
    """Mark batches IN_PROGRESS: insert unknown ones, restart those whose status
    is in ``restart``.

    The restart is a deliberate fix: an insert-only start would leave a failed
    batch first in line for ever.  Returns the new control table.
    """
    ids = batch_ids.select("batch_id").distinct()
    inserts = merge_insert_only(control, ids, ["batch_id"]).select(
        "batch_id", F.lit(K.STATUS_IN_PROGRESS).alias("status"),
        _now().alias("created_timestamp"), _now().alias("updated_timestamp"),
        _now().alias("start_time"), F.lit(None).cast("timestamp").alias("end_time"),
        F.lit(None).cast("string").alias("error_message"))
    restarted = merge_update_only(
        control, ids, ["batch_id"],
        {"status": F.lit(K.STATUS_IN_PROGRESS), "updated_timestamp": _now(),
         "start_time": _now(), "end_time": F.lit(None).cast("timestamp"),
         "error_message": F.lit(None).cast("string")},
        target_condition=F.col("status").isin(*restart))
    return restarted.unionByName(inserts)


def complete_batches(control: DataFrame, batch_ids: DataFrame) -> DataFrame:
    """IN_PROGRESS → COMPLETED for the given batches (others untouched)."""
    return merge_update_only(
        control, batch_ids.select("batch_id").distinct(), ["batch_id"],
        {"status": F.lit(K.STATUS_COMPLETED), "updated_timestamp": _now(), "end_time": _now()},
        target_condition=F.col("status") == K.STATUS_IN_PROGRESS)


def fail_batches(control: DataFrame, condition: Column, message: str) -> DataFrame:
    """UPDATE … SET status = FAILED WHERE condition AND status = IN_PROGRESS."""
    return update_where(
        control, condition & (F.col("status") == K.STATUS_IN_PROGRESS),
        {"status": F.lit(K.STATUS_FAILED), "updated_timestamp": _now(), "end_time": _now(),
         "error_message": F.lit(message)})


def invalid_batch_ids(df: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Batch ids that are not ISO days (string comparison of ids needs that form)."""
    return df.filter(~F.col(batch_col).rlike(ISO_DAY)).select(batch_col).distinct()
