"""File-stream faces of the bronze load and of the silver upsert.

A Structured Streaming file source watches the landing folder; each
micro-batch only tells *which* daily batches received files.  ``foreachBatch``
then re-reads those batches' whole folders and replaces their bronze
partitions, so the result is the same as the batch load however files are
split across micro-batches, and a replay after a failure (same checkpoint)
rewrites the same partitions — idempotent per batch.  The silver stream goes on from
there: it rebuilds those batches' snapshot and upserts it, and the table's version
notes the micro-batch it came from, so one that is replayed changes nothing.

Run it with ``trigger(availableNow=True)`` for scheduled catch-up, or a
processing-time trigger to follow the landing continuously.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators.merge import Guard
from shelfwise.sources import tables as TB
from shelfwise.sources import versions as V
from shelfwise.sources.landing import read_landing


def landing_file_stream(spark: SparkSession, base: str, *, glob: str = "*.json",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of new landing files (path and batch id only)."""
    r = (spark.readStream.format("binaryFile")
         .option("pathGlobFilter", glob)
         .option("basePath", base)
         .schema(T.StructType([T.StructField("path", T.StringType()),
                               T.StructField("modificationTime", T.TimestampType()),
                               T.StructField("length", T.LongType()),
                               T.StructField("content", T.BinaryType()),
                               T.StructField("batch_id", T.StringType())])))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(base).select("path", "batch_id")


def _touched(micro: DataFrame) -> list[str]:
    """The daily batches of which a micro-batch has files (a handful of ids)."""
    return sorted(r["batch_id"] for r in micro.select("batch_id").distinct().collect())


def _replace_bronze(spark: SparkSession, base: str, bronze_path: str, batches: list[str], **read) -> None:
    """One read of the batches' folders, one write replacing their partitions.  Types
    that inference degrades come from the table's declared columns."""
    known = V.current(spark, bronze_path)
    rows = read_landing(spark, base, batch_id=batches, type_hints=known.schema if known else None, **read)
    TB.replace_partitions(rows, bronze_path, ["batch_id"])


def _started(stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint_location: str,
             available_now: bool) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint_location)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def start_bronze_stream(spark: SparkSession, base: str, bronze_path: str,
                        checkpoint_location: str, *, glob: str = "*.json",
                        available_now: bool = True,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Keep the bronze table in step with the landing folder."""
    def load(micro: DataFrame, epoch_id: int) -> None:
        if batches := _touched(micro):
            _replace_bronze(spark, base, bronze_path, batches, glob=glob)

    return _started(landing_file_stream(spark, base, glob=glob, max_files_per_trigger=max_files_per_trigger),
                    load, checkpoint_location, available_now)


def upsert_epoch(spark: SparkSession, base: str, bronze_path: str, silver_path: str, batches: list[str],
                 epoch: tuple[str, int], build: Callable[[DataFrame], DataFrame], keys: list[str],
                 partition_col: str, guard: Guard | None = None, **read) -> bool:
    """One micro-batch of ``start_silver_stream``; False if it is in the table already.

    ``epoch``: the stream's identifier and the number of the micro-batch.  The upsert
    and the note that it is done are one version of the table.
    """
    known = V.current(spark, silver_path)
    if known is not None and known.epochs.get(epoch[0], -1) >= epoch[1]:
        return False
    _replace_bronze(spark, base, bronze_path, batches, **read)
    rows = build(TB.read_table(spark, bronze_path, only=("batch_id", batches)))
    TB.merge_into_table(spark, silver_path, rows, keys, partition_col, guard=guard, epoch=epoch)
    return True


def start_silver_stream(spark: SparkSession, base: str, bronze_path: str, silver_path: str,
                        checkpoint_location: str, *, build: Callable[[DataFrame], DataFrame],
                        keys: list[str], partition_col: str, guard: Guard | None = None,
                        glob: str = "*.json", multiline: bool = True, available_now: bool = True,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Keep bronze and silver in step with the landing folder.

    ``build`` makes the snapshot rows of whole batches from their bronze rows (for the
    catalogue ``plans.silver.build_silver``).  The stream is known by the identifier in
    its checkpoint, so a new checkpoint is a new stream, which starts over.
    """
    def load(micro: DataFrame, epoch_id: int) -> None:
        if batches := _touched(micro):
            stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
            upsert_epoch(spark, base, bronze_path, silver_path, batches, (stream, epoch_id), build, keys,
                         partition_col, guard, glob=glob, multiline=multiline)

    return _started(landing_file_stream(spark, base, glob=glob, max_files_per_trigger=max_files_per_trigger),
                    load, checkpoint_location, available_now)
