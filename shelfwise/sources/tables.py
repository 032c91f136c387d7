"""Path-based parquet tables: scans, batch-scoped replace, append, overwrite and
MERGE-style upserts.

Tables are parquet files partitioned by their batch/date column, so a batch
filter is a partition filter and a batch write rewrites only that partition.
Every write goes through ``sources.versions``: it is published at once when its
files are complete, so readers and crashes see the rows before or the rows after,
and two writers of one partition do not overwrite each other unnoticed.

Folders of plain parquet files, written by others, are read as they are and not
written to.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.merge import Guard, duplicate_source_keys, merge_upsert
from shelfwise.session import path_exists, scratch_table
from shelfwise.sources import versions as V


# --- reads ----------------------------------------------------------------------

def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               merge_schema: bool = False, only: tuple[str, Iterable] | None = None,
               version: int | None = None) -> DataFrame:
    """The table's current rows, or those of an earlier ``version``.

    ``schema``: the columns wanted and their types (default: all the table has had,
    each in the narrowest type that holds all its batches).  ``only``: a partition
    column and the values wanted; other partitions are not listed.
    """
    now = V.current(spark, path) if version is None else V.version_at(spark, path, version)
    if now is not None:
        return V.read_version(spark, path, now, schema, only)
    r = spark.read  # plain files
    if schema is not None:
        r = r.schema(schema)
    if merge_schema:
        r = r.option("mergeSchema", "true")
    return r.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True for a published table, and for a folder of plain files."""
    return bool(V.versions(spark, path)) or (
        path_exists(spark, path) and any(not n.startswith((V.WRITE, "_versions")) for n in V.subpaths(spark, path)))


def scan_batch(df: DataFrame, batch_col: str, batch_id: str) -> DataFrame:
    """Rows of one batch; on a table partitioned by ``batch_col`` only that
    partition's files are listed and read."""
    return df.filter(F.col(batch_col) == F.lit(batch_id))


def tag_batch(df: DataFrame, batch_id: str | Column, batch_col: str = "batch_id",
              date_col: str = "ingesta_date") -> DataFrame:
    """Add the batch id (literal or per-row expression) and its date."""
    b = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    return df.withColumn(batch_col, b).withColumn(date_col, F.try_to_date(F.col(batch_col)))


# --- writes ---------------------------------------------------------------------

def _put(df: DataFrame, path: str, partition_by: Iterable[str] | None, mode: str, **kw) -> V.Version:
    staged = V.stage(df, path, partition_by)
    return V.commit(df.sparkSession, path, staged, mode, **kw)


def create_if_missing(spark: SparkSession, path: str, schema: T.StructType,
                      partition_by: list[str] | None = None) -> bool:
    """``CREATE TABLE IF NOT EXISTS``: publish an empty typed table; True if created."""
    if table_exists(spark, path):
        return False
    _put(spark.createDataFrame([], schema), path, partition_by, "append")
    return True


def overwrite_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Create or fully replace a table, columns included.  ``df`` may read it."""
    _put(df, path, partition_by, "overwrite")


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 epoch: tuple[str, int] | None = None) -> None:
    """Add rows.  ``epoch`` (a stream and its micro-batch) is noted with them."""
    _put(df, path, partition_by, "append", epoch=epoch)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str],
                       base: V.Version | None = None, epoch: tuple[str, int] | None = None) -> None:
    """Replace exactly the partitions present in ``df``; others are untouched.

    ``df`` may read the same table; then give the version it reads as ``base``, and
    a partition that someone else replaces meanwhile raises instead of being lost.
    """
    _put(df, path, partition_by, "replace", base=base, epoch=epoch)


def replace_batch(df: DataFrame, path: str, batch_col: str = "batch_id") -> None:
    """Batch-scoped replace: rewrite the batch partition(s) of ``df`` only."""
    replace_partitions(df, path, [batch_col])


def write_batch(spark: SparkSession, df: DataFrame, path: str, batch_id: str,
                batch_col: str = "batch_id", mode: str = "replace") -> bool:
    """Write one batch.  ``mode='skip'`` leaves an existing batch alone (returns
    False); ``mode='replace'`` always rewrites the batch partition."""
    if mode == "skip" and table_exists(spark, path):
        if not scan_batch(read_table(spark, path), batch_col, batch_id).isEmpty():
            return False
    replace_batch(df, path, batch_col)
    return True


class MergeKeyError(ValueError):
    pass


def merge_into_table(spark: SparkSession, path: str, source: DataFrame, keys: list[str],
                     partition_col: str, *, guard: Guard | None = None,
                     keep_cols: list[str] | None = None,
                     touched: dict[str, Column] | None = None,
                     schema: T.StructType | None = None, epoch: tuple[str, int] | None = None) -> None:
    """Guarded upsert of ``source`` into the table at ``path``.

    Only the partitions present in the source are read and rewritten; the
    partition column must be part of ``keys``.  Raises when a source key
    occurs twice (a MERGE cannot pick one), or when another writer replaces one of
    the partitions meanwhile.  Creates the table on first use.  ``epoch``: a stream
    and the number of its micro-batch, noted in the same version.
    """
    if partition_col not in keys:
        raise ValueError("the partition column must be one of the merge keys")
    with scratch_table(source, "merge-source") as once:  # evaluated a single time
        if not duplicate_source_keys(once, keys).isEmpty():
            raise MergeKeyError(f"merge source has duplicate keys on {keys}")
        base = V.current(spark, path)
        if base is None:
            append_table(once, path, [partition_col], epoch)
            return
        # The touched partition values: one per batch in the source (a handful).
        parts = [r[0] for r in once.select(partition_col).distinct().collect()]
        target = V.read_version(spark, path, base, schema, (partition_col, parts))
        target = target.filter(F.col(partition_col).isin(parts))
        merged = merge_upsert(target, once.select(*target.columns), keys, guard=guard,
                              keep_cols=keep_cols, touched=touched)
        replace_partitions(merged, path, [partition_col], base, epoch)


def batch_exists_in(spark: SparkSession, path: str, col: str, value,
                    schema: T.StructType | None = None) -> bool:
    """True when the table holds at least one row with ``col = value`` (stops at
    the first match; a partition filter on partitioned tables)."""
    return not read_table(spark, path, schema).filter(F.col(col) == F.lit(value)).isEmpty()


def read_partition(spark: SparkSession, path: str, col: str, value,
                   schema: T.StructType | None = None) -> DataFrame:
    """One partition, with the columns and types of its own writes: those of other
    partitions have no say in them.  Only its folders are listed."""
    now = V.current(spark, path)
    if schema is None:
        own = [now.writes[w] for p, ws in now.parts.items() if f"{col}={value}" in p.split("/") for w in ws]
        folders = [f for f in now.schema.fields if f.name in now.partition_by]
        schema = T.StructType([*V.joined(own).fields, *folders])
    return V.read_version(spark, path, now, schema, (col, [value]))


def overwrite_partition(df: DataFrame, path: str, col: str, value) -> None:
    """Replace one partition with ``df`` (which must not carry ``col``).

    Unlike ``replace_partitions``, this also clears the partition when ``df`` is
    empty, so a per-batch table such as the audit never keeps rows from an earlier
    run of the batch.
    """
    _put(df.withColumn(col, F.lit(value)), path, [col], "replace", clear=[f"{col}={value}"])


def overwrite_partitions(df: DataFrame, path: str, col: str, values: Iterable,
                         base: V.Version | None = None) -> None:
    """Replace the partitions of all ``values`` by ``df`` (which carries ``col``) at
    once; those that it has no rows of are empty then."""
    _put(df, path, [col], "replace", base=base, clear=[f"{col}={v}" for v in values])


def drop_partitions(spark: SparkSession, path: str, col: str, values: Iterable) -> None:
    """Take partitions out of the table."""
    V.commit(spark, path, None, "replace", clear=[f"{col}={v}" for v in values])


def latest_partition_value(spark: SparkSession, path: str, col: str, cast: str | None = None):
    """The largest value of partition column ``col``, from the partitions that the
    current version names; no file is listed or opened."""
    return latest_partition(spark, path, col, cast).first()[0]


def latest_partition(spark: SparkSession, path: str, col: str,
                     cast: str | None = None) -> DataFrame:
    """``latest_partition_value`` as one row.  Use it as the latest-batch selector of
    the analytics (a one-row broadcast join, which also prunes the scan to that
    partition)."""
    now, mark = V.current(spark, path), f"{col}="
    values = [n[len(mark):] for p in (now.parts if now else ()) for n in p.split("/") if n.startswith(mark)]
    newest = spark.createDataFrame([(max(values, default=None),)], f"`{col}` string")
    return newest.select(F.col(col).cast(cast).alias(col)) if cast else newest
