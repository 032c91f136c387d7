"""Named tables: schemas (databases) and external tables of the session catalog.

``CREATE SCHEMA``, ``USE``, ``CREATE TABLE ... PARTITIONED BY / CLUSTERED BY ...
LOCATION``, ``INSERT ... SELECT``, ``MSCK REPAIR`` and existence tests as functions
over names.  Data stays in folders of its own choice, so a table can be named
again in another session.  ``name_version`` names what ``sources.versions`` has
published: every partition of the name points to the folder of the current version.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import path_exists
from shelfwise.sources import versions as V


def quoted(name: str) -> str:
    """``schema.table`` with each part in backquotes."""
    parts = name.split(".")
    if not all(re.fullmatch(r"\w+", p) for p in parts):
        raise ValueError(f"not a table name: {name!r}")
    return ".".join(f"`{p}`" for p in parts)


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> bool:
    """``CREATE SCHEMA IF NOT EXISTS``; True if it was created."""
    if spark.catalog.databaseExists(name):
        return False
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA {quoted(name)}{at}")
    return True


@contextmanager
def use_schema(spark: SparkSession, name: str) -> Iterator[None]:
    """``USE name`` for a block; the schema that was in use comes back after it."""
    before = spark.catalog.currentDatabase()
    spark.sql(f"USE {quoted(name)}")
    try:
        yield
    finally:
        spark.sql(f"USE {quoted(before)}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str, *,
                 partition_by: list[str] | None = None, bucket_by: list[str] | None = None,
                 buckets: int = 0) -> bool:
    """``CREATE TABLE IF NOT EXISTS`` over a folder, with what is in it already.

    Files found there are not looked at: partitions in ``column=value`` folders are
    taken up at once (``recover_partitions``), buckets are trusted to be as declared.
    Returns True if the name is new.
    """
    named = quoted(name)
    if table_exists(spark, name):
        return False
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parted = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    keys = ", ".join(f"`{c}`" for c in bucket_by or [])
    clustered = f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS" if bucket_by else ""
    spark.sql(f"CREATE TABLE {named} ({cols}) USING parquet{parted}{clustered} LOCATION '{location}'")
    if partition_by and path_exists(spark, location):
        recover_partitions(spark, name)
    return True


def recover_partitions(spark: SparkSession, name: str) -> None:
    """Take up partition folders that others have added (``MSCK REPAIR TABLE``)."""
    spark.sql(f"ALTER TABLE {quoted(name)} RECOVER PARTITIONS")


def insert_select(spark: SparkSession, name: str, rows: DataFrame, overwrite: bool = False) -> None:
    """``INSERT INTO name SELECT``: columns are matched by name and take the table's
    types (a value that does not fit raises); a column that is left out is NULL, one the
    table lacks is an error.  ``overwrite`` replaces the partitions ``rows`` has (all
    rows, in a table without partitions)."""
    schema = spark.table(name).schema
    have = {c.lower() for c in rows.columns}
    unknown = have - {f.name.lower() for f in schema.fields}
    if unknown:
        raise ValueError(f"{name} has no columns {sorted(unknown)}")
    typed = rows.select(*[(F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None))
                          .cast(f.dataType).alias(f.name) for f in schema.fields])
    typed.write.insertInto(name, overwrite=overwrite)


def _literal(folder_value: str) -> str:
    """The SQL literal of a partition value as folder names write it."""
    if folder_value == "__HIVE_DEFAULT_PARTITION__":
        return "NULL"
    value = unquote(folder_value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{value}'"


def name_version(spark: SparkSession, name: str, root: str) -> int:
    """Make ``name`` stand for the current version of the table at ``root``; returns
    the version's number.  Call it again after each publication.

    A partition of more than one write (appends) is first put into one file set by
    ``versions.compact``; so is a write with other columns or types than the table has.
    """
    now = V.compact(spark, root, uniform=True)
    if table_exists(spark, name):
        spark.sql(f"DROP TABLE {quoted(name)}")  # external: the files stay
    folders = {part: f"{root.rstrip('/')}/{V.WRITE}={w[0]}/{part}".rstrip("/") for part, w in now.parts.items()}
    if not now.partition_by:
        create_table(spark, name, now.schema, folders.get("", f"{root.rstrip('/')}/{V.WRITE}=none"))
        return now.number
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in now.schema.fields)
    by = ", ".join(f"`{c}`" for c in now.partition_by)
    spark.sql(f"CREATE TABLE {quoted(name)} ({cols}) USING parquet PARTITIONED BY ({by}) "
              f"LOCATION '{root.rstrip('/')}/{V.WRITE}=none'")
    adds = []
    for part, folder in folders.items():
        spec = ", ".join(f"`{c}` = {_literal(v)}" for c, v in (p.split("=", 1) for p in part.split("/")))
        adds.append(f"PARTITION ({spec}) LOCATION '{folder}'")
    for i in range(0, len(adds), 500):
        spark.sql(f"ALTER TABLE {quoted(name)} ADD {' '.join(adds[i:i + 500])}")
    return now.number
