"""Stable surrogate keys for dimension rows, assigned in parallel.

A key is ``base + offset of the row's bucket + its position in the bucket``,
where ``base`` is the largest key already issued, buckets split the new
natural keys into ``n`` groups, offsets are the running totals of the bucket
sizes, and positions follow the natural key inside a bucket.  No
single-partition window touches the data (the offsets window has one row per
bucket), keys are dense (``base+1 .. base+N``), and keys already issued never
change.

Two bucketings:

* default — ``pmod(hash(natural key), n)``: a pure function of the key, so
  bucket membership is the same on every retry with nothing materialised and
  no sampling job.  Keys are unique and dense but not in key order (as with an
  identity column).
* ``ordered=True`` — range partitioning, so the keys follow the natural-key
  order (equal to a global ``row_number``).  Range bounds come from sampling,
  so the bucketed frame is written to the shared checkpoint folder and read
  back to fix membership before it is counted and numbered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import materialize


def assign_surrogate_keys(new_rows: DataFrame, natural_key: list[str], key_name: str, *,
                          base: int = 0, partitions: int | None = None,
                          ordered: bool = False) -> DataFrame:
    """Number ``new_rows`` (unique on ``natural_key``) as base+1, base+2, ..."""
    spark = new_rows.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if ordered:
        parted = materialize(new_rows.repartitionByRange(n, *natural_key)
                             .withColumn("_part", F.spark_partition_id()), "keys")
    else:
        parted = new_rows.withColumn(
            "_part", F.pmod(F.hash(*[F.col(c) for c in natural_key]), F.lit(n)))
    sizes = parted.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_offset"))
    w = Window.partitionBy("_part").orderBy(*natural_key)
    return (parted.withColumn("_pos", F.row_number().over(w))
            .join(F.broadcast(offsets), "_part")
            .withColumn(key_name, (F.lit(base) + F.col("_offset") + F.col("_pos")).cast("long"))
            .drop("_part", "_offset", "_pos")
            .select(key_name, *new_rows.columns))


def max_key(df: DataFrame | None, key_name: str) -> int:
    """Largest key issued so far (0 for a missing or empty dimension)."""
    if df is None:
        return 0
    v = df.agg(F.max(key_name)).first()[0]
    return int(v or 0)
