"""Contiguous shards of nearly equal bytes from global prefix sums.

The rows get a fixed global order (hash of the text, then a hash of the
identifier), so equal texts stand together.  The order is cut into logical
partitions by the leading bits of the text hash; one total for each partition,
summed up over the partitions, gives where each begins, and running sums inside
give every row its global byte position.  Cutting at multiples of
``total / n_shards`` yields shards of the same size up to one document.

Only DataFrame functions are used.  A text that makes up a third of the corpus
is spread over ``copy_cells`` cells, each numbered by itself, so no task gets
more than that part of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import require_columns, utf8_bytes
from shelfwise.session import materialize

#: Logical partitions of the global order: a fixed number, so that their
#: totals are a table of bounded size (2**14 rows).
ORDER_BITS = 14


def assign_shards(df: DataFrame, n_shards: int = 16, id_col: str = "doc_id",
                  text_col: str = "text", copy_cells: int = 1024) -> DataFrame:
    """One row for each row of ``df``: its identifier, ``size`` (UTF-8 bytes of
    the text plus 1; a null text has 0 bytes), ``text_crc32`` (null for a null
    text), ``shard`` (0 to ``n_shards - 1``) and ``slot`` (its place in the
    shard, gapless from 0).

    Null identifiers, null, empty or very long texts and repeated rows are rows
    like any others: each gets a place of its own.  Repeated rows are
    interchangeable.  An empty table gives an empty table.  Other columns of
    ``df`` are not looked at, whatever their names.
    """
    require_columns(df, [id_col, text_col])
    text = F.col(text_col)
    slim = df.select(
        F.col(id_col).alias("id"),
        (utf8_bytes(text) + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.xxhash64(text).alias("th"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(copy_cells)).alias("cell"))
    slim = materialize(slim, "shard-sizes")

    # One row for each (text, cell): rows of one text are of one size.
    key = ["th", "size", "cell"]
    cells = slim.groupBy(*key).agg(F.count("*").alias("n")) \
        .withColumn("part", F.shiftrightunsigned("th", 64 - ORDER_BITS)) \
        .withColumn("bytes", F.col("n") * F.col("size"))
    cells = materialize(cells, "shard-cells")
    parts = cells.groupBy("part").agg(F.sum("bytes").alias("p_bytes"), F.sum("n").alias("p_rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "part", F.coalesce(F.sum("p_bytes").over(before), F.lit(0)).alias("b0"),
        F.coalesce(F.sum("p_rows").over(before), F.lit(0)).alias("r0"),
        F.sum("p_bytes").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("part").orderBy(*key) \
        .rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        *key, "part", F.coalesce(F.sum("bytes").over(inside), F.lit(0)).alias("b1"),
        F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("r1"))
    # broadcast: at most 2**ORDER_BITS rows of four numbers
    cells = cells.join(F.broadcast(parts), "part").select(
        *key, (F.col("b0") + F.col("b1")).alias("b"), (F.col("r0") + F.col("r1")).alias("r"),
        "total")

    rows = slim.withColumn("k", F.row_number().over(
        Window.partitionBy(*key).orderBy("id", "crc")) - 1).join(cells, key)
    middle = F.col("b") * 2 + F.col("k") * 2 * F.col("size") + F.col("size")
    ranked = rows.select(
        "id", "size", "crc", (F.col("r") + F.col("k")).alias("rank"), middle.alias("m2"), "total") \
        .withColumn("shard", F.least(F.lit(n_shards - 1), F.expr(
            f"cast((m2 * {int(n_shards)}) div (2 * total) as int)")))
    ranked = materialize(ranked, "shard-ranks")
    starts = ranked.groupBy("shard").agg(F.min("rank").alias("start"))  # n_shards rows
    return ranked.join(F.broadcast(starts), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("rank") - F.col("start")).alias("slot"))


def write_shards(df: DataFrame, path: str, n_shards: int = 16, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write the corpus as one folder ``shard=k`` for each shard.

    Identifiers must be unique and not null: the rows are matched to their
    shards by them.
    """
    plan = assign_shards(df, n_shards, id_col, text_col).select(id_col, "shard", "slot")
    (df.drop("shard", "slot").join(plan, id_col)
       .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
