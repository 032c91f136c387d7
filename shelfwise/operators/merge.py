"""MERGE / UPDATE semantics as DataFrame transformations over plain tables.

Each function returns the *new content* of the target (lazy).  Writers in
``shelfwise.sources.tables`` apply them to only the touched partitions of a
parquet table.

Key equality is SQL equality: a NULL key never matches, exactly like a MERGE
``ON`` clause.  Source keys must be unique (checked by the writers, as MERGE
would raise on several source rows for one target row).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Side = Callable[[str], Column]
Guard = Callable[[Side, Side], Column]


def _prefixed(df: DataFrame, prefix: str, flag: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns], F.lit(True).alias(flag))


def _key_cond(keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col("t__" + k) == F.col("s__" + k))
    return cond


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], *,
                 guard: Guard | None = None, update_cols: list[str] | None = None,
                 keep_cols: list[str] | None = None,
                 touched: dict[str, Column] | None = None) -> DataFrame:
    """Upsert ``source`` into ``target`` on ``keys``.

    * matched and ``guard(t, s)`` true → the columns in ``update_cols`` (default:
      every source column) take the source value; ``keep_cols`` (e.g. a
      created timestamp) keep the target value;
    * matched and guard false/NULL → target row unchanged;
    * only in target → unchanged; only in source → inserted as is.
    ``touched`` overrides values written on updated rows (e.g. an updated
    timestamp); inserted rows keep their source values.
    """
    cols = target.columns
    keep = set(keep_cols or [])
    upd = set(update_cols or [c for c in source.columns if c not in keys]) - keep
    t = _prefixed(target, "t__", "_t")
    s = _prefixed(source.select(*[c for c in cols if c in source.columns]), "s__", "_s")
    j = t.join(s, _key_cond(keys), "full_outer")

    def tcol(c: str) -> Column:
        return F.col("t__" + c)

    def scol(c: str) -> Column:
        return F.col("s__" + c)

    matched = F.col("_t").isNotNull() & F.col("_s").isNotNull()
    ok = guard(tcol, scol) if guard else F.lit(True)
    update = matched & F.coalesce(ok, F.lit(False))
    insert = F.col("_t").isNull()
    out = []
    for c in cols:
        new = (touched or {}).get(c, scol(c)) if c in upd else tcol(c)
        src_val = scol(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType)
        out.append(F.when(insert, src_val).when(update, new).otherwise(tcol(c)).alias(c))
    return j.select(*out)


def merge_insert_only(target: DataFrame, source: DataFrame, keys: list[str], *,
                      drop_null_keys: bool = True) -> DataFrame:
    """Rows of ``source`` whose key is not in ``target`` (``WHEN NOT MATCHED THEN INSERT``).

    A MERGE would insert NULL-key source rows on every run, because NULL never
    matches; with ``drop_null_keys`` they are left out (report them through
    the referential audit instead).  Returns only the rows to append.
    """
    src = source
    if drop_null_keys:
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).isNotNull()
        src = src.filter(cond)
    return src.join(target.select(*keys), keys, "left_anti")


def merge_update_only(target: DataFrame, source: DataFrame, keys: list[str],
                      assignments: dict[str, Column], *,
                      target_condition: Column | None = None) -> DataFrame:
    """``WHEN MATCHED [AND cond] THEN UPDATE SET ...``; unmatched rows unchanged.

    ``assignments`` are expressions over the target's columns and the source's
    non-key columns, which are visible as ``src_<name>``; ``target_condition``
    is over the target's own columns.  Running the result raises an error when a
    key occurs twice in the source, since either row could be meant.
    """
    twice = F.lit("MERGE source has several rows for one key")
    source = source.groupBy(*keys).agg(
        F.when(F.count("*") > 1, F.raise_error(twice)).alias("_one"),
        *[F.first(c).alias(c) for c in source.columns if c not in keys]) \
        .filter(F.col("_one").isNull()).drop("_one")
    src = source.select(*keys, *[F.col(c).alias("src_" + c) for c in source.columns
                                 if c not in keys]).withColumn("_s", F.lit(True))
    j = target.join(src, keys, "left")
    hit = F.col("_s").isNotNull()
    if target_condition is not None:
        hit = hit & F.coalesce(target_condition, F.lit(False))
    return j.select(*[F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c)
                      if c in assignments else F.col(c) for c in target.columns])


def update_where(df: DataFrame, condition: Column, assignments: dict[str, Column]) -> DataFrame:
    """``UPDATE t SET c = v WHERE cond`` as a projection (NULL condition = no update)."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(*[F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c)
                       if c in assignments else F.col(c) for c in df.columns])


def duplicate_source_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once in a merge source (should be empty)."""
    return source.groupBy(*keys).count().filter(F.col("count") > 1)
