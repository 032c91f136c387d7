"""Row filters of the snapshot build and the batch gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.functions.text import bundle_pattern
from shelfwise.functions.util import as_col


def bundle_predicate(category: Column | str = "categoria_principal",
                     name: Column | str = "productname",
                     categories: list[str] | None = None,
                     words: list[str] | None = None) -> Column:
    """True for a promotional bundle: bundle category OR bundle word in the name."""
    return (as_col(category).isin(*(categories or K.BUNDLE_CATEGORIES))
            | as_col(name).rlike(bundle_pattern(words)))


def exclude_promotional(df: DataFrame, category: str = "categoria_principal",
                        name: str = "productname", categories: list[str] | None = None,
                        words: list[str] | None = None) -> DataFrame:
    """Drop bundles with three-valued logic: a NULL category or name drops the row.

    ``NOT (c IN set) AND NOT (name RLIKE p)`` is NULL when either side is NULL,
    and a filter keeps only TRUE — kept on purpose, as in the source system.
    """
    keep = (~F.col(category).isin(*(categories or K.BUNDLE_CATEGORIES))
            & ~F.col(name).rlike(bundle_pattern(words)))
    return df.filter(keep)


def keep_valid_channels(df: DataFrame, channel: str = "canal_venta",
                        valid: list[str] | None = None) -> DataFrame:
    """Keep known channels.  The channel is defaulted before this filter, so
    a NULL can no longer occur and no NULL branch is needed."""
    return df.filter(F.col(channel).isin(*(valid or K.VALID_CHANNELS)))


def gate_counts(df: DataFrame, key_cols: list[str], date_col: str | None = None) -> DataFrame:
    """One-row frame: total rows, rows with a NULL key, rows with a NULL date."""
    null_key = F.lit(False)
    for k in key_cols:
        null_key = null_key | F.col(k).isNull()
    aggs = [F.count(F.lit(1)).alias("total_rows"),
            F.count_if(null_key).alias("null_key_rows")]
    aggs.append(F.count_if(F.col(date_col).isNull()).alias("null_date_rows") if date_col
                else F.lit(0).cast("long").alias("null_date_rows"))
    return df.agg(*aggs)


class BatchGateError(ValueError):
    pass


def enforce_gate(df: DataFrame, key_cols: list[str], date_col: str | None = None) -> None:
    """Raise when the batch is empty or has NULL keys/dates (one aggregate job)."""
    r = gate_counts(df, key_cols, date_col).first()
    if r["total_rows"] == 0:
        raise BatchGateError("batch is empty")
    if r["null_key_rows"] or r["null_date_rows"]:
        raise BatchGateError(
            f"batch has {r['null_key_rows']} rows with a NULL key and "
            f"{r['null_date_rows']} rows with a NULL date")


def batch_exists(df: DataFrame, batch_col: str, batch_id: str) -> bool:
    """Existence probe: stops at the first matching row."""
    return not df.filter(F.col(batch_col) == F.lit(batch_id)).isEmpty()
