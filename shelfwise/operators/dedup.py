"""Keep one best row per key, and consolidate a column's values over the group.

The textbook form is two windows over the same partitioning (``collect_set``
over the whole group, ``row_number`` under an order, keep ``rn = 1``): one
exchange that moves *every* row, then a sort of every group.  A hot key (one
product seen in a third of all rows) lands in a single task and is sorted
there.

The default form here is an aggregate instead: ``min`` over a struct whose
leading fields encode the requested order, followed by the row itself.  Struct
comparison is lexicographic, so the minimum *is* the first row under the
order, and ties are broken by the remaining fields, which makes the choice
deterministic.  Being an aggregate, it is combined map-side: each task ships
at most one candidate per key, so skewed keys are pre-aggregated before the
shuffle.  ``sort_array(collect_set(...))`` rides in the same aggregate (its
size is bounded by the number of distinct values of that column, e.g. the
sixteen catalogue sections).

The window form (one sort of each partition, no aggregation buffers) is for
rows that already lie together by the key or part of it, with few rows for each
key: there is nothing to combine and nothing to shuffle, and the aggregate would
hold every row twice, as its input and as its buffer.  It gives the same rows, ties
included.  It also serves orders the aggregate cannot express (a string key
sorted against the dominant direction).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class SortKey:
    """One ordering term: a column (or expression) with direction and null placement."""

    expr: Column | str
    ascending: bool = True
    nulls_last: bool = True
    name: str | None = None

    def column(self) -> Column:
        return F.col(self.expr) if isinstance(self.expr, str) else self.expr


def asc(expr: Column | str, nulls_last: bool = True) -> SortKey:
    return SortKey(expr, True, nulls_last)


def desc(expr: Column | str, nulls_last: bool = True) -> SortKey:
    return SortKey(expr, False, nulls_last)


def _sort_columns(order: list[SortKey]) -> list[Column]:
    out = []
    for k in order:
        c = k.column()
        if k.ascending:
            out.append(c.asc_nulls_last() if k.nulls_last else c.asc_nulls_first())
        else:
            out.append(c.desc_nulls_last() if k.nulls_last else c.desc_nulls_first())
    return out


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType | T.VariantType):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def _aggregate_plan(df: DataFrame, order: list[SortKey]):
    """Fields for ``min``/``max`` over a struct, or None when not expressible."""
    types = [df.select(k.column()).schema.fields[0].dataType for k in order]
    # Strings (and other non-negatable types) fix the direction of the aggregate.
    fixed = {k.ascending for k, t in zip(order, types) if not isinstance(t, _NUMERIC + (T.BooleanType, T.DateType))}
    if len(fixed) > 1:
        return None
    use_min = fixed.pop() if fixed else True  # min keeps ascending order
    fields = []
    for i, (k, t) in enumerate(zip(order, types)):
        c = k.column()
        same = k.ascending == use_min
        nan = []
        if not same:
            if isinstance(t, T.BooleanType):
                c = ~c
            elif isinstance(t, T.DateType):
                c = F.bitwise_not(F.unix_date(c))
            elif isinstance(t, _INTEGRAL):
                c = F.bitwise_not(c)  # -x - 1: the order reversed, for the smallest value too
            else:
                if isinstance(t, T.FloatType | T.DoubleType):
                    nan = [(~F.isnan(c)).alias(f"_f{i}")]  # NaN is the largest, so first when reversed
                c = -c
        # Null placement: the flag sorts before the value.
        null_first_under_agg = (not k.nulls_last) if use_min else k.nulls_last
        flag = c.isNotNull() if null_first_under_agg else c.isNull()
        fields += [flag.alias(f"_n{i}"), *nan, c.alias(f"_k{i}")]
    return use_min, fields


def best_row_per_key(df: DataFrame, keys: list[str], order: list[SortKey], *,
                     gather: dict[str, str] | None = None,
                     method: str = "aggregate") -> DataFrame:
    """One row per ``keys``: the first under ``order``; gathered sets alongside.

    ``gather`` maps an output name to a column whose distinct non-NULL values
    over the whole group are returned as a sorted array.  Columns of the
    chosen row keep their names and order; gathered columns follow.
    """
    gather = gather or {}
    payload = [c for c in df.columns if c not in keys]
    plan = _aggregate_plan(df, order)
    if method == "window" or plan is None or not all(_orderable(f.dataType) for f in df.schema.fields):
        return _best_row_window(df, keys, order, gather, plan is None or plan[0])

    use_min, fields = plan
    row = F.struct(*fields, F.struct(*[F.col(c) for c in payload]).alias("_row"))
    pick = F.min(row) if use_min else F.max(row)
    aggs = [pick.alias("_best")]
    aggs += [F.sort_array(F.collect_set(src)).alias(out) for out, src in gather.items()]
    g = df.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) for k in keys] + [F.col(f"_best._row.{c}").alias(c) for c in payload]
    cols += [F.col(out) for out in gather]
    return g.select(*cols).select(*df.columns, *gather.keys())


def _best_row_window(df: DataFrame, keys: list[str], order: list[SortKey],
                     gather: dict[str, str], ties_ascending: bool) -> DataFrame:
    """One sort for both: the sets over the whole group and the row number.  Ties are
    broken by the remaining columns, as the aggregate's struct does."""
    ties = [F.col(f.name).asc_nulls_first() if ties_ascending else F.col(f.name).desc_nulls_last()
            for f in df.schema.fields if f.name not in keys and _orderable(f.dataType)]
    w = Window.partitionBy(*keys).orderBy(*_sort_columns(order), *ties)
    group = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = df.select("*", *[F.collect_set(src).over(group).alias(name) for name, src in gather.items()],
                    F.row_number().over(w).alias("_rn")).filter(F.col("_rn") == 1)
    return out.select(*df.columns, *[F.sort_array(name).alias(name) for name in gather])


def duplicate_keys(df: DataFrame, keys: list[str], top: int | None = 10,
                   count_name: str = "veces") -> DataFrame:
    """Keys that occur more than once, most repeated first (``HAVING COUNT(*) > 1``)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)
    g = g.orderBy(F.col(count_name).desc(), *[F.col(k).asc() for k in keys])
    return g.limit(top) if top else g
