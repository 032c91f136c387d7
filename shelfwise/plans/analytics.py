"""The standing questions over the price snapshot (latest-batch KPIs, trends,
price moves, promotion and stock-out shares, catalogue churn).

Every function takes a flat snapshot frame (fact already joined to the
dimensions it needs) with configurable column names.  The latest batch is the
maximum *date* (not the maximum surrogate key, which is wrong after a
backfill).  Joins to one-row batch selectors are broadcast (their size is
exactly one row).  On a date-partitioned table, pass the latest date taken
from the file listing instead: it becomes a static partition filter, so only
that batch's partition is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import constants as K
from shelfwise.functions.money import money_round, pct_of

DATE = "ingesta_date"


def cond_count(c):
    """``SUM(CASE WHEN c THEN 1 ELSE 0 END)``: NULL over no rows, like the source queries."""
    return F.sum(F.when(c, F.lit(1)).otherwise(F.lit(0)))


def latest_batch(snap: DataFrame, date_col: str = DATE) -> DataFrame:
    """One row: the latest batch date."""
    return snap.agg(F.max(date_col).alias(date_col))


def batch_pair(snap: DataFrame, date_col: str = DATE) -> DataFrame:
    """One row: ``ultimo`` (latest date) and ``anterior`` (latest date before it; NULL
    when there is a single batch)."""
    # Distinct dates (partial aggregation), the two latest (top-2), folded
    # into one row by a single aggregate: no join between one-row frames.
    top2 = (snap.select(date_col).distinct()
            .orderBy(F.col(date_col).desc()).limit(2))
    return top2.agg(F.max(date_col).alias("ultimo"),
                    F.when(F.count(date_col) == 2, F.min(date_col)).alias("anterior"))


def latest_batch_rows(snap: DataFrame, date_col: str = DATE, latest=None) -> DataFrame:
    """Rows of the latest batch.

    By default a broadcast join to the one-row ``max`` selector.  On a table
    partitioned by the date only the selected partition is then read: the planner
    prunes the scan at run time by what the selector gives (it does so for a selector
    with a filter that may leave rows out, hence the one below, which leaves out
    none).  ``latest`` may instead be a one-row frame, or the latest value itself
    (e.g. from ``sources.tables.latest_partition_value``): a literal filter is a
    static partition filter, so only that partition is listed.
    """
    if latest is not None and not isinstance(latest, DataFrame):
        return snap.filter(F.col(date_col) == F.lit(latest))
    sel = latest if latest is not None else latest_batch(snap, date_col)
    sel = sel.select(date_col)
    if isinstance(sel.schema[date_col].dataType, T.DateType):
        sel = sel.filter(F.col(date_col) >= F.make_date(F.lit(1), F.lit(1), F.lit(1)))
    return snap.join(F.broadcast(sel), date_col)


def previous_batch_rows(snap: DataFrame, date_col: str = DATE) -> DataFrame:
    """Rows of the batch before the latest one."""
    prev = batch_pair(snap, date_col).select(F.col("anterior").alias(date_col))
    return snap.join(F.broadcast(prev), date_col)


def latest_batch_kpis(snap: DataFrame, date_col: str = DATE, price: str = "precio_regular",
                      available: str = "disponible", promo: str = "en_promocion",
                      valid: str = "precio_valido",
                      card_pct: str = "descuento_tarjeta_sip_pct",
                      latest=None) -> DataFrame:
    """Catalogue size, availability, promotions, mean valid price and mean card discount."""
    base = latest_batch_rows(snap, date_col, latest)
    return base.agg(
        F.count(F.lit(1)).alias("total_productos"),
        cond_count(F.col(available)).alias("disponibles"),
        cond_count(~F.col(available)).alias("sin_stock"),
        cond_count(F.col(promo)).alias("con_sip"),
        money_round(F.avg(F.when(F.col(valid), F.col(price)))).alias("precio_promedio"),
        F.round(F.avg(F.when(F.col(promo), F.col(card_pct))), 1).alias("descuento_sip_promedio"),
    )


def top_category_trend(snap: DataFrame, k: int = 5, date_col: str = DATE,
                       category: str = "categoria_principal", price: str = "precio_regular",
                       valid: str = "precio_valido") -> DataFrame:
    """Mean valid price per day for the k categories with the highest overall mean.

    The ranking mean runs over all history; ties are broken by category name.
    The top-k list has at most k rows and is broadcast into a semi join.
    """
    base = snap.filter(F.col(valid) & F.col(category).isNotNull()).select(date_col, category, price)
    top = (base.groupBy(category).agg(F.avg(price).alias("_avg"))
           .orderBy(F.col("_avg").desc(), F.col(category).asc()).limit(k).select(category))
    return (base.join(F.broadcast(top), category, "left_semi")
            .groupBy(date_col, category)
            .agg(money_round(F.avg(price)).alias("precio_promedio"))
            .orderBy(F.col(date_col), F.col("precio_promedio").desc(), F.col(category)))


def price_moves(snap: DataFrame, key: str = "productid", date_col: str = DATE,
                price: str = "precio_regular", valid: str = "precio_valido",
                extra: tuple[str, ...] = ("productname", "categoria_principal")) -> DataFrame:
    """Every change of a product's valid price against its previous valid row.

    LAG runs over the product's own valid rows (not the previous calendar day).
    The window is partitioned by product; a product has at most one row per
    batch, so a partition holds at most one row per batch date.
    """
    w = Window.partitionBy(key).orderBy(date_col)
    lagged = (snap.filter(F.col(valid))
              .select(key, *extra, F.col(date_col).alias("fecha"), F.col(price).alias("precio_actual"),
                      F.lag(price).over(w).alias("precio_anterior")))
    return (lagged.filter(F.col("precio_anterior").isNotNull()
                          & (F.col("precio_actual") != F.col("precio_anterior")))
            .select(key, *extra, "fecha", "precio_anterior", "precio_actual",
                    F.round(F.col("precio_actual") - F.col("precio_anterior"), 2).alias("variacion"),
                    F.round((F.col("precio_actual") - F.col("precio_anterior"))
                            / F.col("precio_anterior") * 100, 1).alias("variacion_pct")))


def next_price_moves(last_prices: DataFrame | None, batch: DataFrame, key: str = "productid",
                     date_col: str = DATE, price: str = "precio_regular",
                     valid: str = "precio_valido",
                     extra: tuple[str, ...] = ("productname", "categoria_principal")
                     ) -> tuple[DataFrame, DataFrame]:
    """Incremental ``price_moves`` for one new batch.

    ``last_prices`` holds one row per product — its latest valid price
    (``key``, ``fecha``, ``precio``) before this batch (None before the first
    batch).  Returns the batch's moves and the updated ``last_prices``.  Folded
    over the batches in date order this equals ``price_moves`` over the whole
    history, but each day only joins one batch with one row per product,
    instead of shuffling the entire history for the LAG window.  Persist both
    results as tables each day (moves appended, last prices replaced) so the
    lineage does not grow.
    """
    cur = batch.filter(F.col(valid)).select(
        key, *extra, F.col(date_col).alias("fecha"), F.col(price).alias("precio_actual"))
    if last_prices is None:
        moves = cur.limit(0).select(key, *extra, "fecha", F.lit(None).cast("double")
                                    .alias("precio_anterior"), "precio_actual")
        last = cur.select(key, "fecha", F.col("precio_actual").alias("precio"))
    else:
        prev = last_prices.select(key, F.col("precio").alias("precio_anterior"))
        moves = (cur.join(prev, key)
                 .filter(F.col("precio_actual") != F.col("precio_anterior"))
                 .select(key, *extra, "fecha", "precio_anterior", "precio_actual"))
        last = (last_prices.join(cur.select(key), key, "left_anti")
                .unionByName(cur.select(key, "fecha", F.col("precio_actual").alias("precio"))))
    moves = moves.select(
        "*", F.round(F.col("precio_actual") - F.col("precio_anterior"), 2).alias("variacion"),
        F.round((F.col("precio_actual") - F.col("precio_anterior"))
                / F.col("precio_anterior") * 100, 1).alias("variacion_pct"))
    return moves, last


def price_movers(snap: DataFrame, k: int = 15, key: str = "productid", **kw) -> DataFrame:
    """The k largest price moves by absolute percentage (ties: product, date)."""
    return (price_moves(snap, key=key, **kw)
            .orderBy(F.abs("variacion_pct").desc(), F.col(key).asc(), F.col("fecha").asc())
            .limit(k))


def promo_share_by_category(snap: DataFrame, date_col: str = DATE,
                            category: str = "categoria_principal", promo: str = "en_promocion",
                            card_pct: str = "descuento_tarjeta_sip_pct",
                            latest=None) -> DataFrame:
    """Per category in the latest batch: size, promoted count and share, mean card discount."""
    base = latest_batch_rows(snap, date_col, latest).filter(F.col(category).isNotNull())
    return (base.groupBy(category).agg(
        F.count(F.lit(1)).alias("total_productos"),
        cond_count(F.col(promo)).alias("con_sip"),
        pct_of(cond_count(F.col(promo)), F.count(F.lit(1))).alias("pct_con_sip"),
        F.round(F.avg(F.when(F.col(promo), F.col(card_pct))), 1).alias("descuento_sip_promedio"))
        .orderBy(F.col("pct_con_sip").desc(), F.col(category)))


def stockout_by_category(snap: DataFrame, date_col: str = DATE,
                         category: str = "categoria_principal",
                         available: str = "disponible",
                         latest=None) -> DataFrame:
    """Per category in the latest batch: size, available, out of stock and its share."""
    base = latest_batch_rows(snap, date_col, latest).filter(F.col(category).isNotNull())
    return (base.groupBy(category).agg(
        F.count(F.lit(1)).alias("total"),
        cond_count(F.col(available)).alias("disponibles"),
        cond_count(~F.col(available)).alias("sin_stock"),
        pct_of(cond_count(~F.col(available)), F.count(F.lit(1))).alias("pct_sin_stock"))
        .orderBy(F.col("pct_sin_stock").desc(), F.col(category)))


def churn_rows(snap: DataFrame, key: str = "productid", date_col: str = DATE,
               cols: tuple[str, ...] = ("productname", "categoria_principal", "precio_regular")
               ) -> DataFrame:
    """Products new in the latest batch and products gone since the previous one.

    With a single batch there is no previous one: everything is new.  The
    NOT EXISTS tests are anti joins on the product key (sort-merge or
    broadcast, chosen at run time on the real batch sizes).
    """
    pair = batch_pair(snap, date_col)
    last = snap.join(F.broadcast(pair.select(F.col("ultimo").alias(date_col))), date_col)
    prev = snap.join(F.broadcast(pair.select(F.col("anterior").alias(date_col))), date_col)
    new = last.join(prev.select(key), key, "left_anti").select(F.lit(K.TAG_NEW).alias("tipo"), key, *cols)
    gone = prev.join(last.select(key), key, "left_anti").select(F.lit(K.TAG_GONE).alias("tipo"), key, *cols)
    return new.unionByName(gone)


def catalog_churn(snap: DataFrame, key: str = "productid", date_col: str = DATE,
                  category: str = "categoria_principal") -> DataFrame:
    """Count of new and discontinued products and of distinct categories touched."""
    return (churn_rows(snap, key, date_col)
            .groupBy("tipo")
            .agg(F.count(F.lit(1)).alias("total"),
                 F.count_distinct(category).alias("categorias_afectadas")))
