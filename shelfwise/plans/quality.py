"""Data-quality reports over the bronze and snapshot tables.

All of them are single aggregates or joins; nothing is collected except the
one-row gate that decides whether a batch may proceed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.functions.money import money_round
from shelfwise.functions.text import normalize_key


def attribute_consistency(df: DataFrame, key: str, attr: str,
                          name: str = "variaciones") -> DataFrame:
    """Keys mapped to more than one distinct attribute value."""
    return (df.groupBy(key).agg(F.count_distinct(attr).alias(name))
            .filter(F.col(name) > 1))


def label_count_distribution(df: DataFrame, col: str = "num_octogonos") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("cantidad"))


def stock_state(df: DataFrame, price: str = "precio_regular",
                available: str = "disponible") -> DataFrame:
    """Rows per stock state: invalid price first, then availability."""
    p, a = F.col(price), F.col(available)
    state = (F.when(p.isNull() | (p <= 0), F.lit(K.STATE_INVALID_PRICE))
             .when(a == F.lit(False), F.lit(K.STATE_UNAVAILABLE))
             .when(a == F.lit(True), F.lit(K.STATE_AVAILABLE)))
    return df.groupBy(state.alias("estado")).agg(F.count(F.lit(1)).alias("cantidad"))


def array_size_violations(df: DataFrame, col: str, limit: int,
                          keep: tuple[str, ...] = ("productid", "productname")) -> DataFrame:
    """Rows whose array holds more than ``limit`` elements."""
    return (df.filter(F.size(col) > limit)
            .select(*keep, F.col(col), F.size(col).alias("num")))


def price_reconciliation(offers: DataFrame, reference: DataFrame, keys: list[str],
                         reference_price: str, tolerance: float = 0.01) -> DataFrame:
    """Direct (r − d) and adjusted ((r·u − d)/u) card prices against a reference list.

    ``offers`` needs precio_regular, unit_multiplier, mejor_descuento; the
    reference list is joined on ``keys`` (shuffle or broadcast by the planner).
    """
    r, u, d = F.col("precio_regular"), F.col("unit_multiplier"), F.col("mejor_descuento")
    o = offers.filter(d.isNotNull()).select(
        *keys, money_round(r - d).alias("directo"),
        money_round(F.try_divide(r * u - d, u)).alias("ajustado"))
    j = o.join(reference.select(*keys, F.col(reference_price).alias("web")), keys)
    return j.select(*keys, "web", "directo", "ajustado",
                    (F.abs(F.col("directo") - F.col("web")) < tolerance).alias("coincide_directo"),
                    (F.abs(F.col("ajustado") - F.col("web")) < tolerance).alias("coincide_ajustado"))


def colliding_columns(columns: list[str]) -> dict[str, list[str]]:
    """Raw column names that share one normal form (schema metadata, driver side)."""
    groups: dict[str, list[str]] = {}
    for c in columns:
        groups.setdefault(normalize_key(c, overrides={}), []).append(c)
    return {k: v for k, v in groups.items() if len(v) > 1}
