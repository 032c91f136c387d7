"""Gold star schema over the snapshot: calendar, brand, channel, category,
product and label (junk) dimensions, the periodic-snapshot fact and the
referential audit.

Dimensions are insert-only: a natural key keeps the surrogate key (and the
attributes) it got when first seen.  Two fixes to the source behaviour, both
deliberate:

* one row per natural key before inserting — a DISTINCT over more columns than
  the key would insert two rows for two spellings and fan out the fact; the
  attributes of the earliest batch win, ties broken by value;
* NULL natural keys are never inserted (NULL never matches, so they would be
  inserted again on every run); their rows surface in the audit instead.

Join strategy: the fact joins six dimensions on natural keys.  Calendar, channel
and label dimensions are small by construction (days, a handful of channels, 32
combinations) and are broadcast.  Brand, category and product grow with the
catalogue, so they are left to the planner: AQE converts them to broadcast at
run time when the measured side is small and keeps a shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.functions.dates import calendar_columns
from shelfwise.operators.keys import assign_surrogate_keys, max_key
from shelfwise.operators.merge import merge_insert_only
from shelfwise.session import materialize, scratch_table

DATE = "ingesta_date"
LABEL_COLS = ["alto_sodio", "alto_azucar", "alto_saturadas", "num_octogonos"]


def _not_null(keys: list[str]) -> Column:
    c = F.lit(True)
    for k in keys:
        c = c & F.col(k).isNotNull()
    return c


def first_seen(src: DataFrame, natural_key: list[str], attrs: list[str],
               date_col: str = DATE) -> DataFrame:
    """One row per non-NULL natural key with the attributes of its earliest
    batch (ties: smallest attribute values).  An aggregate, so map-side combined."""
    if not attrs:
        return src.filter(_not_null(natural_key)).select(*natural_key).distinct()
    best = F.min(F.struct(F.col(date_col).alias("_d"), *[F.col(a) for a in attrs]))
    return (src.filter(_not_null(natural_key))
            .groupBy(*natural_key).agg(best.alias("_b"))
            .select(*natural_key, *[F.col(f"_b.{a}").alias(a) for a in attrs]))


# --- dimension sources (natural columns only) -------------------------------------------

def calendar_rows(src: DataFrame, date_col: str = DATE) -> DataFrame:
    d = src.select(F.col(date_col).alias("fecha")).filter(F.col("fecha").isNotNull()).distinct()
    return d.withColumns(calendar_columns("fecha"))


def brand_rows(src: DataFrame) -> DataFrame:
    return first_seen(src, ["brandid"], ["brand"])


def channel_rows(src: DataFrame) -> DataFrame:
    return first_seen(src, ["canal_venta"], [])


def category_rows(src: DataFrame) -> DataFrame:
    return first_seen(src, ["categoryid", "subcategoria", "grupo_producto"], ["categoria_principal"])


PRODUCT_ATTRS = ["sku", "productname", "tipo_especifico_producto", "fecha_lanzamiento", "vendedor"]


def product_rows(src: DataFrame) -> DataFrame:
    return first_seen(src, ["productid"], PRODUCT_ATTRS)


def label_junk(spark) -> DataFrame:
    """All 2×2×2×4 = 32 label combinations, generated (no join) with keys 1..32."""
    n = len(K.LABEL_COUNTS)
    i = F.col("_i")
    return (spark.range(0, 8 * n).withColumnRenamed("id", "_i")
            .select((i + 1).alias("etiquetado_key"),
                    ((i / (4 * n)).cast("int") % 2 == 0).alias("alto_sodio"),
                    ((i / (2 * n)).cast("int") % 2 == 0).alias("alto_azucar"),
                    ((i / n).cast("int") % 2 == 0).alias("alto_saturadas"),
                    F.element_at(F.array(*[F.lit(c) for c in K.LABEL_COUNTS]),
                                 (i % n + 1).cast("int")).alias("num_octogonos")))


# --- keyed dimensions -------------------------------------------------------------------

DIMENSIONS = {
    # name: (key column, natural key, rows builder)
    "fecha": ("fecha_key", ["fecha"], calendar_rows),
    "marca": ("marca_key", ["brandid"], brand_rows),
    "canal": ("canal_key", ["canal_venta"], channel_rows),
    "categoria": ("categoria_key", ["categoryid", "subcategoria", "grupo_producto"], category_rows),
    "producto": ("producto_key", ["productid"], product_rows),
}


def new_members(existing: DataFrame | None, rows: DataFrame, natural_key: list[str]) -> DataFrame:
    """Rows whose natural key is not in the dimension yet."""
    return rows if existing is None else merge_insert_only(existing, rows, natural_key)


def number_members(existing: DataFrame | None, new: DataFrame, key_name: str,
                   natural_key: list[str]) -> DataFrame:
    """``new`` with keys after the largest one issued.  They are read twice (to
    size the buckets, to number the rows), so they should be a written table."""
    base = 0 if existing is None else max_key(existing, key_name)
    return assign_surrogate_keys(new, natural_key, key_name, base=base)


def extend_dimension(existing: DataFrame | None, rows: DataFrame, key_name: str,
                     natural_key: list[str]) -> DataFrame:
    """Rows to append: natural keys not yet present, numbered after the largest key."""
    return number_members(existing, new_members(existing, rows, natural_key), key_name, natural_key)


def build_dimensions(src: DataFrame, existing: dict[str, DataFrame] | None = None
                     ) -> dict[str, DataFrame]:
    """Every dimension after loading ``src``: existing rows plus new ones.

    Each is written once to the shared scratch folder, as a load would, and read
    back: its true size then decides how the fact is joined to it.
    """
    existing = existing or {}
    out = {}
    for name, (key, nk, builder) in DIMENSIONS.items():
        old = existing.get(name)
        with scratch_table(new_members(old, builder(src), nk), f"new-{name}") as rows:
            new = number_members(old, rows, key, nk)
            out[name] = materialize(new if old is None else old.unionByName(new), f"dim-{name}")
    junk = existing.get("etiquetado")
    out["etiquetado"] = junk if junk is not None else label_junk(src.sparkSession)
    return out


# --- fact and audit ----------------------------------------------------------------------

SMALL_DIMS = {"fecha", "canal", "etiquetado"}

MEASURES = ["precio_regular", "precio_online", "precio_tarjeta_sip", "full_price",
            "descuento_base_pct", "descuento_tarjeta_sip_pct", "cantidad_disponible",
            "unit_multiplier", "en_promocion", "precio_promo_exacto", "precio_valido",
            "disponible", "retira_hoy", "llega_manana", "envio_domicilio", "recojo_tienda"]

FACT_KEYS = ["fecha_key", "producto_key", "marca_key", "canal_key", "categoria_key",
             "etiquetado_key"]


def _label_join_cols(df: DataFrame) -> DataFrame:
    """Label flags with NULL read as false and a NULL count as 0, as the join uses them."""
    return df.withColumns({
        "_ls": F.coalesce("alto_sodio", F.lit(False)),
        "_la": F.coalesce("alto_azucar", F.lit(False)),
        "_lt": F.coalesce("alto_saturadas", F.lit(False)),
        "_ln": F.coalesce("num_octogonos", F.lit(0)),
    })


def _dim_for_join(name: str, dim: DataFrame) -> DataFrame:
    key, nk, _ = DIMENSIONS.get(name, ("etiquetado_key", None, None))
    if name == "etiquetado":
        d = dim.select("etiquetado_key", F.col("alto_sodio").alias("_ls"),
                       F.col("alto_azucar").alias("_la"), F.col("alto_saturadas").alias("_lt"),
                       F.col("num_octogonos").alias("_ln"))
    elif name == "fecha":
        d = dim.select(key, F.col("fecha").alias(DATE))
    else:
        d = dim.select(key, *nk)
    return F.broadcast(d) if name in SMALL_DIMS else d


def _join_keys(name: str) -> list[str]:
    if name == "etiquetado":
        return ["_ls", "_la", "_lt", "_ln"]
    if name == "fecha":
        return [DATE]
    return DIMENSIONS[name][1]


def fact_rows(src: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Inner star join: one fact row per source row that finds all six dimensions."""
    df = _label_join_cols(src)
    for name in ("fecha", "producto", "marca", "canal", "categoria", "etiquetado"):
        df = df.join(_dim_for_join(name, dims[name]), _join_keys(name), "inner")
    return df.select(*FACT_KEYS, *MEASURES)


def audit_rows(src: DataFrame, dims: dict[str, DataFrame],
               date_col: str = DATE) -> DataFrame:
    """Source rows that miss at least one dimension, with the list of missing ones.

    Left joins on the same keys as the fact; a row that misses several
    dimensions appears once with every reason.
    """
    df = _label_join_cols(src)
    reasons = []
    for name in ("fecha", "producto", "marca", "canal", "categoria", "etiquetado"):
        key = "etiquetado_key" if name == "etiquetado" else DIMENSIONS[name][0]
        df = df.join(_dim_for_join(name, dims[name]), _join_keys(name), "left")
        reasons.append(F.when(F.col(key).isNull(), F.lit(name)))
    motivos = F.filter(F.array(*reasons), lambda x: x.isNotNull())
    return (df.withColumn("motivos", motivos)
            .filter(F.size("motivos") > 0)
            .select("productid", "productname", "categoryid", "subcategoria", "grupo_producto",
                    "canal_venta", "brandid", date_col, "motivos"))


def star_view(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact joined back to date, product and category attributes for analysis."""
    return (fact.join(F.broadcast(dims["fecha"].select("fecha_key", "fecha")), "fecha_key")
            .join(dims["producto"].select("producto_key", "productid", "productname"),
                  "producto_key")
            .join(dims["categoria"].select("categoria_key", "categoria_principal"),
                  "categoria_key"))
