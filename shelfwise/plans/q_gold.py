"""Queries over the gold star built from the NEST snapshot.

Dimension queries return natural columns only (surrogate key values are not
comparable across engines); keyed queries join the fact back to its
dimensions and expose natural keys.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators.dedup import duplicate_keys
from shelfwise.operators.keys import assign_surrogate_keys
from shelfwise.plans import analytics as A
from shelfwise.plans import gold as G
from shelfwise.plans import star as ST
from shelfwise.plans.bindings import product_partitions, table
from shelfwise.plans.oracle_sql import money, pct
from shelfwise.plans.q_silver import NEST_CTE
from shelfwise.plans.q_silver import snapshot_of as _silver
from shelfwise.plans.quality import attribute_consistency
from shelfwise.plans.registry import query
from shelfwise.session import materialize


def _silver_materialised(spark, d):
    """The snapshot, written once to the shared checkpoint folder (as the silver
    table would be), so the dimension loads and the fact read it instead of
    rebuilding it."""
    return materialize(_silver(spark, d), "silver")


def _loaded(spark, d):
    """A star loaded for this query alone, without its fact.  It has a bucket for each
    partition of the snapshot, which is then written where it lies."""
    return ST.write_star(spark, _silver(spark, d), product_partitions(spark, d), fact=False)


def _star(spark, d):
    """A star loaded for this query alone, so that what a query costs does not depend on
    which others ran before it (``star.star_of`` shares one)."""
    return ST.write_star(spark, _silver(spark, d), product_partitions(spark, d))


FIRST_BY_DATE = """
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {k} ORDER BY ingesta_date, {o}) AS _r
                 FROM silver WHERE {nn}) WHERE _r = 1"""


@query("calendar_dimension", sql=f"""
WITH {NEST_CTE}
SELECT DISTINCT ingesta_date AS fecha,
       CAST(dayofmonth(ingesta_date) AS INTEGER) AS dia,
       CAST(month(ingesta_date) AS INTEGER) AS mes,
       monthname(ingesta_date) AS nombre_mes,
       CAST(quarter(ingesta_date) AS INTEGER) AS trimestre,
       CAST(year(ingesta_date) AS INTEGER) AS anio,
       dayname(ingesta_date) AS dia_semana,
       dayofweek(ingesta_date) IN (0, 6) AS es_fin_de_semana
FROM silver
""")
def q_calendar_dimension(spark, d):
    return G.calendar_rows(_silver(spark, d))


@query("dim_brand", sql=f"""
WITH {NEST_CTE}
SELECT brandid, brand FROM ({FIRST_BY_DATE.format(k='brandid', o='brand', nn='brandid IS NOT NULL')})
""")
def q_dim_brand(spark, d):
    return G.brand_rows(_silver(spark, d))


@query("dim_channel", sql=f"""
WITH {NEST_CTE}
SELECT DISTINCT canal_venta FROM silver WHERE canal_venta IS NOT NULL
""")
def q_dim_channel(spark, d):
    return G.channel_rows(_silver(spark, d))


@query("dim_category", sql=f"""
WITH {NEST_CTE}
SELECT categoryid, subcategoria, grupo_producto, categoria_principal
FROM ({FIRST_BY_DATE.format(k='categoryid, subcategoria, grupo_producto', o='categoria_principal',
                            nn='categoryid IS NOT NULL AND subcategoria IS NOT NULL '
                               'AND grupo_producto IS NOT NULL')})
""")
def q_dim_category(spark, d):
    return G.category_rows(_silver(spark, d))


@query("dim_product", sql=f"""
WITH {NEST_CTE}
SELECT productid, sku, productname, tipo_especifico_producto, fecha_lanzamiento, vendedor
FROM ({FIRST_BY_DATE.format(k='productid', o='sku', nn='productid IS NOT NULL')})
""")
def q_dim_product(spark, d):
    return G.product_rows(_silver(spark, d))


JUNK_SQL = """
junk AS (
  SELECT v1.s AS alto_sodio, v2.a AS alto_azucar, v3.t AS alto_saturadas,
         CAST(v4.n AS INTEGER) AS num_octogonos
  FROM (VALUES (true), (false)) v1(s), (VALUES (true), (false)) v2(a),
       (VALUES (true), (false)) v3(t), (VALUES (0), (1), (2), (3)) v4(n))"""


@query("dim_label_junk", sql=f"""
WITH {NEST_CTE}, {JUNK_SQL},
cnt AS (
  SELECT coalesce(alto_sodio, false) AS s, coalesce(alto_azucar, false) AS a,
         coalesce(alto_saturadas, false) AS t, coalesce(num_octogonos, 0) AS n, COUNT(*) AS c
  FROM silver GROUP BY ALL)
SELECT j.alto_sodio, j.alto_azucar, j.alto_saturadas, j.num_octogonos,
       CAST(coalesce(c.c, 0) AS BIGINT) AS filas
FROM junk j LEFT JOIN cnt c
  ON j.alto_sodio = c.s AND j.alto_azucar = c.a AND j.alto_saturadas = c.t
 AND j.num_octogonos = c.n
""")
def q_dim_label_junk(spark, d):
    src = G._label_join_cols(_silver(spark, d))
    cnt = src.groupBy("_ls", "_la", "_lt", "_ln").agg(F.count(F.lit(1)).alias("filas"))
    junk = G.label_junk(spark)
    j = junk.join(F.broadcast(cnt),
                  (junk.alto_sodio == cnt._ls) & (junk.alto_azucar == cnt._la)
                  & (junk.alto_saturadas == cnt._lt) & (junk.num_octogonos == cnt._ln), "left")
    return j.select(*G.LABEL_COLS, F.coalesce("filas", F.lit(0)).alias("filas"))


@query("assign_surrogate_keys", sql="""
SELECT ROW_NUMBER() OVER (ORDER BY p_name, p_brand) AS nombre_marca_key, p_name, p_brand
FROM (SELECT DISTINCT p_name, p_brand FROM part)
""")
def q_assign_surrogate_keys(spark, d):
    rows = table(spark, d, "part").select("p_name", "p_brand").distinct()
    return assign_surrogate_keys(rows, ["p_name", "p_brand"], "nombre_marca_key", ordered=True)


FACT_NATURAL = ["fecha", "productid", "brandid", "canal_venta", "categoryid", "subcategoria",
                "grupo_producto", *G.LABEL_COLS, *G.MEASURES]

FACT_SQL = f"""
WITH {NEST_CTE}
SELECT ingesta_date AS fecha, productid, brandid, canal_venta, categoryid, subcategoria,
       grupo_producto, coalesce(alto_sodio, false) AS alto_sodio,
       coalesce(alto_azucar, false) AS alto_azucar,
       coalesce(alto_saturadas, false) AS alto_saturadas,
       coalesce(num_octogonos, 0) AS num_octogonos, {', '.join(G.MEASURES)}
FROM silver WHERE coalesce(num_octogonos, 0) BETWEEN 0 AND 3
"""


def _natural_fact(fact, dims):
    """Fact rows with surrogate keys replaced by the natural keys they stand for."""
    return (fact
            .join(F.broadcast(dims["fecha"].select("fecha_key", "fecha")), "fecha_key")
            .join(dims["producto"].select("producto_key", "productid"), "producto_key")
            .join(dims["marca"].select("marca_key", "brandid"), "marca_key")
            .join(F.broadcast(dims["canal"].select("canal_key", "canal_venta")), "canal_key")
            .join(dims["categoria"].select("categoria_key", "categoryid", "subcategoria",
                                           "grupo_producto"), "categoria_key")
            .join(F.broadcast(dims["etiquetado"]), "etiquetado_key")
            .select(*FACT_NATURAL))


@query("fact_load", sql=FACT_SQL)
def q_fact_load(spark, d):
    star = _loaded(spark, d)
    dims = star.dims()
    return _natural_fact(G.fact_rows(star.silver, dims), dims)


@query("join_composite_key", sql=f"""
WITH {NEST_CTE},
dim AS (SELECT categoryid, subcategoria, grupo_producto, categoria_principal AS categoria_dim
        FROM ({FIRST_BY_DATE.format(k='categoryid, subcategoria, grupo_producto',
                                    o='categoria_principal',
                                    nn='categoryid IS NOT NULL AND subcategoria IS NOT NULL '
                                       'AND grupo_producto IS NOT NULL')}))
SELECT s.productid, s.ingesta_date, s.categoryid, s.subcategoria, s.grupo_producto,
       s.categoria_principal, d.categoria_dim
FROM silver s JOIN dim d ON s.categoryid = d.categoryid AND s.subcategoria = d.subcategoria
  AND s.grupo_producto = d.grupo_producto
""")
def q_join_composite_key(spark, d):
    src = _silver_materialised(spark, d)
    dim = G.category_rows(src).withColumnRenamed("categoria_principal", "categoria_dim")
    return (src.join(dim, ["categoryid", "subcategoria", "grupo_producto"])
            .select("productid", "ingesta_date", "categoryid", "subcategoria", "grupo_producto",
                    "categoria_principal", "categoria_dim"))


@query("join_coalesced_key", sql=f"""
WITH {NEST_CTE}
SELECT productid, ingesta_date,
       CAST(1 + CASE WHEN coalesce(alto_sodio, false) THEN 0 ELSE 16 END
              + CASE WHEN coalesce(alto_azucar, false) THEN 0 ELSE 8 END
              + CASE WHEN coalesce(alto_saturadas, false) THEN 0 ELSE 4 END
              + coalesce(num_octogonos, 0) AS BIGINT) AS etiquetado_key,
       coalesce(num_octogonos, 0) AS num_octogonos
FROM silver WHERE coalesce(num_octogonos, 0) BETWEEN 0 AND 3
""")
def q_join_coalesced_key(spark, d):
    src = G._label_join_cols(_silver(spark, d))
    junk = G._dim_for_join("etiquetado", G.label_junk(spark))
    return (src.join(junk, ["_ls", "_la", "_lt", "_ln"])
            .select("productid", "ingesta_date", "etiquetado_key",
                    F.col("_ln").alias("num_octogonos")))


# The audit is run against dimensions that lack some members, so that every
# reason comes up: days after the 25th, products and brands by their last digit,
# one channel, categories by size.
AUDIT_REASONS = """
  list_filter([
    CASE WHEN dayofmonth(ingesta_date) > 25 THEN 'fecha' END,
    CASE WHEN right(productid, 1) = '7' THEN 'producto' END,
    CASE WHEN brandid IS NULL OR right(brandid, 1) = '5' THEN 'marca' END,
    CASE WHEN canal_venta IS NULL OR canal_venta = 'SELLERCENTER' THEN 'canal' END,
    CASE WHEN categoryid IS NULL OR subcategoria IS NULL OR grupo_producto IS NULL
              OR right(categoryid, 1) = '3' THEN 'categoria' END,
    CASE WHEN NOT (coalesce(num_octogonos, 0) BETWEEN 0 AND 3) THEN 'etiquetado' END],
    lambda x: x IS NOT NULL)"""


def _partial_star(spark, d):
    star = _loaded(spark, d)
    src, dims = star.silver, star.dims()
    dims["fecha"] = dims["fecha"].filter(F.dayofmonth("fecha") <= 25)
    dims["producto"] = dims["producto"].filter(~F.col("productid").endswith("7"))
    dims["marca"] = dims["marca"].filter(~F.col("brandid").endswith("5"))
    dims["canal"] = dims["canal"].filter(F.col("canal_venta") != "SELLERCENTER")
    dims["categoria"] = dims["categoria"].filter(~F.col("categoryid").endswith("3"))
    return src, dims


@query("referential_audit", sql=f"""
WITH {NEST_CTE},
r AS (SELECT *, {AUDIT_REASONS} AS reasons FROM silver)
SELECT productid, productname, categoryid, subcategoria, grupo_producto, canal_venta, brandid,
       ingesta_date, array_to_string(reasons, ',') AS motivos
FROM r WHERE len(reasons) > 0
""")
def q_referential_audit(spark, d):
    src, dims = _partial_star(spark, d)
    return G.audit_rows(src, dims).withColumn("motivos", F.array_join("motivos", ","))


@query("load_reconciliation", sql=f"""
WITH {NEST_CTE},
c AS (SELECT count(*) AS filas_silver,
             count(*) FILTER (WHERE len({AUDIT_REASONS}) = 0) AS filas_fact,
             count(*) FILTER (WHERE len({AUDIT_REASONS}) > 0) AS filas_perdidas
      FROM silver)
SELECT *, filas_silver = filas_fact + filas_perdidas AS cuadra FROM c
""")
def q_load_reconciliation(spark, d):
    src, dims = _partial_star(spark, d)
    # One aggregate over a tagged union: no joins between one-row frames.
    tagged = (src.select(F.lit("s").alias("_t"))
              .unionByName(G.fact_rows(src, dims).select(F.lit("f").alias("_t")))
              .unionByName(G.audit_rows(src, dims).select(F.lit("a").alias("_t"))))
    r = tagged.agg(F.count_if(F.col("_t") == "s").alias("filas_silver"),
                   F.count_if(F.col("_t") == "f").alias("filas_fact"),
                   F.count_if(F.col("_t") == "a").alias("filas_perdidas"))
    return r.withColumn("cuadra", F.col("filas_silver") == F.col("filas_fact") + F.col("filas_perdidas"))


@query("fact_rows_of_batch", sql=f"""
WITH {NEST_CTE}
SELECT ingesta_date AS fecha, COUNT(*) AS filas
FROM silver WHERE coalesce(num_octogonos, 0) BETWEEN 0 AND 3 GROUP BY ingesta_date
""")
def q_fact_rows_of_batch(spark, d):
    star = _star(spark, d)
    fact, dims = star.fact, star.dims()
    return (fact.join(F.broadcast(dims["fecha"].select("fecha_key", "fecha")), "fecha_key")
            .groupBy("fecha").agg(F.count(F.lit(1)).alias("filas")))


# --- the standing questions over the star (fact joined to its dimensions) -------------------


STAR_BASE_SQL = f"""
WITH {NEST_CTE},
cat AS (SELECT categoryid, subcategoria, grupo_producto, categoria_principal AS categoria_dim
        FROM ({FIRST_BY_DATE.format(k='categoryid, subcategoria, grupo_producto',
                                    o='categoria_principal',
                                    nn='categoryid IS NOT NULL AND subcategoria IS NOT NULL '
                                       'AND grupo_producto IS NOT NULL')})),
prod AS (SELECT productid, productname AS productname_dim
         FROM ({FIRST_BY_DATE.format(k='productid', o='sku', nn='productid IS NOT NULL')})),
star AS (
  SELECT s.ingesta_date AS fecha, s.productid, p.productname_dim AS productname,
         c.categoria_dim AS categoria_principal, s.precio_regular, s.precio_valido,
         s.en_promocion, s.disponible, s.descuento_tarjeta_sip_pct
  FROM silver s
  JOIN cat c ON s.categoryid = c.categoryid AND s.subcategoria = c.subcategoria
            AND s.grupo_producto = c.grupo_producto
  JOIN prod p ON s.productid = p.productid
  WHERE coalesce(s.num_octogonos, 0) BETWEEN 0 AND 3),
latest AS (SELECT * FROM star WHERE fecha = (SELECT max(ingesta_date) FROM silver))"""


def _star_flat(spark, d):
    star = _star(spark, d)
    return G.star_view(star.fact, star.dims(by_key=True))


def _star_latest(spark, d):
    """Star rows and the latest-batch selector taken from the calendar
    dimension (every loaded batch has a date row, even one whose rows were
    all lost to the audit)."""
    star = _star(spark, d)
    latest = star.dims()["fecha"].agg(F.max("fecha").alias("fecha"))
    return G.star_view(star.fact, star.dims(by_key=True)), latest


@query("star_latest_batch_kpis", sql=STAR_BASE_SQL + f"""
SELECT COUNT(*) AS total_productos,
       CAST(SUM(CASE WHEN disponible THEN 1 ELSE 0 END) AS BIGINT) AS disponibles,
       CAST(SUM(CASE WHEN NOT disponible THEN 1 ELSE 0 END) AS BIGINT) AS sin_stock,
       CAST(SUM(CASE WHEN en_promocion THEN 1 ELSE 0 END) AS BIGINT) AS con_sip,
       {money('avg(CASE WHEN precio_valido THEN precio_regular END)')} AS precio_promedio,
       round(avg(CASE WHEN en_promocion THEN descuento_tarjeta_sip_pct END), 1)
         AS descuento_sip_promedio
FROM latest
""")
def q_star_latest_batch_kpis(spark, d):
    star, latest = _star_latest(spark, d)
    return A.latest_batch_kpis(star, date_col="fecha", latest=latest)


@query("star_promo_share_by_category", sql=STAR_BASE_SQL + f"""
SELECT categoria_principal, count(*) AS total_productos, count(*) FILTER (en_promocion) AS con_sip,
       {pct('count(*) FILTER (en_promocion)', 'count(*)')} AS pct_con_sip,
       round(avg(descuento_tarjeta_sip_pct) FILTER (en_promocion), 1) AS descuento_sip_promedio
FROM latest GROUP BY categoria_principal HAVING categoria_principal IS NOT NULL
""")
def q_star_promo_share(spark, d):
    star, latest = _star_latest(spark, d)
    return A.promo_share_by_category(star, date_col="fecha", latest=latest)


@query("star_stockout_by_category", sql=STAR_BASE_SQL + f"""
SELECT categoria_principal, count(*) AS total, count(*) FILTER (disponible) AS disponibles,
       count(*) FILTER (NOT disponible) AS sin_stock,
       {pct('count(*) FILTER (NOT disponible)', 'count(*)')} AS pct_sin_stock
FROM latest GROUP BY categoria_principal HAVING categoria_principal IS NOT NULL
""")
def q_star_stockout(spark, d):
    star, latest = _star_latest(spark, d)
    return A.stockout_by_category(star, date_col="fecha", latest=latest)


@query("star_top_category_trend", sql=STAR_BASE_SQL + f""",
base AS (SELECT fecha, categoria_principal, precio_regular FROM star
         WHERE precio_valido AND categoria_principal IS NOT NULL),
top AS (SELECT categoria_principal FROM base GROUP BY categoria_principal
        ORDER BY avg(precio_regular) DESC, categoria_principal LIMIT 5)
SELECT fecha, categoria_principal, {money('avg(precio_regular)')} AS precio_promedio
FROM base WHERE categoria_principal IN (SELECT categoria_principal FROM top)
GROUP BY fecha, categoria_principal
""")
def q_star_top_category_trend(spark, d):
    return A.top_category_trend(_star_flat(spark, d), k=5, date_col="fecha")


@query("star_price_movers", sql=STAR_BASE_SQL + """,
lagged AS (
  SELECT productid, productname, categoria_principal, fecha, precio_regular AS precio_actual,
         lag(precio_regular) OVER (PARTITION BY productid ORDER BY fecha) AS precio_anterior
  FROM star WHERE precio_valido)
SELECT productid, productname, categoria_principal, fecha, precio_anterior, precio_actual,
       round(precio_actual - precio_anterior, 2) AS variacion,
       round((precio_actual - precio_anterior) / precio_anterior * 100, 1) AS variacion_pct
FROM lagged WHERE precio_anterior IS NOT NULL AND precio_actual <> precio_anterior
ORDER BY abs(variacion_pct) DESC, productid, fecha LIMIT 15
""")
def q_star_price_movers(spark, d):
    return A.price_movers(_star_flat(spark, d), k=15, date_col="fecha")


@query("fact_duplicate_products", sql=f"""
WITH {NEST_CTE}
SELECT productid, COUNT(*) AS veces FROM silver
WHERE coalesce(num_octogonos, 0) BETWEEN 0 AND 3
GROUP BY productid HAVING COUNT(*) > 1
ORDER BY veces DESC, productid LIMIT 10
""")
def q_fact_duplicate_products(spark, d):
    """Products with more than one fact row (fact ⋈ product), most repeated first."""
    star = _star(spark, d)
    fact = star.fact.join(star.dims(by_key=True)["producto"].select("producto_key", "productid"),
                          "producto_key")
    return duplicate_keys(fact, ["productid"], top=10)


@query("category_consistency_silver", sql=f"""
WITH {NEST_CTE}
SELECT categoryid, COUNT(DISTINCT categoria_principal) AS variaciones FROM silver
GROUP BY categoryid HAVING COUNT(DISTINCT categoria_principal) > 1
""")
def q_category_consistency_silver(spark, d):
    """Category ids that map to more than one top-level category in the snapshot."""
    return attribute_consistency(_silver(spark, d), "categoryid", "categoria_principal")
