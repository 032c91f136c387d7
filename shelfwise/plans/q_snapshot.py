"""Queries over OBS / SNAP (events bound as catalogue observations).

Analytics (latest-batch KPIs, trends, moves, shares, churn), the dedup itself,
and the plain scan / projection / cast / JSON operators.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.plans import analytics as A
from shelfwise.plans.bindings import latest_snapshot, observations, snapshot, table
from shelfwise.plans.oracle_sql import OBS_CTE, SNAP_COLS, SNAP_CTE, money, pct
from shelfwise.plans.registry import query
from shelfwise.sources.tables import scan_batch, tag_batch

TREND_K = 3  # only five event types exist in the test data


def _joined_sections(df):
    return df.withColumn("secciones_origen", F.array_join("secciones_origen", ","))


# --- dedup -----------------------------------------------------------------------

@query("dedup_best_row", sql=f"""
WITH {SNAP_CTE}
SELECT {SNAP_COLS}, array_to_string(secciones_origen, ',') AS secciones_origen FROM snap
""")
def q_dedup_best_row(spark, d):
    return _joined_sections(snapshot(spark, d))


# --- latest batch ---------------------------------------------------------------------

@query("latest_batch_rows", sql=f"""
WITH {SNAP_CTE},
u AS (SELECT max(ingesta_date) AS ingesta_date FROM snap)
SELECT {SNAP_COLS}, array_to_string(secciones_origen, ',') AS secciones_origen
FROM snap WHERE ingesta_date = (SELECT ingesta_date FROM u)
""")
def q_latest_batch_rows(spark, d):
    return _joined_sections(A.latest_batch_rows(latest_snapshot(spark, d)))


@query("previous_batch", sql=f"""
WITH {SNAP_CTE},
p AS (SELECT max(ingesta_date) AS d FROM snap
      WHERE ingesta_date < (SELECT max(ingesta_date) FROM snap))
SELECT {SNAP_COLS}, array_to_string(secciones_origen, ',') AS secciones_origen
FROM snap WHERE ingesta_date = (SELECT d FROM p)
""")
def q_previous_batch(spark, d):
    return _joined_sections(A.previous_batch_rows(latest_snapshot(spark, d, 2)))


@query("latest_batch_kpis", sql=f"""
WITH {SNAP_CTE}
SELECT count(*) AS total_productos,
       count(*) FILTER (WHERE disponible) AS disponibles,
       count(*) FILTER (WHERE NOT disponible) AS sin_stock,
       count(*) FILTER (WHERE en_promocion) AS con_sip,
       {money('avg(precio_regular) FILTER (WHERE precio_valido)')} AS precio_promedio,
       round(avg(descuento_tarjeta_sip_pct) FILTER (WHERE en_promocion), 1) AS descuento_sip_promedio
FROM snap WHERE ingesta_date IN (SELECT max(CAST(ts AS DATE)) FROM events)
""")
def q_latest_batch_kpis(spark, d):
    return A.latest_batch_kpis(latest_snapshot(spark, d))


# --- trends and moves -------------------------------------------------------------------

@query("top_category_trend", sql=f"""
WITH {SNAP_CTE},
base AS (SELECT ingesta_date, categoria_principal, precio_regular FROM snap
         WHERE precio_valido AND categoria_principal IS NOT NULL),
top AS (SELECT categoria_principal FROM base GROUP BY categoria_principal
        ORDER BY avg(precio_regular) DESC, categoria_principal LIMIT {TREND_K})
SELECT b.ingesta_date, b.categoria_principal, {money('avg(b.precio_regular)')} AS precio_promedio
FROM base b WHERE b.categoria_principal IN (SELECT categoria_principal FROM top)
GROUP BY b.ingesta_date, b.categoria_principal
""")
def q_top_category_trend(spark, d):
    return A.top_category_trend(snapshot(spark, d), k=TREND_K)


@query("price_movers", sql=f"""
WITH {SNAP_CTE},
priced AS (SELECT * FROM snap WHERE precio_valido)
SELECT now.productid, now.productname, now.categoria_principal, now.ingesta_date AS fecha,
       old.precio_regular AS precio_anterior, now.precio_regular AS precio_actual,
       round(now.precio_regular - old.precio_regular, 2) AS variacion,
       round(100 * (now.precio_regular - old.precio_regular) / old.precio_regular, 1) AS variacion_pct
FROM priced now ASOF JOIN priced old
  ON now.productid = old.productid AND now.ingesta_date > old.ingesta_date
WHERE now.precio_regular IS DISTINCT FROM old.precio_regular
ORDER BY abs(variacion_pct) DESC, now.productid, fecha LIMIT 15
""")
def q_price_movers(spark, d):
    return A.price_movers(snapshot(spark, d), k=15)


# The newest day's rows with a category.
NEWEST_SQL = "(SELECT * FROM snap QUALIFY dense_rank() OVER (ORDER BY ingesta_date DESC NULLS LAST) = 1)"


@query("promo_share_by_category", sql=f"""
WITH {SNAP_CTE}
SELECT categoria_principal, count(*) AS total_productos, count(*) FILTER (en_promocion) AS con_sip,
       {pct('count(*) FILTER (en_promocion)', 'count(*)')} AS pct_con_sip,
       round(avg(descuento_tarjeta_sip_pct) FILTER (en_promocion), 1) AS descuento_sip_promedio
FROM {NEWEST_SQL} GROUP BY categoria_principal HAVING categoria_principal IS NOT NULL
""")
def q_promo_share(spark, d):
    return A.promo_share_by_category(latest_snapshot(spark, d))


@query("stockout_by_category", sql=f"""
WITH {SNAP_CTE}
SELECT categoria_principal, count(*) AS total, count(*) FILTER (disponible) AS disponibles,
       count(*) FILTER (NOT disponible) AS sin_stock,
       {pct('count(*) FILTER (NOT disponible)', 'count(*)')} AS pct_sin_stock
FROM {NEWEST_SQL} GROUP BY categoria_principal HAVING categoria_principal IS NOT NULL
""")
def q_stockout(spark, d):
    return A.stockout_by_category(latest_snapshot(spark, d))


@query("catalog_churn", sql=f"""
WITH {SNAP_CTE},
days AS (SELECT ingesta_date AS d, dense_rank() OVER (ORDER BY ingesta_date DESC) AS back
         FROM (SELECT DISTINCT ingesta_date FROM snap)),
seen AS (SELECT productid, any_value(categoria_principal) AS categoria,
                list_sort(list(back)) AS back
         FROM snap JOIN days ON ingesta_date = d WHERE back <= 2 GROUP BY productid)
SELECT CASE WHEN back = [1] THEN 'Nuevo' ELSE 'Descontinuado' END AS tipo, count(*) AS total,
       count(DISTINCT categoria) AS categorias_afectadas
FROM seen WHERE len(back) = 1 GROUP BY tipo
""")
def q_catalog_churn(spark, d):
    return A.catalog_churn(latest_snapshot(spark, d, 2))


# --- scans, projections, casts ----------------------------------------------------------

SCAN_DAY = "2024-01-15"


@query("scan_batch", sql=f"""
WITH {OBS_CTE}
SELECT {SNAP_COLS} FROM obs WHERE batch_id = '{SCAN_DAY}'
""")
def q_scan_batch(spark, d):
    return scan_batch(observations(spark, d, day_from=SCAN_DAY, day_to=SCAN_DAY), "batch_id", SCAN_DAY)


@query("tag_batch", sql="""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS batch_id, CAST(ts AS DATE) AS ingesta_date,
       'events' AS fuente
FROM events
""")
def q_tag_batch(spark, d):
    ev = table(spark, d, "events").select("event_id", "ts")
    return (tag_batch(ev, F.date_format("ts", "yyyy-MM-dd"))
            .withColumn("fuente", F.lit("events")).drop("ts"))


@query("project_columns", sql=f"""
WITH {OBS_CTE}
SELECT productid, ingesta_date, categoria_principal, precio_regular FROM obs
""")
def q_project_columns(spark, d):
    return observations(spark, d).select("productid", "ingesta_date", "categoria_principal",
                                         "precio_regular")


@query("preview_topn", sql=f"""
WITH {OBS_CTE}
SELECT productid, ingesta_date, precio_regular, event_id FROM obs
WHERE categoria_principal = 'purchase'
ORDER BY precio_regular DESC, event_id LIMIT 10
""")
def q_preview_topn(spark, d):
    return (observations(spark, d).filter(F.col("categoria_principal") == "purchase")
            .select("productid", "ingesta_date", "precio_regular", "event_id")
            .orderBy(F.col("precio_regular").desc(), F.col("event_id")).limit(10))


@query("typed_casts", sql="""
SELECT event_id,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_double,
       TRY_CAST(event_type AS DOUBLE) AS tipo_double,
       TRY_CAST(CAST(user_id AS VARCHAR) AS BIGINT) AS user_bigint,
       TRY_CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS dia,
       TRY_CAST(CASE WHEN value > 50 THEN 'true' ELSE 'false' END AS BOOLEAN) AS caro
FROM events
""")
def q_typed_casts(spark, d):
    ev = table(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    return ev.select(
        "event_id",
        k.try_cast("int").alias("k_int"),
        k.try_cast("double").alias("k_double"),
        F.col("event_type").try_cast("double").alias("tipo_double"),
        F.col("user_id").cast("string").try_cast("bigint").alias("user_bigint"),
        F.try_to_date(F.date_format("ts", "yyyy-MM-dd")).alias("dia"),
        F.when(F.col("value") > 50, "true").otherwise("false").try_cast("boolean").alias("caro"))


@query("json_props", sql="""
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events
""")
def q_json_props(spark, d):
    ev = table(spark, d, "events")
    parsed = F.from_json("props", "k INT")
    return ev.select("event_id", F.get_json_object("props", "$.k").alias("k_text"),
                     parsed["k"].alias("k"))


@query("bronze_union_by_name", sql="""
SELECT event_id, user_id, event_type, value, NULL::VARCHAR AS props
FROM events WHERE ts < TIMESTAMP '2024-01-16'
UNION ALL BY NAME
SELECT event_id, user_id, event_type, value, props
FROM events WHERE ts >= TIMESTAMP '2024-01-16'
""")
def q_bronze_union_by_name(spark, d):
    ev = table(spark, d, "events")
    cut = F.to_timestamp_ntz(F.lit("2024-01-16"))
    early = ev.filter(F.col("ts") < cut).select("event_id", "user_id", "event_type", "value")
    late = ev.filter(F.col("ts") >= cut).select("props", "value", "event_type", "user_id", "event_id")
    return early.unionByName(late, allowMissingColumns=True)
