"""Queries over NEST (line items as landing-shaped catalogue records): the
snapshot build and each of its per-row operators; text functions over TXT.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import functions as SF
from shelfwise.operators.filters import bundle_predicate, exclude_promotional, keep_valid_channels
from shelfwise.plans import silver as S
from shelfwise.plans.bindings import catalogue_records, table
from shelfwise.plans.registry import query

# NEST restated in SQL from lineitem ⋈ part: the values each nested field and
# each derived column must take.
NEST_CTE = r"""
nest AS (
  SELECT
    CAST(l.l_partkey AS VARCHAR) AS productid,
    CASE WHEN l.l_linenumber % 3 = 0 THEN '-' WHEN l.l_linenumber % 3 = 1 THEN ''
         ELSE 'R' || CAST(l.l_partkey AS VARCHAR) END AS productreferencecode,
    p.p_name || ' ' || p.p_type AS productname,
    p.p_brand AS brand,
    regexp_extract(p.p_brand, '(\d+)', 1) AS brandid,
    CAST(p.p_size AS VARCHAR) AS categoryid,
    p.p_type AS p_type,
    CASE WHEN l.l_linenumber % 2 = 1
         THEN '/' || p.p_type || '/' || p.p_brand || '/' || CAST(p.p_size AS VARCHAR) || '/'
         ELSE '/' || p.p_type || '/' || p.p_brand || '/' END AS categoria_raw,
    concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS itemid,
    'Supplier#' || CAST(l.l_suppkey AS VARCHAR) AS sellername,
    (l.l_extendedprice / l.l_quantity) AS precio_regular,
    (l.l_extendedprice / l.l_quantity) * (1.0 - l.l_discount) AS precio_online,
    l.l_quantity AS unit_multiplier,
    l.l_linestatus = 'O' AS disponible,
    CAST(l.l_quantity AS INTEGER) AS cantidad_disponible,
    CASE WHEN l.l_tax > 0.04
         THEN greatest(l.l_discount * (l.l_extendedprice / l.l_quantity) * l.l_quantity, l.l_tax * (l.l_extendedprice / l.l_quantity))
    END AS mejor_descuento,
    l.l_linenumber AS ln, l.l_returnflag AS flag, l.l_linestatus AS status,
    l.l_suppkey AS suppkey,
    'sec-' || CAST(l.l_linenumber AS VARCHAR) AS seccion,
    CAST(l.l_shipdate AS DATE) AS ingesta_date,
    strftime(l.l_shipdate, '%Y-%m-%d') AS batch_id,
    CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(l.l_shipdate AS DATE) - 30 END
      AS fecha_lanzamiento
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
enriched AS (
  SELECT *,
    precio_regular * unit_multiplier AS full_price,
    CASE WHEN mejor_descuento IS NOT NULL THEN CAST(round(CAST(
      (precio_regular * unit_multiplier - mejor_descuento) / unit_multiplier AS DECIMAL(38,6)), 2)
      AS DOUBLE) END AS precio_tarjeta_sip,
    CASE WHEN precio_regular > 0 THEN
      CAST(floor((precio_regular - precio_online) / precio_regular * 100) AS BIGINT)
    END AS descuento_base_pct,
    CASE WHEN mejor_descuento IS NOT NULL THEN
      CAST(floor(mejor_descuento / (precio_regular * unit_multiplier) * 100) AS BIGINT)
    END AS descuento_tarjeta_sip_pct,
    mejor_descuento IS NOT NULL AS en_promocion,
    unit_multiplier = 1.0 AS precio_promo_exacto,
    COALESCE(precio_regular IS NOT NULL AND precio_regular > 0, false) AS precio_valido,
    string_split(categoria_raw, '/')[2] AS categoria_principal,
    string_split(categoria_raw, '/')[3] AS subcategoria,
    string_split(categoria_raw, '/')[4] AS grupo_producto,
    CASE WHEN suppkey % 3 = 2 THEN 'Vendor ' || CAST(suppkey % 10 AS VARCHAR)
         ELSE sellername END AS vendedor,
    CASE WHEN productreferencecode IN ('', '-') THEN itemid ELSE productreferencecode END AS sku,
    flag = 'R' AS retira_hoy,
    ln % 2 = 0 AS llega_manana,
    status = 'O' AS envio_domicilio,
    true AS recojo_tienda,
    CASE WHEN ln = 1 THEN NULL WHEN ln IN (3, 4, 6, 7) THEN true ELSE false END AS alto_sodio,
    CASE WHEN ln = 1 THEN NULL WHEN ln IN (4, 6, 7) THEN true ELSE false END AS alto_azucar,
    CASE WHEN ln = 1 THEN NULL WHEN ln IN (5, 6, 7) THEN true ELSE false END AS alto_saturadas,
    CAST(CASE ln WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 5 THEN 1
                 WHEN 6 THEN 3 ELSE 4 END AS INTEGER) AS num_octogonos,
    CASE WHEN flag = 'R' THEN 'SUPERMERCADO' WHEN flag = 'A' AND status = 'F' THEN 'OTRO'
         WHEN flag = 'A' THEN 'SELLERCENTER' ELSE 'SUPERMERCADO' END AS canal_venta,
    upper(p_type) AS tipo_especifico_producto
  FROM nest),
kept AS (
  SELECT * FROM enriched
  WHERE NOT (categoria_principal IN ('Packs'))
    AND NOT regexp_matches(productname, '(?i)pack|combo|promo|llévate|lleva')
    AND canal_venta IN ('SUPERMERCADO', 'SELLERCENTER')),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY productid, ingesta_date
      ORDER BY length(categoria_raw) DESC, categoria_raw, seccion, sku, itemid) AS rn
  FROM kept),
sections AS (
  SELECT productid, ingesta_date, list_sort(list(DISTINCT seccion)) AS secciones_origen
  FROM kept GROUP BY productid, ingesta_date),
silver AS (
  SELECT r.*, s.secciones_origen FROM ranked r JOIN sections s
    ON r.productid = s.productid AND r.ingesta_date = s.ingesta_date
  WHERE r.rn = 1)"""

SILVER_SELECT = ", ".join(
    "array_to_string(secciones_origen, ',') AS secciones_origen" if c == "secciones_origen" else c
    for c in S.SILVER_COLUMNS)


def nest(spark, d):
    return catalogue_records(spark, d)


def snapshot_of(spark, d):
    """The snapshot of NEST: only the line items are shuffled, by product."""
    return S.build_silver(catalogue_records(spark, d, by_product=True), method="window")


@query("silver_snapshot", sql=f"WITH {NEST_CTE}\nSELECT {SILVER_SELECT} FROM silver")
def q_silver_snapshot(spark, d):
    return snapshot_of(spark, d).withColumn(
        "secciones_origen", F.array_join("secciones_origen", ","))


@query("stage_counts", sql=f"""
WITH {NEST_CTE}
SELECT COUNT(*) AS filas_bronze,
       CAST(count_if(NOT (categoria_principal IN ('Packs'))
            AND NOT regexp_matches(productname, '(?i)pack|combo|promo|llévate|lleva')) AS BIGINT)
         AS filas_sin_packs,
       (SELECT COUNT(*) FROM kept) AS filas_canal_valido,
       (SELECT COUNT(*) FROM silver) AS filas_silver
FROM enriched
""")
def q_stage_counts(spark, d):
    return S.stage_counts(nest(spark, d))


@query("nested_first_item", sql=f"""
WITH {NEST_CTE}
SELECT productid, itemid, sellername, precio_regular AS listprice, precio_online AS price,
       disponible AS isavailable, cantidad_disponible AS availablequantity,
       unit_multiplier AS unitmultiplier
FROM nest
""")
def q_nested_first_item(spark, d):
    n = nest(spark, d)
    item = SF.first_item("items")
    seller = SF.first(item["sellers"])
    offer = SF.offer_of(seller)
    return n.select("productid", item["itemid"].alias("itemid"),
                    seller["sellername"].alias("sellername"),
                    offer["listprice"].alias("listprice"), offer["price"].alias("price"),
                    offer["isavailable"].alias("isavailable"),
                    offer["availablequantity"].alias("availablequantity"),
                    item["unitmultiplier"].alias("unitmultiplier"))


@query("best_discount", sql=f"""
WITH {NEST_CTE}
SELECT itemid, mejor_descuento FROM nest
""")
def q_best_discount(spark, d):
    offer = SF.first(SF.first_item("items")["sellers"])["commertialoffer"]
    return nest(spark, d).select(SF.first_item("items")["itemid"].alias("itemid"),
                                 SF.best_discount(offer["promotionteasers"]).alias("mejor_descuento"))


PRICE_COLS = ["itemid", "precio_regular", "precio_online", "unit_multiplier", "full_price",
              "precio_tarjeta_sip", "descuento_base_pct", "descuento_tarjeta_sip_pct",
              "en_promocion", "precio_promo_exacto", "precio_valido"]


@query("price_metrics", sql=f"WITH {NEST_CTE}\nSELECT {', '.join(PRICE_COLS)} FROM enriched")
def q_price_metrics(spark, d):
    return S.enrich(nest(spark, d)).select(*PRICE_COLS)


@query("typed_offer_casts", sql=f"""
WITH {NEST_CTE}
SELECT itemid, precio_regular, unit_multiplier, disponible, cantidad_disponible,
       fecha_lanzamiento FROM enriched
""")
def q_typed_offer_casts(spark, d):
    return S.enrich(nest(spark, d)).select("itemid", "precio_regular", "unit_multiplier",
                                           "disponible", "cantidad_disponible", "fecha_lanzamiento")


LABEL_COLS = ["itemid", "alto_sodio", "alto_azucar", "alto_saturadas", "num_octogonos"]


@query("label_features", sql=f"WITH {NEST_CTE}\nSELECT {', '.join(LABEL_COLS)} FROM enriched")
def q_label_features(spark, d):
    return S.enrich(nest(spark, d)).select(*LABEL_COLS)


DELIVERY_COLS = ["itemid", "retira_hoy", "llega_manana", "envio_domicilio", "recojo_tienda"]


@query("delivery_flags", sql=f"WITH {NEST_CTE}\nSELECT {', '.join(DELIVERY_COLS)} FROM enriched")
def q_delivery_flags(spark, d):
    return S.enrich(nest(spark, d)).select(*DELIVERY_COLS)


@query("coalesce_fallback", sql=f"WITH {NEST_CTE}\nSELECT itemid, vendedor, sku FROM enriched")
def q_coalesce_fallback(spark, d):
    return S.enrich(nest(spark, d)).select("itemid", "vendedor", "sku")


@query("category_levels", sql=f"""
WITH {NEST_CTE}
SELECT itemid, categoria_principal, subcategoria, grupo_producto FROM enriched
""")
def q_category_levels(spark, d):
    return S.enrich(nest(spark, d)).select("itemid", "categoria_principal", "subcategoria",
                                           "grupo_producto")


@query("exclude_promotional", sql=f"""
WITH {NEST_CTE}
SELECT itemid, productname, categoria_principal FROM enriched
WHERE NOT (categoria_principal IN ('Packs'))
  AND NOT regexp_matches(productname, '(?i)pack|combo|promo|llévate|lleva')
""")
def q_exclude_promotional(spark, d):
    return exclude_promotional(S.enrich(nest(spark, d))).select("itemid", "productname",
                                                                "categoria_principal")


@query("promotional_count", sql=f"""
WITH {NEST_CTE}
SELECT COUNT(*) AS antes,
       CAST(count_if(categoria_principal = 'Packs'
            OR regexp_matches(productname, '(?i)pack|combo|promo|llévate|lleva')) AS BIGINT)
         AS promocionales,
       CAST(count_if(NOT (categoria_principal IN ('Packs'))
            AND NOT regexp_matches(productname, '(?i)pack|combo|promo|llévate|lleva')) AS BIGINT)
         AS despues
FROM enriched
""")
def q_promotional_count(spark, d):
    e = S.enrich(nest(spark, d))
    bundle = bundle_predicate()
    return e.agg(F.count(F.lit(1)).alias("antes"),
                 F.count_if(bundle).alias("promocionales"),
                 F.count_if(~bundle).alias("despues"))


@query("valid_channel", sql=f"""
WITH {NEST_CTE}
SELECT itemid, canal_venta, tipo_especifico_producto, productname, brand FROM enriched
WHERE canal_venta IN ('SUPERMERCADO', 'SELLERCENTER')
""")
def q_valid_channel(spark, d):
    return (keep_valid_channels(S.normalize_text(S.enrich(nest(spark, d))))
            .select("itemid", "canal_venta", "tipo_especifico_producto", "productname", "brand"))


# --- TXT ------------------------------------------------------------------------------

@query("split_levels", sql="""
SELECT page_id, nullif(split_part(url, '/', 2), '') AS nivel_1,
       nullif(split_part(url, '/', 3), '') AS nivel_2,
       nullif(split_part(url, '/', 4), '') AS nivel_3
FROM pages
""")
def q_split_levels(spark, d):
    lv = SF.category_levels("url")
    return table(spark, d, "pages").select(
        "page_id", *[F.nullif(c, F.lit("")).alias(f"nivel_{i + 1}") for i, c in enumerate(lv)])


@query("text_normalize", sql="""
SELECT p_partkey, upper(trim(p_name)) AS nombre, trim(p_brand) AS marca,
       upper(trim(' ' || p_type || ' ')) AS tipo
FROM part
""")
def q_text_normalize(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", SF.clean_upper("p_name").alias("nombre"),
                    F.trim("p_brand").alias("marca"),
                    SF.clean_upper(F.concat(F.lit(" "), "p_type", F.lit(" "))).alias("tipo"))


@query("slugify_text", sql=r"""
SELECT doc_id,
       regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(
         strip_accents(text), '[^\x00-\x7F]', '', 'g'), '[^a-zA-Z0-9]', '_', 'g'), '_+', '_', 'g')),
         '^_+|_+$', '', 'g') AS slug
FROM documents
""")
def q_slugify_text(spark, d):
    return table(spark, d, "documents").select("doc_id", SF.slugify("text").alias("slug"))
