"""Queries: quality reports, batch control and the MERGE/UPDATE family."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.operators.dedup import duplicate_keys
from shelfwise.operators.filters import batch_exists, gate_counts
from shelfwise.operators.merge import (merge_insert_only, merge_update_only, merge_upsert,
                                       update_where)
from shelfwise.plans import control as C
from shelfwise.plans import quality as Q
from shelfwise.plans import silver as S
from shelfwise.plans.bindings import catalogue_records, observations, table
from shelfwise.plans.oracle_sql import OBS_CTE, money
from shelfwise.plans.q_silver import NEST_CTE, snapshot_of
from shelfwise.plans.registry import query


# --- gates and reports -------------------------------------------------------------------

@query("null_key_gate", sql=f"""
WITH {OBS_CTE}
SELECT COUNT(*) AS total_rows,
       CAST(count_if(productid % 10 = 0 OR productid IS NULL OR ingesta_date IS NULL) AS BIGINT)
         AS null_key_rows,
       CAST(count_if(ingesta_date IS NULL) AS BIGINT) AS null_date_rows
FROM obs
""")
def q_null_key_gate(spark, d):
    """Every tenth product's key made NULL, so that the gate has something to count."""
    o = observations(spark, d)
    key = F.when(F.col("productid") % 10 != 0, F.col("productid"))
    return gate_counts(o.withColumn("productid", key), ["productid", "ingesta_date"], "ingesta_date")


@query("duplicate_keys", sql=f"""
WITH {OBS_CTE}
SELECT productid, ingesta_date, COUNT(*) AS veces FROM obs
GROUP BY productid, ingesta_date HAVING COUNT(*) > 1
ORDER BY veces DESC, productid, ingesta_date LIMIT 10
""")
def q_duplicate_keys(spark, d):
    return duplicate_keys(observations(spark, d), ["productid", "ingesta_date"], top=10)


@query("category_consistency", sql="""
SELECT p_name, COUNT(DISTINCT p_brand) AS variaciones FROM part
GROUP BY p_name HAVING COUNT(DISTINCT p_brand) > 1
""")
def q_category_consistency(spark, d):
    return Q.attribute_consistency(table(spark, d, "part"), "p_name", "p_brand")


@query("label_count_distribution", sql=f"""
WITH {NEST_CTE}
SELECT num_octogonos, COUNT(*) AS cantidad FROM silver GROUP BY num_octogonos
""")
def q_label_count_distribution(spark, d):
    return Q.label_count_distribution(snapshot_of(spark, d))


@query("stock_state_case", sql=f"""
WITH {NEST_CTE},
labelled AS (
  SELECT unnest([{{'estado': 'Precio invalido', 'si': NOT coalesce(precio_regular > 0, false)}},
                 {{'estado': 'Producto no disponible', 'si': precio_regular > 0 AND NOT disponible}},
                 {{'estado': 'Producto disponible', 'si': precio_regular > 0 AND disponible}},
                 {{'estado': NULL, 'si': precio_regular > 0 AND disponible IS NULL}}]) AS x
  FROM silver)
SELECT x.estado AS estado, count(*) AS cantidad FROM labelled WHERE x.si GROUP BY 1
""")
def q_stock_state_case(spark, d):
    return Q.stock_state(snapshot_of(spark, d))


@query("array_size_violation", sql=f"""
WITH {NEST_CTE}
SELECT productid, productname,
       CASE WHEN ln = 4 THEN 'altoenazucar,altoenazucar,altoensodio,altoensodio'
            ELSE 'altoensodio,altoenazucar,altoengrasassaturadas,otro' END AS tipodeoctogono,
       4 AS num
FROM nest WHERE ln IN (4, 7)
""")
def q_array_size_violation(spark, d):
    v = Q.array_size_violations(catalogue_records(spark, d), "tipodeoctogono", 3)
    return v.withColumn("tipodeoctogono", F.array_join("tipodeoctogono", ","))


@query("price_reconciliation", sql=f"""
WITH {NEST_CTE},
o AS (SELECT productid, ingesta_date,
             {money('precio_regular - mejor_descuento')} AS directo,
             {money('(precio_regular * unit_multiplier - mejor_descuento) / unit_multiplier')}
               AS ajustado
      FROM enriched WHERE mejor_descuento IS NOT NULL)
SELECT o.productid, o.ingesta_date, s.precio_tarjeta_sip AS web, o.directo, o.ajustado,
       abs(o.directo - s.precio_tarjeta_sip) < 0.01 AS coincide_directo,
       abs(o.ajustado - s.precio_tarjeta_sip) < 0.01 AS coincide_ajustado
FROM o JOIN silver s ON o.productid = s.productid AND o.ingesta_date = s.ingesta_date
""")
def q_price_reconciliation(spark, d):
    n = catalogue_records(spark, d, by_product=True)
    return Q.price_reconciliation(S.enrich(n), S.build_silver(n, method="window"),
                                  ["productid", "ingesta_date"], "precio_tarjeta_sip")


# --- batch control -----------------------------------------------------------------------

def _landing_batches(spark, d):
    return observations(spark, d).select("batch_id").distinct()


def _control_fixture(spark, d):
    """Control rows derived from the landing batches: up to the 15th completed,
    16th–20th failed."""
    b = _landing_batches(spark, d).filter(F.col("batch_id") <= "2024-01-20")
    status = F.when(F.col("batch_id") <= "2024-01-15", F.lit(K.STATUS_COMPLETED)) \
        .otherwise(F.lit(K.STATUS_FAILED))
    return b.select("batch_id", status.alias("status"),
                    *[F.lit(None).cast("timestamp").alias(c) for c in
                      ("created_timestamp", "updated_timestamp", "start_time", "end_time")],
                    F.lit(None).cast("string").alias("error_message"))


@query("next_batch", sql=f"""
WITH {OBS_CTE},
p AS (SELECT DISTINCT batch_id FROM obs
      EXCEPT SELECT DISTINCT batch_id FROM obs WHERE batch_id <= '2024-01-15')
SELECT min(batch_id) AS siguiente_batch, COUNT(*) AS pendientes FROM p
""")
def q_next_batch(spark, d):
    return C.next_batch(_landing_batches(spark, d), _control_fixture(spark, d))


@query("batch_exists", sql=f"""
WITH {OBS_CTE}
SELECT bool_or(batch_id = '2024-01-15') AS existe, bool_or(batch_id = '2031-01-01') AS existe_futuro
FROM obs
""")
def q_batch_exists(spark, d):
    o = observations(spark, d)
    days = ["2024-01-15", "2031-01-01"]
    found = [batch_exists(o, "batch_id", b) for b in days]  # each stops at its first row
    return spark.createDataFrame([found], "existe boolean, existe_futuro boolean")


@query("batch_state_transitions", sql=f"""
WITH {OBS_CTE}
SELECT DISTINCT batch_id,
       CASE WHEN batch_id <= '2024-01-15' THEN 'COMPLETED'
            WHEN batch_id <= '2024-01-17' THEN 'FAILED' ELSE 'IN_PROGRESS' END AS status,
       CASE WHEN batch_id > '2024-01-15' AND batch_id <= '2024-01-17' THEN 'carga interrumpida'
       END AS error_message
FROM obs
""")
def q_batch_state_transitions(spark, d):
    landing = _landing_batches(spark, d)
    # Start: up to the 10th completed, 11th-20th in progress.
    ctl = _control_fixture(spark, d).withColumn(
        "status", F.when(F.col("batch_id") <= "2024-01-10", F.lit(K.STATUS_COMPLETED))
        .otherwise(F.lit(K.STATUS_IN_PROGRESS)))
    ctl = C.complete_batches(ctl, landing.filter(F.col("batch_id") <= "2024-01-15"))
    ctl = C.fail_batches(ctl, F.col("batch_id").between("2024-01-16", "2024-01-20"),
                         "carga interrumpida")
    ctl = C.start_batches(ctl, landing.filter(F.col("batch_id") >= "2024-01-18"))
    return ctl.select("batch_id", "status", "error_message")


# --- MERGE / UPDATE on orders -----------------------------------------------------------------

def _orders(spark, d):
    return table(spark, d, "orders")


def _ts(s):
    return F.to_timestamp_ntz(F.lit(s))


@query("merge_insert_only", sql="""
WITH t AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
           WHERE o_orderdate < TIMESTAMP '1998-01-01'),
s AS (SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice FROM orders
      WHERE o_orderdate >= TIMESTAMP '1997-01-01')
SELECT * FROM t
UNION ALL
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)
""")
def q_merge_insert_only(spark, d):
    o = _orders(spark, d)
    t = o.filter(F.col("o_orderdate") < _ts("1998-01-01")).select("o_orderkey", "o_orderstatus",
                                                                   "o_totalprice")
    s = o.filter(F.col("o_orderdate") >= _ts("1997-01-01")).select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), "o_totalprice")
    return t.unionByName(merge_insert_only(t, s, ["o_orderkey"]))


UPSERT_DAY = "1997-07-01"


@query("merge_guarded_upsert", sql=f"""
WITH t AS (SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS batch_id,
                  CAST(o_orderdate AS DATE) AS creado, CAST(o_orderdate AS DATE) AS actualizado
           FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
s AS (SELECT o_orderkey, o_totalprice + 1.0 AS o_totalprice, '{UPSERT_DAY}' AS batch_id,
             DATE '{UPSERT_DAY}' AS creado, DATE '{UPSERT_DAY}' AS actualizado
      FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'),
j AS (SELECT t.o_orderkey AS tk, t.o_totalprice AS tp, t.batch_id AS tb, t.creado AS tc,
             t.actualizado AS ta, s.o_orderkey AS sk, s.o_totalprice AS sp, s.batch_id AS sb,
             s.creado AS sc, s.actualizado AS sa,
             t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL
               AND coalesce(s.batch_id >= t.batch_id, false) AS upd
      FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey)
SELECT CASE WHEN tk IS NULL THEN sk ELSE tk END AS o_orderkey,
       CASE WHEN tk IS NULL THEN sp WHEN upd THEN sp ELSE tp END AS o_totalprice,
       CASE WHEN tk IS NULL THEN sb WHEN upd THEN sb ELSE tb END AS batch_id,
       CASE WHEN tk IS NULL THEN sc ELSE tc END AS creado,
       CASE WHEN tk IS NULL THEN sa WHEN upd THEN DATE '2000-01-01' ELSE ta END AS actualizado
FROM j
""")
def q_merge_guarded_upsert(spark, d):
    o = _orders(spark, d)
    t = o.filter(F.col("o_orderdate") < _ts("1998-01-01")).select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("batch_id"),
        F.to_date("o_orderdate").alias("creado"), F.to_date("o_orderdate").alias("actualizado"))
    s = o.filter(F.col("o_orderdate") >= _ts("1997-01-01")).select(
        "o_orderkey", (F.col("o_totalprice") + F.lit(1.0)).alias("o_totalprice"),
        F.lit(UPSERT_DAY).alias("batch_id"), F.to_date(F.lit(UPSERT_DAY)).alias("creado"),
        F.to_date(F.lit(UPSERT_DAY)).alias("actualizado"))
    return merge_upsert(t, s, ["o_orderkey"],
                        guard=lambda tc, sc: sc("batch_id") >= tc("batch_id"),
                        keep_cols=["creado"],
                        touched={"actualizado": F.to_date(F.lit("2000-01-01"))})


@query("merge_update_only", sql="""
WITH s AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT t.o_orderkey,
       CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderstatus = 'O' THEN 'C'
            ELSE t.o_orderstatus END AS o_orderstatus,
       t.o_orderpriority
FROM orders t LEFT JOIN s ON t.o_orderkey = s.o_orderkey
""")
def q_merge_update_only(spark, d):
    o = _orders(spark, d).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    s = o.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")
    return merge_update_only(o, s, ["o_orderkey"], {"o_orderstatus": F.lit("C")},
                             target_condition=F.col("o_orderstatus") == "O")


@query("update_where", sql="""
SELECT o_orderkey,
       CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' AND o_orderstatus = 'O' THEN 'F'
            ELSE o_orderstatus END AS o_orderstatus
FROM orders
""")
def q_update_where(spark, d):
    o = _orders(spark, d).select("o_orderkey", "o_orderstatus", "o_orderdate")
    return update_where(o, (F.col("o_orderdate") < _ts("1996-01-01")) & (F.col("o_orderstatus") == "O"),
                        {"o_orderstatus": F.lit("F")}).drop("o_orderdate")
