"""Queries over tables as such: publication at once, versions, type changes, named
schemas and tables, audit timestamps, rejected casts, days in time zones.

Each writes data derived from the given tables under the shared checkpoint folder
and reads it back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.functions.dates import today_batch_id
from shelfwise.plans import analytics as A
from shelfwise.plans import silver as S
from shelfwise.plans.bindings import catalogue_records, snapshot, table
from shelfwise.plans.oracle_sql import SNAP_CTE, money
from shelfwise.plans.registry import query
from shelfwise.session import scratch_path
from shelfwise.sources import catalog as CT
from shelfwise.sources import tables as TB
from shelfwise.sources import versions as V


def _rows(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", "user_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("batch_id"))


# --- published at once -----------------------------------------------------------------

@query("atomic_replace", sql="""
SELECT event_id, user_id, CASE WHEN day(ts) % 3 = 0 THEN value * 2 ELSE value END AS value,
       strftime(ts, '%Y-%m-%d') AS batch_id
FROM events
""")
def q_atomic_replace(spark, d):
    """Two replacements of partitions: one whose writer dies before it is published,
    which nobody sees, and one that is published."""
    path = scratch_path(spark, "atomic")
    rows = _rows(spark, d)
    TB.overwrite_table(rows, path, ["batch_id"])
    V.stage(rows.withColumn("value", F.lit(-1.0)), path, ["batch_id"])  # never published
    third = F.substring("batch_id", 9, 2).cast("int") % 3 == 0
    old = TB.read_table(spark, path)
    TB.replace_partitions(old.filter(third).withColumn("value", F.col("value") * 2), path, ["batch_id"],
                          V.current(spark, path))
    return TB.read_table(spark, path)


@query("read_earlier_version", sql="""
SELECT strftime(ts, '%Y-%m-%d') AS batch_id, count(*) AS filas_antes,
       count(*) FILTER (WHERE event_type <> 'error') AS filas_ahora
FROM events GROUP BY 1
""")
def q_read_earlier_version(spark, d):
    """Rows by batch before and after an overwrite, from the two versions."""
    path = scratch_path(spark, "versions")
    ev = table(spark, d, "events").select("event_id", "event_type",
                                          F.date_format("ts", "yyyy-MM-dd").alias("batch_id"))
    TB.overwrite_table(ev, path, ["batch_id"])
    first = V.current(spark, path).number
    TB.overwrite_table(TB.read_table(spark, path).filter("event_type <> 'error'"), path, ["batch_id"])
    TB.drop_partitions(spark, path, "batch_id", ["1900-01-01"])  # no such day: nothing changes
    before = TB.read_table(spark, path, version=first).select("batch_id", F.lit(1).alias("antes"))
    now = TB.read_table(spark, path).select("batch_id", F.lit(0).alias("antes"))
    return before.unionByName(now).groupBy("batch_id").agg(
        F.count_if(F.col("antes") == 1).alias("filas_antes"), F.count_if(F.col("antes") == 0).alias("filas_ahora"))


@query("batch_type_changes", sql="""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS batch_id,
       CASE day(ts) % 4 WHEN 0 THEN CAST(event_id % 1000 AS VARCHAR)
                        WHEN 1 THEN CAST(event_id * 10000000000 AS VARCHAR)
                        WHEN 2 THEN 'N' || CAST(event_id AS VARCHAR) END AS precio,
       CASE WHEN day(ts) % 4 IN (0, 3) THEN CAST(user_id AS DOUBLE) ELSE user_id + 0.5 END AS cantidad
FROM events
""")
def q_batch_type_changes(spark, d):
    """Batches whose price is an int, a long, a text or missing, and whose quantity is
    a long or a double: one table, each column in the narrowest type for all."""
    path = scratch_path(spark, "types")
    ev = table(spark, d, "events").select("event_id", "user_id", F.dayofmonth("ts").alias("day"),
                                          F.date_format("ts", "yyyy-MM-dd").alias("batch_id"))
    price = [(F.col("event_id") % 1000).cast("int"), F.col("event_id") * 10_000_000_000,
             F.concat(F.lit("N"), F.col("event_id").cast("string")), None]
    for k, p in enumerate(price):
        amount = F.col("user_id") if k in (0, 3) else F.col("user_id") + F.lit(0.5)
        rows = ev.filter(F.col("day") % 4 == k).select(
            "event_id", *([p.alias("precio")] if p is not None else []), amount.alias("cantidad"), "batch_id")
        TB.replace_partitions(rows, path, ["batch_id"])
    return TB.read_table(spark, path).select("event_id", "batch_id", "precio", "cantidad")


@query("latest_kpis_of_partitioned_table", sql=f"""
WITH {SNAP_CTE}, newest AS (SELECT max(ingesta_date) AS dia FROM snap)
SELECT count(*) AS total_productos, sum(disponible::INT)::BIGINT AS disponibles,
       sum((NOT disponible)::INT)::BIGINT AS sin_stock, sum(en_promocion::INT)::BIGINT AS con_sip,
       {money('avg(precio_regular) FILTER (precio_valido)')} AS precio_promedio,
       round(avg(descuento_tarjeta_sip_pct) FILTER (en_promocion), 1) AS descuento_sip_promedio
FROM snap JOIN newest ON ingesta_date = dia
""")
def q_latest_kpis_of_partitioned_table(spark, d):
    """The latest batch's figures over a written table partitioned by the day: the
    selector prunes the scan to one partition at run time."""
    path = scratch_path(spark, "by-day")
    TB.overwrite_table(snapshot(spark, d), path, ["ingesta_date"])
    return A.latest_batch_kpis(TB.read_table(spark, path))


# --- named schemas and tables -------------------------------------------------------------

def _fresh_schema(spark, kind: str) -> tuple[str, str]:
    """A schema of its own for this call, and its folder."""
    folder = scratch_path(spark, f"schema_{kind}".replace("-", "_"))
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    CT.create_schema(spark, name, folder)
    return name, folder


@query("create_schema_use", sql="""
SELECT event_type, count(*) AS filas, sum(user_id)::BIGINT AS suma, true AS esquema_nuevo,
       false AS esquema_otra_vez, true AS tabla_nueva, false AS tabla_otra_vez, true AS vuelve
FROM events GROUP BY event_type
""")
def q_create_schema_use(spark, d):
    """A schema made and used: a table made, filled and read by its bare name, in it."""
    folder = scratch_path(spark, "schema_use")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    new, again = CT.create_schema(spark, name, folder), CT.create_schema(spark, name, folder)
    before = spark.catalog.currentDatabase()
    rows = table(spark, d, "events").select("event_id", "user_id", "event_type")
    with CT.use_schema(spark, name):
        first = CT.create_table(spark, "movimientos", rows.schema, f"{folder}/movimientos",
                                partition_by=["event_type"])
        second = CT.create_table(spark, "movimientos", rows.schema, f"{folder}/movimientos",
                                 partition_by=["event_type"])
        CT.insert_select(spark, "movimientos", rows)
        out = spark.sql("SELECT event_type, count(*) AS filas, sum(user_id) AS suma FROM movimientos "
                        "GROUP BY event_type")
    return out.withColumns({"esquema_nuevo": F.lit(new), "esquema_otra_vez": F.lit(again),
                            "tabla_nueva": F.lit(first), "tabla_otra_vez": F.lit(second),
                            "vuelve": F.lit(spark.catalog.currentDatabase() == before)})


@query("insert_select", sql="""
SELECT event_id, CASE WHEN day(ts) = 15 THEN value * 2 ELSE value END AS value, NULL::VARCHAR AS nota,
       strftime(ts, '%Y-%m-%d') AS batch_id
FROM events
""")
def q_insert_select(spark, d):
    """INSERT INTO ... SELECT by column names, with a column left out, and INSERT
    OVERWRITE of one partition."""
    name, folder = _fresh_schema(spark, "insert")
    rows = _rows(spark, d).select("batch_id", "value", "event_id")
    schema = rows.select("event_id", "value", F.lit("").alias("nota"), "batch_id").schema
    CT.create_table(spark, f"{name}.hechos", schema, f"{folder}/hechos", partition_by=["batch_id"])
    CT.insert_select(spark, f"{name}.hechos", rows)
    day = rows.filter(F.col("batch_id").endswith("-15")).withColumn("value", F.col("value") * 2)
    CT.insert_select(spark, f"{name}.hechos", day, overwrite=True)
    return spark.table(f"{name}.hechos")


@query("recover_partitions", sql="""
SELECT strftime(ts, '%Y-%m-%d') AS batch_id, count(*) AS filas FROM events GROUP BY 1
""")
def q_recover_partitions(spark, d):
    """Partitions that others wrote into the table's folder are taken up, those there
    when the table was named and those that came later."""
    name, folder = _fresh_schema(spark, "recover")
    rows, path = _rows(spark, d), f"{folder}/externa"
    early = F.col("batch_id") < "2024-01-16"
    rows.filter(early).write.partitionBy("batch_id").parquet(path)
    CT.create_table(spark, f"{name}.externa", rows.schema, path, partition_by=["batch_id"])
    rows.filter(~early).write.mode("append").partitionBy("batch_id").parquet(path)
    CT.recover_partitions(spark, f"{name}.externa")
    return spark.sql(f"SELECT batch_id, count(*) AS filas FROM {name}.externa GROUP BY batch_id")


@query("named_version", sql="""
SELECT strftime(ts, '%Y-%m-%d') AS batch_id, count(*) AS filas,
       sum(CASE WHEN day(ts) = 15 THEN -1 ELSE user_id END)::BIGINT AS suma
FROM events WHERE day(ts) <> 20 GROUP BY 1
""")
def q_named_version(spark, d):
    """A name over the published version of a table: partitions appended to, replaced
    and dropped since it was first named."""
    name, folder = _fresh_schema(spark, "named")
    path, rows = f"{folder}/tabla", _rows(spark, d).drop("value")
    day = F.substring("batch_id", 9, 2).cast("int")
    for part in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1):
        TB.append_table(rows.filter(part), path, ["batch_id"])
    CT.name_version(spark, f"{name}.tabla", path)
    TB.replace_partitions(rows.filter(day == 15).withColumn("user_id", F.lit(-1).cast("long")), path, ["batch_id"])
    gone = [p.split("=")[1] for p in V.current(spark, path).parts if p.endswith("-20")]
    TB.drop_partitions(spark, path, "batch_id", gone)
    CT.name_version(spark, f"{name}.tabla", path)
    return spark.sql(f"SELECT batch_id, count(*) AS filas, sum(user_id) AS suma FROM {name}.tabla GROUP BY batch_id")


# --- audit timestamps, casts, days ------------------------------------------------------------

FIRST_LOAD, SECOND_LOAD = "2024-03-01 08:00:00", "2024-03-02 09:30:00"


@query("audit_timestamps", sql=f"""
WITH {SNAP_CTE}
SELECT productid, ingesta_date, TIMESTAMP '{FIRST_LOAD}' AS created_timestamp,
       CASE WHEN productid % 3 = 0 THEN TIMESTAMP '{SECOND_LOAD}' ELSE TIMESTAMP '{FIRST_LOAD}' END
         AS updated_timestamp
FROM snap
UNION ALL
SELECT -1 - productid, ingesta_date, TIMESTAMP '{SECOND_LOAD}', TIMESTAMP '{SECOND_LOAD}'
FROM snap WHERE productid % 3 = 0
""")
def q_audit_timestamps(spark, d):
    """Created and updated times over two loads: rows of the second that were there
    keep when they were created, new ones have both, the others stay."""
    path = scratch_path(spark, "audited")
    keys = ["productid", "ingesta_date"]

    def loaded(rows, at):
        now = F.lit(dt.datetime.fromisoformat(at)).cast("timestamp_ntz")
        return rows.withColumns({"created_timestamp": now, "updated_timestamp": now}), now
    snap = snapshot(spark, d).select(*keys)
    TB.overwrite_table(loaded(snap, FIRST_LOAD)[0], path, ["ingesta_date"])
    third = snap.filter(F.col("productid") % 3 == 0)
    both = third.unionByName(third.withColumn("productid", -1 - F.col("productid")))
    rows, now = loaded(both, SECOND_LOAD)
    TB.merge_into_table(spark, path, rows, keys, "ingesta_date", keep_cols=["created_timestamp"],
                        touched={"updated_timestamp": now})
    return TB.read_table(spark, path)


@query("cast_rejects", sql="""
SELECT count(*) AS filas_bronze, 0::BIGINT AS precio_regular,
       count(*) FILTER (l_linenumber = 5) AS precio_online, 0::BIGINT AS unit_multiplier,
       count(*) FILTER (l_linestatus = 'F') AS disponible,
       count(*) FILTER (l_linenumber = 2) AS cantidad_disponible,
       count(*) FILTER (l_linenumber = 7) AS fecha_lanzamiento
FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def q_cast_rejects(spark, d):
    """How many values of each cast column are there and cannot be read as its type:
    prices, flags, quantities and days written as text, some of them no such thing."""
    nest = catalogue_records(spark, d)
    line = F.substring("seccion", 5, 2).cast("int")
    offer = F.col("items")[0]["sellers"][0]["commertialoffer"]
    spoiled = F.struct(
        offer["listprice"].cast("string").alias("listprice"),
        F.when(line == 5, F.lit("gratis")).otherwise(offer["price"].cast("string")).alias("price"),
        F.when(offer["isavailable"], F.lit("true")).otherwise(F.lit("agotado")).alias("isavailable"),
        F.when(line == 2, F.lit("1e99")).when(line == 3, F.lit(" ")).otherwise(
            offer["availablequantity"].cast("string")).alias("availablequantity"),
        offer["promotionteasers"].alias("promotionteasers"))
    item = F.col("items")[0]
    seller = F.struct(item["sellers"][0]["sellername"].alias("sellername"), spoiled.alias("commertialoffer"))
    items = F.array(F.struct(item["itemid"].alias("itemid"), item["unitmultiplier"].alias("unitmultiplier"),
                             F.array(seller).alias("sellers")))
    return S.cast_rejects(nest.withColumn("items", items))


@query("batch_day_in_zone", sql="""
SELECT event_id, strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d') AS dia_lima,
       strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS dia_tokio
FROM events
""")
def q_batch_day_in_zone(spark, d):
    """The batch id that an instant falls on in two time zones."""
    at = F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC")
    return table(spark, d, "events").select("event_id", today_batch_id("America/Lima", at).alias("dia_lima"),
                                            today_batch_id("Asia/Tokyo", at).alias("dia_tokio"))
