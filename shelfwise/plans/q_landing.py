"""Write-path queries: data derived from the given tables is written under the
shared checkpoint folder (a fresh sub-folder per call) and read back.

Landing JSON round-trip, batch listing and completeness, batch-scoped replace,
append, create-or-replace and the guarded MERGE writer.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.plans.bindings import snapshot, table
from shelfwise.plans.oracle_sql import SNAP_CTE
from shelfwise.plans.registry import query
from shelfwise.session import scratch_path
from shelfwise.sources import landing as L
from shelfwise.sources import tables as TB
from shelfwise.sources import versions as V

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
EXPECTED_SECTIONS = EVENT_TYPES + ["refund"]


def _raw_events(spark, d):
    """Events with landing-style raw keys (mixed case, spaces, accents)."""
    ev = table(spark, d, "events")
    return ev.select(
        F.col("user_id").alias("userId"),
        F.col("value").alias("Valor Unitário"),
        F.col("props").alias("Props"),
        F.col("event_id").alias("eventId"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Fecha  Evento"),
        F.date_format("ts", "yyyy-MM-dd").alias("batch_id"),
        F.col("event_type").alias("seccion"))


def _written_landing(spark, d):
    base = scratch_path(spark, "landing")
    L.write_landing(_raw_events(spark, d), base, id_col="eventId")
    return base


LANDING_SQL = """
SELECT user_id AS userid, value AS valor_unitario, props, event_id AS eventid,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS fecha_evento,
       strftime(ts, '%Y-%m-%d') AS batch_id, event_type AS seccion
FROM events
"""


@query("landing_roundtrip", sql=LANDING_SQL)
def q_landing_roundtrip(spark, d):
    base = _written_landing(spark, d)
    return L.read_landing(spark, base, glob="*.txt")


@query("normalize_columns", sql="""
SELECT COUNT(user_id) AS userid, COUNT(value) AS valor_unitario, COUNT(props) AS props,
       COUNT(event_id) AS eventid, COUNT(ts) AS fecha_evento
FROM events
""")
def q_normalize_columns(spark, d):
    """Raw landing keys renamed to their normal form (the result's column
    names), with the non-NULL count each renamed column carries."""
    base = _written_landing(spark, d)
    df = L.read_landing(spark, base, glob="*.txt").drop("batch_id", "seccion")
    return df.agg(*[F.count(c).alias(c) for c in df.columns])


@query("landing_batches", sql="SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS batch_id FROM events")
def q_landing_batches(spark, d):
    base = _written_landing(spark, d)
    return L.landing_batches(L.landing_files(spark, base, glob="*.txt"))


@query("landing_completeness", sql=f"""
WITH f AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS batch_id, event_type FROM events),
g AS (SELECT batch_id, list_sort(list(event_type)) AS found FROM f GROUP BY batch_id)
SELECT batch_id, CAST(len(found) AS INTEGER) AS secciones,
       array_to_string(list_filter({sorted(EXPECTED_SECTIONS)!r}::VARCHAR[],
                                   lambda x: NOT list_contains(found, x)), ',') AS faltantes,
       len(list_filter({sorted(EXPECTED_SECTIONS)!r}::VARCHAR[],
                       lambda x: NOT list_contains(found, x))) = 0 AS completo
FROM g
""")
def q_landing_completeness(spark, d):
    base = _written_landing(spark, d)
    c = L.landing_completeness(L.landing_files(spark, base, glob="*.txt"), EXPECTED_SECTIONS)
    return c.withColumn("faltantes", F.array_join("faltantes", ","))


@query("landing_json_lines", sql=LANDING_SQL)
def q_landing_json_lines(spark, d):
    """JSON lines in ``*.json`` files, found by the default pattern."""
    base = scratch_path(spark, "landing-lines")
    L.write_landing_lines(_raw_events(spark, d), base)
    return L.read_landing(spark, base, multiline=False)


@query("landing_rejects", sql="""
SELECT strftime(ts, '%Y-%m-%d') AS batch_id, count(*) FILTER (WHERE event_id % 7 <> 0) AS leidas,
       count(*) FILTER (WHERE event_id % 7 = 0) AS rechazadas
FROM events GROUP BY 1
""")
def q_landing_rejects(spark, d):
    """Every seventh line cut off in the middle: lines read and rejected, by batch."""
    base = scratch_path(spark, "landing-broken")
    raw = _raw_events(spark, d)
    line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns if c not in ("batch_id", "seccion")]))
    cut = F.when(F.col("eventId") % 7 == 0, F.substring(line, 1, 12)).otherwise(line)
    raw.select(cut.alias("value"), "batch_id", "seccion").write.partitionBy("batch_id", "seccion").text(base)
    schema = raw.drop("batch_id", "seccion").schema
    read = L.read_landing(spark, base, glob="*.txt", multiline=False, schema=schema, on_error="divert")
    lost = L.landing_rejects(spark, base, glob="*.txt", multiline=False, schema=schema)
    both = read.select("batch_id", F.lit(1).alias("ok")).unionByName(lost.select("batch_id", F.lit(0).alias("ok")))
    return both.groupBy("batch_id").agg(F.count_if(F.col("ok") == 1).alias("leidas"),
                                        F.count_if(F.col("ok") == 0).alias("rechazadas"))


@query("case_colliding_keys", sql="""
WITH e AS (SELECT (event_id % 2 = 0)::INT + (event_id % 3 = 0)::INT + (event_id % 5 = 0)::INT AS tags,
                  (event_id % 2 = 0)::INT + (event_id % 7 > 0)::INT AS valores FROM events)
SELECT 'tag_stock' AS clave, 'TAG Stock,Tag Stock,tag stock' AS formas,
       count(*) FILTER (tags > 0) AS filas, count(*) FILTER (tags > 1) AS filas_con_varias FROM e
UNION ALL
SELECT 'valor', 'VALOR,valor', count(*) FILTER (valores > 0), count(*) FILTER (valores > 1) FROM e
""")
def q_case_colliding_keys(spark, d):
    """Records whose keys differ only by case: for each normal key, the rows that set
    several of its spellings."""
    base = scratch_path(spark, "landing-case")
    n = F.col("event_id")
    ev = table(spark, d, "events").select(
        n, F.date_format("ts", "yyyy-MM").alias("batch_id"), F.col("event_type").alias("seccion"))

    def field(key, when):
        return F.when(when, F.concat(F.lit(f'"{key}":'), n.cast("string")))
    record = F.concat(F.lit("{"), F.concat_ws(",", F.concat(F.lit('"id":'), n.cast("string")),
                                              field("tag stock", n % 2 == 0), field("Tag Stock", n % 3 == 0),
                                              field("TAG Stock", n % 5 == 0), field("valor", n % 2 == 0),
                                              field("VALOR", n % 7 > 0)), F.lit("}"))
    ev.select(record.alias("value"), "batch_id", "seccion").write.partitionBy("batch_id", "seccion").text(base)
    found = L.colliding_counts(spark, base, glob="*.txt", multiline=False, overrides={})
    return found.withColumn("formas", F.array_join("formas", ","))


@query("section_from_file_name", sql=LANDING_SQL)
def q_section_from_file_name(spark, d):
    """Landing files named by their section, ``batch_id=<day>/<section>.json``, and
    read back with the section taken from the name."""
    written, base = scratch_path(spark, "landing-parts"), scratch_path(spark, "landing-named")
    L.write_landing(_raw_events(spark, d), written, id_col="eventId")
    L.publish_landing(spark, written, base)
    return L.read_landing(spark, base)


# --- parquet table writes ------------------------------------------------------------------

def _obs_rows(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", "user_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("batch_id"))


REPLACED_DAY = "2024-01-15"


@query("replace_batch_roundtrip", sql=f"""
SELECT event_id, user_id,
       CASE WHEN strftime(ts, '%Y-%m-%d') = '{REPLACED_DAY}' THEN value * 2 ELSE value END AS value,
       strftime(ts, '%Y-%m-%d') AS batch_id
FROM events
""")
def q_replace_batch_roundtrip(spark, d):
    path = scratch_path(spark, "bronze")
    rows = _obs_rows(spark, d)
    TB.replace_batch(rows, path)
    day = TB.scan_batch(TB.read_table(spark, path), "batch_id", REPLACED_DAY)
    TB.replace_batch(day.withColumn("value", F.col("value") * 2), path)
    return TB.read_table(spark, path).select("event_id", "user_id", "value", "batch_id")


@query("append_roundtrip", sql="""
SELECT event_id, user_id, value, strftime(ts, '%Y-%m-%d') AS batch_id FROM events
""")
def q_append_roundtrip(spark, d):
    path = scratch_path(spark, "append")
    rows = _obs_rows(spark, d)
    TB.append_table(rows.filter(F.col("batch_id") < "2024-01-16"), path)
    TB.append_table(rows.filter(F.col("batch_id") >= "2024-01-16"), path)
    return TB.read_table(spark, path)


@query("create_or_replace_roundtrip", sql="""
SELECT event_id, event_type, value * 100 AS value_cents FROM events
""")
def q_create_or_replace_roundtrip(spark, d):
    path = scratch_path(spark, "table")
    ev = table(spark, d, "events")
    TB.overwrite_table(ev.select("event_id", "value"), path)
    TB.overwrite_table(ev.select("event_id", "event_type",
                                 (F.col("value") * 100).alias("value_cents")), path)
    return TB.read_table(spark, path)


@query("create_table_if_missing", sql="""
SELECT event_id, user_id, value, strftime(ts, '%Y-%m-%d') AS batch_id,
       true AS creada_primero, false AS creada_despues
FROM events
""")
def q_create_table_if_missing(spark, d):
    """An empty typed table made once, filled, and left alone by a second CREATE."""
    path = scratch_path(spark, "created")
    rows = _obs_rows(spark, d)
    first = TB.create_if_missing(spark, path, rows.schema, ["batch_id"])
    TB.append_table(rows, path, ["batch_id"])
    again = TB.create_if_missing(spark, path, rows.schema, ["batch_id"])
    return TB.read_table(spark, path, rows.schema).withColumns(
        {"creada_primero": F.lit(first), "creada_despues": F.lit(again)})


@query("temp_view_sql", sql=f"""
WITH {SNAP_CTE}
SELECT categoria_principal, count(*) AS filas, max(precio_regular) AS precio_maximo
FROM snap WHERE precio_valido GROUP BY categoria_principal HAVING count(*) > 1
""")
def q_temp_view_sql(spark, d):
    """SQL over a temporary view of the snapshot."""
    snapshot(spark, d).createOrReplaceTempView("snap_view")
    return spark.sql("""
        SELECT categoria_principal, count(*) AS filas, max(precio_regular) AS precio_maximo
        FROM snap_view WHERE precio_valido GROUP BY categoria_principal HAVING count(*) > 1""")


MERGE_DAY = "2024-01-15"
SNAP_OUT = ["productid", "ingesta_date", "batch_id", "precio_regular", "event_id"]


@query("merge_table_roundtrip", sql=f"""
WITH {SNAP_CTE}
SELECT productid, ingesta_date, batch_id,
       CASE WHEN ingesta_date = DATE '{MERGE_DAY}' AND productid % 2 = 0
            THEN precio_regular + 1.0 ELSE precio_regular END AS precio_regular,
       event_id
FROM snap
""")
def q_merge_table_roundtrip(spark, d):
    """Guarded upsert through the parquet writer: a replayed batch with older
    batch ids must not overwrite, a same-batch correction must."""
    path = scratch_path(spark, "silver")
    snap = snapshot(spark, d).select(*SNAP_OUT)
    TB.replace_partitions(snap, path, ["ingesta_date"])
    schema = snap.schema
    src = (snap.filter(F.col("ingesta_date") == F.to_date(F.lit(MERGE_DAY)))
           .withColumn("precio_regular", F.col("precio_regular") + F.lit(1.0))
           .withColumn("batch_id", F.when(F.col("productid") % 2 == 0, F.lit(MERGE_DAY))
                       .otherwise(F.lit("2024-01-14"))))
    TB.merge_into_table(spark, path, src, ["productid", "ingesta_date"], "ingesta_date",
                        guard=lambda t, s: s("batch_id") >= t("batch_id"), schema=schema)
    return TB.read_table(spark, path, schema).select(*SNAP_OUT)


@query("landing_stream_bronze", sql=LANDING_SQL)
def q_landing_stream_bronze(spark, d):
    """The streaming face: a file stream over the landing folder drives the
    bronze load (availableNow); the bronze table is read back."""
    from shelfwise.streaming.landing_stream import start_bronze_stream
    base = _written_landing(spark, d)
    bronze = scratch_path(spark, "bronze-stream")
    q = start_bronze_stream(spark, base, bronze, scratch_path(spark, "stream-ckpt"), glob="*.txt")
    q.awaitTermination()
    return TB.read_table(spark, bronze, merge_schema=True)


@query("silver_stream_upsert", sql=f"""
WITH {SNAP_CTE}
SELECT productid, ingesta_date, batch_id, precio_regular, event_id FROM snap
""")
def q_silver_stream_upsert(spark, d):
    """A file stream keeps the snapshot in step with the landing folder, a few files at
    a time: each micro-batch upserts the days it touches, and the last one, played
    again, changes nothing."""
    from shelfwise.operators.dedup import asc, best_row_per_key, desc
    from shelfwise.streaming.landing_stream import start_silver_stream, upsert_epoch
    base = scratch_path(spark, "landing-stream")
    bronze, silver = scratch_path(spark, "bronze-stream"), scratch_path(spark, "silver-stream")
    L.write_landing_lines(_raw_events(spark, d).withColumn("seccion", F.lit("eventos")), base)

    def build(rows):
        typed = rows.select(F.col("userid").alias("productid"), F.to_date("batch_id").alias("ingesta_date"),
                            "batch_id", F.col("valor_unitario").cast("double").alias("precio_regular"),
                            F.col("eventid").alias("event_id"))
        return best_row_per_key(typed, ["productid", "ingesta_date"], [desc("precio_regular"), asc("event_id")])
    keys = ["productid", "ingesta_date"]
    q = start_silver_stream(spark, base, bronze, silver, scratch_path(spark, "stream-ckpt"), build=build,
                            keys=keys, partition_col="ingesta_date", multiline=False,
                            max_files_per_trigger=10)
    q.awaitTermination()
    now = V.current(spark, silver)
    (stream, epoch), = now.epochs.items()
    again = upsert_epoch(spark, base, bronze, silver, ["2024-01-01"], (stream, epoch),
                         lambda rows: build(rows).withColumn("precio_regular", F.lit(-1.0)), keys,
                         "ingesta_date", multiline=False)
    if again or V.current(spark, silver).number != now.number:
        raise AssertionError("a micro-batch was applied twice")
    return TB.read_table(spark, silver).select(*SNAP_OUT)
