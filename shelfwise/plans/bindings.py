"""Bindings of the retail data model onto the driver's test tables.

The library's functions take column names; these bindings produce frames with
the retail names from the TPC-H-like tables, so every registered query runs
over whole tables and its work grows with them.

* OBS  (silver before dedup)  ← ``events``: product = user, day = event day,
  category = event type, price = value, section = ``props.k``.
* SNAP (silver)               ← OBS, best row per (product, day): highest price,
  then lowest event id; sections consolidated.
* NEST (landing-shaped rows)  ← ``lineitem ⋈ part``: one catalogue record per
  line item with the full items → sellers → offer → teasers nesting; the list
  price is the line's unit price (extended price / quantity).
* STAR (gold)                 ← the snapshot built from NEST, loaded into the
  dimensions and the fact exactly as a daily batch would be.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.operators.dedup import asc, best_row_per_key, desc

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- OBS / SNAP ----------------------------------------------------------------

def observations(spark: SparkSession, sf_dir: str, *, day_from: str | None = None,
                 day_to: str | None = None) -> DataFrame:
    """OBS.  Optional day bounds are applied on the raw timestamp, so they reach
    the parquet scan as pushed filters."""
    ev = table(spark, sf_dir, "events")
    if day_from:
        ev = ev.filter(F.col("ts") >= F.to_timestamp_ntz(F.lit(day_from)))
    if day_to:
        ev = ev.filter(F.col("ts") < F.to_timestamp_ntz(F.lit(day_to)) + F.expr("INTERVAL 1 DAY"))
    k = F.get_json_object("props", "$.k")
    ki = k.try_cast("int")
    return ev.select(
        F.col("user_id").alias("productid"),
        F.concat(F.lit("producto-"), F.col("user_id").cast("string")).alias("productname"),
        F.to_date("ts").alias("ingesta_date"),
        F.date_format("ts", "yyyy-MM-dd").alias("batch_id"),
        F.col("event_type").alias("categoria_principal"),
        F.col("value").alias("precio_regular"),
        k.alias("seccion"),
        (F.col("value") > 0).alias("precio_valido"),
        (F.col("value") > 50).alias("en_promocion"),
        (ki % 4 != 0).alias("disponible"),
        (ki % 50).cast("long").alias("descuento_tarjeta_sip_pct"),
        F.col("event_id"),
    )


SNAP_KEYS = ["productid", "ingesta_date"]
SNAP_ORDER = [desc("precio_regular"), asc("event_id")]


def snapshot(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """SNAP: one row per (product, day) with its consolidated sections."""
    return best_row_per_key(observations(spark, sf_dir, **kw), SNAP_KEYS, SNAP_ORDER,
                            gather={"secciones_origen": "seccion"})


def latest_days(spark: SparkSession, sf_dir: str, n: int = 1) -> list[str]:
    """The ``n`` latest event days, newest first: one aggregate over one column,
    whose values then bound the scan by pushed filters."""
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("d")).distinct()
    return [str(r["d"]) for r in days.orderBy(F.col("d").desc_nulls_last()).limit(n).collect()
            if r["d"] is not None]


def latest_snapshot(spark: SparkSession, sf_dir: str, n: int = 1) -> DataFrame:
    """SNAP of the ``n`` latest days only.  The day is one of the keys, so leaving
    out other days before keeping the best row is the same as after."""
    days = latest_days(spark, sf_dir, n)
    return snapshot(spark, sf_dir, day_from=days[-1], day_to=days[0]).filter(
        F.col("ingesta_date").isin([dt.date.fromisoformat(d) for d in days])) if days \
        else snapshot(spark, sf_dir).limit(0)


# --- NEST ----------------------------------------------------------------------

#: Line items that one task gets when they are dealt by product.  It sorts them as wide
#: records, at 500 to 600 bytes each, and sorts them again where it writes buckets.
TASK_ROWS = 250_000


def product_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Into how many partitions line items are dealt by product: the session's shuffle
    partitions, or more where each of those would get over ``TASK_ROWS``.  The rows are
    counted from the files' footers."""
    rows = table(spark, sf_dir, "lineitem").count()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


def _param(name, value):
    return F.struct(F.lit(name).alias("name"), value.alias("value"))


def catalogue_records(spark: SparkSession, sf_dir: str, by_product: bool = False) -> DataFrame:
    """NEST: landing-shaped catalogue records (keys already normalised).

    ``by_product``: line items are brought together by ``productid`` before they are
    joined and widened, so what follows by product needs no shuffle of wide records.
    Their partitions are as many as the rows ask for (``product_partitions``), and stay
    so: small as they are in the shuffle, joined into larger ones they would spill when
    the wide records are sorted.

    Values are derived from the line item and its part, chosen to exercise
    every branch of the snapshot build: bundle names (``PROMO`` types), empty
    and missing arrays, placeholder sellers and SKUs, unknown channels,
    duplicated labels, malformed release dates, several sections per day.
    """
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    li = li.withColumn("productid", F.col("l_partkey").cast("string"))
    if by_product:
        near = li.repartition(product_partitions(spark, sf_dir), "productid")
        j = near.join(part, F.col("productid") == F.col("p_partkey").cast("string"))
    else:
        j = li.join(part, li.l_partkey == part.p_partkey)
    ln = F.col("l_linenumber")
    r = F.col("l_extendedprice") / F.col("l_quantity")  # the line's unit price
    u = F.col("l_quantity")
    d1 = F.col("l_discount") * r * u
    d2 = F.col("l_tax") * r
    teasers = F.when(
        F.col("l_tax") > 0.04,
        F.array(
            F.struct(F.struct(F.array(_param("Other", F.lit("x")),
                                      _param(K.DISCOUNT_PARAMETER, d1.cast("string")))
                              .alias("parameters")).alias("effects")),
            F.struct(F.struct(F.array(_param(K.DISCOUNT_PARAMETER, d2.cast("string")))
                              .alias("parameters")).alias("effects")),
        )).otherwise(F.array().cast(
            "array<struct<effects:struct<parameters:array<struct<name:string,value:string>>>>>"))
    offer = F.struct(
        r.alias("listprice"),
        (r * (F.lit(1.0) - F.col("l_discount"))).alias("price"),
        (F.col("l_linestatus") == "O").alias("isavailable"),
        u.cast("int").alias("availablequantity"),
        teasers.alias("promotionteasers"))
    seller = F.struct(F.concat(F.lit("Supplier#"), F.col("l_suppkey").cast("string")).alias("sellername"),
                      offer.alias("commertialoffer"))
    item_id = F.concat_ws("-", *[F.col(c).cast("string") for c in
                                 ("l_orderkey", "l_linenumber", "productid", "l_suppkey")])
    item = F.struct(item_id.alias("itemid"), u.alias("unitmultiplier"),
                    F.array(seller).alias("sellers"))
    path = F.when(ln % 2 == 1,
                  F.concat(F.lit("/"), F.col("p_type"), F.lit("/"), F.col("p_brand"), F.lit("/"),
                           F.col("p_size").cast("string"), F.lit("/"))
                  ).otherwise(F.concat(F.lit("/"), F.col("p_type"), F.lit("/"), F.col("p_brand"), F.lit("/")))
    empty = F.array().cast("array<string>")
    labels = (F.when(ln == 1, F.lit(None).cast("array<string>"))
              .when(ln == 2, empty)
              .when(ln == 3, F.array(F.lit(K.LABEL_SODIUM)))
              .when(ln == 4, F.array(*[F.lit(x) for x in (K.LABEL_SUGAR, K.LABEL_SUGAR,
                                                           K.LABEL_SODIUM, K.LABEL_SODIUM)]))
              .when(ln == 5, F.array(F.lit(K.LABEL_SATURATED)))
              .when(ln == 6, F.array(*[F.lit(x) for x in (K.LABEL_SODIUM, K.LABEL_SUGAR,
                                                           K.LABEL_SATURATED)]))
              .otherwise(F.array(*[F.lit(x) for x in (K.LABEL_SODIUM, K.LABEL_SUGAR,
                                                       K.LABEL_SATURATED, "otro")])))
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    channel = (F.when(flag == "R", F.array(F.lit(" supermercado")))
               .when((flag == "A") & (status == "F"), F.array(F.lit("otro")))
               .when(flag == "A", F.array(F.lit("sellercenter ")))
               .otherwise(empty))
    sold_by = (F.when(F.col("l_suppkey") % 3 == 0, F.array(F.lit(" marcas aliadas ")))
               .when(F.col("l_suppkey") % 3 == 1, empty)
               .otherwise(F.array(F.concat(F.lit("Vendor "), (F.col("l_suppkey") % 10).cast("string"),
                                           F.lit(" ")))))
    ref = (F.when(ln % 3 == 0, F.lit("-")).when(ln % 3 == 1, F.lit(""))
           .otherwise(F.concat(F.lit("R"), F.col("productid"))))
    release = F.when(ln == 7, F.lit("not-a-date")).otherwise(
        F.date_format(F.date_sub(F.to_date("l_shipdate"), 30), "yyyy-MM-dd"))
    return j.select(
        "productid",
        ref.alias("productreferencecode"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_type")).alias("productname"),
        F.concat(F.lit(" "), F.col("p_brand"), F.lit(" ")).alias("brand"),
        F.regexp_extract("p_brand", r"(\d+)", 1).alias("brandid"),
        F.col("p_size").cast("string").alias("categoryid"),
        F.array(path).alias("categories"),
        F.array(item).alias("items"),
        labels.alias("tipodeoctogono"),
        channel.alias("canal_venta"),
        F.array(F.lower("p_type")).alias("tipo_especifico_producto"),
        F.when(flag == "R", F.array(F.lit("Si"))).when(flag == "A", F.array(F.lit("No")))
        .otherwise(empty).alias("tag_stock_tienda"),
        F.when(ln % 2 == 0, F.array(F.lit("Sí"))).otherwise(F.array(F.lit("No"))).alias("tag_stock_cd"),
        F.when(status == "O", F.array(F.lit(K.HOME_DELIVERY), F.lit(K.STORE_PICKUP)))
        .otherwise(F.array(F.lit(K.STORE_PICKUP))).alias("tipo_de_envio"),
        sold_by.alias("vendido_por"),
        release.alias("releasedate"),
        F.concat(F.lit("sec-"), ln.cast("string")).alias("seccion"),
        F.to_date("l_shipdate").alias("ingesta_date"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("batch_id"),
    )
