"""The snapshot of the registry: line items are shuffled by product while they are
narrow, and the wide records are deduplicated where they then lie."""

import re

import pytest
from pyspark.sql import functions as F

from shelfwise.operators.dedup import asc, best_row_per_key, desc
from shelfwise.plans import bindings as B
from shelfwise.plans import gold as G
from shelfwise.plans import registry
from shelfwise.plans import silver as S
from shelfwise.plans import star as ST
from shelfwise.plans.bindings import catalogue_records
from shelfwise.plans.q_silver import snapshot_of

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001 - test introspection


def shuffles(text: str) -> list[str]:
    return re.findall(r"Exchange (?:hash|range)partitioning\(([a-z_]+)", text)


@pytest.fixture(params=["10m", "-1"], ids=["broadcast", "no broadcast"])
def threshold(spark, request):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.set(name, before)


def test_the_snapshot_shuffles_line_items_only(spark, threshold):
    text = plan(snapshot_of(spark, SF))
    assert shuffles(text).count("productid") == 1
    # what is shuffled are the scanned tables, below every record that is made from them
    assert len(shuffles(text)) == (1 if threshold == "10m" else 2)
    assert text.index("Window") < text.index("Exchange")


def test_bucketing_and_grouping_by_product_need_no_further_shuffle(spark, threshold):
    one = len(shuffles(plan(snapshot_of(spark, SF))))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(shuffles(plan(snapshot_of(spark, SF).repartition(n, "productid")))) == one
    registry.load_all()
    assert len(shuffles(plan(registry.QUERIES["dim_product"](spark, SF)))) == one


def test_by_product_and_window_give_the_rows_of_the_plain_build(spark):
    plain = catalogue_records(spark, SF)
    near = catalogue_records(spark, SF, by_product=True)
    assert near.schema == plain.schema
    assert near.exceptAll(plain).isEmpty() and plain.exceptAll(near).isEmpty()
    old, new = S.build_silver(plain), snapshot_of(spark, SF)
    assert old.schema.names == new.schema.names
    assert old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty()


@pytest.mark.parametrize("order", [[desc("p"), asc("s")], [desc("s"), asc("p")]], ids=["min", "max"])
def test_ties_are_broken_alike_by_window_and_aggregate(spark, order):
    rows = [(k, 1.0, "a", pay, sec) for k in (1, 2, None) for pay in ("z", None, "b", "m")
            for sec in ("s2", "s1", None)]
    df = spark.createDataFrame(rows + rows, "k int, p double, s string, pay string, sec string").repartition(3)
    a, w = (best_row_per_key(df, ["k"], order, gather={"secs": "sec"}, method=m).collect()
            for m in ("aggregate", "window"))
    assert sorted(map(str, a)) == sorted(map(str, w)) and len(a) == 3


def test_the_window_form_sorts_once(spark):
    df = spark.range(9).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"),
                               F.col("id").cast("string").alias("s"))
    text = plan(best_row_per_key(df, ["k"], [desc("v")], gather={"ss": "s"}, method="window"))
    assert text.count("Sort [") == 1 and text.count("Window [") == 1


def test_a_star_query_loads_its_own_star(spark, monkeypatch):
    loaded, write = [], ST.write_star
    monkeypatch.setattr(ST, "write_star", lambda *a, **kw: loaded.append(1) or write(*a, **kw))
    registry.load_all()
    rows = [registry.QUERIES["star_stockout_by_category"](spark, SF).collect() for _ in range(2)]
    assert loaded == [1, 1] and rows[0] == rows[1]


@pytest.fixture()
def tables(spark, scratch):
    """600 line items of 40 products, and their parts."""
    d = scratch("tables")
    i = F.col("id")
    spark.range(600).select(
        (i % 40).alias("l_partkey"), i.alias("l_orderkey"), (i % 7 + 1).cast("int").alias("l_linenumber"),
        (i % 9).alias("l_suppkey"), (i % 5 + 1).cast("double").alias("l_quantity"),
        (i * 10.0).cast("double").alias("l_extendedprice"), F.lit(0.1).alias("l_discount"),
        F.lit(0.05).alias("l_tax"), F.lit("R").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(cast(id % 6 as int))").alias("l_shipdate"),
    ).write.parquet(f"{d}/lineitem.parquet")
    spark.range(40).select(
        i.alias("p_partkey"), F.concat(F.lit("part "), i.cast("string")).alias("p_name"),
        F.lit("Brand#12").alias("p_brand"), F.lit("SMALL TIN").alias("p_type"),
        (i % 3).cast("int").alias("p_size")).write.parquet(f"{d}/part.parquet")
    return d


def sizes(df) -> list[int]:
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_partitions_of_the_snapshot_grow_with_the_line_items(spark, tables, monkeypatch):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert B.product_partitions(spark, tables) == n
    few = catalogue_records(spark, tables, by_product=True)
    monkeypatch.setattr(B, "TASK_ROWS", 25)
    assert B.product_partitions(spark, tables) == 24 > n
    many = catalogue_records(spark, tables, by_product=True)
    # nothing is joined into larger partitions, though all of it is a few KB
    assert few.rdd.getNumPartitions() == n and many.rdd.getNumPartitions() == 24
    assert max(sizes(many)) < max(sizes(few))
    old, new = S.build_silver(few, method="window"), S.build_silver(many, method="window")
    assert new.count() > 40 and old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty()


def test_a_star_with_more_buckets_is_still_written_where_the_snapshot_lies(spark, tables, monkeypatch, threshold):
    monkeypatch.setattr(B, "TASK_ROWS", 25)
    n = B.product_partitions(spark, tables)
    asked, write = [], ST.write_star
    monkeypatch.setattr(ST, "write_star", lambda *a, **kw: asked.append(write(*a, **kw)) or asked[-1])
    registry.load_all()
    fact = registry.QUERIES["fact_load"](spark, tables)
    assert len(shuffles(plan(snapshot_of(spark, tables).repartition(n, "productid")))) \
        == len(shuffles(plan(snapshot_of(spark, tables))))
    assert f"into {n} buckets" in asked[0].spark.sql(
        f"show create table {asked[0].schema}.silver").first()[0].lower()
    load = plan(G.fact_rows(asked[0].silver, asked[0].dims()))
    assert "productid" not in shuffles(load)
    assert fact.count() == asked[0].silver.filter("coalesce(num_octogonos, 0) between 0 and 3").count() > 0
