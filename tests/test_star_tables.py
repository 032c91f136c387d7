"""The star as bucketed tables: the product side is joined where it lies."""

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import gold as G
from shelfwise.plans import silver as S
from shelfwise.plans import star as ST
from shelfwise.plans.bindings import catalogue_records

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def star(spark):
    return ST.write_star(spark, S.build_silver(catalogue_records(spark, SF)), buckets=4)


@pytest.fixture()
def no_broadcast(spark):
    """As with tables too large for it."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001 - test introspection


def test_load_joins_the_product_dimension_without_an_exchange(star, no_broadcast):
    joined = star.silver.join(star.dims()["producto"].select("productid", "producto_key"), "productid")
    plan = executed(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan


def test_analysis_joins_the_product_dimension_without_an_exchange(star, no_broadcast):
    dim = star.dims(by_key=True)["producto"].select("producto_key", "productname")
    plan = executed(star.fact.join(dim, "producto_key"))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    # counting by product needs none either
    assert "Exchange" not in executed(star.fact.join(dim, "producto_key").groupBy("producto_key").count())


def test_the_whole_star_view_moves_the_fact_for_the_category_alone(star, no_broadcast):
    plan = executed(G.star_view(star.fact, star.dims(by_key=True)))
    assert plan.count("hashpartitioning(producto_key") == 0


def test_rows_and_keys_are_those_of_the_plain_load(star, spark):
    fact = star.fact
    dims = star.dims()
    assert fact.count() == G.fact_rows(star.silver, dims).count()
    for name, (key, natural, builder) in G.DIMENSIONS.items():
        d = dims[name]
        n = builder(star.silver).count()
        row = d.agg(F.count("*"), F.count_distinct(key), F.min(key), F.max(key)).first()
        assert tuple(row) == (n, n, 1, n)
    both = star.dims(by_key=True)["producto"]
    assert both.exceptAll(dims["producto"].select(*both.columns)).isEmpty()
    assert fact.join(both, "producto_key", "left_anti").isEmpty()


def test_the_star_of_a_source_is_written_once(spark, monkeypatch):
    calls = []

    def snapshot():
        calls.append(1)
        return S.build_silver(catalogue_records(spark, SF))
    monkeypatch.setattr(ST, "_WRITTEN", {})
    one, two = ST.star_of(spark, SF, snapshot), ST.star_of(spark, SF + "/", snapshot)
    assert one is two and calls == [1]
    from shelfwise.session import delete_path
    delete_path(spark, f"{one.folder}/fact")  # someone cleared the scratch folder
    assert ST.star_of(spark, SF, snapshot) is not one and calls == [1, 1]


def test_an_empty_snapshot_gives_an_empty_star(spark):
    star = ST.write_star(spark, S.build_silver(catalogue_records(spark, SF)).limit(0), buckets=2)
    assert star.fact.count() == 0 and star.dims()["producto"].count() == 0
    assert star.dims()["etiquetado"].count() == 32
