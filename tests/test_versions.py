"""Tables published a version at a time: crashes, concurrent writers, type changes."""

import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import publish_file, read_text
from shelfwise.sources import catalog as CT
from shelfwise.sources import tables as TB
from shelfwise.sources import versions as V

L, D, S, I = T.LongType(), T.DoubleType(), T.StringType(), T.IntegerType()


def rows(spark, data, schema="k long, v string, day string"):
    return spark.createDataFrame(data, schema)


def got(df):
    return sorted(tuple(r) for r in df.collect())


class Killed(Exception):
    pass


def die(*_):
    raise Killed


@pytest.mark.parametrize("write", ["replace", "overwrite", "append", "partition"])
def test_a_crash_before_publication_leaves_the_old_rows(spark, scratch, monkeypatch, write):
    path = scratch("crash")
    old = [(1, "a", "d1"), (2, "b", "d2")]
    TB.overwrite_table(rows(spark, old), path, ["day"])
    new = rows(spark, [(9, "z", "d1")])
    todo = {"replace": lambda: TB.replace_partitions(new, path, ["day"]),
            "overwrite": lambda: TB.overwrite_table(new, path, ["day"]),
            "append": lambda: TB.append_table(new, path, ["day"]),
            "partition": lambda: TB.overwrite_partition(new.drop("day"), path, "day", "d1")}[write]
    with monkeypatch.context() as m:
        m.setattr(V, "publish_file", die)
        with pytest.raises(Killed):
            todo()
    assert got(TB.read_table(spark, path)) == old
    todo()  # the rerun
    want = {"replace": [(2, "b", "d2"), (9, "z", "d1")], "overwrite": [(9, "z", "d1")],
            "append": [*old, (9, "z", "d1")], "partition": [(2, "b", "d2"), (9, "z", "d1")]}[write]
    assert got(TB.read_table(spark, path)) == want


def test_a_reader_keeps_its_version_while_others_write(spark, scratch):
    path = scratch("reader")
    TB.overwrite_table(rows(spark, [(1, "a", "d1")]), path, ["day"])
    before = TB.read_table(spark, path)
    TB.overwrite_table(rows(spark, [(2, "b", "d1")]), path, ["day"])
    assert got(before) == [(1, "a", "d1")] and got(TB.read_table(spark, path)) == [(2, "b", "d1")]
    assert got(TB.read_table(spark, path, version=1)) == [(1, "a", "d1")]


def test_writers_of_one_partition_collide_and_others_do_not(spark, scratch):
    path = scratch("writers")
    TB.overwrite_table(rows(spark, [(1, "a", "d1"), (2, "b", "d2")]), path, ["day"])
    base = V.current(spark, path)
    one, two = (V.stage(rows(spark, [(k, "n", "d1")]), path, ["day"]) for k in (3, 4))
    other = V.stage(rows(spark, [(5, "n", "d2")]), path, ["day"])
    V.commit(spark, path, one, "replace", base=base)
    with pytest.raises(V.ConcurrentWriteError, match="day=d1"):
        V.commit(spark, path, two, "replace", base=base)
    V.commit(spark, path, other, "replace", base=base)
    assert got(TB.read_table(spark, path)) == [(3, "n", "d1"), (5, "n", "d2")]


def test_appends_at_the_same_time_are_all_kept(spark, scratch):
    path = scratch("appends")
    TB.create_if_missing(spark, path, rows(spark, []).schema, ["day"])
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: TB.append_table(rows(spark, [(k, "x", "d1")]), path, ["day"]), range(6)))
    assert [r[0] for r in got(TB.read_table(spark, path))] == list(range(6))
    assert V.versions(spark, path) == list(range(1, 8))


def test_only_one_of_many_creates_a_file(spark, scratch):
    path = f"{scratch('one')}/lease"
    gate = threading.Barrier(8)

    def create(k):
        gate.wait()
        return publish_file(spark, path, f"from {k}")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(create, range(8)))
    assert sum(won) == 1 and read_text(spark, path) == f"from {won.index(True)}"
    assert os.listdir(os.path.dirname(path.removeprefix("file:"))) == ["lease"]


def test_empty_partitions_clear_and_unknown_ones_do_nothing(spark, scratch):
    path = scratch("clear")
    TB.overwrite_table(rows(spark, [(1, "a", "d1"), (2, "b", "d2")]), path, ["day"])
    TB.overwrite_partitions(rows(spark, [(3, "c", "d3")]), path, "day", ["d1", "d3", "d9"])
    assert got(TB.read_table(spark, path)) == [(2, "b", "d2"), (3, "c", "d3")]
    TB.drop_partitions(spark, path, "day", ["d2", "nothing"])
    assert got(TB.read_table(spark, path)) == [(3, "c", "d3")]
    assert got(TB.read_table(spark, path, only=("day", ["d1"]))) == []
    assert TB.latest_partition_value(spark, path, "day") == "d3"


def test_vacuum_deletes_what_no_kept_version_needs(spark, scratch):
    path = scratch("vacuum")
    for k in range(4):
        TB.replace_partitions(rows(spark, [(k, "x", "d1")]), path, ["day"])
    V.stage(rows(spark, [(9, "lost", "d1")]), path, ["day"])  # a writer that died
    assert V.vacuum(spark, path, keep=2) == []  # too young, all of them
    assert len(V.vacuum(spark, path, keep=2, older_than_hours=-1)) == 3
    assert V.versions(spark, path) == [3, 4] or len(V.versions(spark, path)) == 2
    assert got(TB.read_table(spark, path)) == [(3, "x", "d1")]
    assert got(TB.read_table(spark, path, version=V.versions(spark, path)[0])) == [(2, "x", "d1")]


def test_folders_of_others_are_read_and_not_written(spark, scratch):
    path = scratch("plain")
    rows(spark, [(1, "a", "d1")]).write.parquet(path)
    assert TB.table_exists(spark, path) and got(TB.read_table(spark, path)) == [(1, "a", "d1")]
    with pytest.raises(V.NotVersionedError):
        TB.append_table(rows(spark, [(2, "b", "d2")]), path)


def test_partitioning_cannot_change_by_an_append(spark, scratch):
    path = scratch("parted")
    TB.overwrite_table(rows(spark, [(1, "a", "d1")]), path, ["day"])
    with pytest.raises(ValueError, match="partitioned"):
        TB.append_table(rows(spark, [(2, "b", "d2")]), path)
    TB.overwrite_table(rows(spark, [(2, "b", "d2")]), path)
    assert got(TB.read_table(spark, path)) == [(2, "b", "d2")]


@pytest.mark.parametrize("a, b, both", [
    (I, L, L), (L, I, L), (I, D, D), (L, S, S), (T.BooleanType(), I, S), (T.NullType(), D, D),
    (L, T.FloatType(), D), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()), (T.DateType(), L, S),
    (T.DecimalType(10, 2), T.DecimalType(12, 4), T.DecimalType(12, 4)), (T.DecimalType(10, 2), L, D),
    (T.DecimalType(38, 2), T.DecimalType(38, 10), D),
    (T.ArrayType(I), T.ArrayType(S), T.ArrayType(S)), (T.ArrayType(I), S, S),
    (T.MapType(S, I), T.MapType(S, L), T.MapType(S, L)),
    (T.StructType([T.StructField("a", I)]), T.StructType([T.StructField("A", L), T.StructField("b", S)]),
     T.StructType([T.StructField("a", L), T.StructField("b", S)])),
])
def test_the_narrowest_type_for_both(a, b, both):
    assert V.promote(a, b) == both
    if not isinstance(a, T.StructType):
        assert V.promote(b, a) == both
    assert V.promote(both, a) == both and V.promote(both, b) == both


def test_batches_of_different_types_read_as_one(spark, scratch):
    path = scratch("types")
    batches = [("d1", "k long, p int, s struct<a:int>, l array<int>", [(1, 10, (1,), [1, 2])]),
               ("d2", "k long, p double, s struct<a:string,b:int>, l array<string>", [(2, 1.5, ("x", 5), ["y"])]),
               ("d3", "k long, p string", [(3, "free")]), ("d4", "k long, p date", [(4, None)])]
    for day, schema, data in batches:
        TB.replace_partitions(spark.createDataFrame(data, schema).withColumn("day", F.lit(day)), path, ["day"])
    df = TB.read_table(spark, path).select("k", "p", "s", "l")
    assert dict(df.dtypes) == {"k": "bigint", "p": "string", "s": "struct<a:string,b:int>", "l": "array<string>"}
    assert [tuple(r) for r in df.orderBy("k").collect()] == [
        (1, "10", ("1", None), ["1", "2"]), (2, "1.5", ("x", 5), ["y"]), (3, "free", None, None), (4, None, None, None)]
    # one partition by itself has the types it was written with
    assert dict(TB.read_partition(spark, path, "day", "d1").dtypes)["p"] == "int"


def test_filters_reach_the_files_of_every_write(spark, scratch):
    path = scratch("pushed")
    for day in ("d1", "d2"):
        TB.replace_partitions(rows(spark, [(1, "a", day)]), path, ["day"])
    plan = TB.read_table(spark, path).filter("k = 1 AND day = 'd1'") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,1)" in plan and "PartitionFilters: [isnotnull(day" in plan


def test_compacted_partitions_hold_the_same_rows_in_one_write(spark, scratch):
    path = scratch("compact")
    for k in range(3):
        TB.append_table(rows(spark, [(k, "x", "d1"), (k, "y", f"d{k + 2}")]), path, ["day"])
    before = got(TB.read_table(spark, path))
    now = V.compact(spark, path)
    assert {len(ws) for ws in now.parts.values()} == {1} and got(TB.read_table(spark, path)) == before
    assert V.compact(spark, path).number == now.number  # nothing left to do


def test_names_in_a_schema(spark, scratch):
    folder = scratch("schema")
    name = "s_" + folder[-12:]
    assert CT.create_schema(spark, name, folder) and not CT.create_schema(spark, name, folder)
    schema = rows(spark, []).schema
    with CT.use_schema(spark, name):
        assert not CT.table_exists(spark, "t")
        assert CT.create_table(spark, "t", schema, f"{folder}/t", partition_by=["day"])
        CT.insert_select(spark, "t", spark.createDataFrame([("d1", "7")], "day string, k string"))
        with pytest.raises(ValueError, match="no columns"):
            CT.insert_select(spark, "t", spark.createDataFrame([(1,)], "other int"))
        assert CT.table_exists(spark, "t")
    assert spark.catalog.currentDatabase() != name
    assert got(spark.table(f"{name}.t")) == [(7, None, "d1")]
    with pytest.raises(NumberFormatException):
        CT.insert_select(spark, f"{name}.t", spark.createDataFrame([("d1", "x")], "day string, k string"))
    with pytest.raises(ValueError, match="not a table name"):
        CT.create_table(spark, "a b; DROP", schema, folder)


def test_a_name_over_odd_partition_values(spark, scratch):
    folder = scratch("odd")
    name = "s_" + folder[-12:]
    CT.create_schema(spark, name, folder)
    data = [(1, "a", "it's"), (2, "b", "x/y:z"), (3, "c", None), (4, "d", "é =%")]
    TB.overwrite_table(rows(spark, data), f"{folder}/t", ["day"])
    CT.name_version(spark, f"{name}.t", f"{folder}/t")
    assert sorted(map(tuple, spark.table(f"{name}.t").collect())) == data
    assert got(TB.read_table(spark, f"{folder}/t")) == data


def test_the_latest_batch_is_pruned_at_run_time(spark, scratch):
    from shelfwise.plans import analytics as A
    path = scratch("pruned")
    df = spark.range(60).select("id", F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("id") % 20).cast("int"))
                                .alias("ingesta_date"))
    TB.overwrite_table(df, path, ["ingesta_date"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = A.latest_batch_rows(TB.read_table(spark, path))
        assert sorted(r.id for r in out.collect()) == [19, 39, 59]
        plan = out._jdf.queryExecution().executedPlan()  # noqa: SLF001 - test introspection
        assert "dynamicpruning" in plan.toString()
        leaves = plan.collectLeaves()
        read = [leaves.apply(i).metrics().get("numPartitions") for i in range(leaves.size())]
        assert [m.get().value() for m in read if m.isDefined()][0] == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
