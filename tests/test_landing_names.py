"""Landing files by their real names, keys that differ by case, replayed micro-batches."""

import json
import os

from pyspark.sql import functions as F

from shelfwise.session import subpaths
from shelfwise.sources import landing as L
from shelfwise.sources import tables as TB
from shelfwise.sources import versions as V
from shelfwise.streaming.landing_stream import start_silver_stream, upsert_epoch


def write(base, batch, name, rows):
    d = f"{base}/batch_id={batch}"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/{name}.json", "w", encoding="utf-8") as f:
        json.dump(rows, f, ensure_ascii=False)


def test_keys_that_differ_by_case_are_read_record_by_record(spark, scratch):
    base = scratch("case")
    write(base, "2024-06-01", "a", [{"id": 1, "Tag Stock": "x", "tag stock": "y"}, {"id": 2, "TAG STOCK": "z"}])
    write(base, "2024-06-01", "b", [{"id": 3, "Tag Stock": "w", "TAG STOCK": None, "Other": {"k": 1}}])
    write(base, "2024-06-02", "a", [{"id": 4}])
    got = {r.id: (r.tag_stock, r.seccion, r.batch_id) for r in L.read_landing(spark, base).collect()}
    assert got == {1: ("y", "a", "2024-06-01"), 2: ("z", "a", "2024-06-01"), 3: ("w", "b", "2024-06-01"),
                   4: (None, "a", "2024-06-02")}
    assert [tuple(r) for r in L.colliding_counts(spark, base).collect()] == [
        ("tag_stock", ["TAG STOCK", "Tag Stock", "tag stock"], 3, 1)]
    assert L.colliding_counts(spark, base, batch_id="2024-06-02").count() == 0
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


def test_a_broken_file_among_keys_that_differ_by_case(spark, scratch):
    base = scratch("broken")
    write(base, "2024-06-01", "a", [{"K": 1, "k": 2}])
    with open(f"{base}/batch_id=2024-06-01/b.json", "w") as f:
        f.write('[{"K": 3')
    try:
        L.read_landing(spark, base).collect()
        raise AssertionError("read")
    except Exception as e:
        assert "does not parse" in str(e)
    assert [r.k for r in L.read_landing(spark, base, on_error="divert").collect()] == [2]
    assert L.landing_rejects(spark, base).count() == 1


def test_sections_take_the_names_of_their_files(spark, scratch):
    written, base = scratch("parts"), scratch("named")
    df = spark.range(25).select(F.col("id").alias("Id"), F.lit("2024-06-01").alias("batch_id"),
                                F.when(F.col("id") < 20, "fresh 2.0").otherwise("dairy").alias("seccion"))
    L.write_landing(df, written, id_col="Id", chunk_rows=10)
    n = L.publish_landing(spark, written, base)
    names = subpaths(spark, f"{base}/batch_id=2024-06-01")
    assert len(names) == n and "dairy.json" in names
    got = L.read_landing(spark, base)
    assert sorted(r.id for r in got.collect()) == list(range(25))
    assert {r.seccion for r in L.landing_files(spark, base).collect()} == {"fresh 2.0", "dairy"}
    assert {r.seccion: r["count"] for r in got.groupBy("seccion").count().collect()} == {
        r.seccion: r["count"] for r in df.groupBy("seccion").count().collect()}
    # a second delivery of a section takes the place of the first
    again = scratch("again")
    L.write_landing(df.filter("Id = 24"), again, id_col="Id")
    L.publish_landing(spark, again, base)
    assert sorted(r.id for r in L.read_landing(spark, base).collect()) == [*range(20), 24]


def build(rows):
    return rows.select(F.col("id").alias("productid"), F.to_date("batch_id").alias("day"), "batch_id",
                       F.col("price").cast("double").alias("price"), F.current_timestamp().alias("touched"))


def test_a_replayed_micro_batch_changes_nothing(spark, scratch):
    base, bronze, silver, ckpt = (scratch(x) for x in ("landing", "bronze", "silver", "ckpt"))
    write(base, "2024-06-01", "a", [{"id": 1, "price": 1.0}, {"id": 2, "price": 2.0}])

    def run():
        q = start_silver_stream(spark, base, bronze, silver, ckpt, build=build, keys=["productid", "day"],
                                partition_col="day")
        q.awaitTermination()

    def rows():
        return sorted((r.productid, str(r.day), r.price) for r in TB.read_table(spark, silver).collect())
    run()
    first = rows()
    write(base, "2024-06-02", "a", [{"id": 1, "price": 3.0}])
    run()
    assert first == [(1, "2024-06-01", 1.0), (2, "2024-06-01", 2.0)]
    assert rows() == [*first[:1], (1, "2024-06-02", 3.0), first[1]]
    now = V.current(spark, silver)
    assert len(now.epochs) == 1 and list(now.epochs.values()) == [1]
    stream, = now.epochs
    args = (spark, base, bronze, silver, ["2024-06-02"])
    for epoch in (0, 1):  # as after a crash between the upsert and the stream's own commit
        assert not upsert_epoch(*args, (stream, epoch), build, ["productid", "day"], "day")
    assert V.current(spark, silver).number == now.number
    assert upsert_epoch(*args, (stream, 2), build, ["productid", "day"], "day")
    assert V.current(spark, silver).epochs == {stream: 2}
