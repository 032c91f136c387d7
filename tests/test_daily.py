"""The daily batch end to end on hand-written landing folders."""

import json
import os

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas as SC
from shelfwise.plans import daily as DY
from shelfwise.sources import tables as TB


def offer(price, teasers=()):
    return {"ListPrice": price, "Price": price, "IsAvailable": True, "AvailableQuantity": 2,
            "PromotionTeasers": [{"effects": {"parameters": [
                {"name": "PromotionalPriceTableItemsDiscount", "value": str(t)}]}} for t in teasers]}


def product(pid, price, *, name="Arroz", brand="7", cat="/Abarrotes/Arroz/Blanco/", teasers=(),
            labels=()):
    return {"productId": pid, "productReferenceCode": f"R{pid}", "productName": name,
            "brand": "Marca", "brandId": brand, "categoryId": "3", "categories": [cat],
            "items": [{"itemId": f"I{pid}", "unitMultiplier": 1.0,
                       "sellers": [{"sellerName": "S", "commertialOffer": offer(price, teasers)}]}],
            "Tipo de Producto": ["supermercado"], "Tipo De Producto": ["abarrotes"],
            "tipoDeOctogono": list(labels), "Tag Stock Tienda": ["Sí"], "Tag Stock CD": [],
            "Tipo de envío": ["Despacho a domicilio"], "Vendido por": [],
            "releaseDate": "2024-01-01"}


def write(base, batch, section, rows):
    d = f"{base}/batch_id={batch}"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/{section}.json", "w", encoding="utf-8") as f:
        json.dump(rows, f, ensure_ascii=False)


def test_two_batches_end_to_end_and_rerun(spark, scratch):
    landing, lake = scratch("landing"), DY.Lake(scratch("lake"))
    write(landing, "2024-06-01", "abarrotes", [product("1", 10.0), product("2", 5.0, teasers=[1])])
    write(landing, "2024-06-01", "ofertas", [product("2", 5.0, teasers=[1], cat="/Abarrotes/"),
                                             product("9", 3.0, name="Pack x6")])
    write(landing, "2024-06-02", "abarrotes", [product("1", 11.0), product("3", 2.0, brand="8"),
                                               product("4", 1.0, labels=["a", "b", "c", "d"])])
    assert DY.run_pending(spark, landing, lake) == ["2024-06-01", "2024-06-02"]
    assert DY.next_batch_id(spark, landing, lake) is None

    # The second batch's teaser lists are all empty (inferred array<string>);
    # widened with the bronze schema, the whole bronze table still merges.
    assert TB.read_table(spark, lake.bronze, merge_schema=True).count() == 7

    ctl = {r.batch_id: r.status for r in DY.read_control(spark, lake).collect()}
    assert ctl == {"2024-06-01": "COMPLETED", "2024-06-02": "COMPLETED"}

    silver = TB.read_table(spark, lake.silver, SC.SILVER)
    got = sorted((r.productid, str(r.ingesta_date), r.precio_regular, r.secciones_origen)
                 for r in silver.collect())
    assert got == [("1", "2024-06-01", 10.0, ["abarrotes"]), ("1", "2024-06-02", 11.0, ["abarrotes"]),
                   ("2", "2024-06-01", 5.0, ["abarrotes", "ofertas"]),
                   ("3", "2024-06-02", 2.0, ["abarrotes"]), ("4", "2024-06-02", 1.0, ["abarrotes"])]

    # Latest batch from the file listing: same rows as the max over the data.
    from shelfwise.plans import analytics as A
    latest = TB.latest_partition(spark, lake.silver, "ingesta_date", "date")
    assert str(latest.first().ingesta_date) == "2024-06-02"
    kpi_listing = A.latest_batch_kpis(silver, latest=latest).first()
    assert kpi_listing == A.latest_batch_kpis(silver).first()
    assert kpi_listing.total_productos == 3
    day = TB.latest_partition_value(spark, lake.silver, "ingesta_date", "date")
    assert A.latest_batch_kpis(silver, latest=day).first() == kpi_listing
    plan = A.latest_batch_kpis(silver, latest=day)._jdf.queryExecution() \
        .executedPlan().toString()  # noqa: SLF001 - plan introspection
    assert "PartitionFilters: [isnotnull(ingesta_date" in plan  # only that partition is read

    fact = TB.read_table(spark, lake.fact, SC.FACT)
    audit = TB.read_table(spark, lake.audit, SC.AUDIT)
    assert fact.count() == 4 and audit.count() == 1   # 4 labels miss the junk dimension
    assert [r.motivos for r in audit.collect()] == [["etiquetado"]]
    brands = {r.brandid: r.marca_key for r in TB.read_table(spark, lake.dim("marca")).collect()}
    assert brands == {"7": 1, "8": 2}
    products = TB.read_table(spark, lake.dim("producto"))
    assert products.count() == 4 and products.select("producto_key").distinct().count() == 4

    assert "fact" in DY.register_views(spark, lake)
    kpi = spark.sql("""SELECT COUNT(*) AS n FROM fact f JOIN dim_fecha d ON f.fecha_key = d.fecha_key
                       WHERE d.fecha = (SELECT max(fecha) FROM dim_fecha)""").first().n
    assert kpi == 2

    # Incremental price moves equal the LAG form over the silver history.
    from shelfwise.plans import analytics as A2
    want = sorted(map(tuple, A2.price_moves(silver).select(
        "productid", "fecha", "precio_anterior", "precio_actual").collect()))
    moves_path = lake.path("gold/price_moves")
    got = sorted(map(tuple, TB.read_table(spark, moves_path).select(
        "productid", F.to_date("fecha").alias("fecha"), "precio_anterior", "precio_actual").collect()))
    assert got == want == [("1", __import__("datetime").date(2024, 6, 2), 10.0, 11.0)]

    # Rerun of a completed batch: same tables (idempotent), keys unchanged.
    keys_before = sorted(map(tuple, products.collect()))
    created = silver.filter(F.col("productid") == "3").first().created_timestamp
    DY.run_daily_batch(spark, landing, lake, "2024-06-02")
    assert TB.read_table(spark, lake.fact, SC.FACT).count() == 4
    assert sorted(map(tuple, TB.read_table(spark, lake.dim("producto")).collect())) == keys_before
    again = TB.read_table(spark, lake.silver, SC.SILVER).filter(F.col("productid") == "3").first()
    assert again.created_timestamp == created and again.updated_timestamp >= created
    again_moves = sorted(map(tuple, TB.read_table(spark, moves_path).select(
        "productid", F.to_date("fecha").alias("fecha"), "precio_anterior", "precio_actual").collect()))
    assert again_moves == got


def moves_of(spark, lake):
    return sorted(map(tuple, TB.read_table(spark, lake.path("gold/price_moves")).select(
        "productid", F.to_date("fecha").alias("fecha"), "precio_anterior", "precio_actual").collect()))


def test_a_late_batch_loads_and_corrects_the_next_day(spark, scratch):
    landing, lake = scratch("landing"), DY.Lake(scratch("lake"))
    write(landing, "2024-06-02", "abarrotes", [product("1", 11.0), product("2", 5.0)])
    assert DY.run_pending(spark, landing, lake) == ["2024-06-02"]
    write(landing, "2024-06-01", "abarrotes", [product("1", 10.0), product("3", 4.0)])
    write(landing, "2024-06-03", "abarrotes", [product("1", 12.0), product("2", 5.0), product("3", 6.0)])
    assert DY.run_pending(spark, landing, lake) == ["2024-06-01", "2024-06-03"]
    from shelfwise.plans import analytics as A
    silver = TB.read_table(spark, lake.silver, SC.SILVER)
    want = sorted(map(tuple, A.price_moves(silver).select(
        "productid", "fecha", "precio_anterior", "precio_actual").collect()))
    assert moves_of(spark, lake) == want and len(want) == 3
    DY.run_daily_batch(spark, landing, lake, "2024-06-01")  # again, late once more
    assert moves_of(spark, lake) == want


def test_an_unfinished_price_state_is_not_read(spark, scratch):
    landing, lake = scratch("landing"), DY.Lake(scratch("lake"))
    write(landing, "2024-06-01", "abarrotes", [product("1", 10.0)])
    write(landing, "2024-06-02", "abarrotes", [product("1", 11.0)])
    DY.run_pending(spark, landing, lake)
    folder = f"{lake.path('gold/last_prices')}/as_of=2024-06-02"
    os.makedirs(f"{folder}/v000009")  # as a crash in the middle of a write would leave it
    DY.run_daily_batch(spark, landing, lake, "2024-06-02")
    assert [(m[0], m[2], m[3]) for m in moves_of(spark, lake)] == [("1", 10.0, 11.0)]
    assert len(os.listdir(folder)) == 1


def test_a_failing_rerun_is_failed_and_does_not_hold_up_others(spark, scratch):
    landing, lake = scratch("landing"), DY.Lake(scratch("lake"))
    write(landing, "2024-06-01", "abarrotes", [product("1", 10.0)])
    DY.run_pending(spark, landing, lake)
    with open(f"{landing}/batch_id=2024-06-01/abarrotes.json", "w") as f:
        f.write('[{"productId": "1"')
    with pytest.raises(Exception):
        DY.run_daily_batch(spark, landing, lake, "2024-06-01")
    assert DY.read_control(spark, lake).first().status == "FAILED"
    write(landing, "2024-06-02", "abarrotes", [product("1", 11.0)])
    with pytest.raises(DY.PendingBatchesFailed, match="2024-06-01"):
        DY.run_pending(spark, landing, lake)
    assert {r.batch_id: r.status for r in DY.read_control(spark, lake).collect()} == {
        "2024-06-01": "FAILED", "2024-06-02": "COMPLETED"}


def test_a_batch_waits_for_all_its_sections(spark, scratch):
    landing, lake = scratch("landing"), DY.Lake(scratch("lake"))
    write(landing, "2024-06-01", "abarrotes", [product("1", 10.0)])
    need = ["abarrotes", "bebidas"]
    with pytest.raises(DY.PendingBatchesFailed, match="bebidas"):
        DY.run_pending(spark, landing, lake, expected_sections=need)
    assert "bebidas" in DY.read_control(spark, lake).first().error_message
    assert not TB.table_exists(spark, lake.bronze)
    write(landing, "2024-06-01", "bebidas", [product("2", 3.0)])
    counts = DY.run_daily_batch(spark, landing, lake, "2024-06-01", expected_sections=need)
    assert counts == {"bronze": 2, "silver": 2, "fact": 2, "audit": 0}


@pytest.mark.parametrize("broken", ['[{"productId": "2"}, {"productId"', "no json at all"])
def test_a_truncated_file_fails_the_batch(spark, scratch, broken):
    landing, lake = scratch("landing"), DY.Lake(scratch("lake"))
    write(landing, "2024-06-01", "abarrotes", [product("1", 10.0)])
    with open(f"{landing}/batch_id=2024-06-01/bebidas.json", "w") as f:
        f.write(broken)
    with pytest.raises(Exception):
        DY.run_daily_batch(spark, landing, lake, "2024-06-01")
    assert DY.read_control(spark, lake).first().status == "FAILED"


def test_scratch_files_go_when_a_batch_is_done(spark, scratch):
    from shelfwise.session import checkpoint_root
    landing, lake = scratch("landing"), DY.Lake(scratch("lake"))
    write(landing, "2024-06-01", "abarrotes", [product("1", 10.0)])
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    DY.run_pending(spark, landing, lake)
    left = {n for n in set(os.listdir(root)) - before if not n.startswith("lake-")}
    assert left == set()


def test_daily_reads_are_pruned_to_the_day(spark, scratch):
    landing, lake = scratch("landing"), DY.Lake(scratch("lake"))
    write(landing, "2024-06-01", "abarrotes", [product("1", 10.0)])
    DY.run_pending(spark, landing, lake)
    plan = DY.silver_of(spark, lake, "2024-06-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingesta_date" in plan


def test_failed_batch_is_marked_and_restartable(spark, scratch):
    import pytest
    landing, lake = scratch("landing"), DY.Lake(scratch("lake"))
    os.makedirs(f"{landing}/batch_id=2024-06-05")
    with open(f"{landing}/batch_id=2024-06-05/x.json", "w") as f:
        f.write("[]")
    with pytest.raises(Exception):
        DY.run_daily_batch(spark, landing, lake, "2024-06-05")
    row = DY.read_control(spark, lake).first()
    assert row.status == "FAILED" and row.error_message
    write(landing, "2024-06-05", "abarrotes", [product("1", 1.0)])
    DY.run_daily_batch(spark, landing, lake, "2024-06-05")
    assert DY.read_control(spark, lake).first().status == "COMPLETED"
