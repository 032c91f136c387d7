"""Star schema, keys, merges, writers, analytics edge cases and batch control."""

import datetime as dt
import json
import os

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.functions.text import normalize_key
from shelfwise.operators.keys import assign_surrogate_keys
from shelfwise.operators.merge import merge_upsert
from shelfwise.plans import analytics as A
from shelfwise.plans import control as C
from shelfwise.plans import gold as G
from shelfwise.plans import quality as Q
from shelfwise.sources import landing as L
from shelfwise.sources import tables as TB

D1, D2, D3 = dt.date(2024, 6, 1), dt.date(2024, 6, 2), dt.date(2024, 6, 3)


# --- dimensions and keys ---------------------------------------------------------------

def test_label_junk_has_32_distinct_rows(spark):
    j = G.label_junk(spark)
    assert j.count() == 32
    assert j.select(*G.LABEL_COLS).distinct().count() == 32
    assert sorted(r[0] for r in j.select("etiquetado_key").collect()) == list(range(1, 33))


def test_first_seen_is_one_row_per_key_earliest_batch_wins(spark):
    src = spark.createDataFrame(
        [("B1", "Marca", D2), ("B1", "MARCA", D1), ("B1", "Zeta", D1), (None, "Sin", D1)],
        "brandid string, brand string, ingesta_date date")
    rows = G.brand_rows(src).collect()
    assert [(r.brandid, r.brand) for r in rows] == [("B1", "MARCA")]


def test_surrogate_keys_dense_ordered_and_after_existing(spark):
    rows = spark.createDataFrame([(f"k{i:03d}",) for i in range(57)], "nk string")
    keyed = assign_surrogate_keys(rows, ["nk"], "sk", base=100, partitions=5, ordered=True)
    got = sorted((r.sk, r.nk) for r in keyed.collect())
    assert got == [(101 + i, f"k{i:03d}") for i in range(57)]


def test_dimension_extension_keeps_old_keys(spark):
    src1 = spark.createDataFrame([("B1", "x", D1), ("B2", "y", D1)],
                                 "brandid string, brand string, ingesta_date date")
    dim1 = G.extend_dimension(None, G.brand_rows(src1), "marca_key", ["brandid"])
    src2 = spark.createDataFrame([("B2", "changed", D2), ("B3", "z", D2), (None, "n", D2)],
                                 "brandid string, brand string, ingesta_date date")
    new = G.extend_dimension(dim1, G.brand_rows(src2), "marca_key", ["brandid"])
    full = {r.brandid: (r.marca_key, r.brand) for r in dim1.unionByName(new).collect()}
    assert full == {"B1": (1, "x"), "B2": (2, "y"), "B3": (3, "z")}


def _silver_rows(spark, rows):
    return spark.createDataFrame(rows, """productid string, productname string, brandid string,
        brand string, canal_venta string, categoryid string, subcategoria string,
        grupo_producto string, categoria_principal string, sku string,
        tipo_especifico_producto string, fecha_lanzamiento date, vendedor string,
        alto_sodio boolean, alto_azucar boolean, alto_saturadas boolean, num_octogonos int,
        ingesta_date date""").withColumns({m: F.lit(None).cast("double") for m in G.MEASURES})


def test_fact_and_audit_reconcile_with_null_keys_and_unknown_labels(spark):
    base = ["N", "B1", "b", "SUPERMERCADO", "C", "S", "G", "Cat", "sku", "T", D1, "v"]
    rows = [
        ("P1", *base, True, False, False, 1, D1),
        ("P2", *base, None, None, None, 0, D1),          # NULL flags read as false
        ("P3", *base, True, True, True, 4, D1),          # 4 labels: no junk row
        ("P4", "N", None, "b", "SUPERMERCADO", "C", "S", "G", "Cat", "sku", "T", D1, "v",
         False, False, False, 0, D1),                      # NULL brand key
    ]
    src = _silver_rows(spark, rows)
    dims = G.build_dimensions(src)
    assert dims["marca"].filter(F.col("brandid").isNull()).count() == 0
    fact = G.fact_rows(src, dims)
    audit = {r.productid: r.motivos for r in G.audit_rows(src, dims).collect()}
    assert fact.count() == 2
    assert audit == {"P3": ["etiquetado"], "P4": ["marca"]}
    assert fact.count() + len(audit) == src.count()


# --- merges ------------------------------------------------------------------------------

def _snap(spark, rows):
    return spark.createDataFrame(rows, "productid string, ingesta_date date, batch_id string, "
                                       "precio double, creado string")


GUARD = staticmethod(lambda t, s: s("batch_id") >= t("batch_id"))


def test_merge_guard_blocks_older_batch(spark):
    tgt = _snap(spark, [("P1", D2, "2024-06-02", 10.0, "t")])
    src = _snap(spark, [("P1", D2, "2024-06-01", 99.0, "s")])
    out = merge_upsert(tgt, src, ["productid", "ingesta_date"],
                       guard=lambda t, s: s("batch_id") >= t("batch_id"), keep_cols=["creado"])
    assert [tuple(r) for r in out.collect()] == [("P1", D2, "2024-06-02", 10.0, "t")]


def test_merge_updates_inserts_and_keeps_created(spark):
    tgt = _snap(spark, [("P1", D2, "2024-06-02", 10.0, "t1"), ("P2", D2, "2024-06-02", 5.0, "t2")])
    src = _snap(spark, [("P1", D2, "2024-06-02", 11.0, "s1"), ("P3", D2, "2024-06-02", 7.0, "s3")])
    out = merge_upsert(tgt, src, ["productid", "ingesta_date"],
                       guard=lambda t, s: s("batch_id") >= t("batch_id"), keep_cols=["creado"])
    got = sorted((r.productid, r.precio, r.creado) for r in out.collect())
    assert got == [("P1", 11.0, "t1"), ("P2", 5.0, "t2"), ("P3", 7.0, "s3")]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["P1", "P2", "P3", "P4"]),
                          st.sampled_from(["2024-06-01", "2024-06-02", "2024-06-03"]),
                          st.floats(0, 100, allow_nan=False)), max_size=6,
                unique_by=lambda x: x[0]))
def test_merge_twice_equals_merge_once(spark, rows):
    tgt = _snap(spark, [("P1", D2, "2024-06-02", 1.0, "t"), ("P2", D2, "2024-06-02", 2.0, "t")])
    src = _snap(spark, [(p, D2, b, v, "s") for p, b, v in rows])
    keys = ["productid", "ingesta_date"]
    g = lambda t, s: s("batch_id") >= t("batch_id")
    once = merge_upsert(tgt, src, keys, guard=g, keep_cols=["creado"])
    twice = merge_upsert(once, src, keys, guard=g, keep_cols=["creado"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_merge_into_table_rewrites_only_touched_partitions(spark, scratch):
    path = scratch("silver")
    tgt = _snap(spark, [("P1", D1, "2024-06-01", 1.0, "a"), ("P1", D2, "2024-06-02", 2.0, "b")])
    TB.replace_partitions(tgt, path, ["ingesta_date"])
    src = _snap(spark, [("P1", D2, "2024-06-02", 3.0, "c"), ("P2", D2, "2024-06-02", 4.0, "d")])
    for _ in range(2):  # idempotent
        TB.merge_into_table(spark, path, src, ["productid", "ingesta_date"], "ingesta_date",
                            guard=lambda t, s: s("batch_id") >= t("batch_id"),
                            keep_cols=["creado"], schema=tgt.schema)
    got = sorted((r.productid, r.ingesta_date, r.precio, r.creado)
                 for r in TB.read_table(spark, path, tgt.schema).collect())
    assert got == [("P1", D1, 1.0, "a"), ("P1", D2, 3.0, "b"), ("P2", D2, 4.0, "d")]


def test_merge_into_table_rejects_duplicate_source_keys(spark, scratch):
    import pytest
    path = scratch("dup")
    src = _snap(spark, [("P1", D2, "2024-06-02", 3.0, "c"), ("P1", D2, "2024-06-02", 4.0, "d")])
    with pytest.raises(TB.MergeKeyError):
        TB.merge_into_table(spark, path, src, ["productid", "ingesta_date"], "ingesta_date")


def test_replace_batch_and_skip_mode(spark, scratch):
    path = scratch("bronze")
    a = spark.createDataFrame([(1, "2024-06-01"), (2, "2024-06-02")], "v int, batch_id string")
    TB.replace_batch(a, path)
    b = spark.createDataFrame([(9, "2024-06-02")], "v int, batch_id string")
    assert TB.write_batch(spark, b, path, "2024-06-02", mode="skip") is False
    assert TB.write_batch(spark, b, path, "2024-06-02", mode="replace") is True
    got = sorted((r.v, r.batch_id) for r in TB.read_table(spark, path).collect())
    assert got == [(1, "2024-06-01"), (9, "2024-06-02")]


def test_create_if_missing(spark, scratch):
    path = scratch("control")
    assert TB.create_if_missing(spark, path, C.CONTROL_SCHEMA) is True
    assert TB.create_if_missing(spark, path, C.CONTROL_SCHEMA) is False
    assert TB.read_table(spark, path, C.CONTROL_SCHEMA).count() == 0


# --- analytics edge cases ----------------------------------------------------------------

def _simple_snap(spark, rows):
    return spark.createDataFrame(rows, "productid string, productname string, "
                                       "categoria_principal string, precio_regular double, "
                                       "precio_valido boolean, ingesta_date date")


def test_single_batch_everything_is_new(spark):
    s = _simple_snap(spark, [("P1", "a", "C", 1.0, True, D1), ("P2", "b", "D", 2.0, True, D1)])
    got = {r.tipo: (r.total, r.categorias_afectadas) for r in A.catalog_churn(s).collect()}
    assert got == {"Nuevo": (2, 2)}


def test_churn_between_last_two_batches(spark):
    s = _simple_snap(spark, [("P1", "a", "C", 1.0, True, D1), ("P1", "a", "C", 1.0, True, D2),
                             ("P2", "b", "C", 1.0, True, D2), ("P3", "c", "D", 1.0, True, D3),
                             ("P1", "a", "C", 1.0, True, D3)])
    got = {r.tipo: r.total for r in A.catalog_churn(s).collect()}
    assert got == {"Nuevo": 1, "Descontinuado": 1}


def test_lag_is_previous_valid_row_not_previous_day(spark):
    s = _simple_snap(spark, [("P1", "a", "C", 10.0, True, D1), ("P1", "a", "C", 0.0, False, D2),
                             ("P1", "a", "C", 12.0, True, D3)])
    moves = A.price_moves(s).collect()
    assert [(m.fecha, m.precio_anterior, m.precio_actual, m.variacion_pct) for m in moves] == \
        [(D3, 10.0, 12.0, 20.0)]


def test_latest_batch_is_max_date(spark):
    s = _simple_snap(spark, [("P1", "a", "C", 1.0, True, D3), ("P2", "a", "C", 1.0, True, D1)])
    assert [r.productid for r in A.latest_batch_rows(s).collect()] == ["P1"]
    pair = A.batch_pair(s).first()
    assert (pair.ultimo, pair.anterior) == (D3, D1)


# --- control ---------------------------------------------------------------------------------

def test_failed_batch_can_restart_and_next_batch(spark):
    ctl = spark.createDataFrame([("2024-06-01", "COMPLETED"), ("2024-06-02", "FAILED")],
                                "batch_id string, status string")
    ctl = ctl.select("batch_id", "status",
                     *[F.lit(None).cast("timestamp").alias(c) for c in
                       ("created_timestamp", "updated_timestamp", "start_time", "end_time")],
                     F.lit("boom").alias("error_message"))
    ids = spark.createDataFrame([("2024-06-02",), ("2024-06-03",)], "batch_id string")
    after = {r.batch_id: (r.status, r.error_message) for r in C.start_batches(ctl, ids).collect()}
    assert after == {"2024-06-01": ("COMPLETED", "boom"), "2024-06-02": ("IN_PROGRESS", None),
                     "2024-06-03": ("IN_PROGRESS", None)}
    landing = spark.createDataFrame([("2024-06-01",), ("2024-06-02",), ("2024-06-03",)],
                                    "batch_id string")
    nb = C.next_batch(landing, ctl).first()
    assert (nb.siguiente_batch, nb.pendientes) == ("2024-06-02", 2)


# --- landing -----------------------------------------------------------------------------------

def test_normalize_key_cases():
    assert normalize_key("Tipo De Producto") == "tipo_especifico_producto"
    assert normalize_key("Tipo de Producto") == "canal_venta"
    assert normalize_key("Tag Stock Tienda") == "tag_stock_tienda"
    assert normalize_key("Tipo de envío") == "tipo_de_envio"
    assert normalize_key("  A--B ") == "a_b"
    assert normalize_key("productName") == "productname"
    assert normalize_key(normalize_key("Tipo de envío")) == "tipo_de_envio"


def test_colliding_columns_report():
    assert Q.colliding_columns(["Tipo de Producto", "Tipo De Producto", "x"]) == \
        {"tipo_de_producto": ["Tipo de Producto", "Tipo De Producto"]}


def _write_json(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(rows, f, ensure_ascii=False, indent=1)


def test_landing_end_to_end(spark, scratch):
    from shelfwise.plans import silver as S
    base = scratch("landing")
    prod = {"productId": "P1", "productReferenceCode": "R1", "productName": "Arroz",
            "brand": "M", "brandId": 7, "categoryId": 3, "categories": ["/A/B/C/"],
            "items": [{"itemId": "I1", "unitMultiplier": 1.0, "sellers": [
                {"sellerName": "S", "commertialOffer": {"ListPrice": 10.0, "Price": 9.0,
                 "IsAvailable": True, "AvailableQuantity": 3, "PromotionTeasers": []}}]}],
            "Tipo de Producto": ["supermercado"], "Tipo De Producto": ["abarrotes"],
            "tipoDeOctogono": [], "Tag Stock Tienda": ["Si"], "Tag Stock CD": [],
            "Tipo de envío": ["Recojo en tienda"], "Vendido por": [], "releaseDate": "2024-01-01"}
    extra = dict(prod, productId="P2", nuevaColumna="x")
    _write_json(f"{base}/batch_id=2024-06-01/abarrotes.json", [prod])
    _write_json(f"{base}/batch_id=2024-06-01/bebidas.json", [prod])
    _write_json(f"{base}/batch_id=2024-06-02/abarrotes.json", [prod, extra])
    with open(f"{base}/batch_id=2024-06-02/notes.txt", "w") as f:
        f.write("ignored")
    df = L.read_landing(spark, base)
    assert {"canal_venta", "tipo_especifico_producto", "tag_stock_tienda", "tipo_de_envio",
            "nuevacolumna", "seccion", "batch_id"} <= set(df.columns)
    assert df.count() == 4
    bronze = df.withColumn("ingesta_date", F.to_date("batch_id"))
    silver = S.build_silver(bronze).orderBy("ingesta_date", "productid").collect()
    assert [(r.productid, str(r.ingesta_date), r.secciones_origen) for r in silver] == [
        ("P1", "2024-06-01", ["abarrotes", "bebidas"]), ("P1", "2024-06-02", ["abarrotes"]),
        ("P2", "2024-06-02", ["abarrotes"])]
    assert silver[0].canal_venta == "SUPERMERCADO"
    assert silver[0].tipo_especifico_producto == "ABARROTES"
    assert silver[0].retira_hoy is True
    files = L.landing_files(spark, base)
    assert sorted(r[0] for r in L.landing_batches(files).collect()) == ["2024-06-01", "2024-06-02"]
    one = L.read_landing(spark, base, batch_id="2024-06-02")
    assert one.count() == 2


def test_landing_missing_or_empty_folder_fails(spark, scratch):
    import pytest
    with pytest.raises(L.LandingError):
        L.read_landing(spark, scratch("nothing-here"))
    empty = scratch("empty")
    os.makedirs(f"{empty}/batch_id=2024-06-01")
    with pytest.raises(L.LandingError):
        L.read_landing(spark, empty)


def test_batch_ids_must_be_explicit_iso_days(spark):
    import pytest
    from shelfwise.plans import daily as DY
    with pytest.raises(ValueError):
        DY._check_batch_id("")
    with pytest.raises(ValueError):
        DY._check_batch_id("02/06/2024")
    ids = spark.createDataFrame([("2024-06-02",), ("2024-6-2",), ("hoy",)], "batch_id string")
    assert sorted(r.batch_id for r in C.invalid_batch_ids(ids).collect()) == ["2024-6-2", "hoy"]


def test_fact_skip_mode_leaves_an_existing_batch(spark, scratch):
    from shelfwise import schemas as SC
    from shelfwise.plans import daily as DY
    lake = DY.Lake(scratch("lake"))
    rows = [("P1", "N", "B1", "b", "SUPERMERCADO", "C", "S", "G", "Cat", "sku", "T", D1, "v",
             False, False, False, 0, D1)]
    silver = _silver_rows(spark, rows).withColumns({
        "batch_id": F.lit("2024-06-01"), "secciones_origen": F.array(F.lit("s")),
        "created_timestamp": F.current_timestamp(), "updated_timestamp": F.current_timestamp()})
    typed = silver.select(*[F.col(f.name).cast(f.dataType) for f in SC.SILVER.fields])
    TB.replace_partitions(typed, lake.silver, ["ingesta_date"])
    assert DY.load_gold(spark, lake, "2024-06-01")["fact"] == 1
    assert DY.load_gold(spark, lake, "2024-06-01", fact_mode="skip") == {"fact": -1}
    assert TB.read_table(spark, lake.fact, SC.FACT).count() == 1


def test_widen_replaces_only_degenerate_types():
    from pyspark.sql import types as T
    teaser = T.ArrayType(T.StructType([T.StructField("effects", T.StringType())]))
    hint = T.StructType([T.StructField("Offer", T.StructType([
        T.StructField("Teasers", teaser), T.StructField("Price", T.DoubleType())]))])
    inferred = T.StructType([T.StructField("Offer", T.StructType([
        T.StructField("Teasers", T.ArrayType(T.StringType())), T.StructField("Price", T.LongType()),
        T.StructField("New", T.StringType())]))])
    out = L.widen(inferred, hint)
    offer = out["Offer"].dataType
    assert offer["Teasers"].dataType == teaser          # empty arrays take the known type
    assert offer["Price"].dataType == T.LongType()      # a real difference is left alone
    assert offer["New"].dataType == T.StringType()      # new fields are kept
    assert L.widen(T.NullType(), T.DoubleType()) == T.DoubleType()


def test_overwrite_partition_clears_a_partition_even_when_empty(spark, scratch):
    path = scratch("audit")
    rows = spark.createDataFrame([("P1", D1), ("P2", D2)], "productid string, ingesta_date date")
    TB.replace_partitions(rows, path, ["ingesta_date"])
    TB.overwrite_partition(spark.createDataFrame([], "productid string"), path, "ingesta_date", D2)
    got = sorted(r.productid for r in TB.read_table(
        spark, path, rows.schema).collect())
    assert got == ["P1"]


def test_landing_json_lines(spark, scratch):
    base = scratch("landing-jsonl")
    d = f"{base}/batch_id=2024-06-01"
    os.makedirs(d)
    with open(f"{d}/abarrotes.json", "w", encoding="utf-8") as f:
        f.write('{"productId": "P1", "Tipo de Producto": ["a"], "Tipo De Producto": ["b"]}\n\n')
        f.write('{"productId": "P2", "Tipo de Producto": ["c"]}\n')
    rows = sorted(map(tuple, L.read_landing(spark, base, multiline=False)
                      .select("productid", "canal_venta", "tipo_especifico_producto", "seccion")
                      .collect()))
    assert rows == [("P1", ["a"], ["b"], "abarrotes"), ("P2", ["c"], None, "abarrotes")]


def test_incremental_price_moves_equal_the_lag_form(spark):
    import random
    rnd = random.Random(7)
    days = [dt.date(2024, 6, d) for d in range(1, 6)]
    rows = []
    for p in range(12):
        for d in days:
            if rnd.random() < 0.8:
                price = float(rnd.choice([5, 6, 7, 0]))
                rows.append((f"P{p}", "n", "C", price, price > 0, d))
    snap = _simple_snap(spark, rows)
    want = sorted(map(tuple, A.price_moves(snap).collect()))
    last, got = None, []
    for d in days:
        moves, last = A.next_price_moves(last, snap.filter(F.col("ingesta_date") == F.lit(d)))
        got += [tuple(r) for r in moves.collect()]
    assert sorted(got) == want
