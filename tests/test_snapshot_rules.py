"""Hand-made catalogue records for each rule of the snapshot build."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import silver as S

BRONZE_DDL = """
productid string, productreferencecode string, productname string, brand string,
brandid string, categoryid string, categories array<string>,
items array<struct<itemid:string, unitmultiplier:double,
  sellers:array<struct<sellername:string, commertialoffer:struct<listprice:double, price:double,
    isavailable:boolean, availablequantity:int,
    promotionteasers:array<struct<effects:struct<parameters:array<struct<name:string, value:string>>>>>>>>>>,
tipodeoctogono array<string>, canal_venta array<string>, tipo_especifico_producto array<string>,
tag_stock_tienda array<string>, tag_stock_cd array<string>, tipo_de_envio array<string>,
vendido_por array<string>, releasedate string, seccion string, ingesta_date date, batch_id string
"""

DAY = dt.date(2024, 6, 2)


def teaser(*params):
    return {"effects": {"parameters": [{"name": n, "value": v} for n, v in params]}}


def record(**kw):
    offer = {"listprice": kw.pop("r", 10.0), "price": kw.pop("o", 9.0),
             "isavailable": kw.pop("available", True), "availablequantity": 5,
             "promotionteasers": kw.pop("teasers", [])}
    item = {"itemid": kw.pop("itemid", "I1"), "unitmultiplier": kw.pop("u", 1.0),
            "sellers": [{"sellername": kw.pop("seller", "Tienda"), "commertialoffer": offer}]}
    base = {
        "productid": "P1", "productreferencecode": "R1", "productname": "Arroz",
        "brand": " Marca ", "brandid": "B1", "categoryid": "C1",
        "categories": ["/Abarrotes/Arroz/Blanco/"], "items": [item],
        "tipodeoctogono": [], "canal_venta": ["supermercado"], "tipo_especifico_producto": ["x"],
        "tag_stock_tienda": [], "tag_stock_cd": [], "tipo_de_envio": [], "vendido_por": [],
        "releasedate": "2024-01-01", "seccion": "abarrotes", "ingesta_date": DAY,
        "batch_id": "2024-06-02",
    }
    base.update(kw)
    return base


def bronze(spark, *recs):
    return spark.createDataFrame(list(recs), BRONZE_DDL)


def enriched(spark, *recs):
    return S.normalize_text(S.enrich(bronze(spark, *recs)))


# --- golden prices --------------------------------------------------------------------

@pytest.mark.parametrize("u,r,d,card", [
    (3.0, 1.29, 0.60, 1.09),      # watermelon by the kg
    (0.09, 7.90, 0.20, 5.68),     # bread by the kg
    (1.1, 42.90, 10.56, 33.30),   # beef cut by the kg
])
def test_card_price_uses_package_total(spark, u, r, d, card):
    rec = record(u=u, r=r, o=r, teasers=[teaser(("PromotionalPriceTableItemsDiscount", str(d)))])
    row = enriched(spark, rec).first()
    assert row.precio_tarjeta_sip == card
    assert row.en_promocion is True
    assert row.precio_promo_exacto is False


def test_best_discount_takes_max_of_first_named_parameter(spark):
    rec = record(u=1.0, r=100.0, o=90.0, teasers=[
        teaser(("Other", "99"), ("PromotionalPriceTableItemsDiscount", "5")),
        teaser(("PromotionalPriceTableItemsDiscount", "12.5"),
               ("PromotionalPriceTableItemsDiscount", "40")),
        teaser(("Other", "1"))])
    row = enriched(spark, rec).first()
    assert row.precio_tarjeta_sip == 87.5
    assert row.descuento_tarjeta_sip_pct == 12
    assert row.descuento_base_pct == 10


def test_no_teasers_or_null_teasers_means_no_promotion(spark):
    rows = enriched(spark, record(itemid="a", teasers=[]), record(itemid="b", teasers=None)).collect()
    assert all(r.precio_tarjeta_sip is None and r.en_promocion is False for r in rows)


def test_zero_divisors_give_null_not_error(spark):
    t = [teaser(("PromotionalPriceTableItemsDiscount", "1"))]
    rows = enriched(spark, record(itemid="u0", u=0.0, teasers=t),
                    record(itemid="r0", r=0.0, teasers=t)).orderBy("itemid").collect()
    r0, u0 = rows
    assert u0.precio_tarjeta_sip is None
    assert r0.descuento_base_pct is None and r0.descuento_tarjeta_sip_pct is None
    assert r0.precio_valido is False


def test_malformed_numbers_and_dates_are_null(spark):
    t = [teaser(("PromotionalPriceTableItemsDiscount", "abc"))]
    row = enriched(spark, record(teasers=t, releasedate="31/02/2024")).first()
    assert row.precio_tarjeta_sip is None
    assert row.fecha_lanzamiento is None


# --- labels, delivery, seller, sku -------------------------------------------------------

def test_label_duplicates_are_counted_once(spark):
    row = enriched(spark, record(tipodeoctogono=["altoenazucar", "altoenazucar",
                                                 "altoensodio", "altoensodio"])).first()
    assert (row.alto_azucar, row.alto_sodio, row.alto_saturadas, row.num_octogonos) == \
        (True, True, False, 2)


def test_null_and_empty_label_lists(spark):
    rows = enriched(spark, record(itemid="n", tipodeoctogono=None),
                    record(itemid="e", tipodeoctogono=[])).orderBy("itemid").collect()
    empty, null = rows
    assert (null.alto_sodio, null.num_octogonos) == (None, 0)
    assert (empty.alto_sodio, empty.num_octogonos) == (False, 0)


def test_delivery_flags_accept_yes_with_accent_and_empty_lists(spark):
    rows = enriched(
        spark,
        record(itemid="a", tag_stock_tienda=["Sí"], tag_stock_cd=["Si"],
               tipo_de_envio=["Despacho a domicilio"]),
        record(itemid="b", tag_stock_tienda=[], tag_stock_cd=None,
               tipo_de_envio=["Recojo en tienda"])).orderBy("itemid").collect()
    a, b = rows
    assert (a.retira_hoy, a.llega_manana, a.envio_domicilio, a.recojo_tienda) == (True, True, True, False)
    assert (b.retira_hoy, b.llega_manana, b.envio_domicilio, b.recojo_tienda) == (False, False, False, True)


def test_seller_fallback(spark):
    rows = enriched(spark,
                    record(itemid="1", vendido_por=[" marcas aliadas "], seller="Offer"),
                    record(itemid="2", vendido_por=[], seller="Offer"),
                    record(itemid="3", vendido_por=["X "], seller="Offer")).orderBy("itemid").collect()
    assert [r.vendedor for r in rows] == ["Offer", "Offer", "X"]


def test_sku_fallback(spark):
    rows = enriched(spark,
                    record(itemid="1", productreferencecode="-"),
                    record(itemid="2", productreferencecode=""),
                    record(itemid="3", productreferencecode=None),
                    record(itemid="4", productreferencecode="R1")).orderBy("itemid").collect()
    assert [r.sku for r in rows] == ["1", "2", "3", "R1"]


def test_category_levels_start_after_leading_slash(spark):
    row = enriched(spark, record(categories=["/A/B/C/"])).first()
    assert (row.categoria_principal, row.subcategoria, row.grupo_producto) == ("A", "B", "C")
    row = enriched(spark, record(categories=[])).first()
    assert row.categoria_principal is None


# --- filters ------------------------------------------------------------------------------

def test_bundle_filter_drops_bundles_and_nulls(spark):
    names = ["Pack x6", "COMBO familiar", "Lleva 2", "LLÉVATE 3", "Compacko", None, "Arroz"]
    recs = [record(itemid=str(i), productid=str(i), productname=n) for i, n in enumerate(names)]
    recs.append(record(itemid="cat", productid="cat", categories=["/Packs/x/"]))
    recs.append(record(itemid="nullcat", productid="nullcat", categories=None))
    out = S.build_silver(bronze(spark, *recs)).select("productname").collect()
    assert [r.productname for r in out] == ["Arroz"]


def test_channel_default_and_filter(spark):
    recs = [record(itemid="1", productid="1", canal_venta=[]),
            record(itemid="2", productid="2", canal_venta=[" sellercenter"]),
            record(itemid="3", productid="3", canal_venta=["otro"])]
    out = S.build_silver(bronze(spark, *recs)).orderBy("productid").collect()
    assert [(r.productid, r.canal_venta) for r in out] == [("1", "SUPERMERCADO"), ("2", "SELLERCENTER")]


# --- dedup ----------------------------------------------------------------------------------

def test_dedup_keeps_most_specific_category_and_all_sections(spark):
    recs = [record(itemid="1", categories=["/A/"], seccion="s2"),
            record(itemid="2", categories=["/A/B/"], seccion="s1"),
            record(itemid="3", categories=["/A/B/"], seccion="s1")]
    out = S.build_silver(bronze(spark, *recs)).collect()
    assert len(out) == 1
    assert out[0].subcategoria == "B"
    assert out[0].secciones_origen == ["s1", "s2"]


def test_dedup_is_deterministic_on_ties(spark):
    recs = [record(itemid=str(i), productreferencecode=f"R{i}", categories=["/A/B/"],
                   seccion="s") for i in range(5)]
    a = S.build_silver(bronze(spark, *recs)).first()
    b = S.build_silver(bronze(spark, *reversed(recs))).first()
    assert a.sku == b.sku == "R0"


def test_aggregate_and_window_dedup_agree(spark):
    from shelfwise.operators.dedup import asc, best_row_per_key, desc
    df = spark.createDataFrame(
        [(k % 7, float(v % 5), v, f"s{v % 3}") for k, v in zip(range(200), range(200, 0, -1))],
        "k long, price double, id long, sec string")
    order = [desc("price"), asc("id")]
    a = best_row_per_key(df, ["k"], order, gather={"secs": "sec"})
    w = best_row_per_key(df, ["k"], order, gather={"secs": "sec"}, method="window")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, w.collect()))


def test_silver_schema(spark):
    out = S.build_silver(bronze(spark, record()))
    assert out.columns == S.SILVER_COLUMNS
    types = dict(out.dtypes)
    assert types["descuento_base_pct"] == "bigint"
    assert types["num_octogonos"] == "int"
    assert types["secciones_origen"] == "array<string>"


def test_observation_counts_rows_during_the_write(spark):
    from pyspark.sql import Observation
    obs = Observation("silver")
    recs = [record(itemid="1"), record(itemid="2", productname="Pack x2")]
    S.build_silver(bronze(spark, *recs), observation=obs).write.format("noop").mode("overwrite").save()
    assert obs.get["rows_after_filters"] == 1


def test_today_batch_id_is_iso(spark):
    from shelfwise.functions.dates import today_batch_id
    v = spark.range(1).select(today_batch_id("America/Lima").alias("b")).first().b
    assert len(v) == 10 and v[4] == "-" and v[7] == "-"


def test_sections_are_gathered_after_the_filters(spark):
    # D6: a bundle row of the same product and day does not add its section.
    recs = [record(itemid="1", seccion="abarrotes"),
            record(itemid="2", seccion="ofertas", productname="Pack Arroz"),
            record(itemid="3", seccion="canal", canal_venta=["otro"])]
    out = S.build_silver(bronze(spark, *recs)).collect()
    assert [r.secciones_origen for r in out] == [["abarrotes"]]


def test_discount_without_multiplier_is_not_a_promotion(spark):
    # D31: the promotion flag is "card price is set"; no multiplier, no card price.
    t = [teaser(("PromotionalPriceTableItemsDiscount", "1"))]
    row = enriched(spark, record(u=None, teasers=t)).first()
    assert row.precio_tarjeta_sip is None and row.en_promocion is False
    assert row.descuento_tarjeta_sip_pct is None
