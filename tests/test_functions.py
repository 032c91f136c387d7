"""Column functions: rounding, text folding, slugs, calendar."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import dates, money, text


@pytest.mark.parametrize("x,want", [(1.005, 1.01), (2.675, 2.68), (0.125, 0.13),
                                    (-1.005, -1.01), (33.3, 33.3), (None, None)])
def test_money_round_is_decimal_half_up(spark, x, want):
    got = spark.createDataFrame([(x,)], "x double").select(money.money_round("x").alias("r")).first().r
    assert got == want


def test_pct_of_handles_zero_whole(spark):
    r = spark.createDataFrame([(1, 8), (1, 0)], "a long, b long") \
        .select(money.pct_of("a", "b").alias("p")).collect()
    assert [x.p for x in r] == [12.5, None]


def test_fold_table_is_derived_and_one_to_one():
    single, forms, longer = text._ascii_forms()
    assert len(single) == len(forms) > 200 and not set(single) & set(longer)
    pairs = dict(zip(single, forms))
    assert pairs["é"] == "e" and pairs["Ñ"] == "N" and pairs["ü"] == "u" and pairs["Ç"] == "C"
    assert "ø" not in pairs and "ß" not in pairs


def test_slugify_matches_key_normalisation(spark):
    raw = ["Tipo de envío", "  A--B ", "Ünïcode_Spaß", "__x__y__", "Tag Stock CD"]
    got = [r.s for r in spark.createDataFrame([(v,) for v in raw], "v string")
           .select(text.slugify("v").alias("s")).collect()]
    assert got == [text.normalize_key(v, overrides={}) for v in raw]


def test_bundle_pattern_unicode_case(spark):
    df = spark.createDataFrame([("LLÉVATE 3",), ("llévate",), ("Arroz",)], "n string")
    assert [r.b for r in df.select(text.is_bundle_name("n").alias("b")).collect()] == \
        [True, True, False]


def test_calendar_columns(spark):
    row = spark.createDataFrame([(dt.date(2024, 6, 2),)], "d date") \
        .select(*[c.alias(k) for k, c in dates.calendar_columns("d").items()]).first()
    assert (row.dia, row.mes, row.nombre_mes, row.trimestre, row.anio, row.dia_semana,
            row.es_fin_de_semana) == (2, 6, "June", 2, 2024, "Sunday", True)


def test_parse_batch_date_is_null_on_garbage(spark):
    r = spark.createDataFrame([("2024-06-02",), ("not-a-date",)], "s string") \
        .select(dates.parse_batch_date("s").alias("d")).collect()
    assert [x.d for x in r] == [dt.date(2024, 6, 2), None]
    assert spark.range(1).select(F.lit(1)).count() == 1
