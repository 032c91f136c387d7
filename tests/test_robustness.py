"""Input the clean test tables do not hold: broken files, clashing names, extreme
values."""

import json
import os
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.text import normalize_key, slugify
from shelfwise.functions.money import money_round
from shelfwise.operators.dedup import asc, best_row_per_key, desc
from shelfwise.operators.merge import merge_update_only
from shelfwise.sources import landing as L


def put(base, batch, name, text):
    os.makedirs(f"{base}/batch_id={batch}", exist_ok=True)
    with open(f"{base}/batch_id={batch}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


COLLIDING = [{"Key": 1, "key": "a"}, {"Key": 2, "key": None}]


@pytest.mark.parametrize("rows", [[{"Key": 1}, {"Key": 2}], COLLIDING])
def test_a_broken_file_fails_or_is_listed(spark, scratch, rows):
    base = scratch("landing")
    put(base, "2024-01-01", "a.json", json.dumps(rows))
    put(base, "2024-01-01", "b.json", json.dumps(rows)[:-3])
    schema = T.StructType([T.StructField(k, T.StringType()) for k in rows[0]])
    with pytest.raises(Exception, match="does not parse"):
        L.read_landing(spark, base, schema=schema).collect()
    with pytest.raises(Exception, match="does not parse"):
        L.read_landing(spark, base, schema=schema).count()
    good = L.read_landing(spark, base, schema=schema, on_error="divert")
    assert [r.seccion for r in good.collect()] == ["a", "a"] and good.count() == 2
    bad = L.landing_rejects(spark, base, schema=schema).collect()
    assert len(bad) >= 1 and all(r.path.endswith("b.json") for r in bad)


@pytest.mark.parametrize("keys", [("Key",), ("Key", "key")])
def test_broken_lines_fail_or_are_listed(spark, scratch, keys):
    base = scratch("landing")
    line = json.dumps({k: "x" for k in keys})
    put(base, "2024-01-01", "a.json", f"{line}\n\n{line[:-2]}\n{line}\n")
    schema = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    kw = dict(schema=schema, multiline=False)
    with pytest.raises(Exception, match="does not parse"):
        L.read_landing(spark, base, **kw).collect()
    assert L.read_landing(spark, base, on_error="divert", **kw).count() == 2
    assert [r.record for r in L.landing_rejects(spark, base, **kw).collect()] == [line[:-2]]


def test_fields_named_like_a_folder_elsewhere_are_kept(spark, scratch):
    base = scratch("landing")
    put(base, "2024-01-01", "a.json", json.dumps([{"chunk": 7, "x": 1}]))
    assert L.read_landing(spark, base).select("chunk", "x").first() == (7, 1)


def test_inference_leaves_the_session_as_it_is(spark, scratch):
    base = scratch("landing")
    put(base, "2024-01-01", "a.json", json.dumps(COLLIDING))
    spark.conf.set("spark.sql.caseSensitive", "false")
    assert L.infer_landing_schema(spark, base).fieldNames() == ["Key", "key"]
    assert spark.conf.get("spark.sql.caseSensitive") == "false"
    got = sorted(r.key for r in L.read_landing(spark, base).collect())
    assert got == ["2", "a"]


def test_landing_folders_are_few(spark, scratch):
    base = scratch("landing")
    df = spark.range(3000).select("id", F.lit("2024-01-01").alias("batch_id"),
                                  (F.col("id") % 3).cast("string").alias("seccion"))
    L.write_landing(df, base, id_col="id", chunk_rows=500)
    files = L.landing_files(spark, base, glob="*.txt")
    assert files.count() <= 3 * 2 and L.read_landing(spark, base, glob="*.txt").count() == 3000


def nfkd_slug(s):
    s = unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode()
    out = "".join(c if c.isalnum() else "_" for c in s)
    while "__" in out:
        out = out.replace("__", "_")
    return out.strip("_").lower()


ODD = ["Nº 5", "ﬁn 2ª m²", "Ｆｕｌｌ", "½ kg", "Ⅷ ①⑩", "ñandú ø ß", "__a  b__", "", "𝐀𝐛", "ǆ ŉ", "x​y"]


def test_slug_is_that_of_the_decomposed_text(spark):
    df = spark.createDataFrame([(x,) for x in ODD], "s string")
    for r in df.select("s", slugify("s").alias("slug")).collect():
        assert r.slug == nfkd_slug(r.s) == normalize_key(r.s, {}), r.s


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_key_form_is_that_of_the_decomposed_text(s):
    assert normalize_key(s, {}) == nfkd_slug(s)


INT_MIN = -2 ** 31


@pytest.mark.parametrize("kind, values", [
    ("int", [INT_MIN, 0, 5, None]), ("bigint", [-2 ** 63, 2 ** 63 - 1, None]), ("smallint", [-32768, 3]),
    ("double", [float("nan"), 5.0, -1.0, None]), ("float", [float("nan"), float("inf"), float("-inf")]),
    ("date", ["0001-01-01", "9999-12-31", None]), ("boolean", [True, False, None]),
    ("decimal(10,2)", [-1, 7, None])])
@pytest.mark.parametrize("direction", [asc, desc])
@pytest.mark.parametrize("nulls_last", [True, False])
def test_both_forms_of_the_best_row_agree(spark, kind, values, direction, nulls_last):
    rows = [(k, v if v is None else str(v), i) for k in range(2) for i, v in enumerate(values[k:])]
    df = spark.createDataFrame(rows, "k int, v string, id int").withColumn("v", F.col("v").cast(kind))
    order = [direction("v", nulls_last), asc("id")]
    a, b = (sorted(map(str, best_row_per_key(df, ["k"], order, method=m).collect()))
            for m in ("aggregate", "window"))
    assert a == b


def test_an_update_from_two_rows_of_one_key_fails(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (1, "y")], "k int, w string")
    with pytest.raises(Exception, match="several rows for one key"):
        merge_update_only(target, source, ["k"], {"v": F.col("src_w")}).collect()
    once = merge_update_only(target, source.limit(1), ["k"], {"v": F.col("src_w")}).collect()
    assert len(once) == 2


def test_money_halves_round_up_whatever_the_float_noise(spark):
    df = spark.createDataFrame([(1.005, 1.01), (2.675, 2.68), (-1.005, -1.01), (1854.5749999999998, 1854.58),
                                (1.00499, 1.0)], "x double, want double")
    assert all(r.got == r.want for r in df.select("want", money_round("x").alias("got")).collect())


def test_no_machine_local_folders_in_the_library():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, names in os.walk(f"{root}/shelfwise"):
        for n in names:
            if n.endswith(".py"):
                with open(f"{folder}/{n}", encoding="utf-8") as f:
                    assert "tempfile" not in f.read(), n
