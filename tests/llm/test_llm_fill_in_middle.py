import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import fill_in_middle as FIM


def by_hand(doc_id, text, seed=1, rate=90, spm=20):
    """The transformation in plain Python."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * k:8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(rows, data, **kw):
    made = FIM.fill_in_middle(rows("doc_id long, text string", data), **kw)
    got = made.withColumn("back", FIM.restored(F.col("output"), F.col("form"))).collect()
    want = [(i, t, *by_hand(i, t, **kw), t or "") for i, t in data]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_random_texts_against_plain_python(rows):
    r = random.Random(5)
    parts = ["a", "Word", "longerword", " ", "\n", "é", "ß", "𝒜", "😀", "<", ">", "<P", "S>", "$1", "\\", "1",
             "\r\n", " ", "-", "("]
    data = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 60)))) for i in range(600)]
    check(rows, data)
    check(rows, data, seed=7, rate=100, spm=50)


def test_odd_rows(rows):
    check(rows, [(1, None), (2, ""), (None, "no identifier here"), (4, "has <S> in it"), (5, "<M>"),
                 (6, "same text"), (6, "same text"), (7, "same text"), (8, "x"), (-9, "minus nine, too")], rate=100)
    assert FIM.fill_in_middle(rows("doc_id long, text string", [])).count() == 0


def test_columns_that_clash(rows):
    df = rows("doc_id long, text string, N string, form int, _h1 int, _whole int, other int",
              [(i, f"some text {i}", "x", 1, 2, 3, 4) for i in range(30)])
    out = FIM.fill_in_middle(df)
    assert out.columns == ["doc_id", "text", "_h1", "_whole", "other", "n", "form", "prefix_chars",
                           "middle_chars", "output"]
    for r in out.collect():
        assert tuple(r)[5:] == by_hand(r["doc_id"], r["text"]) and tuple(r)[2:5] == (2, 3, 4)


def test_texts_of_millions_of_units(rows):
    check(rows, [(1, "ab 1" * 500_000), (2, "x" * 3_000_000), (3, "𝒜b" * 300_000), (5, "\n" * 1_000_000)], rate=100)


def test_shares_of_the_forms(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b c d e").alias("text"))
    n = {r["form"]: r["count"] for r in FIM.fill_in_middle(df).groupBy("form").count().collect()}
    assert abs(n["plain"] / 20_000 - 0.1) < 0.01 and abs(n["spm"] / (n["spm"] + n["psm"]) - 0.2) < 0.015


def test_the_plan_is_one_projection_without_python(rows):
    out = FIM.fill_in_middle(rows("doc_id long, text string", [(1, "a")], parts=1))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "hashpartitioning" not in plan


def test_markers_must_be_told_apart(rows):
    with pytest.raises(ValueError):
        FIM.fill_in_middle(rows("doc_id long, text string", []), markers=("<P>", "<P>", "<M>"))
