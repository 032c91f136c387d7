import duckdb
import pytest

import corpus_pipeline
import __spark_entry__ as E
from shelfwise.llm import queries

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    want = con.sql(queries.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    order = sorted(df.columns)
    rows = sorted((tuple(r[c] for c in order) for r in df.collect()), key=str)
    assert rows == sorted((tuple(r) for r in want.project(", ".join(order)).fetchall()), key=str)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        now = {r[0] for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and now <= before
        if name in ("language_id", "line_dedup", "source_mix"):
            assert len(now) >= 0.95 * len(before)
        before = now
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r[0] for r in packed.select("doc_id").collect()} == before


def test_stages_on_odd_documents(spark, rows):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    data = [(1, None, "en", "a", 0), (2, "", None, None, None), (None, "the words of one", "en", "a", 5),
            (3, "the words of one and two", "en", None, 5), (3, "the words of one and two", "en", None, 5),
            (4, "x " * 60_000, "de", "b", 1)]
    for some in (data, []):
        docs = spark.createDataFrame(some, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF).cache()
            docs.count()
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("near", [False, True])
def test_one_of_many_copies_keeps_its_text(spark, near):
    """A third of a source is one document and copies of it: one comes out, whole."""
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    words = [f"w{i}" for i in range(160)]

    def copy(i):
        some = list(words)
        if near:
            some[i * 7 % 160] = f"other{i}"
        return "\n".join(" ".join(some[a:a + 20]) for a in range(0, 160, 20))
    data = [(i, copy(i), "en", "a", 1) for i in range(60)]
    data += [(i, "\n".join(f"text {i} line {k} " + " ".join(f"v{i}x{k}x{j}" for j in range(9))
                           for k in range(5)) + "\nall rights reserved", "en", "a", 1) for i in range(60, 180)]
    docs = spark.createDataFrame(data, schema).repartition(4)
    for name, stage in corpus_pipeline.STAGES[1:3]:
        docs = stage(spark, docs, SF).cache()
    out = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(out) == {0, *range(60, 180)} and out[0] == copy(0)
    assert not any("rights" in t for t in out.values())  # boilerplate goes as before
