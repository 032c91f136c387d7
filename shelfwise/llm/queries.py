"""Registered queries of the operators and, where SQL can say it, their DuckDB
texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (conversation_trie, cost_packing, embedding_dedup, fill_in_middle,
                           html_extract, language_id, line_dedup, mixing, ngram_join, packing, pii_crf,
                           quality_rules, sharding)
from shelfwise.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return keep


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_line_dedup", """
WITH pages AS (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, source, unnest(ls) AS line FROM pages),
c AS (SELECT source, trim(line) AS t, count(DISTINCT doc_id) AS n FROM l WHERE trim(line) <> ''
      GROUP BY 1, 2),
h AS (SELECT source, count(*) AS pages FROM documents GROUP BY 1),
b AS (SELECT c.source, c.t FROM c JOIN h ON c.source IS NOT DISTINCT FROM h.source
      WHERE n >= 5 AND n > 0.02 * pages),
s AS (SELECT source, list(t) AS bad FROM b GROUP BY 1)
SELECT p.doc_id, p.source,
       CASE WHEN p.ls IS NULL THEN NULL ELSE array_to_string(
         list_filter(p.ls, lambda x: trim(x) = '' OR NOT coalesce(list_contains(s.bad, trim(x)), false)),
         chr(10)) END AS text,
       coalesce(len(list_filter(p.ls, lambda x: trim(x) <> '')), 0) AS n_lines,
       coalesce(len(list_filter(p.ls, lambda x: trim(x) <> ''
                                AND coalesce(list_contains(s.bad, trim(x)), false))), 0) AS n_dropped
FROM pages p LEFT JOIN s ON p.source IS NOT DISTINCT FROM s.source
""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that make up the boilerplate of their source."""
    return line_dedup.drop_boilerplate(documents(spark, sf_dir), "source").select(
        "doc_id", "source", "text", "n_lines", "n_dropped")


def languages(docs: DataFrame) -> language_id.Model:
    """Learned from the documents that are not held out."""
    return language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"))), "lang", "text")


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by cross-parsing entropy."""
    docs = documents(spark, sf_dir)
    texts = docs.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "text")
    return language_id.identify(texts, languages(docs)).drop("text")


@query("op3_ngram_join")
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles are alike to 85 %."""
    return ngram_join.similar_components(documents(spark, sf_dir), k=4, percent=85) \
        .drop("group", "text_hash")


@query("op4_source_mix")
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents drawn, once for each time, with every document at least
    once and no source more than twice."""
    mixed = mixing.mix(documents(spark, sf_dir), "source", max_repeats=2.0)
    return mixed.select("doc_id", "source", "epoch", "mix_key", "weight", "mix_tokens")


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of every document, and which pass the cutoffs chosen on the
    labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.apply_rules(documents(spark, sf_dir), labels)


@query("op6_html_extract")
def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return html_extract.extract_text(pages, "html").select(
        "page_id", "url", F.col("main_text").alias("text"),
        F.length("main_text").cast("long").alias("n_chars"))


@query("op7_embedding_dedup")
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings by cosine: links of each, and one kept of each component."""
    return embedding_dedup.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op8_pii_crf")
def op8_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts of the base patterns' spans, a
    digest of them, and all spans with those the field adds."""
    found = pii_crf.find_personal_data(documents(spark, sf_dir).select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(col: str) -> Column:
        return F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])),
                            ",")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in pii_crf.KINDS],
        F.sha2(F.encode(joined("base_spans"), "UTF-8"), 256).alias("base_sha256"),
        joined("all_spans").alias("spans"))


@query("op9_sharding")
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 contiguous shards of nearly the same bytes."""
    return sharding.assign_shards(documents(spark, sf_dir), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2,048 tokens."""
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_file(), 2048)


@query("op11_fill_in_middle", """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT *, len(u) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
             ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                       OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
             array_to_string(u[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
""")
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into prefix, middle and suffix and put in its new
    order, with digests of the output and of the text rebuilt from it."""
    made = fill_in_middle.fill_in_middle(documents(spark, sf_dir).select("doc_id", "text"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(back, 256).alias("restored_sha256"))


@query("op12_cost_packing")
def op12_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2,048 tokens without padding, with
    balanced attention cost."""
    return cost_packing.pack_balanced(documents(spark, sf_dir), tokenizer_file(), 2048).drop("cost")


@query("op13_conversation_trie", """
WITH t AS (SELECT conv_id AS c, length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS x,
                  strlen(coalesce(text, '')) AS bytes, row_number() OVER (
                    PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS i
           FROM conversations WHERE conv_id IS NOT NULL),
v AS (SELECT DISTINCT c, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(string_split(c::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
               lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda p, q:
                 CASE WHEN p & 1 = 1 THEN xor(p >> 1, 3988292384) ELSE p >> 1 END))) % 9 AS h FROM t),
o AS (SELECT v.c, t.i AS pos, t.x, t.bytes FROM v JOIN t ON t.c = v.c - v.c % 5 AND t.i < v.h),
s AS (SELECT v.c, v.h - count(o.c) AS up FROM v LEFT JOIN o USING (c) GROUP BY v.c, v.h),
r AS (SELECT * FROM o UNION ALL
      SELECT t.c, t.i - s.up, t.x, t.bytes FROM t JOIN v USING (c) JOIN s USING (c) WHERE t.i >= v.h),
m AS (SELECT c, 0 AS d, '' AS k, '' AS pk, 0 AS bytes FROM v UNION ALL
      SELECT c, pos + 1, k, coalesce(lag(k) OVER (PARTITION BY c ORDER BY pos), ''), bytes
      FROM (SELECT c, pos, bytes, md5(string_agg(md5(x), '') OVER (PARTITION BY c ORDER BY pos)) AS k FROM r)),
z AS (SELECT c, max(d) AS d FROM m GROUP BY c),
n AS (SELECT m.d, m.k, any_value(m.pk) AS pk, min(m.c) AS c, count(*) AS n, any_value(m.bytes) AS bytes,
             coalesce(string_agg(m.c::VARCHAR, ',' ORDER BY m.c) FILTER (z.d = m.d), '') AS ends
      FROM m JOIN z USING (c) GROUP BY m.d, m.k),
q AS (SELECT d - 1 AS d, pk AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
u AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN q USING (d, k)),
w AS (SELECT m.d, m.k, count(*) FILTER (u.n_children = 0) AS n_leaves, sum((u.n - 1) * u.bytes) AS saved
      FROM u JOIN m ON m.c = u.c AND m.d <= u.d GROUP BY m.d, m.k)
SELECT u.c AS conv_id, u.d::BIGINT AS depth, p.c AS parent_conv_id, u.n AS n_convs, u.n_children,
       w.n_leaves, w.saved::BIGINT AS saved_tokens, sha256(u.ends) AS ends_sha256
FROM u JOIN w USING (d, k) LEFT JOIN u AS p ON p.d = u.d - 1 AND p.k = u.pk
""")
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt with shared openings."""
    return conversation_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
