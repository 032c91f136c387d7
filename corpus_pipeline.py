"""A corpus from documents: language, boilerplate, near duplicates, mixture and
packed sequences, each stage an operator of ``shelfwise.llm``.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)``
and its result is written as Parquet and read again as the next one's ``docs``.
All but the last keep the columns of documents.  Each stage decides on all that
its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import language_id, line_dedup, mixing, ngram_join, packing
from shelfwise.llm.common import documents, fresh
from shelfwise.llm.queries import languages, tokenizer_file
from shelfwise.session import materialize

#: SQL has no automata, components of similarity joins or tokenizers.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that have a language: texts without a letter go."""
    lang, score = fresh(docs, "lang_pred", "lang_score")
    found = language_id.identify(docs, languages(docs), "text", lang, score)
    return found.filter(F.col(lang) != "und").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the boilerplate lines of their source.  Copies count
    once, and documents that are mostly such lines stay whole: they are copies,
    of which the next stage keeps one."""
    return line_dedup.drop_boilerplate(docs, "source", distinct_pages=True, max_part=0.5) \
        .select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is alike in 80 % of its 5-word shingles."""
    return ngram_join.keep_one(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to twice."""
    return mixing.mix(docs, "source", max_repeats=2.0).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2,048 tokens; one row for each piece."""
    return packing.pack_documents(docs, tokenizer_file(), 2048)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", drop_lines),
    ("ngram_join", one_of_each),
    ("source_mix", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
