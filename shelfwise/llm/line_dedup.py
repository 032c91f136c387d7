"""Boilerplate lines by their site-relative frequency.

For every host, the share of its pages that contain a line; lines over a ratio
are boilerplate of that host and go from all its pages.  Lines travel as 128-bit
hashes, pages as hashes of host and text: the text itself is never exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import fresh, require_columns
from shelfwise.session import materialize


def host_of(url: Column) -> Column:
    """Lower-cased host of a URL, without a leading ``www.``; null if none."""
    host = F.regexp_replace(F.lower(F.parse_url(url, F.lit("HOST"))), r"^www\.", "")
    return F.when(host != "", host)


def _line_key(line: Column) -> Column:
    """Two 64-bit hashes of a line without the white space around it."""
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("h1"), F.xxhash64(F.lit(1), bare).alias("h2"))


def line_keys(text: Column) -> Column:
    """Distinct keys of the lines of a text that hold anything."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    return F.array_distinct(F.transform(lines, _line_key))


def drop_boilerplate(df: DataFrame, host: Column | str = "source", text_col: str = "text",
                     max_ratio: float = 0.02, min_pages: int = 5, distinct_pages: bool = False,
                     max_part: float = 1.0) -> DataFrame:
    """Rows of ``df`` with boilerplate lines taken from ``text_col``, and the
    columns ``n_lines`` (lines that hold anything) and ``n_dropped`` (of those,
    the lines taken).

    A line is boilerplate of a host if at least ``min_pages`` of its pages, and
    more than ``max_ratio`` of them, contain it.  Lines are compared without the
    spaces around them; a line counts once a page; empty lines stay where they
    are.  A text of which nothing is left is empty, not null.

    A null host is a host; a null text is a page without lines and stays null.
    Repeated rows are pages of their own, or with ``distinct_pages`` equal texts
    of a host are one page together.  A page of whose characters, white space
    around lines aside, boilerplate makes up more than ``max_part`` is taken for
    a copy of others and stays whole.  Empty input gives an empty table.
    Existing columns ``n_lines`` and ``n_dropped`` are replaced; all others stay.
    """
    require_columns(df, [text_col])
    df = df.drop("n_lines", "n_dropped")
    own = df.columns
    hc, k1, k2, bad = fresh(df, "ld_host", "ld_k1", "ld_k2", "ld_bad")
    host = F.col(host) if isinstance(host, str) else host
    pages = df.withColumn(hc, F.xxhash64(host.cast("string"), host.isNull())) \
        .withColumn(k1, F.xxhash64(text_col)).withColumn(k2, F.xxhash64(F.lit(1), F.col(text_col)))

    each = pages.select(hc, k1, k2)
    totals = (each.distinct() if distinct_pages else each).groupBy(F.col(hc).alias("t_host")).agg(
        F.count("*").alias("pages"))
    lines = pages.select(hc, k1, k2, F.explode(line_keys(F.col(text_col))).alias("key")) \
        .select(F.col(hc).alias("host"), F.col(k1).alias("p1"), F.col(k2).alias("p2"), "key.*")
    counted = lines
    if distinct_pages:
        # copies are combined before the shuffle, which carries hashes only
        bodies = pages.select(hc, k1, k2, line_keys(F.col(text_col)).alias("keys")) \
            .groupBy(hc, k1, k2).agg(F.first("keys").alias("keys"))
        counted = bodies.select(F.col(hc).alias("host"), F.explode("keys").alias("key")) \
            .select("host", "key.*")
    counts = counted.groupBy("host", "h1", "h2").agg(F.count("*").alias("n")) \
        .filter(F.col("n") >= min_pages)
    frequent = counts.join(totals, F.col("host") == F.col("t_host")) \
        .filter(F.col("n") > F.lit(max_ratio) * F.col("pages")) \
        .select(F.col("host").alias("b_host"), F.col("h1").alias("b1"), F.col("h2").alias("b2"))
    frequent = materialize(frequent, "boilerplate")

    # The boilerplate on each page, one row for each distinct page that has any.
    found = lines.join(frequent, (F.col("host") == F.col("b_host")) & (F.col("h1") == F.col("b1"))
                       & (F.col("h2") == F.col("b2")), "left_semi")
    on_page = found.groupBy(F.col("host").alias("f_host"), F.col("p1").alias("f1"),
                            F.col("p2").alias("f2")).agg(
        F.collect_set(F.struct("h1", "h2")).alias(bad))
    joined = pages.join(on_page, (F.col(hc) == F.col("f_host")) & (F.col(k1) == F.col("f1"))
                        & (F.col(k2) == F.col("f2")), "left")

    every = F.split(F.col(text_col), "\n")
    kept = F.filter(every, lambda x: ~F.array_contains(F.col(bad), _line_key(x)) | (F.trim(x) == ""))
    if max_part < 1:
        def chars(lines: Column) -> Column:
            return F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + F.length(F.trim(x)))
        joined = joined.withColumn(bad, F.when(
            F.col(bad).isNotNull() & (chars(kept) >= (1 - max_part) * chars(every)), F.col(bad)))
    full = F.when(F.col(text_col).isNull(), 0).otherwise(
        F.size(F.filter(every, lambda x: F.trim(x) != "")))
    text = F.when(F.col(bad).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    dropped = F.when(F.col(bad).isNull() | F.col(text_col).isNull(), 0).otherwise(
        F.size(every) - F.size(kept))
    return joined.select(
        *[text.alias(c) if c == text_col else F.col(c) for c in own],
        full.cast("long").alias("n_lines"), dropped.cast("long").alias("n_dropped"))
