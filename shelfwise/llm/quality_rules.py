"""Quality rules with risk-controlled cutoffs.

Rules are cutoffs on ratios of a text (symbols to words, repeated lines to
lines, ...).  Labelled holdout documents choose them: for each stratum the
sharpest of a sequence of rule sets for which exact binomial tests show that
good documents are rejected less often than allowed by all rules together.
Where the labels are too few to show it, nothing is cut.

Only DataFrame functions are used: counting, testing and choosing are joins and
aggregates, and texts are measured row by row inside the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import SPACE_CLASS, fresh, require_columns
from shelfwise.session import materialize

SPACES = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

#: Feature → ladder of cutoffs from sharp to mild; a document with a larger
#: value is rejected.
LADDERS: Mapping[str, Sequence[float]] = {
    "symbol_ratio": (0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0),
    "dup_line_ratio": (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7),
    "repeat_ratio": (0.01, 0.02, 0.05, 0.08, 0.1, 0.12, 0.15, 0.18),
    "long_words": (6.0, 6.5, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0),
    "short_words": (-4.0, -3.5, -3.0, -2.5, -2.0, -1.5),
}


def measured(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``n_words, word_chars, n_symbols, n_lines, n_dup_lines`` and
    ``n_repeat_words`` (long) of its whole texts; a null text has none of them.

    A word is a run without ASCII white space.  ``n_dup_lines`` counts lines
    holding a word that equal an earlier line; ``n_repeat_words`` the words in
    windows of five words that the text has twice or more, the first included.
    Windows are told apart by 64-bit hashes.  Existing columns of these names
    are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    df = df.drop(*names)
    own = df.columns
    t, w, h, o, ls = fresh(df, "q_text", "q_words", "q_hashes", "q_sorted", "q_lines")
    df = df.withColumn(t, F.coalesce(F.col(text_col), F.lit("")))
    bare = F.btrim(F.col(t), F.lit(SPACES))
    df = df.withColumn(w, F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, SPACE_CLASS + "+")))
    df = df.withColumn("n_words", F.size(w).cast("long"))
    df = df.withColumn(h, F.when(F.col("n_words") > WINDOW, F.transform(
        F.sequence(F.lit(1), (F.col("n_words") - (WINDOW - 1)).cast("int")),
        lambda i: F.xxhash64(F.slice(F.col(w), i, WINDOW)))))
    # only texts that repeat a window have their windows put in order
    df = df.withColumn(o, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(
        F.transform(F.col(h), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    n = F.size(o)

    def twin(x: Column, i: Column) -> Column:
        here = F.col(o)
        return ((i > 0) & (F.get(here, i - 1)["h"] == x["h"])) | (
            (i < n - 1) & (F.get(here, i + 1)["h"] == x["h"]))

    places = F.sort_array(F.transform(F.filter(F.col(o), twin), lambda x: x["i"]))
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("words"), F.lit(0).alias("end")),
        lambda a, p: F.struct((a["words"] + p + WINDOW - F.greatest(p, a["end"])).alias("words"),
                              (p + WINDOW).alias("end")), lambda a: a["words"])
    df = df.withColumn(ls, F.filter(F.split(F.col(t), "\n"),
                                    lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    return df.select(
        *own, "n_words",
        (F.length(t) - F.regexp_count(F.col(t), F.lit(SPACE_CLASS))).cast("long").alias("word_chars"),
        F.regexp_count(F.col(t), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size(ls).cast("long").alias("n_lines"),
        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        F.when(F.col(o).isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    """Fewer than ten words, or over a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def features() -> dict[str, Column]:
    """Values of :data:`LADDERS` from the columns of :func:`measured`."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {
        "symbol_ratio": F.col("n_symbols") / words,
        "dup_line_ratio": F.col("n_dup_lines") / lines,
        "repeat_ratio": F.col("n_repeat_words") / words,
        "long_words": F.col("word_chars") / words,
        "short_words": -F.col("word_chars") / words,
    }


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of a binomial(n, p): the terms from k down relative to that of
    k, times that of k, in logarithms so that large n do not underflow."""
    odds = (1 - p) / p
    terms = F.aggregate(
        F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(F.array().cast("array<int>")),
        F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda a, i: F.struct(
            (a["sum"] + a["term"] * (k - i + 1) / (n - k + i) * odds).alias("sum"),
            (a["term"] * (k - i + 1) / (n - k + i) * odds).alias("term")), lambda a: a["sum"])
    choose = F.aggregate(
        F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(F.array().cast("array<int>")),
        F.lit(0.0), lambda a, i: a + F.log((n - k + i) / i))
    top = choose + k * math.log(p) + (n - k) * math.log1p(-p)
    return F.least(F.lit(1.0), F.exp(top + F.log(terms)))


def choose_cutoffs(labelled: DataFrame, stratum: str, good: str = "good",
                   max_false: float = 0.02, confidence: float = 0.95,
                   ladders: Mapping[str, Sequence[float]] = LADDERS) -> DataFrame:
    """One row for each stratum of ``labelled`` that has good documents (a row
    for each document: the stratum, ``good``, and the features): the stratum and
    a column for each feature with its cutoff, null where none could be shown.

    With the given confidence, for all strata at once, at most ``max_false`` of
    a stratum's good documents fall to all the rules together.  Each stratum has
    a path of rule sets, every one with one more cutoff than the last and a
    feature's cutoffs from mild to sharp; the sets are tested in turn for what
    all their rules reject together, and the last one before the first that
    fails is taken.  Such a fixed sequence needs no correction for its length,
    so the level is ``1 - confidence`` over the number of strata.  Strata in
    which no false rejection at all would still show nothing are not tested.

    The order of the path has to be known without the good documents: cutoffs
    that catch many bad ones for all those not known to be good that they reject
    come first, then the order of ``ladders``.  Rows with a null label count for
    that order only.
    """
    steps = [(f, float(c)) for f, cuts in ladders.items() for c in reversed(cuts)]
    places = {f: [i for i, (g, _) in enumerate(steps) if g == f] for f in ladders}
    firsts = {f: f"{f}__first" for f in ladders}  # the mildest step of the feature that rejects
    label = F.when(F.col(good) == 1, 1).when(F.col(good).isNotNull(), 0)
    groups = labelled.select(F.col(stratum).alias("g_stratum"), label.alias("g_good"), *[
        F.coalesce(*[F.when(F.col(f) > steps[i][1], F.lit(i)) for i in at]).alias(firsts[f])
        for f, at in places.items()])
    groups = materialize(groups.groupBy(*groups.columns).agg(F.count("*").alias("rows")),
                         "quality-groups")

    def rows(which: Column) -> Column:
        return F.coalesce(F.sum(F.when(which, F.col("rows"))), F.lit(0))

    def worth(i: int) -> Column:
        here = F.col(firsts[steps[i][0]]) == i
        return rows(here & (F.col("g_good") == 0)) / F.greatest(
            rows(here & ~F.col("g_good").eqNullSafe(1)), F.lit(1))

    strata = groups.groupBy(F.col("g_stratum").alias("p_stratum")).agg(
        rows(F.col("g_good") == 1).alias("n"),
        F.array(*[worth(i) for i in range(len(steps))]).alias("worth")).filter("n > 0")
    # a mild step is worth as much as the best of the sharper ones behind it
    ranks = [F.struct((-F.array_max(F.slice("worth", i + 1, places[f][-1] - i + 1))).alias("w"),
                      F.lit(i).alias("i")) for i, (f, _) in enumerate(steps)]
    strata = strata.withColumn("path", F.transform(F.sort_array(F.array(*ranks)), lambda x: x["i"]))
    # one row a stratum: as many of the largest as can show something at their common level
    strata = strata.withColumn("nth", F.count("*").over(Window.orderBy(F.desc("n"))))
    able = F.when(F.col("n") * math.log1p(-max_false) <= F.log((1 - confidence) / F.col("nth")),
                  F.col("nth"))
    strata = strata.withColumn("tested", F.max(able).over(Window.partitionBy()))

    at_step = F.array_min(F.array(*[F.array_position("path", F.col(c)) for c in firsts.values()]))
    counts = groups.filter("g_good = 1").join(
        strata, F.col("g_stratum").eqNullSafe(F.col("p_stratum"))).withColumn("at_step", at_step)
    counts = counts.groupBy("p_stratum", "n", "path", "nth", "tested").agg(F.array(*[
        rows(F.col("at_step") <= k) for k in range(1, len(steps) + 1)]).alias("rejected"))
    level = (1 - confidence) / F.col("tested")

    def shown(k: Column) -> Column:
        # more rejected than allowed cannot pass; their tail is not worked out
        return F.when(k <= max_false * F.col("n"), binomial_tail(k, F.col("n"), max_false) <= level) \
            .otherwise(False)
    # sets only grow along the path, so those that pass are its beginning
    done = F.when(F.col("nth") <= F.col("tested"), F.size(F.filter("rejected", shown))).otherwise(0)
    counts = counts.withColumn("done", done)
    return counts.select(F.col("p_stratum").alias(stratum), *[F.coalesce(*[
        F.when(F.array_position("path", F.lit(i)) <= F.col("done"), F.lit(steps[i][1]))
        for i in reversed(at)]).alias(f) for f, at in places.items()])


def apply_rules(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                stratum_col: str = "lang", label_col: str = "quality",
                max_false: float = 0.02, confidence: float = 0.95) -> DataFrame:
    """One row for each row of ``df``: identifier, stratum, the measures,
    ``base_failed`` and ``kept``.

    Cutoffs are chosen on the documents of ``labels`` (identifier, label 0 or 1)
    that pass the base rules (see :func:`choose_cutoffs`).  A stratum without labels of its own has no
    cutoffs.  A null stratum is a stratum; null identifiers match no label; a
    document with several labels counts as good only if all say so.  Null and
    empty texts fail the base rules.  Repeated rows are rows of their own, and
    an empty table gives an empty table.
    """
    require_columns(df, [id_col, text_col, stratum_col])
    rows = df.select(F.col(id_col).alias("id"), F.col(stratum_col).alias("stratum"),
                     F.col(text_col).alias("text"))
    rows = measured(rows, "text").drop("text").withColumn("base_failed", base_failed())
    rows = materialize(rows, "quality-measures")
    scored = rows.select("*", *[c.alias(f) for f, c in features().items()])

    one = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("l_id")).agg(
        F.min(label_col).alias("good"))
    passed = scored.filter(~F.col("base_failed"))
    held = passed.filter("id is not null").join(one, F.col("id") == F.col("l_id"), "left").drop("l_id")
    # null identifiers would all meet in one task of the join
    held = held.unionByName(passed.filter("id is null"), allowMissingColumns=True)
    cutoffs = choose_cutoffs(held, "stratum", "good", max_false, confidence)
    cutoffs = materialize(cutoffs.select(F.col("stratum").alias("c_stratum"), *[
        F.col(f).alias(f"cut_{f}") for f in LADDERS]), "quality-cutoffs")
    joined = scored.join(cutoffs, F.col("stratum").eqNullSafe(F.col("c_stratum")), "left")
    over = F.lit(False)
    for f in LADDERS:
        over = over | F.coalesce(F.col(f) > F.col(f"cut_{f}"), F.lit(False))
    return joined.select(
        F.col("id").alias(id_col), F.col("stratum").alias(stratum_col), "n_words", "word_chars",
        "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~over).alias("kept"))
