"""Temperature mixing of sources.

The weights are the sources' token shares raised to an exponent and normalised.
The exponent is bisected to meet a target: an entropy of the weights, or a limit
on how often a source is repeated.  The weights become rows as permutations
of whole sources: a source with a budget of 1.7 times its tokens gives one full
permutation of its documents and a second one cut where the budget is spent.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import WORD_CLASS, fresh, require_columns
from shelfwise.session import materialize

#: Leading bits of a permutation key that name a block of the permutation.
BLOCK_BITS = 12


def word_count(text: Column) -> Column:
    """Words of a text; 0 if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS + "+")), F.lit(0)).cast("long")


def weights_at(shares: Mapping[object, float], exponent: float) -> dict[object, float]:
    raised = {s: p ** exponent for s, p in shares.items() if p > 0}
    total = sum(raised.values())
    return {s: x / total for s, x in raised.items()}


def entropy(weights: Mapping[object, float]) -> float:
    """In bits."""
    return -sum(w * math.log2(w) for w in weights.values() if w > 0)


def _bisect(reached: Callable[[float], bool]) -> float:
    """Largest exponent in [0, 1] that ``reached`` holds for, taking it to hold
    up to some point; 0 if it holds nowhere."""
    if reached(1.0):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if reached(mid) else (low, mid)
    return low


def solve(tokens: Mapping[object, int], target_entropy: float | None = None,
          max_repeats: float | None = None) -> tuple[float, dict[object, float]]:
    """(exponent, weights) of the sources that have tokens.

    Exponent 1 is the corpus as it is, 0 all sources alike.  ``target_entropy``
    (bits) takes the largest exponent whose weights have at least that entropy;
    ``max_repeats`` the smallest one for which, with each source used at least
    once, none is used more often than that.
    """
    total = sum(tokens.values())
    shares = {s: n / total for s, n in tokens.items() if n > 0}
    if not shares:
        return 1.0, {}
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give one of target_entropy and max_repeats")
    if target_entropy is not None:
        exponent = _bisect(lambda x: entropy(weights_at(shares, x)) >= target_entropy)
    else:
        def too_often(x: float) -> bool:
            uses = [w / shares[s] for s, w in weights_at(shares, x).items()]
            return max(uses) / min(uses) > max_repeats
        exponent = 0.0 if not too_often(0.0) else _bisect(too_often)
    return exponent, weights_at(shares, exponent)


def mix(df: DataFrame, source_col: str = "source", text_col: str = "text",
        tokens: Column | None = None, target_entropy: float | None = None,
        max_repeats: float | None = None, budget: int | None = None, seed: int = 0,
        max_sources: int = 100_000) -> DataFrame:
    """The mixed corpus: rows of ``df``, each as often as its source's weight
    asks, with ``epoch`` (which permutation of its source, from 0), ``mix_key``
    (its place in that permutation) and ``weight`` (of its source).

    ``tokens`` counts a row's tokens (default: words).  ``budget`` is the number
    of tokens to draw; by default the least that uses every document once.
    A source's last permutation ends with the document that reaches its budget.

    Null sources are one source.  Rows without tokens, and sources that have
    only such rows, come once and weigh nothing.  Repeated rows are rows of
    their own.  Existing columns called ``epoch``, ``mix_key`` or ``weight`` are
    replaced; all others stay as they are.  More than ``max_sources`` sources
    raise an error: their totals are solved on the driver.
    """
    require_columns(df, [source_col, text_col])
    df = df.drop("epoch", "mix_key", "weight")
    spark, own = df.sparkSession, df.columns
    n_col, h_col = fresh(df, "mix_tokens", "mix_hash")
    counted = tokens if tokens is not None else word_count(F.col(text_col))
    plain = [c for c, t in df.dtypes if "map<" not in t and t != "variant"]
    rows = df.withColumn(n_col, F.coalesce(counted.cast("long"), F.lit(0))) \
        .withColumn(h_col, F.xxhash64(*plain))
    # three numbers a row are all that the plan needs
    slim = materialize(rows.select(F.col(source_col).alias("s"), F.col(n_col).alias("n"),
                                   F.col(h_col).alias("h")), "mix-sizes")

    totals = slim.groupBy("s").agg(F.sum("n").alias("t")) \
        .limit(max_sources + 1).collect()  # at most max_sources rows, or an error
    if len(totals) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    sizes = {r["s"]: r["t"] for r in totals}
    _, weights = solve(sizes, target_entropy, max_repeats)
    drawn = budget if budget is not None else max(
        (math.ceil(sizes[s] / w) for s, w in weights.items()), default=0)
    plan = []
    for s, t in sizes.items():
        want = round(weights.get(s, 0.0) * drawn)
        # a hair over or under a whole number of uses is that number
        full, rest = divmod(want, t) if t else (1, 0)
        if t and t - rest <= 1e-9 * want + 1:
            full, rest = full + 1, 0
        plan.append((s, weights.get(s, 0.0), int(full), int(rest if rest > 1e-9 * want + 1 else 0)))
    source_type = df.schema[source_col].dataType.simpleString()
    key, epoch, src, cut, used = fresh(df, "mix_key", "epoch", "mix_source", "mix_rest", "mix_full")
    uses = spark.createDataFrame(plan, f"{src} {source_type}, weight double, {used} long, {cut} long")

    def permuted(of: Column, hashed: Column) -> Column:
        return F.xxhash64(F.lit(seed), of, hashed)

    # Where does the last, partial permutation of each source end?  Whole blocks of
    # keys are counted; only the block that the budget ends in is put in order.
    # broadcast: at most max_sources rows
    last = slim.filter("n > 0").join(F.broadcast(uses), F.col("s").eqNullSafe(F.col(src))).filter(
        F.col(cut) > 0).select("s", permuted(F.col(used).cast("int"), F.col("h")).alias("k"), "n",
                               F.col(cut).alias("rest"))
    last = last.withColumn("block", F.shiftrightunsigned("k", 64 - BLOCK_BITS))
    sums = last.groupBy("s", "block", "rest").agg(F.sum("n").alias("n"))
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy("s").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)))
    edge = sums.filter("before < rest and before + n >= rest").select(
        F.col("s").alias("es"), F.col("block").alias("eb"), "before")
    inside = last.join(F.broadcast(edge), F.col("s").eqNullSafe(F.col("es"))
                       & (F.col("block") == F.col("eb")))  # one block a source
    unsigned = F.col("k").bitwiseXOR(F.lit(-2 ** 63))
    inside = inside.withColumn("upto", F.col("before") + F.coalesce(F.sum("n").over(
        Window.partitionBy("s").orderBy(unsigned).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)))
    ends = inside.filter("upto < rest").groupBy("s").agg(F.max(unsigned).alias("last_key"))
    ends = ends.select(F.col("s").alias("end_source"), "last_key")
    out = rows.join(F.broadcast(uses), F.col(source_col).eqNullSafe(F.col(src))).join(
        F.broadcast(ends), F.col(src).eqNullSafe(F.col("end_source")), "left")
    copies = F.col(used) + F.when((F.col(cut) > 0) & (F.col(n_col) > 0), 1).otherwise(0)
    out = out.withColumn(epoch, F.explode(F.when(F.col(n_col) == 0, F.array(F.lit(0))).when(
        copies > 0, F.sequence(F.lit(0), (copies - 1).cast("int"))).otherwise(
        F.array().cast("array<int>"))))
    out = out.withColumn(key, permuted(F.col(epoch), F.col(h_col)))
    keep = (F.col(epoch) < F.col(used)) | (F.col(n_col) == 0) | (
        F.col(key).bitwiseXOR(F.lit(-2 ** 63)) <= F.col("last_key"))
    return out.filter(keep).select(*own, F.col(epoch).alias("epoch"), F.col(key).alias("mix_key"),
                                   "weight", n_col)
