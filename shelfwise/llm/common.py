"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import materialize

#: ASCII white space; everything else belongs to a word.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def drop_scratch(df: DataFrame) -> None:
    """Delete the files of a materialised table nobody will read again."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)  # noqa: SLF001 - Hadoop FS
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)  # noqa: SLF001


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working column names that clash with no column of ``df`` (matched
    without regard to case, as Spark resolves them)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def utf8_bytes(text: Column) -> Column:
    """Size of a text in UTF-8 bytes; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b",
                         max_rounds: int = 60) -> DataFrame:
    """Smallest vertex reachable from every vertex that has an edge.

    Alternating large-star / small-star rounds: each round hangs every vertex's
    larger neighbours (then all its smaller ones) on its smallest neighbour, so
    the forest gets flat after a logarithmic number of rounds whatever the
    diameter.  Minima are combined before the shuffle, so a hub costs one row
    for each task; every round is written to the shared scratch folder, which
    keeps the lineage short and survives lost executors.

    Returns ``(node, component)``; vertices without edges are not listed.
    Empty input gives an empty table.  Raises when ``max_rounds`` do not do.
    """
    def star(pairs: DataFrame) -> DataFrame:
        return pairs.filter("a > b").distinct()

    def fingerprint(pairs: DataFrame) -> tuple:
        """The same for the same set of pairs, in one small job."""
        return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")),
                               F.bit_xor(F.xxhash64(F.lit(1), "a", "b"))).first())

    now = materialize(star(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))),
                      "cc-edges")
    mark = fingerprint(now)
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = star(both.join(least, both["a"] == least["k"]).filter("b > a")
                     .select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = materialize(large, "cc-large")
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        joined = large.join(low, large["a"] == low["k"])
        small = star(joined.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
                     .unionByName(joined.select("a", F.col("m").alias("b"))))
        small = materialize(small, "cc-small")
        before, mark = mark, fingerprint(small)
        drop_scratch(large)
        drop_scratch(now)
        now = small
        if mark == before:
            roots = now.select(F.col("b").alias("node")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                roots.select("node", F.col("node").alias("component")))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


# ---------------------------------------------------------------- hashes of words, in numpy

_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so that multiplying loses nothing
_UNSTEP = np.uint64(pow(int(_STEP), -1, 1 << 64))
SPACE_BYTES = np.isin(np.arange(256), [32, *range(9, 14)])
#: ASCII characters that are no letter or digit.
MARK_BYTES = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chained(hashes: Sequence[np.ndarray]) -> np.ndarray:
    """One hash from several in order, element by element."""
    out = hashes[0]
    for h in hashes[1:]:
        out = out * _STEP + h
    return mixed(out)


def _byte_values() -> np.ndarray:
    low = np.arange(256, dtype=np.uint64)
    low[65:91] += np.uint64(32)  # A-Z as a-z
    return mixed((low + np.uint64(1)) * _STEP)


_VALUES = _byte_values()


def word_hashes(texts: Sequence[str | None], gaps: np.ndarray = SPACE_BYTES
                ) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, A-Z in lower case, and where each
    text's words begin (one more than there are texts).

    Words are runs of UTF-8 bytes that are not in ``gaps``.  The hash of a word
    is a polynomial in its bytes modulo 2**64, had from differences of one
    running sum over all texts.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    buf = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([False], ~gaps[buf]))))
    start, end = edge[0::2], edge[1::2]
    power = np.cumprod(np.full(len(buf), _STEP, np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUES[buf] * power)))
    back = np.cumprod(np.full(len(buf), _UNSTEP, np.uint64))
    words = mixed((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
    begins = np.cumsum([0, *[len(r) + 1 for r in raw]])
    return words, np.searchsorted(start, begins)


def text_runs(texts: Sequence[str | None], most: int = 4 << 20):
    """(begin, end) of runs of texts of at most so many characters together; a
    larger text is a run of its own."""
    at = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > at and size + n > most:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, len(texts)
