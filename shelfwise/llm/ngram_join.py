"""Exact Jaccard join of documents on word n-grams as a blocked sparse product.

The product of the document by n-gram incidence matrix with its transpose holds
the overlap of every two documents.  It is worked out in blocks of columns:

1. *Leading block.*  A fixed quarter of the hash space and every document's
   first n-grams in a global order (rare ones by hash, then frequent ones).
   Two sets over the threshold share one of their first ``n - need + 1``
   n-grams, so only pairs meeting there are entries of the product at all.
2. A pair is discarded when it cannot reach the size-derived bound
   ``t / (1 + t) * (a + b)``: first by the parities of its n-grams in 512 bins (as
   many n-grams as there are unequal bins are in one set only), then by their
   overlap in the quarter, accumulated, plus all remaining columns.
3. *Remaining block.*  Survivors accumulate the rest and are decided exactly.

Equal sets are one row of the matrix.  Only components are asked for, so pairs
whose documents are linked through others already are not worked out again.  A
first pass tries every document with one other of its leading n-gram; some more
try, for every n-gram, one document of each component that has it with one of
them; the full product then takes the pairs across the components found.  No
pair of different components is left out, and a group of documents that are
alike is never expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import (chained, connected_components, drop_scratch, fresh, require_columns,
                                  text_runs, word_hashes)
from shelfwise.session import materialize

#: Hashes (unsigned) below this are the leading quarter of the columns.
LEAD = 1 << 62
#: An n-gram in more documents than this comes last in the global order.
FREQUENT = 48
#: Words of 64 bins each in which the parities of a set's n-grams are kept.
PARITY = [f"p{i}" for i in range(8)]
#: Passes between components before the full product: they only save work.
PASSES = 3
#: Entries of a set that are carried along to tell where a pair meets first.
BEFORE = 16
#: Keys that may be broadcast (of 8 bytes); more are joined by shuffling.
BROADCAST_KEYS = 2_000_000


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's ``k``-word shingles; of
    all its words if they are fewer; nothing if there are none.

    Words are runs without ASCII white space, A-Z in lower case.
    """
    words, begin = word_hashes(texts)
    n = len(words) - k + 1
    windows = chained([words[j:n + j] for j in range(k)]) if n > 0 else words[:0]
    out = []
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        if b - a >= k:
            got = np.sort(windows[a:b - k + 1])
            out.append(got[np.concatenate(([True], got[1:] != got[:-1]))])
        elif b > a:
            size = np.full(1, b - a, np.uint64)
            out.append(chained([size, *[words[j:j + 1] for j in range(a, b)]]))
        else:
            out.append(words[:0])
    return out


def _set_id(s: np.ndarray) -> int | None:
    import xxhash
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64)) if len(s) else None


def _parities(s: np.ndarray) -> np.ndarray:
    """Whether the number of hashes in each bin is odd, as words of 64 bins."""
    bins = 64 * len(PARITY)
    odd = np.bincount((s % np.uint64(bins)).astype(np.int64), minlength=bins) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def prefix_length(n, percent: int):
    """First n-grams of a set of ``n`` of which one is shared with any set that
    is similar enough."""
    return n - -(-percent * n // 100) + 1


def _sketch(k: int, percent: int, id_type: T.DataType):
    """Documents → identifier, set size, set hash, text hash, and once for each
    set and partition the set's leading hashes in order, how many of them lie in
    the leading quarter, and the parities."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in text_runs(texts):
                ns, ids, lead, inside, odd = [], [], [], [], []
                for s in shingle_sets(texts[a:b], k):
                    key = _set_id(s)
                    ns.append(len(s))
                    ids.append(key)
                    if key is None or key in seen:
                        lead.append(None)
                        inside.append(None)
                        odd.append((None,) * len(PARITY))
                        continue
                    seen.add(key)
                    q = int(np.searchsorted(s, np.uint64(LEAD)))
                    lead.append(s[:max(q, prefix_length(len(s), percent))].view(np.int64))
                    inside.append(q)
                    odd.append(_parities(s).tolist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(2)[a:b], pa.array(ns, pa.int64()),
                     pa.array(ids, pa.int64()), pa.array(lead, pa.list_(pa.int64())),
                     pa.array(inside, pa.int64()), *[pa.array(x, pa.int64()) for x in zip(*odd)]],
                    ["id", "th", "n", "sid", "lead", "inside", *PARITY])

    return run, T.StructType([
        T.StructField("id", id_type), T.StructField("th", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("sid", T.LongType()),
        T.StructField("lead", T.ArrayType(T.LongType())), T.StructField("inside", T.LongType()),
        *[T.StructField(p, T.LongType()) for p in PARITY]])


def _whole_sets(k: int):
    """Documents → set hash and the whole set, once for each set and partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            new = []
            for text, th in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if th not in seen:
                    seen.add(th)
                    new.append(text)
            for a, b in text_runs(new):
                sets = shingle_sets(new[a:b], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_set_id(s) for s in sets], pa.int64()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    ["sid", "whole"])
    return run, "sid long, whole array<long>"


def _needed(na: Column, nb: Column, percent: int) -> Column:
    """Least overlap of sets of these sizes: ceil(t / (1 + t) * (a + b))."""
    return F.ceil(percent * (na + nb) / F.lit(100 + percent))


def _possible(na: Column, nb: Column, percent: int) -> Column:
    """Can sets of these sizes, with their parities as ``p0_a``, ``p0_b``, ..., be
    similar enough?"""
    unequal = F.lit(0)
    for p in PARITY:
        unequal = unequal + F.bit_count(F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b")))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (
        unequal <= na + nb - 2 * _needed(na, nb, percent))


def _semi(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is in the written table ``keys``: broadcast up
    to a checked size, else by shuffling."""
    small = keys.count() <= BROADCAST_KEYS
    return df.join(F.broadcast(keys) if small else keys, key, "left_semi").select(*df.columns)


class _Product:
    """The incidence matrix of one call, and decisions on its entries."""

    def __init__(self, docs: DataFrame, sketches: DataFrame, k: int, percent: int):
        self.docs, self.sketches, self.k, self.percent = docs, sketches, k, percent

    def links(self, pairs: DataFrame) -> DataFrame:
        """Of ``pairs`` (a, b, na, nb): those over the threshold, exactly."""
        pairs = materialize(pairs, "ngram-pairs")
        rows = materialize(pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct(),
                           "ngram-rows")
        lead = _semi(self.sketches.filter("lead is not null"), rows, "sid") \
            .dropDuplicates(["sid"]).select("sid", F.slice("lead", 1, F.col("inside").cast("int"))
                                            .alias("part"), "inside", "th")
        lead = materialize(lead, "ngram-lead")

        def side(table: DataFrame, x: str, *cols: str) -> DataFrame:
            return table.select(F.col("sid").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in cols])

        both = pairs.join(side(lead, "a", "part", "inside"), "a").join(
            side(lead, "b", "part", "inside"), "b")
        most = F.size(F.array_intersect("part_a", "part_b")) + F.least(
            F.col("na") - F.col("inside_a"), F.col("nb") - F.col("inside_b"))
        left = both.filter(most >= _needed(F.col("na"), F.col("nb"), self.percent)) \
            .select("a", "b", "na", "nb")
        left = materialize(left, "ngram-left")
        named = left.select(F.col("a").alias("sid")).union(left.select("b")).distinct()
        texts = materialize(lead.join(named, "sid", "left_semi").select("th").distinct(), "ngram-texts")
        run, schema = _whole_sets(self.k)
        whole = _semi(self.docs.select("text", "th"), texts, "th").mapInArrow(run, schema) \
            .dropDuplicates(["sid"])
        whole = materialize(whole, "ngram-whole")
        both = left.join(side(whole, "a", "whole"), "a").join(side(whole, "b", "whole"), "b")
        overlap = F.size(F.array_intersect("whole_a", "whole_b"))
        found = materialize(both.filter(
            100 * overlap >= self.percent * (F.col("na") + F.col("nb") - overlap)).select("a", "b"),
            "ngram-links")
        for done in (pairs, rows, lead, left, texts, whole):
            drop_scratch(done)
        return found


def _leading_entries(sketches: DataFrame, percent: int) -> DataFrame:
    """A written table (h, sid, n, at): the n-grams among each set's first in the global order,
    of those that more than one set or copy has.

    The order: n-grams of the leading quarter by hash, the frequent ones of
    them after the others, then all other n-grams by hash.  All n-grams of the
    quarter are counted, so which are frequent is the same for every set.
    """
    entries = sketches.filter("lead is not null").select(
        "sid", (F.col("n") + F.col("inside") * F.lit(1 << 32)).alias("sizes"),
        F.posexplode("lead").alias("pos", "h"))
    counts = entries.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    live = entries.join(counts, "h").select(
        "h", "sid", F.expr(f"sizes % {1 << 32}").alias("n"), F.expr(f"sizes div {1 << 32}").alias("inside"),
        "pos", ((F.col("df") > FREQUENT) & (F.col("h") >= 0) & (F.col("h") < LEAD)).alias("frequent"))
    live = materialize(live.distinct(), "ngram-live")
    late = live.filter("frequent").groupBy(F.col("sid").alias("f_sid")).agg(
        F.collect_list("pos").alias("late"))
    ranked = live.join(late, F.col("sid") == F.col("f_sid"), "left")
    behind = F.coalesce(F.size(F.filter("late", lambda x: x < F.col("pos"))), F.lit(0))
    behind = F.when(F.col("late").isNull(), 0).otherwise(behind)
    in_quarter = (F.col("h") >= 0) & (F.col("h") < LEAD)
    at = F.when(F.col("frequent"), F.col("inside") - F.size("late") + behind) \
        .when(in_quarter, F.col("pos") - behind).otherwise(F.col("pos"))
    first = F.expr(f"n - (({percent} * n + 99) div 100) + 1")
    out = materialize(ranked.select("h", "sid", "n", at.cast("long").alias("at"))
                      .filter(F.col("at") < first), "ngram-entries")
    drop_scratch(live)
    return out


def similar_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                       percent: int = 80) -> DataFrame:
    """One row for each row of ``df``: its identifier, ``n_shingles`` (size of
    its set of ``k``-word shingles), ``component_id`` (smallest identifier
    reachable over links), ``group`` (a number for its component, null for an
    empty set) and ``text_hash`` (xxhash64 of its text).

    Two documents are linked when 100 * intersection >= ``percent`` * union of
    their sets; the decision is exact but for 64-bit hashes standing for
    shingles and sets.  Every row is a document, repeated ones too.  Null and
    empty texts and texts without a word have an empty set, are linked with
    nothing and keep their own identifier.  A null identifier is ignored among
    others; a component of nothing else has a null one.  Empty input gives an
    empty table; extra columns are not looked at.
    """
    require_columns(df, [id_col, text_col])
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                     F.xxhash64(text_col).alias("th"))
    run, schema = _sketch(k, percent, df.schema[id_col].dataType)
    sketches = materialize(docs.select("id", "text", "th").mapInArrow(run, schema), "ngram-sketches")
    product = _Product(docs, sketches, k, percent)
    entries = _leading_entries(sketches, percent)

    known = materialize(sketches.filter("lead is not null").join(
        entries.select("sid").distinct(), "sid", "left_semi").select("sid", *PARITY)
        .dropDuplicates(["sid"]), "ngram-parities")

    def named(side: str, *cols: str) -> list[Column]:
        return [F.col(c).alias(f"{c}_{side}") for c in cols]

    # First pass: every set with the smallest one of the same first shared n-gram.
    first = entries.groupBy("sid").agg(F.min_by("h", "at").alias("h"), F.first("n").alias("n"))
    first = first.join(known, "sid")
    heads = first.groupBy("h").agg(F.min("sid").alias("sid"))
    heads = first.join(heads.select(F.col("sid").alias("head")), F.col("sid") == F.col("head"), "left_semi")
    possible = _possible(F.col("n_a"), F.col("n_b"), percent)
    seeds = heads.select(*named("a", "h", "sid", "n", *PARITY)).join(
        first.select(*named("b", "h", "sid", "n", *PARITY)),
        (F.col("h_a") == F.col("h_b")) & (F.col("sid_a") != F.col("sid_b")) & possible).select(
        F.col("sid_a").alias("a"), F.col("sid_b").alias("b"), F.col("n_a").alias("na"),
        F.col("n_b").alias("nb"))
    groups = materialize(connected_components(product.links(seeds)), "ngram-groups")

    def open_entries() -> DataFrame:
        """Entries of the n-grams that several components have, with their component ``c``."""
        placed = materialize(entries.join(groups, F.col("sid") == F.col("node"), "left").select(
            "h", "sid", "n", "at", F.coalesce("component", "sid").alias("c")), "ngram-placed")
        mixed = placed.groupBy(F.col("h").alias("m_h")).agg(
            F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("m_h")
        out = materialize(placed.join(mixed, F.col("h") == F.col("m_h"), "left_semi"), "ngram-open")
        drop_scratch(placed)
        return out

    def joined(left: DataFrame, right: DataFrame, which: Column, *more: str) -> DataFrame:
        """Pairs with a common n-gram that ``which`` holds for and that are possible."""
        return left.join(known, "sid").select(*named("a", "h", "sid", "n", "c", *more, *PARITY)).join(
            right.join(known, "sid").select(*named("b", "h", "sid", "n", "c", *more, *PARITY)),
            (F.col("h_a") == F.col("h_b")) & which & (F.col("c_a") != F.col("c_b")) & possible).select(
            F.col("sid_a").alias("a"), F.col("sid_b").alias("b"), F.col("n_a").alias("na"),
            F.col("n_b").alias("nb")).distinct()

    def grown(more: DataFrame) -> DataFrame:
        so_far = groups.filter("node <> component").select(
            F.col("node").alias("a"), F.col("component").alias("b"))
        return materialize(connected_components(so_far.unionByName(more)), "ngram-groups")

    # Between components: one of each, picked anew in each pass, with one of the n-gram.
    for turn in range(PASSES):
        entry = open_entries()
        pick = F.xxhash64(F.lit(turn), "sid")
        ones = entry.groupBy("h", "c").agg(F.min_by(F.struct("sid", "n"), pick).alias("one")) \
            .select("h", "c", "one.*")
        heads = ones.groupBy("h").agg(F.min_by(F.struct("sid", "n", "c"), pick).alias("one")) \
            .select("h", "one.*")
        more = product.links(joined(heads, ones, F.lit(True)))
        drop_scratch(entry)
        if more.isEmpty():
            break
        groups = grown(more)

    # The full product, across the components found.  A pair has an entry at each
    # n-gram its sets share among their first; it is taken at the first of them in the
    # global order, behind which lies all they share: the rest of both has to be long
    # enough.  ``before``, a set's first entries ahead of this one, tells later ones
    # (not all of them: a pair may then come up again, and is decided once).
    entry = open_entries().groupBy("sid", "n", "c").agg(
        F.array_sort(F.collect_list(F.struct("at", "h"))).alias("own")).select(
        "sid", "n", "c", "own", F.posexplode("own").alias("pos", "e")).select(
        "sid", "n", "c", "e.h", "e.at", F.slice("own.h", 1, F.least("pos", F.lit(BEFORE))).alias("before"))
    rest = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    at_first = (F.col("sid_a") < F.col("sid_b")) & (rest >= _needed(F.col("n_a"), F.col("n_b"), percent)) \
        & ~F.arrays_overlap("before_a", "before_b")
    groups = grown(product.links(joined(entry, entry, at_first, "at", "before")))

    rows = sketches.select("id", "n", "sid", "th")
    classed = rows.join(groups, F.col("sid") == F.col("node"), "left").select(
        "id", "n", "th", "sid", F.coalesce("component", "sid").alias("class"))
    classed = materialize(classed, "ngram-classes")
    least = classed.filter("class is not null").groupBy(F.col("class").alias("l_class")).agg(
        F.min("id").alias("least"))
    out = classed.join(least, F.col("class") == F.col("l_class"), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("least"))
                      .alias("component_id"), F.col("class").alias("group"), F.col("th").alias("text_hash"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
             percent: int = 80) -> DataFrame:
    """Rows of ``df`` with one row of each component left: one with its smallest
    identifier (null after all others).  Rows with an empty set all stay.
    Columns stay as they are.
    """
    found = materialize(similar_components(df, id_col, text_col, k, percent), "ngram-found")
    c, t = fresh(df, "kept_id", "kept_hash")
    # by group, not by identifier: different texts may share one, or have none
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias(c),
                           F.col("text_hash").alias(t))).alias("first")
    keep = found.filter("group is not null").groupBy("group").agg(first).select(
        f"first.{c}", f"first.{t}")
    nothing = found.filter(F.col("n_shingles") == 0).select(
        F.col(id_col).alias(c), F.col("text_hash").alias(t)).distinct()
    here = (F.col(id_col).eqNullSafe(F.col(c))) & (F.xxhash64(text_col) == F.col(t))
    return df.join(keep, here).drop(c, t).dropDuplicates([id_col, text_col]).unionByName(
        df.join(nothing, here, "left_semi"))
