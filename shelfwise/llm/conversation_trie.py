"""Prefix trie of conversations by hashed blocks of turns.

A node of depth d is a distinct sequence of the first d turns.  Conversations are
first grouped by whole blocks of ``BLOCK`` turns: a row for each (conversation,
block) holds the fingerprint of the prefix before the block and after it, and
conversations with the same pair share the block, which becomes one row
whatever their number.  Single turns are looked at only after that, once for each
distinct block; blocks that other blocks follow the same prefix beside, where
siblings diverge, have their turn prefixes grouped, while a block without a sibling
gives its turns as nodes as they are.

The fingerprint of a prefix is the exclusive or, over its turns, of two 64-bit
hashes of (position, digest of role and text).  Being associative, it comes from
running totals in stretches of a conversation and totals of the stretches before,
so that no conversation has to be in one task as a whole.

Sums over subtrees need no walk up the tree.  Every node is represented by its
smallest member; the nodes that a conversation c represents are the end of its
path, and R(c) is the bytes of its path before them, those it shares with smaller
conversations (all, if it represents none).  Then the bytes saved below a node v
with ``pre`` bytes on the path before it are the sum of R(c) - pre over its
members but the smallest, and its leaves are those that its members represent.
Both are sums of one number for each conversation, gathered as the counts are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import require_columns
from shelfwise.session import materialize

BLOCK = 8
#: Turns of one conversation that are put in order, or summed up, by one task.
STRETCH = 4096
#: A key is hot if it has more than one row in so many; so many are at most hot.
HOT = 256
#: Conversations whose identifiers differ only in so many low bits are listed together.
LIST_BITS = 16

KEY = ["depth", "f1", "f2"]


def _prefix(col: Column, over) -> Column:
    return F.coalesce(col.over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def number_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turns in order: ``conv, slot, i, digest, bytes``, ``i`` from 0.

    Ordered by turn (null first), equal ones by the digest of role and text (a
    null role or text counts as empty).  A slot is a range of turn numbers; each
    is put in order on its own, and counts of the slots before give its first place.
    Rows without a conversation identifier are no conversation's and left out.
    """
    require_columns(df, [conv_col, turn_col, role_col, text_col])
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = df.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role), F.lit(":"), role, text))).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    rows = rows.withColumn("slot", F.coalesce(F.expr(f"turn div {STRETCH}"), F.lit(-2**62)))
    counts = rows.groupBy("conv", "slot").agg(F.count("*").alias("n"))
    begins = counts.select(F.col("conv").alias("c"), F.col("slot").alias("s"), _prefix(
        F.sum("n"), Window.partitionBy("conv").orderBy("slot")).alias("begin"))
    own = Window.partitionBy("conv", "slot").orderBy(F.col("turn").asc_nulls_first(), "digest")
    rows = rows.withColumn("at", F.row_number().over(own) - 1)
    return rows.join(begins, (F.col("conv") == F.col("c")) & (F.col("slot") == F.col("s"))).select(
        "conv", "slot", (F.col("begin") + F.col("at")).alias("i"), "digest", "bytes")


def share_openings(numbered: DataFrame, group: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Every conversation c again, with the first h turns of conversation
    ``c - c % group`` (all if it has fewer, none if there is no such one) in place
    of its own first h, where h is ``crc32(decimal c) % (most + 1)``: the
    conversations (``conv``) and their turns (``conv, pos, digest, bytes``).

    ``numbered`` (of ``number_turns``) is read several times: give a written table.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)
    heads = numbered.filter((F.col("i") < most) & (F.col("conv") % group == 0)).groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("i", "digest", "bytes"))).alias("head"))
    slots = numbered.select("conv", "slot").distinct()
    convs = slots.select("conv").distinct()
    opened = convs.select("conv", h.cast("int").alias("h"), (F.col("conv") - F.col("conv") % group).alias("base")) \
        .join(heads.select(F.col("conv").alias("base"), "head"), "base", "left") \
        .select("conv", "h", F.expr("CASE WHEN head IS NULL OR h = 0 THEN NULL ELSE slice(head, 1, h) END")
                .alias("head"))
    openings = opened.select("conv", F.posexplode("head").alias("pos", "t")).select(
        "conv", F.col("pos").cast("long").alias("pos"), "t.digest", "t.bytes")
    # where the opening is shorter than what it replaces, the turns behind it move up
    moved = opened.select("conv", (F.col("h") - F.coalesce(F.size("head"), F.lit(0))).alias("up")) \
        .filter("up > 0")
    moved = slots.join(moved, "conv").select(F.col("conv").alias("c"), F.col("slot").alias("s"), "up")
    rest = numbered.filter(F.col("i") >= h).join(
        moved, (F.col("conv") == F.col("c")) & (F.col("slot") == F.col("s")), "left").select(
        "conv", (F.col("i") - F.coalesce("up", F.lit(0))).alias("pos"), "digest", "bytes")
    return convs, openings.unionByName(rest)


def _paths(turns: DataFrame, block: int) -> DataFrame:
    """A row for each block of a conversation: ``conv, k, b1, b2, pre`` (its place,
    the fingerprint and bytes of the prefix before it), ``depth, f1, f2, post``
    (of the prefix after it) and its ``turns`` in order."""
    size = block * (STRETCH // block or 1)
    t = turns.select("conv", F.expr(f"pos div {size}").alias("stretch"), F.expr(f"pos div {block}").alias("k"),
                     "pos", F.xxhash64("pos", "digest").alias("h1"),
                     F.xxhash64(F.lit(1), "digest", "pos").alias("h2"), "bytes")
    sums = [F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"), F.sum("bytes").alias("x3")]
    totals = t.groupBy("conv", "stretch").agg(*sums)
    along = Window.partitionBy("conv").orderBy("stretch")
    begins = totals.select(F.col("conv").alias("c"), F.col("stretch").alias("s"),
                           _prefix(F.bit_xor("x1"), along).alias("s1"),
                           _prefix(F.bit_xor("x2"), along).alias("s2"),
                           _prefix(F.sum("x3"), along).alias("s3")).filter("s > 0")
    blocks = t.repartition("conv", "stretch").groupBy("conv", "stretch", "k").agg(
        F.array_sort(F.collect_list(F.struct("pos", "h1", "h2", "bytes"))).alias("turns"), *sums)
    inside = Window.partitionBy("conv", "stretch").orderBy("k")
    blocks = blocks.withColumns({"i1": _prefix(F.bit_xor("x1"), inside),
                                 "i2": _prefix(F.bit_xor("x2"), inside),
                                 "i3": _prefix(F.sum("x3"), inside)})
    joined = blocks.join(begins, (F.col("conv") == F.col("c")) & (F.col("stretch") == F.col("s")), "left")
    joined = joined.withColumns({f"b{j}": F.col(f"i{j}").bitwiseXOR(F.coalesce(f"s{j}", F.lit(0)))
                                 for j in (1, 2)})
    joined = joined.withColumn("pre", F.col("i3") + F.coalesce("s3", F.lit(0)))
    return joined.select("conv", "k", "b1", "b2", "pre",
                         (F.col("k") * block + F.size("turns")).alias("depth"),
                         F.col("b1").bitwiseXOR(F.col("x1")).alias("f1"),
                         F.col("b2").bitwiseXOR(F.col("x2")).alias("f2"),
                         (F.col("pre") + F.col("x3")).alias("post"), "turns")


#: Every turn of a block as a node: its key, its parent's fingerprint, bytes before
#: it and its own.
_STEPS = """transform(turns, (t, j) -> struct(
    t.pos + 1 AS depth,
    aggregate(slice(turns, 1, j + 1), b1, (s, x) -> s ^ x.h1) AS f1,
    aggregate(slice(turns, 1, j + 1), b2, (s, x) -> s ^ x.h2) AS f2,
    aggregate(slice(turns, 1, j), b1, (s, x) -> s ^ x.h1) AS p1,
    aggregate(slice(turns, 1, j), b2, (s, x) -> s ^ x.h2) AS p2,
    aggregate(slice(turns, 1, j), pre, (s, x) -> s + x.bytes) AS pre))"""


def _turn_by_turn(edges: DataFrame, *carried: str) -> DataFrame:
    return edges.select(*carried, F.explode(F.expr(_STEPS)).alias("step")).select(*carried, "step.*")


def _look_up(big: DataFrame, small: DataFrame, keys: list[str], share: str) -> DataFrame:
    """``big`` joined to ``small``, unique by ``keys``, whose column ``share`` is
    how many rows of ``big`` have the key.  Rows of the (at most ``HOT``) hot keys
    stay where they are, a broadcast of those keys' rows comes to them."""
    total = small.agg(F.sum(share)).first()[0] or 0
    limit = total // HOT
    few = small.filter(F.col(share) > limit).drop(share)
    many = small.filter(F.col(share) <= limit).drop(share)
    cold = big.join(F.broadcast(few.select(*keys)), keys, "left_anti").join(many, keys)
    return big.join(F.broadcast(few), keys).unionByName(cold)


def _digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined identifiers that end at each node.

    Lists of neighbouring identifiers (at most 2**``LIST_BITS``) are joined first;
    a node's lists then go through the hash one after the other."""
    part = F.shiftright("conv", LIST_BITS).alias("part")
    lists = ends.groupBy(*KEY, part).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, done = None, None, []
        for batch in batches:
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
                if key != node:
                    if node:
                        done.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if len(done) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names)
                done = []
        if node:
            done.append((*node, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names)

    names = [*KEY, "ends_sha256"]
    return lists.repartition(*KEY).sortWithinPartitions(*KEY, "part").mapInArrow(
        run, "depth long, f1 long, f2 long, ends_sha256 string")


def prefix_trie(convs: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of ``turns`` (``conv, pos, digest, bytes``; positions of each
    conversation from 0 without gaps) of ``convs`` (``conv``, each once; those
    without turns end at the root).

    One row for each node: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (bytes that members but one need not store, over the
    subtree) and ``ends_sha256``.

    Equal conversations, and any group that shares its beginning, are one row for
    each block after a sum before the shuffle; very long conversations are handled in
    stretches.  The identifiers that end at one node pass one hash one after the
    other, as the digest asks, in lists joined before.  No conversations give no
    node at all.
    """
    paths = materialize(_paths(turns, block), "trie-paths")

    # whole blocks first: one row for each distinct block after a distinct prefix
    place = ["k", "b1", "b2", "pre", *KEY]
    edges = materialize(paths.groupBy(*place).agg(
        F.count("*").alias("n"), F.min("conv").alias("conv"), F.first("turns").alias("turns")), "trie-edges")
    siblings = edges.groupBy("k", "b1", "b2").agg(F.count("*").alias("edges"))
    siblings = siblings.withColumn("diverge", F.col("edges") > 1)
    edges_at = _look_up(edges, siblings, ["k", "b1", "b2"], "edges")

    # single turns, grouped only where several blocks follow the same prefix
    found = ["n", "conv", *KEY, "p1", "p2", "pre"]
    alone = _turn_by_turn(edges_at.filter("NOT diverge").drop("depth", "f1", "f2"), "n", "conv")
    apart = _turn_by_turn(edges_at.filter("diverge").drop("depth", "f1", "f2"), "n", "conv").groupBy(*KEY).agg(
        F.sum("n").alias("n"), F.min("conv").alias("conv"), *[F.first(c).alias(c) for c in ("p1", "p2", "pre")])
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count("*").alias("n"), F.min("conv").alias("conv")).filter("n > 0").select(
        "n", "conv", *[zero.alias(c) for c in KEY], *[zero.alias(c) for c in ("p1", "p2", "pre")])
    turns_apart = root.unionByName(alone.select(*found)).unionByName(apart.select(*found))
    # every node is counted at its parent's key, where the parent itself is as well
    own = F.struct(*KEY, F.lit(0).alias("children"), *[c for c in found if c not in KEY])
    at_parent = F.struct((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"),
                         F.lit(1).alias("children"),
                         *[F.lit(None).cast("long").alias(c) for c in found if c not in KEY])
    nodes = turns_apart.select(F.explode(F.when(F.col("depth") > 0, F.array(own, at_parent))
                                         .otherwise(F.array(own))).alias("x")).select("x.*")
    nodes = materialize(nodes.groupBy(*KEY).agg(
        F.sum("children").alias("n_children"), *[F.max(c).alias(c) for c in found if c not in KEY]), "trie-nodes")

    # one number for each conversation: bytes shared with smaller ones, leaves it stands for
    stands = nodes.groupBy("conv").agg(F.min("pre").alias("before"),
                                       F.count_if(F.col("n_children") == 0).alias("leaves"))
    last = paths.groupBy("conv").agg(F.count("*").alias("blocks"), F.max("depth").alias("depth"), *[
        F.max_by(c, "depth").alias(c) for c in ("f1", "f2", "post")])
    ends = materialize(convs.join(last, "conv", "left").join(stands, "conv", "left").select(
        "conv", *[F.coalesce(c, zero).alias(c) for c in (*KEY, "blocks", "leaves")],
        F.coalesce("before", "post", zero).alias("shared")), "trie-ends")

    def gathered(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(
            F.sum("leaves").alias("leaves"), F.sum("shared").alias("shared"),
            F.min_by("own", "conv").alias("own"), F.min("conv").alias("conv"))

    weights = ends.filter("blocks > 0").select("conv", "leaves", "shared", "blocks")
    by_block = gathered(_look_up(paths.select("conv", *KEY), weights, ["conv"], "blocks")
                        .withColumn("own", F.col("shared")), *KEY)
    by_turn = gathered(_turn_by_turn(
        edges.select(*KEY, "b1", "b2", "pre", "turns").join(by_block, KEY).drop(*KEY),
        "leaves", "shared", "own", "conv"), *KEY)
    at_root = gathered(ends.select("conv", "leaves", "shared", F.col("shared").alias("own"),
                                   *[zero.alias(c) for c in KEY]), *KEY)
    sums = by_turn.unionByName(at_root).drop("conv")

    parents = nodes.filter("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"),
        F.col("conv").alias("parent_conv_id"), "n_children")
    above = _look_up(nodes.filter("depth > 0").select(*KEY, "p1", "p2"), parents,
                     ["depth", "p1", "p2"], "n_children").select(*KEY, "parent_conv_id")
    out = nodes.join(sums, KEY).join(above, KEY, "left").join(_digests(ends.select("conv", *KEY)), KEY, "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        F.col("leaves").alias("n_leaves"),
        (F.col("shared") - F.col("own") - (F.col("n") - 1) * F.col("pre")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def conversation_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                      role_col: str = "role", text_col: str = "text", group: int | None = 5,
                      most: int = 8, block: int = BLOCK) -> DataFrame:
    """``prefix_trie`` of the conversations of ``df``, rebuilt with shared openings
    (``share_openings``), or as they are if ``group`` is None.

    Turns are ordered by turn (null first), those with the same turn by a digest of
    role and text; repeated rows are turns of their own.  A null role or text counts
    as empty, texts may have any length (only a digest and a size leave the scan).
    Rows with a null conversation identifier are left out.  An empty table gives an
    empty one.  Columns but the four named are not looked at.
    """
    numbered = materialize(number_turns(df, conv_col, turn_col, role_col, text_col), "trie-numbered")
    if group is None:
        return prefix_trie(numbered.select("conv").distinct(),
                           numbered.select("conv", F.col("i").alias("pos"), "digest", "bytes"), block)
    return prefix_trie(*share_openings(numbered, group, most), block)
