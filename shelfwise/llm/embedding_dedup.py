"""Exact range join of embeddings by cosine over pivot cells.

On unit vectors a cosine of ``c`` is a Euclidean distance of ``sqrt(2 - 2c)``.
Pivots part the vectors into cells of the nearest pivot.  A vector of cell ``i``
can only have a neighbour in cell ``j`` if it is that near to the border of the
two; by the triangle inequality this is so only if
``d(x, p_j) - d(x, p_i) <= 2 * eps``, and the distance to the plane between the
pivots gives the sharper test used here.  Such vectors are copied to the cell
with the smaller number, so every pair meets once, and cells are joined
independently: each task holds one bounded block of a cell and streams the
others past it.

Counting is done inside the blocks and only a spanning forest of the links
leaves them, so a dense group costs its comparisons but no list of its pairs.
Vectors without structure (spread evenly in many dimensions) lie near most
borders; then nearly every pair is compared, as in any exact join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import connected_components, require_columns
from shelfwise.session import materialize

#: Vectors aimed at in a cell, and held at once by a task.
BLOCK = 4096
#: Most pivots; with more vectors cells get larger and are held in more blocks.
MAX_PIVOTS = 512
#: Distinct vector lengths compared in one call.
MAX_LENGTHS = 16


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten() if not isinstance(column, pa.ChunkedArray) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of the sample far from each other (farthest first)."""
    chosen = [0]
    nearest = 1 - sample @ sample[0]
    while len(chosen) < min(n, len(sample)):
        k = int(nearest.argmax())
        if nearest[k] <= 1e-12:
            break
        chosen.append(k)
        nearest = np.minimum(nearest, 1 - sample @ sample[k])
    return sample[chosen]


def _homes(pivots: np.ndarray, eps: float):
    """Vectors → their cell and the smaller cells whose border is in reach."""
    apart = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))
    dim = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = _unit(_matrix(batch.column(1), dim)) @ pivots.T
            home = near.argmax(axis=1)
            # distance to the plane between the home pivot and another one
            to_plane = (near[np.arange(len(home)), home][:, None] - near) \
                / np.maximum(apart[home], 1e-300)
            reach = (to_plane <= eps + 1e-9) & (np.arange(len(pivots)) < home[:, None])
            visits = [np.flatnonzero(r).astype(np.int32) for r in reach]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(home.astype(np.int32)),
                 pa.array(visits, pa.list_(pa.int32()))], ["node", "v", "copies", "home", "visits"])
    return run


class _Block:
    """The vectors a task holds, their links counted so far, and which of them
    are connected."""

    def __init__(self, node: np.ndarray, x: np.ndarray, copies: np.ndarray, min_cos: float):
        self.node, self.x, self.copies, self.min_cos = node, x, copies, min_cos
        self.x32 = x.astype(np.float32)
        self.slack = max(1e-5, x.shape[1] * 3e-7)  # over the rounding error of a 32-bit product
        self.links = np.zeros(len(node), np.int64)
        self.root = np.arange(len(node))

    def hits(self, y: np.ndarray, later: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``y``, row held) of the pairs over the threshold, in order;
        ``later``: for each row of y, the first held row to compare with."""
        near = y.astype(np.float32) @ self.x32.T
        if later is not None:
            near[np.arange(len(self.node)) < later[:, None]] = -2
        i, j = np.nonzero(near >= self.min_cos - self.slack)
        unsure = np.flatnonzero(near[i, j] < self.min_cos + self.slack)
        keep = np.ones(len(i), bool)
        for a in range(0, len(unsure), 1 << 16):
            u = unsure[a:a + (1 << 16)]
            keep[u] = np.einsum("ij,ij->i", y[i[u]], self.x[j[u]]) >= self.min_cos
        return i[keep], j[keep]

    def connect(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up

    def count_own(self) -> None:
        for a in range(0, len(self.node), 1024):
            rows = np.arange(a, min(a + 1024, len(self.node)))
            i, j = self.hits(self.x[rows], rows + 1)
            i = rows[i]
            self.links += np.bincount(i, self.copies[j], len(self.node)).astype(np.int64)
            self.links += np.bincount(j, self.copies[i], len(self.node)).astype(np.int64)
            self.connect(i, j)

    def count_visitors(self, node, y, copies) -> Iterator[tuple[int, int, int]]:
        for a in range(0, len(node), 1024):
            i, j = self.hits(y[a:a + 1024])
            if not len(i):
                continue
            i += a
            self.links += np.bincount(j, copies[i], len(self.node)).astype(np.int64)
            theirs = np.bincount(i, self.copies[j], len(node)).astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1])))
            same = np.flatnonzero(i[1:] == i[:-1])
            self.connect(j[same], j[same + 1])
            for p in first:
                yield int(node[i[p]]), int(theirs[i[p]]), int(self.node[j[p]])

    def results(self) -> Iterator[tuple[int, int, int | None]]:
        for k in np.flatnonzero(self.links):
            yield int(self.node[k]), int(self.links[k]), int(self.node[self.root[k]])


def _join_blocks(dim: int, min_cos: float):
    """Rows ordered by task and role → (node, links, a node it is connected to)."""
    def rows_out(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                          ["node", "links", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, block = None, [], None

        def begin() -> _Block:
            out = _Block(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]),
                         np.concatenate([h[2] for h in held]), min_cos)
            out.count_own()
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            tasks = batch.column(0).to_numpy()
            roles = batch.column(1).to_numpy()
            node = batch.column(2).to_numpy()
            x = _unit(_matrix(batch.column(3), dim))
            copies = batch.column(4).to_numpy()
            cuts = np.flatnonzero((np.diff(tasks) != 0) | (np.diff(roles) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(tasks)]):
                out = []
                if tasks[a] != task:
                    if held or block:
                        out += (block or begin()).results()
                    task, held, block = tasks[a], [], None
                if roles[a] == 0:
                    held.append((node[a:b], x[a:b], copies[a:b]))
                elif held or block:
                    block = block or begin()
                    held = []
                    out += block.count_visitors(node[a:b], x[a:b], copies[a:b])
                if out:
                    yield rows_out(out)
        if held or block:
            yield rows_out(list((block or begin()).results()))
    return run


def _links(vectors: DataFrame, dim: int, min_cos: float, block: int) -> DataFrame:
    """(node, links, other) of distinct vectors (node, v, copies) of one length."""
    spark = vectors.sparkSession
    n = vectors.count()
    want = max(1, min(MAX_PIVOTS, -(-n // block)))
    # a bounded sample for the pivots: the vectors with the smallest hashes
    sample = vectors.orderBy("node").limit(8 * want).select("v").collect()
    pivots = choose_pivots(_unit(np.array([r[0] for r in sample], np.float64)), want)
    eps = math.sqrt(max(0.0, 2 - 2 * min_cos))
    kind = dict(vectors.dtypes)["v"]
    homes = materialize(vectors.mapInArrow(_homes(pivots, eps), f"node long, v {kind}, copies long, "
                                           "home int, visits array<int>"), "vector-homes")
    sizes = homes.groupBy("home").count().collect()  # at most MAX_PIVOTS rows
    blocks = {r[0]: -(-r[1] // block) for r in sizes}
    per_cell = spark.createDataFrame([(c, b) for c, b in blocks.items()], "cell int, blocks int")
    per_cell = F.broadcast(per_cell)

    own = homes.join(per_cell, F.col("home") == F.col("cell")).withColumn(
        "mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    own = own.select("node", "v", "copies", "cell", "mine", F.explode(
        F.sequence("mine", F.col("blocks") - 1)).alias("b"))
    own = own.select("cell", "b", F.when(F.col("b") == F.col("mine"), 0).otherwise(1).alias("role"),
                     "node", "v", "copies")
    there = homes.select("node", "v", "copies", F.explode("visits").alias("to"))
    there = there.join(per_cell, F.col("to") == F.col("cell")).select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"),
        F.lit(1).alias("role"), "node", "v", "copies")
    work = own.unionByName(there).select(
        (F.col("cell").cast("long") * F.lit(1 << 32) + F.col("b")).alias("task"), "role", "node", "v",
        "copies")
    return work.repartition("task").sortWithinPartitions("task", "role").mapInArrow(
        _join_blocks(dim, min_cos), "node long, links long, other long")


def near_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                 min_cos: float = 0.95, block: int = BLOCK) -> DataFrame:
    """One row for each row of ``df``: its identifier, ``n_links`` (other rows
    with a cosine of at least ``min_cos``, in double precision),
    ``component_id`` (smallest identifier reachable over links, its own
    included) and ``kept`` (its identifier is that one).

    Vectors that are null, empty or zero, or hold a null or non-finite component,
    are linked with nothing, and so are vectors of different lengths with each
    other; more than ``MAX_LENGTHS`` lengths raise an error.  Equal vectors are
    compared once and counted for each row.  A null identifier is ignored among
    others.  Empty input gives an empty table; extra columns are not looked at.
    """
    require_columns(df, [id_col, vec_col])
    v = F.col(vec_col)
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(
        v, lambda x: x != 0)
    rows = df.select(F.col(id_col).alias("id"), F.when(F.coalesce(usable, F.lit(False)), v).alias("v"))
    rows = rows.withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("v")))
    distinct = rows.filter("v is not null").groupBy("node", "v").agg(
        F.count("*").alias("copies"), F.min("id").alias("least_id")).withColumn("dim", F.size("v"))
    distinct = materialize(distinct, "vectors")
    dims = [r[0] for r in distinct.select("dim").distinct().limit(MAX_LENGTHS + 1).collect()]
    if len(dims) > MAX_LENGTHS:
        raise ValueError(f"vectors of more than {MAX_LENGTHS} lengths")
    found = None
    for dim in sorted(dims):
        part = _links(distinct.filter(F.col("dim") == dim).select("node", "v", "copies"), dim, min_cos,
                      block)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = df.sparkSession.createDataFrame([], "node long, links long, other long")
    found = materialize(found, "vector-links")
    groups = connected_components(found.filter("other is not null and other <> node"), "node", "other")
    degrees = found.groupBy(F.col("node").alias("d_node")).agg(F.sum("links").alias("links"))
    nodes = distinct.select("node", "copies", "least_id").join(
        degrees, F.col("node") == F.col("d_node"), "left").join(
        groups.withColumnRenamed("node", "g_node"), F.col("node") == F.col("g_node"), "left")
    nodes = materialize(nodes.select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("class"), "least_id"), "vector-nodes")
    least = nodes.groupBy(F.col("class").alias("l_class")).agg(F.min("least_id").alias("least"))
    answer = nodes.join(least, F.col("class") == F.col("l_class")).select(
        F.col("node").alias("a_node"), "n_links", "least")
    out = rows.select("id", "node").join(answer, F.col("node") == F.col("a_node"), "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long")
                      .alias("n_links"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
