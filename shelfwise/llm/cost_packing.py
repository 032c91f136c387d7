"""Packing with balanced attention cost and no padding.

A piece of n tokens costs ``linear * n + quadratic * n**2``.  Documents longer
than a sequence give whole sequences at once; what is left of each (less than a
sequence) lies one after the other on a line of tokens, which is cut every
``cell`` sequences.  So each cell holds exactly as many tokens as its sequences,
whatever the documents are like, and is packed by one task on its own: pieces in
descending order go to the sequence of lowest cost that has room for them, and
what fits nowhere whole is cut over the rooms that are left.  The last cell's
tokens beyond whole sequences fill sequences of powers of two.

Positions on the line come from running totals inside each task that reads
documents and a prefix sum over the totals of those tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import require_columns
from shelfwise.llm.packing import encoder
from shelfwise.session import materialize

#: Share of the quadratic term: attention over n tokens against the layers' other
#: work, n / (6 * width) for a model this wide.
WIDTH = 2048

# Numbers of sequences: even ones for cells (up to 2**20 in each), odd ones for the
# whole sequences of long documents (up to 2**36 from each task).
_SEQUENCES = 1 << 20
_WHOLES = 1 << 36


def rooms(tokens: int, capacity: int) -> list[int]:
    """Sizes of the sequences that ``tokens`` fill without padding: whole ones and
    powers of two for the rest."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << k for k in reversed(range(rest.bit_length()))
                                                if rest >> k & 1]


def assign(lengths: np.ndarray, sizes: np.ndarray, linear: float = 1.0,
           quadratic: float = 1 / (6 * WIDTH)) -> list[tuple[int, int, int, int, int]]:
    """Rows ``(piece, start, length, sequence, offset)`` that fill sequences of
    ``sizes`` with pieces of ``lengths`` tokens; both sum to the same.

    Descending pieces go whole to the sequence of lowest cost with room (the
    first of equals).  Those that fit in none wait until all others have their
    place and are then cut, into the largest room that is left each time.
    """
    if lengths.sum() != sizes.sum():
        raise ValueError(f"{lengths.sum()} tokens for sequences of {sizes.sum()}")
    room, cost, out, late = sizes.astype(np.int64), np.zeros(len(sizes)), [], []

    def put(piece: int, start: int, n: int, to: int) -> None:
        out.append((piece, start, n, to, int(sizes[to] - room[to])))
        room[to] -= n
        cost[to] += linear * n + quadratic * n * n

    for piece in np.argsort(-lengths, kind="stable"):
        n = int(lengths[piece])
        free = np.where(room >= n, cost, np.inf)
        to = int(free.argmin())
        if np.isinf(free[to]):
            late.append(piece)
        else:
            put(int(piece), 0, n, to)
    for piece in late:
        start, n = 0, int(lengths[piece])
        while start < n:
            to = int(room.argmax())
            part = min(n - start, int(room[to]))
            put(int(piece), start, part, to)
            start += part
    return out


def _line(df: DataFrame, tokenizer_path: str, capacity: int, id_col: str, text_col: str,
          end_id: int, with_ids: bool) -> DataFrame:
    """Whole sequences (with a checksum; ``at`` is their number in the task) and
    rests (with ids and no checksum; ``at`` is their place among the rests of the
    task) of every document: ``id, start, length, doc_tokens, part, at, ids_crc32, ids``."""
    end = np.array([end_id], "<u4").tobytes()
    id_type = df.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, True)
        whole = place = 0
        names = ["id", "start", "length", "doc_tokens", "part", "at", "ids_crc32", "ids"]

        def made(rows: list) -> pa.RecordBatch:
            types = [key_type, *[pa.int64()] * 6, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
        for batch in batches:
            key_type, rows, size = batch.schema.field(0).type, [], 0
            for key, text, part in zip(*(c.to_pylist() for c in batch.columns)):
                ids = encode(text or "") + end
                n = len(ids) // 4
                for start in range(0, n - n % capacity, capacity):
                    piece = ids[4 * start:4 * (start + capacity)]
                    rows.append((key, start, capacity, n, part, whole, zlib.crc32(piece),
                                 piece if with_ids else None))
                    whole += 1
                    size += capacity * with_ids
                if rest := n % capacity:
                    rows.append((key, n - rest, rest, n, part, place, None, ids[-4 * rest:]))
                    place += rest
                    size += rest
                if size > 1 << 20 or len(rows) > 50_000:
                    yield made(rows)
                    rows, size = [], 0
            if rows:
                yield made(rows)

    long = T.LongType()
    out = T.StructType([T.StructField("id", id_type)] + [
        T.StructField(c, long) for c in ("start", "length", "doc_tokens", "part", "at", "ids_crc32")
    ] + [T.StructField("ids", T.BinaryType())])
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                     F.spark_partition_id().cast("long").alias("part")).mapInArrow(run, out)


def pack_balanced(df: DataFrame, tokenizer_path: str, capacity: int = 2048, cell: int = 256,
                  id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
                  linear: float = 1.0, quadratic: float = 1 / (6 * WIDTH),
                  with_ids: bool = False) -> DataFrame:
    """Tokenise every document, put ``end_id`` after it and pack all tokens; one
    row for each piece: ``id_col, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, cost`` and, if asked for, ``ids`` (little-endian
    unsigned 32-bit numbers).

    ``start`` is the piece's place in its document, ``doc_tokens`` the document's
    tokens with the end, ``cost`` the piece's own share of its sequence's cost.
    Sequences hold ``capacity`` tokens (a power of two), all but at most log2 of
    that many, which hold a smaller power of two; none is padded.

    Null or empty texts are the end token alone.  Very long texts are cut to
    whole sequences where they are read; only a document's last, shorter part is
    shuffled, and a cell never holds more than ``cell`` sequences, so no text and
    no group of equal texts or identifiers makes a task larger.  Null identifiers
    and repeated rows are rows of their own.  An empty table gives an empty
    table.  Extra columns of ``df`` are not looked at.
    """
    require_columns(df, [id_col, text_col])
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"capacity must be a power of two, not {capacity}")
    if not 0 < cell < _SEQUENCES - 64:
        raise ValueError(f"a cell has 1 to {_SEQUENCES - 65} sequences, not {cell}")
    line = materialize(_line(df, tokenizer_path, capacity, id_col, text_col, end_id, with_ids),
                       "token-line")
    rests = line.filter("ids_crc32 IS NULL")

    # one row for each task that read documents: where its rests begin on the line
    totals = rests.groupBy("part").agg(F.sum("length").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = totals.select(F.col("part").alias("of"),
                           F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("begin"))
    # written, so that its true size decides how it comes to the rests: with the ids
    # on them they should not be shuffled for it
    begins = materialize(begins, "line-begins")
    room = cell * capacity
    placed = rests.join(begins, F.col("part") == F.col("of")).select(
        "id", "start", "doc_tokens", "ids", (F.col("begin") + F.col("at")).alias("low"),
        (F.col("begin") + F.col("at") + F.col("length")).alias("high"))
    # a rest that lies over a border of cells is cut there
    placed = placed.withColumn("cell", F.explode(F.expr(f"sequence(low div {room}, (high - 1) div {room})")))
    skip = F.greatest(F.col("cell") * room - F.col("low"), F.lit(0))
    stop = F.least((F.col("cell") + 1) * room, "high") - F.col("low")
    placed = placed.select("id", "cell", "doc_tokens", (F.col("start") + skip).alias("start"),
                           F.substring("ids", (4 * skip + 1).cast("int"),
                                       (4 * (stop - skip)).cast("int")).alias("ids"))

    def pack_cell(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("start", "doc_tokens", "ids")])
        ids = rows["ids"].to_pylist()
        lengths = np.array([len(x) // 4 for x in ids])
        sizes = np.array(rooms(int(lengths.sum()), capacity))
        piece, start, n, to, offset = np.array(
            assign(lengths, sizes, linear, quadratic), np.int64).T
        of = rows.take(pa.array(piece))
        parts = [ids[i][4 * s:4 * (s + k)] for i, s, k in zip(piece, start, n)]
        cols = [of["id"], of["start"].to_numpy() + start, n, [zlib.crc32(x) for x in parts],
                of["doc_tokens"], (of["cell"].to_numpy() * _SEQUENCES + to) * 2, offset]
        return pa.table([*cols, *([pa.array(parts, pa.binary())] if with_ids else [])],
                        names=[f.name for f in out])

    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    out = T.StructType([T.StructField("id", df.schema[id_col].dataType)]
                       + [T.StructField(c, T.LongType()) for c in names]
                       + ([T.StructField("ids", T.BinaryType())] if with_ids else []))
    packed = placed.groupBy("cell").applyInArrow(pack_cell, out)
    whole = line.filter("ids_crc32 IS NOT NULL").select(
        "id", "start", "length", "ids_crc32", "doc_tokens",
        ((F.col("part") * _WHOLES + F.col("at")) * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), *(["ids"] if with_ids else []))
    cost = linear * F.col("length") + quadratic * F.col("length") * F.col("length")
    return whole.unionByName(packed).select(
        F.col("id").alias(id_col), *names, cost.alias("cost"), *(["ids"] if with_ids else []))
