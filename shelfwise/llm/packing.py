"""Best-fit packing planned over a histogram of lengths.

How many pieces have each length is all the packer has to know: ``plan`` runs
best-fit decreasing on at most ``capacity`` (length, count) pairs, moving whole
groups of equal, equally filled sequences at once, so its work and its result do
not depend on how many documents there are.  Documents take the planned places
by a join on their rank within their length.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import require_columns
from shelfwise.session import materialize

#: The file's own parting of a text into words (fixed value of its kind).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The vocabulary file writes each byte as one printable character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@cache
def encoder(path: str, added: bool = False) -> Callable[[str], bytes]:
    """Text → token ids as little-endian unsigned 32-bit numbers, for a
    byte-level BPE in a ``tokenizers`` file.

    The file's vocabulary is run by ``tiktoken``, which gives the same ids (the
    tests compare them) in a third of the time.  Strings of added tokens are
    ordinary text, or with ``added`` those tokens, as ``tokenizers`` has it if
    not told otherwise.
    """
    import tiktoken
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["model"]["type"] != "BPE":
        raise ValueError(f"{path} is no byte-level BPE")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path} has added tokens that take more than their own string")
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in w): i for w, i in spec["model"]["vocab"].items()
             if w not in special}
    core = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks,
                             special_tokens=special if added else {})._core_bpe
    allowed = set(special) if added else set()
    return lambda text: bytes(core.encode_to_tiktoken_buffer(text, allowed))


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: one if they fit, else
    pieces of ``capacity``, of which the first takes the remainder."""
    head = n % capacity or min(n, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def token_pieces(df: DataFrame, tokenizer_path: str, capacity: int = 2048,
                 id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Every document's tokens and one ``end_id``, cut into pieces of at most
    ``capacity``: ``id, piece, start, length, ids_crc32, ids``.

    Strings of the file's added tokens are those tokens.  A null text counts as empty and gives one piece of the end token alone.
    """
    require_columns(df, [id_col, text_col])
    id_type = df.schema[id_col].dataType
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, True)
        for batch in batches:
            rows, total = [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                for k, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start:4 * (start + n)]
                    rows.append((key, k, start, n, zlib.crc32(part), part))
                    total += len(part)
                if total > 8 << 20:
                    yield _batch(rows, batch.schema.field(0).type)
                    rows, total = [], 0
            if rows:
                yield _batch(rows, batch.schema.field(0).type)

    def _batch(rows: list, key_type: pa.DataType) -> pa.RecordBatch:
        cols = list(zip(*rows))
        types = [key_type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["id", "piece", "start", "length", "ids_crc32", "ids"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    out = T.StructType([
        T.StructField("id", id_type), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("ids", T.BinaryType())])
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, out)


def plan(histogram: dict[int, int], capacity: int = 2048) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Rows ``(length, first_rank, n, per, sequence, offset)``: of the pieces of
    that length, those ranked ``first_rank`` and on, ``n`` in all, go ``per`` to
    a sequence into the sequences from ``sequence`` on, from token ``offset``.
    """
    if any(not 0 < k <= capacity for k in histogram):
        raise ValueError(f"lengths must be 1 to {capacity}")
    groups: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room → (sequence, how many)
    rooms: list[int] = []  # ascending
    out, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if not groups[room]:
                rooms.insert(bisect_left(rooms, room), room)
            groups[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = groups[room].pop()
                if not groups[room]:
                    rooms.pop(at)
            else:
                per = capacity // length
                room, first, n = capacity, sequences, -(-left // per)
                sequences += n
            per = min(room // length, left)
            used = min(n, left // per)  # these get ``per`` each; a last smaller rest comes round again
            out.append((length, rank, used * per, per, first, capacity - room))
            put(room, first + used, n - used)
            put(room - per * length, first, used)
            rank += used * per
            left -= used * per
    return out


PLAN_SCHEMA = ("p_length long, first_rank long, n long, per long, first_sequence long, "
               "first_offset long")


def pack(pieces: DataFrame, capacity: int = 2048, cells: int = 256) -> DataFrame:
    """Give every row of ``pieces`` (a column ``length`` of 1 to ``capacity``)
    a ``sequence_id`` and an ``offset``; other columns stay.

    Sequences are filled without gaps from 0 and hold at most ``capacity``.
    Rows of one length are interchangeable.  A length that most pieces have is
    ranked in ``cells`` parts.  Empty input gives an empty table.
    """
    spark = pieces.sparkSession
    others = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    keyed = pieces.select(*others, F.pmod(F.xxhash64(*[
        c for c, t in pieces.dtypes if c != "ids" and not t.startswith("map")]),
        F.lit(cells)).alias("_cell"))
    counts = keyed.groupBy("length", "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("length").alias("_l"), F.col("_cell").alias("_c"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_r0"))
    # at most ``capacity`` rows reach the driver, and a plan over them goes back
    histogram = {r[0]: r[1] for r in keyed.groupBy("length").count().collect()}
    places = spark.createDataFrame(plan(histogram, capacity), PLAN_SCHEMA)

    order = [c for c in others if c != "ids"]
    ranked = keyed.withColumn("_k", F.row_number().over(
        Window.partitionBy("length", "_cell").orderBy(*order)) - 1)
    ranked = ranked.join(starts, (F.col("length") == F.col("_l")) & (F.col("_cell") == F.col("_c"))) \
        .withColumn("_rank", F.col("_r0") + F.col("_k"))
    step = F.col("_rank") - F.col("first_rank")
    return ranked.join(F.broadcast(places), (F.col("length") == F.col("p_length"))
                       & (F.col("_rank") >= F.col("first_rank"))
                       & (F.col("_rank") < F.col("first_rank") + F.col("n"))).select(
        *others, (F.col("first_sequence") + F.expr("(_rank - first_rank) div per")).alias("sequence_id"),
        (F.col("first_offset") + F.pmod(step, F.col("per")) * F.col("length")).alias("offset"))


def pack_documents(df: DataFrame, tokenizer_path: str, capacity: int = 2048,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack every document of ``df``; one row for each piece:
    ``id_col, piece, start, length, ids_crc32, sequence_id, offset`` and, if
    asked for, ``ids`` (little-endian unsigned 32-bit numbers).

    Null or empty texts are one piece of the end token; long texts are cut, the
    first piece taking the remainder.  Null identifiers and repeated rows are
    rows of their own.  Extra columns of ``df`` are not looked at.
    """
    pieces = token_pieces(df, tokenizer_path, capacity, id_col, text_col)
    pieces = materialize(pieces if with_ids else pieces.drop("ids"), "pieces")
    return pack(pieces, capacity).withColumnRenamed("id", id_col)
