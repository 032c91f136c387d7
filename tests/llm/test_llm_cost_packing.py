import random
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pytest
from tokenizers import Tokenizer

from shelfwise.llm import cost_packing as CP
from shelfwise.llm.queries import tokenizer_file

ODD = [(1, "a b"), (2, None), (3, ""), (None, "x"), (5, "é" * 9000), (6, "same"), (6, "same"),
       (7, "same <|endoftext|> here"), (8, "word " * 5000)]


own_tokenizer = cache(lambda: Tokenizer.from_file(tokenizer_file()))


def tokens_of(text):
    return own_tokenizer().encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_packing(data, out, capacity):
    """Every id in one piece, no gaps in sequences, none padded."""
    want = defaultdict(list)  # (id, tokens) → ids, once for each row
    for key, text in data:
        ids = tokens_of(text)
        want[(key, len(ids), tuple(ids))].append(ids)
    total = sum(len(i) for v in want.values() for i in v)
    assert sum(r["length"] for r in out) == total
    for key, n, ids in want:
        copies = sum(len(v) for k, v in want.items() if k[:2] == (key, n))
        own = [r for r in out if r["doc_id"] == key and r["doc_tokens"] == n]
        covered = np.zeros(n, int)
        for r in own:
            covered[r["start"]:r["start"] + r["length"]] += 1
        assert (covered == copies).all()
        if copies == len(want[key, n, ids]):
            assert all(r["ids_crc32"] == crc(ids[r["start"]:r["start"] + r["length"]]) for r in own)
    fills = defaultdict(list)
    for r in out:
        fills[r["sequence_id"]].append((r["offset"], r["length"]))
    ends = []
    for places in fills.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at and n > 0
            at += n
        ends.append(at)
    assert all(n <= capacity and n & (n - 1) == 0 for n in ends)
    assert sorted(n for n in ends if n < capacity) == sorted(
        1 << k for k in range(capacity.bit_length()) if total % capacity >> k & 1)


@pytest.mark.parametrize("cell", [1, 3, 256])
def test_odd_rows_at_every_size_of_cells(rows, cell):
    r = random.Random(cell)
    data = ODD + [(100 + i, "w" + " word" * r.randint(0, 150)) for i in range(150)]
    out = CP.pack_balanced(rows("doc_id long, text string", data, 5), tokenizer_file(), 128, cell).collect()
    check_packing(data, out, 128)


def test_a_group_of_copies_is_split_over_cells(rows):
    data = [(7, "one text that is there many times over")] * 400 + [(i, f"other {i}") for i in range(100)]
    df = CP.pack_balanced(rows("doc_id long, text string", data), tokenizer_file(), 64, 4)
    check_packing(data, df.collect(), 64)
    cells = {r["sequence_id"] // (2 << 20) for r in df.filter("doc_id = 7").collect()}
    assert len(cells) > 5


def test_no_rows_and_wrong_arguments(rows):
    none = rows("doc_id long, text string", [])
    assert CP.pack_balanced(none, tokenizer_file()).count() == 0
    for bad in (dict(capacity=100), dict(cell=0)):
        with pytest.raises(ValueError):
            CP.pack_balanced(none, tokenizer_file(), **bad)


def test_ids_of_the_sequences_and_clashing_columns(rows):
    data = [(2**60 + i, "some words " * i) for i in range(60)] + [(None, "n")]
    df = rows("doc_id long, text string, part int, cell string, ids string",
              [(*d, 1, "c", "i") for d in data])
    out = CP.pack_balanced(df, tokenizer_file(), 32, 8, with_ids=True).collect()
    texts = dict(data)
    for r in out:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert ids == tokens_of(texts[r["doc_id"]])[r["start"]:r["start"] + r["length"]]
        assert r["cost"] == pytest.approx(r["length"] + r["length"] ** 2 / (6 * CP.WIDTH))
    check_packing(data, out, 32)


def test_the_lowest_cost_with_room_takes_the_next_piece():
    r = np.random.default_rng(2)
    lengths = r.integers(1, 40, 200)
    lengths[-1] += -lengths.sum() % 64  # whole sequences
    sizes = np.array(CP.rooms(int(lengths.sum()), 64))
    room, cost, late = sizes.copy(), [0.0] * len(sizes), 0
    got = {}
    for piece, start, n, to, offset in CP.assign(lengths, sizes, 1.0, 0.01):
        got.setdefault(piece, []).append((start, n, to, offset))
    for piece in sorted(range(200), key=lambda i: -lengths[i]):
        n = int(lengths[piece])
        fits = [i for i in range(len(sizes)) if room[i] >= n]
        if not fits:
            late += 1
            continue
        to = min(fits, key=lambda i: (cost[i], i))
        assert got[piece] == [(0, n, to, int(sizes[to] - room[to]))]
        room[to] -= n
        cost[to] += n + 0.01 * n * n
    assert sum(len(v) > 1 for v in got.values()) <= late <= len(sizes)


def test_costs_are_more_even_than_first_come(rows):
    r = np.random.default_rng(4)
    lengths = np.minimum(r.lognormal(5, 1.2, 3000).astype(int) + 1, 700)
    sizes = np.array(CP.rooms(int(lengths.sum()), 2048))
    squares = np.zeros(len(sizes))
    for _, _, n, to, _ in CP.assign(lengths, sizes):
        squares[to] += n * n
    line = np.zeros(len(sizes) + 1)
    at = 0
    for n in lengths:  # one after the other, cut at the borders
        left = int(n)
        while left:
            k = min(left, 2048 - at % 2048)
            line[at // 2048] += k * k
            at, left = at + k, left - k
    whole = sizes == 2048
    assert squares[whole].std() < 0.7 * line[:len(sizes)][whole].std()


def test_a_very_long_text(rows):
    data = [(1, "many words in one text " * 60_000), (2, "short")]
    out = CP.pack_balanced(rows("doc_id long, text string", data), tokenizer_file(), 2048).collect()
    check_packing(data, out, 2048)
    assert sum(r["length"] == 2048 for r in out) > 100
