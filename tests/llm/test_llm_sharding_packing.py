import random
import zlib

import numpy as np
import pytest

from shelfwise.llm import packing, sharding
from shelfwise.llm.queries import tokenizer_file

ODD = [(1, "a b"), (2, None), (3, ""), (None, "x"), (5, "é" * 9000), (6, "same"), (6, "same"), (7, "same")]


def by_shard(out):
    shards = {}
    for r in out:
        shards.setdefault(r["shard"], []).append(r)
    return shards


def test_shards_of_odd_rows(rows):
    out = sharding.assign_shards(rows("doc_id long, text string", ODD), 4).collect()
    want = sorted(((i, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode()))
                   for i, t in ODD), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=str) == want
    for group in by_shard(out).values():
        assert sorted(r["slot"] for r in group) == list(range(len(group)))


def test_shards_are_even_and_keep_copies_together(rows):
    r = random.Random(3)
    data = [(i, "copy " * 20 if i % 3 == 0 else "w" * r.randint(0, 200)) for i in range(3000)]
    df = rows("doc_id long, text string, size string, shard string", [(i, t, "x", "y") for i, t in data])
    out = sharding.assign_shards(df, 8).collect()
    sizes = [sum(x["size"] for x in g) for g in by_shard(out).values()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2 * 201
    homes = {}
    for x in out:
        homes.setdefault(x["text_crc32"], set()).add(x["shard"])
    # contiguous: only texts on a cut are in two shards, but for the large group
    assert sum(len(h) > 1 for c, h in homes.items() if c != zlib.crc32(b"copy " * 20)) <= 7
    assert [tuple(x) for x in sharding.assign_shards(df, 8).orderBy("doc_id").collect()] == \
        sorted(map(tuple, out))


def test_no_rows_and_missing_columns(rows):
    assert sharding.assign_shards(rows("doc_id long, text string", []), 4).count() == 0
    with pytest.raises(ValueError):
        sharding.assign_shards(rows("doc_id long", [(1,)]))


def test_written_shards_hold_every_row(spark, rows, scratch):
    path = scratch("shards")
    sharding.write_shards(rows("doc_id long, text string", [(i, "t" * i) for i in range(50)]), path, 4)
    back = spark.read.parquet(path)
    assert back.count() == 50 and back.select("shard").distinct().count() == 4


def test_ids_equal_the_tokenizers_own():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_file())
    t.encode_special_tokens = True
    encode = packing.encoder(tokenizer_file())
    for text in ["", " ", "a'sb don't  x\n\n y \t z", "<|endoftext|> é́ 日本語 ١٢٣ ²½Ⅷ _a_", "  x   y​ z",
                 "x \x1c y\x1d z", "Zu und. Dieüauß der.\nEin\n", "a" * 500, "\r\n   q"]:
        assert np.frombuffer(encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_added_tokens_as_the_tokenizer_has_them(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_file())
    texts = ["<|endoftext|>", "a <|endoftext|> b", "x  <|endoftext|>\n\n y", "<|endoftext|><|endoftext|>z",
             "<|endoftext", "a  \t<|endoftext|>é"]
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    encode = packing.encoder(tokenizer_file(), True)
    assert [np.frombuffer(encode(x), "<u4").tolist() for x in texts] == want
    out = packing.token_pieces(rows("doc_id long, text string", list(enumerate(texts))), tokenizer_file())
    got = {r["id"]: np.frombuffer(r["ids"], "<u4").tolist()[:-1] for r in out.collect()}
    assert [got[i] for i in range(len(texts))] == want


@pytest.mark.parametrize("n, want", [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]),
                                     (17, [(0, 1), (1, 8), (9, 8)]), (16, [(0, 8), (8, 8)])])
def test_cut(n, want):
    assert packing.cut(n, 8) == want


def filled(plan, capacity):
    """Sequences as lists of (offset, length), from a plan."""
    out = {}
    for length, first, n, per, seq, offset in plan:
        for k in range(n):
            out.setdefault(seq + k // per, []).append((offset + k % per * length, length))
    for pieces in out.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return out


def test_plan_is_gapless_whole_and_tight():
    r = random.Random(5)
    for _ in range(60):
        capacity = r.choice([5, 16, 64])
        hist = {k: r.randint(1, 40) for k in r.sample(range(1, capacity + 1), r.randint(1, min(capacity, 20)))}
        plan = packing.plan(hist, capacity)
        got = {}
        for length, first, n, *_ in plan:
            assert first == got.get(length, 0)
            got[length] = first + n
        assert got == hist
        # as good as best-fit over the single pieces, longest first
        bins = []
        for length in sorted(hist, reverse=True):
            for _ in range(hist[length]):
                room = [b for b in bins if b[0] >= length]
                b = min(room) if room else None
                if b is None:
                    b = [capacity]
                    bins.append(b)
                b[0] -= length
        assert len(filled(plan, capacity)) <= len(bins)


def test_a_plan_is_no_larger_with_more_documents():
    hist = {k: 1 + k % 7 for k in range(1, 65)}
    small, large = (packing.plan({k: n * f for k, n in hist.items()}, 64) for f in (10, 10_000_000))
    assert len(large) < 4 * len(small) < 4 * 64 * 8


def test_packed_documents_come_back_whole(rows):
    data = [*ODD, (8, "word " * 3000), (9, "word " * 3000)]
    df = rows("doc_id long, text string, length string, sequence_id string", [(*d, "x", "y") for d in data])
    out = packing.pack_documents(df, tokenizer_file(), 256, with_ids=True).collect()
    encode = packing.encoder(tokenizer_file())
    sequences, docs = {}, {}
    for r in out:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] <= 256 and r["ids_crc32"] == zlib.crc32(r["ids"])
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        docs.setdefault(r["doc_id"], []).append((r["piece"], r["start"], ids))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    for key in (1, 2, 3, 5, 8, 9):
        text = dict(data)[key] or ""
        pieces = sorted(docs[key])
        assert [p for p, *_ in pieces] == list(range(len(pieces)))
        assert sum((ids for *_, ids in pieces), []) == np.frombuffer(encode(text), "<u4").tolist() + [0]
        assert all(len(ids) == 256 for _, _, ids in pieces[1:])
    assert len(docs[6]) == 2 and len(docs[None]) == 1


def test_nothing_to_pack(rows):
    assert packing.pack_documents(rows("doc_id long, text string", []), tokenizer_file()).count() == 0
