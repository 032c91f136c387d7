import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from shelfwise.llm import conversation_trie as CT

SCHEMA = "conv_id long, turn long, role string, text string"
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(data, group=5, most=8):
    """Conversations in order, with shared openings if ``group`` is given."""
    rows = defaultdict(list)
    for conv, turn, role, text in data:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            rows[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in rows.items()}
    if group is None:
        return own
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        rest = abs(c) % group * (1 if c >= 0 else -1)
        out[c] = own.get(c - rest, [])[:h] + turns[h:]
    return out


def by_hand(convs):
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in nodes:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = sum(saved[q] for q in children[p]) + (
            (len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest())
                  for p, m in nodes.items())


def got(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def conversations(r, n, depth, words=3):
    data = []
    for c in range(n):
        for turn in range(r.randint(0, depth)):
            data.append((c, turn, r.choice(["user", "assistant"]) if r.random() < 0.1 else "user",
                         r.choice("abcdé"[:words]) * (1 + turn % 3)))
    return data


def test_small_blocks_stretches_lists_and_hot_keys(rows, monkeypatch):
    monkeypatch.setattr(CT, "STRETCH", 6)
    monkeypatch.setattr(CT, "LIST_BITS", 2)
    monkeypatch.setattr(CT, "HOT", 3)
    r = random.Random(1)
    data = conversations(r, 60, 12, 2)
    data += [(100 + c, t, "user", "same all over") for c in range(25) for t in range(7)]  # copies
    data += [(300, t, "user", f"long {t}") for t in range(80)] + [(305, t, "user", f"long {t}") for t in range(64)]
    data += [(-7 - c, t, None, "ab"[t % 2]) for c in range(4) for t in range(5)]
    df = rows(SCHEMA, data)
    assert got(CT.conversation_trie(df, block=3)) == by_hand(rebuilt(data))
    assert got(CT.conversation_trie(df, block=4, group=None)) == by_hand(rebuilt(data, None))


def test_odd_rows_as_the_query_has_them(rows):
    r = random.Random(2)
    data = conversations(r, 40, 20)
    data += [(200, None, "user", "first"), (200, 3, None, None), (200, 3, "", ""), (200, 3, "user", "tie b"),
             (200, 3, "user", "tie a"), (200, -4, "x", "before 3"), (None, 0, "user", "nobody's"),
             (201, 0, "user", "é" * 100_000), (201, 0, "user", "é" * 100_000), (2**60 + 3, 2**61, "user", "x"),
             (203, 0, "1", ":1a"), (204, 0, "1:", "1a")]
    data += [(c, t, "user", "shared") for c in range(500, 530) for t in range(10)]
    wide = rows(SCHEMA + ", conv string, pos int, digest int, depth int, n int",
                [(*d, "c", 1, 2, 3, 4) for d in data])
    assert got(CT.conversation_trie(wide)) == by_hand(rebuilt(data))


def test_no_conversations(rows):
    assert CT.conversation_trie(rows(SCHEMA, [])).count() == 0
    with pytest.raises(ValueError):
        CT.conversation_trie(rows("conv_id long, turn long", []))


def test_conversations_without_turns_end_at_the_root(rows):
    data = [(1, 0, "user", "only turn")]  # gone when it is rebuilt: no conversation 0, and h is not 0
    assert zlib.crc32(b"1") % 9 > 0
    assert got(CT.conversation_trie(rows(SCHEMA, data))) == by_hand(rebuilt(data)) == [
        (1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]
