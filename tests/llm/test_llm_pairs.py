import itertools
import math
import random

import numpy as np
import pytest

from shelfwise.llm import common, embedding_dedup, ngram_join


def least_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components_against_union_find(spark, rows):
    r = random.Random(3)
    chain = [(i, i + 1) for i in range(1000, 1120)]
    star = [(2000, i) for i in range(2001, 2300)]
    noise = [(r.randint(0, 400), r.randint(0, 400)) for _ in range(250)]
    edges = chain + star + noise
    got = {x["node"]: x["component"] for x in common.connected_components(
        rows("x long, y long", edges), "x", "y").collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert got == {n: c for n, c in least_reachable(nodes, edges).items() if n in nodes}
    assert common.connected_components(rows("a long, b long", [])).count() == 0


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def joined_by_hand(data, k, percent):
    sets = [shingles(t, k) for _, t in data]
    links = [(a, b) for a, b in itertools.combinations(range(len(data)), 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = least_reachable(range(len(data)), links)
    least = {}
    for n, c in root.items():
        if data[n][0] is not None:
            least[c] = min(least.get(c, data[n][0]), data[n][0])
    return sorted(((data[n][0], len(sets[n]), least.get(c)) for n, c in root.items()), key=str)


def near_copies(r, n, words=40, changes=2):
    base = [f"w{r.randint(0, 500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(r.randint(0, changes)):
            copy[r.randrange(len(copy))] = f"x{r.randint(0, 10 ** 6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80)])
def test_join_against_brute_force(rows, k, percent):
    r = random.Random(k)
    texts = [None, "", " \n", "one", "ONE", "a b", "a b", "A  b\n", "é ü", "x " * 6000, "x " * 6001,
             "x\x1cy z", "a b c d e", "a b c d e f"]
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [f"{passage} " + " ".join(f"o{r.randint(0, 10 ** 6)}" for _ in range(r.randint(5, 60)))
              for _ in range(120)]  # a passage that many share
    for _ in range(12):
        texts += near_copies(r, r.choice([2, 3, 8]))
    texts += near_copies(r, 90, changes=3) + ["exact copy of many words here"] * 50
    # a chain: each like the next, the ends unlike
    words = [f"c{i}" for i in range(60)]
    texts += [" ".join(words[i:i + 45]) for i in range(0, 15)]
    r.shuffle(texts)
    data = [(i, t) for i, t in enumerate(texts)]
    data += [(None, texts[0] or "some words alone"), (None, "nobody has these words at all"), (3, texts[3])]
    df = rows("doc_id long, text string, th string, n string", [(*d, "x", "y") for d in data], 5)
    out = ngram_join.similar_components(df, k=k, percent=percent).drop("group", "text_hash").collect()
    assert sorted(map(tuple, out), key=str) == joined_by_hand(data, k, percent)


def test_one_of_each_stays(rows):
    r = random.Random(9)
    group = near_copies(r, 6, words=120, changes=1)
    data = [(i, t, "x") for i, t in enumerate(group)] + [(10, "alone in the world here", "x")]
    data += [(11, "", "x"), (12, None, None), (12, None, None), (0, group[0], "x"), (None, "no id at all", "x"),
             (None, "another one without an id", "x"), (10, "the same id and quite another text", "x")]
    df = rows("doc_id long, text string, kept_id string", data)
    out = ngram_join.keep_one(df)
    assert out.columns == df.columns
    assert sorted((x["doc_id"] for x in out.collect()), key=str) == \
        [0, 10, 10, 11, 12, 12, None, None]
    assert ngram_join.keep_one(df.limit(0)).count() == 0


def test_size_bounds_never_lose_a_link():
    for percent in (80, 85):
        for a in range(1, 80):
            for b in range(a, 100):
                need = math.ceil(percent * (a + b) / (100 + percent))
                if 100 * a >= percent * b:
                    # any overlap that links leaves less than a prefix outside of it
                    assert a - need < ngram_join.prefix_length(a, percent)
                    assert b - need < ngram_join.prefix_length(b, percent)


def near_by_hand(data, min_cos):
    ok = [i for i, (_, v) in enumerate(data) if v and None not in v and all(map(math.isfinite, v)) and any(v)]
    links = []
    for a, b in itertools.combinations(ok, 2):
        x, y = (np.array(data[k][1], float) for k in (a, b))
        x, y = x / np.abs(x).max(), y / np.abs(y).max()  # squares of 1e200 would overflow
        if len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= min_cos:
            links.append((a, b))
    root = least_reachable(range(len(data)), links)
    least, degree = {}, [0] * len(data)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    for n, c in root.items():
        if data[n][0] is not None:
            least[c] = min(least.get(c, data[n][0]), data[n][0])
    return sorted(((data[n][0], degree[n], least.get(c), data[n][0] == least.get(c))
                   for n, c in root.items()), key=str)


def test_vectors_against_brute_force(rows):
    r = np.random.default_rng(4)
    data = []
    for _ in range(12):
        centre = r.standard_normal(8)
        data += [(centre + 0.15 * r.standard_normal(8)).tolist() for _ in range(r.integers(1, 30))]
    data += [r.standard_normal(8).tolist() for _ in range(150)]
    data += [data[0]] * 5 + [[3 * x for x in data[1]]]
    data += [None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [float("nan")] * 8, [float("inf")] + [1.0] * 7,
             [1.0, 2.0], [1.0, 2.0], [-1e200] * 8, [1e-200] + [0.0] * 7, [1e-200] + [0.0] * 7]
    data = [(i, v) for i, v in enumerate(data)] + [(None, data[0]), (3, data[3])]
    df = rows("vec_id long, embedding array<double>, node string, v string",
              [(*d, "x", "y") for d in data])
    want = near_by_hand(data, 0.95)
    for block in (4096, 16):  # one cell, and many cells of several blocks
        out = embedding_dedup.near_vectors(df, block=block).collect()
        assert sorted(map(tuple, out), key=str) == want
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_an_exact_cosine_is_linked(rows):
    data = [(1, [1.0, 0.0]), (2, [0.95, math.sqrt(1 - 0.95 ** 2)]), (3, [3.0, 4.0]), (4, [4.0, 3.0])]
    out = embedding_dedup.near_vectors(rows("vec_id long, embedding array<double>", data), min_cos=0.96)
    got = {x["vec_id"]: x["n_links"] for x in out.collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 1} or got[3] == got[4] == 1  # 24/25 is on the threshold
