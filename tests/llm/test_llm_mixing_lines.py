import math

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import line_dedup, mixing


def test_word_count(rows):
    data = [(None,), ("",), ("  ",), ("a",), (" a  b\n",), ("a b c",), ("\t\x0bx\r\ny z",)]
    got = rows("text string", data).select("text", mixing.word_count(F.col("text")).alias("n")).collect()
    for r in got:
        assert r["n"] == len((r["text"] or "").encode().split())


def test_exponent_meets_an_entropy():
    tokens = {"a": 900, "b": 90, "c": 10}
    for target in (0.9, 1.2, 1.5):
        x, w = mixing.solve(tokens, target_entropy=target)
        assert 0 < x < 1 and math.isclose(mixing.entropy(w), target, rel_tol=1e-9)
        assert math.isclose(sum(w.values()), 1)
    assert mixing.solve(tokens, target_entropy=0.1)[0] == 1.0  # the corpus has more already
    assert mixing.solve(tokens, target_entropy=9)[0] == 0.0


def test_exponent_meets_a_limit_of_repetition():
    tokens = {"a": 900, "b": 90, "c": 10, "none": 0}
    x, w = mixing.solve(tokens, max_repeats=3)
    uses = [w[s] / tokens[s] for s in w]
    assert math.isclose(max(uses) / min(uses), 3, rel_tol=1e-9) and "none" not in w
    assert mixing.solve(tokens, max_repeats=1000)[0] == 0.0
    assert mixing.solve({}, max_repeats=2) == (1.0, {})
    with pytest.raises(ValueError):
        mixing.solve(tokens)


DATA = [(i, "big" if i < 300 else "small" if i < 360 else None, "w " * (1 + i % 5)) for i in range(400)]


def test_mix_realises_the_weights(rows):
    out = mixing.mix(rows("doc_id long, source string, text string", DATA), max_repeats=2.0).collect()
    tokens = {s: sum(1 + i % 5 for i, x, _ in DATA if x == s) for s in ("big", "small", None)}
    _, weights = mixing.solve(tokens, max_repeats=2.0)
    total = sum(r["mix_tokens"] for r in out)
    for s, w in weights.items():
        drawn = sum(r["mix_tokens"] for r in out if r["source"] == s)
        assert abs(drawn - w * total) <= 12
    seen = {}
    for r in out:
        seen.setdefault(r["doc_id"], []).append(r["epoch"])
    assert sorted(seen) == list(range(400))  # every document once at least
    assert all(sorted(e) == list(range(len(e))) for e in seen.values())


def test_a_budget_cuts_a_permutation(rows):
    df = rows("doc_id long, source string, text string", DATA)
    out = mixing.mix(df, max_repeats=1.0, budget=300).collect()
    assert 300 <= sum(r["mix_tokens"] for r in out) <= 300 + 3 * 5
    assert {r["epoch"] for r in out} == {0}
    again = mixing.mix(df.repartition(5), max_repeats=1.0, budget=300).collect()
    assert sorted(r["doc_id"] for r in again) == sorted(r["doc_id"] for r in out)
    other = mixing.mix(df, max_repeats=1.0, budget=300, seed=1).collect()
    assert sorted(r["doc_id"] for r in other) != sorted(r["doc_id"] for r in out)


def test_mix_of_odd_rows(rows):
    schema = "doc_id long, source string, text string, epoch string, mix_tokens string, extra string"
    data = [(1, "a", None, "e", "m", "x"), (None, None, "", "e", "m", None), (3, "a", "w w", "e", "m", "x"),
            (3, "a", "w w", "e", "m", "x"), (4, "b", "w" * 5000, "e", "m", None)]
    out = mixing.mix(rows(schema, data), max_repeats=4.0)
    assert dict(out.dtypes)["epoch"] == "int" and out.columns.count("mix_tokens") == 1
    got = [r["doc_id"] for r in out.collect()]
    assert got.count(1) == 1 and got.count(None) == 1 and got.count(3) >= 2 and 4 in got
    assert mixing.mix(rows(schema, []), max_repeats=2.0).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(rows(schema, data), max_repeats=2.0, max_sources=1)


def lines_by_hand(data, max_ratio, min_pages):
    out = []
    for key, host, text in data:
        pages = [t for _, h, t in data if h == host]
        bad = set()
        for line in {x.strip(" ") for t in pages if t for x in t.split("\n")} - {""}:
            n = sum(line in [x.strip(" ") for x in (t or "").split("\n")] for t in pages)
            if n >= min_pages and n > max_ratio * len(pages):
                bad.add(line)
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if x.strip(" ") not in bad]
        out.append((key, host, None if text is None else "\n".join(kept),
                    sum(x.strip(" ") != "" for x in lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_lines_against_brute_force(rows):
    data = [(i, ["a", "b", None][i % 3], f"own {i}\n  menu \n\nmenu\nrare {i % 20}\nfoot {i % 2}")
            for i in range(60)]
    data += [(100, "a", None), (101, "a", ""), (None, "b", "menu"), (5, "c", "menu"), (5, "c", "menu"),
             (7, "a", "x " * 50_000 + "\nmenu")]
    df = rows("doc_id long, source string, text string", data)
    for ratio, least in ((0.3, 3), (0.05, 2), (0.9, 1), (0.0, 1)):
        out = line_dedup.drop_boilerplate(df, "source", "text", ratio, least).collect()
        assert sorted((tuple(r) for r in out), key=str) == lines_by_hand(data, ratio, least)


def test_lines_keep_other_columns(rows):
    df = rows("n_lines string, host string, text string, LD_HOST string, b1 string",
              [("x", "h", "a\nb", "k", "l")] * 6)
    out = line_dedup.drop_boilerplate(df, "host", "text", 0.5, 2)
    assert out.columns == ["host", "text", "LD_HOST", "b1", "n_lines", "n_dropped"]
    assert {tuple(r) for r in out.collect()} == {("h", "", "k", "l", 2, 2)}
    assert line_dedup.drop_boilerplate(df.limit(0), "host").count() == 0


def test_copies_count_once_and_stay_whole(rows):
    data = [(i, "a", f"own {i}\nmenu") for i in range(20)]
    data += [(100 + i, "a", "one\ntwo\nmenu") for i in range(30)]  # copies, one page together
    data += [(200 + i, "a", f"a long line in all of them\nshort {i}") for i in range(10)]
    out = line_dedup.drop_boilerplate(rows("doc_id long, source string, text string", data), "source", "text",
                                      0.3, 5, distinct_pages=True, max_part=0.6).collect()
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in out}
    assert len(out) == 60 and all(got[i] == (f"own {i}", 1) for i in range(20))
    assert all(got[100 + i] == ("one\ntwo", 1) for i in range(30))
    assert all(got[200 + i] == (f"a long line in all of them\nshort {i}", 0) for i in range(10))


def test_host_of(rows):
    data = [("http://www.A.example.com/x?y",), ("https://b.example.org",), ("nothing",), (None,)]
    got = {r[0]: r[1] for r in rows("u string", data).select(
        "u", line_dedup.host_of(F.col("u"))).collect()}
    assert list(map(got.get, [d[0] for d in data])) == ["a.example.com", "b.example.org", None, None]
