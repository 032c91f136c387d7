import math
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import language_id, quality_rules

SF = "/root/testdata/sf0.001"
MODEL = (("aa", "the cat sat on the mat and the dog ran to the cat " * 3),
         ("bb", "der hund und die katze sassen auf der matte und der hund lief " * 3))


def phrases_by_hand(parser, text, learned):
    z = bytes(parser.letters(text).astype("uint8"))
    s = bytes(parser.letters(learned).astype("uint8"))
    n = 0
    for a in range(0, len(z), language_id.BLOCK):
        block, i = z[a:a + language_id.BLOCK], 0
        while i < len(block):
            j = i + 1
            while j <= len(block) and block[i:j] in s:
                j += 1
            i, n = max(i + 1, j - 1), n + 1
    return n


def test_phrases_against_brute_force():
    p = language_id.Parser(MODEL)
    r = random.Random(2)
    texts = ["", "the", "zzz", "ж the ж", "the dog und der hund", "x" * 1500,
             *["".join(r.choice("the dogund  ж1") for _ in range(r.randint(1, 1400))) for _ in range(20)]]
    got = p.phrases([p.letters(t) for t in texts])
    for t, row in zip(texts, got):
        assert row.tolist() == [phrases_by_hand(p, t, learned) for _, learned in MODEL]


def test_automaton_knows_exactly_the_substrings():
    text = [1, 2, 1, 1, 2, 3, 1, 2]
    steps = language_id.suffix_automaton(text)
    subs = {tuple(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1)}
    found, open_ = set(), [(0, ())]
    while open_:
        s, word = open_.pop()
        found.add(word)
        open_ += [(to, (*word, c)) for c, to in steps[s].items()]
    assert found == subs


def test_odd_texts(rows):
    data = [(1, None), (2, ""), (3, "12 !!"), (4, "the dog"), (4, "the dog"), (5, "der hund lief"),
            (None, "ж" * 30), (7, "the cat and " * 20_000)]
    df = rows("doc_id long, text string, LANG_PRED string, language_text string",
              [(*d, "x", "y") for d in data])
    out = language_id.identify(df, MODEL)
    assert out.columns == ["doc_id", "text", "language_text", "lang_pred", "score"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out.collect()}
    assert [got[k] for k in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[4][0] == "aa" and got[5][0] == "bb" and got[7][0] == "aa" and out.count() == 8
    assert got[None] == ("aa", 0.0)  # strange to both: the first by name
    assert all(0 <= s <= 1 for _, s in got.values())
    assert {r["lang_pred"] for r in language_id.identify(df, ()).collect()} == {"und"}
    assert language_id.identify(df.limit(0), MODEL).count() == 0


def test_fit_is_bounded_and_leaves_nulls_out(rows):
    data = [(f"text number {i} of a language", ["x", "y", None][i % 3]) for i in range(300)]
    data += [(None, "x"), ("short", "z")]
    model = language_id.fit(rows("text string, lang string", data), texts=5, chars=10)
    assert [lang for lang, _ in model] == ["x", "y"]
    assert all(len(t) <= 5 * 11 for _, t in model)
    assert language_id.fit(rows("text string, lang string", [])) == ()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"))))
    out = language_id.identify(docs.filter(language_id.held_out(F.col("doc_id"))), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.97 * len(out) > 30


def measures_by_hand(text):
    import re
    words = (text or "").encode().split()
    word_list = [w.decode() for w in words]
    seen, marks = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            for p in places:
                marks |= set(range(p, p + 5))
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (len(words), sum(map(len, word_list)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines),
            len(lines) - len(set(lines)), len(marks))


def test_measures_against_brute_force(spark, rows):
    r = random.Random(4)
    data = [(None,), ("",), (" \n\t",), ("a b c d e",), ("a b c d e a b c d e",), ("x " * 40,),
            ("é ü z\n# $ 1\n# $ 1\n\n# $ 1 ",), ("a b c d e f " * 3000,)]
    data += [(" ".join(r.choice("ab") for _ in range(r.randint(0, 60))) + "\n" * r.randint(0, 2)
              + "ab#",) for _ in range(80)]
    df = rows("text string", data).union(spark.read.parquet(f"{SF}/documents.parquet").select("text"))
    out = quality_rules.measured(df.withColumn("q_words", F.lit("clash")).withColumn("N_WORDS", F.lit(0)))
    assert out.columns == ["text", "q_words", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                           "n_repeat_words"]
    for x in out.collect():
        assert tuple(x)[2:] == measures_by_hand(x["text"]), x["text"]


def test_binomial_tail(spark):
    def tail(k, n, p):
        return sum(math.comb(n, j) * p ** j * (1 - p) ** (n - j) for j in range(k + 1))
    cases = [(0, 10), (1, 10), (10, 10), (3, 50), (0, 800), (5, 900), (20, 1000)]
    df = spark.createDataFrame(cases, "k long, n long")
    for p in (0.005, 0.2):
        for r in df.select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), p).alias("t")).collect():
            assert math.isclose(r["t"], tail(r["k"], r["n"], p), rel_tol=1e-9, abs_tol=1e-12)
    large = spark.createDataFrame([(100, 1_000_000)], "k long, n long")  # far below the smallest double
    assert large.select(quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.01)).first()[0] == 0.0


def test_cutoffs_keep_the_risk(rows):
    r = random.Random(1)
    data = [("a", 1, r.random() * 0.5, 0.0) for _ in range(4000)] + [("a", 0, 0.9, 0.9)] * 500
    data += [("b", 1, 0.0, 0.0)] * 30 + [(None, 1, 0.0, 1.0)] * 4000 + [("a", None, 1.0, 1.0)] * 50
    ladders = {"f": (0.1, 0.3, 0.6), "g": (0.5,)}
    out = quality_rules.choose_cutoffs(rows("s string, good int, f double, g double", data), "s",
                                       max_false=0.02, ladders=ladders).collect()
    got = {x["s"]: (x["f"], x["g"]) for x in out}
    # 0.1 and 0.3 would reject good documents of a; b has too few to show anything
    assert got == {"a": (0.6, 0.5), "b": (None, None), None: (0.1, None)}


def test_false_rejections_stay_below_the_limit(rows):
    """Good documents of one kind, over and over: a cutoff that rejects too many
    is chosen in no more than the allowed part of the trials."""
    wrong = 0
    for trial in range(12):
        r = random.Random(trial)
        data = [("a", 1, r.random()) for _ in range(600)]
        out = quality_rules.choose_cutoffs(rows("s string, good int, f double", data, 1), "s", max_false=0.05,
                                           ladders={"f": (0.93, 0.95, 0.99)}).first()
        wrong += out["f"] == 0.93
    assert wrong <= 1


def test_few_labels_are_enough(rows):
    """Strata of some hundred good labels get cutoffs, and small ones do not
    take them from the others."""
    data = [(s, 1, 0.0, 0.001 * (i % 5)) for s in "abcd" for i in range(250)]
    data += [(s, 0, 0.3, 0.0) for s in "abcd" for _ in range(30)]
    data += [(f"small {i}", 1, 0.0, 0.0) for i in range(300)]
    ladders = {"g": (0.002, 0.5), "f": (0.1, 0.2, 0.6)}
    out = quality_rules.choose_cutoffs(rows("s string, good int, f double, g double", data), "s",
                                       ladders=ladders).collect()
    got = {x["s"]: (x["g"], x["f"]) for x in out}
    assert len(got) == 304
    # f > 0.2 catches the bad ones and so comes first; g > 0.002 would cost 100 good ones
    assert all(got[s] == (0.5, 0.2) for s in "abcd")
    assert all(got[f"small {i}"] == (None, None) for i in range(300))


def test_rules_together_keep_the_risk(rows):
    """Each of two rules alone would pass, both together would not."""
    data = [("a", 1, float(i < 9), float(9 <= i < 18)) for i in range(1000)] + [("a", 0, 1.0, 0.0)]
    out = quality_rules.choose_cutoffs(rows("s string, good int, f double, g double", data), "s",
                                       ladders={"g": (0.5,), "f": (0.5,)}).first()
    assert (out["f"], out["g"]) == (0.5, None)


def test_bad_documents_of_every_language_go(spark):
    """The given tables: all four languages have labels enough."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = quality_rules.apply_rules(docs, labels).join(labels, "doc_id").filter("not base_failed")
    got = {(r["lang"], r["quality"]): (r["n"], r["gone"]) for r in out.groupBy("lang", "quality").agg(
        F.count("*").alias("n"), F.sum((~F.col("kept")).cast("int")).alias("gone")).collect()}
    for lang in ("de", "en", "es", "fr"):
        (n_bad, bad), (n_good, good) = got[lang, 0], got[lang, 1]
        assert bad >= 0.9 * n_bad and good <= 0.02 * n_good


def test_rules_on_odd_rows(rows):
    docs = [(1, "w " * 20, "en", "x"), (2, None, "en", None), (None, "", None, "x"), (4, "a b c d e " * 9, "de", "x"),
            (5, "one two three four five six seven eight nine ten", None, "x")]
    docs += [docs[0]]
    df = rows("doc_id long, text string, lang string, kept string", docs)
    out = quality_rules.apply_rules(df, rows("doc_id long, quality int", [(1, 1), (1, 0), (None, 1), (5, None)]))
    got = {(r["doc_id"], r["n_words"], r["base_failed"], r["kept"]) for r in out.collect()}
    assert got == {(1, 20, True, False), (2, 0, True, False), (None, 0, True, False), (4, 45, True, False),
                   (5, 10, False, True)}
    assert out.count() == 6
    empty = quality_rules.apply_rules(df.limit(0), rows("doc_id long, quality int", []))
    assert empty.count() == 0


def test_no_python_in_the_plan(rows):
    df = rows("doc_id long, text string, lang string", [(1, "a b", "en")])
    plan = quality_rules.measured(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
