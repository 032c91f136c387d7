import random
import re
import resource
import time
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import html_extract, pii_crf

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_by_hand(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and pii_crf.luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], list(PLAIN).index(s[0])))


def test_base_spans_are_those_of_the_patterns():
    r = random.Random(1)
    for _ in range(20_000):
        text = "".join(r.choice("aZ0199 .@-+()%_5\né") for _ in range(r.randint(0, 60)))
        assert pii_crf.base_spans(text) == base_by_hand(text)
    for text, _ in pii_crf.generated(300, seed=11):
        assert pii_crf.base_spans(text) == base_by_hand(text)


def test_very_long_runs_take_linear_time():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "+1" * 50_000, "a@" * 50_000):
        pii_crf.base_spans(text)


def test_luhn():
    assert pii_crf.luhn("4111111111111111") and not pii_crf.luhn("4111111111111112")


def test_field_finds_made_up_entities_it_has_not_seen():
    field = pii_crf.trained()
    hit = found = true = 0
    for text, spans in pii_crf.generated(200, seed=99):
        got = field.decode(text)
        hit, found, true = hit + len({*got} & {*spans}), found + len(got), true + len(spans)
    assert hit >= 0.97 * found and hit >= 0.97 * true


def test_field_adds_what_the_patterns_miss():
    text = "call (361) 555-8283 or use 7536784127813050 4845168114407329 now"
    base, spans = pii_crf.find(text, pii_crf.trained())
    assert base == [] and ("phone", 5, 19) in spans
    clean = "It was 12:30 on 2024-05-06, version 2.0.1, order 482913 at 3.50."
    assert pii_crf.find(clean, pii_crf.trained())[1] == []


def best_by_hand(field, text):
    """The score of the best segmentation, by trying all of them."""
    tokens = pii_crf._TOKEN.findall(text)
    segs = pii_crf.segments(tokens)

    def best(at, before):
        if at == len(tokens):
            return 0.0
        out = field.follow[before, 0] + field.outside.get(pii_crf._class(tokens[at]), 0.0) + best(at + 1, 0)
        for e in range(at + 1, len(tokens) + 1):
            for s, features in segs[e]:
                if s == at:
                    for k, w in enumerate(field.scores(features), 1):
                        out = max(out, field.follow[before, k] + w + best(e, k))
        return out

    def score(spans):
        total, at, before, starts = 0.0, 0, 0, np.cumsum([0, *map(len, tokens)]).tolist()
        by = {starts.index(a): (starts.index(b), pii_crf.KINDS.index(k) + 1) for k, a, b in spans}
        while at < len(tokens):
            e, k = by.get(at, (at + 1, 0))
            total += field.follow[before, k] + (
                field.scores(dict(segs[e])[at])[k - 1] if k else
                field.outside.get(pii_crf._class(tokens[at]), 0.0))
            at, before = e, k
        return total
    return best(0, 0), score(field.decode(text))


def test_decoding_goes_with_the_length_of_the_text():
    r, field, took = random.Random(6), pii_crf.trained(), []
    for n in (10_000, 40_000):
        text = " ".join(str(r.randint(0, 10 ** r.randint(1, 9))) for _ in range(n))
        begin = time.process_time()
        base, spans = pii_crf.find(text, field)
        took.append(time.process_time() - begin)
        assert base == pii_crf.base_spans(text) and set(base) <= set(spans)
    assert took[1] < 8 * took[0] + 1


def test_spans_at_the_borders_of_stretches_are_not_lost():
    field = pii_crf.trained()
    call = "call (361) 555-8283 now"
    assert pii_crf.find(call, field)[1] == [("phone", 5, 19)]
    for pad in range(0, 130, 7):  # another number at every distance around the reach
        text = f"{'w' * pad} 12 {'w ' * pad}{call} {'w ' * pad}34 {'w' * pad}"
        at = text.index("(361)")
        assert ("phone", at, at + 14) in pii_crf.find(text, field)[1]
    for a, b in pii_crf.regions("x" * 500 + "1" + "y" * 500 + " z " * 50 + "2"):
        assert (a, b) in ((0, 1001), (1110, 1152)) or a > 1001


def test_decoding_finds_the_best_segmentation():
    field = pii_crf.trained()
    for text in ("a@b.cd 12", "12-34 5678", "+1 23 4567", "x 1.2.3.4", "", "9" * 14):
        want, got = best_by_hand(field, text)
        assert abs(want - got) < 1e-9


def test_training_learns_its_examples():
    examples = pii_crf.generated(15, seed=5)
    field = pii_crf._Trainer(examples).train(rounds=30)
    assert sum(field.decode(text) == spans for text, spans in examples) >= 13


def test_personal_data_of_odd_rows(rows):
    data = [(1, None), (2, ""), (3, "mail a.b@c.example.com!"), (3, "mail a.b@c.example.com!"), (None, "+1 (361) 555-8283"),
            (4, "é" * 100_000 + " 1.2.3.4 " + "w " * 50_000)]
    df = rows("doc_id long, text string, BASE_SPANS string, searched_text string", [(*d, "x", "y") for d in data])
    out = pii_crf.find_personal_data(df)
    assert out.columns == ["doc_id", "text", "searched_text", "base_spans", "all_spans"]
    got = {r["doc_id"]: [tuple(s) for s in r["all_spans"]] for r in out.collect()}
    assert got == {1: [], 2: [], 3: [("email", 5, 22)], None: [("phone", 0, 17)], 4: [("ip", 100_001, 100_008)]}
    assert out.count() == 6 and pii_crf.find_personal_data(df.limit(0)).count() == 0


def test_redact_and_digest():
    assert pii_crf.redact("x a@b.cd y", [("email", 2, 8)]) == "x <email> y"
    assert pii_crf.redact(None, []) is None
    assert pii_crf.digest([]).startswith("e3b0c442")


# ---------------------------------------------------------------- pages

def texts(page):
    return [b.text for b in html_extract.blocks(page)]


def test_blocks_of_broken_markup():
    assert texts("<p>a<b>b</b> c<p>d<br>e &amp;&nbsp;&#233;  f</p>g") == ["ab c", "d", "e & é f", "g"]
    assert texts("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>") == ["a", "b", "c", "d", "e"]
    assert texts("a<!-- x <p> -->b<script>var t='</p>'</script>c<style>p{}</style>") == ["abc"]
    assert texts("<script>never ends <p>x") == [] and texts("x <!-- never ends") == ["x"]
    assert texts("1 < 2 > 0 &lt;p&gt; <3") == ["1 < 2 > 0 <p> <3"]
    assert texts('<p title="a > b">x</p></div></p>y') == ["x", "y"]
    assert texts("") == [] and texts("<p> \n </p>") == []
    assert len(texts("<p>" + "w " * 300_000 + "</p>" + "<div>" * 3000 + "deep")) == 2


def test_quotes_and_comments_end_as_the_standard_says():
    page = "<article><p data-x='it's'>One</p><p>Two isn't</p><p>Three</p></article>"
    assert texts(page) == ["One", "Two isn't", "Three"]
    assert texts('<p title="5"">Hello') == ["Hello"] and texts("<p a=\"b'c>d\" e='\">'>x") == ["x"]
    assert texts("<p>x<!-- a --!>y</p><p>z</p>") == ["xy", "z"] and texts("a<!-->b<!--->c<!-- -- >-->d") == ["abcd"]
    assert texts("<p class=a/>x<p/class=b id>y<p = a='>z") == ["x", "y", "z"]
    assert texts("<p title='never closed>one</p><p>two</p>") == ["one", "two"]
    assert texts("x <b y") == ["x"] and texts("1 <2 <") == ["1 <2 <"]


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<div>" * 200_000, '<a b="' * 170_000, "<p title='" * 100_000, "<div>x" * 150_000,
    "<div>" * 70_000 + "</p></span>" * 60_000, "<ul>" * 60_000 + "<li>x" * 100_000, "<!--" * 250_000,
    "< " * 500_000, "&amp" * 250_000, '<p class="' * 100_000, "<a " + "=" * 1_000_000, "<script>" * 120_000])
def test_hostile_pages_of_a_megabyte_take_seconds(page):
    begin = time.process_time()
    html_extract.blocks(page)
    assert time.process_time() - begin < 20


def test_a_page_of_200_000_blocks_takes_bounded_memory():
    net = html_extract.trained()
    page = "<article>" + "<p>Some words of a sentence, and more." * 200_000 + "</article>"
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    text = html_extract.main_texts([page, "<p>short</p>"] + ["<div>x</div>"] * 100, net)[0]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1 << 20  # KB
    assert text.count("\n") > 150_000


class Article(HTMLParser):
    """The blocks of a page's article elements, by the parser of the standard library."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.skip, self.parts = 0, 0, [""]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.skip += tag in ("script", "style")
        if tag in html_extract.BLOCKS:
            self.parts.append("")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        self.skip -= tag in ("script", "style")
        if tag in html_extract.BLOCKS:
            self.parts.append("")

    def handle_data(self, data):
        if self.depth and not self.skip:
            self.parts[-1] += data

    def text(self):
        return "\n".join(t for t in (" ".join(p.split()) for p in self.parts) if t)


def test_pages_of_the_table_against_another_parser(spark):
    out = html_extract.extract_text(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()
    wrong = 0
    for x in out:
        other = Article()
        other.feed(x["html"])
        other.close()
        wrong += x["main_text"] != other.text()
    assert len(out) > 10 and wrong <= 0.02 * len(out)


def test_gradient_of_the_network():
    r = random.Random(3)
    pages = [html_extract.labelled_page(html_extract.made_up_page(r)) for _ in range(3)]
    net = html_extract.Labeller(2)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask = html_extract._padded([p for p, _ in pages])
    y = np.zeros(mask.shape)
    for j, (_, labels) in enumerate(pages):
        y[:len(labels), j] = labels
    _, g = net.gradient(x, mask, y)
    for name, grad in g.items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        old, sides = net.p[name][at], []
        for step in (1e-3, -1e-3):
            net.p[name][at] = old + step
            sides.append(net.gradient(x, mask, y)[0])
        net.p[name][at] = old
        assert abs((sides[0] - sides[1]) / 2e-3 - grad[at]) < 1e-4 + 1e-2 * abs(grad[at])


def test_labels_of_made_up_pages_not_seen():
    net, r = html_extract.trained(), random.Random(77)
    pages = [html_extract.labelled_page(html_extract.made_up_page(r)) for _ in range(200)]
    right = [got == (want > 0) for got, (_, want) in zip(net.label([p for p, _ in pages]), pages)]
    assert np.concatenate(right).mean() >= 0.98


def test_batches_do_not_change_a_page():
    net, r = html_extract.trained(), random.Random(8)
    pages = [html_extract.made_up_page(r) for _ in range(40)]
    assert html_extract.main_texts(pages, net) == [html_extract.main_texts([p], net)[0] for p in pages]


def test_pages_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = html_extract.extract_text(pages).collect()
    wrong = 0
    for x in out:
        inner = x["html"][x["html"].index("<article>"):x["html"].index("</article>")]
        wrong += x["main_text"] != "\n".join(texts(inner))
    assert len(out) == pages.count() and wrong <= 0.02 * len(out)


def test_pages_of_odd_rows(rows):
    page = "<nav><a href=x>Home</a></nav><article><p>One long sentence of the main text.</p></article><footer>©</footer>"
    data = [(1, None), (2, ""), (3, page), (3, page), (None, "<script>x</script>")]
    df = rows("page_id long, html string, MAIN_TEXT string, page_html string", [(*d, "x", "y") for d in data])
    out = html_extract.extract_text(df)
    assert out.columns == ["page_id", "html", "page_html", "main_text"]
    got = {r["page_id"]: r["main_text"] for r in out.collect()}
    assert got == {1: "", 2: "", 3: "One long sentence of the main text.", None: ""}
    assert out.count() == 5 and html_extract.extract_text(df.limit(0)).count() == 0
    assert out.filter(F.col("main_text").isNull()).count() == 0
