"""Main text of web pages by a recurrent labeller of blocks.

A page is cut into blocks of text, the leaves of its tag tree in page order.
Each block is a vector: its hashed tag path, its hashed words and a few counts.
A bidirectional LSTM in numpy reads the whole sequence, so that each block is
judged in the light of the document before and after it, and labels it as main
text or not.  It is trained here, on pages made up from layouts.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache, lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import MARK_BYTES, fresh, require_columns, word_hashes

#: Elements whose begin and end part blocks of text.
BLOCKS = frozenset("""address article aside blockquote body br button caption center dd details dialog dir
    div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html
    legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td
    template textarea tfoot th thead title tr ul""".split())
#: Elements without an end.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup; only that of the last two is text.
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
#: What a start tag ends without saying so: tag → open elements it closes.
_PARTS = frozenset("td th".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", *_PARTS}, "td": _PARTS,
          "th": _PARTS, "option": {"option"}, "body": {"head"}}
#: Elements that end an open paragraph.
ENDS_P = BLOCKS - {"br", "button", "head", "html", "body", "title", "option", "optgroup", "template", "td",
                   "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "noscript", "select", "p",
                   "frameset", "textarea"} | {"p"}

# What a "<" begins, by the HTML standard's tokeniser.  A comment ends at "-->" or
# "--!>", and "<!-->" is one; a quote has a meaning only behind "=" (one that is never
# closed is part of a name).  Possessive repeats never go back, so no start is tried
# twice; a tag that does not end by the end of the page is no tag.
_COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+>?", re.S)
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+" + _VALUE + r"?+)?+|=)*+)>")
_LABEL = re.compile(r"""\b(?:class|id|role|itemprop|hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""",
                    re.I)
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[^\W_]+")

PATH_SIZE, WORD_SIZE, COUNTS = 48, 24, 10
INPUT = PATH_SIZE + WORD_SIZE + COUNTS
HIDDEN = 16
#: Blocks that go through the network at a time (some 2 KB each).
STEPS = 20_000


class Place:
    """An element's place in the tree: its parent's and its own label, that is its tag
    with the words of its class, id and role.  The vector of the path from the root is
    made once, from the parent's."""
    __slots__ = ("parent", "label", "_vector")

    def __init__(self, parent: Place | None, label: str):
        self.parent, self.label, self._vector = parent, label, None

    def vector(self) -> np.ndarray:
        todo, at = [], self
        while at._vector is None and at.parent is not None:
            todo.append(at)
            at = at.parent
        if at._vector is None:
            at._vector = _label_vector(at.label)
        for place in reversed(todo):
            place._vector = place.parent._vector + _label_vector(place.label)
        return self._vector


class Block(NamedTuple):
    place: Place  # of the innermost open element
    text: str
    link_chars: int


def blocks(page: str) -> list[Block]:
    """Texts between the borders of block elements, in page order; references
    decoded, white space made single spaces, empty ones left out.

    One scan forward; what is open is counted by tag, so that looking for an element
    that is not open costs nothing, and looking for one that is closes all it passes.
    """
    out: list[Block] = []
    open_: list[str] = []
    places = [Place(None, "")]
    counts: Counter[str] = Counter()
    text: list[str] = []
    links = open_blocks = 0

    def end_block() -> None:
        nonlocal links
        if text:
            joined = _SPACE.sub(" ", "".join(text)).strip()
            if joined:
                out.append(Block(places[-1], joined, links))
            text.clear()
        links = 0

    def close(upto: int) -> None:
        """Close all but the first ``upto`` open elements; a block ends before, if
        one of them is of a block."""
        if open_blocks and any(t in BLOCKS for t in open_[upto:]):
            end_block()
        drop(upto)

    def drop(upto: int) -> None:
        nonlocal open_blocks
        for t in open_[upto:]:
            counts[t] -= 1
            open_blocks -= t in BLOCKS
        del open_[upto:], places[upto + 1:]

    def push(tag: str, label: str) -> None:
        nonlocal open_blocks
        open_.append(tag)
        places.append(Place(places[-1], label))
        counts[tag] += 1
        open_blocks += tag in BLOCKS

    def innermost(tags) -> int:
        """Place of the innermost open one of ``tags``, which are open."""
        return next(k for k in range(len(open_) - 1, -1, -1) if open_[k] in tags)

    def add(raw: str) -> None:
        nonlocal links
        if raw:
            s = entities.unescape(raw) if "&" in raw else raw
            text.append(s)
            if counts["a"]:
                links += len(s)

    at = begin = 0  # text from ``begin`` on has not been added yet
    while True:
        at = page.find("<", at)
        if at < 0:
            add(page[begin:])
            break
        comment = _COMMENT.match(page, at)
        m = None if comment else _TAG.match(page, at)
        if not m and not comment:
            if page[at + 1:at + 2].isalpha() and page[at + 1:at + 2].isascii() or \
                    page[at + 1:at + 2] == "/" and page[at + 2:at + 3].isalpha() and page[at + 2:at + 3].isascii():
                add(page[begin:at])  # a tag that the page ends in
                break
            at += 1
            continue
        add(page[begin:at])
        at = begin = (comment or m).end()
        if comment:
            continue
        tag = m[2].lower()
        if m[1]:
            if counts[tag]:
                close(innermost((tag,)))
            elif tag in BLOCKS:
                end_block()
            continue
        if tag in BLOCKS:
            end_block()
        if tag in ENDS_P and counts["p"]:
            close(innermost(("p",)))
        if tag in CLOSES and any(counts[t] for t in CLOSES[tag]):
            k = innermost((*CLOSES[tag], "ul", "ol", "dl", "table", "select"))
            if open_[k] in CLOSES[tag]:
                close(k)
        if tag in VOID or m[3].rstrip().endswith("/") and tag not in BLOCKS:
            continue
        label = " ".join([tag, *[w.lower() for a in _LABEL.finditer(m[3] or "")
                                 for w in _WORD.findall(a[1] or a[0])]]) if m[3] else tag
        if tag in RAW:
            stop = _RAW_END[tag].search(page, at)
            inner = page[at:stop.start() if stop else len(page)]
            if tag in ("textarea", "title"):
                push(tag, label)
                add(inner)
                end_block()
                drop(len(open_) - 1)
            at = begin = stop.end() if stop else len(page)
            continue
        push(tag, label)
    end_block()
    return out


# ---------------------------------------------------------------- vectors

def _slot(word: str, size: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return h % size, 1.0 if h >> 31 else -1.0


@lru_cache(50_000)
def _label_vector(label: str) -> np.ndarray:
    v = np.zeros(PATH_SIZE, np.float32)
    if label not in ("", "html", "body"):
        for k, w in enumerate(label.split()):
            i, sign = _slot(("tag " if k == 0 else "label ") + w, PATH_SIZE)
            v[i] += sign
    return v


def vectors(pages: list[list[Block]]) -> list[np.ndarray]:
    """For each page one row for each of its blocks."""
    every = [b for page in pages for b in page]
    out = np.zeros((len(every), INPUT), np.float32)
    if not every:
        return [out for _ in pages]
    words, begin = word_hashes([b.text for b in every], MARK_BYTES)
    counts = np.diff(begin)
    owner = np.repeat(np.arange(len(every)), counts)
    slot = owner * WORD_SIZE + (words % np.uint64(WORD_SIZE)).astype(np.int64)
    sign = np.where(words >> np.uint64(63), 1.0, -1.0)
    bag = np.bincount(slot, sign, len(every) * WORD_SIZE).reshape(-1, WORD_SIZE)
    out[:, PATH_SIZE:PATH_SIZE + WORD_SIZE] = bag / np.maximum(counts, 1)[:, None]
    at, rows = 0, []
    for page in pages:
        longest = max((len(b.text) for b in page), default=1)
        for k, b in enumerate(page):
            n, t = len(b.text), b.text
            out[at + k, :PATH_SIZE] = b.place.vector()
            out[at + k, -COUNTS:] = (
                math.log1p(n) / 6, math.log1p(counts[at + k]) / 4, min(1.0, b.link_chars / n), n / longest,
                t[-1] in ".!?…", (t.count(",") + t.count(";")) / (1 + counts[at + k]), k / len(page),
                "©" in t or "®" in t, k == 0, 1.0)
        rows.append(out[at:at + len(page)])
        at += len(page)
    return rows


# ---------------------------------------------------------------- network

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with one logistic output for each block."""

    def __init__(self, seed: int = 1):
        r = np.random.default_rng(seed)
        def weights(*shape):
            return (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {}
        for side in "fb":
            self.p[f"x{side}"] = weights(INPUT, 4 * HIDDEN)
            self.p[f"h{side}"] = weights(HIDDEN, 4 * HIDDEN)
            self.p[f"c{side}"] = np.zeros(4 * HIDDEN, np.float32)
            self.p[f"c{side}"][HIDDEN:2 * HIDDEN] = 1  # remember at first
        self.p["out"] = weights(2 * HIDDEN, 1)
        self.p["skip"] = weights(INPUT, 1) * 0.1
        self.p["bias"] = np.zeros(1, np.float32)

    def _pass(self, x: np.ndarray, mask: np.ndarray, side: str, keep: list | None) -> np.ndarray:
        """x: (steps, pages, INPUT), mask: (steps, pages) → (steps, pages, HIDDEN)."""
        steps, pages, _ = x.shape
        gates = x @ self.p[f"x{side}"] + self.p[f"c{side}"]
        h = np.zeros((pages, HIDDEN), np.float32)
        c = np.zeros_like(h)
        out = np.zeros((steps, pages, HIDDEN), np.float32)
        for t in (range(steps) if side == "f" else range(steps - 1, -1, -1)):
            z = gates[t] + h @ self.p[f"h{side}"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            c_new = np.where(m, f * c + i * g, c)
            tc = np.tanh(c_new)
            h_new = np.where(m, o * tc, h)
            if keep is not None:
                keep.append((t, i, f, o, g, c, tc, h))
            h, c = h_new, c_new
            out[t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        both = []
        for side in "fb":
            steps = None if keep is None else keep.setdefault(side, [])
            both.append(self._pass(x, mask, side, steps))
        h = np.concatenate(both, axis=2)
        if keep is not None:
            keep["h"] = h
        return (h @ self.p["out"] + x @ self.p["skip"])[..., 0] + self.p["bias"]

    def gradient(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        keep: dict = {}
        z = self.logits(x, mask, keep)
        p = _sigmoid(z)
        n = mask.sum()
        loss = float(-(mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / n)
        dz = ((p - y) * mask / n).astype(np.float32)[..., None]
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"] = np.tensordot(keep["h"], dz, ((0, 1), (0, 1)))
        g["skip"] = np.tensordot(x, dz, ((0, 1), (0, 1)))
        g["bias"] = dz.sum(axis=(0, 1))
        dh_all = dz @ self.p["out"].T
        for side, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            dh = np.zeros((x.shape[1], HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, i, f, o, gg, c, tc, h in reversed(keep[side]):
                m = mask[t][:, None]
                total = dh + dh_all[t][:, part]
                d_cell = (dc + total * o * (1 - tc * tc)) * m
                dgates = np.concatenate([d_cell * gg * i * (1 - i), d_cell * c * f * (1 - f),
                                         total * m * tc * o * (1 - o), d_cell * i * (1 - gg * gg)], axis=1)
                g[f"x{side}"] += x[t].T @ dgates
                g[f"h{side}"] += h.T @ dgates
                g[f"c{side}"] += dgates.sum(axis=0)
                dh = dgates @ self.p[f"h{side}"].T + np.where(m, 0, total)
                dc = np.where(m, d_cell * f, dc)
        return loss, g

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Is it main text, for each block of each page.  Pages of like length
        go through together, as many as make ``STEPS`` blocks when padded to the
        longest, or one that is longer than that."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            n = len(order)  # the longest that are left, while they fit
            some = order[max(0, n - min(128, max(1, STEPS // len(pages[order[-1]])))):]
            del order[n - len(some):]
            x, mask = _padded([pages[k] for k in some])
            z = self.logits(x, mask)
            for j, k in enumerate(some):
                out[k] = z[:len(pages[k]), j] > 0
        return out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((steps, len(pages), INPUT), np.float32)
    mask = np.zeros((steps, len(pages)), bool)
    for j, p in enumerate(pages):
        x[:len(p), j] = p
        mask[:len(p), j] = True
    return x, mask


def train(pages: list[tuple[np.ndarray, np.ndarray]], rounds: int = 12, rate: float = 0.01,
          seed: int = 1) -> Labeller:
    """Adam on shuffled batches of 32 labelled pages."""
    net, r = Labeller(seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    t = 0
    for turn in range(rounds):
        order = r.permutation(len(pages))
        for a in range(0, len(order), 32):
            some = [pages[k] for k in order[a:a + 32]]
            x, mask = _padded([p for p, _ in some])
            y = np.zeros(mask.shape, np.float32)
            for j, (_, labels) in enumerate(some):
                y[:len(labels), j] = labels
            # words of a few pages are hidden, so that the paths are learned as well
            x[:, r.random(len(some)) < 0.4, PATH_SIZE:PATH_SIZE + WORD_SIZE] = 0
            _, g = net.gradient(x, mask, y)
            t += 1
            for k in net.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                step = rate * (1 - turn / rounds) * (m[k] / (1 - 0.9 ** t)) / (
                    np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
                net.p[k] = (net.p[k] - step).astype(np.float32)
    return net


# ---------------------------------------------------------------- made-up pages

#: What a part of a page may be called, by whether it is main text.
_SIDE = {
    "nav": ["nav", "menu", "navbar", "main-menu", "breadcrumb", "navigation", "site-nav", "pagination"],
    "header": ["header", "site-header", "masthead", "banner", "topbar", "logo"],
    "footer": ["footer", "site-footer", "copyright", "legal", "bottom"],
    "aside": ["sidebar", "aside", "related", "widget", "side", "recommended", "most-read", "tags", "share"],
    "ad": ["ad", "ads", "advert", "sponsored", "promo", "banner-ad", "advertisement"],
    "notice": ["cookie", "cookie-banner", "notice", "consent", "newsletter", "subscribe", "popup", "alert"],
    "comments": ["comments", "comment", "comment-list", "discussion", "replies", "reader-comments"],
}
_MAIN = ["article", "content", "post", "entry-content", "article-body", "main-content", "story", "post-body",
         "text"]
_PHRASES = {
    "nav": ["Home", "About", "Contact", "News", "Login", "Search", "Next", "Previous"],
    "header": ["Welcome", "The Daily", "Sign in", "Menu"],
    "footer": ["© 2024 All rights reserved", "Privacy policy", "Terms of use", "Imprint", "© {w} · {s}"],
    "aside": ["Related articles", "Most read", "Share this", "Tags: {w}, {w}"],
    "ad": ["Advertisement", "Sponsored", "Buy now {w}", "{s}"],
    "notice": ["We use cookies {s}", "Accept", "Subscribe to our newsletter", "{s}"],
    "comments": ["Comments", "{w} says:", "Reply", "{s}", "{s} {s}"],
}


def _words(r: random.Random, n: int) -> str:
    syllables = r.choice([["an", "er", "in", "ou", "th", "st", "re", "ing", "ea"],
                          ["ch", "ei", "en", "ung", "sch", "ber", "pf", "ü"],
                          ["eau", "que", "é", "oi", "ment", "la", "ai"],
                          ["ción", "os", "ll", "ar", "ñ", "ga", "do"]])
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n))


def _sentence(r: random.Random, longest: int = 30) -> str:
    words = _words(r, r.randint(1, longest)).capitalize()
    if r.random() < 0.06:  # junk and tables are found anywhere
        words = re.sub(" ", r.choice([" | ", "*** ", "&amp;&amp;&amp; ", "### ", " - ", ", "]), words)
    if r.random() < 0.05:
        words += r.choice([" 4.2.1", " +1 (555) 010-0000", f" {r.randint(1, 9999)}", " a@example.com",
                           "%%%", "$$$", "###", ' token = "9f3a"'])
    return words + r.choice([".", ".", ".", ".", ".", "", ",", "!", "?", ":"])


def _side_part(r: random.Random, kind: str) -> str:
    tag = r.choice([{"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "ad": "div",
                     "notice": "div", "comments": "section"}[kind], "div", "div", "section"])
    name = r.choice(_SIDE[kind])
    known = tag not in ("div", "section")
    attr = "" if known and r.random() < 0.6 else r.choice([f' class="{name}"', f' id="{name}"',
                                                           f' class="x{r.randint(1, 9)} {name}"'])
    parts = []
    for _ in range(r.randint(1, 7 if kind in ("nav", "comments") else 4)):
        if kind in ("ad", "footer", "notice", "comments", "aside") and r.random() < 0.5:
            # whole prose, so that words and length alone do not tell it from main text
            s = " ".join(_sentence(r) for _ in range(r.randint(1, 3)))
        else:
            s = r.choice(_PHRASES[kind]).format(w=_words(r, 1), s=_sentence(r, 14)) \
                if r.random() < 0.6 else _words(r, r.randint(1, 3))
        if kind == "nav" or kind in ("aside", "header") and r.random() < 0.5:
            s = f'<a href="/{r.randint(1, 99)}">{s}</a>'
        parts.append(s)
    form = r.choice(["li", "p", "div", "plain", "form"])
    if kind == "nav" and r.random() < 0.7:
        form = "li"
    inner = {"li": "<ul>" + "".join(f"<li>{p}</li>" for p in parts) + "</ul>",
             "p": "".join(f"<p>{p}</p>" for p in parts), "div": "".join(f"<div>{p}</div>" for p in parts),
             "plain": "<br>".join(parts), "form": "<form><label>" + "</label><label>".join(parts)
             + "</label><input><button>OK</button></form>"}[form]
    return f"<{tag}{attr}>{inner}</{tag}>"


_HERE = "\ue000"  # marks main text in made-up pages


def _main_part(r: random.Random) -> str:
    parts = []
    if r.random() < 0.8:
        parts.append(f"<h1>{_HERE}{_words(r, r.randint(1, 12))}</h1>")
    for _ in range(r.choice([1, 1, 2, 3, 5, 8, 12, 25])):
        s = _HERE + " ".join(_sentence(r) for _ in range(r.choice([1, 1, 2, 5, 9])))
        kind = r.random()
        if kind < 0.55:
            parts.append(f"<p>{s}</p>")
        elif kind < 0.65:
            parts.append(f"<p><b>{s}<br>")
        elif kind < 0.72:
            parts.append(f"<h{r.randint(2, 4)}>{_HERE}{_words(r, 4)}</h2>")
        elif kind < 0.78:
            parts.append("<ul>" + "".join(f"<li>{_HERE}{_sentence(r)}</li>" for _ in range(3)) + "</ul>")
        elif kind < 0.83:
            parts.append(f"<blockquote>{s}</blockquote>")
        elif kind < 0.88:
            parts.append(f'<p>{s} <a href="/x">{_words(r, 2)}</a> {_sentence(r)}</p>')
        elif kind < 0.92:
            parts.append("<table><tr>" + "".join(f"<td>{_HERE}{_words(r, 2)}</td>" for _ in range(3))
                         + "</tr></table>")
        elif kind < 0.96:
            parts.append(f"<div>{s}</div>")
        else:
            parts.append(_side_part(r, r.choice(["ad", "aside", "notice"])))
    return "".join(parts)


def made_up_page(r: random.Random) -> str:
    tag = r.choice(["article", "article", "article", "main", "div", "section"])
    attr = "" if tag in ("article", "main") and r.random() < 0.7 else \
        r.choice([f' class="{r.choice(_MAIN)}"', f' id="{r.choice(_MAIN)}"'])
    before = [_side_part(r, k) for k in ("header", "nav", "ad", "notice", "aside") if r.random() < 0.5]
    after = [_side_part(r, k) for k in ("aside", "ad", "comments", "notice", "nav", "footer")
             if r.random() < 0.4]
    if r.random() < 0.6:
        after.append(_side_part(r, "footer"))
    main = _main_part(r)
    if r.random() < 0.2:
        main += _side_part(r, r.choice(["comments", "aside"]))
    body = f"<{tag}{attr}>{main}</{tag}>"
    if r.random() < 0.3:
        body = f'<div class="{r.choice(["wrapper", "page", "container"])}">{body}</div>'
    return (f"<html><head><title>{_words(r, 5)}</title><script>x</script></head><body>"
            f"{''.join(before)}{body}{''.join(after)}</body></html>")


def labelled_page(page: str) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and labels of a made-up page."""
    got = blocks(page)
    labels = np.array([_HERE in b.text for b in got], np.float32)
    clean = [b._replace(text=b.text.replace(_HERE, "").strip() or "x") for b in got]
    return vectors([clean])[0], labels


@cache
def trained(pages: int = 1200, seed: int = 5) -> Labeller:
    r = random.Random(seed)
    return train([labelled_page(made_up_page(r)) for _ in range(pages)])


# ---------------------------------------------------------------- on Spark

def main_texts(pages: list[str | None], net: Labeller) -> list[str]:
    """Main text of each page: its blocks so labelled, joined by newlines."""
    parsed = [blocks(p or "") for p in pages]
    marks = net.label(vectors(parsed))
    return ["\n".join(b.text for b, keep in zip(p, m) if keep) for p, m in zip(parsed, marks)]


def extract_text(df: DataFrame, html_col: str = "html", text_as: str = "main_text",
                 net: Labeller | None = None) -> DataFrame:
    """``df`` with the main text of each page in ``text_as``.

    A null or empty page, and one without any main text, has an empty text.
    Whole pages are read, whatever their length.  An existing column called
    ``text_as`` is replaced; all others stay.
    """
    require_columns(df, [html_col])
    net = net or trained()
    own = [c for c in df.columns if c.lower() != text_as.lower()]
    lent, = fresh(df, "page_html")
    rows = df.select(*own, F.col(html_col).cast("string").alias(lent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column(batch.num_columns - 1).to_pylist()
            texts: list[str] = []
            for a in range(0, len(pages), 256):
                texts += main_texts(pages[a:a + 256], net)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())],
                                             [*batch.schema.names[:-1], text_as])

    return rows.mapInArrow(run, T.StructType(
        [*rows.drop(lent).schema.fields, T.StructField(text_as, T.StringType())]))
