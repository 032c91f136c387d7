"""Personal data by patterns and a semi-Markov conditional random field.

Patterns give the base spans.  Around every digit and at-sign a semi-Markov CRF
scores whole candidate segments (their skeleton, digit groups, checksums,
neighbours), and dynamic programming over segments of at most ``LONGEST``
tokens picks boundaries and kinds jointly; its spans that touch no base span are
added.  The field is trained here, on generated sentences.
"""

from __future__ import annotations

import hashlib
import random
import re
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import cache
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import fresh, require_columns

KINDS = ("email", "ip", "card", "phone")
#: Most tokens in a segment.
LONGEST = 16
#: Characters looked at on either side of a digit or an at-sign.
REACH = 40

Span = tuple[str, int, int]

# The base patterns; possessive repeats match the same and never go back.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_ANCHOR = re.compile(r"[0-9@]++")
_GAP = re.compile(r"\s")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping spans of each kind, by start, then kind."""
    out: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > done and _LOCAL.match(text, begin - 1):
            begin -= 1
        m = _DOMAIN.match(text, at) if begin < at else None
        if m:
            out.append(("email", begin, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = re.sub(r"[\x20-]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGIT.findall(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around digits and at-signs: at least ``REACH`` characters on either
    side, and on to the next white space or end of the text."""
    out: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        if out and m.end() + REACH <= out[-1][1]:
            continue
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        low = out[-1][1] if out else 0
        while a > low and not text[a - 1].isspace():
            a -= 1
        space = _GAP.search(text, b) if b and not text[b - 1].isspace() else None
        b = b if b and text[b - 1].isspace() else space.start() if space else len(text)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _class(token: str) -> str:
    c = token[0]
    return "9" if "0" <= c <= "9" else "a" if c.isalpha() else " " if c.isspace() else c


class Tokens:
    """The tokens of a stretch of text, their classes (one character each), and what
    segments over them are made from: lengths of digit groups, digits so far, and for
    each place the last word and the last gap before it."""

    def __init__(self, tokens: list[str]):
        self.tokens, self.kinds = tokens, "".join(map(_class, tokens))
        self.group, self.digits, self.word, self.after_gap = [], [0], [], [0]
        last, gap = "", 0
        for i, (t, k) in enumerate(zip(tokens, self.kinds)):
            n = len(t) if k == "9" else 0
            self.group.append(min(n, 20))
            self.digits.append(self.digits[-1] + n)
            self.word.append(last)
            if k == "a":
                last = t.lower()
            elif k == " " and t != " ":
                gap = i + 1  # a line end or a wider gap is in no entity
            self.after_gap.append(gap)

    def ending(self, e: int) -> Iterator[tuple[int, Candidate]]:
        """The segments that end before token ``e`` and could be an entity, by start:
        they hold a digit or an at-sign and begin and end well."""
        kinds = self.kinds
        if kinds[e - 1] not in "9a":
            return
        right = kinds[e] if e < len(kinds) else "$"
        for s in range(max(self.after_gap[e], e - LONGEST), e):
            if kinds[s] in "9a+(":
                n = self.digits[e] - self.digits[s]
                if n < 4 and kinds.find("@", s, e) < 0:
                    continue
                skeleton = kinds[s:e]
                check = quad = None
                if 13 <= n <= 19:
                    check = luhn("".join([t for t, k in zip(self.tokens[s:e], skeleton) if k == "9"]))
                if skeleton == "9.9.9.9":
                    quad = all(map(_small, self.tokens[s:e:2]))
                yield s, Candidate(skeleton, n if n < 20 else 20, tuple(filter(None, self.group[s:e])),
                                   kinds[s - 1] if s else "^", right, self.word[s], check, quad)


class Candidate(NamedTuple):
    """All that a segment's features are made from; many segments are alike in it."""
    skeleton: str
    digits: int
    groups: tuple[int, ...]
    left: str
    right: str
    word: str
    check: bool | None
    quad: bool | None

    def features(self) -> list[str]:
        out = [*_shape(self.skeleton), *self._details(), "groups=" + "-".join(map(str, self.groups))]
        return out

    def _details(self) -> list[str]:
        """Those of neighbours and digits, without the lengths of the groups."""
        out = [f"digits={self.digits}", "left=" + self.left, "right=" + self.right, "word=" + self.word]
        if self.check is not None:
            out.append(f"luhn={self.check}")
        if self.quad is not None:
            out.append(f"quad={self.quad}")
        return out


def _shape(k: str) -> list[str]:
    """Features of a skeleton alone."""
    out = ["any", "skeleton=" + k, f"at={k.count('@')}", f"dots={min(k.count('.'), 5)}",
           f"gaps={min(k.count(' '), 5)}",
           "first=" + k[0] + ("+" if "+" in k else "") + ("(" if "(" in k else "")]
    if "@" in k:
        local, _, domain = k.rpartition("@")
        out.append(f"mail={bool(local)}{'.' in domain.strip('.')}{' ' in k}{k[-1]}")
    return out


def segments(tokens: list[str]) -> list[list[tuple[int, list[str]]]]:
    """For every end (exclusive) the (start, features) of the segments that could be
    an entity."""
    t = Tokens(tokens)
    return [[]] + [[(s, c.features()) for s, c in t.ending(e)] for e in range(1, len(tokens) + 1)]


class Field:
    """Weights of segment features for each kind, of lone outside tokens, and of
    one label following another (0 is outside)."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.weight = np.zeros((0, len(KINDS)))
        self.outside: dict[str, float] = {}
        self.follow = np.zeros((len(KINDS) + 1, len(KINDS) + 1))

    def scores(self, features: list[str]) -> np.ndarray:
        rows = [self.index[f] for f in features if f in self.index]
        return self.weight[rows].sum(axis=0)

    def _scorer(self) -> Callable[[Candidate], list[float]]:
        """``scores`` of a candidate's features, from sums that many candidates share."""
        parts: dict = {}

        def part(key, features: Callable[[], list[str]]) -> list[float]:
            got = parts.get(key)
            if got is None:
                if len(parts) > 200_000:
                    parts.clear()
                got = parts[key] = self.scores(features()).tolist()
            return got

        def score(c: Candidate) -> list[float]:
            shape = part(c.skeleton, lambda: _shape(c.skeleton))
            rest = part((c.digits, c.left, c.right, c.word, c.check, c.quad), c._details)
            row = self.index.get("groups=" + "-".join(map(str, c.groups)))
            if row is None:
                return [a + b for a, b in zip(shape, rest)]
            return [a + b + g for a, b, g in zip(shape, rest, self.weight[row].tolist())]
        return score

    def decode(self, text: str) -> list[Span]:
        """The best segmentation of a stretch of text: its entities.

        Segments are bounded, so the work goes with the number of tokens; what is kept
        of each token is a score and a way back for each label."""
        tokens = _TOKEN.findall(text)
        known, labels, size = Tokens(tokens), range(len(KINDS) + 1), len(tokens)
        follow, kinds, never = self.follow.tolist(), range(1, len(KINDS) + 1), float("-inf")
        score_of = self._scorer()
        back_to, back_label = array("i"), array("b")
        enter: list[tuple[list[float], list[int]]] = []  # best way into an entity after each token
        best = [0.0] + [never] * len(KINDS)
        for e in range(size + 1):
            if e:
                ways = [best[x] + follow[x][0] for x in labels]
                y = max(labels, key=ways.__getitem__)
                best = [ways[y] + self.outside.get(known.kinds[e - 1], 0.0)] + [never] * len(KINDS)
                to, label = [e - 1] * len(labels), [y] * len(labels)
                for s, found in known.ending(e):
                    score = score_of(found)
                    ways, froms = enter[s]
                    for k in kinds:
                        value = ways[k - 1] + score[k - 1]
                        if value > best[k]:
                            best[k], to[k], label[k] = value, s, froms[k - 1]
                back_to.extend(to)
                back_label.extend(label)
            froms = [max(labels, key=lambda x: best[x] + follow[x][k]) for k in kinds] \
                if any(v > never for v in best[1:]) else [0] * len(KINDS)
            enter.append(([best[x] + follow[x][k] for k, x in zip(kinds, froms)], froms))
            if e >= LONGEST:
                enter[e - LONGEST] = ()  # no segment reaches back so far any more
        starts = [0, *accumulate(map(len, tokens))]
        e, y, out = size, max(labels, key=best.__getitem__), []
        while e > 0:
            at = (e - 1) * len(labels) + y
            s, before = back_to[at], back_label[at]
            if y:
                out.append((KINDS[y - 1], starts[s], starts[e]))
            e, y = s, before
        return out[::-1]


# ---------------------------------------------------------------- training

def _word(r: random.Random) -> str:
    return "".join(r.choice(["an", "er", "in", "ou", "the", "st", "ch", "ei", "la", "de", "que", "ón"])
                   for _ in range(r.randint(1, 4)))


def _number(r: random.Random, n: int) -> str:
    return "".join(str(r.randint(0, 9)) for _ in range(n))


def _card(r: random.Random, valid: bool) -> str:
    while True:
        d = _number(r, r.choice([14, 15, 16, 16, 16, 16, 17, 18, 19]))
        if luhn(d) == valid:
            break
    if len(d) == 16 and r.random() < 0.4:
        return r.choice([" ", "-"]).join(d[i:i + 4] for i in range(0, 16, 4))
    return d


def _phone(r: random.Random) -> str:
    a, b, c = _number(r, 3), _number(r, 3), _number(r, 4)
    return r.choice([f"+1 ({a}) {b}-{c}", f"+1 ({a}) {b}-{c}", f"+{r.randint(1, 99)} {a} {b} {c}",
                     f"({a}) {b}-{c}", f"({a}) {b}-{c}", f"({a}) {b} {c}", f"{a}-{b}-{c}"])


def _email(r: random.Random) -> str:
    user = r.choice([_word(r), f"{_word(r)}.{_number(r, 2)}", f"{_word(r)}.{_word(r)}"])
    return f"{user}@{r.choice(['mail', 'post', _word(r)])}{r.choice(['', _number(r, 1)])}." \
           f"{r.choice(['example.', ''])}{r.choice(['com', 'org', 'net', 'de', 'fr'])}".replace("ó", "o")


def _ip(r: random.Random, valid: bool) -> str:
    parts = [r.randint(0, 255) for _ in range(4)]
    if not valid:
        parts[r.randrange(4)] = r.randint(256, 999)
    return ".".join(map(str, parts))


def _other(r: random.Random) -> str:
    """Numbers and signs that are nobody's personal data."""
    return r.choice([
        lambda: _card(r, False), lambda: _card(r, False), lambda: _ip(r, False),
        lambda: f"{r.randint(1900, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}",
        lambda: f"{r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1900, 2030)}",
        lambda: f"{r.randint(0, 23)}:{r.randint(0, 59):02}", lambda: f"{r.randint(1, 9)}.{r.randint(0, 9)}",
        lambda: f"{r.randint(1, 9)}.{r.randint(0, 9)}.{r.randint(0, 99)}", lambda: _number(r, r.randint(1, 12)),
        lambda: f"{_number(r, 2)},{_number(r, 3)}.{_number(r, 2)}", lambda: f"@{_word(r)}",
        lambda: f"{_word(r)} @ {_word(r)}", lambda: f'token = "{r.getrandbits(128):032x}"',
        lambda: f"{_number(r, 4)} {_number(r, 3)} {_number(r, 5)}", lambda: f"{_word(r)}{_number(r, 2)}",
        lambda: f"{_number(r, 3)}-{_number(r, 2)}", lambda: f"({_number(r, 4)})",
        lambda: f"{_number(r, 13)}", lambda: f"{_number(r, 3)} {_number(r, 4)} ({_number(r, 2)})"])()


def generated(n: int, seed: int = 7) -> list[tuple[str, list[Span]]]:
    """Stretches of text with their true spans."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(r.randint(1, 3)):
            text += " ".join(_word(r) for _ in range(r.randint(1, 4))) + r.choice([" ", " ", " ", ". ", "\n"])
            kind = r.choice([*KINDS, "", ""])
            item = {"email": _email, "ip": lambda r: _ip(r, True), "card": lambda r: _card(r, True),
                    "phone": _phone, "": _other}[kind](r)
            if kind:
                spans.append((kind, len(text), len(text) + len(item)))
            text += item + r.choice([" ", " ", ". ", ", ", "\n", "*** ", "!! "])
        out.append((text + _word(r), spans))
    return out


def _log_sum(x: np.ndarray, axis: int | None = None) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis)) if axis is not None \
        else float(top.ravel()[0] + np.log(np.exp(x - top).sum()))


class _Trainer:
    """Gradient steps on the likelihood of the true segmentations."""

    def __init__(self, examples: list[tuple[str, list[Span]]]):
        self.field, self.examples = Field(), []
        seen: dict[str, int] = {}
        for text, spans in examples:
            tokens = _TOKEN.findall(text)
            segs = segments(tokens)
            for ss in segs:
                for _, fs in ss:
                    for f in fs:
                        seen[f] = seen.get(f, 0) + 1
            self.examples.append((tokens, segs, spans))
        for f, n in seen.items():
            if n >= 3:
                self.field.index[f] = len(self.field.index)
        self.classes = sorted({_class(t) for ts, _, _ in self.examples for t in ts})
        self.field.weight = np.zeros((len(self.field.index), len(KINDS)))
        self.out = np.zeros(len(self.classes))
        self.seen = [np.full(x.shape, 1e-3) for x in (self.field.weight, self.out, self.field.follow)]
        self.ready = [self._prepare(*x) for x in self.examples]

    def _prepare(self, tokens, segs, spans):
        starts = {int(x): i for i, x in enumerate(np.cumsum([0, *map(len, tokens)]))}
        gold = {(starts[a], starts[b]): KINDS.index(k) + 1 for k, a, b in spans}
        rows = [[(s, np.array([self.field.index[f] for f in fs if f in self.field.index], int))
                 for s, fs in ss] for ss in segs]
        return [self.classes.index(_class(t)) for t in tokens], rows, gold

    def step(self, classes, segs, gold, rate: float, decay: float) -> None:
        f, n, labels = self.field, len(classes), len(KINDS) + 1
        score = [[f.weight[rows].sum(axis=0) for _, rows in ss] for ss in segs]
        ahead = np.full((n + 1, labels), -np.inf)
        ahead[0, 0] = 0.0
        for e in range(1, n + 1):
            ahead[e, 0] = _log_sum(ahead[e - 1] + f.follow[:, 0]) + self.out[classes[e - 1]]
            for (s, _), w in zip(segs[e], score[e]):
                ahead[e, 1:] = np.logaddexp(ahead[e, 1:], _log_sum(
                    ahead[s][:, None] + f.follow[:, 1:], axis=0) + w)
        total = _log_sum(ahead[n])
        behind = np.full((n + 1, labels), -np.inf)
        behind[n] = 0.0
        g_weight, g_out, g_follow = {}, np.zeros_like(self.out), np.zeros_like(f.follow)
        for e in range(n, 0, -1):
            # every segment that ends here: its expected count, then what it hands back
            w = self.out[classes[e - 1]] + behind[e, 0]
            p = np.exp(ahead[e - 1] + f.follow[:, 0] + w - total)
            g_out[classes[e - 1]] -= p.sum()
            g_follow[:, 0] -= p
            behind[e - 1] = np.logaddexp(behind[e - 1], f.follow[:, 0] + w)
            for (s, rows), v in zip(segs[e], score[e]):
                w = v + behind[e, 1:]
                p = np.exp(ahead[s][:, None] + f.follow[:, 1:] + w - total)
                g_follow[:, 1:] -= p
                g_weight[s, e] = (rows, -p.sum(axis=0))
                behind[s] = np.logaddexp(behind[s], _log_sum(f.follow[:, 1:] + w, axis=1))
        at, before = 0, 0
        by_start = {s: (e, k) for (s, e), k in gold.items()}
        while at < n:  # the true segmentation
            e, k = by_start.get(at, (at + 1, 0))
            g_follow[before, k] += 1
            if k and (at, e) in g_weight:
                g_weight[at, e][1][k - 1] += 1
            elif not k:
                g_out[classes[at]] += 1
            at, before = e, k
        grad = np.zeros_like(f.weight)
        for rows, g in g_weight.values():
            grad[rows] += g
        for x, g, seen in zip((f.weight, self.out, f.follow), (grad, g_out, g_follow), self.seen):
            g -= decay * x
            seen += g * g
            x += rate * g / np.sqrt(seen)

    def train(self, rounds: int, seed: int = 3) -> Field:
        r = random.Random(seed)
        for _ in range(rounds):
            for k in r.sample(range(len(self.ready)), len(self.ready)):
                self.step(*self.ready[k], rate=0.3, decay=1e-3)
        self.field.outside = dict(zip(self.classes, self.out.tolist()))
        return self.field


@cache
def trained(examples: int = 500, rounds: int = 4) -> Field:
    return _Trainer(generated(examples)).train(rounds)


# ---------------------------------------------------------------- on Spark

def _free_of(taken: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Does a span touch none of ``taken``?  Those that overlap are joined, so one
    look to the left is enough."""
    joined_spans: list[list[int]] = []
    for x, y in sorted(taken):
        if joined_spans and x < joined_spans[-1][1]:
            joined_spans[-1][1] = max(joined_spans[-1][1], y)
        else:
            joined_spans.append([x, y])
    starts = [x for x, _ in joined_spans]

    def free(s: int, e: int) -> bool:
        k = bisect_left(starts, e) - 1  # the last that begins before the end
        return k < 0 or joined_spans[k][1] <= s
    return free


def find(text: str | None, field: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a text, each by start, then kind."""
    text = text or ""
    base = base_spans(text)
    free = _free_of([(x, y) for _, x, y in base])
    added: list[Span] = []
    for a, b in regions(text):
        for kind, s, e in field.decode(text[a:b]):
            if free(s + a, e + a):
                added.append((kind, s + a, e + a))
    return base, sorted([*base, *added], key=_order)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_personal_data(df: DataFrame, text_col: str = "text", field: Field | None = None) -> DataFrame:
    """``df`` with ``base_spans`` and ``all_spans``: arrays of (kind, start, end),
    in code points with the end exclusive, by start, then kind as in ``KINDS``.

    All texts are searched whole; a null or empty text has no spans.  Existing
    columns of these names are replaced; all others stay.
    """
    require_columns(df, [text_col])
    field = field or trained()
    df = df.drop("base_spans", "all_spans")
    lent, = fresh(df, "searched_text")
    rows = df.select("*", F.col(text_col).cast("string").alias(lent))
    spans = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()),
                                      T.StructField("start", T.LongType()),
                                      T.StructField("end", T.LongType())]))
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find(t, field) for t in batch.column(batch.num_columns - 1).to_pylist()]
            cols = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x[i]] for x in found], arrow)
                    for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *cols], [*batch.schema.names[:-1], "base_spans", "all_spans"])

    return rows.mapInArrow(run, T.StructType([
        *df.schema.fields, T.StructField("base_spans", spans), T.StructField("all_spans", spans)]))


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by its kind in angle brackets; of spans
    that overlap, the first."""
    if text is None:
        return None
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
            at = b
    return "".join([*out, text[at:]])


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
