"""Language identification by cross-parsing entropy.

Each language has a suffix automaton of labelled text.  A text is parsed
greedily into the longest phrases that occur in that text; a language whose
phrases are long needs few of them.  The number of phrases times
``log2(size of the labelled text)`` over the letters parsed is an entropy, and
the language with the least one is the answer.

Parsing needs no suffix links: a phrase that cannot go on ends, and the next one
starts at the root.  So an automaton is a table from (state, letter) to (state,
did a phrase start), and numpy walks all blocks of a batch of texts through the
tables of all languages in step.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import fresh, require_columns

#: Letters walked in one go: a text is parsed in blocks of this many letters,
#: and the phrase at the end of a block is cut there, alike for all languages.
BLOCK = 512
#: Learned from: for each language this many labelled texts ...
SAMPLE_TEXTS = 40
#: ... of which the first so many characters.
SAMPLE_CHARS = 900
MAX_LANGUAGES = 200

Model = tuple[tuple[str, str], ...]  # (language, labelled text), in order of language


def sample(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text",
           texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(lang, piece): the bounded sample a model is learned from: the openings
    of ``texts`` distinct texts for each language, picked by a hash."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("key")).filter(F.length("text") >= 20)
    picked = rows.groupBy("lang", F.pmod("key", F.lit(texts)).alias("slot")).agg(
        F.min("key").alias("key")).select(F.col("lang").alias("p_lang"), F.col("key").alias("p_key"))
    found = rows.select("lang", "key", F.substring("text", 1, chars).alias("piece")).join(
        picked, (F.col("lang") == F.col("p_lang")) & (F.col("key") == F.col("p_key")))
    return found.groupBy("lang", "key").agg(F.min("piece").alias("piece"))


def fit(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text",
        texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> Model:
    """The labelled text of each language.

    Null labels and texts are left out; no labelled rows give an empty model.
    More than ``MAX_LANGUAGES`` languages raise an error.
    """
    rows = sample(labelled, lang_col, text_col, texts, chars) \
        .limit(MAX_LANGUAGES * texts + 1).collect()  # bounded by the parameters, or an error
    by: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["key"])):
        by.setdefault(r["lang"], []).append(r["piece"])
    if len(by) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return tuple((lang, "\n".join(pieces)) for lang, pieces in sorted(by.items()))


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the
    root."""
    step: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in text:
        new = len(step)
        step.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step


class Parser:
    """The automata of a model as one table, and counts of phrases by it."""

    def __init__(self, model: Model):
        self.languages = [lang for lang, _ in model]
        known = sorted({c for _, t in model for c in t.lower() if c.isalpha()})
        self.width = len(known) + 2  # 0: no letter, last: a letter nobody knows
        alphabet = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        self.classes = np.where(alphabet, self.width - 1, 0).astype(np.uint16)
        for k, c in enumerate(known):
            self.classes[ord(c)] = k + 1
        tables, self.bits, self.roots, begin = [], [], [], 0
        for _, text in model:
            letters = self.letters(text)
            states = suffix_automaton(letters.tolist())
            root = np.full(self.width, begin * 2 + 1, np.int64)
            for c, to in states[0].items():
                root[c] = (begin + to * self.width) * 2 + 1
            table = np.tile(root, (len(states), 1))
            for s, out in enumerate(states[1:], 1):
                for c, to in out.items():
                    table[s, c] = (begin + to * self.width) * 2
            tables.append(table.ravel())
            self.roots.append(begin)
            self.bits.append(math.log2(max(2, len(letters))))
            begin += table.size
        self.table = np.concatenate(tables) if tables else np.empty(0, np.int64)
        if begin < 1 << 30:
            self.table = self.table.astype(np.int32)

    def letters(self, text: str) -> np.ndarray:
        """Classes of the lower-case letters; all between two of them is one 0."""
        got = self.classes[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
        gap = got == 0
        return got[~gap | np.concatenate(([False], ~gap[:-1]))]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (row) in each language (column)."""
        owner, parts = [], []
        for i, t in enumerate(texts):
            for a in range(0, len(t), BLOCK):
                owner.append(i)
                parts.append(t[a:a + BLOCK])
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        if not parts:
            return out
        sizes = np.array([len(p) for p in parts])
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        grid = np.zeros((int(sizes[0]), len(parts)), self.table.dtype)
        for lane, k in enumerate(order):
            grid[:len(parts[k]), lane] = parts[k]
        active = np.searchsorted(-sizes, -np.arange(len(grid)), side="left")
        at = np.repeat(np.array(self.roots, self.table.dtype)[:, None], len(parts), axis=1)
        count = np.zeros(at.shape, np.int32)
        for t, n in enumerate(active.tolist()):
            moved = self.table.take(at[:, :n] + grid[t, :n], mode="clip")
            count[:, :n] += moved & 1
            np.right_shift(moved, 1, out=at[:, :n])
        np.add.at(out, np.array(owner)[order], count.T)
        return out

    def identify(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text.  The score is how much less the best
        entropy is than the second best, as a part of that (0 to 1)."""
        got = [self.letters(t or "") for t in texts]
        counts = self.phrases(got)
        langs, scores, bits = [], [], np.array(self.bits)
        for letters, row in zip(got, counts):
            if not self.languages or not letters.any():
                langs.append("und")
                scores.append(0.0)
                continue
            strange = int((letters == self.width - 1).sum())  # a phrase each, and alike for all
            entropy = ((row - strange) * bits + strange * bits.max()) / len(letters)
            best = int(entropy.argmin())  # the first in order of language, if several
            rest = np.delete(entropy, best)
            langs.append(self.languages[best])
            scores.append(float(1 - entropy[best] / rest.min()) if len(rest) else 1.0)
        return langs, scores


@cache
def parser(model: Model) -> Parser:
    return Parser(model)


def identify(df: DataFrame, model: Model, text_col: str = "text", lang_as: str = "lang_pred",
             score_as: str = "score") -> DataFrame:
    """``df`` with the language of each whole text and its score.

    ``und`` with score 0 for a text that is null or has no letter, or if the
    model is empty.  Languages that do equally well go by name, with score 0;
    letters the model has never seen are phrases of their own in every language.
    Nothing but the text is looked at: equal texts get equal answers.  Existing
    columns with the names of the answers are replaced, all others stay.
    """
    require_columns(df, [text_col])
    own = [c for c in df.columns if c.lower() not in (lang_as.lower(), score_as.lower())]
    lent, = fresh(df, "language_text")
    rows = df.select(*own, F.col(text_col).cast("string").alias(lent))
    kept = rows.drop(lent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = parser(model)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            langs, scores, a, size = [], [], 0, 0
            for b, t in enumerate([*texts, None]):
                if b == len(texts) or size > 4 << 20:  # so many characters at once
                    more = table.identify(texts[a:b])
                    langs += more[0]
                    scores += more[1]
                    a, size = b, 0
                size += len(t or "")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names[:-1], lang_as, score_as])

    return rows.mapInArrow(run, T.StructType([
        *kept.schema.fields, T.StructField(lang_as, T.StringType()),
        T.StructField(score_as, T.DoubleType())]))


def held_out(key: Column) -> Column:
    """Documents nothing is learned from: crc32 of the identifier as text is 2
    modulo 4.  A null identifier is not held out."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))
