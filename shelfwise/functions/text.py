"""Text functions: trimming, accent folding, slugs and the bundle pattern.

Column functions are built from Catalyst string expressions (``translate``,
``regexp_replace``, ``upper``...) so they run inside whole-stage codegen.
``normalize_key`` is the one driver-side function: it renames *schema fields*
(metadata), never row values.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.functions.util import as_col


def clean_upper(c: Column | str) -> Column:
    """``upper(trim(x))``."""
    return F.upper(F.trim(as_col(c)))


def _ascii_form(ch: str) -> str:
    """ASCII part of a character's compatibility decomposition."""
    return unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")


@cache
def _ascii_forms() -> tuple[str, str, dict[str, str]]:
    """All characters beyond ASCII that have an ASCII form: those with a form of
    one character (and these forms), and those with a longer one."""
    single, forms, longer = [], [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if not 0xD800 <= cp < 0xE000:
            form = _ascii_form(chr(cp))
            if len(form) == 1:
                single.append(chr(cp))
                forms.append(form)
            elif form:
                longer[chr(cp)] = form
    return "".join(single), "".join(forms), longer


def _ranges(chars) -> str:
    """A regular expression's class of characters, runs of neighbours as ranges."""
    runs: list[list[int]] = []
    for cp in sorted(map(ord, chars)):
        if runs and runs[-1][1] == cp - 1:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    return "[" + "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in runs) + "]"


def fold_accents(c: Column | str) -> Column:
    """Replace characters by their ASCII form (``é`` → ``e``, ``º`` → ``o``, ``ﬁ`` →
    ``fi``); characters without one stay."""
    single, forms, longer = _ascii_forms()
    c = as_col(c)
    # Texts of ASCII alone, nearly all, are left as they are after one look, and of the
    # rest only those that hold a character with a longer form are taken apart.
    table = F.create_map(*[F.lit(x) for pair in longer.items() for x in pair])
    spelled = F.array_join(F.transform(F.split(c, ""), lambda ch: F.coalesce(
        F.try_element_at(table, ch), ch)), "")
    rare = c.rlike(_ranges(longer))
    folded = F.translate(F.when(rare, spelled).otherwise(c), single, forms)
    return F.when(c.rlike(r"[^\x00-\x7F]"), folded).otherwise(c)


def slugify(c: Column | str) -> Column:
    """Column form of ``normalize_key``: characters in their ASCII form, others
    beyond ASCII dropped, each run of anything but ASCII letters and digits one
    ``_``, none at the ends, lower case."""
    s = F.regexp_replace(fold_accents(c), r"[^\x00-\x7F]", "")
    s = F.regexp_replace(s, r"[^a-zA-Z0-9]+", "_")
    return F.btrim(F.lower(s), F.lit("_"))


def bundle_pattern(words: list[str] | None = None) -> str:
    """Unanchored, Unicode case-insensitive alternation of bundle words.

    ``(?iu)`` rather than ``(?i)``: on the JVM ``(?i)`` folds ASCII only, so
    ``LLÉVATE`` would escape a plain ``(?i)llévate``.
    """
    return "(?iu)" + "|".join(words or K.BUNDLE_WORDS)


def is_bundle_name(c: Column | str, words: list[str] | None = None) -> Column:
    return as_col(c).rlike(bundle_pattern(words))


def is_yes(c: Column | str) -> Column:
    """True when the value is "Si" with or without the accent."""
    return F.trim(as_col(c)).isin("Si", "Sí")


# --- schema (driver metadata) -----------------------------------------------

def normalize_key(name: str, overrides: dict[str, str] | None = None) -> str:
    """Normal form of a raw landing key: its words of ASCII letters and digits,
    in lower case, joined by ``_``.  An entry of ``overrides`` goes first."""
    fixed = (K.KEY_OVERRIDES if overrides is None else overrides).get(name)
    if fixed is not None:
        return fixed
    words = "".join(c if c.isalnum() else " " for c in _ascii_form(name)).split()
    return "_".join(words).lower()
