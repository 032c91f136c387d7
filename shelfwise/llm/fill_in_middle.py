"""Fill-in-the-middle texts, cut by one counted-quantifier match.

A unit is a run of letters or any other single character.  ``regexp_count``
gives how many units a text has, two draws from the identifier say after how
many of them the prefix and the middle end, and one pattern made for the row,

    \\A((?:unit){a}+)((?:unit){b-a}+)(.*+)\\z

takes all three parts in a single match of ``regexp_replace``, which writes them
in their new order between the markers.  The groups are possessive: counted
possessive groups are matched in a loop, so a text of any length needs no stack
and nothing is tried twice.  Everything is one projection in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import fresh, require_columns

#: A run of letters, or one other character (a code point).
UNIT = "[A-Za-z]+|[^A-Za-z]"
#: The same for counted groups: no letter run is given up once it is matched.
_HELD = "(?:[A-Za-z]++|[^A-Za-z])"


def draws(id_col: str | Column, seed: int = 1, n: int = 4) -> list[Column]:
    """``n`` (at most 8) unsigned 32-bit numbers from a row's identifier: the
    8-digit groups of the hex SHA-256 of ``seed:identifier`` (a null identifier
    counts as an empty one)."""
    key = (F.col(id_col) if isinstance(id_col, str) else id_col).cast("string")
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key, F.lit(""))), 256)
    return [F.conv(F.substring(hexed, 8 * k + 1, 8), 16, 10).cast("long") for k in range(n)]


def restored(output: Column, form: Column, markers: tuple[str, str, str] = ("<P>", "<S>", "<M>")
             ) -> Column:
    """The text a transformed one was made from.  No marker can arise where a
    part meets a marker, and texts that hold one stay plain, so the markers found
    are those that were written."""
    part = F.split(output, "|".join(markers), -1)
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])) \
        .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
                   rate: int = 90, spm: int = 20,
                   markers: tuple[str, str, str] = ("<P>", "<S>", "<M>"),
                   names: tuple[str, ...] = ("n", "form", "prefix_chars", "middle_chars", "output")
                   ) -> DataFrame:
    """Every row of ``df`` with five columns more, called ``names``: number of
    units, form (``plain``, ``psm`` or ``spm``), code points of prefix and middle
    (null if plain) and the output.

    ``rate`` of 100 texts are transformed, ``spm`` of 100 of those with the suffix
    first.  The middle stands between the smaller and the larger of two cuts
    drawn from 0 to n units, both ends included, so any part may be empty.

    A null text counts as empty; an empty one, and one that holds a marker, stays
    plain.  A null identifier draws as an empty one; rows with the same identifier
    draw alike, repeated rows stay rows of their own.  A very long text needs
    memory for its units while they are counted, some 60 bytes each, and none
    for matching.  An empty table gives an empty table.  Columns of ``df`` that
    are called like one of ``names`` (whatever their case) are replaced.  Markers
    must be three different texts of the shape ``<X>``, X a letter.
    """
    require_columns(df, [id_col, text_col])
    if len(set(markers)) != 3 or any(len(m) != 3 or m[0] + m[2] != "<>" or not m[1].isalpha()
                                     for m in markers):
        raise ValueError(f"markers must be different texts like <P>, not {markers}")
    p, s, m = markers
    own = {x.lower() for x in names}
    kept = [c for c in df.columns if c.lower() not in own]
    h1, h2, h3, h4, text, n, form, output, parts = fresh(
        df, *(f"_{x}" for x in ("h1", "h2", "h3", "h4", "whole", "units", "form", "out", "parts")))

    has_marker = F.contains(text, F.lit(p)) | F.contains(text, F.lit(s)) | F.contains(text, F.lit(m))
    first, second = F.col(h1) % (F.col(n) + 1), F.col(h2) % (F.col(n) + 1)
    a, b = F.least(first, second), F.greatest(first, second)
    pattern = F.concat(F.lit(f"(?s)\\A({_HELD}{{"), a.cast("string"), F.lit(f"}}+)({_HELD}{{"),
                       (b - a).cast("string"), F.lit("}+)(.*+)\\z"))
    order = F.when(F.col(form) == "psm", F.lit(f"{p}$1{s}$3{m}$2")).otherwise(F.lit(f"{s}$3{p}$1{m}$2"))
    plain = F.col(form) == "plain"

    found = df.select("*", F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(text),
                      *[x.alias(name) for x, name in zip(draws(id_col, seed), (h1, h2, h3, h4))])
    found = found.withColumn(n, F.regexp_count(text, F.lit(UNIT)).cast("long"))
    found = found.withColumn(form, F.when((F.col(text) == "") | has_marker | (F.col(h3) % 100 >= rate), "plain")
                             .when(F.col(h4) % 100 < spm, "spm").otherwise("psm"))
    found = found.withColumn(output, F.when(plain, F.col(text)).otherwise(
        F.regexp_replace(F.col(text), pattern, order)))
    found = found.withColumn(parts, F.when(~plain, F.split(output, "|".join(markers), -1)))
    prefix = F.when(F.col(form) == "psm", F.col(parts)[1]).otherwise(F.col(parts)[2])
    return found.select(*kept, *[c.alias(name) for c, name in zip(
        (F.col(n), F.col(form), F.length(prefix).cast("long"), F.length(F.col(parts)[3]).cast("long"),
         F.col(output)), names)])
