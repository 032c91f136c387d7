"""Money and percentage expressions (all JVM-side Catalyst expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.util import as_col


def money_round(c: Column | str, scale: int = 2) -> Column:
    """Round half-up in decimal arithmetic and return a double.

    ``round(double, n)`` differs between engines exactly at halves (binary
    doubles such as 1.005 sit just below the half); rounding the value as a
    ``decimal(38,6)`` first is portable and matches printed prices.
    """
    return F.round(as_col(c).cast("decimal(38,6)"), scale).cast("double")


def pct_of(part: Column | str, whole: Column | str, scale: int = 1) -> Column:
    """``round(part * 100.0 / whole, scale)`` as a double (NULL when whole is 0)."""
    return F.round(F.try_divide(as_col(part).cast("double") * F.lit(100.0),
                                as_col(whole).cast("double")), scale)


def card_price(regular: Column | str, multiplier: Column | str,
               discount: Column | str) -> Column:
    """Card price per unit: ``round((r*u - d) / u, 2)`` when a discount exists.

    The discount applies to the whole package (r*u), then is spread back over
    the unit multiplier.  A zero multiplier yields NULL instead of an error.
    """
    r, u, d = as_col(regular), as_col(multiplier), as_col(discount)
    return F.when(d.isNotNull(), money_round(F.try_divide(r * u - d, u)))


def base_discount_pct(regular: Column | str, online: Column | str) -> Column:
    """``floor((r - o) / r * 100)`` for positive regular prices, else NULL."""
    r, o = as_col(regular), as_col(online)
    return F.when(r > 0, F.floor((r - o) / r * 100))


def card_discount_pct(regular: Column | str, multiplier: Column | str,
                      discount: Column | str) -> Column:
    """``floor(d / (r*u) * 100)`` when a discount exists; NULL on a zero base."""
    r, u, d = as_col(regular), as_col(multiplier), as_col(discount)
    return F.when(d.isNotNull(), F.floor(F.try_divide(d, r * u) * 100))
