"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.util import as_col


def calendar_columns(d: Column | str) -> dict[str, Column]:
    """Day, month (number and English name), quarter, year, weekday name, weekend.

    Weekday numbering is Spark's (Sunday = 1), so the weekend is 1 or 7.
    """
    c = as_col(d)
    return {
        "dia": F.dayofmonth(c),
        "mes": F.month(c),
        "nombre_mes": F.date_format(c, "MMMM"),
        "trimestre": F.quarter(c),
        "anio": F.year(c),
        "dia_semana": F.date_format(c, "EEEE"),
        "es_fin_de_semana": F.dayofweek(c).isin(1, 7),
    }


def batch_id_of(ts: Column | str) -> Column:
    """ISO batch id (``yyyy-MM-dd``) of a timestamp or date."""
    return F.date_format(as_col(ts), "yyyy-MM-dd")


def parse_batch_date(c: Column | str) -> Column:
    """Batch id or release date to DATE; malformed text gives NULL, not an error."""
    return F.try_to_date(as_col(c))


def today_batch_id(tz: str, at: Column | None = None) -> Column:
    """Batch id of the local date in a time zone (``yyyy-MM-dd``), now or ``at`` an
    instant."""
    now = F.current_timestamp() if at is None else at
    return F.date_format(F.from_utc_timestamp(now, tz), "yyyy-MM-dd")
