"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_id(day: Column) -> Column:
    """``yyyymmdd`` integer key of a date."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_of_id(key: Column) -> Column:
    """The date behind a ``yyyymmdd`` key."""
    return F.to_date(key.cast("string"), "yyyyMMdd")


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text of a UTC timestamp; the fraction is left out when it is zero."""
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(seconds, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""),
                    F.lit("+00:00"))


def calendar_columns(day: Column) -> list[Column]:
    """Attributes of a calendar row.

    ``day_of_week`` is 1 = Sunday; ``iso_dow`` and ``iso_year`` go with the ISO ``week``, whose
    first days may belong to the calendar year before.
    """
    return [
        date_id(day).alias("date_id"),
        day.alias("date"),
        F.dayofweek(day).alias("day_of_week"),
        (F.weekday(day) + 1).alias("iso_dow"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week"),
        F.extract(F.lit("YEAROFWEEK"), day).alias("iso_year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
    ]
