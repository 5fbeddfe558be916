"""National holidays and commercial dates as a generated dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Federal holidays by month and day.
FIXED = [
    ("Universal Fraternization Day", 1, 1),
    ("Tiradentes' Day", 4, 21),
    ("Worker's Day", 5, 1),
    ("Independence Day", 9, 7),
    ("Our Lady of Aparecida", 10, 12),
    ("All Souls' Day", 11, 2),
    ("Republic Proclamation Day", 11, 15),
    ("Christmas Day", 12, 25),
]
# Days after Easter Sunday.
MOVABLE = [("Good Friday", -2), ("Corpus Christi", 60)]


def easter(year: Column) -> Column:
    """Easter Sunday (Gregorian calendar, anonymous algorithm of 1876)."""
    div = lambda a, b: F.floor(a / F.lit(b)).cast("int")
    golden, century, rest = year % 19, div(year, 100), year % 100
    leap = div(century, 4)
    moon = (19 * golden + century - leap - div(century - div(century + 8, 25) + 1, 3) + 15) % 30
    weekday = (32 + 2 * (century % 4) + 2 * div(rest, 4) - moon - rest % 4) % 7
    shift = moon + weekday - 7 * div(golden + 11 * moon + 22 * weekday, 451) + 114
    return F.make_date(year, div(shift, 31), shift % 31 + 1)


def nth_weekday(year: Column, month: int, weekday: str, nth: int) -> Column:
    """n-th given weekday of a month ('Sun', 'Fri', …)."""
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), weekday), 7 * (nth - 1))


def holiday_calendar(span: DataFrame) -> DataFrame:
    """(day, holiday, kind) for every year touched by a one-row span."""
    years = span.select(F.explode(F.sequence(F.year("first_day"), F.year("last_day"))).alias("year"))
    y = F.col("year")
    entry = lambda name, kind, day: F.struct(day.alias("day"), F.lit(name).alias("holiday"), F.lit(kind).alias("kind"))
    entries = [entry(n, "FEDERAL", F.make_date(y, F.lit(m), F.lit(d))) for n, m, d in FIXED]
    entries += [entry(n, "FEDERAL", F.date_add(easter(y), shift)) for n, shift in MOVABLE]
    entries += [
        entry("Mother's Day", "COMMERCIAL", nth_weekday(y, 5, "Sun", 2)),
        entry("Lovers' Day", "COMMERCIAL", F.make_date(y, F.lit(6), F.lit(12))),
        entry("Father's Day", "COMMERCIAL", nth_weekday(y, 8, "Sun", 2)),
        # the Friday after the fourth Thursday of November
        entry("Black Friday", "COMMERCIAL", F.date_add(nth_weekday(y, 11, "Thu", 4), 1)),
    ]
    return years.select(F.inline(F.array(*entries)))
