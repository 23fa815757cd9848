"""US federal holidays as a closed-form predicate on a date column: no dimension table, no join."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (month, day, first year) of holidays moved to the nearest workday.
FIXED_DATE = ((1, 1, 0), (6, 19, 2021), (7, 4, 0), (11, 11, 0), (12, 25, 0))
# Fixed values: (month, weekday with Monday=0, n-th occurrence, first year).
NTH_WEEKDAY = ((1, 0, 3, 1986), (2, 0, 3, 0), (9, 0, 1, 0), (10, 0, 2, 0), (11, 3, 4, 0))
# Fixed values: (month, weekday) of holidays on the last such weekday of the month.
LAST_WEEKDAY = ((5, 0),)


def _observed(day: str, month: int, dom: int, since: int) -> str:
    """On the day itself if a workday, else on the Friday before or the Monday after."""

    def is_date(expr: str) -> str:
        return f"(month({expr}) = {month} AND day({expr}) = {dom} AND year({expr}) >= {since})"

    return (
        f"(weekday({day}) <= 4 AND {is_date(day)})"
        f" OR (weekday({day}) = 4 AND {is_date(f'date_add({day}, 1)')})"
        f" OR (weekday({day}) = 0 AND {is_date(f'date_sub({day}, 1)')})"
    )


def _nth_weekday(day: str, month: int, weekday: int, nth: int, since: int) -> str:
    return (
        f"(month({day}) = {month} AND weekday({day}) = {weekday}"
        f" AND (day({day}) + 6) div 7 = {nth} AND year({day}) >= {since})"
    )


def _last_weekday(day: str, month: int, weekday: int) -> str:
    return (
        f"(month({day}) = {month} AND weekday({day}) = {weekday} AND month(date_add({day}, 7)) <> {month})"
    )


def is_federal_holiday(day: str) -> Column:
    """True where the named date column is an observed US federal holiday."""
    tests = [_observed(day, *rule) for rule in FIXED_DATE]
    tests += [_nth_weekday(day, *rule) for rule in NTH_WEEKDAY]
    tests += [_last_weekday(day, *rule) for rule in LAST_WEEKDAY]
    return F.expr(" OR ".join(tests))


def holiday_flag(day: str) -> Column:
    return F.when(is_federal_holiday(day), 1).otherwise(0)
