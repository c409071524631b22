"""US public holidays as an expression over a date: no lookup table, no join, any year.

Fixed-date holidays are also observed: on Friday when they fall on a Saturday, on Monday
when they fall on a Sunday. New Year's Day can so be observed in the year before. The
rules hold from 1978 on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------
# name: (month and day as a number, first year)
FIXED_DATES = {
    "New Year's Day": (101, 1978),
    "Juneteenth National Independence Day": (619, 2021),
    "Independence Day": (704, 1978),
    "Veterans Day": (1111, 1978),
    "Christmas Day": (1225, 1978),
}
# name: (weekday with Monday 0, earliest and latest month and day, first year)
WEEKDAY_RULES = {
    "Martin Luther King Jr. Day": (0, 115, 121, 1986),
    "Washington's Birthday": (0, 215, 221, 1978),
    "Memorial Day": (0, 525, 531, 1978),
    "Labor Day": (0, 901, 907, 1978),
    "Columbus Day": (0, 1008, 1014, 1978),
    "Thanksgiving Day": (3, 1122, 1128, 1978),
}
# ---- end of fixed values ------------------------------------------------------------

HOLIDAY_NAMES = (
    *FIXED_DATES,
    *(f"{name} (observed)" for name in FIXED_DATES),
    *WEEKDAY_RULES,
)


def _month_day(day: Column) -> Column:
    return F.month(day) * 100 + F.dayofmonth(day)


def _conditions(day: Column) -> dict[str, Column]:
    """Holiday name to the condition under which ``day`` is that holiday."""
    weekday = F.weekday(day)
    before, after = F.date_sub(day, 1), F.date_add(day, 1)
    rules: dict[str, Column] = {}
    for name, (month_day, since) in FIXED_DATES.items():
        rules[name] = (_month_day(day) == month_day) & (F.year(day) >= since)
        friday = (weekday == 4) & (_month_day(after) == month_day) & (F.year(after) >= since)
        monday = (weekday == 0) & (_month_day(before) == month_day) & (F.year(before) >= since)
        rules[f"{name} (observed)"] = friday | monday
    for name, (on, first, last, since) in WEEKDAY_RULES.items():
        rules[name] = (
            (weekday == on) & _month_day(day).between(first, last) & (F.year(day) >= since)
        )
    return rules


def holiday_index(day: Column) -> Column:
    """Position of the day's holiday in ``HOLIDAY_NAMES`` (from 0), null on other days."""
    rules = _conditions(day)
    return F.coalesce(*(F.when(rules[name], i) for i, name in enumerate(HOLIDAY_NAMES)))


def holiday_name(day: Column) -> Column:
    rules = _conditions(day)
    return F.coalesce(*(F.when(rules[name], F.lit(name)) for name in HOLIDAY_NAMES))


def is_holiday(day: Column) -> Column:
    """1 on a holiday, else 0."""
    rules = _conditions(day)
    found = rules[HOLIDAY_NAMES[0]]
    for name in HOLIDAY_NAMES[1:]:
        found = found | rules[name]
    return F.when(found, 1).otherwise(0)
