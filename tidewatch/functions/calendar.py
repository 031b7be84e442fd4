"""Calendar: holidays, electoral phases, and the date dimension's attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values: (month, day) of national holidays, dates of moveable ones, and the state's own.
FIXED_HOLIDAYS = ((1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (11, 20), (12, 25))
MOVEABLE_HOLIDAYS = ("2024-02-13", "2024-03-29", "2024-05-30", "2025-03-04", "2025-04-18", "2025-06-19", "2026-02-17", "2026-04-03", "2026-06-04", "2027-02-09", "2027-03-26", "2027-05-27")
STATE_HOLIDAYS = ((10, 3),)
#: Last day of each phase of the 2026 cycle.
PHASES = (("2025-12-31", "none"), ("2026-08-15", "pre_campaign"), ("2026-10-04", "campaign"), ("2026-10-25", "runoff"), ("2026-12-31", "post"))


def _on(day: Column, days: tuple[tuple[int, int], ...]) -> Column:
    return (F.month(day) * 100 + F.dayofmonth(day)).isin([m * 100 + d for m, d in days])


def is_national_holiday(day: Column) -> Column:
    return _on(day, FIXED_HOLIDAYS) | day.cast("date").cast("string").isin(*MOVEABLE_HOLIDAYS)


def is_state_holiday(day: Column) -> Column:
    return _on(day, STATE_HOLIDAYS)


def electoral_phase(day: Column) -> Column:
    out = F.lit("none")
    for last, name in reversed(PHASES):
        out = F.when(day.cast("date") <= F.lit(last).cast("date"), F.lit(name)).otherwise(out)
    return out


def week_start(day: Column) -> Column:
    """The Monday of a day's week."""
    return F.date_trunc("week", day).cast("date")
