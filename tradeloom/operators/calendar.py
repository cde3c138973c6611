"""Windows of the local calendar.

The calendar is data: one row per day with local year, month and day.  A window
is the first and last day of some local period relative to an anchor day.
``window_bounds`` computes windows lazily; ``resolve`` fetches that one row, so
that reports filter their vouchers with literal dates, which reach the Parquet
scan and prune date partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.filters import between


@dataclass(frozen=True)
class Window:
    first: dt.date | None
    last: dt.date | None

    def holds(self, column: str = "posted_on") -> Column:
        return between(column, self.first, self.last)


def anchored(calendar: DataFrame, date: dt.date) -> DataFrame:
    """The calendar with the anchor's local date beside every day.

    The anchor's local date is unknown if the calendar lacks ``date``.
    """
    anchor = calendar.filter(F.col("day") == F.lit(date)).agg(
        F.max("local_year").alias("year"), F.max("local_month").alias("month"), F.max("local_day").alias("day")
    )
    return calendar.select(
        "day", "local_year", "local_month", "local_day",
        *[anchor.select(c).scalar().alias(f"anchor_{c}") for c in ("year", "month", "day")],
    )


_MONTH_NO = "(local_year * 12 + local_month)"
_ANCHOR_MONTH_NO = "(anchor_year * 12 + anchor_month)"

# Which days belong to a window, by the window's name.
WINDOWS = {
    "day": f"{_MONTH_NO} = {_ANCHOR_MONTH_NO} AND local_day = anchor_day",
    "month": f"{_MONTH_NO} = {_ANCHOR_MONTH_NO}",
    "month_last_year": f"{_MONTH_NO} = {_ANCHOR_MONTH_NO} - 12",
    # The month before the anchor's, taken from last year; before month 1 comes
    # month 12 of that same last year.
    "previous_month_last_year":
        "local_year = anchor_year - 1 AND local_month = CASE WHEN anchor_month > 1 THEN anchor_month - 1 ELSE 12 END",
    "year": "local_year = anchor_year",
    "last_year": "local_year = anchor_year - 1",
    "three_months": f"{_MONTH_NO} BETWEEN {_ANCHOR_MONTH_NO} - 2 AND {_ANCHOR_MONTH_NO}",
}

# Names of the fiscal months in order, from local month 9 of one
# year to local month 8 of the next.
FISCAL_MONTHS = ("poush", "magh", "falgun", "chaitra", "baishak", "jestha", "ashad", "shrawan", "bhadra",
                 "asoj", "kartik", "mangsir")
FIRST_FISCAL_MONTH = 9


def window_bounds(calendar: DataFrame, date: dt.date, names: list[str]) -> DataFrame:
    """One row per window, in one pass over the calendar: window, first, last."""
    bounds = []
    for name in names:
        days = F.when(F.expr(WINDOWS[name]), F.col("day"))
        bounds.append(F.struct(
            F.lit(name).alias("window"), F.min(days).alias("first"), F.max(days).alias("last")
        ))
    return anchored(calendar, date).agg(F.array(*bounds).alias("w")).select(F.inline("w"))


def fiscal_grid(calendar: DataFrame, date: dt.date) -> DataFrame:
    """Twelve rows: ordinal, month name, first and last day of each fiscal month.

    A fiscal month the calendar lacks keeps its row, without days.
    """
    start = F.expr(
        f"(anchor_year - CASE WHEN anchor_month < {FIRST_FISCAL_MONTH} THEN 1 ELSE 0 END) * 12 + {FIRST_FISCAL_MONTH}"
    )
    days = anchored(calendar, date).select("day", (F.expr(_MONTH_NO) - start).alias("offset"))
    bounds = []
    for offset, name in enumerate(FISCAL_MONTHS):
        inside = F.when(F.col("offset") == offset, F.col("day"))
        bounds.append(F.struct(
            F.lit(offset + 1).alias("ordinal"), F.lit(name).alias("window"),
            F.min(inside).alias("first"), F.max(inside).alias("last"),
        ))
    return days.agg(F.array(*bounds).alias("w")).select(F.inline("w"))


def resolve(bounds: DataFrame) -> Mapping[str, Window]:
    """Fetch the handful of window bounds as plain dates."""
    return {r["window"]: Window(r["first"], r["last"]) for r in bounds.select("window", "first", "last").collect()}


def resolve_windows(calendar: DataFrame, date: dt.date, names: list[str]) -> Mapping[str, Window]:
    return resolve(window_bounds(calendar, date, names))


def spanning(first: Window, last: Window) -> Window:
    """From the start of one window to the end of another."""
    return Window(first.first, last.last)
