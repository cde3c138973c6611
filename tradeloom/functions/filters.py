"""Filters from report parameters; a wildcard adds no filter at all."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.params import ALL, HEAD_OFFICE, code, code_list


def equal_to(df: DataFrame, column: str, value: str) -> DataFrame:
    return df if value.strip() == ALL else df.filter(F.col(column) == code(value))


def in_list(df: DataFrame, column: str, value: str) -> DataFrame:
    members = code_list(value)
    return df if members is None else df.filter(F.col(column).isin(members))


def outside_head_office(df: DataFrame, column: str, value: str) -> DataFrame:
    """One company, or every company but the head office."""
    if value.strip() == ALL:
        return df.filter(F.col(column) != HEAD_OFFICE)
    return df.filter(F.col(column) == code(value))


def between(column: str, first: dt.date | None, last: dt.date | None) -> Column:
    """Both ends included; an unknown end makes the test unknown."""
    return F.col(column).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
