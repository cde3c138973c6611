"""Voucher headers and lines, filtered and joined once per report.

Headers are filtered by date, profit centre and company before they meet the
lines on the voucher number.  Other dimensions join after pieces are summed
wherever the sum allows it, which also takes hot products out of those joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.measures import units
from tradeloom.operators.calendar import Window
from tradeloom.operators.hierarchy import distributors_in_scope
from tradeloom.params import DashboardScope
from tradeloom.sources.model import Model

# Fixed values.
HOME_CENTRE = "PC007"
CASE_UNIT = "CASE"
SALE, CREDIT_NOTE, PURCHASE, DEBIT_NOTE, OPENING = "TI", "CN", "PI", "DN", "OP"


def case_factors(model: Model) -> DataFrame:
    """product_id and its pieces per case."""
    return model.case_unit.filter(F.col("unit") == CASE_UNIT).select("product_id", "factor")


def scoped_vouchers(vouchers: DataFrame, model: Model, scope: DashboardScope, when: Column) -> DataFrame:
    """Home-centre vouchers of the companies in scope, with ``copies``."""
    chosen = vouchers.filter((F.col("profit_centre") == HOME_CENTRE) & when)
    return chosen.join(distributors_in_scope(model, scope), "distributor_id")


def sold_units() -> Column:
    return units(F.col("qty_out") - F.col("qty_in"))


def bought_units() -> Column:
    return units(F.col("qty_in") - F.col("qty_out"))


def counted(df: DataFrame, scope: DashboardScope) -> DataFrame:
    """``units`` times copies, where the scope can have copies."""
    return df.withColumn("units", F.col("units") * F.col("copies")) if scope.restricted else df


def window_sums(windows: dict[str, Window]) -> list[Column]:
    """Sum of the units posted in each window."""
    return [F.sum(F.when(w.holds(), F.col("units")).otherwise(F.lit(0))).alias(n) for n, w in windows.items()]
