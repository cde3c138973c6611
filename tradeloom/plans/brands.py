"""Share of each brand or vertical in all cases sold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.measures import cases, percent_of
from tradeloom.operators.calendar import resolve_windows, spanning
from tradeloom.operators.facts import case_factors, counted, scoped_vouchers, sold_units, window_sums
from tradeloom.operators.pricing import brand_vertical
from tradeloom.params import DashboardScope
from tradeloom.sources.model import Model

SHARE = "decimal(10,2)"


def brand_contribution(model: Model, scope: DashboardScope) -> DataFrame:
    """Percent of cases by vertical, or by brand for a restricted user, and a 100 % row."""
    found = resolve_windows(model.calendar, scope.date, ["month", "month_last_year", "year", "last_year"])
    windows = {"mtd": found["month"], "ly_mtd": found["month_last_year"],
               "ytd": found["year"], "ly_ytd": found["last_year"]}
    vouchers = scoped_vouchers(
        model.sales_voucher, model, scope, spanning(found["last_year"], found["year"]).holds()
    ).select("voucher_no", "posted_on", "copies")
    lines = model.sales_line.select("voucher_no", "product_id", sold_units().alias("units"))
    by_product = (
        counted(vouchers.join(lines, "voucher_no"), scope)
        .groupBy("product_id")
        .agg(*window_sums(windows))
    )
    brands = brand_vertical(model).withColumn("segment", F.col("brand_name" if scope.restricted else "vertical"))
    labels = model.product.join(brands, "brand_code").select("product_id", "segment")
    sold = by_product.join(labels, "product_id").join(case_factors(model), "product_id", "left").select(
        "segment", *[cases(F.col(w), F.col("factor")).alias(w) for w in windows]
    )
    # One aggregate gives the segments and, beside them, the row of the whole.
    shares = sold.groupingSets([["segment"], []], "segment").agg(
        F.grouping("segment").alias("whole"), *[F.sum(w).alias(w) for w in windows]
    )
    everything = Window.partitionBy()

    def share(w: str):
        total = F.sum(F.when(F.col("whole") == 0, F.col(w))).over(everything)
        percent = F.coalesce(percent_of(F.col(w), total), F.lit(0)).cast("decimal(38,8)").cast(SHARE)
        return F.when(F.col("whole") == 1, F.lit(100).cast(SHARE)).otherwise(percent).alias(w)

    return (
        shares.select(F.when(F.col("whole") == 1, "Total").otherwise(F.col("segment")).alias("segment"),
                      *[share(w) for w in windows], "whole")
        .orderBy("whole", "segment")
        .drop("whole")
    )
