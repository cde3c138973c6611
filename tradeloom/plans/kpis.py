"""Bought and sold cases against an earlier period, and the month grid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.measures import cases, percent_of, pieces, value_in_cases, whole
from tradeloom.operators.calendar import (
    FISCAL_MONTHS,
    Window,
    fiscal_grid,
    resolve,
    resolve_windows,
    spanning,
)
from tradeloom.operators.facts import (
    CREDIT_NOTE,
    DEBIT_NOTE,
    PURCHASE,
    SALE,
    bought_units,
    case_factors,
    counted,
    scoped_vouchers,
    sold_units,
)
from tradeloom.params import DashboardScope
from tradeloom.sources.model import Model


def primary_secondary(model: Model, scope: DashboardScope) -> DataFrame:
    """Four rows: purchases and sales in cases, each against two earlier periods.

    "LM" compares the month with the previous month of last year; "LY" compares
    the whole year with the same month of last year.
    """
    found = resolve_windows(
        model.calendar, scope.date, ["month", "previous_month_last_year", "year", "month_last_year"]
    )
    month, old_month = found["month"], found["previous_month_last_year"]
    year, old_year = found["year"], found["month_last_year"]
    # Which vouchers a comparison looks at; without any, its figures are unknown.
    seen = {"LM": old_month.holds() | month.holds(), "LY": spanning(old_year, year).holds()}
    compared = {"LM": (month, old_month), "LY": (year, old_year)}

    def comparison(label: str, vouchers: DataFrame, lines: DataFrame, units: Column) -> DataFrame:
        headers = scoped_vouchers(vouchers, model, scope, seen["LM"] | seen["LY"]).select(
            "voucher_no", "posted_on", "copies"
        )
        sums = []
        for period, (current, old) in compared.items():
            for side, window in (("now", current), ("old", old)):
                inside = F.when(window.holds(), F.col("units")).otherwise(F.lit(0))
                sums.append(F.sum(F.when(seen[period], inside)).alias(f"{side}_{period}"))
        totals = (
            counted(headers.join(lines.select("voucher_no", "product_id", units.alias("units")), "voucher_no"), scope)
            .groupBy("product_id")
            .agg(*sums)
            .join(case_factors(model), "product_id", "left")
            .agg(*[
                F.sum(cases(F.col(f"{side}_{period}"), F.col("factor"))).alias(f"{side}_{period}")
                for period in compared for side in ("now", "old")
            ])
        )
        return totals.select(F.inline(F.array(*[
            F.struct(
                F.lit(f"{label} in Cases {period}").alias("identifier"),
                F.col(f"now_{period}").alias("now"), F.col(f"old_{period}").alias("old"),
            )
            for period in compared
        ])))

    rows = comparison("Primary", model.purchase_voucher, model.purchase_line, bought_units()).unionByName(
        comparison("Secondary", model.sales_voucher, model.sales_line, sold_units())
    )
    return rows.select(
        "identifier",
        whole(F.col("now")).alias("currents"),
        whole(F.col("old")).alias("old"),
        whole(F.coalesce(percent_of(F.col("now"), F.col("old")), F.lit(0))).alias("achievement_percent"),
    )


def month_grid(model: Model, scope: DashboardScope) -> DataFrame:
    """Cases and value bought and sold in each month of the fiscal year."""
    months = resolve(fiscal_grid(model.calendar, scope.date))
    span = Window(months[FISCAL_MONTHS[0]].first, months[FISCAL_MONTHS[-1]].last)
    traded = F.col("voucher_type").isin(SALE, CREDIT_NOTE, PURCHASE, DEBIT_NOTE)
    month = reduce(
        lambda chain, name: chain.when(months[name].holds(), name), FISCAL_MONTHS[1:],
        F.when(months[FISCAL_MONTHS[0]].holds(), FISCAL_MONTHS[0]),
    )
    headers = scoped_vouchers(model.ledger_voucher, model, scope, traded & span.holds()).select(
        "voucher_no", month.alias("month"), "copies"
    )
    # Prices are looked up by price id alone here.
    prices = model.price_batch.select("product_id", "batch", "price_id").join(
        model.price.select("price_id", "selling_price"), "price_id", "left"
    ).select("product_id", "batch", "selling_price")

    def grid(label: str, lines: DataFrame, units: Column) -> DataFrame:
        by_month = (
            counted(
                headers.join(lines.select("voucher_no", "product_id", "batch", units.alias("units")), "voucher_no"), scope
            )
            .groupBy("month", "product_id", "batch")
            .agg(F.sum("units").alias("units"))
            .join(case_factors(model), "product_id", "left")
            .join(prices, ["product_id", "batch"], "left")
            .select(
                "month",
                cases(F.col("units"), F.col("factor")).alias("cases"),
                value_in_cases(
                    pieces(F.col("units")).cast("decimal(18,4)") * F.col("selling_price"), F.col("factor")
                ).alias("value"),
            )
            .groupBy("month")
            .agg(F.sum("cases").alias("cases"), F.sum("value").alias("value"))
        )

        def spread(measure: str) -> list[Column]:
            # A month without vouchers is 0, unless no voucher at all has the measure.
            known = F.when(F.col(measure).isNotNull(), F.lit(0))
            return [
                F.sum(F.when(F.col("month") == m, F.col(measure)).otherwise(known)).alias(m) for m in FISCAL_MONTHS
            ]

        wide = by_month.agg(
            F.struct(F.lit(label).alias("items"), *spread("cases")).alias("c"),
            F.struct(F.lit(f"{label} Value").alias("items"), *spread("value")).alias("v"),
        )
        return wide.select(F.inline(F.array("c", "v")))

    rows = grid("Primary", model.purchase_line, bought_units()).unionByName(
        grid("Secondary", model.sales_line, sold_units())
    )
    return rows.select("items", *[whole(F.col(m)).alias(m) for m in FISCAL_MONTHS])
