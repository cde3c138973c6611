"""The ten parties and the ten products with the most cases this year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.filters import in_list
from tradeloom.functions.measures import SETTLED, cases, whole
from tradeloom.operators.calendar import resolve_windows, spanning
from tradeloom.operators.facts import case_factors, counted, scoped_vouchers, sold_units, window_sums
from tradeloom.params import ALL, DashboardScope
from tradeloom.sources.model import Model

TOP = 10


def _windows(model: Model, scope: DashboardScope, last_month: str) -> tuple[dict, object]:
    found = resolve_windows(model.calendar, scope.date, ["month", last_month, "year", "last_year"])
    named = {"mtd": found["month"], "ly_mtd": found[last_month], "ytd": found["year"], "ly_ytd": found["last_year"]}
    return named, spanning(found["last_year"], found["year"])


def _top(sums: DataFrame, label: str, windows: list[str]) -> DataFrame:
    """The ten labels with the largest year figure; equal figures go by label."""
    return (
        sums.groupBy(label)
        .agg(*[F.sum(w).alias(w) for w in windows])
        .orderBy(F.col("ytd").cast(SETTLED).desc(), F.col(label).asc_nulls_first())
        .limit(TOP)
        .select(label, *[whole(F.col(w)).alias(w) for w in windows])
    )


def top_parties(model: Model, scope: DashboardScope, mcode: str = ALL) -> DataFrame:
    """Cases per party, named with its tax number; parties without one share a row."""
    windows, span = _windows(model, scope, "month_last_year")
    vouchers = scoped_vouchers(model.sales_voucher, model, scope, span.holds()).select(
        "voucher_no", "posted_on", "copies", F.coalesce("billed_to", "party_id").alias("account_id")
    )
    products = model.product.select("product_id").join(case_factors(model), "product_id", "left")
    lines = in_list(model.sales_line, "product_id", mcode).select(
        "voucher_no", "product_id", sold_units().alias("units")
    )
    by_party = (
        counted(vouchers.join(lines, "voucher_no"), scope)
        .join(products, "product_id")
        .groupBy("account_id", "factor")
        .agg(*window_sums(windows))
        .groupBy("account_id")
        .agg(*[F.sum(cases(F.col(w), F.col("factor"))).alias(w) for w in windows])
    )
    name = F.concat("account_name", F.lit(" ("), "tax_no", F.lit(")"))
    named = by_party.join(model.account.select("account_id", name.alias("party")), "account_id")
    return _top(named, "party", list(windows))


def top_skus(model: Model, scope: DashboardScope) -> DataFrame:
    """Cases per product name."""
    windows, span = _windows(model, scope, "previous_month_last_year")
    vouchers = scoped_vouchers(model.sales_voucher, model, scope, span.holds()).select(
        "voucher_no", "posted_on", "copies"
    )
    lines = model.sales_line.select("voucher_no", "product_id", sold_units().alias("units"))
    by_product = (
        counted(vouchers.join(lines, "voucher_no"), scope)
        .groupBy("product_id")
        .agg(*window_sums(windows))
    )
    products = model.product.select("product_id", F.col("product_name").alias("sku")).join(
        case_factors(model), "product_id", "left"
    )
    named = by_product.join(products, "product_id").select(
        "sku", *[cases(F.col(w), F.col("factor")).alias(w) for w in windows]
    )
    return _top(named, "sku", list(windows))
