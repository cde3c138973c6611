"""Overall status, and sales by claim type: day, month and rolling three months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.measures import cases, pieces, value_at_piece_rate, whole
from tradeloom.operators.calendar import resolve_windows
from tradeloom.operators.facts import (
    SALE,
    case_factors,
    counted,
    scoped_vouchers,
    sold_units,
    window_sums,
)
from tradeloom.operators.pricing import batch_prices
from tradeloom.params import DashboardScope
from tradeloom.sources.model import Model

# Organisation codes and the label of untyped bills.
WHOLESALE, RETAIL = "123456-4", "111111-1"
NORMAL_BILLS = "Normal Bills"
WINDOW_NAMES = {"day": "day", "month": "month", "qtd": "three_months"}


def _windows(model: Model, scope: DashboardScope) -> dict:
    found = resolve_windows(model.calendar, scope.date, list(WINDOW_NAMES.values()))
    return {short: found[name] for short, name in WINDOW_NAMES.items()}


def overall_status(model: Model, scope: DashboardScope) -> DataFrame:
    """Seven rows: bills, products, cases, wholesale and retail parties and their cases.

    One pass over the vouchers.  A distinct count in several windows is taken by
    marking each bill, product or party with the windows it occurs in, then
    counting the marks, so no row is repeated per window.
    """
    windows = _windows(model, scope)
    vouchers = scoped_vouchers(model.sales_voucher, model, scope, windows["qtd"].holds()).select(
        "voucher_no", "posted_on", "copies", F.coalesce("billed_to", "party_id").alias("account_id")
    )
    lines = model.sales_line.select("voucher_no", "product_id", sold_units().alias("units"))
    sold = (
        counted(vouchers.join(lines, "voucher_no"), scope)
        .join(case_factors(model), "product_id", "left")
    )
    marks = [F.max(w.holds().cast("int")).alias(f"in_{name}") for name, w in windows.items()]
    things = sold.groupingSets(
        [["voucher_no"], ["product_id"], ["account_id", "factor"]],
        "voucher_no", "product_id", "account_id", "factor",
    ).agg(
        F.when(F.grouping("voucher_no") == 0, "bill").when(F.grouping("product_id") == 0, "product")
        .otherwise("party").alias("kind"),
        *marks,
        *window_sums(windows),
    )
    # Bills and products shrink to one row each; parties keep theirs.
    per_party = things.groupBy("kind", "account_id").agg(
        *[F.sum(f"in_{n}").alias(f"count_{n}") for n in windows],
        *[F.max(f"in_{n}").alias(f"in_{n}") for n in windows],
        *[F.sum(cases(F.col(n), F.col("factor"))).alias(n) for n in windows],
    )
    # How often an account is listed as a wholesaler and as a retailer.
    outlets = (
        model.account.filter(F.col("org_code").isin(WHOLESALE, RETAIL))
        .select("account_id", "org_code")
        .join(model.org_type.select("org_code"), "org_code")
        .groupBy("account_id")
        .agg(F.count_if(F.col("org_code") == WHOLESALE).cast("int").alias("wholesale"),
             F.count_if(F.col("org_code") == RETAIL).cast("int").alias("retail"))
    )
    rated = per_party.join(outlets, "account_id", "left")

    def count_of(kind: str, n: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(f"count_{n}"))), F.lit(0))

    def parties(role: str, n: str) -> Column:
        return F.count_if((F.col("kind") == "party") & (F.col(role) > 0) & (F.col(f"in_{n}") == 1))

    def cases_of(role: str, n: str) -> Column:
        listed = (F.col("kind") == "party") & (F.col(role) > 0)
        return F.sum(F.when(listed, F.col(n) * F.col(role)))

    # The labels; wholesale and retail cases carry the same one.
    figures = {
        "bills": ("Bill No.", lambda n: count_of("bill", n)),
        "products": ("SKU No.", lambda n: count_of("product", n)),
        "cases": ("Quantity(Case)", lambda n: F.sum(F.when(F.col("kind") == "party", F.col(n)))),
        "wholesalers": ("WS no(Unique Party)", lambda n: parties("wholesale", n)),
        "retailers": ("Retail no(Unique)", lambda n: parties("retail", n)),
        "wholesale_cases": ("WS qty(Case)", lambda n: cases_of("wholesale", n)),
        "retail_cases": ("WS qty(Case)", lambda n: cases_of("retail", n)),
    }
    totals = rated.agg(*[
        F.struct(F.lit(label).alias("items"), *[whole(figure(n)).alias(n) for n in windows]).alias(name)
        for name, (label, figure) in figures.items()
    ])
    return totals.select(F.inline(F.array(*figures)))


def typed_vouchers(model: Model, vouchers: DataFrame) -> DataFrame:
    """Vouchers with ``type_code``, NULL for a bill without a known claim type."""
    known = model.claim_type.select(F.col("type_code").alias("claim_type"), "type_code")
    tags = model.claim_tag.join(known, "claim_type", "left").select("voucher_no", "type_code")
    return vouchers.join(tags, "voucher_no", "left")


def claim_sales(model: Model, scope: DashboardScope) -> DataFrame:
    """Bills, cases and amount per claim type, ordinary bills first, and a total."""
    windows = _windows(model, scope)
    vouchers = scoped_vouchers(model.sales_voucher, model, scope, windows["qtd"].holds()).select(
        "voucher_no", "posted_on", "voucher_type", "copies"
    )
    lines = model.sales_line.select("voucher_no", "product_id", "batch", sold_units().alias("units"))
    prices = batch_prices(model).join(case_factors(model), "product_id", "left").select(
        "product_id", "batch", "complementary_rate", "factor"
    )
    sold = (
        counted(typed_vouchers(model, vouchers).join(lines, "voucher_no"), scope)
        .join(prices, ["product_id", "batch"])
        .withColumn("value", pieces(F.col("units")).cast("decimal(18,4)") * F.col("complementary_rate"))
    )
    billed = F.col("voucher_type") == SALE
    by_bill = (
        sold.groupBy("type_code", "voucher_no", "factor")
        .agg(
            *[F.max((w.holds() & billed).cast("int")).alias(f"bill_{n}") for n, w in windows.items()],
            *window_sums(windows),
            *[F.sum(F.when(w.holds(), F.col("value")).otherwise(F.lit(0))).alias(f"value_{n}")
              for n, w in windows.items()],
        )
        .groupBy("type_code", "voucher_no")
        .agg(
            *[F.max(f"bill_{n}").alias(f"bill_{n}") for n in windows],
            *[F.sum(cases(F.col(n), F.col("factor"))).alias(f"cases_{n}") for n in windows],
            *[F.sum(value_at_piece_rate(F.col(f"value_{n}"), F.col("factor"))).alias(f"amount_{n}") for n in windows],
        )
    )
    measures = [f"{m}_{n}" for m in ("bill", "cases", "amount") for n in windows]
    by_type = by_bill.groupBy("type_code").agg(*[F.sum(m).alias(m) for m in measures])
    ordinary = F.col("type_code").isNull()
    listed = by_type.select(
        F.coalesce("type_code", F.lit(NORMAL_BILLS)).alias("category"), *measures,
        F.when(ordinary, 0).otherwise(1).alias("section"),
    )
    total = by_type.agg(*[F.sum(m).alias(m) for m in measures]).select(
        F.lit("TOTAL").alias("category"), *measures, F.lit(2).alias("section")
    )
    return (
        listed.unionByName(total)
        .orderBy("section", "category")
        .select(
            "category",
            *[F.col(f"bill_{n}").alias(f"bill_cut_{n}") for n in windows],
            *[whole(F.col(f"cases_{n}")).alias(f"cases_{n}") for n in windows],
            *[whole(F.col(f"amount_{n}")).alias(f"total_amount_{n}") for n in windows],
        )
    )


def distinct_bills(model: Model, scope: DashboardScope) -> DataFrame:
    """Distinct sale bills per claim type in the three windows."""
    return claim_sales(model, scope).filter(F.col("category") != "TOTAL").select(
        "category", "bill_cut_day", "bill_cut_month", "bill_cut_qtd"
    )
