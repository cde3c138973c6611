"""Stock movement in cases: opening, purchases, sales by claim type, closing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.filters import between, equal_to, in_list
from tradeloom.functions.measures import MONEY, cases_or_none, pieces
from tradeloom.operators.facts import (
    CREDIT_NOTE,
    DEBIT_NOTE,
    OPENING,
    PURCHASE,
    SALE,
    bought_units,
    case_factors,
)
from tradeloom.operators.pricing import supplied_products
from tradeloom.params import StockRequest
from tradeloom.report import Report, date_range
from tradeloom.sources.model import Model

# Claim types with a sales column of their own, in report order.
OWN_COLUMN = ("PP", "OP", "NEV", "AC", "BC", "TVB", "TEX")
BUCKETS = ("opening", "purchase", "sales", *[t.lower() for t in OWN_COLUMN], "closing")


def _units_moved(model: Model, request: StockRequest) -> DataFrame:
    """Units per company, product and batch, in one pass over the ledger.

    ``sales`` are sales of no type with an own column; ``total_sales`` are all.
    """
    vouchers = equal_to(model.ledger_voucher, "profit_centre", request.pcl).filter(
        (F.col("posted_on") <= F.lit(request.date2)) & (F.col("fiscal_year") == request.phiscalid.strip().upper())
    )
    vouchers = in_list(vouchers, "distributor_id", request.companyid).select(
        "voucher_no", "distributor_id", "posted_on", "voucher_type"
    )
    keys = ["voucher_no", "distributor_id"]
    typed = vouchers.join(model.claim_tag.select(*keys, "claim_type"), keys, "left")
    lines = model.ledger_line.select(*keys, "product_id", "batch", bought_units().alias("came_in"))
    came_in = F.col("came_in")
    in_range = between("posted_on", request.date1, request.date2)
    bought = in_range & F.col("voucher_type").isin(PURCHASE, DEBIT_NOTE)
    sold = in_range & F.col("voucher_type").isin(SALE, CREDIT_NOTE)
    kind = F.coalesce("claim_type", F.lit(""))

    def bucket(name: str, condition: Column, units: Column) -> Column:
        return F.sum(F.when(condition, units).otherwise(F.lit(0))).alias(name)

    moved = typed.join(lines, keys).groupBy("distributor_id", "product_id", "batch").agg(
        bucket("opening", (F.col("voucher_type") == OPENING) | (F.col("posted_on") < F.lit(request.date1)), came_in),
        bucket("purchase", bought, came_in),
        *[bucket(t.lower(), sold & (kind == t), -came_in) for t in OWN_COLUMN],
        bucket("sales", sold & ~kind.isin(*OWN_COLUMN), -came_in),
        bucket("total_sales", sold, -came_in),
        F.sum(came_in).alias("closing"),
    )
    return moved.join(model.product.select("product_id"), "product_id")


def stock_movement(model: Model, request: StockRequest) -> DataFrame:
    """Pieces per company, product and batch in each bucket."""
    moved = _units_moved(model, request)
    keys = ("distributor_id", "product_id", "batch")
    return moved.select(
        *keys, *[pieces(F.col(b)).cast("decimal(28,4)").alias(b) for b in moved.columns if b not in keys]
    )


def _stock_cases(model: Model, request: StockRequest) -> DataFrame:
    """Cases per product and distributor; batches without a price are left out."""
    # A company listed as a customer under several accounts counts once for each.
    accounts = model.account.filter(F.col("customer_id").isNotNull()).groupBy(
        F.col("customer_id").alias("distributor_id")
    ).agg(F.count("*").cast("int").alias("listings"))
    priced = model.price_batch.groupBy("product_id", "batch").agg(F.count("*").cast("int").alias("prices"))
    listed = model.distributor.select("distributor_id", F.col("distributor_id").alias("distributor_code"))
    times = (F.coalesce("listings", F.lit(1)) * F.col("prices")).cast("bigint")
    by_product = (
        _units_moved(model, request)
        .join(priced, ["product_id", "batch"])
        .join(accounts, "distributor_id", "left")
        .join(listed, "distributor_id", "left")
        .groupBy("product_id", "distributor_code")
        .agg(*[F.sum(F.col(b) * times).alias(b) for b in BUCKETS])
    )
    products = (
        equal_to(model.product, "profit_centre", request.pcl)
        .select("product_id", "product_name")
        .join(supplied_products(model, request.acid), "product_id")
        .join(case_factors(model), "product_id", "left")
    )
    return by_product.join(products, "product_id").select(
        F.col("product_id").alias("product_code"), "product_name", "distributor_code",
        *[cases_or_none(F.col(b) * F.col("supplies"), F.col("factor")).alias(b) for b in BUCKETS],
    )


def stock_summary(model: Model, request: StockRequest) -> Report:
    stock = _stock_cases(model, request)
    companies = model.distributor.select(
        F.col("distributor_id").alias("distributor_code"), "distributor_name", "nav_name", "nav_code", "region"
    )
    detail = stock.join(companies, "distributor_code", "left").select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("nav_code", "nav_name")],
        "distributor_name", "distributor_code", F.coalesce("region", F.lit("")).alias("region"),
        "product_code", "product_name", *[F.col(b).cast(MONEY).alias(b) for b in BUCKETS],
    ).orderBy("product_name")
    total = stock.agg(*[F.sum(b).cast("decimal(38,8)").cast(MONEY).alias(b) for b in BUCKETS]).select(
        F.lit("Total").alias("product_name"), *BUCKETS
    )
    return Report("Claim Report - Stock Summary", date_range(request.date1, request.date2),
                  {"detail": detail, "total": total})
