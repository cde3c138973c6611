"""Claims bill by bill, with the sale each refers to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.filters import between, in_list
from tradeloom.functions.measures import MONEY, NET_RATE, RATE, TAX_RATE, UNTAXED_CLAIM, grossed_up, pieces, tax_on
from tradeloom.operators.claims import (
    at_rate, bills, claim_bills, claimed_goods, goods_given, lines_of, lines_read_once, net_of, sums_by_bill,
)
from tradeloom.operators.facts import CREDIT_NOTE, SALE
from tradeloom.params import ClaimRequest
from tradeloom.report import Report, as_on
from tradeloom.sources.model import Model

# Claim types listed first, and the place of all others.
TYPE_ORDER = (("PP", 1), ("OP", 2), ("NEV", 3))
OTHER_TYPES = 99


SOLD = (("qty_out", "sold"), ("alt_out", "sold_cases"))
RETURNED = (("qty_in", "returned"), ("alt_in", "returned_cases"))


def sales_headers(model: Model, request: ClaimRequest, claimed: DataFrame) -> DataFrame:
    """Sales bills named in ``claimed.ref_no``."""
    wanted = claimed.select(F.col("ref_no").alias("voucher_no")).distinct()
    return bills(model, request, SALE, home_only=False).join(wanted, "voucher_no", "left_semi").select(
        "voucher_no", F.col("voucher_no").alias("bill")
    )


def sales_of_claimed_bills(model: Model, request: ClaimRequest, claimed: DataFrame) -> DataFrame:
    """Units and case units per bill and product, for bills named in ``claimed.ref_no``."""
    return sums_by_bill(lines_of(model, sales_headers(model, request, claimed)), ["bill", "product_id"], SOLD)


def returns_headers(model: Model, request: ClaimRequest, claimed: DataFrame) -> DataFrame:
    """Credit notes on claim bills."""
    wanted = claimed.select(F.col("voucher_no").alias("bill")).distinct()
    return bills(model, request, CREDIT_NOTE, home_only=False).select(
        "voucher_no", F.col("ref_no").alias("bill")
    ).join(wanted, "bill", "left_semi")


def claimed_goods_of_listed_types(model: Model, request: ClaimRequest) -> DataFrame:
    """Goods on bills of every claim type in the type table, of any profit centre."""
    return claimed_goods(model, request, claim_bills(model, request, model.claim_type, home_only=False))


def claim_billwise(model: Model, request: ClaimRequest) -> Report:
    claims = claim_bills(model, request, model.claim_type, home_only=False)
    # Bill numbers alone select the sales and returns to sum.  They include claim
    # bills whose goods have no price; the sums of those find no partner below.
    lines = lines_read_once(
        model, claims=claims, sales=sales_headers(model, request, claims), returns=returns_headers(model, request, claims)
    )
    sold = sums_by_bill(lines["sales"], ["bill", "product_id"], SOLD)
    returned = sums_by_bill(lines["returns"], ["bill", "product_id"], RETURNED)
    found = sold.select(F.col("bill").alias("ref_no"), F.col("bill").alias("ref_bill_no")).distinct()
    party = model.account.select(F.col("account_id").alias("party_id"), F.col("tax_no").alias("pan"),
                                 F.col("account_name").alias("party_name"))
    listed = ", ".join(f"('{kind}', {place})" for kind, place in TYPE_ORDER)
    place = model.product.sparkSession.sql(f"SELECT * FROM VALUES {listed} AS places(claim_type, place)")
    net = net_of("given", "returned")
    facts = (
        goods_given(model, request, lines["claims"])
        .join(found, "ref_no", "left")
        .join(sold.withColumnRenamed("bill", "ref_bill_no"), ["ref_bill_no", "product_id"], "left")
        .join(returned.withColumnRenamed("bill", "voucher_no"), ["voucher_no", "product_id"], "left")
        .join(model.distributor.select("distributor_id", "nav_code", "nav_name"), "distributor_id", "left")
        .join(place, "claim_type", "left")
        .withColumns({
            "place": F.coalesce("place", F.lit(OTHER_TYPES)),
            "units": net, "case_units": net_of("given_cases", "returned_cases"), "value": at_rate(net),
        })
        .join(party, "party_id", "left")
    )
    kind = F.col("claim_type")

    def quantity(column: str) -> Column:
        return pieces(F.col(column)).cast(RATE)

    detail = facts.join(model.product.select("product_id", "product_name"), "product_id").select(
        F.date_format("posted_on", "MM/dd/yyyy").alias("trn_date"),
        "nav_code", "nav_name", F.col("product_id").alias("product_code"), "product_name", "pan", "party_name",
        "ref_bill_no", quantity("sold").alias("qty"), quantity("sold_cases").alias("qty_case"),
        kind.alias("type"), F.col("voucher_no").alias("comp_ref_no"),
        quantity("units").alias("comp_qty"), quantity("case_units").alias("comp_qty_case"),
        F.col("rate").alias("comp_rate"), F.col("value").cast(MONEY).alias("comp_amount"),
        tax_on(F.col("value"), kind).alias("tds_15"), grossed_up(F.col("value"), kind).alias("total_amount"),
        "place", F.lit("A").alias("flag"), "posted_at",
    )
    sums = facts.groupBy("nav_code", "nav_name", "claim_type", "place").agg(
        F.sum("sold").alias("sold"), F.sum("sold_cases").alias("sold_cases"),
        F.sum("units").alias("units"), F.sum("case_units").alias("case_units"), F.sum("value").alias("value"),
    )
    taxed = F.col("value").cast("decimal(26,8)") / F.lit(NET_RATE)
    plain = kind == UNTAXED_CLAIM
    values = {
        "nav_code": F.col("nav_code"), "nav_name": F.col("nav_name"), "product_name": F.lit("Total >>"),
        "qty": quantity("sold"), "qty_case": quantity("sold_cases"), "type": kind,
        "comp_qty": quantity("units"), "comp_qty_case": quantity("case_units"), "comp_amount": F.col("value"),
        "tds_15": F.when(plain, F.lit(0)).otherwise((taxed * F.lit(TAX_RATE)).cast(MONEY)),
        "total_amount": F.when(plain, F.col("value").cast(MONEY)).otherwise(taxed.cast(MONEY)),
        "place": F.col("place"), "flag": F.lit("B"),
    }
    total = sums.select([
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in detail.schema
    ])
    # The date is sorted as the text it is shown as.
    rows = detail.unionByName(total).orderBy(
        "place", "type", "nav_name", "flag", "party_name", "trn_date", "posted_at", "product_name"
    ).drop("place", "flag", "posted_at")
    return Report("Claim Report - Bill Wise Detail", as_on(request.date1, request.date2), {"detail": rows})


def vouchers_per_company(model: Model, request: ClaimRequest) -> DataFrame:
    """Vouchers in a date range, per company of a comma-separated list."""
    chosen = in_list(model.sales_voucher, "distributor_id", request.companyid).filter(
        between("posted_on", request.date1, request.date2)
    )
    return chosen.groupBy("distributor_id").agg(F.count("*").alias("vouchers"))
