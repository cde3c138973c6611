"""Complementary (claim) bills, the sales they refer to, and returns on either.

A claim bill gives goods away against an earlier sale.  Its value is the net
quantity at the complementary rate.  Credit notes name the bill they return.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.filters import between, in_list
from tradeloom.functions.measures import RATE, cents, grossed_up, money, pieces, units
from tradeloom.operators.facts import CREDIT_NOTE, HOME_CENTRE, SALE
from tradeloom.operators.pricing import piece_rates, supplied_products
from tradeloom.params import ClaimRequest
from tradeloom.sources.model import Model
from tradeloom.stored import keep

# The claim types the summary reports know.
CLAIM_TYPES = ("PP", "OP", "NEV", "TVB", "TEX", "BC", "AC", "MKB")

QUANTITY = "decimal(18,4)"
MEASURES = ("qty_out", "alt_out", "qty_in", "alt_in")
CLAIM_KEYS = ("voucher_no", "claim_type", "ref_no", "distributor_id", "party_id", "posted_on", "posted_at")


def bills(model: Model, request: ClaimRequest, kind: str, home_only: bool = True) -> DataFrame:
    """Sales vouchers of one kind in the requested range and companies."""
    chosen = model.sales_voucher.filter(
        (F.col("voucher_type") == kind) & between("posted_on", request.date1, request.date2)
    )
    chosen = in_list(chosen, "distributor_id", request.companyid)
    if home_only:
        chosen = chosen.filter(F.col("profit_centre") == HOME_CENTRE)
    return chosen.withColumn("ref_no", F.trim("ref_no"))


def claim_bills(
    model: Model, request: ClaimRequest, types: Sequence[str] | DataFrame = CLAIM_TYPES, home_only: bool = True
) -> DataFrame:
    """Headers of bills tagged with a claim type, from a list or the type table."""
    if isinstance(types, DataFrame):
        tags = model.claim_tag.join(
            types.select(F.col("type_code").alias("claim_type")), "claim_type", "left_semi"
        )
    else:
        tags = model.claim_tag.filter(F.col("claim_type").isin(*types))
    return bills(model, request, SALE, home_only).join(tags.select("voucher_no", "claim_type"), "voucher_no").select(
        *CLAIM_KEYS
    )


def lines_of(model: Model, headers: DataFrame) -> DataFrame:
    """The headers with their vouchers' lines."""
    return headers.join(model.sales_line.select("voucher_no", "product_id", "batch", *MEASURES), "voucher_no")


def lines_read_once(model: Model, **headers: DataFrame) -> dict[str, DataFrame]:
    """:func:`lines_of` for several header tables; the lines meet all of them in one join, which is stored.

    A report that sums the lines of claims, sales and returns so reads and deals the lines once, not once for each.
    """
    tagged = [h.withColumn("role", F.lit(role)) for role, h in headers.items()]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    stored = keep(lines_of(model, every), "bill-lines")
    return {
        role: stored.filter(F.col("role") == role).select(*h.columns, "product_id", "batch", *MEASURES)
        for role, h in headers.items()
    }


def claimed_goods(model: Model, request: ClaimRequest, claims: DataFrame) -> DataFrame:
    """Per claim bill, product and rate: units and case units given away.

    Only batches with a price count.
    """
    return goods_given(model, request, lines_of(model, claims))


def goods_given(model: Model, request: ClaimRequest, claim_lines: DataFrame) -> DataFrame:
    """:func:`claimed_goods` from the claims' lines."""
    return (
        claim_lines
        .join(piece_rates(model), ["product_id", "batch"])
        .join(supplied_products(model, request.acid), "product_id")
        .groupBy(*CLAIM_KEYS, "product_id", "exact_rate", "rate")
        .agg(_total("qty_out", "given"), _total("alt_out", "given_cases"))
    )


def _total(column: str, alias: str) -> Column:
    return F.sum(units(F.col(column)) * F.col("supplies")).alias(alias)


def sale_headers(
    model: Model, request: ClaimRequest, *extra_keys: str, named_by: DataFrame | None = None
) -> DataFrame:
    """Sales bills, claim bills too; ``named_by`` limits them to those its ``ref_no`` names."""
    headers = bills(model, request, SALE).select(F.col("voucher_no"), F.col("voucher_no").alias("bill"), *extra_keys)
    if named_by is not None:
        headers = headers.join(named_by.select(F.col("ref_no").alias("bill")).distinct(), "bill", "left_semi")
    return headers


def return_headers(model: Model, request: ClaimRequest, named_by: DataFrame | None = None) -> DataFrame:
    """Credit notes and the bill each refers to; ``named_by`` limits the bills to its ``voucher_no``."""
    headers = bills(model, request, CREDIT_NOTE).select("voucher_no", F.col("ref_no").alias("bill"))
    if named_by is not None:
        headers = headers.join(named_by.select(F.col("voucher_no").alias("bill")).distinct(), "bill", "left_semi")
    return headers


def units_sold(model: Model, request: ClaimRequest, sale_lines: DataFrame, *extra_keys: str) -> DataFrame:
    """Units and case units sold per bill and product; claim bills are sales too."""
    return _by_bill(model, request, sale_lines, ("qty_out", "sold"), ("alt_out", "sold_cases"), *extra_keys)


def units_returned(model: Model, request: ClaimRequest, return_lines: DataFrame) -> DataFrame:
    """Units and case units returned per referenced bill and product."""
    return _by_bill(model, request, return_lines, ("qty_in", "returned"), ("alt_in", "returned_cases"))


def returned_units(model: Model, request: ClaimRequest) -> DataFrame:
    """Units and case units returned per referenced bill and product."""
    return units_returned(model, request, lines_of(model, return_headers(model, request)))


def returns_by_bill(model: Model, request: ClaimRequest) -> DataFrame:
    """Pieces and cases returned per referenced bill and product."""
    return in_pieces(returned_units(model, request), "returned", "returned_cases")


def in_pieces(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: pieces(F.col(c)).cast(QUANTITY) for c in columns})


def _by_bill(
    model: Model, request: ClaimRequest, lines: DataFrame, *measures_and_keys: tuple[str, str] | str
) -> DataFrame:
    measures = [m for m in measures_and_keys if not isinstance(m, str)]
    keys = ["bill", "product_id", *[k for k in measures_and_keys if isinstance(k, str)]]
    summed = sums_by_bill(lines, keys, measures)
    return summed.join(supplied_products(model, request.acid), "product_id").select(
        *keys, *[(F.col(name) * F.col("supplies")).alias(name) for _, name in measures]
    )


def sums_by_bill(lines: DataFrame, keys: Sequence[str], measures: Sequence[tuple[str, str]]) -> DataFrame:
    """Line quantities summed in units; ``bill`` says which bill a line counts for."""
    return lines.select(*keys, *[units(F.col(c)).alias(n) for c, n in measures]).groupBy(*keys).agg(
        *[F.sum(n).alias(n) for _, n in measures])


def net_of(column: str, returned: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)) - F.coalesce(F.col(returned), F.lit(0))


def at_rate(units: Column) -> Column:
    """Units at the complementary rate, exact to eight decimals."""
    return pieces(units).cast(QUANTITY) * F.col("rate").cast(QUANTITY)


def net_claims(
    model: Model, request: ClaimRequest, claim_lines: DataFrame, return_lines: DataFrame, by_company: bool
) -> DataFrame:
    """Claims net of returns, summed per referenced bill, product and type.

    ``claims`` counts them, ``amount`` is in cents.  A bill many claims refer to becomes one row per
    company and type, whatever is joined to it next.
    """
    owner = ["distributor_id"] if by_company else []
    goods = goods_given(model, request, claim_lines).withColumnRenamed("voucher_no", "bill")
    if by_company:
        # A company that is not listed counts as unknown.
        listed = model.distributor.select("distributor_id", F.col("distributor_id").alias("listed"))
        goods = goods.join(listed, "distributor_id", "left").drop("distributor_id").withColumnRenamed(
            "listed", "distributor_id"
        )
    returned = units_returned(model, request, return_lines).select("bill", "product_id", "returned")
    net = net_of("given", "returned")
    return (
        goods.join(returned, ["bill", "product_id"], "left")
        .select("ref_no", "product_id", "claim_type", *owner, net.alias("units"),
                cents(grossed_up(at_rate(net), F.col("claim_type"))).alias("amount"))
        .groupBy("ref_no", "product_id", "claim_type", *owner)
        .agg(F.sum("amount").alias("amount"), F.sum("units").alias("units"), F.count("*").alias("claims"))
    )


def claim_rows(
    model: Model, request: ClaimRequest, by_company: bool = True, types: Sequence[str] | None = None
) -> DataFrame:
    """Claims joined with the sales they refer to, not yet summed; in cents and units.

    All types together are full-joined, so sales no claim refers to stay, without
    a type.  A report on some ``types`` drops those sales, hence it needs only
    the sales its claims name; and none at all without companies, since a bill
    then has one row per product, which can neither add nor repeat an amount.
    """
    headers = claim_bills(model, request, types or CLAIM_TYPES)
    if types and not by_company:
        lines = lines_read_once(model, claims=headers, returns=return_headers(model, request, named_by=headers))
        return net_claims(model, request, lines["claims"], lines["returns"], by_company).select(
            "product_id", "claim_type", "amount")
    owner = ["distributor_id"] if by_company else []
    lines = lines_read_once(
        model, claims=headers, returns=return_headers(model, request),
        sales=sale_headers(model, request, *owner, named_by=headers if types else None),
    )
    claims = net_claims(model, request, lines["claims"], lines["returns"], by_company)
    sales = (
        units_sold(model, request, lines["sales"], *owner)
        .join(units_returned(model, request, lines["returns"]).select("bill", "product_id", "returned_cases"),
              ["bill", "product_id"], "left")
        .select("bill", F.col("product_id").alias("sold_product"),
                *[F.col(c).alias("sold_by") for c in owner], net_of("sold_cases", "returned_cases").alias("case_units"))
    )
    joined = claims.join(
        sales, (F.col("ref_no") == F.col("bill")) & (F.col("product_id") == F.col("sold_product")),
        "left" if types else "full",
    )
    rows = joined.select(
        F.coalesce("product_id", "sold_product").alias("product_id"),
        *[F.coalesce(c, F.col("sold_by")).alias(c) for c in owner],
        "claim_type",
        F.coalesce("amount", F.lit(0)).alias("amount"),
        F.coalesce("units", F.lit(0)).alias("units"),
        (F.coalesce("case_units", F.lit(0)) * F.coalesce("claims", F.lit(1))).alias("case_units"),
    )
    if not by_company:
        return rows
    # Companies that are not listed are one unknown company.
    listed = model.distributor.select("distributor_id", F.col("distributor_id").alias("listed"))
    return rows.join(listed, "distributor_id", "left").drop("distributor_id").withColumnRenamed(
        "listed", "distributor_id")


def claims_vs_sales(model: Model, request: ClaimRequest) -> DataFrame:
    """Amount, pieces and cases per product, company and claim type.

    Sales no claim refers to have no claim type.
    """
    return claim_rows(model, request).groupBy("product_id", "distributor_id", "claim_type").agg(
        money(F.sum("amount")).alias("amount"),
        pieces(F.sum("units")).cast(RATE).alias("pieces"),
        pieces(F.sum("case_units")).cast(RATE).alias("cases"),
    )


def pivot_amounts(rows: DataFrame, keys: Sequence[str], types: Sequence[str]) -> DataFrame:
    """One amount column per claim type, 0 where a group has none of it."""
    spread = [
        F.sum(F.when(F.col("claim_type") == t, F.col("amount")).otherwise(F.lit(0))).alias(t.lower()) for t in types
    ]
    return rows.groupBy(*keys).agg(*spread)


def claim_pivot(model: Model, request: ClaimRequest) -> DataFrame:
    """Product by claim type."""
    wide = pivot_amounts(claim_rows(model, request, by_company=False), ["product_id"], CLAIM_TYPES)
    return wide.select("product_id", *[money(F.col(t.lower())).alias(t.lower()) for t in CLAIM_TYPES])
