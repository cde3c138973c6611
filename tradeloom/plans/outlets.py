"""Outlet master with bills and cases in a date range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.filters import between, outside_head_office
from tradeloom.functions.measures import SETTLED, cases_or_none
from tradeloom.operators.facts import CREDIT_NOTE, HOME_CENTRE, case_factors, sold_units
from tradeloom.params import OutletRequest
from tradeloom.report import Report, date_range
from tradeloom.sources.model import Model

# Outlet accounts, and the channel types an outlet plays a role in.
OUTLET_PREFIX = "PA"
OUTLET_KIND = "C"
ROLES = {"channel": ("channel_code", "CHANNEL"), "sub_channel": ("subchannel_code", "SUB-CHANNEL"),
         "segment": ("segment_code", "SEGMENT")}


def sales_by_outlet(model: Model, request: OutletRequest) -> DataFrame:
    """Per company and party: bills that are not returns, cases, and net amount with returns negative."""
    vouchers = outside_head_office(
        model.sales_voucher.filter(
            between("posted_on", request.date1, request.date2) & (F.col("profit_centre") == HOME_CENTRE)
        ),
        "distributor_id", request.companyid,
    ).select("voucher_no", "distributor_id", "party_id", (F.col("voucher_type") == CREDIT_NOTE).alias("is_return"))
    lines = model.sales_line.select("voucher_no", "product_id", sold_units().alias("units"), "net_amount")
    signed = F.when(F.col("is_return"), -F.col("net_amount")).otherwise(F.col("net_amount"))
    by_bill = (
        vouchers.join(lines, "voucher_no")
        .join(case_factors(model), "product_id", "left")
        .groupBy("distributor_id", "party_id", "voucher_no", "factor")
        .agg(F.max((~F.col("is_return")).cast("int")).alias("bill"),
             F.sum("units").alias("units"), F.sum(signed).alias("amount"))
        .groupBy("distributor_id", "party_id", "voucher_no")
        .agg(F.max("bill").alias("bill"), F.sum(cases_or_none(F.col("units"), F.col("factor"))).alias("cases"),
             F.sum("amount").alias("amount"))
    )
    return by_bill.groupBy("distributor_id", "party_id").agg(
        F.sum("bill").alias("no_of_bills"), F.sum("cases").alias("cases"), F.sum("amount").alias("amount")
    )


def net_amount_by_outlet(model: Model, request: OutletRequest) -> DataFrame:
    return sales_by_outlet(model, request).select(
        "distributor_id", "party_id", F.col("amount").cast("decimal(32,4)").alias("net_amount")
    )


def outlets(model: Model, request: OutletRequest) -> DataFrame:
    """Outlet accounts with their distributor, province and channel roles."""
    companies = outside_head_office(model.distributor, "distributor_id", request.companyid)
    accounts = model.account.filter(
        F.col("account_id").startswith(OUTLET_PREFIX)
        & ((F.col("party_kind") == OUTLET_KIND) | (F.col("is_common") == 1))
    )
    listed = (
        accounts.join(companies, "distributor_id")
        .join(model.org_type, "org_code", "left")
        .join(model.state, "state_code", "left")
    )
    for role, (column, kind) in ROLES.items():
        names = model.channel.filter(F.col("channel_type") == kind).select(
            F.col("channel_code").alias(column), F.col("channel_name").alias(role)
        )
        listed = listed.join(names, column, "left")
    return listed.select(
        "distributor_id", F.col("account_id").alias("party_id"), "region", "distributor_name",
        F.col("account_name").alias("outlet_name"), F.col("tax_no").alias("outlet_pan"),
        F.col("address").alias("outlet_address"), F.col("state_name").alias("province"),
        F.col("org_name").alias("outlet_type"), *ROLES,
    )


def outlet_master(model: Model, request: OutletRequest) -> Report:
    sales = sales_by_outlet(model, request).select("distributor_id", "party_id", "no_of_bills", "cases")
    rows = outlets(model, request).join(sales, ["distributor_id", "party_id"]).select(
        "region", F.col("distributor_id").alias("distributor_code"), "distributor_name", "outlet_name", "outlet_pan",
        "outlet_address", "province", "outlet_type", *ROLES, "no_of_bills",
        F.col("cases").cast(SETTLED).cast("decimal(32,6)").alias("total_sales"),
    ).orderBy("distributor_name", "outlet_name")
    return Report("Outlet Master Report - Detail", date_range(request.date1, request.date2), {"detail": rows})
