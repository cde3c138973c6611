"""Breakage, leakage, shortage and carton loss in transport, in print layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.filters import between, equal_to
from tradeloom.functions.measures import MONEY, zero
from tradeloom.params import ClaimRequest
from tradeloom.sources.model import Model

LOSSES = ("leakage", "breakage", "shortage", "carton")
PRINTED = (
    "delivery_note", "pws_no", "invoice_date", "distributor_name", "transport_name", "description", "invoice_qty",
    "dispatch_rate", *LOSSES, "amount", "truck_number", "driver_name", "driver_number",
)


def _two_decimals(value: Column) -> Column:
    return F.format_number(value.cast(MONEY), 2)


def transport_losses(model: Model, request: ClaimRequest) -> DataFrame:
    """One row per delivered line with a recorded loss, valued at the dispatch rate."""
    vouchers = equal_to(
        model.purchase_voucher.filter(between("posted_on", request.date1, request.date2)),
        "distributor_id", request.companyid,
    ).select("voucher_no", "posted_on", "distributor_id")
    products = equal_to(model.product, "supplier_id", request.acid).select("product_id", "product_name")
    receipts = model.receipt.select(F.col("voucher_no").alias("receipt_no"), F.col("ref_no").alias("voucher_no"))
    lost = (
        model.transit_loss.withColumnRenamed("voucher_no", "receipt_no")
        .join(model.consignment.withColumnRenamed("voucher_no", "receipt_no"), "receipt_no")
        .join(receipts, "receipt_no")
    )
    lines = model.purchase_line.select("voucher_no", "product_id", "maker_id", "qty_in", "rate")
    pieces = sum((F.coalesce(F.col(c), zero()) for c in LOSSES[1:]), F.coalesce(F.col(LOSSES[0]), zero()))
    return (
        vouchers.join(lost, "voucher_no")
        .join(lines, ["voucher_no", "product_id", "maker_id"])
        .join(products, "product_id")
        .join(model.distributor.select("distributor_id", "distributor_name"), "distributor_id", "left")
        .select(
            "delivery_note", "pws_no", F.date_format("posted_on", "yyyy-MM-dd").alias("invoice_date"),
            "distributor_name", F.col("carrier").alias("transport_name"),
            F.col("product_name").alias("description"), F.coalesce("qty_in", zero()).alias("invoice_qty"),
            F.col("rate").alias("dispatch_rate"), *[F.coalesce(c, zero()).alias(c) for c in LOSSES],
            (pieces.cast("decimal(18,4)") * F.col("rate")).alias("amount"),
            F.col("vehicle_no").alias("truck_number"), "driver_name", F.col("driver_no").alias("driver_number"),
        )
    )


def transport_claim(model: Model, request: ClaimRequest) -> DataFrame:
    """Deliveries with losses, a spacer and the total, all as printed text."""
    losses = transport_losses(model, request)
    summed = ("invoice_qty", *LOSSES, "amount")
    numbers = (*summed, "dispatch_rate")
    detail = losses.select(
        *[_two_decimals(F.col(c)).alias(c) if c in numbers else F.col(c) for c in PRINTED], F.lit(1).alias("section")
    )
    total = losses.agg(*[F.sum(c).alias(c) for c in summed])

    def other(df: DataFrame, first: str, shown: tuple[str, ...], section: int) -> DataFrame:
        return df.select(
            F.lit(first).alias("delivery_note"),
            *[(_two_decimals(F.col(c)) if c in shown else F.lit(None).cast("string")).alias(c) for c in PRINTED[1:]],
            F.lit(section).alias("section"),
        )

    spacer = other(losses.sparkSession.range(1), "\n\r", (), 2)
    return (
        detail.unionByName(spacer)
        .unionByName(other(total, "TOTAL", summed, 3))
        .orderBy("section", "delivery_note")
        .drop("section")
    )
