"""Products with their brands, suppliers, prices and case factors.

These are joins among dimensions; facts meet only their result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.filters import in_list
from tradeloom.functions.measures import RATE, piece_rate
from tradeloom.operators.facts import case_factors
from tradeloom.sources.model import Model


def brand_vertical(model: Model) -> DataFrame:
    """brand_code, brand_name and the vertical the brand belongs to."""
    vertical = model.brand.filter(F.col("brand_type") == "VERTICAL").select(
        F.col("brand_id").alias("parent_id"), F.col("brand_name").alias("vertical")
    )
    return model.brand.join(vertical, "parent_id").select("brand_code", "brand_name", "vertical")


def supplied_products(model: Model, acid: str) -> DataFrame:
    """product_id and ``supplies``: how many supplier accounts of interest it has.

    Without an account filter a product without a supplier account counts once.
    """
    suppliers = in_list(model.account.select(F.col("account_id").alias("supplier_id")), "supplier_id", acid)
    how = "left" if acid.strip() == "%" else "inner"
    return (
        model.product.select("product_id", "supplier_id")
        .join(suppliers, "supplier_id", how)
        .groupBy("product_id")
        .agg(F.count("*").cast("int").alias("supplies"))
    )


def batch_prices(model: Model) -> DataFrame:
    """product_id, batch and the prices filed for that very product."""
    return model.price_batch.join(model.price, ["price_id", "product_id"]).select(
        "product_id", "batch", "complementary_rate", "selling_price"
    )


def piece_rates(model: Model) -> DataFrame:
    """product_id, batch, complementary rate per piece and the same in four decimals."""
    rate = piece_rate(F.col("complementary_rate"), F.col("factor"))
    return (
        batch_prices(model)
        .join(case_factors(model), "product_id", "left")
        .select("product_id", "batch", rate.alias("exact_rate"), rate.cast(RATE).alias("rate"))
    )
