"""Claim summary: on screen with distributors, and in print layout."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.measures import BONUS_PER_CASE, BUDGET_PER_CASE, NET_RATE, RATE, TAX_RATE, money, pieces
from tradeloom.operators.claims import claim_rows, pivot_amounts
from tradeloom.params import ClaimKind, ClaimRequest
from tradeloom.report import Report, as_on
from tradeloom.sources.model import Model

MARKET_BREAKAGE = "MKB"


@dataclass(frozen=True)
class Layout:
    """Which claim types one claim report shows."""

    types: tuple[str, ...]
    #: types added into the grand total of the summary
    total_types: tuple[str, ...]
    taxed: bool = True
    net_style: str = "B"


# Claim types, tax treatment and line styles of each layout.
LAYOUTS = {
    ClaimKind.SALES: Layout(("PP", "NEV"), ("PP", "OP", "NEV")),
    ClaimKind.BRAND: Layout(("BC",), ("BC",), net_style="R"),
    ClaimKind.ADMIN: Layout(("AC",), ("AC",), taxed=False, net_style="R"),
    ClaimKind.TIE_UP: Layout(("TVB", "TEX"), ("TVB", "TEX")),
    ClaimKind.OUTLET: Layout(("OP",), ("OP",)),
}
PLAIN, BOLD = "R", "B"
SPACER = "\n\r"
REPORT_NAME = "Claim Report - Summary"

DISTRIBUTOR_COLUMNS = ("nav_name", "nav_code", "distributor_name", "distributor_code", "region")


def _named(df: DataFrame, model: Model, by_company: bool) -> DataFrame:
    """Replace ids by the names the report shows."""
    products = model.product.select("product_id", "product_name")
    df = df.join(products, "product_id", "left").withColumnRenamed("product_id", "product_code")
    if not by_company:
        return df
    companies = model.distributor.select(
        "distributor_id", "nav_name", "nav_code", "distributor_name",
        F.col("distributor_id").alias("distributor_code"), F.coalesce("region", F.lit("")).alias("region"),
    )
    named = df.join(companies, "distributor_id", "left").drop("distributor_id")
    return named.withColumn("region", F.coalesce("region", F.lit("")))


def _sum_of(types: tuple[str, ...]) -> Column:
    return reduce(Column.__add__, [F.col(t.lower()) for t in types])


def _amounts(rows: DataFrame, keys: list[str], shown: tuple[str, ...], added: tuple[str, ...]) -> DataFrame:
    """Amounts by type and their total; groups whose total is 0 or unknown are dropped."""
    wide = pivot_amounts(rows, keys, added)
    return wide.withColumn("total", _sum_of(added)).filter(F.col("total") != 0).select(
        *keys, *[money(F.col(t.lower())).alias(t.lower()) for t in shown], money(F.col("total")).alias("total")
    )


def _breakage(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Cases sold, the budget and bonus they earn, and what broke in the market."""
    broken = F.col("claim_type") == MARKET_BREAKAGE
    sums = rows.groupBy(*keys).agg(
        pieces(F.sum("case_units")).cast("decimal(24,4)").alias("cases"),
        F.sum(F.when(broken, F.col("units")).otherwise(F.lit(0))).alias("broken"),
        F.sum(F.when(broken, F.col("amount")).otherwise(F.lit(0))).alias("broken_amount"),
    )
    return sums.select(
        *keys,
        F.col("cases").cast(RATE).alias("sales_cs"),
        (F.col("cases") * F.lit(BUDGET_PER_CASE)).cast("decimal(32,10)").alias("approved_budget"),
        pieces(F.col("broken")).cast(RATE).alias("breakage_pcs"),
        money(F.col("broken_amount")).alias("breakage_amount"),
        (F.col("cases") * F.lit(BONUS_PER_CASE)).cast(RATE).alias("approved_bonus"),
    )


BREAKAGE_COLUMNS = ("sales_cs", "approved_budget", "breakage_pcs", "breakage_amount", "approved_bonus")


def claim_summary(model: Model, request: ClaimRequest) -> Report:
    """Detail by product and distributor, and the grand total."""
    kind = request.kind(ClaimKind.BRAND)
    keys = ["product_id", "distributor_id"]
    names = (*DISTRIBUTOR_COLUMNS, "product_code", "product_name")
    label = F.lit("Total").alias("product_name")
    if kind is ClaimKind.BREAKAGE:
        rows = claim_rows(model, request)
        detail = _named(_breakage(rows, keys), model, True).select(*names, *BREAKAGE_COLUMNS)
        total = _breakage(rows, []).select(label, *BREAKAGE_COLUMNS)
    else:
        layout = LAYOUTS[kind]
        shown = [t.lower() for t in layout.types]
        rows = claim_rows(model, request, types=layout.types)
        detail = _named(_amounts(rows, keys, layout.types, layout.types), model, True).select(*names, *shown, "total")
        rows = claim_rows(model, request, types=layout.total_types)
        total = _amounts(rows, [], layout.types, layout.total_types).select(label, *shown, "total")
    return Report(REPORT_NAME, as_on(request.date1, request.date2), {"detail": detail, "total": total})


def _section(df: DataFrame, ordinal: int, style: str) -> DataFrame:
    return df.withColumns({"fflg": F.lit(style), "section": F.lit(ordinal)})


def _spacer(like: DataFrame) -> DataFrame:
    """One blank row between detail and totals."""
    columns = [
        (F.lit(SPACER) if f.name == "product_name" else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in like.schema
    ]
    return like.sparkSession.range(1).select(columns)


def claim_print(model: Model, request: ClaimRequest) -> DataFrame:
    """Print layout: products, a spacer, then total, tax and net amount.

    ``fflg`` is the line style; rows come sorted by section.
    """
    kind = request.kind(ClaimKind.SALES)
    if kind is ClaimKind.BREAKAGE:
        rows = claim_rows(model, request, by_company=False)
        detail = _named(_breakage(rows, ["product_id"]), model, False).select("product_name", *BREAKAGE_COLUMNS)
        total = _breakage(rows, []).select(F.lit("Total").alias("product_name"), *BREAKAGE_COLUMNS)
        sections = [_section(detail, 1, PLAIN), _section(_spacer(detail), 2, PLAIN), _section(total, 3, BOLD)]
    else:
        layout = LAYOUTS[kind]
        rows = claim_rows(model, request, by_company=False, types=layout.types)
        amounts = [*[t.lower() for t in layout.types], "total"]

        def scaled(factor) -> list[Column]:
            return [(F.col(a).cast("decimal(28,2)") * F.lit(factor)).cast(RATE).alias(a) for a in amounts]

        detail = _named(_amounts(rows, ["product_id"], layout.types, layout.types), model, False).select(
            "product_name", *scaled(1)
        )
        whole = _amounts(rows, [], layout.types, layout.types)
        tax, net = (TAX_RATE, NET_RATE) if layout.taxed else (0, 1)
        # One total row becomes the three closing lines.
        closing = whole.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("product_name"), *scaled(factor), F.lit(style).alias("fflg"),
                     F.lit(ordinal).alias("section"))
            for ordinal, (name, factor, style) in enumerate(
                [("Total", 1, BOLD), ("Less: TDS (15%)", tax, PLAIN), ("Net Amount", net, layout.net_style)], start=3
            )
        ])))
        sections = [_section(detail, 1, PLAIN), _section(_spacer(detail), 2, PLAIN), closing]
    return reduce(DataFrame.unionByName, sections).orderBy("section", "product_name").drop("section")
