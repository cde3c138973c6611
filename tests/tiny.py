"""Hand-made tables: rows as dicts, everything else NULL."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pyarrow as pa

from tradeloom.sources.model import AMOUNT, CODE, DAY, ERP_TABLES, TEXT, WHOLE, Model, schema


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


ARROW_TYPES = {CODE: pa.string(), TEXT: pa.string(), DAY: pa.date32(), WHOLE: pa.int32(), AMOUNT: pa.decimal128(18, 4)}


def tiny_model(spark, **tables: list[dict]) -> Model:
    """Small Arrow tables become local relations, so Spark knows how small they are."""

    def frame(table):
        kinds = {c: kind for c, (_, kind) in ERP_TABLES[table][1].items()}
        columns = {}
        given = tables.get(table, [])
        assert all(set(row) <= set(kinds) for row in given)
        for c, kind in kinds.items():
            values = [row.get(c) for row in given]
            if kind == AMOUNT:
                values = [None if v is None else Decimal(str(v)) for v in values]
            columns[c] = pa.array(values, ARROW_TYPES[kind])
        return spark.createDataFrame(pa.table(columns), schema(table))

    return Model({table: lambda table=table: frame(table) for table in ERP_TABLES})


def calendar(first: str = "1998-01-01", last: str = "2002-12-31") -> list[dict]:
    """A local year that starts on 14 April."""
    rows, at = [], day(first)
    while at <= day(last):
        local = at - dt.timedelta(days=103)
        rows.append(dict(day=at, local_year=local.year + 57, local_month=local.month, local_day=local.day))
        at += dt.timedelta(days=1)
    return rows


def rows(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def shop(**more: list[dict]) -> dict[str, list[dict]]:
    """Two distributors and three products: factor 12, factor 0 and no factor."""
    return dict(
        distributor=[
            dict(distributor_id="A", distributor_name="Alpha", nav_name="Nav A", nav_code="NA", region="EAST"),
            dict(distributor_id="B", distributor_name="Beta", nav_name="Nav B", region="WEST"),
            dict(distributor_id="CENTRAL", distributor_name="Office"),
        ],
        product=[
            dict(product_id="M1", product_name="Twelve", supplier_id="SU1", brand_code="B1", profit_centre="PC007"),
            dict(product_id="M2", product_name="Zero", supplier_id="SU1", brand_code="B2", profit_centre="PC007"),
            dict(product_id="M3", product_name="None", supplier_id="SU2", brand_code="B1", profit_centre="PC007"),
        ],
        case_unit=[
            dict(product_id="M1", unit="CASE", factor=12), dict(product_id="M2", unit="CASE", factor=0),
            dict(product_id="M3", unit="BOX", factor=5),
        ],
        price_batch=[dict(product_id=p, batch="B0", price_id=f"{p}-P") for p in ("M1", "M2", "M3")],
        price=[
            dict(price_id="M1-P", product_id="M1", complementary_rate=120, selling_price=240),
            dict(price_id="M2-P", product_id="M2", complementary_rate=17, selling_price=34),
            dict(price_id="M3-P", product_id="M3", complementary_rate=8.5, selling_price=20),
        ],
        claim_type=[dict(type_code=t) for t in ("PP", "OP", "NEV", "TVB", "TEX", "BC", "AC", "MKB")],
        brand=[
            dict(brand_id="V1", brand_name="Vertical", brand_type="VERTICAL"),
            dict(brand_id="B1", brand_code="B1", brand_name="One", parent_id="V1", brand_type="BRAND"),
            dict(brand_id="B2", brand_code="B2", brand_name="Two", parent_id="V1", brand_type="BRAND"),
        ],
        **more,
    )


def voucher(no: str, on: str, kind: str = "TI", ref: str | None = None, company: str = "A", **more) -> dict:
    return dict(voucher_no=no, posted_on=day(on), voucher_type=kind, ref_no=ref, distributor_id=company,
                party_id="PA1", profit_centre="PC007", posted_at="1:00") | more


def line(no: str, product: str, out: float = 0, back: float = 0, batch: str = "B0", **more) -> dict:
    return dict(voucher_no=no, product_id=product, batch=batch, qty_out=out, qty_in=back,
                alt_out=out, alt_in=back, net_amount=more.pop("net_amount", 0)) | more
