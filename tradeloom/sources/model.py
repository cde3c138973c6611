"""The 24 tables the reports read, under the names this package uses.

``ERP_TABLES`` ties each table and column to its physical name in the ERP
database and to the type it is stored in after import.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CODE = "code"  # text compared without case or surrounding blanks
TEXT = "text"
DAY = "day"
WHOLE = "whole"
AMOUNT = "amount"

SPARK_TYPES = {
    CODE: T.StringType(),
    TEXT: T.StringType(),
    DAY: T.DateType(),
    WHOLE: T.IntegerType(),
    AMOUNT: T.DecimalType(18, 4),
}

#: placeholder for the claim-type column, whose physical name differs per site
CLAIM_TYPE_COLUMN = "<claim type>"

# Physical table and column names of the ERP database.
ERP_TABLES: dict[str, tuple[str, dict[str, tuple[str, str]]]] = {
    "sales_voucher": ("TRNMAIN", {
        "voucher_no": ("VCHRNO", CODE),
        "ref_no": ("REFBILL", CODE),
        "party_id": ("PARAC", CODE),
        "billed_to": ("TRNAC", CODE),
        "posted_on": ("TRNDATE", DAY),
        "posted_at": ("TRNTIME", TEXT),
        "distributor_id": ("COMPANYID", CODE),
        "voucher_type": ("VOUCHERTYPE", CODE),
        "profit_centre": ("PCL", CODE),
    }),
    "sales_line": ("TRNPROD", {
        "voucher_no": ("VCHRNO", CODE),
        "product_id": ("MCODE", CODE),
        "batch": ("BATCH", CODE),
        "qty_out": ("REALQTY", AMOUNT),
        "alt_out": ("ALTQTY", AMOUNT),
        "qty_in": ("REALQTY_IN", AMOUNT),
        "alt_in": ("ALTQTY_IN", AMOUNT),
        "net_amount": ("NETAMOUNT", AMOUNT),
    }),
    "ledger_voucher": ("RMD_TRNMAIN", {
        "voucher_no": ("VCHRNO", CODE),
        "distributor_id": ("COMPANYID", CODE),
        "posted_on": ("TRNDATE", DAY),
        "voucher_type": ("VOUCHERTYPE", CODE),
        "profit_centre": ("PCL", CODE),
        "fiscal_year": ("PHISCALID", CODE),
    }),
    "ledger_line": ("RMD_TRNPROD", {
        "voucher_no": ("VCHRNO", CODE),
        "distributor_id": ("COMPANYID", CODE),
        "product_id": ("MCODE", CODE),
        "batch": ("BATCH", CODE),
        "qty_out": ("REALQTY", AMOUNT),
        "qty_in": ("REALQTY_IN", AMOUNT),
    }),
    "purchase_voucher": ("PURMAIN", {
        "voucher_no": ("VCHRNO", CODE),
        "posted_on": ("TRNDATE", DAY),
        "distributor_id": ("COMPANYID", CODE),
        "profit_centre": ("PCL", CODE),
    }),
    "purchase_line": ("PURPROD", {
        "voucher_no": ("VCHRNO", CODE),
        "product_id": ("MCODE", CODE),
        "batch": ("BATCH", CODE),
        "qty_out": ("REALQTY", AMOUNT),
        "qty_in": ("REALQTY_IN", AMOUNT),
        "rate": ("RATE", AMOUNT),
        "maker_id": ("MANUFACTURER", CODE),
    }),
    "receipt": ("INVMAIN", {
        "voucher_no": ("VCHRNO", CODE),
        "ref_no": ("REFBILL", CODE),
    }),
    "transit_loss": ("LEAKAGEBREAKAGE_SUMMARY", {
        "voucher_no": ("VCHRNO", CODE),
        "product_id": ("MCODE", CODE),
        "maker_id": ("MANUFACTURER", CODE),
        "leakage": ("LEAKAGE", AMOUNT),
        "breakage": ("BREAKAGE", AMOUNT),
        "shortage": ("SHORTAGE", AMOUNT),
        "carton": ("CARTON", AMOUNT),
    }),
    "consignment": ("TRANSPORTER_EWAY", {
        "voucher_no": ("VCHRNO", CODE),
        "delivery_note": ("DELIVERYNOTE", TEXT),
        "pws_no": ("PWSNO", TEXT),
        "carrier": ("TRANSPORTER", TEXT),
        "vehicle_no": ("VEHICLENO", TEXT),
        "driver_name": ("DRIVERNAME", TEXT),
        "driver_no": ("DRIVERNO", TEXT),
    }),
    "product": ("MENUITEM", {
        "product_id": ("MCODE", CODE),
        "product_name": ("DESCA", TEXT),
        "supplier_id": ("SUPPLIER", CODE),
        "brand_code": ("BRANDCODE", CODE),
        "profit_centre": ("PCL", CODE),
    }),
    "brand": ("BRAND", {
        "brand_id": ("BRANDID", CODE),
        "brand_code": ("BRANDCODE", CODE),
        "brand_name": ("BRANDNAME", TEXT),
        "parent_id": ("PARENTBRANDCODE", CODE),
        "brand_type": ("TYPE", CODE),
    }),
    "distributor": ("COMPANY", {
        "distributor_id": ("COMPANYID", CODE),
        "distributor_name": ("NAME", TEXT),
        "nav_name": ("NAV_NAME", TEXT),
        "nav_code": ("NAV_CODE", TEXT),
        "region": ("ADDRESS2", CODE),
    }),
    "account": ("RMD_ACLIST", {
        "account_id": ("ACID", CODE),
        "account_name": ("ACNAME", TEXT),
        "tax_no": ("VATNO", TEXT),
        "distributor_id": ("COMPANYID", CODE),
        "org_code": ("GEO", CODE),
        "address": ("ADDRESS", TEXT),
        "state_code": ("STATE", CODE),
        "channel_code": ("CHANNEL", CODE),
        "subchannel_code": ("SUBCHANNEL", CODE),
        "segment_code": ("SEGMENTTYPE", CODE),
        "party_kind": ("PTYPE", CODE),
        "is_common": ("COMMON", WHOLE),
        "customer_id": ("CUSTOMERID", CODE),
    }),
    "price_batch": ("BATCHPRICE_MASTER", {
        "product_id": ("MCODE", CODE),
        "batch": ("BATCHCODE", CODE),
        "price_id": ("PRICEID", CODE),
    }),
    "price": ("DETAILPRICE", {
        "price_id": ("PRICEID", CODE),
        "product_id": ("MCODE", CODE),
        "complementary_rate": ("COMPLEMENTARYRATE", AMOUNT),
        "selling_price": ("IMPSELLINGPRICEWITHVAT", AMOUNT),
    }),
    "case_unit": ("MULTIALTUNIT", {
        "product_id": ("MCODE", CODE),
        "unit": ("ALTUNIT", CODE),
        "factor": ("CONFACTOR", AMOUNT),
    }),
    "claim_tag": ("RMD_TRNMAIN_ADDITIONALINFO", {
        "voucher_no": ("VCHRNO", CODE),
        "distributor_id": ("COMPANYID", CODE),
        "claim_type": (CLAIM_TYPE_COLUMN, CODE),
    }),
    "claim_type": ("TYPE_MASTER", {
        "type_code": ("TYPECODE", CODE),
    }),
    "calendar": ("DATEMITI_FULL", {
        "day": ("AD", DAY),
        "local_date": ("MITI", TEXT),
        "local_year": ("SAL", WHOLE),
        "local_month": ("MAHINA", WHOLE),
        "local_day": ("GATE", WHOLE),
    }),
    "sales_node": ("SALESHIERARCHY_MASTER", {
        "node_id": ("ID", CODE),
        "node_name": ("NAME", TEXT),
        "node_code": ("CODE", CODE),
        "division": ("DIVISION", TEXT),
        "node_type": ("TYPE", CODE),
        "parent_id": ("PARENT", CODE),
        "status": ("STATUS", WHOLE),
    }),
    "node_account": ("SALESHIERARCHY_ACLIST", {
        "account_id": ("ACID", CODE),
        "node_id": ("SOCODE", CODE),
        "distributor_id": ("COMPANYID", CODE),
    }),
    "org_type": ("ORGANIZATION_TYPE_MASTER", {
        "org_code": ("ORGTYPECODE", CODE),
        "org_name": ("ORGTYPENAME", TEXT),
    }),
    "channel": ("CHANNEL_HIERARCHY_MASTER", {
        "channel_code": ("CHANNELCODE", CODE),
        "channel_type": ("CHANNELTYPE", CODE),
        "channel_name": ("CHANNELNAME", TEXT),
    }),
    "state": ("STATE_MASTER", {
        "state_code": ("STATECODE", CODE),
        "state_name": ("STATENAME", TEXT),
    }),
}


def schema(table: str) -> T.StructType:
    """The stored schema of one table."""
    _, columns = ERP_TABLES[table]
    return T.StructType([T.StructField(c, SPARK_TYPES[k]) for c, (_, k) in columns.items()])


class Model:
    """The tables of one database; a table's frame is built on first use."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        unknown = set(builders) - set(ERP_TABLES)
        if unknown:
            raise ValueError(f"not a table of the model: {sorted(unknown)}")
        self._builders = dict(builders)
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_") or table not in self._builders:
            raise AttributeError(table)
        if table not in self._frames:
            self._frames[table] = self._builders[table]()
        return self._frames[table]

    def tables(self) -> list[str]:
        return list(self._builders)
