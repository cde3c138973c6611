"""Reading an ERP export and storing it in the layout the reports want.

``read_erp`` is the import view: physical names become model names, code
columns are trimmed and upper-cased once.  ``store`` writes that view;
``open_store`` and ``open_tables`` read it back, so report filters meet plain
columns that Parquet can push down and prune.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.sources.model import CLAIM_TYPE_COLUMN, CODE, ERP_TABLES, SPARK_TYPES, Model, schema

#: big tables and the key their joins use
VOUCHER_TABLES = (
    "sales_voucher",
    "sales_line",
    "ledger_voucher",
    "ledger_line",
    "purchase_voucher",
    "purchase_line",
    "claim_tag",
)


def _import_view(raw: DataFrame, table: str, claim_type_column: str) -> DataFrame:
    physical = {c.upper(): c for c in raw.columns}
    columns = []
    for name, (source, kind) in ERP_TABLES[table][1].items():
        if source == CLAIM_TYPE_COLUMN:
            source = claim_type_column.upper()
        value = F.col(f"`{physical[source]}`").cast(SPARK_TYPES[kind])
        columns.append((F.upper(F.trim(value)) if kind == CODE else value).alias(name))
    return raw.select(columns)


def read_erp(read: Callable[[str], DataFrame], claim_type_column: str) -> Model:
    """Model over raw ERP tables; ``read`` gets a physical table name."""
    return Model({
        table: lambda table=table, erp=erp: _import_view(read(erp), table, claim_type_column)
        for table, (erp, _) in ERP_TABLES.items()
    })


def read_erp_folder(spark: SparkSession, folder: str, claim_type_column: str, fmt: str = "parquet") -> Model:
    """Model over a folder holding one sub-folder or file per physical table."""
    root = folder.rstrip("/")
    return read_erp(lambda erp: spark.read.format(fmt).load(f"{root}/{erp}"), claim_type_column)


def store(model: Model, folder: str, mode: str = "error") -> None:
    """Write the model as plain Parquet folders."""
    for table in model.tables():
        getattr(model, table).write.mode(mode).parquet(f"{folder.rstrip('/')}/{table}")


def open_store(spark: SparkSession, folder: str) -> Model:
    root = folder.rstrip("/")
    return Model({
        table: lambda table=table: spark.read.schema(schema(table)).parquet(f"{root}/{table}")
        for table in ERP_TABLES
    })


def store_tables(model: Model, database: str, buckets: int, mode: str = "error") -> None:
    """Write the model as catalog tables.

    Voucher headers, lines and claim tags share one bucketing on the voucher
    number, so the header-to-line join every report makes needs no shuffle.
    ``buckets`` should give files of a few hundred MB.
    """
    for table in model.tables():
        writer = getattr(model, table).write.mode(mode).format("parquet")
        if table in VOUCHER_TABLES:
            writer = writer.bucketBy(buckets, "voucher_no").sortBy("voucher_no")
        writer.saveAsTable(f"{database}.{table}")


def open_tables(spark: SparkSession, database: str) -> Model:
    return Model({table: lambda table=table: spark.table(f"{database}.{table}") for table in ERP_TABLES})
