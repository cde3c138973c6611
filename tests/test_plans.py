"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as registered
from tests.tiny import day
from tradeloom.operators.facts import sold_units
from tradeloom.params import ClaimRequest, DashboardScope
from tradeloom.plans import top_ten
from tradeloom.plans.claims import claim_summary
from tradeloom.report import read_report
from tradeloom.sources.erp import open_store, open_tables, read_erp_folder, store, store_tables
from tradeloom.sources.model import CLAIM_TYPE_COLUMN, ERP_TABLES, Model
from tradeloom.sources.retail import retail_model


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def without_broadcast(spark):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for s in settings:
        spark.conf.set(s, "-1")
    yield spark
    for s in settings:
        spark.conf.unset(s)


@pytest.mark.parametrize("name", registered.reports())
def test_no_cross_join_and_no_forced_broadcast(without_broadcast, small_data, name):
    """Every join of a report has keys and a way that needs no broadcast.

    The training-data operators are checked in their own tests: they store stages before the last
    plan is made, and some broadcast a side whose size they have counted first.
    """
    plan = physical(registered.reports()[name](without_broadcast, small_data))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BroadcastHashJoin" not in plan
    assert "Python" not in plan


@pytest.mark.parametrize("name", ["claim_billwise", "claim_print_breakage", "claim_sales", "transport_claim"])
def test_details_and_totals_share_their_shuffles(spark, small_data, name):
    df = registered.queries()[name](spark, small_data)
    df.collect()
    assert "ReusedExchange" in physical(df).split("== Initial Plan ==")[0]


def test_print_layout_leaves_the_sales_out(spark, small_data):
    """A layout without sales columns reads claim and return lines, not all sales."""
    typed = physical(registered.queries()["claim_print_outlet"](spark, small_data))
    whole = physical(registered.queries()["claim_print_breakage"](spark, small_data))
    assert "FullOuter" not in typed and "FullOuter" in whole


@pytest.mark.parametrize("name", [
    "claims_vs_sales", "claim_pivot", "claim_print_breakage", "claim_billwise", "claim_summary_sales",
])
def test_claim_reports_read_the_lines_once(spark, small_data, name):
    """The lines were joined and stored before; no branch of the report reads and deals them again."""
    assert "l_orderkey" not in physical(registered.reports()[name](spark, small_data))


@pytest.fixture(scope="module")
def stored(spark, small_data, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("store") / "model")
    store(retail_model(spark, small_data), folder)
    return folder


def test_filters_reach_the_stored_vouchers(spark, stored):
    """Literal window bounds, centre and type are pushed to Parquet; only used columns are read."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = physical(top_ten.top_skus(open_store(spark, stored), DashboardScope(day("2000-06-15"))))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "/sales_voucher" in line)
    assert "GreaterThanOrEqual(posted_on,1999-04-14)" in scan and "EqualTo(profit_centre,PC007)" in scan
    read = re.search(r"ReadSchema: struct<(.*?)>", scan).group(1)
    assert read == "voucher_no:string,posted_on:date,distributor_id:string,profit_centre:string"
    lines = next(line for line in plan.splitlines() if "FileScan" in line and "/sales_line" in line)
    assert "ReadSchema: struct<voucher_no:string,product_id:string,qty_out:decimal(18,4),qty_in:decimal(18,4)>" in lines


def test_stored_model_gives_the_same_report(spark, small_data, stored):
    request = ClaimRequest(day("1996-01-01"), day("2000-12-31"), claimtype=0)
    fresh = claim_summary(retail_model(spark, small_data), request)["detail"]
    again = claim_summary(open_store(spark, stored), request)["detail"]
    assert sorted(map(str, again.collect())) == sorted(map(str, fresh.collect()))


def test_bucketed_tables_join_without_a_shuffle(without_broadcast, stored):
    spark = without_broadcast
    spark.sql("CREATE DATABASE IF NOT EXISTS loom_plans")
    full = open_store(spark, stored)
    store_tables(
        Model({t: lambda t=t: getattr(full, t) for t in ERP_TABLES}), "loom_plans", buckets=4, mode="overwrite"
    )
    model = open_tables(spark, "loom_plans")
    vouchers = model.sales_voucher.filter("voucher_type = 'TI'").select("voucher_no", "posted_on")
    joined = vouchers.join(model.sales_line.select("voucher_no", sold_units().alias("units")), "voucher_no")
    plan = physical(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == full.sales_line.join(full.sales_voucher.filter("voucher_type = 'TI'"), "voucher_no").count()


def test_raw_export_is_normalised_once(spark, stored, tmp_path):
    """Physical names, stray case and blanks disappear on import."""
    full = open_store(spark, stored)
    for table, (erp, columns) in ERP_TABLES.items():
        raw = getattr(full, table).selectExpr(*[
            (f"concat(' ', lower({name}), '  ')" if kind == "code" else name)
            + f" AS {'EXPENSE_TYPE' if source == CLAIM_TYPE_COLUMN else source.capitalize()}"
            for name, (source, kind) in columns.items()
        ])
        raw.write.parquet(f"{tmp_path}/{erp}")
    model = read_erp_folder(spark, str(tmp_path), claim_type_column="expense_type")
    scope = DashboardScope(day("2000-06-15"))
    assert top_ten.top_parties(model, scope).collect() == top_ten.top_parties(full, scope).collect()


def test_report_frames_are_written_by_name(spark, stored, tmp_path):
    request = ClaimRequest(day("1996-01-01"), day("2000-12-31"), claimtype=1)
    claim_summary(open_store(spark, stored), request).write(str(tmp_path / "out"))
    assert read_report(spark, str(tmp_path / "out"))["total"].count() == 1


def test_report_sink_commits_title_criteria_and_frames_at_once(spark, stored, tmp_path):
    model = open_store(spark, stored)
    folder = str(tmp_path / "sink")
    with pytest.raises(FileNotFoundError):
        read_report(spark, folder)
    first = claim_summary(model, ClaimRequest(day("1996-01-01"), day("2000-12-31"), claimtype=1))
    first.write(folder)
    back = read_report(spark, folder)
    assert (back.name, back.criteria, list(back.frames)) == (first.name, first.criteria, list(first.frames))
    for frame, df in first.frames.items():
        assert sorted(back[frame].collect()) == sorted(df.collect())
    with pytest.raises(FileExistsError):
        first.write(folder)

    # An interrupted attempt: frames written, its manifest still uncommitted.
    (tmp_path / "sink" / "attempt-zzz" / "total").mkdir(parents=True)
    pending = tmp_path / "sink" / "_manifest" / "attempt-zzz" / "_temporary" / "0"
    pending.mkdir(parents=True)
    (pending / "part-0.json").write_text(
        '{"name":"x","criteria":"x","attempt":"attempt-zzz","committed_at":9000000000000000000,"frames":["total"]}\n'
    )
    assert read_report(spark, folder).criteria == first.criteria

    second = claim_summary(model, ClaimRequest(day("1998-01-01"), day("1998-12-31"), claimtype=1))
    second.write(folder, mode="overwrite")
    again = read_report(spark, folder)
    assert again.criteria == second.criteria != first.criteria
    assert sorted(again["detail"].collect()) == sorted(second["detail"].collect())
