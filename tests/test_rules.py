"""Hand-made rows for the rules that are easy to get wrong."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.tiny import calendar, day, line, rows, shop, tiny_model, voucher
from tradeloom.functions.measures import cases, cases_or_none, units, whole
from tradeloom.operators import calendar as cal
from tradeloom.operators.claims import claims_vs_sales
from tradeloom.operators.hierarchy import register_user_hierarchy, user_hierarchy
from tradeloom.params import ClaimKind, ClaimRequest, DashboardScope, OutletRequest, StockRequest
from tradeloom.plans.billwise import claim_billwise
from tradeloom.plans.brands import brand_contribution
from tradeloom.plans.claims import claim_print, claim_summary
from tradeloom.plans.kpis import month_grid, primary_secondary
from tradeloom.plans.outlets import outlet_master
from tradeloom.plans.status import claim_sales, overall_status
from tradeloom.plans.stock import stock_summary
from tradeloom.plans.top_ten import top_parties, top_skus
from tradeloom.plans.transport import transport_claim

RANGE = (day("2000-01-01"), day("2000-03-31"))


def claim_shop(spark, bills, lines, tags):
    return tiny_model(spark, **shop(
        sales_voucher=bills, sales_line=lines,
        claim_tag=[dict(voucher_no=v, distributor_id="A", claim_type=t) for v, t in tags],
        account=[dict(account_id="PA1", account_name="Party", tax_no="T1")],
    ))


def test_cases_with_missing_and_zero_factor(spark):
    df = spark.sql("SELECT CAST(f AS decimal(18,4)) AS f FROM VALUES (12), (0), (NULL) AS t(f)")
    seven = units(F.lit(7).cast("decimal(18,4)"))
    got = df.select(cases(seven, F.col("f")).alias("a"), cases_or_none(seven, F.col("f")).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(D("0.583333333333"), D("0.583333333333")), (7, 0), (7, 0)]


def test_whole_rounds_halves_away_from_zero(spark):
    df = spark.sql("SELECT CAST(x AS decimal(38,12)) AS x FROM VALUES (0.5), (-0.5), (1.499999999999), (2.4) AS t(x)")
    assert [r[0] for r in df.select(whole(F.col("x"))).collect()] == [1, -1, 2, 2]


def local_span(first: tuple[int, int], last: tuple[int, int]) -> tuple[dt.date, dt.date]:
    """Days of the local months from ``first`` to ``last``, as (year, month)."""
    lag = dt.timedelta(days=103)
    year, month = last[0] - 57 + last[1] // 12, last[1] % 12 + 1
    return dt.date(first[0] - 57, first[1], 1) + lag, dt.date(year, month, 1) + lag - dt.timedelta(days=1)


@pytest.mark.parametrize("anchor, month, previous, opening", [
    # The month before, taken from last year; before month 1 comes month 12 of last year.
    ("2000-04-20", (2057, 1), (2056, 12), (2056, 11)),
    ("2000-05-20", (2057, 2), (2056, 1), (2056, 12)),
    ("2000-11-20", (2057, 8), (2056, 7), (2057, 6)),
    ("2000-12-20", (2057, 9), (2056, 8), (2057, 7)),
    ("2000-03-20", (2056, 12), (2055, 11), (2056, 10)),
])
def test_windows_wrap_around_the_year(spark, anchor, month, previous, opening):
    frame = tiny_model(spark, calendar=calendar()).calendar
    found = cal.resolve_windows(frame, day(anchor), ["month", "previous_month_last_year", "three_months"])
    assert (found["month"].first, found["month"].last) == local_span(month, month)
    last_year = found["previous_month_last_year"]
    assert (last_year.first, last_year.last) == local_span(previous, previous)
    assert (found["three_months"].first, found["three_months"].last) == local_span(opening, month)


@pytest.mark.parametrize("anchor, first, last", [
    ("2000-11-20", "1999-12-13", "2000-12-12"),  # local month 8 belongs to the fiscal year before
    ("2000-12-20", "2000-12-13", "2001-12-12"),  # local month 9 opens one
])
def test_fiscal_year_opens_in_local_month_nine(spark, anchor, first, last):
    frame = tiny_model(spark, calendar=calendar()).calendar
    grid = cal.fiscal_grid(frame, day(anchor)).orderBy("ordinal").collect()
    assert [r.window for r in grid] == list(cal.FISCAL_MONTHS)
    assert (str(grid[0].first), str(grid[-1]["last"])) == (first, last)


def test_anchor_outside_the_calendar(spark):
    model = tiny_model(spark, **shop(
        calendar=calendar(), sales_voucher=[voucher("S1", "2000-06-15")], sales_line=[line("S1", "M1", 12)],
    ))
    scope = DashboardScope(day("2030-01-01"))
    assert rows(top_skus(model, scope)) == []
    assert all(r["currents"] is None and r["achievement_percent"] == 0 for r in rows(primary_secondary(model, scope)))
    assert all(r["poush"] is None for r in rows(month_grid(model, scope)))


def test_gross_up_by_claim_type(spark):
    model = claim_shop(
        spark,
        [voucher(f"C{i}", "2000-02-01", ref=f"S{i}") for i in range(5)],
        [line(f"C{i}", "M3", 1) for i in range(5)],
        [("C0", "AC"), ("C1", "PP"), ("C2", "MKB"), ("C3", "ZZ")],
    )
    got = {r["claim_type"]: r["amount"] for r in rows(claims_vs_sales(model, ClaimRequest(*RANGE)))}
    # 8.50 as it is, or divided by 0.85; an unknown type is no claim but still a sale.
    assert got == {"AC": D("8.50"), "PP": D("10.00"), "MKB": D("10.00"), None: D("0.00")}


def test_return_larger_than_the_claim_is_negative(spark):
    model = claim_shop(
        spark,
        [voucher("S1", "2000-01-05"), voucher("C1", "2000-02-01", ref="  S1 "),
         voucher("R1", "2000-02-05", "CN", " C1 ")],
        [line("S1", "M3", 9), line("C1", "M3", 1), line("R1", "M3", back=3)],
        [("C1", "PP")],
    )
    summary = claim_summary(model, ClaimRequest(*RANGE, claimtype=0))
    assert [(r["pp"], r["nev"], r["total"]) for r in rows(summary["detail"])] == [(D("-20.00"), 0, D("-20.00"))]
    assert summary.criteria == "@As On Dated : 01-01-2000 - 03-31-2000"
    printed = rows(claim_print(model, ClaimRequest(*RANGE, claimtype=0)))
    assert [(r["product_name"], r["total"], r["fflg"]) for r in printed] == [
        ("None", -20, "R"), ("\n\r", None, "R"), ("Total", -20, "B"), ("Less: TDS (15%)", -3, "R"),
        ("Net Amount", -17, "B"),
    ]


def test_amounts_that_cancel_are_dropped(spark):
    model = claim_shop(
        spark,
        [voucher("C1", "2000-02-01"), voucher("C2", "2000-02-02"), voucher("R2", "2000-02-05", "CN", "C2")],
        [line("C1", "M3", 1), line("C2", "M3", 1), line("R2", "M3", back=2)],
        [("C1", "TVB"), ("C2", "TEX")],
    )
    summary = claim_summary(model, ClaimRequest(*RANGE, claimtype=ClaimKind.TIE_UP))
    assert rows(summary["detail"]) == [] and rows(summary["total"]) == []
    assert [r["product_name"] for r in rows(claim_print(model, ClaimRequest(*RANGE, claimtype=3)))] == ["\n\r"]


def test_sales_total_adds_outlet_promotion_the_detail_does_not(spark):
    model = claim_shop(
        spark, [voucher("C1", "2000-02-01"), voucher("C2", "2000-02-02")],
        [line("C1", "M3", 1), line("C2", "M3", 2)], [("C1", "PP"), ("C2", "OP")],
    )
    summary = claim_summary(model, ClaimRequest(*RANGE, claimtype=0))
    assert [r["total"] for r in rows(summary["detail"])] == [D("10.00")]
    assert [r["total"] for r in rows(summary["total"])] == [D("30.00")]


def test_one_sale_claimed_twice_counts_its_cases_twice(spark):
    model = claim_shop(
        spark,
        [voucher("S1", "2000-01-05"), voucher("C1", "2000-02-01", ref="S1"), voucher("C2", "2000-02-02", ref="S1"),
         voucher("S2", "2000-01-06")],
        [line("S1", "M3", 6), line("C1", "M3", 1), line("C2", "M3", 1), line("S2", "M3", 4)],
        [("C1", "MKB"), ("C2", "MKB")],
    )
    got = {r["claim_type"]: (r["pieces"], r["cases"]) for r in rows(claims_vs_sales(model, ClaimRequest(*RANGE)))}
    # The two claim bills and S2 are sales nobody claims on: 1 + 1 + 4 cases.
    assert got == {"MKB": (2, 12), None: (0, 6)}
    broken = rows(claim_summary(model, ClaimRequest(*RANGE, claimtype=9))["total"])[0]
    assert (broken["sales_cs"], broken["breakage_pcs"], broken["breakage_amount"], broken["approved_bonus"]) == (
        18, 2, D("20.00"), 180)
    assert broken["approved_budget"] == D("156.521736")


def test_sales_of_unlisted_companies_are_one_unknown_company(spark):
    model = claim_shop(
        spark, [voucher("X1", "2000-01-05", company="X"), voucher("Y1", "2000-01-06", company="Y")],
        [line("X1", "M1", out=12), line("Y1", "M1", out=24)], [])
    detail = rows(claim_summary(model, ClaimRequest(*RANGE, claimtype=5))["detail"])
    assert [(r["product_name"], r["distributor_code"], r["sales_cs"]) for r in detail] == [("Twelve", None, 36)]


def test_each_claim_report_has_its_own_default_layout(spark):
    model = tiny_model(spark, **shop())
    assert "bc" in claim_summary(model, ClaimRequest(*RANGE))["detail"].columns
    assert {"pp", "nev"} <= set(claim_print(model, ClaimRequest(*RANGE)).columns)


def test_claims_on_an_empty_range(spark):
    model = claim_shop(spark, [], [], [])
    request = ClaimRequest(*RANGE, claimtype=5)
    total = rows(claim_summary(model, request)["total"])
    assert len(total) == 1 and total[0]["sales_cs"] is None
    assert [r["product_name"] for r in rows(claim_print(model, request))] == ["\n\r", "Total"]
    assert rows(claim_summary(model, ClaimRequest(*RANGE, claimtype=1))["total"]) == []


def test_billwise_reference_inside_and_outside_the_range(spark):
    model = claim_shop(
        spark,
        [voucher("S1", "2000-01-05"), voucher("S2", "1999-12-30"), voucher("C1", "2000-02-01", ref=" S1 "),
         voucher("C2", "2000-02-02", ref="S2", profit_centre="PC001"), voucher("R1", "2000-02-03", "CN", "C1")],
        [line("S1", "M1", 24), line("S2", "M1", 24), line("C1", "M1", 12), line("C2", "M1", 12),
         line("R1", "M1", back=2)],
        [("C1", "PP"), ("C2", "AC")],
    )
    report = claim_billwise(model, ClaimRequest(*RANGE))
    got = [(r["product_name"], r["ref_bill_no"], r["qty"], r["comp_qty"], r["comp_amount"], r["tds_15"],
            r["total_amount"]) for r in rows(report["detail"])]
    assert got == [
        ("Twelve", "S1", 24, 10, D("100.00"), D("17.65"), D("117.65")),
        ("Total >>", None, 24, 10, D("100.00"), D("17.65"), D("117.65")),
        ("Twelve", None, None, 12, D("120.00"), D("0.00"), D("120.00")),
        ("Total >>", None, None, 12, D("120.00"), D("0.00"), D("120.00")),
    ]


def test_filters_by_company_and_supplier_lists(spark):
    model = claim_shop(
        spark, [voucher("C1", "2000-02-01"), voucher("C2", "2000-02-02", company="B")],
        [line("C1", "M3", 1), line("C2", "M1", 12)], [("C1", "BC"), ("C2", "BC")],
    )
    # No supplier account is listed, so naming one leaves nothing.
    assert rows(claim_summary(model, ClaimRequest(*RANGE, acid="SU2"))["detail"]) == []
    only_b = rows(claim_summary(model, ClaimRequest(*RANGE, companyid="b , x"))["detail"])
    assert [(r["distributor_code"], r["nav_code"], r["total"]) for r in only_b] == [("B", None, D("141.18"))]


SALES = dict(
    calendar=calendar(),
    sales_voucher=[
        voucher("S1", "2000-06-15", billed_to="PA2"), voucher("S2", "2000-06-20", company="B", party_id="PA3"),
        voucher("S3", "1999-06-20"), voucher("S4", "2000-06-16", profit_centre="PC001"),
        voucher("R1", "2000-07-01", "CN"),
    ],
    sales_line=[line("S1", "M1", 30), line("S2", "M2", 4), line("S3", "M1", 12), line("S4", "M1", 600),
                line("R1", "M1", back=6), line("S1", "M3", 2, batch="UNPRICED")],
    account=[
        dict(account_id="PA1", account_name="One", org_code="123456-4"),
        dict(account_id="PA2", account_name="Two", tax_no="T2", org_code="111111-1"),
        dict(account_id="PA3", account_name="Three", org_code="123456-4"),
    ],
    org_type=[dict(org_code="123456-4", org_name="W"), dict(org_code="111111-1", org_name="R")],
    claim_tag=[dict(voucher_no="S2", distributor_id="B", claim_type="PP"),
               dict(voucher_no="R1", distributor_id="A", claim_type="ZZ")],
    sales_node=[
        dict(node_id="U1", node_type="USER", status=1, node_code="U1"),
        dict(node_id="T1", node_type="AREA", status=1, node_code="T1", parent_id="U1"),
        dict(node_id="T2", node_type="AREA", status=0, node_code="T2", parent_id="U1"),
        dict(node_id="G2", node_type="BEAT", status=1, node_code="G2", parent_id="T2"),
        dict(node_id="U2", node_type="USER", status=1, node_code="U2", parent_id="T1"),
    ],
    node_account=[
        dict(account_id="X1", node_id="T1", distributor_id="A"), dict(account_id="X2", node_id="T1", distributor_id="A"),
        dict(account_id="X3", node_id="G2", distributor_id="B"), dict(account_id="X4", node_id="U2", distributor_id="B"),
    ],
)
SCOPE = DashboardScope(day("2000-06-15"))


@pytest.fixture(scope="module")
def sales(spark):
    return tiny_model(spark, **shop(**SALES))


def test_hierarchy_cuts_inactive_branches_and_repeats_no_node(sales):
    assert {(r["id"], r["acid"]) for r in rows(user_hierarchy(sales))} == {("T1", "X1"), ("T1", "X2"), ("U2", "X4")}
    assert len(rows(user_hierarchy(sales))) == 3
    assert [r["id"] for r in rows(user_hierarchy(sales, type="user "))] == ["U2"]


def test_hierarchy_as_sql_table_function_equals_the_dataframe_call(sales):
    spark = sales.sales_node.sparkSession
    name = register_user_hierarchy(sales)

    def same(query, **arguments):
        expected = user_hierarchy(sales, **arguments)
        got = spark.sql(query)
        assert got.columns == expected.columns
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
        return len(got.collect())

    assert same(f"SELECT * FROM {name}()") == 3
    assert same(f"SELECT * FROM {name}('user ')", type="user ") == 1
    assert same(f"SELECT * FROM {name}(id => ' t1')", id=" t1") == 2
    assert same(f"SELECT * FROM {name}(type => 'USER', id => 'T1')", type="USER", id="T1") == 0
    assert same(f"SELECT * FROM {name}(id => ' %')", id=" %") == 3
    assert spark.sql(f"SELECT * FROM {name}(NULL)").count() == 0


def test_restricted_sums_repeat_per_account(sales):
    def year(**more):
        return {r["sku"]: r["ytd"] for r in rows(top_skus(sales, DashboardScope(SCOPE.date, **more)))}

    # 24 net pieces in cases of 12, and pieces counted as cases.
    assert year() == {"Twelve": 2, "Zero": 4, "None": 2}
    assert year(id="T1") == {"Twelve": 4, "None": 4}
    assert year(id="T1", distinct_companies=True) == {"Twelve": 2, "None": 2}
    assert year(id="admin", region="west") == {"Zero": 4}
    assert year(id="T1", distributor="B") == {}


def test_party_without_tax_number_has_no_name(sales):
    got = {r["party"]: (r["ytd"], r["ly_ytd"]) for r in rows(top_parties(sales, SCOPE))}
    # S1 goes to the account billed; the rest have no tax number: -0.5 + 4 cases.
    assert got == {"Two (T2)": (5, 0), None: (4, 1)}
    assert {r["party"] for r in rows(top_parties(sales, SCOPE, mcode="m2,m9"))} == {None}


def test_overall_status_counts(sales):
    got = [(r["items"], r["day"], r["month"], r["qtd"]) for r in rows(overall_status(sales, SCOPE))]
    assert got == [
        ("Bill No.", 1, 3, 3), ("SKU No.", 2, 3, 3), ("Quantity(Case)", 5, 8, 8), ("WS no(Unique Party)", 0, 2, 2),
        ("Retail no(Unique)", 1, 1, 1), ("WS qty(Case)", 0, 4, 4), ("WS qty(Case)", 5, 5, 5),
    ]


def test_claim_sales_lists_ordinary_bills_first(sales):
    got = rows(claim_sales(sales, SCOPE))
    assert [(r["category"], r["bill_cut_day"], r["bill_cut_qtd"], r["cases_qtd"], r["total_amount_qtd"])
            for r in got] == [
        # Two cases at a piece rate of 10; the unpriced batch is out, the credit note is no bill.
        ("Normal Bills", 1, 1, 2, 20), ("PP", 0, 1, 4, 68), ("TOTAL", 1, 2, 6, 88),
    ]


def test_brand_shares_add_up_and_total_is_one_hundred(sales):
    got = rows(brand_contribution(sales, SCOPE))
    assert [(r["segment"], r["ytd"], r["ly_ytd"], r["ly_mtd"]) for r in got] == [
        ("Vertical", 100, 100, 100), ("Total", 100, 100, 100)]
    scoped = rows(brand_contribution(sales, DashboardScope(SCOPE.date, id="T1")))
    assert [(r["segment"], r["ytd"]) for r in scoped] == [("One", 100), ("Total", 100)]
    assert rows(brand_contribution(sales, DashboardScope(SCOPE.date, region="nowhere"))) == []


def test_outlet_cases_without_factor_are_zero(spark):
    model = tiny_model(spark, **shop(
        sales_voucher=[voucher("S1", "2000-02-01"), voucher("R1", "2000-02-02", "CN"),
                       voucher("S2", "2000-02-01", company="CENTRAL")],
        sales_line=[line("S1", "M1", 24, net_amount=10), line("S1", "M3", 5), line("R1", "M1", back=6, net_amount=3),
                    line("S2", "M1", 9)],
        account=[dict(account_id="PA1", account_name="Shop", distributor_id="A", party_kind="C"),
                 dict(account_id="PA1", account_name="Shop", distributor_id="CENTRAL", is_common=1),
                 dict(account_id="XX1", account_name="Other", distributor_id="A", party_kind="C")],
    ))
    got = rows(outlet_master(model, OutletRequest(*RANGE))["detail"])
    assert [(r["outlet_name"], r["no_of_bills"], r["total_sales"]) for r in got] == [("Shop", 1, D("1.500000"))]
    office = rows(outlet_master(model, OutletRequest(*RANGE, companyid="central"))["detail"])
    assert [r["distributor_code"] for r in office] == ["CENTRAL"]


def test_stock_buckets_and_closing(spark):
    ledger = [("O1", "1999-12-01", "OP", "M1", 0, 120), ("P1", "2000-01-10", "PI", "M1", 0, 60),
              ("S0", "1999-12-20", "TI", "M1", 12, 0), ("S1", "2000-02-01", "TI", "M1", 24, 0),
              ("C1", "2000-02-02", "TI", "M1", 12, 0), ("C2", "2000-02-02", "TI", "M1", 36, 0),
              ("R1", "2000-02-03", "CN", "M1", 0, 12), ("S9", "2000-04-01", "TI", "M1", 12, 0),
              ("P2", "2000-01-10", "PI", "M3", 0, 60)]
    model = tiny_model(spark, **shop(
        ledger_voucher=[dict(voucher_no=v, posted_on=day(on), voucher_type=kind, distributor_id="A",
                             profit_centre="PC007", fiscal_year="56/57") for v, on, kind, *_ in ledger],
        ledger_line=[dict(voucher_no=v, distributor_id="A", product_id=p, batch="B0", qty_out=out, qty_in=into)
                     for v, _, _, p, out, into in ledger],
        claim_tag=[dict(voucher_no="C1", distributor_id="A", claim_type="OP"),
                   dict(voucher_no="C2", distributor_id="A", claim_type="MKB")],
        account=[dict(account_id="SU1")],
    ))
    request = StockRequest(*RANGE, phiscalid="56/57", acid="su1,su7")
    report = stock_summary(model, request)
    got = rows(report["detail"])
    assert len(got) == 1
    figures = {k: got[0][k] for k in ("opening", "purchase", "sales", "op", "pp", "closing")}
    # Breakage claims are other sales: 24 + 36 - 12 pieces.
    assert figures == {"opening": 9, "purchase": 5, "sales": 4, "op": 1, "pp": 0, "closing": 9}
    assert got[0]["closing"] == got[0]["opening"] + got[0]["purchase"] - got[0]["sales"] - got[0]["op"]
    assert rows(report["total"])[0]["closing"] == 9
    assert [r["closing"] for r in rows(stock_summary(model, StockRequest(*RANGE, phiscalid="56/57"))["detail"])] == [0, 9]
    assert report.name == "Claim Report - Stock Summary"


def test_transport_claim_prints_text(spark):
    model = tiny_model(spark, **shop(
        purchase_voucher=[dict(voucher_no="P1", posted_on=day("2000-02-01"), distributor_id="A",
                               profit_centre="PC007")],
        purchase_line=[dict(voucher_no="P1", product_id="M1", qty_in=1500, rate=10.125, maker_id="SU1"),
                       dict(voucher_no="P1", product_id="M2", qty_in=1, rate=1, maker_id="SU1")],
        receipt=[dict(voucher_no="I1", ref_no="P1")],
        transit_loss=[dict(voucher_no="I1", product_id="M1", maker_id="SU1", leakage=100, shortage=1)],
        consignment=[dict(voucher_no="I1", delivery_note="D1", carrier="Road")],
    ))
    got = rows(transport_claim(model, ClaimRequest(*RANGE)))
    assert [r["delivery_note"] for r in got] == ["D1", "\n\r", "TOTAL"]
    first, _, total = got
    assert (first["invoice_date"], first["invoice_qty"], first["dispatch_rate"], first["carton"], first["amount"]) == (
        "2000-02-01", "1,500.00", "10.13", "0.00", "1,022.63")
    assert (total["leakage"], total["amount"], total["dispatch_rate"]) == ("100.00", "1,022.63", None)
    assert [r["delivery_note"] for r in rows(transport_claim(model, ClaimRequest(*RANGE, companyid="B")))] == [
        "\n\r", "TOTAL"]
