"""The model derived from a plain order-and-lineitem star schema.

Used for tests, the correctness run and the benchmark: every table of the model
is computed by Spark from whole source tables, so work grows with them.  Orders
become sale, claim, return and purchase vouchers; rules depend on attributes of
the source rows only.
"""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.sources.model import Model, schema

# Fixed values of this derivation: the claim type of a claim bill by the month of its order.
CLAIM_TYPE_BY_MONTH = "'PP','OP','NEV','TVB','TEX','BC','AC','MKB','ZZ','PP','AC','OP'"
CLAIM_BILL = "o_orderpriority IN ('1-URGENT', '2-HIGH')"
RETURN_BILL = "o_orderstatus = 'F'"
CALENDAR_LAG = 103
LOCAL_YEAR_OFFSET = 57

BATCH = "CASE WHEN l_linenumber < 3 THEN 'B0' WHEN l_linenumber < 5 THEN 'B1' ELSE 'B2' END"
CENTRE = "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'PC001' ELSE 'PC007' END"


# The source columns in use.  Naming them spares a look at every file's footer.
SOURCE_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_returnflag string, l_linestatus string",
}


def _shape(df: DataFrame, table: str, **columns: str) -> DataFrame:
    """Project to the stored schema; columns not named are NULL."""
    return df.selectExpr(*[
        f"CAST({columns.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema(table)
    ])


def _union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def retail_model(spark: SparkSession, folder: str) -> Model:
    @cache
    def source(name: str) -> DataFrame:
        return spark.read.schema(SOURCE_COLUMNS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")

    @cache
    def orders() -> DataFrame:
        """Orders with the nation of their customer."""
        buyers = source("customer").select("c_custkey", "c_nationkey")
        return source("orders").withColumn("o_day", F.col("o_orderdate").cast("date")).join(
            buyers, F.col("o_custkey") == F.col("c_custkey")
        )

    def sales_voucher() -> DataFrame:
        base = orders()
        shared = dict(
            party_id="concat('PA', o_custkey)",
            posted_at="concat(substr(o_orderpriority, 1, 1), ':00')",
            distributor_id="concat('N', c_nationkey)",
            profit_centre=CENTRE,
        )
        sale = _shape(
            base, "sales_voucher", **shared,
            voucher_no="concat('S', o_orderkey)", voucher_type="'TI'", posted_on="o_day",
            billed_to="CASE WHEN o_orderstatus = 'P' THEN concat('PA', c_nationkey) END",
        )
        claim = _shape(
            base.filter(CLAIM_BILL), "sales_voucher", **shared,
            voucher_no="concat('C', o_orderkey)", voucher_type="'TI'", posted_on="date_add(o_day, 9)",
            ref_no="concat('  S', o_orderkey, ' ')",
        )
        refund = _shape(
            base.filter(RETURN_BILL), "sales_voucher", **shared,
            voucher_no="concat('R', o_orderkey)", voucher_type="'CN'", posted_on="date_add(o_day, 20)",
            ref_no="concat(CASE WHEN o_orderpriority = '1-URGENT' THEN ' C' ELSE ' S' END, o_orderkey, ' ')",
        )
        return _union(sale, claim, refund)

    def sales_line_from(lines: DataFrame, table: str, **extra: str) -> DataFrame:
        shared = dict(product_id="concat('M', l_partkey)", batch=BATCH, **extra)
        sale = _shape(
            lines, table, **shared, voucher_no="concat('S', l_orderkey)",
            qty_out="l_quantity", alt_out="round(l_quantity / 12, 4)", qty_in="0", alt_in="0",
            net_amount="cast(l_extendedprice AS decimal(18,2))",
        )
        claim = _shape(
            lines.filter("l_linestatus = 'O'"), table, **shared, voucher_no="concat('C', l_orderkey)",
            qty_out="ceil(l_quantity / 10)", alt_out="round(ceil(l_quantity / 10) / 12D, 4)",
            qty_in="0", alt_in="0", net_amount="0",
        )
        refund = _shape(
            lines.filter("l_returnflag = 'R'"), table, **shared, voucher_no="concat('R', l_orderkey)",
            qty_out="0", alt_out="0", qty_in="floor(l_quantity / 5)",
            alt_in="round(floor(l_quantity / 5) / 12D, 4)",
            net_amount="cast(l_extendedprice AS decimal(18,2))",
        )
        return _union(sale, claim, refund)

    def purchase_line_from(lines: DataFrame, table: str, **extra: str) -> DataFrame:
        return _shape(
            lines, table, **extra, voucher_no="concat('P', l_orderkey)",
            product_id="concat('M', l_partkey)", batch=BATCH,
            qty_out="CASE WHEN l_returnflag = 'R' THEN floor(l_quantity / 7) ELSE 0 END",
            qty_in="l_quantity + 1", rate="cast(l_extendedprice AS decimal(18,2))",
            maker_id="concat('SU', l_suppkey)",
        )

    def purchase_voucher() -> DataFrame:
        return _shape(
            orders(), "purchase_voucher",
            voucher_no="concat('P', o_orderkey)", posted_on="date_sub(o_day, 7)",
            distributor_id="concat('N', c_nationkey)", profit_centre=CENTRE,
        )

    @cache
    def opening_years() -> tuple[int, int]:
        """First and last year whose fiscal year a voucher of the given orders falls into."""
        def year(day: str) -> str:
            return f"year(date_sub({day}, {CALENDAR_LAG})) - if(month(date_sub({day}, {CALENDAR_LAG})) >= 4, 0, 1)"

        first, last = orders().selectExpr(f"min({year('date_sub(o_day, 7)')})", f"max({year('o_day')})").head()
        return (first, last) if first is not None else (1, 0)

    def openings() -> DataFrame:
        first, last = opening_years()
        years = F.array(*[F.lit(y) for y in range(first, last + 1)]).cast("array<int>")
        return source("part").select(
            "p_partkey", "p_size",
            F.explode(years).alias("fy"),
        ).selectExpr(
            "concat('O', fy, 'M', p_partkey) AS voucher_no",
            "concat('N', floor((p_size - 1) / 2)) AS distributor_id",
            f"date_add(make_date(fy, 4, 1), {CALENDAR_LAG}) AS posted_on",
            "concat('M', p_partkey) AS product_id",
            "p_size * 10 AS qty_in",
        )

    def ledger_voucher() -> DataFrame:
        local = f"date_sub(posted_on, {CALENDAR_LAG})"
        fy = f"(year({local}) + {LOCAL_YEAR_OFFSET} - CASE WHEN month({local}) >= 4 THEN 0 ELSE 1 END)"
        fiscal_year = f"concat(substr({fy}, 3, 2), '/', substr({fy} + 1, 3, 2))"
        shared = dict(voucher_no="voucher_no", distributor_id="distributor_id", posted_on="posted_on",
                      fiscal_year=fiscal_year)
        bought = orders().selectExpr(
            "concat('P', o_orderkey) AS voucher_no", "concat('N', c_nationkey) AS distributor_id",
            "date_sub(o_day, 7) AS posted_on", f"{CENTRE} AS profit_centre",
            "CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM' THEN 'DN' ELSE 'PI' END AS voucher_type",
        )
        return _union(
            _shape(sales_voucher(), "ledger_voucher", **shared,
                   voucher_type="voucher_type", profit_centre="profit_centre"),
            _shape(bought, "ledger_voucher", **shared,
                   voucher_type="voucher_type", profit_centre="profit_centre"),
            _shape(openings(), "ledger_voucher", **shared, voucher_type="'OP'", profit_centre="'PC007'"),
        )

    def ledger_line() -> DataFrame:
        owners = orders().selectExpr("o_orderkey", "concat('N', c_nationkey) AS owner")
        lines = source("lineitem").join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
        return _union(
            sales_line_from(lines, "ledger_line", distributor_id="owner"),
            purchase_line_from(lines, "ledger_line", distributor_id="owner"),
            _shape(openings(), "ledger_line", voucher_no="voucher_no", distributor_id="distributor_id",
                   product_id="product_id", batch="'B0'", qty_out="0", qty_in="qty_in"),
        )

    def claim_tag() -> DataFrame:
        return _shape(
            orders().filter(CLAIM_BILL), "claim_tag",
            voucher_no="concat('C', o_orderkey)", distributor_id="concat('N', c_nationkey)",
            claim_type=f"element_at(array({CLAIM_TYPE_BY_MONTH}), month(o_day))",
        )

    def transit_loss() -> DataFrame:
        lost = source("lineitem").filter("l_returnflag = 'A'").groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(
            F.expr("sum(floor(l_quantity / 10))").alias("leakage"),
            F.expr("sum(floor(l_quantity / 8))").alias("breakage"),
            F.expr("sum(floor(l_quantity / 25))").alias("shortage"),
        )
        return _shape(
            lost, "transit_loss", voucher_no="concat('I', l_orderkey)", product_id="concat('M', l_partkey)",
            maker_id="concat('SU', l_suppkey)", leakage="leakage", breakage="breakage", shortage="shortage",
        )

    def consignment() -> DataFrame:
        return _shape(
            source("orders"), "consignment", voucher_no="concat('I', o_orderkey)",
            delivery_note="concat('DN-', o_orderkey)", pws_no="concat('PWS-', o_orderkey)",
            carrier="o_orderpriority", vehicle_no="concat('V-', o_custkey)",
            driver_name="concat('Driver ', o_custkey)",
            driver_no="CASE WHEN o_orderstatus <> 'P' THEN concat('98', o_custkey) END",
        )

    def brand() -> DataFrame:
        return _union(
            _shape(source("part").select("p_type").distinct(), "brand", brand_id="p_type", brand_code="p_type",
                   brand_name="concat(p_type, ' range')", brand_type="'VERTICAL'"),
            _shape(source("part").select("p_type", "p_brand").distinct(), "brand",
                   brand_id="concat(p_type, '/', p_brand)", brand_code="concat(p_type, '/', p_brand)",
                   brand_name="concat(p_brand, ' ', p_type)", parent_id="p_type", brand_type="'BRAND'"),
        )

    def distributor() -> DataFrame:
        nations = source("nation").join(source("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        office = spark.range(1)
        return _union(
            _shape(nations, "distributor", distributor_id="concat('N', n_nationkey)", distributor_name="n_name",
                   nav_name="concat('Nav ', n_name)", region="r_name",
                   nav_code="CASE WHEN n_regionkey <> 3 THEN concat('D', n_nationkey) END"),
            _shape(office, "distributor", distributor_id="'CENTRAL'", distributor_name="'Head Office'",
                   nav_name="'Head Office'", nav_code="'D-HO'"),
        )

    def account() -> DataFrame:
        return _union(
            _shape(source("customer"), "account", account_id="concat('PA', c_custkey)", account_name="c_name",
                   tax_no="CASE WHEN c_acctbal <= 9000 THEN concat('V', c_custkey) END",
                   distributor_id="concat('N', c_nationkey)",
                   org_code="CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '123456-4' "
                            "WHEN c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') THEN '111111-1' ELSE '999999-9' END",
                   address="concat('Street ', c_custkey)", state_code="concat('ST', c_nationkey)",
                   channel_code="concat('CH-', c_mktsegment)", subchannel_code="concat('SC-', c_mktsegment)",
                   segment_code="concat('SG-', c_mktsegment)",
                   party_kind="CASE WHEN c_acctbal < 0 THEN 'V' ELSE 'C' END",
                   is_common="CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END"),
            _shape(source("supplier"), "account", account_id="concat('SU', s_suppkey)", account_name="s_name",
                   customer_id="CASE WHEN s_acctbal < 0 THEN concat('N', s_nationkey) END"),
        )

    def product() -> DataFrame:
        return _shape(
            source("part"), "product", product_id="concat('M', p_partkey)",
            product_name="concat(p_name, ' ', p_partkey)", supplier_id="concat('SU', p_size)",
            brand_code="concat(p_type, '/', p_brand)",
            profit_centre="CASE WHEN p_brand = 'Brand#14' THEN 'PC001' ELSE 'PC007' END",
        )

    def batches() -> DataFrame:
        """Every product has three price batches, but one brand never got its third."""
        return source("part").withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(2)))).filter(
            "NOT (p_brand = 'Brand#13' AND step = 2)"
        )

    def price_batch() -> DataFrame:
        return _shape(batches(), "price_batch", product_id="concat('M', p_partkey)", batch="concat('B', step)",
                      price_id="concat('M', p_partkey, '-B', step)")

    def price() -> DataFrame:
        retail = "cast(p_retailprice AS decimal(18,2))"
        return _shape(batches(), "price", price_id="concat('M', p_partkey, '-B', step)",
                      product_id="concat('M', p_partkey)", complementary_rate=f"{retail} + step",
                      selling_price=f"{retail} * 1.13")

    def case_unit() -> DataFrame:
        return _union(
            _shape(source("part").filter("p_brand <> 'Brand#12'"), "case_unit",
                   product_id="concat('M', p_partkey)", unit="'CASE'",
                   factor="CASE WHEN p_brand = 'Brand#11' THEN 0 ELSE p_size END"),
            _shape(source("part").filter("p_size > 25"), "case_unit",
                   product_id="concat('M', p_partkey)", unit="'BOX'", factor="2"),
        )

    def claim_type() -> DataFrame:
        used = claim_tag().select("claim_type").distinct().filter("claim_type <> 'ZZ'")
        return _shape(used, "claim_type", type_code="claim_type")

    def calendar() -> DataFrame:
        """Every day from two years before the first order to two years after the last."""
        span = source("orders").select(F.col("o_orderdate").cast("date").alias("d")).agg(
            F.expr("make_date(year(min(d)) - 2, 1, 1)").alias("first"),
            F.expr("make_date(year(max(d)) + 2, 12, 31)").alias("last"),
        )
        days = span.select(F.explode(F.sequence("first", "last")).alias("ad")).withColumn(
            "local", F.date_sub("ad", CALENDAR_LAG)
        )
        year = f"year(local) + {LOCAL_YEAR_OFFSET}"
        return _shape(days, "calendar", day="ad", local_year=year, local_month="month(local)",
                      local_day="day(local)", local_date=f"concat({year}, date_format(local, '-MM-dd'))")

    def sales_node() -> DataFrame:
        beats = source("customer").select("c_nationkey", "c_mktsegment").distinct()
        return _union(
            _shape(source("region"), "sales_node", node_id="concat('U', r_regionkey)",
                   node_name="concat(r_name, ' manager')", node_code="concat('UC', r_regionkey)",
                   division="r_name", node_type="'USER'", status="1"),
            _shape(source("nation"), "sales_node", node_id="concat('T', n_nationkey)",
                   node_name="concat(n_name, ' area')", node_code="concat('AC', n_regionkey)",
                   division="n_name", node_type="'AREA'", parent_id="concat('U', n_regionkey)",
                   status="CASE WHEN n_nationkey IN (5, 11, 17, 23) THEN 0 ELSE 1 END"),
            _shape(source("supplier"), "sales_node", node_id="concat('P', s_suppkey)", node_name="s_name",
                   node_code="concat('PC', s_suppkey)", division="'FIELD'", node_type="'USER'",
                   parent_id="concat('T', s_nationkey)", status="CASE WHEN s_acctbal < 0 THEN 0 ELSE 1 END"),
            _shape(beats, "sales_node", node_id="concat('G', c_nationkey, '-', c_mktsegment)",
                   node_name="concat(c_mktsegment, ' beat')", node_code="concat('GC-', c_mktsegment)",
                   division="c_mktsegment", node_type="'BEAT'", parent_id="concat('T', c_nationkey)", status="1"),
        )

    def node_account() -> DataFrame:
        shared = dict(account_id="concat('PA', c_custkey)", distributor_id="concat('N', c_nationkey)")
        return _union(
            _shape(source("customer"), "node_account", **shared, node_id="concat('T', c_nationkey)"),
            _shape(source("customer"), "node_account", **shared,
                   node_id="concat('G', c_nationkey, '-', c_mktsegment)"),
            _shape(source("supplier"), "node_account", account_id="concat('SU', s_suppkey)",
                   node_id="concat('P', s_suppkey)", distributor_id="concat('N', s_nationkey)"),
        )

    def org_type() -> DataFrame:
        used = account().select("org_code").filter("org_code IS NOT NULL").distinct()
        return _shape(used, "org_type", org_code="org_code",
                      org_name="CASE org_code WHEN '123456-4' THEN 'Wholesale' WHEN '111111-1' THEN 'Retail' "
                               "ELSE 'Institution' END")

    def channel() -> DataFrame:
        segments = source("customer").select("c_mktsegment").distinct()
        return _union(*[
            _shape(segments, "channel", channel_code=f"concat('{code}-', c_mktsegment)", channel_type=f"'{kind}'",
                   channel_name=f"concat(c_mktsegment, ' {kind.lower()}')")
            for code, kind in (("CH", "CHANNEL"), ("SC", "SUB-CHANNEL"), ("SG", "SEGMENT"))
        ])

    return Model({
        "sales_voucher": sales_voucher,
        "sales_line": lambda: sales_line_from(source("lineitem"), "sales_line"),
        "ledger_voucher": ledger_voucher,
        "ledger_line": ledger_line,
        "purchase_voucher": purchase_voucher,
        "purchase_line": lambda: purchase_line_from(source("lineitem"), "purchase_line"),
        "receipt": lambda: _shape(source("orders"), "receipt", voucher_no="concat('I', o_orderkey)",
                                  ref_no="concat('P', o_orderkey)"),
        "transit_loss": transit_loss,
        "consignment": consignment,
        "product": product,
        "brand": brand,
        "distributor": distributor,
        "account": account,
        "price_batch": price_batch,
        "price": price,
        "case_unit": case_unit,
        "claim_tag": claim_tag,
        "claim_type": claim_type,
        "calendar": calendar,
        "sales_node": sales_node,
        "node_account": node_account,
        "org_type": org_type,
        "channel": channel,
        "state": lambda: _shape(source("nation"), "state", state_code="concat('ST', n_nationkey)",
                                state_name="concat('State of ', n_name)"),
    })
