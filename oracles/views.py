"""The model's tables as DuckDB views over the given tables.

``with_views`` prefixes a statement with just the views it needs.
"""

from __future__ import annotations

import re

_BATCH = "CASE WHEN l_linenumber < 3 THEN 'B0' WHEN l_linenumber < 5 THEN 'B1' ELSE 'B2' END"
_CENTRE = "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'PC001' ELSE 'PC007' END"
_LOCAL = "(posted_on - 103)"


def _qty(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,4))"


VIEWS: dict[str, str] = {
    "ord": """
        SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS st, o_orderpriority AS prio,
               CAST(o_orderdate AS DATE) AS d, c_nationkey AS nk, o_orderstatus, o_orderpriority
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "sales_voucher": f"""
        SELECT 'S' || k AS voucher_no, CAST(NULL AS VARCHAR) AS ref_no, 'PA' || cust AS party_id,
               CASE WHEN st = 'P' THEN 'PA' || nk END AS billed_to, d AS posted_on, left(prio, 1) || ':00' AS posted_at,
               'N' || nk AS distributor_id, 'TI' AS voucher_type, {_CENTRE} AS profit_centre
        FROM ord
        UNION ALL
        SELECT 'C' || k, '  S' || k || ' ', 'PA' || cust, NULL, d + 9, left(prio, 1) || ':00', 'N' || nk, 'TI', {_CENTRE}
        FROM ord WHERE prio IN ('1-URGENT', '2-HIGH')
        UNION ALL
        SELECT 'R' || k, CASE WHEN prio = '1-URGENT' THEN ' C' ELSE ' S' END || k || ' ', 'PA' || cust, NULL, d + 20,
               left(prio, 1) || ':00', 'N' || nk, 'CN', {_CENTRE}
        FROM ord WHERE st = 'F'""",
    "sales_line": f"""
        SELECT 'S' || l_orderkey AS voucher_no, l_orderkey AS k, 'M' || l_partkey AS product_id, {_BATCH} AS batch,
               {_qty("l_quantity")} AS qty_out, {_qty("round(l_quantity / 12, 4)")} AS alt_out,
               {_qty("0")} AS qty_in, {_qty("0")} AS alt_in, {_qty("l_extendedprice")} AS net_amount
        FROM lineitem
        UNION ALL
        SELECT 'C' || l_orderkey, l_orderkey, 'M' || l_partkey, {_BATCH}, {_qty("ceil(l_quantity / 10)")},
               {_qty("round(ceil(l_quantity / 10) / 12, 4)")}, 0, 0, 0
        FROM lineitem WHERE l_linestatus = 'O'
        UNION ALL
        SELECT 'R' || l_orderkey, l_orderkey, 'M' || l_partkey, {_BATCH}, 0, 0, {_qty("floor(l_quantity / 5)")},
               {_qty("round(floor(l_quantity / 5) / 12, 4)")}, {_qty("l_extendedprice")}
        FROM lineitem WHERE l_returnflag = 'R'""",
    "purchase_voucher": f"""
        SELECT 'P' || k AS voucher_no, d - 7 AS posted_on, 'N' || nk AS distributor_id, {_CENTRE} AS profit_centre
        FROM ord""",
    "purchase_line": f"""
        SELECT 'P' || l_orderkey AS voucher_no, l_orderkey AS k, 'M' || l_partkey AS product_id, {_BATCH} AS batch,
               {_qty("CASE WHEN l_returnflag = 'R' THEN floor(l_quantity / 7) ELSE 0 END")} AS qty_out,
               {_qty("l_quantity + 1")} AS qty_in, {_qty("l_extendedprice")} AS rate, 'SU' || l_suppkey AS maker_id
        FROM lineitem""",
    "opening": """
        SELECT 'O' || fy || 'M' || p_partkey AS voucher_no, 'N' || ((p_size - 1) // 2) AS distributor_id,
               make_date(fy, 4, 1) + 103 AS posted_on, 'M' || p_partkey AS product_id,
               CAST(p_size * 10 AS DECIMAL(18,4)) AS qty_in
        FROM part CROSS JOIN (
            SELECT CAST(unnest(generate_series(
                min(year(d - 110) - CASE WHEN month(d - 110) >= 4 THEN 0 ELSE 1 END),
                max(year(d - 103) - CASE WHEN month(d - 103) >= 4 THEN 0 ELSE 1 END))) AS INTEGER) AS fy
            FROM ord)""",
    "ledger_voucher": f"""
        SELECT voucher_no, distributor_id, posted_on, voucher_type, profit_centre,
               substr(CAST(fy AS VARCHAR), 3, 2) || '/' || substr(CAST(fy + 1 AS VARCHAR), 3, 2) AS fiscal_year
        FROM (
            SELECT *, year({_LOCAL}) + 57 - CASE WHEN month({_LOCAL}) >= 4 THEN 0 ELSE 1 END AS fy
            FROM (
                SELECT voucher_no, distributor_id, posted_on, voucher_type, profit_centre FROM sales_voucher
                UNION ALL
                SELECT 'P' || k, 'N' || nk, d - 7,
                       CASE WHEN st = 'O' AND prio = '3-MEDIUM' THEN 'DN' ELSE 'PI' END, {_CENTRE}
                FROM ord
                UNION ALL
                SELECT voucher_no, distributor_id, posted_on, 'OP', 'PC007' FROM opening))""",
    "ledger_line": """
        SELECT voucher_no, 'N' || nk AS distributor_id, product_id, batch, qty_out, qty_in
        FROM (SELECT voucher_no, k, product_id, batch, qty_out, qty_in FROM sales_line
              UNION ALL
              SELECT voucher_no, k, product_id, batch, qty_out, qty_in FROM purchase_line)
        JOIN ord USING (k)
        UNION ALL
        SELECT voucher_no, distributor_id, product_id, 'B0', 0, qty_in FROM opening""",
    "claim_tag": """
        SELECT 'C' || k AS voucher_no, 'N' || nk AS distributor_id,
               ['PP','OP','NEV','TVB','TEX','BC','AC','MKB','ZZ','PP','AC','OP'][month(d)] AS claim_type
        FROM ord WHERE prio IN ('1-URGENT', '2-HIGH')""",
    "claim_type": "SELECT DISTINCT claim_type AS type_code FROM claim_tag WHERE claim_type <> 'ZZ'",
    "receipt": "SELECT 'I' || o_orderkey AS voucher_no, 'P' || o_orderkey AS ref_no FROM orders",
    "transit_loss": f"""
        SELECT 'I' || l_orderkey AS voucher_no, 'M' || l_partkey AS product_id, 'SU' || l_suppkey AS maker_id,
               {_qty("sum(floor(l_quantity / 10))")} AS leakage, {_qty("sum(floor(l_quantity / 8))")} AS breakage,
               {_qty("sum(floor(l_quantity / 25))")} AS shortage, CAST(NULL AS DECIMAL(18,4)) AS carton
        FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_orderkey, l_partkey, l_suppkey""",
    "consignment": """
        SELECT 'I' || o_orderkey AS voucher_no, 'DN-' || o_orderkey AS delivery_note, 'PWS-' || o_orderkey AS pws_no,
               o_orderpriority AS carrier, 'V-' || o_custkey AS vehicle_no, 'Driver ' || o_custkey AS driver_name,
               CASE WHEN o_orderstatus <> 'P' THEN '98' || o_custkey END AS driver_no
        FROM orders""",
    "brand": """
        SELECT DISTINCT p_type AS brand_id, p_type AS brand_code, p_type || ' range' AS brand_name,
               CAST(NULL AS VARCHAR) AS parent_id, 'VERTICAL' AS brand_type FROM part
        UNION ALL
        SELECT DISTINCT p_type || '/' || p_brand, p_type || '/' || p_brand, p_brand || ' ' || p_type, p_type, 'BRAND'
        FROM part""",
    "distributor": """
        SELECT 'N' || n_nationkey AS distributor_id, n_name AS distributor_name, 'Nav ' || n_name AS nav_name,
               CASE WHEN n_regionkey <> 3 THEN 'D' || n_nationkey END AS nav_code, r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT 'CENTRAL', 'Head Office', 'Head Office', 'D-HO', NULL""",
    "account": """
        SELECT 'PA' || c_custkey AS account_id, c_name AS account_name,
               CASE WHEN c_acctbal <= 9000 THEN 'V' || c_custkey END AS tax_no, 'N' || c_nationkey AS distributor_id,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '123456-4'
                    WHEN c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') THEN '111111-1' ELSE '999999-9' END AS org_code,
               'Street ' || c_custkey AS address, 'ST' || c_nationkey AS state_code,
               'CH-' || c_mktsegment AS channel_code, 'SC-' || c_mktsegment AS subchannel_code,
               'SG-' || c_mktsegment AS segment_code, CASE WHEN c_acctbal < 0 THEN 'V' ELSE 'C' END AS party_kind,
               CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END AS is_common, CAST(NULL AS VARCHAR) AS customer_id
        FROM customer
        UNION ALL
        SELECT 'SU' || s_suppkey, s_name, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
               CASE WHEN s_acctbal < 0 THEN 'N' || s_nationkey END
        FROM supplier""",
    "product": """
        SELECT 'M' || p_partkey AS product_id, p_name || ' ' || p_partkey AS product_name, 'SU' || p_size AS supplier_id,
               p_type || '/' || p_brand AS brand_code,
               CASE WHEN p_brand = 'Brand#14' THEN 'PC001' ELSE 'PC007' END AS profit_centre
        FROM part""",
    "part_batch": """
        SELECT part.*, step FROM part CROSS JOIN (SELECT unnest([0, 1, 2]) AS step)
        WHERE NOT (p_brand = 'Brand#13' AND step = 2)""",
    "price_batch": """
        SELECT 'M' || p_partkey AS product_id, 'B' || step AS batch, 'M' || p_partkey || '-B' || step AS price_id
        FROM part_batch""",
    "price": """
        SELECT 'M' || p_partkey || '-B' || step AS price_id, 'M' || p_partkey AS product_id,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) + step AS DECIMAL(18,4)) AS complementary_rate,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 1.13 AS DECIMAL(18,4)) AS selling_price
        FROM part_batch""",
    "case_unit": """
        SELECT 'M' || p_partkey AS product_id, 'CASE' AS unit,
               CAST(CASE WHEN p_brand = 'Brand#11' THEN 0 ELSE p_size END AS DECIMAL(18,4)) AS factor
        FROM part WHERE p_brand <> 'Brand#12'
        UNION ALL
        SELECT 'M' || p_partkey, 'BOX', 2 FROM part WHERE p_size > 25""",
    "calendar": """
        SELECT ad AS day, year(loc) + 57 AS local_year, month(loc) AS local_month, day(loc) AS local_day
        FROM (SELECT ad, ad - 103 AS loc
              FROM (SELECT CAST(unnest(generate_series(
                        make_date(CAST(year(min(o_orderdate)) - 2 AS INTEGER), 1, 1),
                        make_date(CAST(year(max(o_orderdate)) + 2 AS INTEGER), 12, 31),
                        INTERVAL 1 DAY)) AS DATE) AS ad FROM orders))""",
    "sales_node": """
        SELECT 'U' || r_regionkey AS node_id, r_name || ' manager' AS node_name, 'UC' || r_regionkey AS node_code,
               r_name AS division, 'USER' AS node_type, CAST(NULL AS VARCHAR) AS parent_id, 1 AS status FROM region
        UNION ALL
        SELECT 'T' || n_nationkey, n_name || ' area', 'AC' || n_regionkey, n_name, 'AREA', 'U' || n_regionkey,
               CASE WHEN n_nationkey IN (5, 11, 17, 23) THEN 0 ELSE 1 END FROM nation
        UNION ALL
        SELECT 'P' || s_suppkey, s_name, 'PC' || s_suppkey, 'FIELD', 'USER', 'T' || s_nationkey,
               CASE WHEN s_acctbal < 0 THEN 0 ELSE 1 END FROM supplier
        UNION ALL
        SELECT DISTINCT 'G' || c_nationkey || '-' || c_mktsegment, c_mktsegment || ' beat',
               'GC-' || c_mktsegment, c_mktsegment, 'BEAT', 'T' || c_nationkey, 1 FROM customer""",
    "node_account": """
        SELECT 'PA' || c_custkey AS account_id, 'T' || c_nationkey AS node_id, 'N' || c_nationkey AS distributor_id
        FROM customer
        UNION ALL
        SELECT 'PA' || c_custkey, 'G' || c_nationkey || '-' || c_mktsegment, 'N' || c_nationkey FROM customer
        UNION ALL
        SELECT 'SU' || s_suppkey, 'P' || s_suppkey, 'N' || s_nationkey FROM supplier""",
    "org_type": """
        SELECT DISTINCT org_code, CASE org_code WHEN '123456-4' THEN 'Wholesale' WHEN '111111-1' THEN 'Retail'
               ELSE 'Institution' END AS org_name
        FROM account WHERE org_code IS NOT NULL""",
    "channel": """
        SELECT DISTINCT code || '-' || c_mktsegment AS channel_code, kind AS channel_type,
               c_mktsegment || ' ' || lower(kind) AS channel_name
        FROM customer
        CROSS JOIN (VALUES ('CH', 'CHANNEL'), ('SC', 'SUB-CHANNEL'), ('SG', 'SEGMENT')) AS kinds(code, kind)""",
    "state": "SELECT 'ST' || n_nationkey AS state_code, 'State of ' || n_name AS state_name FROM nation",
    # Shared by several answers: pieces per case, with none meaning one.
    "case_factor": """
        SELECT product_id, factor, CASE WHEN coalesce(factor, 0) = 0 THEN 1 ELSE factor END AS pieces_per_case
        FROM product LEFT JOIN (SELECT * FROM case_unit WHERE unit = 'CASE') USING (product_id)""",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the views it reads from, directly or through others."""
    known = {**VIEWS, **(extra or {})}
    order: dict[str, None] = {}

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+([a-z_0-9]+)", text):
            if name in known and name not in order and text is not known[name]:
                visit(known[name])
                order[name] = None

    visit(body)
    if not order:
        return body
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS ({known[name]})" for name in order) + "\n" + body
