"""One DuckDB statement per registered query.

Cases are computed line by line in floating point here, then settled to six
decimals before the last rounding; the Spark plans sum exact pieces first.
"""

from __future__ import annotations

from oracles.views import with_views

ANCHOR = "2000-06-15"
CLAIM_RANGE = ("1996-01-01", "2000-12-31")
STOCK_RANGE, FISCAL_YEAR = ("1999-10-01", "2000-06-30"), "56/57"
CSV_COMPANIES = ("N3", "N7", "N11", "N19", "N24")
SCOPE_TYPE, SCOPE_CODE = "BEAT", "GC-BUILDING"


def whole(x: str) -> str:
    return f"CAST(CAST(round({x}, 6) AS DECIMAL(38,6)) AS DECIMAL(32,0))"


def money(x: str) -> str:
    """Two decimals from a quotient, halves away from zero."""
    return f"CAST(CAST(round({x}, 8) AS DECIMAL(38,8)) AS DECIMAL(32,2))"


def dec(x: str, scale: int) -> str:
    return f"CAST({x} AS DECIMAL(32,{scale}))"


def _between(column: str, bounds: tuple[str, str]) -> str:
    return f"{column} BETWEEN DATE '{bounds[0]}' AND DATE '{bounds[1]}'"


_WINDOWS = {
    "d1": "local_year = ay AND local_month = am AND local_day = ad",
    "mo": "local_year = ay AND local_month = am",
    "mo_ly": "local_year = ay - 1 AND local_month = am",
    "pm_ly": "local_year = ay - 1 AND local_month = CASE WHEN am = 1 THEN 12 ELSE am - 1 END",
    "yr": "local_year = ay",
    "ly": "local_year = ay - 1",
    "q3": "(local_year = ay AND local_month BETWEEN am - 2 AND am) OR (local_year = ay - 1 AND local_month > am + 9)",
}

EXTRA: dict[str, str] = {
    "anchor": f"""SELECT local_year AS ay, local_month AS am, local_day AS ad
                  FROM calendar WHERE day = DATE '{ANCHOR}'""",
    "win": "SELECT " + ", ".join(
        f"min(day) FILTER ({cond}) AS {name}_a, max(day) FILTER ({cond}) AS {name}_b" for name, cond in _WINDOWS.items()
    ) + " FROM calendar CROSS JOIN anchor",
    "fiscal": """
        SELECT local_year * 12 + local_month - (12 * (ay - CASE WHEN am <= 8 THEN 1 ELSE 0 END) + 8) AS ordinal,
               min(day) AS a, max(day) AS b
        FROM calendar CROSS JOIN anchor GROUP BY ALL HAVING ordinal BETWEEN 1 AND 12""",
    "walk": """
        SELECT node_id, node_name, node_code, division, node_type, parent_id
        FROM sales_node WHERE node_type = 'USER' AND status = 1
        UNION
        SELECT c.node_id, c.node_name, c.node_code, c.division, c.node_type, c.parent_id
        FROM walk JOIN sales_node AS c ON c.parent_id = walk.node_id WHERE c.status = 1""",
    "seen": "SELECT distributor_id FROM distributor",
    "scope_rows": f"""
        SELECT DISTINCT walk.*, account_id, distributor_id FROM walk JOIN node_account USING (node_id)
        WHERE node_type = '{SCOPE_TYPE}' AND node_code = '{SCOPE_CODE}'""",
    "sold": """
        SELECT v.voucher_no, posted_on, voucher_type, distributor_id, coalesce(billed_to, party_id) AS buyer,
               product_id, batch, qty_out - qty_in AS pieces, factor, pieces_per_case,
               (qty_out - qty_in) / pieces_per_case AS cases
        FROM sales_voucher AS v JOIN seen USING (distributor_id) JOIN sales_line USING (voucher_no)
        JOIN case_factor USING (product_id)
        WHERE profit_centre = 'PC007'""",
    "bought": """
        SELECT posted_on, (qty_in - qty_out) / pieces_per_case AS cases
        FROM purchase_voucher JOIN seen USING (distributor_id) JOIN purchase_line USING (voucher_no)
        JOIN case_factor USING (product_id)
        WHERE profit_centre = 'PC007'""",
    "priced": """
        SELECT price_batch.product_id, batch, complementary_rate
        FROM price_batch JOIN price USING (price_id, product_id)""",
    "brands": """
        SELECT child.brand_code, child.brand_name, top.brand_name AS vertical
        FROM brand AS child JOIN brand AS top ON child.parent_id = top.brand_id WHERE top.brand_type = 'VERTICAL'""",
    # Claims.
    "piece_price": f"""
        SELECT product_id, batch,
               CAST(CAST(round(complementary_rate / pieces_per_case, 9) AS DECIMAL(38,9)) AS DECIMAL(32,4)) AS rate,
               complementary_rate / pieces_per_case AS exact_rate
        FROM priced JOIN case_factor USING (product_id)""",
    "in_range": f"""
        SELECT voucher_no, trim(ref_no) AS ref_no, party_id, posted_on, posted_at, distributor_id, voucher_type,
               profit_centre
        FROM sales_voucher WHERE {_between("posted_on", CLAIM_RANGE)}""",
    "given": """
        SELECT claim_type, ref_no, party_id, voucher_no, posted_on, posted_at, distributor_id, profit_centre,
               product_id, rate, sum(qty_out) AS qty, sum(alt_out) AS alt
        FROM in_range JOIN claim_tag USING (voucher_no, distributor_id) JOIN sales_line USING (voucher_no)
        JOIN piece_price USING (product_id, batch)
        WHERE voucher_type = 'TI' AND claim_type <> 'ZZ'
        GROUP BY ALL""",
    "given_home": "SELECT * FROM (SELECT * EXCLUDE (profit_centre), profit_centre AS pc FROM given) WHERE pc = 'PC007'",
    "back": """
        SELECT ref_no AS bill, product_id, sum(qty_in) AS qty_back, sum(alt_in) AS alt_back
        FROM in_range JOIN sales_line USING (voucher_no)
        WHERE voucher_type = 'CN' AND profit_centre = 'PC007' GROUP BY ALL""",
    "back_any": """
        SELECT ref_no AS bill, product_id, sum(qty_in) AS qty_back, sum(alt_in) AS alt_back
        FROM in_range JOIN sales_line USING (voucher_no) WHERE voucher_type = 'CN' GROUP BY ALL""",
    "sale_bill": """
        SELECT voucher_no AS bill, product_id, distributor_id, sum(alt_out) - coalesce(any_value(alt_back), 0) AS alt
        FROM in_range JOIN sales_line USING (voucher_no)
        LEFT JOIN back ON back.bill = in_range.voucher_no AND back.product_id = sales_line.product_id
        WHERE voucher_type = 'TI' AND profit_centre = 'PC007'
        GROUP BY voucher_no, sales_line.product_id, distributor_id""".replace(
            "AS bill, product_id,", "AS bill, sales_line.product_id,"),
    "net_claim": f"""
        SELECT g.ref_no, g.product_id, g.distributor_id, g.claim_type, g.qty - coalesce(qty_back, 0) AS qty,
               CASE WHEN claim_type = 'AC' THEN CAST((g.qty - coalesce(qty_back, 0)) * rate AS DECIMAL(32,2))
                    ELSE {money("((g.qty - coalesce(qty_back, 0)) * rate) / 0.85")} END AS amount
        FROM given_home AS g LEFT JOIN back ON back.bill = g.voucher_no AND back.product_id = g.product_id""",
    "claim_base": """
        SELECT coalesce(c.product_id, s.product_id) AS product_id, coalesce(c.distributor_id, s.distributor_id) AS distributor_id,
               claim_type, sum(coalesce(amount, 0)) AS amount, sum(coalesce(qty, 0)) AS pieces, sum(coalesce(alt, 0)) AS cases
        FROM net_claim AS c FULL JOIN sale_bill AS s ON c.ref_no = s.bill AND c.product_id = s.product_id
        GROUP BY ALL""",
    "claim_named": """
        SELECT nav_name, nav_code, distributor_name, distributor_id AS distributor_code, coalesce(region, '') AS region,
               product_id AS product_code, product_name, claim_type, amount, pieces, cases
        FROM claim_base LEFT JOIN product USING (product_id) LEFT JOIN distributor USING (distributor_id)""",
    # Stock.
    "moved": f"""
        SELECT distributor_id, product_id, batch, qty_in - qty_out AS net_in,
               voucher_type = 'OP' OR posted_on < DATE '{STOCK_RANGE[0]}' AS is_open,
               voucher_type IN ('PI', 'DN') AND posted_on >= DATE '{STOCK_RANGE[0]}' AS is_bought,
               voucher_type IN ('TI', 'CN') AND posted_on >= DATE '{STOCK_RANGE[0]}' AS is_sold,
               coalesce(claim_type, '') AS kind
        FROM ledger_voucher JOIN ledger_line USING (voucher_no, distributor_id)
        LEFT JOIN claim_tag USING (voucher_no, distributor_id)
        WHERE posted_on <= DATE '{STOCK_RANGE[1]}' AND fiscal_year = '{FISCAL_YEAR}' AND profit_centre = 'PC007'""",
}
_OWN = ("PP", "OP", "NEV", "AC", "BC", "TVB", "TEX")
_BUCKET_SUMS = {
    "opening": "sum(net_in) FILTER (is_open)",
    "purchase": "sum(net_in) FILTER (is_bought)",
    **{t.lower(): f"sum(-net_in) FILTER (is_sold AND kind = '{t}')" for t in _OWN},
    "sales": f"sum(-net_in) FILTER (is_sold AND kind NOT IN {_OWN})",
    "total_sales": "sum(-net_in) FILTER (is_sold)",
    "closing": "sum(net_in)",
}
EXTRA["movement"] = (
    "SELECT distributor_id, product_id, batch, "
    + ", ".join(f"CAST(coalesce({expr}, 0) AS DECIMAL(28,4)) AS {name}" for name, expr in _BUCKET_SUMS.items())
    + " FROM moved GROUP BY ALL"
)
_CASE_BUCKETS = ("opening", "purchase", "sales", *[t.lower() for t in _OWN], "closing")
EXTRA["stock_cases"] = (
    "SELECT product_id, product_name, m.distributor_id, "
    + ", ".join(
        f"sum(CASE WHEN coalesce(factor, 0) = 0 THEN 0 ELSE {b} / factor END) AS {b}" for b in _CASE_BUCKETS
    )
    + """ FROM movement AS m JOIN product USING (product_id) JOIN price_batch USING (product_id, batch)
      JOIN case_factor USING (product_id) LEFT JOIN account AS a ON a.customer_id = m.distributor_id
      WHERE product.profit_centre = 'PC007' GROUP BY ALL"""
)
EXTRA["bill_outlet"] = f"""
    SELECT distributor_id, party_id, voucher_no, voucher_type,
           CASE WHEN coalesce(factor, 0) = 0 THEN 0 ELSE sum(qty_out - qty_in) / factor END AS cases,
           sum(net_amount) AS net_amount
    FROM sales_voucher JOIN sales_line USING (voucher_no) JOIN case_factor USING (product_id)
    WHERE distributor_id <> 'CENTRAL' AND profit_centre = 'PC007' AND {_between("posted_on", CLAIM_RANGE)}
    GROUP BY distributor_id, party_id, voucher_no, voucher_type, factor, product_id"""


def _in(name: str, column: str = "posted_on") -> str:
    return f"{column} BETWEEN {name}_a AND {name}_b"


def _case_sums(windows: dict[str, str]) -> str:
    return ", ".join(f"coalesce(sum(cases) FILTER ({_in(w)}), 0) AS {alias}" for alias, w in windows.items())


_TOP_PARTY = {"mtd": "mo", "ly_mtd": "mo_ly", "ytd": "yr", "ly_ytd": "ly"}
_TOP_SKU = {"mtd": "mo", "ly_mtd": "pm_ly", "ytd": "yr", "ly_ytd": "ly"}
_STATUS = {"day": "d1", "month": "mo", "qtd": "q3"}


def _top(label: str, source: str, windows: dict[str, str]) -> str:
    figures = ", ".join(f"{whole(w)} AS {w}" for w in windows)
    return f"""
        SELECT {label}, {figures} FROM (
            SELECT {label}, {_case_sums(windows)} FROM {source} CROSS JOIN win
            WHERE posted_on BETWEEN ly_a AND yr_b GROUP BY {label})
        ORDER BY round(ytd, 6) DESC, {label} NULLS FIRST LIMIT 10"""


def _dashboards(scoped: bool) -> dict[str, str]:
    segment = "brand_name" if scoped else "vertical"
    share = ", ".join(
        f"CAST(round(coalesce(100 * round({w}, 6) / nullif(round(sum({w}) OVER (), 6), 0), 0), 8) AS DECIMAL(38,8)) AS {w}"
        for w in _TOP_PARTY
    )
    percents = ", ".join(f"CAST({w} AS DECIMAL(10,2)) AS {w}" for w in _TOP_PARTY)
    brand = f"""
        SELECT segment, {percents} FROM (
            SELECT segment, {share} FROM (
                SELECT {segment} AS segment, {_case_sums(_TOP_PARTY)}
                FROM sold JOIN product USING (product_id) JOIN brands USING (brand_code) CROSS JOIN win
                WHERE posted_on BETWEEN ly_a AND yr_b GROUP BY ALL)
            UNION ALL SELECT 'Total', 100, 100, 100, 100)"""

    def compare(label: str, source: str) -> str:
        parts = []
        for period, now, old, seen in (
            ("LM", "mo", "pm_ly", f"{_in('pm_ly')} OR {_in('mo')}"),
            ("LY", "yr", "mo_ly", "posted_on BETWEEN mo_ly_a AND yr_b"),
        ):
            parts.append(f"""
                SELECT '{label} in Cases {period}' AS identifier, {whole("now")} AS currents, {whole("old")} AS old,
                       {whole("coalesce(100 * round(now, 6) / nullif(round(old, 6), 0), 0)")} AS achievement_percent
                FROM (SELECT sum(CASE WHEN {_in(now)} THEN cases ELSE 0 END) AS now,
                             sum(CASE WHEN {_in(old)} THEN cases ELSE 0 END) AS old
                      FROM {source} CROSS JOIN win WHERE {seen})""")
        return " UNION ALL ".join(parts)

    months = ("poush", "magh", "falgun", "chaitra", "baishak", "jestha", "ashad", "shrawan", "bhadra", "asoj",
              "kartik", "mangsir")

    def grid(label: str, lines: str, pieces: str) -> str:
        rows = f"""
            SELECT ordinal, {pieces} / pieces_per_case AS cases, {pieces} / pieces_per_case * selling_price AS value
            FROM ledger_voucher AS v JOIN seen USING (distributor_id) JOIN {lines} USING (voucher_no)
            JOIN case_factor USING (product_id)
            LEFT JOIN (SELECT p.product_id, p.batch, selling_price FROM price_batch AS p JOIN price USING (price_id)) AS q
                   ON q.product_id = {lines}.product_id AND q.batch = {lines}.batch
            JOIN fiscal ON posted_on BETWEEN a AND b
            WHERE profit_centre = 'PC007' AND voucher_type IN ('TI', 'CN', 'PI', 'DN')"""
        return " UNION ALL ".join(
            f"SELECT '{label}{suffix}' AS items, " + ", ".join(
                whole(f"sum(CASE WHEN ordinal = {i} THEN {m} WHEN {m} IS NOT NULL THEN 0 END)") + f" AS {name}"
                for i, name in enumerate(months, 1)
            ) + f" FROM ({rows})"
            for suffix, m in (("", "cases"), (" Value", "value"))
        )

    def status(label: str, column: str, source: str) -> str:
        figures = ", ".join(
            f"CAST(count(DISTINCT {column}) FILTER ({_in(w)}) AS DECIMAL(32,0)) AS {n}" if column != "cases"
            else f"{whole(f'sum(CASE WHEN {_in(w)} THEN cases ELSE 0 END)')} AS {n}"
            for n, w in _STATUS.items()
        )
        return f"SELECT '{label}' AS items, {figures} FROM {source} CROSS JOIN win WHERE {_in('q3')}"

    def at(code: str) -> str:
        return (f"(SELECT sold.*, account_id FROM sold JOIN account ON account_id = buyer "
                f"JOIN org_type USING (org_code) WHERE org_code = '{code}')")

    overall = " UNION ALL ".join([
        status("Bill No.", "voucher_no", "sold"),
        status("SKU No.", "product_id", "sold"),
        status("Quantity(Case)", "cases", "sold"),
        status("WS no(Unique Party)", "account_id", at("123456-4")),
        status("Retail no(Unique)", "account_id", at("111111-1")),
        status("WS qty(Case)", "cases", at("123456-4")),
        status("WS qty(Case)", "cases", at("111111-1")),
    ])
    amount = "cases * (complementary_rate / pieces_per_case)"
    by_type = "SELECT coalesce(type_code, 'Normal Bills') AS category, " + ", ".join(
        [f"count(DISTINCT voucher_no) FILTER ({_in(w)} AND voucher_type = 'TI') AS bill_cut_{n}"
         for n, w in _STATUS.items()]
        + [f"sum(CASE WHEN {_in(w)} THEN cases ELSE 0 END) AS cases_{n}" for n, w in _STATUS.items()]
        + [f"sum(CASE WHEN {_in(w)} THEN {amount} ELSE 0 END) AS total_amount_{n}" for n, w in _STATUS.items()]
    ) + f""" FROM sold LEFT JOIN claim_tag USING (voucher_no)
             LEFT JOIN claim_type ON claim_tag.claim_type = type_code
             JOIN priced USING (product_id, batch) CROSS JOIN win WHERE {_in('q3')} GROUP BY 1"""
    figures = [f"{p}_{n}" for p in ("bill_cut", "cases", "total_amount") for n in _STATUS]
    shown = ", ".join(f"CAST({f} AS BIGINT) AS {f}" if f.startswith("bill") else f"{whole(f)} AS {f}" for f in figures)
    claim_sales = f"""
        SELECT category, {shown} FROM (
            SELECT category, {", ".join(figures)} FROM ({by_type})
            UNION ALL SELECT 'TOTAL', {", ".join(f"sum({f})" for f in figures)} FROM ({by_type}))"""
    answers = {
        "top_skus": _top("sku", "(SELECT sold.*, product_name AS sku FROM sold JOIN product USING (product_id))", _TOP_SKU),
        "top_parties": _top(
            "party", "(SELECT sold.*, account_name || ' (' || tax_no || ')' AS party FROM sold "
            "JOIN account ON account_id = buyer)", _TOP_PARTY),
        "overall_status": overall,
        "primary_secondary": compare("Primary", "bought") + " UNION ALL " + compare("Secondary", "sold"),
        "claim_sales": claim_sales,
        "brand_contribution": brand,
        "month_grid": grid("Primary", "purchase_line", "(qty_in - qty_out)") + " UNION ALL "
        + grid("Secondary", "sales_line", "(qty_out - qty_in)"),
    }
    if scoped:
        extra = {**EXTRA, "seen": "SELECT distributor_id FROM scope_rows JOIN distributor USING (distributor_id)"}
        return {f"{k}_scoped": with_views(v, extra) for k, v in answers.items()}
    answers["distinct_bills"] = (
        f"SELECT category, bill_cut_day, bill_cut_month, bill_cut_qtd FROM ({by_type})"
    )
    return {k: with_views(v, EXTRA) for k, v in answers.items()}


_LAYOUTS = {
    # types shown, types in the grand total, tax share, net share, style of the net line
    "sales": (("PP", "NEV"), ("PP", "OP", "NEV"), "0.15", "0.85", "B"),
    "brand": (("BC",), ("BC",), "0.15", "0.85", "R"),
    "admin": (("AC",), ("AC",), "0", "1", "R"),
    "tieup": (("TVB", "TEX"), ("TVB", "TEX"), "0.15", "0.85", "B"),
    "outlet": (("OP",), ("OP",), "0.15", "0.85", "B"),
}
_SUMMARY_KEYS = "nav_name, nav_code, distributor_name, distributor_code, region, product_code, product_name"
_BREAKAGE = (
    f"{dec('sum(cases)', 4)} AS sales_cs, CAST(sum(cases) * 8.695652 AS DECIMAL(32,10)) AS approved_budget, "
    f"{dec("coalesce(sum(pieces) FILTER (claim_type = 'MKB'), 0)", 4)} AS breakage_pcs, "
    f"{dec("coalesce(sum(amount) FILTER (claim_type = 'MKB'), 0)", 2)} AS breakage_amount, "
    f"{dec('sum(cases) * 10.00', 4)} AS approved_bonus"
)


def _claims() -> dict[str, str]:
    answers = {}

    def amount(kinds) -> str:
        return f"sum(CASE WHEN claim_type IN ({', '.join(repr(k) for k in kinds)}) THEN amount ELSE 0 END)"

    for name, (types, total_types, tax, net, style) in _LAYOUTS.items():
        shown = ", ".join(f"{dec(amount([t]), 2)} AS {t.lower()}" for t in types)
        answers[f"claim_summary_{name}"] = f"""
            SELECT {_SUMMARY_KEYS}, {shown}, {dec(amount(types), 2)} AS total
            FROM claim_named GROUP BY {_SUMMARY_KEYS} HAVING {amount(types)} <> 0"""
        answers[f"claim_total_{name}"] = f"""
            SELECT 'Total' AS product_name, {shown}, {dec(amount(total_types), 2)} AS total
            FROM claim_named HAVING {amount(total_types)} <> 0"""
        columns = [t.lower() for t in types] + ["total"]
        sums = ", ".join(f"{amount([t])} AS {t.lower()}" for t in types) + f", {amount(types)} AS total"

        def line(label: str, factor: str, fflg: str, columns=columns, sums=sums) -> str:
            scaled = ", ".join(f"CAST({c} * {factor} AS DECIMAL(32,4)) AS {c}" for c in columns)
            return (f"SELECT '{label}' AS product_name, {scaled}, '{fflg}' AS fflg "
                    f"FROM (SELECT {sums} FROM claim_named) WHERE total <> 0")

        detail = (f"SELECT product_name, {', '.join(f'CAST({c} AS DECIMAL(32,4)) AS {c}' for c in columns)}, 'R' AS fflg "
                  f"FROM (SELECT product_code, product_name, {sums} FROM claim_named GROUP BY ALL) WHERE total <> 0")
        spacer = f"SELECT chr(10) || chr(13), {', '.join('NULL' for _ in columns)}, 'R'"
        answers[f"claim_print_{name}"] = " UNION ALL ".join([
            detail, spacer, line("Total", "1", "B"), line("Less: TDS (15%)", tax, "R"), line("Net Amount", net, style)
        ])
    answers["claim_summary_breakage"] = (
        f"SELECT {_SUMMARY_KEYS}, {_BREAKAGE} FROM claim_named GROUP BY {_SUMMARY_KEYS}"
    )
    answers["claim_total_breakage"] = f"SELECT 'Total' AS product_name, {_BREAKAGE} FROM claim_named"
    answers["claim_print_breakage"] = f"""
        SELECT product_name, {_BREAKAGE}, 'R' AS fflg FROM claim_named GROUP BY product_code, product_name
        UNION ALL SELECT chr(10) || chr(13), NULL, NULL, NULL, NULL, NULL, 'R'
        UNION ALL SELECT 'Total', {_BREAKAGE}, 'B' FROM claim_named"""
    answers["claims_vs_sales"] = f"""
        SELECT product_id, distributor_id, claim_type, {dec("amount", 2)} AS amount, {dec("pieces", 4)} AS pieces,
               {dec("cases", 4)} AS cases
        FROM claim_base"""
    types = ("PP", "OP", "NEV", "TVB", "TEX", "BC", "AC", "MKB")
    answers["claim_pivot"] = (
        "SELECT product_id, " + ", ".join(f"{dec(amount([t]), 2)} AS {t.lower()}" for t in types)
        + " FROM claim_base GROUP BY product_id"
    )
    answers["returns_by_bill"] = f"""
        SELECT bill, product_id, CAST(qty_back AS DECIMAL(18,4)) AS returned,
               CAST(alt_back AS DECIMAL(18,4)) AS returned_cases FROM back"""
    answers["price_lookup"] = "SELECT product_id, batch, rate FROM piece_price"
    answers["sales_of_claimed_bills"] = """
        SELECT voucher_no AS bill, product_id, CAST(sum(qty_out) AS DECIMAL(18,4)) AS sold,
               CAST(sum(alt_out) AS DECIMAL(18,4)) AS sold_cases
        FROM in_range JOIN sales_line USING (voucher_no)
        WHERE voucher_type = 'TI' AND voucher_no IN (SELECT ref_no FROM given) GROUP BY ALL"""
    detail = f"""
        SELECT nav_code, nav_name, g.product_id, product_name, tax_no AS pan, account_name AS party_name,
               x.voucher_no AS ref_bill_no, s.qty AS qty, s.alt AS qty_case, claim_type AS type, g.voucher_no AS comp_ref_no,
               strftime(g.posted_on, '%m/%d/%Y') AS trn_date, rate,
               g.qty - coalesce(qty_back, 0) AS comp_qty, g.alt - coalesce(alt_back, 0) AS comp_qty_case,
               (g.qty - coalesce(qty_back, 0)) * rate AS value
        FROM given AS g
        LEFT JOIN (SELECT voucher_no FROM in_range WHERE voucher_type = 'TI') AS x ON g.ref_no = x.voucher_no
        LEFT JOIN (SELECT voucher_no, product_id, sum(qty_out) AS qty, sum(alt_out) AS alt FROM in_range
                   JOIN sales_line USING (voucher_no) WHERE voucher_type = 'TI' GROUP BY ALL) AS s
               ON s.voucher_no = x.voucher_no AND s.product_id = g.product_id
        LEFT JOIN back_any AS b ON b.bill = g.voucher_no AND b.product_id = g.product_id
        LEFT JOIN account ON g.party_id = account_id
        JOIN product ON product.product_id = g.product_id
        LEFT JOIN distributor ON distributor.distributor_id = g.distributor_id"""
    answers["claim_billwise"] = f"""
        SELECT trn_date, nav_code, nav_name, product_id AS product_code, product_name, pan, party_name, ref_bill_no,
               {dec("qty", 4)} AS qty, {dec("qty_case", 4)} AS qty_case, type, comp_ref_no, {dec("comp_qty", 4)} AS comp_qty,
               {dec("comp_qty_case", 4)} AS comp_qty_case, rate AS comp_rate, {dec("value", 2)} AS comp_amount,
               CASE WHEN type = 'AC' THEN 0 ELSE {money("value / 0.85 * 0.15")} END AS tds_15,
               CASE WHEN type = 'AC' THEN {dec("value", 2)} ELSE {money("value / 0.85")} END AS total_amount
        FROM ({detail})
        UNION ALL
        SELECT NULL, nav_code, nav_name, NULL, 'Total >>', NULL, NULL, NULL, {dec("sum(qty)", 4)},
               {dec("sum(qty_case)", 4)}, type, NULL, {dec("sum(comp_qty)", 4)}, {dec("sum(comp_qty_case)", 4)}, NULL,
               {dec("sum(value)", 2)}, CASE WHEN type = 'AC' THEN 0 ELSE {money("sum(value) / 0.85 * 0.15")} END,
               CASE WHEN type = 'AC' THEN {dec("sum(value)", 2)} ELSE {money("sum(value) / 0.85")} END
        FROM ({detail}) GROUP BY nav_code, nav_name, type"""
    return {k: with_views(v, EXTRA) for k, v in answers.items()}


def _others() -> dict[str, str]:
    names = {"d1": "day", "mo": "month", "mo_ly": "month_last_year", "pm_ly": "previous_month_last_year",
             "yr": "year", "ly": "last_year", "q3": "three_months"}

    def windows(*chosen: str) -> str:
        return " UNION ALL ".join(
            f"SELECT '{names[w]}' AS window_name, strftime({w}_a, '%Y-%m-%d') AS first_day, "
            f"strftime({w}_b, '%Y-%m-%d') AS last_day, "
            f"(SELECT count(*) FROM sales_voucher WHERE posted_on BETWEEN {w}_a AND {w}_b) AS vouchers FROM win"
            for w in chosen
        )

    months = ("poush", "magh", "falgun", "chaitra", "baishak", "jestha", "ashad", "shrawan", "bhadra", "asoj",
              "kartik", "mangsir")
    two = "format('{{:,.2f}}', CAST({} AS DECIMAL(32,2)))"

    def text(column: str) -> str:
        return two.format(column)

    companies = ", ".join(repr(c) for c in CSV_COMPANIES)
    losses = f"""
        SELECT delivery_note, pws_no, strftime(posted_on, '%Y-%m-%d') AS invoice_date, distributor_name, carrier,
               product_name, qty_in, rate, coalesce(leakage, 0) AS leakage, coalesce(breakage, 0) AS breakage,
               coalesce(shortage, 0) AS shortage, coalesce(carton, 0) AS carton,
               (coalesce(leakage, 0) + coalesce(breakage, 0) + coalesce(shortage, 0) + coalesce(carton, 0)) * rate AS amount,
               vehicle_no, driver_name, driver_no
        FROM receipt AS r JOIN purchase_voucher AS p ON p.voucher_no = r.ref_no
        JOIN purchase_line AS l ON l.voucher_no = p.voucher_no
        JOIN transit_loss AS t ON t.voucher_no = r.voucher_no AND t.product_id = l.product_id AND t.maker_id = l.maker_id
        JOIN consignment AS c ON c.voucher_no = r.voucher_no
        JOIN product ON product.product_id = l.product_id
        LEFT JOIN distributor ON distributor.distributor_id = p.distributor_id
        WHERE {_between("p.posted_on", CLAIM_RANGE)}"""
    measured = ("leakage", "breakage", "shortage", "carton", "amount")
    buckets = ", ".join(f"{money(b)} AS {b}" for b in _CASE_BUCKETS)
    bucket_totals = ", ".join(f"{money(f'sum({b})')} AS {b}" for b in _CASE_BUCKETS)
    answers = {
        "calendar_windows": windows("mo", "mo_ly", "yr", "ly"),
        "calendar_prev_month": windows("pm_ly"),
        "calendar_last3": windows("d1", "mo", "q3"),
        "calendar_fiscal_grid": f"""
            SELECT CAST(ordinal AS INTEGER) AS ordinal, {list(months)}[ordinal] AS window_name,
                   strftime(a, '%Y-%m-%d') AS first_day, strftime(b, '%Y-%m-%d') AS last_day, count(voucher_no) AS vouchers
            FROM fiscal LEFT JOIN sales_voucher ON posted_on BETWEEN a AND b GROUP BY ALL""",
        "user_hierarchy": """
            SELECT DISTINCT node_id AS id, node_name AS name, node_code AS code, division, node_type AS type,
                   parent_id AS parent, account_id AS acid, node_id AS socode, distributor_id AS companyid
            FROM walk JOIN node_account USING (node_id)""",
        "filter_csv_scope": f"""
            SELECT distributor_id, count(*) AS vouchers FROM in_range WHERE distributor_id IN ({companies})
            GROUP BY distributor_id""",
        "brand_vertical": """
            SELECT brand_code, brand_name, vertical, count(product_id) AS products
            FROM brands LEFT JOIN product USING (brand_code) GROUP BY ALL""",
        "stock_movement": "SELECT * FROM movement",
        "stock_summary": f"""
            SELECT coalesce(nav_code, '') AS nav_code, coalesce(nav_name, '') AS nav_name, distributor_name,
                   distributor_id AS distributor_code, coalesce(region, '') AS region, product_id AS product_code,
                   product_name, {buckets}
            FROM stock_cases LEFT JOIN distributor USING (distributor_id)""",
        "stock_summary_total": f"SELECT 'Total' AS product_name, {bucket_totals} FROM stock_cases",
        "net_amount_by_outlet": f"""
            SELECT distributor_id, party_id,
                   {dec("sum(CASE voucher_type WHEN 'CN' THEN -net_amount ELSE net_amount END)", 4)} AS net_amount
            FROM bill_outlet GROUP BY ALL""",
        "outlet_master": """
            SELECT region, d.distributor_id AS distributor_code, distributor_name, account_name AS outlet_name,
                   tax_no AS outlet_pan, address AS outlet_address, state_name AS province, org_name AS outlet_type,
                   ch.channel_name AS channel, sc.channel_name AS sub_channel, sg.channel_name AS segment,
                   no_of_bills, CAST(round(cases, 6) AS DECIMAL(32,6)) AS total_sales
            FROM distributor AS d JOIN account AS o ON o.distributor_id = d.distributor_id
            JOIN (SELECT distributor_id, party_id, sum(cases) AS cases,
                         count(DISTINCT voucher_no) FILTER (voucher_type <> 'CN') AS no_of_bills
                  FROM bill_outlet GROUP BY ALL) AS s
              ON s.distributor_id = d.distributor_id AND s.party_id = o.account_id
            LEFT JOIN org_type USING (org_code)
            LEFT JOIN state USING (state_code)
            LEFT JOIN channel AS ch ON ch.channel_code = o.channel_code AND ch.channel_type = 'CHANNEL'
            LEFT JOIN channel AS sc ON sc.channel_code = o.subchannel_code AND sc.channel_type = 'SUB-CHANNEL'
            LEFT JOIN channel AS sg ON sg.channel_code = o.segment_code AND sg.channel_type = 'SEGMENT'
            WHERE account_id LIKE 'PA%' AND (party_kind = 'C' OR is_common = 1) AND d.distributor_id <> 'CENTRAL'""",
        "transport_claim": f"""
            SELECT delivery_note, pws_no, invoice_date, distributor_name, carrier AS transport_name,
                   product_name AS description, {text("qty_in")} AS invoice_qty, {text("rate")} AS dispatch_rate,
                   {", ".join(f"{text(m)} AS {m}" for m in measured)}, vehicle_no AS truck_number, driver_name,
                   driver_no AS driver_number
            FROM ({losses})
            UNION ALL
            SELECT chr(10) || chr(13), {", ".join(["NULL"] * 15)}
            UNION ALL
            SELECT 'TOTAL', NULL, NULL, NULL, NULL, NULL, {text("sum(qty_in)")}, NULL,
                   {", ".join(text(f"sum({m})") for m in measured)}, NULL, NULL, NULL
            FROM ({losses})""",
    }
    return {k: with_views(v, EXTRA) for k, v in answers.items()}


def all_answers() -> dict[str, str]:
    answers = {**_dashboards(False), **_dashboards(True), **_claims(), **_others()}
    answers["user_hierarchy_sql"] = answers["user_hierarchy"]  # the SQL table function gives the same rows
    return answers
