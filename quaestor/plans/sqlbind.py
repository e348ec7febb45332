"""The binding of ``bindings.py`` as SQL CTEs for the DuckDB oracle.

Each constant is a CTE body; ``with_(...)`` assembles a WITH clause from the
names a query needs (dependencies first).
"""

from __future__ import annotations

MONEY = "DECIMAL(19,2)"

CTES = {
    "party": f"""SELECT c_custkey AS party_id, c_name AS party_name, c_nationkey AS nation_key,
        c_mktsegment AS segment, CAST(c_acctbal AS {MONEY}) AS balance FROM customer""",
    "return_lines": f"""SELECT l_orderkey AS return_id, l_linenumber AS line_number, l_partkey AS part_id,
        l_suppkey AS supplier_id, CAST(l_extendedprice AS {MONEY}) AS line_amount,
        l_returnflag AS charge_type_code, l_linestatus AS line_status, CAST(l_shipdate AS DATE) AS ship_date,
        CAST(CAST(l_extendedprice AS {MONEY}) * (1 - CAST(l_discount AS {MONEY})) AS {MONEY}) AS payment_amount,
        CAST(l_discount AS {MONEY}) AS discount, CAST(l_tax AS {MONEY}) AS tax_rate FROM lineitem""",
    "line_totals": """SELECT return_id, COUNT(*) AS line_count, SUM(line_amount) AS declared_amount,
        SUM(payment_amount) AS paid_amount, MIN(ship_date) AS first_ship_date, MAX(ship_date) AS last_ship_date
        FROM return_lines GROUP BY return_id""",
    "returns": f"""SELECT o_orderkey AS return_id, o_custkey AS party_id, o_orderpriority AS tax_type_code,
        CAST(o_orderdate AS DATE) AS period_date, CAST(o_totalprice AS {MONEY}) AS assessed_amount,
        o_orderstatus AS status, CAST(last_day(CAST(o_orderdate AS DATE)) + 15 AS DATE) AS due_date FROM orders""",
    "filings": """SELECT r.*, t.line_count, t.declared_amount, t.paid_amount, t.first_ship_date, t.last_ship_date,
        t.first_ship_date AS filing_date,
        CASE WHEN t.first_ship_date IS NOT NULL THEN 1 ELSE 0 END AS is_filed,
        CASE WHEN t.first_ship_date IS NOT NULL AND t.first_ship_date > r.due_date THEN 1 ELSE 0 END AS is_late,
        CASE WHEN t.first_ship_date IS NOT NULL AND t.first_ship_date <= r.due_date THEN 1 ELSE 0 END AS is_on_time,
        CASE WHEN t.first_ship_date IS NOT NULL THEN GREATEST(date_diff('day', r.due_date, t.first_ship_date), 0) END AS days_late
        FROM returns r LEFT JOIN line_totals t ON t.return_id = r.return_id""",
    "payments": """SELECT concat_ws('-', l.return_id, l.line_number, l.part_id, l.supplier_id, strftime(l.ship_date, '%Y%m%d')) AS payment_id, l.return_id, l.line_number, o.o_custkey AS party_id, o.o_orderpriority AS tax_type_code,
        l.ship_date AS payment_date, l.payment_amount, l.charge_type_code, l.line_status
        FROM return_lines l JOIN orders o ON o.o_orderkey = l.return_id""",
    "ledger": f"""SELECT party_id AS account_id, period_date AS txn_date, 'ASSESSMENT' AS txn_type,
        assessed_amount AS amount, return_id AS ref_id, 0 AS ref_line FROM returns
        UNION ALL
        SELECT party_id, payment_date, 'PAYMENT', CAST(-payment_amount AS {MONEY}), return_id, line_number FROM payments""",
    "ev": f"""SELECT event_id, ts AS event_ts, CAST(ts AS DATE) AS event_date, user_id AS party_id, event_type,
        CAST(value AS {MONEY}) AS event_value, props FROM events""",
}

DEPS = {
    "line_totals": ["return_lines"],
    "filings": ["returns", "line_totals"],
    "payments": ["return_lines"],
    "ledger": ["returns", "payments"],
}


def _order(names):
    out = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_(*names: str, extra: dict | None = None) -> str:
    """WITH clause for the named binding CTEs plus ``extra`` (name -> body)."""
    parts = [f"{n} AS ({CTES[n]})" for n in _order(names)]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v})")
    return "WITH " + ",\n".join(parts) + "\n"
