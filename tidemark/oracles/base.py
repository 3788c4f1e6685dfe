"""Common table expressions that build the same bank in DuckDB, and a helper to prefix them."""

from __future__ import annotations

import re

from tidemark import constants as K


def lookup(values, index: str) -> str:
    names = ", ".join(f"'{v}'" for v in values)
    return f"([{names}])[CAST({index} AS INT) + 1]"


def half_up(total: str, n: str, digits: int) -> str:
    """Mean of integers `total` / n, rounded half away from zero, as a scaled double."""
    return (
        f"(sign({total}) * ((2 * abs({total}) + {n}) // (2 * {n})) / {float(10 ** digits)})"
    )


def persona_values(*positions: int) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)"

    return ", ".join("(" + ", ".join(lit(p[i]) for i in positions) + ")" for p in K.PERSONAS)


MONTH = "CAST(DATE '2024-01-01' + to_months(CAST({} AS INT)) AS DATE)"
FOLD = "((year({0}) * 12 + month({0}) - 1) % 24)"
CENTS = "CAST(round(({}) * 100) AS BIGINT)"


def shift(month: str, n: str) -> str:
    return f"CAST({month} + to_months(CAST({n} AS INT)) AS DATE)"


def emi(p: str, rate: str, n: str) -> str:
    r = f"(CAST({rate} AS DOUBLE) / 1200.0)"
    g = f"pow(CAST(1.0 AS DOUBLE) + {r}, {n})"
    return f"round(CAST({p} AS DOUBLE) * {r} * {g} / ({g} - CAST(1.0 AS DOUBLE)), 2)"


def uniform(key: str, seed: int) -> str:
    digits = f"substr(md5('{seed}:' || CAST(CAST({key} AS BIGINT) AS VARCHAR)), 1, 15)"
    return f"(CAST('0x' || {digits} AS BIGINT) % 1000000)"


PRODUCT_ARITHMETIC = {
    **{
        name: f"(c * 7 + {5 * k}) % 30 <= idx + {k % 3}"
        for k, name in enumerate(K.PRODUCT_FLAGS[:9])
    },
    K.PRODUCT_FLAGS[9]: "(c + idx) % 11 = 0",
}

CTES: dict[str, str] = {
    "months": f"SELECT CAST(i AS INT) AS idx, {MONTH.format('i')} AS m FROM range(24) t(i)",
    "cust": f"""
        SELECT c_custkey AS customer_id, {lookup(K.PERSONA_NAMES, 'c_custkey % 6')} AS persona,
          CAST(300000 + (CAST(c_acctbal AS DECIMAL(18,2)) + 1000) * 100 AS DECIMAL(18,2))
            AS annual_income,
          make_date(2014 + c_custkey % 10, c_custkey % 12 + 1, 1) AS customer_since,
          r_name || ' ' || (n_nationkey % 2) AS city, r_name AS state,
          'B' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS branch_code,
          CAST(200 * (CAST(c_acctbal AS DECIMAL(18,2)) + 1000) AS DECIMAL(18,2)) AS wealth,
          c_name, c_mktsegment
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "branch": """
        SELECT 'B' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS branch_code,
          n_name AS branch_name, r_name || ' ' || (n_nationkey % 2) AS city, r_name AS state,
          DATE '2010-01-01' AS open_date, CAST(1 + n_nationkey % 18 AS INT) AS customer_weight
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "acct": """
        SELECT 10000000 + customer_id AS account_id, customer_id, branch_code,
          'Savings' AS account_type,
          CASE WHEN customer_id % 7 = 0 THEN make_date(2012 + 4 * (customer_id % 3), 2, 29)
               ELSE customer_since END AS open_date,
          CASE WHEN customer_id % 20 = 0 THEN 'Dormant' ELSE 'Active' END AS account_status,
          persona IN ('salary_core', 'complaint_prone_churner') AS salary_account_flag,
          CAST(0 AS DECIMAL(18,2)) AS overdraft_limit, wealth AS opening_balance
        FROM cust
        UNION ALL
        SELECT 15000000 + customer_id, customer_id, branch_code, 'Current',
          CAST(customer_since + INTERVAL 6 MONTH AS DATE), 'Active', false,
          CAST(CASE WHEN customer_id % 2 = 0 THEN 25000 ELSE 50000 END AS DECIMAL(18,2)),
          CAST(wealth / 2 AS DECIMAL(18,2))
        FROM cust WHERE customer_id % 5 = 0""",
    "card": f"""
        SELECT k.card_id, k.customer_id, k.card_type, k.issue_date, k.card_status,
          k.credit_limit, k.persona,
          CASE WHEN month(k.issue_date) = 2 AND day(k.issue_date) = 29
               THEN make_date(year(k.issue_date) + 5, 3, 1)
               ELSE CAST(k.issue_date + INTERVAL 60 MONTH AS DATE) END AS expiry_date
        FROM (
          SELECT 20000000 + customer_id AS card_id, customer_id, persona, 'Debit' AS card_type,
            CASE WHEN customer_id % 7 = 0 THEN make_date(2012 + 4 * (customer_id % 3), 2, 29)
                 ELSE customer_since END AS issue_date,
            'Active' AS card_status, CAST(0 AS DECIMAL(18,2)) AS credit_limit
          FROM cust WHERE customer_id % 10 <> 0
          UNION ALL
          SELECT 25000000 + customer_id, customer_id, persona, 'Credit', customer_since,
            CASE WHEN customer_id % 33 = 0 THEN 'Blocked' ELSE 'Active' END,
            CAST(greatest(10000.0,
              round_even(CAST(annual_income AS DOUBLE) / 12.0 * 3.0 / 1000.0, 0) * 1000.0)
              AS DECIMAL(18,2))
          FROM cust WHERE customer_id % 3 = 0) k""",
    "loan": f"""
        SELECT *, CAST({emi('sanctioned_amount', 'interest_rate', 'tenure_months')}
          AS DECIMAL(18,2)) AS emi_amount,
          {shift('disbursement_date', 'tenure_months')} AS maturity_date
        FROM (
          SELECT 30000000 + customer_id AS loan_id, customer_id, branch_code,
            CASE WHEN customer_id % 8 = 1 THEN 'Personal Loan' ELSE 'Home Loan' END AS loan_type,
            CAST(CASE WHEN customer_id % 8 = 1 THEN 50000 + (customer_id % 50) * 1000
              ELSE 2000000 + (customer_id % 20) * 50000 END AS DECIMAL(18,2))
              AS sanctioned_amount,
            make_date(2023, customer_id % 12 + 1, 1) AS disbursement_date,
            CAST(8.5 + (customer_id % 13) * 0.5 AS DOUBLE) AS interest_rate,
            CAST(CASE WHEN customer_id % 8 = 1 THEN 12 * (1 + customer_id % 5) ELSE 120 END AS INT)
              AS tenure_months
          FROM cust WHERE customer_id % 4 = 1)""",
    "line": """
        SELECT l_orderkey, l_linenumber, min(l_shipdate) AS shipped,
          CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount
        FROM lineitem GROUP BY ALL""",
    "txn": f"""
        SELECT l_orderkey * 10 + l_linenumber AS transaction_id,
          o_custkey + CASE WHEN o_custkey % 5 = 0 AND l_linenumber % 4 = 0 THEN 15000000
                           ELSE 10000000 END AS account_id,
          o_custkey AS customer_id, {MONTH.format(FOLD.format('shipped'))} AS txn_month,
          {MONTH.format(FOLD.format('shipped'))} + (least(day(shipped), 28) - 1)::INT
            AS txn_date,
          l_linenumber AS ln, l_orderkey AS order_key, amount,
          CASE WHEN o_orderstatus = 'F' THEN 'Credit' ELSE 'Debit' END AS direction,
          {lookup(K.TXN_CHANNELS, 'l_linenumber - 1')} AS channel,
          'M' || (l_orderkey % 37) AS merchant_name,
          o_orderstatus = 'F' AND l_linenumber = 1 AS is_salary_credit,
          o_orderstatus <> 'F' AND l_linenumber = 7 AS is_fee,
          CASE WHEN o_orderstatus = 'F' THEN amount ELSE -amount END AS signed
        FROM line JOIN orders ON l_orderkey = o_orderkey""",
    "ledger": """
        SELECT txn.*, CAST(opening_balance + sum(signed) OVER (PARTITION BY txn.account_id
          ORDER BY txn_date, ln, transaction_id ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2))
          AS balance_after_txn,
          row_number() OVER (PARTITION BY txn.account_id, txn_month
            ORDER BY txn_date DESC, ln DESC, transaction_id DESC) AS from_end
        FROM txn LEFT JOIN acct ON txn.account_id = acct.account_id""",
    "acct_month": f"""
        SELECT account_id, txn_month AS m, max(CASE WHEN from_end = 1 THEN balance_after_txn END)
          AS closing, {half_up(CENTS.format('sum(balance_after_txn)'), 'count(*)', 2)} AS mean_bal,
          min(balance_after_txn) AS lo, max(balance_after_txn) AS hi,
          count(*) FILTER (WHERE direction = 'Credit') AS credits,
          count(*) FILTER (WHERE direction <> 'Credit') AS debits,
          sum(amount) FILTER (WHERE is_fee) AS fees,
          sum(amount) FILTER (WHERE is_salary_credit) AS salary
        FROM ledger GROUP BY account_id, txn_month""",
    "acct_snap": """
        SELECT account_id, m AS snapshot_month, customer_id, account_status,
          current_balance,
          CAST(coalesce(mean_bal, current_balance) AS DECIMAL(18,2)) AS average_monthly_balance,
          coalesce(lo, current_balance) AS min_balance_30d,
          coalesce(hi, current_balance) AS max_balance_30d,
          CAST(coalesce(credits, 0) AS INT) AS credit_txn_count,
          CAST(coalesce(debits, 0) AS INT) AS debit_txn_count,
          CAST(coalesce(fees, 0) AS DECIMAL(18,2)) AS fee_charged_amount,
          CAST(coalesce(salary, 0) AS DECIMAL(18,2)) AS salary_credit_amount
        FROM (
          SELECT a.account_id, a.customer_id, a.account_status, months.m, am.* EXCLUDE (account_id, m),
            coalesce(last_value(am.closing IGNORE NULLS) OVER (PARTITION BY a.account_id
              ORDER BY months.m ROWS UNBOUNDED PRECEDING), a.opening_balance) AS current_balance
          FROM acct a CROSS JOIN months
          LEFT JOIN acct_month am ON am.account_id = a.account_id AND am.m = months.m
          WHERE months.m >= date_trunc('month', a.open_date))""",
    "complaint": f"""
        SELECT o_orderkey AS complaint_id, o_custkey AS customer_id,
          {MONTH.format(FOLD.format('o_orderdate'))} AS complaint_month,
          {MONTH.format(FOLD.format('o_orderdate'))} + (least(day(o_orderdate), 28) - 1)::INT
            AS complaint_date,
          {lookup(K.COMPLAINT_CATEGORIES, 'o_orderkey % 5')} AS category,
          {lookup(K.COMPLAINT_ROOT_CAUSES, 'o_orderkey % 5')} AS root_cause,
          {lookup(('Low', 'Medium', 'High'), 'o_orderkey % 3')} AS severity,
          CAST(CASE WHEN o_orderstatus = 'F' THEN 7 + o_orderkey % 69 END AS INT)
            AS resolution_days,
          o_orderstatus = 'F' AS resolved_flag
        FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "feedback": f"""
        SELECT o_orderkey AS feedback_id, o_custkey AS customer_id,
          {MONTH.format(FOLD.format('o_orderdate'))} AS feedback_month,
          CAST(CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 11 END AS INT) AS nps_score,
          {lookup(('General', 'Digital Experience', 'Complaint Resolution'), 'o_orderkey % 3')}
            AS survey_topic
        FROM orders WHERE o_orderpriority = '5-LOW'""",
    "event": f"""
        SELECT DISTINCT customer_id, txn_month AS event_month,
          {lookup(K.EVENTS, '(order_key + 5 * ln) % 12')} AS event_type
        FROM txn WHERE ln IN (2, 3)""",
    "hold": f"""
        SELECT customer_id, m AS snapshot_month, idx, {', '.join(K.PRODUCT_FLAGS)},
          CAST({' + '.join(f'CAST({f} AS INT)' for f in K.PRODUCT_FLAGS)} AS INT)
            AS products_count
        FROM (SELECT customer_id, m, idx,
          {', '.join(f'{e} AS {n}' for n, e in PRODUCT_ARITHMETIC.items())}
          FROM (SELECT customer_id, customer_id AS c, m, idx FROM cust CROSS JOIN months))""",
    "acquired": " UNION ALL ".join(
        f"SELECT customer_id, '{name}' AS product, "
        f"greatest(0, (customer_id * 7 + {5 * k}) % 30 - {k % 3}) AS idx FROM cust "
        f"WHERE greatest(0, (customer_id * 7 + {5 * k}) % 30 - {k % 3}) < 24"
        for k, name in enumerate(K.PRODUCT_FLAGS[:9])
    ),
    "active_month": """
        SELECT customer_id, m AS snapshot_month FROM state CROSS JOIN months
        WHERE churn_month IS NULL OR m <= churn_month""",
    "activity": f"""
        SELECT a.customer_id, a.snapshot_month,
          CAST(count(*) FILTER (WHERE channel IN ('UPI', 'Internet Banking', 'Mobile App'))
            AS INT) AS login_count,
          CAST(count(*) FILTER (WHERE direction = 'Debit') AS INT) AS debit_txn_count,
          CAST(count(*) FILTER (WHERE direction = 'Credit') AS INT) AS credit_txn_count,
          CAST(coalesce(sum(amount) FILTER (WHERE direction = 'Debit'), 0) AS DECIMAL(18,2))
            AS total_debit_amount,
          CAST(coalesce(sum(amount) FILTER (WHERE direction = 'Credit'), 0) AS DECIMAL(18,2))
            AS total_credit_amount,
          CAST(coalesce({half_up(
              CENTS.format("sum(amount) FILTER (WHERE direction = 'Debit')"),
              "nullif(count(*) FILTER (WHERE direction = 'Debit'), 0)", 2)}, 0)
            AS DECIMAL(18,2)) AS avg_transaction_value,
          CAST(count(DISTINCT merchant_name) AS INT) AS unique_merchants,
          CAST(count(*) FILTER (WHERE channel = 'ATM') AS INT) AS cash_withdrawal_count,
          CAST(count(*) FILTER (WHERE channel = 'POS') AS INT) AS card_present_txn_count,
          CAST(count(*) FILTER (WHERE channel IN ('UPI', 'Internet Banking', 'Mobile App'))
            AS INT) AS card_not_present_txn_count,
          CAST(coalesce(date_diff('day', (SELECT max(p.txn_date) FROM txn p
            WHERE p.customer_id = a.customer_id AND p.txn_month <= a.snapshot_month),
            last_day(a.snapshot_month)), {K.DEFAULT_DORMANT_DAYS}) AS INT)
            AS days_since_last_txn
        FROM active_month a LEFT JOIN txn
          ON txn.customer_id = a.customer_id AND txn.txn_month = a.snapshot_month
        GROUP BY a.customer_id, a.snapshot_month""",
    "digital": """
        SELECT a.customer_id, a.snapshot_month,
          count(*) FILTER (WHERE channel = 'Mobile App') > 0 AS mobile_app_active,
          (SELECT max(p.txn_date) FROM txn p WHERE p.customer_id = a.customer_id
            AND p.txn_month <= a.snapshot_month
            AND p.channel IN ('UPI', 'Internet Banking', 'Mobile App')) AS last_login_date,
          count(*) FILTER (WHERE channel = 'Mobile App') AS campaigns_received,
          count(*) FILTER (WHERE channel = 'Mobile App' AND direction = 'Credit')
            AS campaigns_responded,
          count(*) FILTER (WHERE channel = 'Internet Banking') AS web_sessions
        FROM active_month a LEFT JOIN txn
          ON txn.customer_id = a.customer_id AND txn.txn_month = a.snapshot_month
        GROUP BY a.customer_id, a.snapshot_month""",
    "pay": """
        SELECT loan_id, loan.customer_id, m, idx,
          EXISTS (SELECT 1 FROM txn WHERE txn.customer_id = loan.customer_id
            AND txn.txn_month = months.m) AS paid
        FROM loan CROSS JOIN months""",
    "loan_open": """
        SELECT loan_id, 0 AS k, CAST(sanctioned_amount AS DOUBLE) AS o,
          CAST(emi_amount AS DOUBLE) AS emi, interest_rate / 1200.0 AS r,
          CAST(12 - month(disbursement_date) + 1 AS INT) AS elapsed
        FROM loan
        UNION ALL
        SELECT loan_id, k + 1, greatest(0.0, o - (emi - o * r)), emi, r, elapsed
        FROM loan_open WHERE k < elapsed""",
    "loan_state": """
        SELECT p.loan_id, p.customer_id, -1 AS idx, CAST(NULL AS DATE) AS m, lo.o, 0 AS dpd,
          CASE WHEN lo.o > 0 THEN 'Active' ELSE 'Closed' END AS st, lo.emi, lo.r
        FROM loan p JOIN loan_open lo ON p.loan_id = lo.loan_id AND lo.k = lo.elapsed
        UNION ALL
        SELECT s.loan_id, s.customer_id, pay.idx, pay.m,
          CASE WHEN s.st = 'Active' AND pay.paid
               THEN greatest(0.0, s.o - least(s.emi - s.o * s.r, s.o)) ELSE s.o END,
          CASE WHEN s.st <> 'Active' THEN s.dpd WHEN pay.paid THEN 0
               ELSE least(90, s.dpd + 30) END,
          CASE WHEN s.st <> 'Active' THEN s.st
               WHEN pay.paid AND greatest(0.0, s.o - least(s.emi - s.o * s.r, s.o)) <= 0
                 THEN 'Closed'
               WHEN NOT pay.paid AND s.dpd + 30 >= 90 THEN 'Delinquent' ELSE s.st END,
          s.emi, s.r
        FROM loan_state s JOIN pay ON pay.loan_id = s.loan_id AND pay.idx = s.idx + 1""",
    "card_month": """
        SELECT card_id, a.snapshot_month,
          CAST(coalesce(sum(amount) FILTER (WHERE channel = 'POS' AND direction = 'Debit'), 0)
            AS DOUBLE) AS spend,
          count(*) FILTER (WHERE channel = 'POS' AND direction = 'Debit') AS purchases,
          CASE WHEN count(*) FILTER (WHERE direction = 'Credit') > 0 THEN 'full'
               WHEN count(amount) > 0 AND count(amount) % 2 = 0 THEN 'min' ELSE 'none' END
            AS capacity,
          row_number() OVER (PARTITION BY card_id ORDER BY a.snapshot_month) AS k
        FROM card JOIN active_month a ON card.customer_id = a.customer_id
          AND card.card_type = 'Credit' AND a.snapshot_month >= date_trunc('month', issue_date)
        LEFT JOIN txn ON txn.customer_id = a.customer_id AND txn.txn_month = a.snapshot_month
        GROUP BY card_id, a.snapshot_month""",
    "card_bal": """
        SELECT DISTINCT card_id, CAST(0 AS BIGINT) AS k, CAST(0 AS DOUBLE) AS b,
          CAST(NULL AS DATE) AS snapshot_month, CAST(0 AS BIGINT) AS purchases
        FROM card_month
        UNION ALL
        SELECT c.card_id, m.k,
          CASE WHEN c.b + m.spend <= 0 THEN c.b + m.spend
               WHEN m.capacity = 'full' THEN CAST(0 AS DOUBLE)
               WHEN m.capacity = 'min' THEN ((c.b + m.spend)
                 - (c.b + m.spend) * CAST(0.05 AS DOUBLE)) * CAST(1.02 AS DOUBLE)
               ELSE (c.b + m.spend) * CAST(1.03 AS DOUBLE) END,
          m.snapshot_month, m.purchases
        FROM card_bal c JOIN card_month m ON m.card_id = c.card_id AND m.k = c.k + 1""",
    "card_snap": """
        SELECT b.card_id, c.customer_id, b.snapshot_month,
          CAST(round(b.b, 2) AS DECIMAL(18,2)) AS monthly_spend_amount,
          CAST(CASE WHEN b.b > 0 THEN b.purchases ELSE 0 END AS INT) AS monthly_txn_count,
          CAST(round(CASE WHEN c.credit_limit > 0 THEN b.b / CAST(c.credit_limit AS DOUBLE)
            ELSE 0 END, 4) AS DECIMAL(10,4)) AS utilization_rate,
          CAST(round(b.b * CAST(0.05 AS DOUBLE), 2) AS DECIMAL(18,2)) AS min_due_amount,
          b.b > CAST(c.credit_limit AS DOUBLE) AS delinquency_flag
        FROM card_bal b JOIN card c ON c.card_id = b.card_id WHERE b.k > 0
        UNION ALL
        SELECT c.card_id, c.customer_id, a.snapshot_month,
          CAST((CAST(total_debit_amount * 100 AS BIGINT) * 3 + 5) // 10 / 100.0
            AS DECIMAL(18,2)), a.debit_txn_count,
          CAST(0 AS DECIMAL(10,4)), CAST(0 AS DECIMAL(18,2)), false
        FROM activity a JOIN card c ON c.customer_id = a.customer_id AND c.card_type = 'Debit'
          AND a.snapshot_month >= date_trunc('month', c.issue_date)""",
    "loan_snap": """
        SELECT loan_id, customer_id, m AS snapshot_month,
          CAST(round(o, 2) AS DECIMAL(18,2)) AS outstanding_balance,
          CAST(emi AS DECIMAL(18,2)) AS emi_amount, CAST(dpd AS INT) AS dpd_days,
          CAST(CASE WHEN dpd > 0 THEN emi ELSE 0 END AS DECIMAL(18,2)) AS overdue_amount,
          CAST(round(CASE WHEN dpd > 0 THEN 0 ELSE least(emi - o * r, o) END, 2)
            AS DECIMAL(18,2)) AS principal_paid_amount,
          CAST(round(CASE WHEN dpd > 0 THEN 0 ELSE o * r END, 2) AS DECIMAL(18,2))
            AS interest_paid_amount,
          CAST(CASE WHEN dpd > 0 THEN 0 ELSE emi END AS DECIMAL(18,2))
            AS installment_paid_amount,
          st AS loan_status
        FROM loan_state WHERE idx >= 0""",
    "state": f"""
        SELECT cust.customer_id, persona, cust.customer_id % 8 = 0 AS low_sensitivity_segment,
          CASE WHEN last_month < DATE '2025-12-01' THEN {shift('last_month', '1')} END
            AS churn_month,
          last_month < DATE '2025-12-01' AND last_month IS NOT NULL AS churned_flag,
          CASE WHEN last_month < DATE '2025-12-01'
               THEN {lookup(K.CHURN_REASONS, 'cust.customer_id % 7')} END AS churn_reason,
          CAST(coalesce(CASE WHEN last_month < DATE '2025-12-01'
            THEN date_diff('month', DATE '2024-01-01', last_month) + 2 END, 24) AS INT)
            AS active_months_generated
        FROM cust LEFT JOIN (SELECT customer_id, max(txn_month) AS last_month FROM txn
          GROUP BY customer_id) t ON t.customer_id = cust.customer_id""",
    "label": f"""
        SELECT customer_id, m AS as_of_month, CAST(h AS INT) AS prediction_horizon_months,
          coalesce(churn_month <= {shift('m', 'h')}, false) AS churned,
          CASE WHEN churn_month <= {shift('m', 'h')} THEN churn_month END AS churn_date,
          CASE WHEN churn_month <= {shift('m', 'h')} THEN churn_reason END AS churn_reason
        FROM state CROSS JOIN months CROSS JOIN (VALUES (1), (3), (6), (12)) t(h)
        WHERE churn_month IS NULL OR m < churn_month""",
    "spine": """
        SELECT DISTINCT customer_id, as_of_month FROM label
        WHERE as_of_month >= (SELECT min(snapshot_month) + INTERVAL 6 MONTH FROM hold)""",
    "resolved": """
        SELECT c.complaint_id, c.customer_id, c.complaint_month, c.severity,
          min(e.event_month) AS resolved_month
        FROM complaint c LEFT JOIN event e ON e.customer_id = c.customer_id
          AND e.event_type = 'complaint_resolved' AND e.event_month > c.complaint_month
        GROUP BY ALL""",
}


def oracle(sql: str) -> str:
    """Prefix a query with the table expressions it names, each after those it needs itself."""
    seen: set[str] = set()
    needed: list[str] = []

    def visit(names: set[str]) -> None:
        for name in sorted(names & CTES.keys()):
            if name not in seen:
                seen.add(name)
                visit(set(re.findall(r"(?:FROM|JOIN)\s+([a-z_]+)", CTES[name])))
                needed.append(name)

    visit(set(re.findall(r"[a-z_]+", sql)))
    ctes = [f"{name} AS ({CTES[name]})" for name in needed]
    return f"WITH RECURSIVE {', '.join(ctes)} {sql}" if ctes else sql
