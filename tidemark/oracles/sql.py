"""One DuckDB query per Spark query, over the table expressions in `base`.

Features are written in join shape with half-open date ranges, folds as recursive queries and
streaks as gaps and islands, so they share no logic with the Spark plans they check.
"""

from __future__ import annotations

from tidemark import constants as K
from tidemark.oracles.base import (
    emi, half_up, lookup, oracle, persona_values, shift, uniform,
)
from tidemark.sources.schemas import COMPOSITE_KEYS, FOREIGN_KEYS, SINGLE_KEYS

SQL: dict[str, str] = {}
# Activity months that have a transaction.
BUSY = "debit_txn_count + credit_txn_count > 0"

# -- scans and sinks -----------------------------------------------------------------------
SQL |= {
    "scan_master": """SELECT customer_id, 'CIF' || customer_id AS cif_number, annual_income,
        customer_since, city, branch_code FROM cust""",
    "scan_month_partitions": """SELECT complaint_id, customer_id, complaint_month, severity
        FROM complaint WHERE complaint_month BETWEEN DATE '2024-06-01' AND DATE '2025-03-01'""",
    "write_master": """SELECT account_id, customer_id, account_type, open_date, account_status,
        salary_account_flag, overdraft_limit FROM acct""",
    "write_month_partitions": "SELECT feedback_id, customer_id, feedback_month, nps_score FROM feedback",
    "merge_chunk_outputs": """SELECT 'branch_master' AS table_name, branch_code AS id,
        city || '|' || state AS content FROM branch
        UNION ALL SELECT 'customer_master', CAST(customer_id AS VARCHAR),
          customer_since || '|' || branch_code || '|' || annual_income FROM cust
        UNION ALL SELECT 'customer_complaints', CAST(complaint_id AS VARCHAR),
          complaint_month || '|' || category || '|' || severity || '|' || resolved_flag
        FROM complaint""",
}

# -- expressions ---------------------------------------------------------------------------
INCOME = "CAST(annual_income AS DOUBLE) / 12.0"
R, N = "(interest_rate / 1200.0)", "tenure_months"
GROWTH = f"pow(CAST(1.0 AS DOUBLE) + {R}, {N})"
AFFORD = f"""
    SELECT loan_id, loan.customer_id, loan_type, max_emi, max_p, floor_amount,
      CASE WHEN max_p >= floor_amount
        THEN floor(least(CAST(sanctioned_amount AS DOUBLE), max_p) / step) * step END AS granted
    FROM (SELECT loan.*, floor_amount, step, {INCOME} * share AS max_emi,
        {INCOME} * share * ({GROWTH} - CAST(1.0 AS DOUBLE)) / ({R} * {GROWTH}) AS max_p
      FROM loan JOIN cust USING (customer_id)
      JOIN (VALUES ('Personal Loan', CAST(0.4 AS DOUBLE), CAST(50000 AS DOUBLE),
          CAST(1000 AS DOUBLE)),
        ('Home Loan', CAST(0.5 AS DOUBLE), CAST(2000000 AS DOUBLE), CAST(10000 AS DOUBLE)))
        l(loan_type, share, floor_amount, step) USING (loan_type)) loan"""
SQL |= {
    "month_shift": f"""SELECT complaint_id, complaint_month AS month,
        {shift('complaint_month', '-7')} AS back_7, {shift('complaint_month', '14')} AS ahead_14
        FROM complaint""",
    "month_calendar": "SELECT customer_id, m AS snapshot_month FROM cust CROSS JOIN months",
    "days_in_month": """SELECT txn_month, CAST(day(last_day(txn_month)) AS INT) AS days,
        count(*) AS txns FROM txn GROUP BY txn_month""",
    "tenure_months": """SELECT customer_id, CAST(date_diff('month', customer_since,
        DATE '2025-12-01') AS INT) AS tenure_months FROM cust""",
    "ratio_change": """SELECT customer_id, round(CASE WHEN p > 0 THEN (r - p) / p ELSE 0 END, 4)
        AS change FROM (SELECT customer_id,
          CAST(count(*) FILTER (WHERE year(txn_month) = 2025) AS DOUBLE) AS r,
          CAST(count(*) FILTER (WHERE year(txn_month) = 2024) AS DOUBLE) AS p
        FROM txn GROUP BY customer_id)""",
    "null_defaults": """SELECT customer_id, m AS snapshot_month,
        coalesce(days_since_last_txn, 180) AS dormant_days,
        coalesce(CAST(nps AS DOUBLE), 8.0) AS best_nps FROM cust CROSS JOIN months
        LEFT JOIN (SELECT customer_id, snapshot_month AS m, days_since_last_txn FROM activity) a
          USING (customer_id, m)
        LEFT JOIN (SELECT customer_id, max(nps_score) AS nps FROM feedback GROUP BY 1) f
          USING (customer_id)""",
    "floored_diff": """SELECT a.customer_id, CAST(greatest(0, a.products_count - b.products_count)
        AS INT) AS velocity FROM hold a JOIN hold b USING (customer_id)
        WHERE a.idx = 22 AND b.idx = 17""",
    "safe_rate": """SELECT customer_id, round(CAST(sum(campaigns_responded) AS DOUBLE)
        / nullif(sum(campaigns_received), 0), 6) AS rate FROM digital GROUP BY customer_id""",
    "emi_amount": f"SELECT loan_id, {emi('sanctioned_amount', 'interest_rate', N)} AS emi_amount FROM loan",
    "maturity_date": "SELECT loan_id, maturity_date FROM loan",
    "max_principal": f"""SELECT loan_id, round(max_emi, 2) AS max_emi,
        round(max_p, 2) AS max_principal FROM ({AFFORD})""",
    "loan_affordability": f"""SELECT loan_id, max_p >= floor_amount AS accepted,
        granted AS granted_amount FROM ({AFFORD})""",
    "credit_limit": """SELECT customer_id, CAST(greatest(10000.0, round_even(CAST(annual_income
        AS DOUBLE) / 12.0 * 3.0 / 1000.0, 0) * 1000.0) AS DECIMAL(18,2)) AS credit_limit
        FROM cust""",
    "card_tier": f"""SELECT card_id, persona, programme AS rewards_program, tier AS reward_tier
        FROM card JOIN (VALUES {persona_values(0, 6, 7)}) p(persona, programme, tier)
        USING (persona) WHERE card_type = 'Credit'""",
    "plus_years_leap": """SELECT account_id, CASE WHEN month(open_date) = 2 AND day(open_date) = 29
        THEN make_date(year(open_date) + 5, 3, 1)
        ELSE make_date(year(open_date) + 5, month(open_date), day(open_date)) END
        AS after_5_years FROM acct""",
    "logit_sigmoid": """SELECT customer_id, snapshot_month,
        round(ln(p / (1.0 - p)), 10) AS logit,
        round(CASE WHEN x >= 0 THEN 1.0 / (1.0 + exp(-x)) ELSE exp(x) / (1.0 + exp(x)) END, 10)
          AS sigmoid
        FROM (SELECT customer_id, snapshot_month,
          least(CAST(1.0 - 1e-5 AS DOUBLE), greatest(CAST(1e-5 AS DOUBLE),
            CASE WHEN credit_txn_count + debit_txn_count = 0 THEN CAST(0.5 AS DOUBLE) ELSE
            CAST(credit_txn_count AS DOUBLE) / (credit_txn_count + debit_txn_count) END)) AS p,
          CAST(credit_txn_count - debit_txn_count AS DOUBLE) AS x FROM activity)""",
    "clip_score": """SELECT feedback_id, CAST(least(10, greatest(0,
        round_even(CAST(nps_score AS DOUBLE) * 1.5 - 3.0, 0))) AS INT) AS clipped
        FROM feedback WHERE nps_score IS NOT NULL""",
    "products_count": "SELECT customer_id, snapshot_month, products_count FROM hold",
    "revoke_flag": f"""SELECT customer_id, snapshot_month,
        home_loan_flag AND r.customer_id IS NULL AS home_loan_flag,
        CAST(products_count - CASE WHEN home_loan_flag AND r.customer_id IS NOT NULL
          THEN 1 ELSE 0 END AS INT) AS products_count
        FROM hold LEFT JOIN (SELECT DISTINCT customer_id FROM ({AFFORD})
          WHERE loan_type = 'Home Loan' AND max_p < floor_amount) r USING (customer_id)""",
    "quarter_gate": """SELECT transaction_id, txn_month FROM txn
        WHERE month(txn_month) IN (3, 6, 9, 12)""",
    "channel_class": """SELECT channel, CASE channel WHEN 'ATM' THEN 'cash'
        WHEN 'POS' THEN 'card_present' WHEN 'UPI' THEN 'card_not_present'
        WHEN 'Mobile App' THEN 'card_not_present'
        WHEN 'Internet Banking' THEN 'card_not_present' ELSE 'other' END AS channel_class,
        count(*) AS txns FROM txn GROUP BY 1, 2""",
    "active_filter": """SELECT 'account' AS kind, account_id AS id FROM acct
        WHERE account_status = 'Active'
        UNION ALL SELECT 'complaint', complaint_id FROM complaint WHERE NOT resolved_flag
        UNION ALL SELECT 'salary month', account_id FROM acct_snap
        WHERE salary_credit_amount > 0""",
    "cast_contract": "SELECT * FROM label",
}

# -- joins ---------------------------------------------------------------------------------
RANGE_JOIN = """SELECT s.customer_id, s.as_of_month, count(c.complaint_id) AS complaints
    FROM spine s LEFT JOIN complaint c ON s.customer_id = c.customer_id
      AND c.complaint_month >= s.as_of_month - INTERVAL 6 MONTH
      AND c.complaint_month < s.as_of_month
    GROUP BY ALL"""
SQL |= {
    "join_dim_inner": """SELECT acct.customer_id, acct_snap.account_id, snapshot_month,
        current_balance FROM acct_snap JOIN acct USING (account_id)""",
    "join_dim_left": "SELECT customer_id, card_id, snapshot_month, utilization_rate FROM card_snap",
    "join_month_lag": """SELECT s.customer_id, s.as_of_month, p1.products_count AS products_m1,
        p6.products_count AS products_m6 FROM spine s
        LEFT JOIN hold p1 ON p1.customer_id = s.customer_id
          AND p1.snapshot_month = s.as_of_month - INTERVAL 1 MONTH
        LEFT JOIN hold p6 ON p6.customer_id = s.customer_id
          AND p6.snapshot_month = s.as_of_month - INTERVAL 6 MONTH""",
    "join_point_in_time": """SELECT s.customer_id, s.as_of_month, CAST(coalesce(date_diff('day',
        d.last_login_date, s.as_of_month), 180) AS INT) AS days_since_last_login
        FROM spine s LEFT JOIN digital d ON d.customer_id = s.customer_id
        AND d.snapshot_month = s.as_of_month - INTERVAL 1 MONTH""",
    "join_half_open_range": RANGE_JOIN,
    "join_filter_range": """SELECT s.customer_id, s.as_of_month,
        CAST(sum(nps_score) AS BIGINT) AS nps_sum, count(*) AS nps_n
        FROM spine s JOIN feedback f USING (customer_id)
        WHERE nps_score IS NOT NULL AND feedback_month < as_of_month
          AND feedback_month >= as_of_month - INTERVAL 12 MONTH GROUP BY ALL""",
    "anti_join_orphans": """SELECT account_id AS key_value, count(*) AS orphan_rows FROM txn
        WHERE account_id NOT IN (SELECT account_id FROM acct WHERE account_status = 'Active')
        GROUP BY account_id""",
    "semi_join_eligible": """SELECT customer_id, as_of_month, prediction_horizon_months FROM label
        WHERE customer_id IN (SELECT customer_id FROM complaint)""",
    "cross_join_spine": """SELECT customer_id, m AS as_of_month,
        CAST(h AS INT) AS prediction_horizon_months
        FROM cust CROSS JOIN months CROSS JOIN (VALUES (1), (3), (6), (12)) t(h)""",
    "correlated_count": """SELECT s.customer_id, s.as_of_month, (SELECT count(*) FROM complaint c
        WHERE c.customer_id = s.customer_id
          AND c.complaint_month >= s.as_of_month - INTERVAL 6 MONTH
          AND c.complaint_month < s.as_of_month) AS complaints FROM spine s""",
    "scalar_subquery_bound": """SELECT customer_id, as_of_month, prediction_horizon_months
        FROM label WHERE as_of_month >= (SELECT min(snapshot_month) + INTERVAL 6 MONTH FROM hold)""",
    "first_event_after": "SELECT complaint_id, resolved_month AS next_event_month FROM resolved",
    "first_branch_in_city": """SELECT customer_id, city, first_branch FROM cust
        JOIN (SELECT city, min(branch_code) AS first_branch FROM branch GROUP BY city) b
        USING (city)""",
    "broadcast_config": f"""SELECT persona, customer_id, threshold, base_min FROM state
        JOIN (VALUES {persona_values(0, 1, 2)}) p(persona, threshold, base_min)
        USING (persona)""",
}

# -- aggregates ----------------------------------------------------------------------------
BALANCE = """SELECT customer_id, snapshot_month, CAST(sum(current_balance) AS DOUBLE) / count(*)
    AS avg_bal FROM acct_snap GROUP BY ALL"""
EMI = """SELECT customer_id, snapshot_month, CAST(sum(emi_amount) AS DECIMAL(18,2)) AS total_emi
    FROM loan_snap GROUP BY ALL"""
UTIL = f"""SELECT customer_id, snapshot_month,
    {half_up('CAST(sum(utilization_rate) * 10000 AS BIGINT)', 'count(*)', 4)} AS avg_util
    FROM card_snap GROUP BY ALL"""
ACTIVITY_COLUMNS = """customer_id, snapshot_month, debit_txn_count, credit_txn_count,
    total_debit_amount, total_credit_amount, avg_transaction_value, unique_merchants,
    cash_withdrawal_count, card_present_txn_count, card_not_present_txn_count"""
SQL |= {
    "customer_month_balance": f"SELECT customer_id, snapshot_month, round(avg_bal, 4) AS avg_bal FROM ({BALANCE})",
    "customer_month_emi": EMI,
    "customer_month_utilization": UTIL,
    "activity_rollup": f"SELECT {ACTIVITY_COLUMNS} FROM activity WHERE {BUSY}",
    "fee_and_salary_sums": """SELECT account_id, txn_month AS snapshot_month,
        CAST(coalesce(sum(amount) FILTER (WHERE is_fee), 0) AS DECIMAL(18,2))
          AS fee_charged_amount,
        CAST(coalesce(sum(amount) FILTER (WHERE is_salary_credit), 0) AS DECIMAL(18,2))
          AS salary_credit_amount FROM txn GROUP BY ALL""",
    "salary_months": """SELECT customer_id, count(DISTINCT txn_month) AS salary_months FROM txn
        WHERE is_salary_credit AND amount > 0 GROUP BY customer_id""",
    "loan_worst_state": """SELECT customer_id, m AS snapshot_month, CAST(max(dpd) AS INT)
        AS max_dpd, bool_or(st = 'Delinquent') AS any_delinquent
        FROM loan_state WHERE idx >= 0 GROUP BY ALL""",
    "open_complaints": """SELECT customer_id, count(*) FILTER (WHERE NOT resolved_flag)
        AS open_complaints, count(*) AS complaints FROM complaint GROUP BY customer_id""",
    "event_set": """SELECT customer_id, event_month,
        string_agg(event_type, ',' ORDER BY event_type) AS events,
        CAST(count(*) AS INT) AS n_events FROM event GROUP BY ALL""",
    "txns_per_customer": "SELECT customer_id, count(*) AS txn_count FROM txn GROUP BY customer_id",
    "segment_rate": """SELECT persona, count(*) AS n,
        round(avg(CAST(churned_flag AS INT)), 10) AS rate FROM state GROUP BY persona""",
    "conditional_means": """SELECT
        round(avg(CASE WHEN persona = 'complaint_prone_churner' THEN CAST(churned_flag AS INT) END),
          10) AS complaint_prone,
        round(avg(CASE WHEN persona = 'salary_core' THEN CAST(churned_flag AS INT) END), 10)
          AS salary_core,
        round(avg(CASE WHEN low_sensitivity_segment THEN CAST(churned_flag AS INT) END), 10)
          AS low_sensitivity,
        round(avg(CASE WHEN NOT low_sensitivity_segment THEN CAST(churned_flag AS INT) END), 10)
          AS normal FROM state""",
    "duplicate_groups": """SELECT count(*) AS duplicate_groups,
        CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_involved
        FROM (SELECT count(*) AS n FROM complaint GROUP BY customer_id, complaint_month
          HAVING count(*) > 1)""",
    "extremes": """SELECT min(txn_month) AS first_month, max(txn_month) AS last_month,
        min(transaction_id) AS first_id, max(transaction_id) AS last_id FROM txn""",
    "distinct_spine": "SELECT DISTINCT customer_id, as_of_month FROM label",
}

# -- windows and folds ---------------------------------------------------------------------


def islands(rows: str, reset: str) -> str:
    """Running length of the current run of rows without `reset`, as gaps and islands."""
    return f"""SELECT *, CAST(count(*) FILTER (WHERE NOT reset) OVER (PARTITION BY customer_id,
        island ORDER BY m ROWS UNBOUNDED PRECEDING) AS INT) AS streak
      FROM (SELECT *, sum(CAST(reset AS INT)) OVER (PARTITION BY customer_id ORDER BY m
          ROWS UNBOUNDED PRECEDING) AS island
        FROM (SELECT *, {reset} AS reset FROM ({rows})))"""


PRIMARY = """SELECT customer_id, account_id, account_type, salary_account_flag FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id
      ORDER BY account_type <> 'Savings', account_id) AS rn
    FROM acct WHERE account_status = 'Active') WHERE rn = 1"""
SALARY = islands(
    f"""SELECT c.customer_id, months.m, coalesce(p.salary_account_flag, false) AS salaried,
      EXISTS (SELECT 1 FROM txn t WHERE t.customer_id = c.customer_id AND t.txn_month = months.m
        AND t.is_salary_credit) AS paid
      FROM cust c CROSS JOIN months LEFT JOIN ({PRIMARY}) p USING (customer_id)""",
    "paid OR NOT salaried",
)
INACTIVE = islands(
    """SELECT c.customer_id, months.m, coalesce(d.mobile_app_active OR d.web_sessions > 0, false)
      AS used FROM cust c CROSS JOIN months LEFT JOIN digital d
      ON d.customer_id = c.customer_id AND d.snapshot_month = months.m""",
    "used",
)
FAILURES = """
    WITH RECURSIVE walk AS (
      SELECT customer_id, CAST(-1 AS INT) AS i, 0 AS level, CAST(NULL AS DATE) AS m FROM cust
      UNION ALL
      SELECT w.customer_id, months.idx,
        CASE WHEN f.customer_id IS NOT NULL THEN least(2, w.level + 1)
             ELSE greatest(0, w.level - 1) END, months.m
      FROM walk w JOIN months ON months.idx = w.i + 1
      LEFT JOIN (SELECT customer_id, event_month FROM event
          WHERE event_type = 'bank_service_failure') f
        ON f.customer_id = w.customer_id AND f.event_month = months.m)
    SELECT customer_id, m AS snapshot_month, CAST(level AS INT) AS service_failures_2m
    FROM walk WHERE i >= 0"""
DROP = """SELECT customer_id, snapshot_month, products_count, coalesce(products_count
    < lag(products_count) OVER (PARTITION BY customer_id ORDER BY snapshot_month), false)
    AS products_count_drop FROM hold"""
TRAILING = """SELECT c.customer_id, months.m AS snapshot_month, count(k.complaint_id)
    AS complaints_trailing FROM cust c CROSS JOIN months LEFT JOIN complaint k
      ON k.customer_id = c.customer_id AND k.complaint_month <= months.m
      AND k.complaint_month >= months.m - INTERVAL 6 MONTH GROUP BY ALL"""
SQL |= {
    "running_balance": "SELECT transaction_id, account_id, balance_after_txn FROM ledger",
    "account_snapshot": "SELECT * EXCLUDE (customer_id) FROM acct_snap",
    "primary_account": PRIMARY,
    "salary_gap_streak": f"SELECT customer_id, m AS snapshot_month, streak AS months_without_salary FROM ({SALARY})",
    "digital_inactive_streak": f"SELECT customer_id, m AS snapshot_month, streak AS digital_inactive_months FROM ({INACTIVE})",
    "service_failure_counter": f"SELECT * FROM ({FAILURES})",
    "product_drop": DROP,
    "complaints_trailing": TRAILING,
    "loan_opening_balance": """SELECT loan_id, elapsed AS elapsed_months, round(o, 2) AS opening
        FROM loan_open WHERE k = elapsed""",
    "loan_schedule": """SELECT * FROM (WITH RECURSIVE walk AS (
        SELECT loan_id, 0 AS k, CAST(sanctioned_amount AS DOUBLE) AS o, CAST(0 AS DOUBLE) AS i,
          CAST(0 AS DOUBLE) AS p, CAST(emi_amount AS DOUBLE) AS e, interest_rate / 1200.0 AS r,
          tenure_months AS n FROM loan
        UNION ALL
        SELECT loan_id, k + 1, greatest(0.0, o - least(e - o * r, o)), o * r,
          least(e - o * r, o), e, r, n FROM walk WHERE k < n)
      SELECT loan_id, CAST(k AS INT) AS instalment, round(i, 2) AS interest,
        round(p, 2) AS principal, round(o, 2) AS closing FROM walk WHERE k > 0)""",
    "loan_dpd": """SELECT loan_id, m AS snapshot_month, round(o, 2) AS outstanding,
        CAST(dpd AS INT) AS dpd_days, st AS loan_status FROM loan_state WHERE idx >= 0""",
    "loan_snapshot": "SELECT * EXCLUDE (customer_id) FROM loan_snap",
    "card_revolve": "SELECT card_id, snapshot_month, round(b, 2) AS balance FROM card_bal WHERE k > 0",
    "card_snapshot": "SELECT * EXCLUDE (customer_id) FROM card_snap",
}

# -- sets ----------------------------------------------------------------------------------
SQL |= {
    "ordered_output": """SELECT customer_id, complaint_month, complaint_id FROM complaint
        ORDER BY ALL""",
    "sample_violations": f"SELECT * FROM ({SQL['anti_join_orphans']}) ORDER BY key_value LIMIT 5",
    "union_tables": "SELECT complaint_id, customer_id, complaint_month FROM complaint",
    "disjoint_union": """SELECT DISTINCT customer_id, 'Complaint Resolution' AS topic
        FROM complaint WHERE resolved_flag
        UNION ALL SELECT DISTINCT customer_id, 'General' FROM feedback
        WHERE customer_id NOT IN (SELECT customer_id FROM complaint WHERE resolved_flag)""",
    "dedupe_one_per_month": """SELECT customer_id, feedback_month, feedback_id, survey_topic
        FROM feedback QUALIFY row_number() OVER (PARTITION BY customer_id, feedback_month
        ORDER BY survey_topic <> 'Complaint Resolution', feedback_id) = 1""",
    "table_equality": """SELECT 'same' AS case_name, CAST(0 AS BIGINT) AS differing_rows,
        true AS equal
        UNION ALL SELECT 'fees removed', count(*), count(*) = 0 FROM (
          SELECT account_id, txn_month FROM txn GROUP BY ALL HAVING bool_or(is_fee))""",
    "surrogate_keys": """SELECT complaint_month, complaint_id, 49999999 + row_number() OVER
        (ORDER BY complaint_month, complaint_id) AS new_id FROM complaint""",
    "segment_assignment": f"""
        SELECT customer_id, {lookup(K.PERSONA_NAMES, f"{uniform('customer_id', 42)} * 6 // 1000000")}
          AS persona, {uniform('customer_id', 43)} < 125000 AS low_sensitivity, branch_code
        FROM cust_only JOIN (SELECT branch_code,
            sum(customer_weight) OVER (ORDER BY branch_code) - customer_weight AS lo,
            sum(customer_weight) OVER (ORDER BY branch_code) AS hi,
            sum(customer_weight) OVER () AS total FROM branch) b
          ON {uniform('customer_id', 44)} * total // 1000000 >= lo
          AND {uniform('customer_id', 44)} * total // 1000000 < hi""".replace(
        "FROM cust_only", "FROM (SELECT customer_id FROM cust)"
    ),
    "stratified_sample": f"""SELECT complaint_id, resolved_flag FROM complaint
        WHERE {uniform('complaint_id', 42)} < CASE WHEN resolved_flag THEN 200000 ELSE 20000 END""",
}

# -- behaviour -----------------------------------------------------------------------------
FLAGS = """SELECT customer_id, event_month,
    bool_or(event_type = 'bank_service_failure') AS failure,
    bool_or(event_type = 'salary_delay') AS delay,
    bool_or(event_type = 'fee_hike_or_service_charge') AS fee,
    bool_or(event_type = 'salary_job_change') AS job,
    bool_or(event_type = 'home_purchase') AS home,
    bool_or(event_type = 'large_life_expense') AS expense,
    count(*) AS n FROM event GROUP BY ALL"""
KEY = "(customer_id * 100000 + year(m) * 12 + month(m))"
TARGETS = f"""SELECT customer_id, persona, m AS snapshot_month, CASE
      WHEN closed AND {uniform(KEY, 42)} < 200000 THEN 'Complaint Resolution'
      WHEN {uniform(KEY, 43)} < 20000 AND {uniform(KEY, 44)} < 500000 THEN 'General'
      WHEN {uniform(KEY, 43)} < 20000 THEN 'Digital Experience' END AS topic
    FROM (SELECT s.customer_id, persona, m, EXISTS (SELECT 1 FROM resolved r
        WHERE r.customer_id = s.customer_id AND r.resolved_month = months.m) AS closed
      FROM state s CROSS JOIN months WHERE churn_month IS NULL OR m <= churn_month)"""
OPEN_NOW = """(SELECT count(*) FROM resolved r WHERE r.customer_id = {c}
    AND r.complaint_month <= {m} AND (r.resolved_month IS NULL OR r.resolved_month > {m}))"""
SQL |= {
    "event_mutual_exclusion": f"""SELECT e.* FROM event e JOIN ({FLAGS}) f
        USING (customer_id, event_month)
        WHERE NOT (event_type = 'salary_delay' AND job)
          AND NOT (event_type = 'large_life_expense' AND home)""",
    "conditional_event_gate": """SELECT * FROM event e WHERE CASE event_type
        WHEN 'card_decline_spike' THEN customer_id IN
          (SELECT customer_id FROM card WHERE card_status = 'Active')
        WHEN 'campaign_exposure' THEN customer_id IN
            (SELECT customer_id FROM state WHERE persona = 'digital_native')
          OR EXISTS (SELECT 1 FROM digital d WHERE d.customer_id = e.customer_id
            AND d.snapshot_month = e.event_month AND (d.mobile_app_active OR d.web_sessions > 0))
        WHEN 'loan_delinquency_start' THEN EXISTS (SELECT 1 FROM loan_state s
          WHERE s.customer_id = e.customer_id AND s.st = 'Active'
            AND coalesce(s.m + INTERVAL 1 MONTH, DATE '2024-01-01') = e.event_month)
        WHEN 'complaint_resolved' THEN EXISTS (SELECT 1 FROM resolved r
          WHERE r.customer_id = e.customer_id AND r.resolved_month = e.event_month)
        ELSE true END""",
    "complaint_root_cause": f"""SELECT complaint_id,
        CASE WHEN failure THEN 'Tech Issue' WHEN delay THEN 'Transaction' WHEN fee THEN 'Billing'
             ELSE category END AS category,
        CASE WHEN failure THEN 'System Outage' WHEN delay THEN 'Delayed Salary Processing'
             WHEN fee THEN 'Excessive Charges' ELSE root_cause END AS root_cause,
        CASE WHEN failure THEN 'High'
             WHEN delay THEN CASE WHEN severity = 'High' THEN 'High' ELSE 'Medium' END
             WHEN fee THEN 'Medium' ELSE severity END AS severity
        FROM complaint c LEFT JOIN ({FLAGS}) f
          ON f.customer_id = c.customer_id AND f.event_month = c.complaint_month""",
    "complaint_resolution": """SELECT complaint_id, resolved_month,
        resolved_month IS NOT NULL AS resolved_flag,
        CASE WHEN resolved_month IS NULL THEN 'Open' ELSE 'Resolved' END AS status
        FROM resolved""",
    "resolution_sla": """SELECT complaint_id, severity, resolution_days, CASE severity
        WHEN 'Low' THEN resolution_days NOT BETWEEN 7 AND 25
        WHEN 'Medium' THEN resolution_days NOT BETWEEN 20 AND 45
        ELSE resolution_days NOT BETWEEN 35 AND 75 END AS out_of_band
        FROM complaint WHERE resolved_flag""",
    "survey_targets": f"""SELECT customer_id, snapshot_month, topic FROM ({TARGETS})
        WHERE topic IS NOT NULL""",
    "expected_nps_csat": f"""SELECT customer_id, snapshot_month, topic,
        CAST(least(10, greatest(0, round_even(nps_base - least(4.0, o * 1.5::DOUBLE)
          - CASE WHEN failure THEN 3.5::DOUBLE ELSE 0 END - CASE WHEN fee THEN 1.5::DOUBLE ELSE 0
          END + CASE WHEN topic = 'Complaint Resolution' THEN 1.0::DOUBLE ELSE 0 END, 0)))
          AS INT) AS nps_score,
        CAST(least(5, greatest(1, round_even(csat_base - least(2.0, o * 0.7::DOUBLE)
          - CASE WHEN failure THEN 1.8::DOUBLE ELSE 0 END - CASE WHEN fee THEN 0.8::DOUBLE ELSE 0
          END + CASE WHEN topic = 'Complaint Resolution' THEN 0.5::DOUBLE ELSE 0 END, 0)))
          AS INT) AS csat_score
        FROM (SELECT t.*, CAST({OPEN_NOW.format(c='t.customer_id', m='t.snapshot_month')}
            AS DOUBLE) AS o FROM ({TARGETS}) t WHERE topic IS NOT NULL) t
        JOIN (VALUES {persona_values(0, 4, 5)}) p(persona, nps_base, csat_base) USING (persona)
        LEFT JOIN ({FLAGS}) f ON f.customer_id = t.customer_id
          AND f.event_month = t.snapshot_month""".replace(
        "SELECT customer_id, snapshot_month, topic,",
        "SELECT t.customer_id, t.snapshot_month, topic,", 1),
    "campaign_uptake": """SELECT exposure, count(*) AS customer_months,
        CAST(sum(gain) AS BIGINT) AS products_gained,
        round(CAST(sum(gain) AS DOUBLE) / count(*), 6) AS mean_gain
        FROM (SELECT CASE WHEN campaigns_responded > 0 THEN 'responded'
            WHEN campaigns_received > 0 THEN 'received' ELSE 'none' END AS exposure,
          greatest(0, h.products_count - b.products_count) AS gain
        FROM hold h JOIN hold b ON b.customer_id = h.customer_id AND b.idx = h.idx - 1
        LEFT JOIN digital d ON d.customer_id = h.customer_id
          AND d.snapshot_month = h.snapshot_month) GROUP BY exposure""",
    "holdings_panel": f"""SELECT c.customer_id, months.m AS snapshot_month,
        {', '.join(f"coalesce(bool_or(a.product = '{p}'), false) AS {p}" for p in K.PRODUCT_FLAGS)},
        CAST(count(a.product) AS INT) AS products_count
        FROM cust c CROSS JOIN months LEFT JOIN acquired a
          ON a.customer_id = c.customer_id AND a.idx <= months.idx GROUP BY ALL""",
}

# -- churn ---------------------------------------------------------------------------------
FIRED = FLAGS.replace("FROM event", f"FROM ({SQL['conditional_event_gate']})")
SIGNALS = f"""
    SELECT c.customer_id, months.m AS snapshot_month, c.persona,
      ln(((base_min + base_max) / 2.0::DOUBLE)
        / (1.0::DOUBLE - (base_min + base_max) / 2.0::DOUBLE)) AS base_rate,
      (coalesce(f.n, 0) - CASE WHEN f.job AND f.delay THEN 1 ELSE 0 END
        - CASE WHEN f.home AND f.expense THEN 1 ELSE 0 END) * 0.1::DOUBLE AS event_score,
      0.0::DOUBLE AS trend_score, (10 - h.products_count) / 10.0::DOUBLE AS product_score,
      t.complaints_trailing * 0.15::DOUBLE + o.n * 0.25::DOUBLE AS complaint_score,
      coalesce(l.max_dpd, 0) / 90.0::DOUBLE AS loan_stress_score,
      i.streak * 0.2::DOUBLE AS digital_inactivity_score,
      CAST(coalesce(l.max_dpd, 0) AS INT) AS dpd_days,
      CASE WHEN l.any_delinquent THEN 'Delinquent' ELSE 'Active' END AS loan_status,
      CAST(t.complaints_trailing AS INT) AS complaint_count_6m,
      CAST(o.n AS INT) AS unresolved_complaints,
      CAST(coalesce(b.balance, 0) AS DECIMAL(18,2)) AS current_balance,
      s.streak AS months_without_salary, w.service_failures_2m,
      i.streak AS digital_inactive_months, false AS core_account_closed,
      coalesce(f.job, false) AS recent_salary_job_change, h.products_count_drop,
      coalesce(f.failure, false) AS recent_service_failure
    FROM cust c CROSS JOIN months
    JOIN active_month alive ON alive.customer_id = c.customer_id AND alive.snapshot_month = months.m
    JOIN (VALUES {persona_values(0, 2, 3)}) p(persona, base_min, base_max)
      ON p.persona = c.persona
    LEFT JOIN ({FIRED}) f ON f.customer_id = c.customer_id AND f.event_month = months.m
    JOIN ({DROP}) h ON h.customer_id = c.customer_id AND h.snapshot_month = months.m
    JOIN ({TRAILING}) t ON t.customer_id = c.customer_id AND t.snapshot_month = months.m
    JOIN (SELECT c.customer_id, months.m, count(r.complaint_id) AS n
      FROM cust c CROSS JOIN months LEFT JOIN resolved r ON r.customer_id = c.customer_id
        AND r.complaint_month <= months.m
        AND (r.resolved_month IS NULL OR r.resolved_month > months.m) GROUP BY ALL) o
      ON o.customer_id = c.customer_id AND o.m = months.m
    LEFT JOIN ({SQL['loan_worst_state']}) l
      ON l.customer_id = c.customer_id AND l.snapshot_month = months.m
    LEFT JOIN (SELECT customer_id, snapshot_month, sum(current_balance) AS balance FROM acct_snap
      GROUP BY ALL) b ON b.customer_id = c.customer_id AND b.snapshot_month = months.m
    JOIN ({SALARY}) s ON s.customer_id = c.customer_id AND s.m = months.m
    JOIN ({FAILURES}) w ON w.customer_id = c.customer_id AND w.snapshot_month = months.m
    JOIN ({INACTIVE}) i ON i.customer_id = c.customer_id AND i.m = months.m"""
HARD = {
    "Loan default": "loan_status = 'Delinquent' AND dpd_days >= 90",
    "Salary account lost": "recent_salary_job_change AND months_without_salary >= 2",
    "Service dissatisfaction": "complaint_count_6m >= 4 AND unresolved_complaints >= 2",
    "Account dormancy": "current_balance < 500 AND months_without_salary >= 3",
    "Service failure": "service_failures_2m >= 2 AND digital_inactive_months >= 2",
    "Voluntary closure": "core_account_closed",
}
HARD_REASON = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for r, c in HARD.items()) + " END"
SOFT_REASON = """CASE WHEN dpd_days >= 90 OR loan_status = 'Delinquent' THEN 'Loan default'
    WHEN months_without_salary >= 2 AND recent_salary_job_change THEN 'Salary account lost'
    WHEN unresolved_complaints >= 1 OR complaint_count_6m >= 2 THEN 'Service dissatisfaction'
    WHEN current_balance < 500 OR digital_inactive_months >= 2 THEN 'Account dormancy'
    WHEN products_count_drop THEN 'Product disengagement'
    WHEN recent_service_failure THEN 'Service failure' ELSE 'Voluntary closure' END"""
SCORED = f"""
    SELECT *, CASE WHEN hard_reason IS NOT NULL THEN 999.0::DOUBLE ELSE x END AS churn_risk,
      CASE WHEN hard_reason IS NOT NULL THEN 1.0::DOUBLE
           WHEN x >= 0 THEN 1.0::DOUBLE / (1.0::DOUBLE + exp(-x))
           ELSE exp(x) / (1.0::DOUBLE + exp(x)) END AS churn_prob
    FROM (SELECT *, {HARD_REASON} AS hard_reason, {SOFT_REASON} AS soft_reason,
        base_rate + event_score * 0.3::DOUBLE + trend_score * 0.15::DOUBLE
        - product_score * 0.1::DOUBLE + complaint_score * 0.25::DOUBLE
        + loan_stress_score * 0.2::DOUBLE + digital_inactivity_score * 0.15::DOUBLE AS x
      FROM ({SIGNALS}))"""
SKEY = "(customer_id * 100000 + year(snapshot_month) * 12 + month(snapshot_month))"
DECIDED = f"""
    SELECT d.*, threshold,
      hard_reason IS NOT NULL OR {uniform(SKEY, 42)} < churn_prob * 1000000 AS drawn,
      hard_reason IS NOT NULL OR churn_prob > threshold AS above_threshold
    FROM ({SCORED}) d JOIN (VALUES {persona_values(0, 1)}) p(persona, threshold)
      USING (persona)"""
FIRST_CHURN = f"""SELECT customer_id, min(snapshot_month) FILTER (WHERE drawn) AS churn_month,
    arg_min(coalesce(hard_reason, soft_reason), snapshot_month) FILTER (WHERE drawn) AS reason,
    max(snapshot_month) AS last_month
    FROM ({DECIDED}) GROUP BY customer_id"""
ACTIVE = """CAST(date_diff('month', DATE '2024-01-01', coalesce(f.churn_month, f.last_month)) + 1
    AS INT)"""
SCORES = ("base_rate", "event_score", "trend_score", "product_score", "complaint_score",
          "loan_stress_score", "digital_inactivity_score")
SQL |= {
    "churn_signals": f"""SELECT * REPLACE ({', '.join(f'round({c}, 10) AS {c}' for c in SCORES)})
        FROM ({SIGNALS})""",
    "hard_triggers": f"""SELECT customer_id, snapshot_month,
        {', '.join(f"{c} AS {r.lower().replace(' ', '_')}" for r, c in HARD.items())},
        {HARD_REASON} AS hard_reason FROM ({SIGNALS})""",
    "churn_score": f"""SELECT customer_id, snapshot_month, round(churn_risk, 10) AS churn_risk,
        round(churn_prob, 10) AS churn_prob FROM ({SCORED})""",
    "churn_decision": f"SELECT customer_id, snapshot_month, above_threshold, drawn FROM ({DECIDED})",
    "churn_reason": f"""SELECT customer_id, snapshot_month, CASE WHEN drawn
        THEN coalesce(hard_reason, soft_reason) END AS churn_reason, soft_reason
        FROM ({DECIDED})""",
    "churn_month": f"SELECT customer_id, churn_month FROM ({FIRST_CHURN})",
    "active_months": f"SELECT customer_id, {ACTIVE} AS active_months_generated FROM ({FIRST_CHURN}) f",
    "churn_state": f"""SELECT customer_id, persona, low_sensitivity_segment, f.churn_month,
        f.churn_month IS NOT NULL AS churned_flag, f.reason AS churn_reason,
        {ACTIVE} AS active_months_generated FROM ({FIRST_CHURN}) f
        JOIN (SELECT customer_id, persona, low_sensitivity_segment FROM state) s
        USING (customer_id)""",
    "churn_label": "SELECT * FROM label",
}

# -- panel and features --------------------------------------------------------------------


def per_month(select: str, table: str, month: str = "snapshot_month") -> str:
    return (
        f"(SELECT customer_id, {month} AS month, {select} FROM {table} GROUP BY customer_id, {month})"
    )


def bigint_sum(column: str) -> str:
    return f"CAST(sum({column}) AS BIGINT) AS {column}"


PANEL_SOURCES = [
    "(SELECT customer_id, as_of_month AS month, true AS is_spine FROM spine)",
    per_month("CAST(sum(current_balance) AS DECIMAL(18,2)) AS balance", "acct_snap"),
    per_month("CAST(sum(emi_amount) AS DECIMAL(18,2)) AS emi", "loan_snap"),
    per_month("CAST(sum(debit_txn_count + credit_txn_count) AS BIGINT) AS txns, "
              "CAST(sum(login_count) AS BIGINT) AS logins, "
              "min(days_since_last_txn) AS dormant", "activity"),
    per_month("max(last_login_date) AS last_login, CAST(sum(campaigns_received) AS BIGINT) "
              "AS received, CAST(sum(campaigns_responded) AS BIGINT) AS responded", "digital"),
    per_month("count(*) AS complaints, nullif(count(*) FILTER (WHERE NOT resolved_flag), 0) "
              "AS unresolved", "complaint", "complaint_month"),
    per_month("CAST(sum(nps_score) AS BIGINT) AS nps_sum, count(*) AS nps_n",
              "(SELECT * FROM feedback WHERE nps_score IS NOT NULL)", "feedback_month"),
    per_month("max(products_count) AS products", "hold"),
    per_month("count(*) AS n_cards", "card_snap"),
]
PANEL = PANEL_SOURCES[0] + "".join(
    f" FULL OUTER JOIN {s} s{i} USING (customer_id, month)"
    for i, s in enumerate(PANEL_SOURCES[1:])
)


def windowed(select: str, facts: str, month: str, back: int | None, until: int = 0,
             extra: str = "") -> str:
    """Aggregate of facts in [as_of - back, as_of - until) per spine row."""
    lower = f"AND x.{month} >= s.as_of_month - INTERVAL {back} MONTH" if back else ""
    return f"""(SELECT s.customer_id, s.as_of_month, {select} FROM spine s LEFT JOIN {facts} x
        ON x.customer_id = s.customer_id {lower}
        AND x.{month} < s.as_of_month - INTERVAL {until} MONTH {extra} GROUP BY ALL)"""


def change(select: str, facts: str, month: str, near: int, far: int) -> str:
    recent = windowed(f"avg({select}) AS r", facts, month, near)
    prior = windowed(f"avg({select}) AS p", facts, month, far, near)
    return f"""(SELECT customer_id, as_of_month, round(CASE WHEN p > 0
        THEN (coalesce(r, 0) - p) / p ELSE 0 END, 4) AS value
        FROM {recent} JOIN {prior} USING (customer_id, as_of_month))"""


def at_lag(select: str, facts: str, lag: int = 1) -> str:
    return f"""(SELECT s.customer_id, s.as_of_month, {select} AS value FROM spine s
        LEFT JOIN {facts} x ON x.customer_id = s.customer_id
        AND x.snapshot_month = s.as_of_month - INTERVAL {lag} MONTH)"""


TXNS = ("(SELECT customer_id, snapshot_month, debit_txn_count + credit_txn_count AS txns, "
        "login_count FROM activity)")
FEATURE_SQL = {
    "tenure_months": """(SELECT customer_id, as_of_month, CAST((year(as_of_month)
        - year(customer_since)) * 12 + month(as_of_month) - month(customer_since) AS INT)
        AS value FROM spine JOIN cust USING (customer_id))""",
    "products_count": at_lag("coalesce(products_count, 1)", "hold"),
    "balance_change_3m": change("avg_bal", f"({BALANCE})", "snapshot_month", 3, 6),
    "txn_count_change_3m": change("txns", TXNS, "snapshot_month", 3, 6),
    "login_count_change_6m": change("login_count", TXNS, "snapshot_month", 6, 12),
    "complaint_count_6m": windowed(
        "CAST(count(x.complaint_id) AS INT) AS value", "complaint", "complaint_month", 6),
    "unresolved_complaints": windowed(
        "CAST(count(x.complaint_id) AS INT) AS value", "complaint", "complaint_month", None,
        extra="AND NOT x.resolved_flag"),
    "days_since_last_login": at_lag(
        "CAST(coalesce(date_diff('day', last_login_date, s.as_of_month), 180) AS INT)",
        "digital"),
    "salary_credit_consistency": windowed(
        "round(count(DISTINCT x.snapshot_month) / 6.0::DOUBLE, 4) AS value",
        "acct_snap", "snapshot_month", 6, extra="AND x.salary_credit_amount > 0"),
    "credit_utilization": at_lag("coalesce(avg_util, 0)", f"({UTIL})"),
    "emi_to_income_ratio": f"""(SELECT customer_id, as_of_month,
        round(coalesce(CAST(value AS DOUBLE), 0) / ({INCOME}), 4) AS value
        FROM {at_lag('total_emi', f'({EMI})')} JOIN cust USING (customer_id))""",
    "dormant_days": at_lag("coalesce(days_since_last_txn, 180)", "activity"),
    "nps_avg_12m": windowed(
        "round(coalesce(avg(x.nps_score), 8.0), 4) AS value", "feedback", "feedback_month", 12,
        extra="AND x.nps_score IS NOT NULL"),
    "campaign_response_rate": windowed(
        """round(coalesce(CAST(sum(x.campaigns_responded) AS DOUBLE)
        / nullif(sum(x.campaigns_received), 0), 0), 4) AS value""",
        "digital", "snapshot_month", 12),
    "product_acquisition_velocity_6m": f"""(SELECT customer_id, as_of_month,
        CAST(greatest(0, a.value - b.value) AS INT) AS value
        FROM {at_lag('coalesce(products_count, 0)', 'hold')} a
        JOIN {at_lag('coalesce(products_count, 0)', 'hold', 6)} b
        USING (customer_id, as_of_month))""",
}
SNAPSHOT = f"""SELECT l.customer_id, l.as_of_month, l.prediction_horizon_months,
    {', '.join(f'{name}.value AS {name}' for name in FEATURE_SQL)},
    l.churned, l.churn_date, l.churn_reason FROM label l
    {' '.join(f'JOIN {sql} {name} ON {name}.customer_id = l.customer_id AND {name}.as_of_month = l.as_of_month' for name, sql in FEATURE_SQL.items())}"""
SQL |= {
    "monthly_panel": f"""SELECT customer_id, month, coalesce(is_spine, false) AS is_spine,
        balance, emi, txns, logins, dormant, last_login, received, responded, complaints,
        unresolved, nps_sum, nps_n, products FROM {PANEL}""",
    **{f"feat_{name}": f"SELECT customer_id, as_of_month, value AS {name} FROM {sql}"
       for name, sql in FEATURE_SQL.items()},
    "feature_snapshot": SNAPSHOT,
    "feature_snapshot_joins": SNAPSHOT,
    "training_split": f"""SELECT customer_id, as_of_month, CASE WHEN as_of_month
        <= DATE '2025-06-01' THEN 'train' ELSE 'eval' END AS split, value AS products_count,
        churned FROM label JOIN {FEATURE_SQL['products_count']} p
        USING (customer_id, as_of_month) WHERE prediction_horizon_months = 3""",
}

# -- quality, leakage, parity ---------------------------------------------------------------
DDL_TABLE = {
    "branch_master": "branch", "customer_master": "cust", "account_master": "acct",
    "card_portfolio": "card", "loan_master": "loan", "churn_simulation_state": "state",
    "transaction_fact": "txn", "customer_complaints": "complaint",
    "customer_feedback": "feedback", "account_monthly_snapshot": "acct_snap",
    "card_monthly_snapshot": "card_snap", "loan_monthly_snapshot": "loan_snap",
    "product_holdings_monthly": "hold", "customer_monthly_activity": "activity",
    "digital_engagement_monthly": "digital", "customer_churn_label": "label",
    "churn_feature_snapshot": "(SELECT * FROM label JOIN spine USING (customer_id, as_of_month))",
}


def key_report(table: str, keys: tuple[str, ...]) -> str:
    source, cols = DDL_TABLE[table], ", ".join(keys)
    nulls = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"""SELECT 'key {table}({cols})' AS check_name, a.n + b.n = 0 AS passed,
        a.n + b.n AS violations, 'nulls=' || a.n || ', duplicates=' || b.n AS detail
        FROM (SELECT count(*) AS n FROM {source} WHERE {nulls}) a,
        (SELECT count(*) AS n FROM (SELECT {cols} FROM {source} GROUP BY {cols}
          HAVING count(*) > 1)) b"""


def fk_report(child: str, column: str, parent: str) -> str:
    key = SINGLE_KEYS[parent]
    source = DDL_TABLE[child]
    return f"""SELECT 'foreign key {child}({column}) -> {parent}', count(*) = 0, count(*),
        'orphan rows=' || count(*) || ', keys=' || count(DISTINCT c.{column})
        FROM {source} c LEFT JOIN {DDL_TABLE[parent]} p ON c.{column} = p.{key}
        WHERE c.{column} IS NOT NULL AND p.{key} IS NULL"""


def named(sql: str) -> str:
    return f"SELECT * FROM ({sql}) t(check_name, passed, violations, detail)"


def order_report(name: str, a: str, b: str, source: str) -> str:
    def text(x):
        return f"coalesce(CAST(CAST(round({x} * 1000000) AS BIGINT) AS VARCHAR), 'none')"

    return f"""SELECT '{name}' AS check_name, coalesce(a > b, false) AS passed,
        CAST(CASE WHEN a > b THEN 0 ELSE 1 END AS BIGINT) AS violations,
        {text('a')} || ' > ' || {text('b')} AS detail
        FROM (SELECT avg({a}) AS a, avg({b}) AS b FROM {source})"""


def late_report(table: str, month: str, op: str) -> str:
    return f"""SELECT 'post churn {table}', count(*) = 0, count(*), '{op} churn month'
        FROM {DDL_TABLE[table]} x JOIN state s ON s.customer_id = x.customer_id
        WHERE s.churned_flag AND x.{month} {op} s.churn_month"""


CHURN_INT = "CAST(churned_flag AS INT)"
LATE = [
    ("account_monthly_snapshot", "snapshot_month", ">"),
    ("card_monthly_snapshot", "snapshot_month", ">"),
    ("loan_monthly_snapshot", "snapshot_month", ">"),
    ("product_holdings_monthly", "snapshot_month", ">"),
    ("customer_monthly_activity", "snapshot_month", ">"),
    ("digital_engagement_monthly", "snapshot_month", ">"),
    ("customer_complaints", "complaint_month", ">"),
    ("customer_feedback", "feedback_month", ">"),
    ("customer_churn_label", "as_of_month", ">="),
    ("churn_feature_snapshot", "as_of_month", ">="),
    ("transaction_fact", "txn_month", ">"),
]
SQL |= {
    "dq_single_pk": " UNION ALL ".join(key_report(t, (k,)) for t, k in SINGLE_KEYS.items()),
    "dq_composite_grain": " UNION ALL ".join(key_report(t, k) for t, k in COMPOSITE_KEYS.items()),
    "dq_foreign_keys": named(" UNION ALL ".join(fk_report(*fk) for fk in FOREIGN_KEYS)),
    "dq_persona_churn_order": order_report(
        "persona churn order",
        f"CASE WHEN persona = 'complaint_prone_churner' THEN {CHURN_INT} END",
        f"CASE WHEN persona = 'salary_core' THEN {CHURN_INT} END", "state"),
    "dq_dpd_order": order_report(
        "days past due order",
        "CASE WHEN persona = 'credit_stressed' THEN dpd_days END",
        "CASE WHEN persona = 'affluent_multi_product' THEN dpd_days END",
        "loan_snap JOIN state USING (customer_id)"),
    "dq_campaign_uptake": order_report(
        "campaign uptake", "CASE WHEN c.value > 0 THEN v.value END",
        "CASE WHEN c.value = 0 THEN v.value END",
        f"""label JOIN {FEATURE_SQL['campaign_response_rate']} c USING (customer_id, as_of_month)
        JOIN {FEATURE_SQL['product_acquisition_velocity_6m']} v
        USING (customer_id, as_of_month)"""),
    "dq_low_sensitivity": order_report(
        "low sensitivity", f"CASE WHEN NOT low_sensitivity_segment THEN {CHURN_INT} END",
        f"CASE WHEN low_sensitivity_segment THEN {CHURN_INT} END", "state"),
    "leak_label_boundary": """SELECT 'label boundary' AS check_name, n = 0 AS passed,
        n AS violations, 'rows=' || r AS detail
        FROM (SELECT count(*) FILTER (WHERE churned AND as_of_month >= churn_date) AS n,
          count(*) AS r FROM label JOIN spine USING (customer_id, as_of_month))""",
    "leak_complaint_window": f"""SELECT 'complaint window' AS check_name, count(*) = 0 AS passed,
        count(*) AS violations, '[M-6, M)' AS detail
        FROM label JOIN {FEATURE_SQL['complaint_count_6m']} f USING (customer_id, as_of_month)
        JOIN ({RANGE_JOIN}) e USING (customer_id, as_of_month) WHERE f.value <> e.complaints""",
    "post_churn_activity": named(" UNION ALL ".join(late_report(*late) for late in LATE)),
    "dq_date_monotonic": named("""
        SELECT 'dates account open', n = 0, n, 'rows=' || r FROM (SELECT count(*) AS r,
          count(*) FILTER (WHERE date_trunc('month', open_date) > first_month) AS n
          FROM acct JOIN (SELECT account_id, min(snapshot_month) AS first_month FROM acct_snap
            GROUP BY account_id) f USING (account_id))
        UNION ALL SELECT 'dates card expiry', n = 0, n, 'rows=' || r FROM (SELECT count(*) AS r,
          count(*) FILTER (WHERE issue_date >= expiry_date) AS n FROM card)
        UNION ALL SELECT 'dates loan maturity', n = 0, n, 'rows=' || r FROM (
          SELECT count(*) AS r, count(*) FILTER (WHERE disbursement_date >= maturity_date) AS n
          FROM loan)"""),
}
REPORT_NAMES = (
    "dq_single_pk", "dq_composite_grain", "dq_foreign_keys", "dq_persona_churn_order",
    "dq_dpd_order", "dq_campaign_uptake", "dq_low_sensitivity", "leak_label_boundary",
    "leak_complaint_window", "post_churn_activity", "dq_date_monotonic",
)
ALL_CHECKS = " UNION ALL ".join(f"SELECT * FROM ({SQL[r]})" for r in REPORT_NAMES)


def ks_report(metric: str, values: str, limit: float) -> str:
    """KS over (side, v) rows: the largest gap between the two step functions at any value."""
    return f"""SELECT '{metric}' AS metric, round(max(gap), 10) AS ks, max(gap) <= {limit} AS passed
        FROM (SELECT abs(
            CAST(sum(a) OVER (ORDER BY v) AS DOUBLE) / sum(a) OVER ()
            - CAST(sum(b) OVER (ORDER BY v) AS DOUBLE) / sum(b) OVER ()) AS gap
          FROM (SELECT v, count(*) FILTER (WHERE side = 0) AS a,
            count(*) FILTER (WHERE side = 1) AS b FROM ({values}) GROUP BY v))"""


# (measure, its rows as customer_id, m: the month it is filed under, seen: the month it is known)
SEEN = {
    "bal": ("acct_snap WHERE current_balance IS NOT NULL", "snapshot_month"),
    "salary": ("acct_snap WHERE salary_credit_amount > 0", "snapshot_month"),
    "util": ("card_snap WHERE utilization_rate IS NOT NULL", "snapshot_month"),
    "emi": ("loan_snap WHERE emi_amount IS NOT NULL", "snapshot_month"),
    "txns": ("activity", "snapshot_month"),
    "logins": ("activity WHERE login_count IS NOT NULL", "snapshot_month"),
    "dormant": ("activity WHERE days_since_last_txn IS NOT NULL", "snapshot_month"),
    "campaigns": ("digital", "snapshot_month"),
    "complaints": ("complaint", "complaint_month"),
    "nps": ("feedback WHERE nps_score IS NOT NULL", "feedback_month"),
    "products": ("hold", "snapshot_month"),
    "filed": ("resolved", "complaint_month"),
    "closed": ("resolved WHERE resolved_month IS NOT NULL", "resolved_month"),
}
# (feature, measure, first month, last month) of everything a feature reads.
READS = (
    ("products_count", "products", -1, -1), ("product_acquisition_velocity_6m", "products", -1, -1),
    ("product_acquisition_velocity_6m", "products", -6, -6),
    ("balance_change_3m", "bal", -6, -1), ("txn_count_change_3m", "txns", -6, -1),
    ("login_count_change_6m", "logins", -12, -1), ("complaint_count_6m", "complaints", -6, -1),
    ("unresolved_complaints", "final flag", -999, -1),
    ("unresolved_complaints_strict", "filed", -999, -1),
    ("unresolved_complaints_strict", "closed", -999, -1),
    ("days_since_last_login", "last login", -1, -1),
    ("salary_credit_consistency", "salary", -6, -1), ("credit_utilization", "util", -1, -1),
    ("total_emi", "emi", -1, -1), ("dormant_days", "dormant", -1, -1),
    ("nps_avg_12m", "nps", -12, -1), ("campaign_response_rate", "campaigns", -12, -1),
    ("planted_current_month", "txns", -2, 0),
)
LEADS = f"""WITH seen AS (
      {" UNION ALL ".join(
        f"SELECT '{name}' AS measure, customer_id, {m} AS m, {m} AS known FROM {rows}"
        for name, (rows, m) in SEEN.items())}
      UNION ALL SELECT 'final flag', customer_id, complaint_month,
        greatest(complaint_month, coalesce(resolved_month, complaint_month)) FROM resolved
      UNION ALL SELECT 'last login', customer_id, snapshot_month, greatest(snapshot_month,
        CAST(date_trunc('month', last_login_date) AS DATE)) FROM digital
        WHERE last_login_date IS NOT NULL),
    reads(feature, measure, start, stop) AS (VALUES {", ".join(map(str, READS))})
    SELECT feature, spine.customer_id, as_of_month,
      max(datediff('month', as_of_month, known)) AS lead
    FROM spine CROSS JOIN reads LEFT JOIN seen ON seen.customer_id = spine.customer_id
      AND seen.measure = reads.measure AND m >= as_of_month + to_months(start)
      AND m <= as_of_month + to_months(stop)
    GROUP BY ALL"""

PARITY_TABLES = {
    "customer_master": "cust", "account_master": "acct", "customer_complaints": "complaint",
    "customer_feedback": "feedback", "customer_churn_label": "label",
}
SQL |= {
    "validation_report": f"""SELECT * FROM ({ALL_CHECKS}) UNION ALL
        SELECT 'overall', bool_and(passed), CAST(sum(violations) AS BIGINT), 'all checks'
        FROM ({ALL_CHECKS})""",
    "leak_future_months": f"""SELECT feature, as_of_month, count(*) AS n_rows,
        count(lead) AS n_sourced, count(*) FILTER (WHERE lead >= 0) AS n_leaking,
        CAST(max(lead) AS INT) AS largest_lead FROM ({LEADS}) GROUP BY ALL""",
    "parity_overall_rate": """SELECT round(a, 10) AS left_rate, round(b, 10) AS right_rate,
        abs(a - b) <= 0.01 AS passed FROM (SELECT
          avg(CAST(churned AS INT)) FILTER (WHERE customer_id % 2 = 0) AS a,
          avg(CAST(churned AS INT)) FILTER (WHERE customer_id % 2 = 1) AS b FROM label)""",
    "parity_segment_rate": """SELECT persona, round(a, 10) AS left_rate,
        round(coalesce(b, 0), 10) AS right_rate, abs(a - coalesce(b, 0)) <= 0.02 AS passed
        FROM (SELECT persona, avg(CAST(churned AS INT)) AS a FROM label
          JOIN state USING (customer_id) WHERE customer_id % 2 = 0 GROUP BY persona)
        LEFT JOIN (SELECT persona, avg(CAST(churned AS INT)) AS b FROM label
          JOIN state USING (customer_id) WHERE customer_id % 2 = 1 GROUP BY persona)
        USING (persona)""",
    "parity_ks": " UNION ALL ".join([
        ks_report("annual_income", "SELECT customer_id % 2 AS side, annual_income AS v FROM cust",
                  0.05),
        ks_report("final_balance", """SELECT customer_id % 2 AS side, current_balance AS v
            FROM acct_snap WHERE snapshot_month = DATE '2025-12-01'""", 0.07),
        ks_report("txn_count", """SELECT customer_id % 2 AS side, count(*) AS v FROM txn
            GROUP BY customer_id""", 0.05),
    ]),
    "parity_row_counts": " UNION ALL ".join(
        f"""SELECT table_name, left_rows, right_rows,
        round(CAST(abs(left_rows - right_rows) AS DOUBLE) / left_rows, 10) AS deviation,
        coalesce(CAST(abs(left_rows - right_rows) AS DOUBLE) / left_rows <= 0.25,
          right_rows = 0) AS passed
        FROM (SELECT '{name}' AS table_name, count(*) FILTER (WHERE customer_id % 2 = 0)
          AS left_rows, count(*) FILTER (WHERE customer_id % 2 = 1) AS right_rows FROM {cte})"""
        for name, cte in PARITY_TABLES.items()
    ),
    "parity_columns": " UNION ALL ".join(
        f"""SELECT '{column}' AS column_name, count(*) FILTER (WHERE {wrong}) AS mismatches
        FROM label JOIN spine USING (customer_id, as_of_month)"""
        for column, wrong in {
            "unmatched_rows": "customer_id % 11 = 0",
            **dict.fromkeys((*FEATURE_SQL, "churned", "churn_date", "churn_reason"), "false"),
            "products_count": "customer_id % 5 = 0 AND customer_id % 11 <> 0",
        }.items()
    ),
    "stream_month_sink": f"""SELECT customer_id, snapshot_month, debit_txn_count,
        credit_txn_count, total_debit_amount, total_credit_amount, unique_merchants
        FROM activity WHERE {BUSY}""",
    "stream_activity_rollup": f"""SELECT customer_id, snapshot_month, debit_txn_count,
        credit_txn_count, total_debit_amount, total_credit_amount, unique_merchants,
        cash_withdrawal_count, card_present_txn_count, card_not_present_txn_count
        FROM activity WHERE {BUSY}""",
    "stream_running_balance": """SELECT transaction_id, account_id, balance_after_txn,
        false AS out_of_order FROM ledger""",
}


def oracle_sql() -> dict[str, str]:
    return {name: oracle(sql) for name, sql in SQL.items()}
