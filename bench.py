"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the local cores. `feature_snapshot` reads written bank
tables, as a feature build over an existing bank does; `feature_snapshot_from_raw` derives every
table from the raw files first. Results go to a sink that reads all rows and keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark import queries as Q
from tidemark.session import build_session
from tidemark.plans import churn, features, quality
from tidemark.sources.star_bank import StarBank

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

FEATURE_TABLES = (
    "customer_master", "account_master", "card_portfolio", "loan_master",
    "account_monthly_snapshot", "card_monthly_snapshot", "loan_monthly_snapshot",
    "product_holdings_monthly", "customer_monthly_activity", "digital_engagement_monthly",
    "customer_complaints", "customer_feedback", "customer_churn_label",
)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(f"local[{CPUS}]", int(CPUS))
    bank = StarBank(spark, SF_DIR)
    stored = Q.written(bank)
    for name in FEATURE_TABLES:
        stored.table(name)
    runs = {
        "feature_snapshot": lambda: features.feature_snapshot(stored),
        "feature_snapshot_from_raw": lambda: features.feature_snapshot(bank),
        "running_balance": lambda: Q.running_balance(bank),
        "account_snapshot": lambda: Q.account_snapshot(bank),
        "activity_rollup": lambda: Q.activity_rollup(bank),
        "churn_signals": lambda: churn.churn_signals(bank),
        "validation_report": lambda: quality.validation_report(stored),
        "parity_ks": lambda: Q.parity_ks(bank),
    }
    drain(features.feature_snapshot(stored))
    drain(quality.validation_report(stored))
    seconds = {}
    for name, build in runs.items():
        best = None
        for _ in range(2):
            start = time.perf_counter()
            drain(build())
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(f"{name}: {best:.2f}s", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "feature_snapshot_seconds",
        "value": seconds["feature_snapshot"],
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "total": round(sum(seconds.values()), 3),
    }))


if __name__ == "__main__":
    main()
