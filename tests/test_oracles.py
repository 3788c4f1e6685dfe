"""Spark queries against their DuckDB counterparts on the smallest data, all of them.

TIDEMARK_SOME_ORACLES=1 runs a part while working on something else.
"""

import os

import pytest

from check import compare, connect
from tests.conftest import SMALL
from tidemark.oracles.sql import oracle_sql
from tidemark.queries import QUERIES

SOME = (
    "scan_month_partitions", "merge_chunk_outputs", "loan_affordability", "card_tier",
    "join_half_open_range", "correlated_count", "activity_rollup", "running_balance",
    "account_snapshot", "loan_schedule", "loan_snapshot", "card_snapshot", "segment_assignment",
    "conditional_event_gate", "churn_signals", "churn_state", "feature_snapshot",
    "post_churn_activity", "parity_ks",
)
CHOSEN = SOME if os.environ.get("TIDEMARK_SOME_ORACLES") else tuple(QUERIES)
SQL = oracle_sql()


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"schema_contract"}


@pytest.mark.parametrize("name", [n for n in CHOSEN if n in SQL])
def test_same_rows(bank, name):
    verdict, n = compare(QUERIES[name](bank), connect(SMALL).sql(SQL[name]))
    assert verdict == "ok"
    assert n > 0
