import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402
from tidemark.sources.star_bank import StarBank  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return build_session("local[8]", 4)


@pytest.fixture(scope="session")
def bank(spark):
    return StarBank(spark, SMALL)


def month(n: int) -> dt.date:
    """The n-th month of 2024, counting on into the next years."""
    return dt.date(2024 + (n - 1) // 12, (n - 1) % 12 + 1, 1)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
