"""Bulk load into a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import inline_table
from tidemark.sources.schemas import LOAD_ORDER, SCHEMAS


def load_order(names) -> list[str]:
    """Parents before children."""
    return [name for name in LOAD_ORDER if name in names]


def reachable(spark, url: str, properties: dict) -> str | None:
    """None if the database answers, else why not."""
    try:
        spark.read.jdbc(url, "(SELECT 1 AS one) probe", properties=properties).limit(1).collect()
        return None
    except Exception as error:
        return str(error).splitlines()[0]


def jdbc_load(bank, url: str, properties: dict | None = None, names=LOAD_ORDER,
              connections: int = 16) -> DataFrame:
    """Append tables in foreign-key order; one row per table with what happened.

    An unreachable database skips everything, a failing table only itself. Columns are written by
    name, so their order in the database does not matter. Each partition inserts over its own
    connection; `connections` bounds how many a database has to serve.
    """
    properties = properties or {}
    spark = bank.spark
    problem = reachable(spark, url, properties)
    outcome = []
    for position, name in enumerate(load_order(names)):
        if problem is not None:
            outcome.append((position, name, "skipped", problem))
            continue
        try:
            df = bank.table(name).select(*[f.name for f in SCHEMAS[name]])
            if df.isEmpty():
                outcome.append((position, name, "empty", None))
                continue
            df.coalesce(connections).write.jdbc(url, name, mode="append", properties=properties)
            outcome.append((position, name, "loaded", None))
        except Exception as error:
            outcome.append((position, name, "failed", str(error).splitlines()[0]))
    return inline_table(spark, ("load_position", "table_name", "status", "reason"), outcome)
