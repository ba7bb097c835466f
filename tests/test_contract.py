"""The driver's contract: names, and columns of queries and their SQL."""

from __future__ import annotations

import __spark_entry__


def test_names_and_entry(spark):
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 100
    assert __spark_entry__.entry(spark).count() == 10
