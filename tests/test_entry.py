"""Every query has its SQL twin or a reason not to, and agrees with it on the smallest tables."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as contract

SF = Path("/root/testdata/sf0.001")
NO_SQL: set[str] = set()
SAMPLE = ["silver_clean", "mart_sentiment_daily", "frequent_terms", "drift_verdict", "load_summary", "time_travel", "ingest_twice"]


def test_every_query_has_sql():
    own = set(contract.all_queries())
    assert own - set(contract.oracle_sql()) == NO_SQL
    assert set(contract.oracle_sql()) <= set(contract.queries())


def comparable(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value.isoformat() if hasattr(value, "isoformat") else value


@pytest.mark.skipif(not SF.exists(), reason="driver tables are absent")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    frame = contract.queries()[name](spark, str(SF))
    columns = sorted(frame.columns)
    got = sorted(str([comparable(r[c]) for c in columns]) for r in frame.collect())
    cursor = connection.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = sorted(
        str([comparable(row[names.index(c)]) for c in columns]) for row in cursor.fetchall()
    )
    assert got == expected
