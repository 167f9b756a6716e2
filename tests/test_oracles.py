"""Every registered query equals its independent DuckDB oracle."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_harness import compare, duck
from tillsight.oracles import oracle_statements
from tillsight.plans.registry import registered_queries


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


QUERIES, ORACLES = registered_queries(), oracle_statements()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    result = compare(spark, con, key, QUERIES[key], ORACLES[key], SF_SMALL)
    assert result["columns_match"], result
    assert result["spark_rows"] == result["oracle_rows"], result
    assert result["match"], result


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "CustomerSegment", "CustomerCount", "SegmentRevenue", "AverageFrequency", "AverageRecencyDays",
    ]
    got = {r["CustomerSegment"]: r["CustomerCount"] for r in df.collect()}
    assert got == {"Active": 32, "At Risk": 80, "High Value": 11, "Regular": 27}


SPARK_TO_DUCKDB = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_column_types_match_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    spark_types = {f.name: SPARK_TO_DUCKDB.get(f.dataType.simpleString()) for f in sdf.schema.fields}
    rel = con.sql(ORACLES[key])
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    assert spark_types == duck_types


@pytest.mark.parametrize("key", ["typed_sales", "date_functions", "weekday_sales", "customer_rfm"])
def test_results_do_not_depend_on_session_time_zone(spark, con, key):
    """Timestamps are pinned to TIMESTAMP_NTZ right after parsing, so a
    non-UTC session (with DST) gives the same rows."""
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        result = compare(spark, con, key, QUERIES[key], ORACLES[key], SF_SMALL)
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)
    assert result["match"], result
