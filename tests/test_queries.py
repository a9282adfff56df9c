"""Every query against its SQL in DuckDB, and the driver contract."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as contract
from eventloom.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return compare.duck(folder)


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, folder, con, name):
    ours = QUERIES[name](spark, folder).toArrow()
    assert compare.differences(ours, con.sql(ORACLES[name]).to_arrow_table()) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_models_cover_all_rows(spark, folder, name):
    result = QUERIES[name](spark, folder)
    events = spark.read.parquet(f"{folder}/events.parquet")
    expected = events.count() if name == "anomaly_iforest" else events.select("user_id").distinct().count()
    assert result.count() == expected


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())
    result = contract.entry(spark)
    assert result.columns == ["day", "event_type", "country", "events", "users", "revenue"]
    assert result.count() > 0
