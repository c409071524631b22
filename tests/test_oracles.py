"""Queries against their DuckDB oracles at the smallest scale."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect
from queries import ORACLES, QUERIES
from tests.conftest import SF

SAMPLE = [
    "scalar_to_utc", "scalar_canonical_key", "feature_holidays", "ingest_merge",
    "ingest_gap_report", "silver_build", "silver_build_dirty", "split_time_cutoff",
    "kpi_all_models", "gold_forecast_rows", "gold_backtest_rows", "check_predictions_spoiled",
    "publish_pair_checks", "report_error_histogram", "io_chunks", "model_additive_sums",
    "model_residual_quantiles",
]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert compare(got, duck.execute(ORACLES[name]).df()) == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    row = entry.entry(spark).collect()
    assert [r["model"] for r in row] == ["baseline_ride_mean"]
    assert row[0]["coverage_pct"] > 0
