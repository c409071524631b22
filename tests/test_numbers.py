"""Split, KPIs, decision, gold rows, checks and report on golden values."""

from dataclasses import replace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slotcast.config import MODEL_ADDITIVE, MODEL_GLOBAL, MODEL_LOCAL
from slotcast.functions import clock
from slotcast.functions.ranking import with_row_index
from slotcast.operators import checks as ck
from slotcast.operators import features as fe
from slotcast.operators import gold as go
from slotcast.operators import kpis as kp
from slotcast.operators import report as rp
from slotcast.operators import silver as si
from tests.helpers import SETTINGS, at, silver


def times(spark, *texts):
    return spark.createDataFrame([(at(t),) for t in texts], "ts_local timestamp_ntz")


def test_cutoff_interpolates(spark):
    rows = times(spark, "2026-01-01T00:00", "2026-01-01T00:30")
    assert fe.time_cutoff(rows, SETTINGS).first()["cutoff"] == at("2026-01-01T00:24")
    rows = times(spark, *(f"2026-01-01T0{h}:00" for h in (1, 2, 4, 8)))
    assert fe.time_cutoff(rows, SETTINGS).first()["cutoff"] == at("2026-01-01T05:36")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 2000), min_size=1, max_size=60))
def test_cutoff_is_the_linear_quantile(spark, slots):
    import pandas as pd

    base = pd.Timestamp("2026-01-01")
    series = pd.Series([base + pd.Timedelta(minutes=30 * s) for s in slots])
    rows = spark.createDataFrame([(t.to_pydatetime(),) for t in series], "ts_local timestamp_ntz")
    expected = series.quantile(0.8).round("us")
    assert abs(pd.Timestamp(fe.time_cutoff(rows, SETTINGS).first()["cutoff"]) - expected) <= (
        pd.Timedelta(microseconds=1)
    )


def test_split_is_at_the_cutoff(spark):
    rows = silver(spark, [("North", "a", f"2026-03-02T{h:02d}:00", h) for h in range(8, 19)])
    train, test = fe.chrono_split(rows, SETTINGS)
    assert (train.count(), test.count()) == (9, 2)
    assert {r["side"]: r["rows"] for r in fe.split_profile(train, test).collect()} == {
        "train": 9, "test": 2,
    }


def scored(spark, errors, model="m", high=True, hour=12):
    rows = [(model, at(f"2026-03-02T{hour:02d}:00"), 0.0, e, high) for e in errors]
    return spark.createDataFrame(
        rows, "model string, ts_local timestamp_ntz, wait_time double, yhat double, is_high boolean"
    )


def test_kpis_thresholds(spark):
    row = kp.compute_kpis(scored(spark, [10.0, 15.0, 15.1, None]), SETTINGS).first()
    assert row["pct_within_10min"] == pytest.approx(100 / 3)
    assert row["pct_severe_miss"] == pytest.approx(100 / 3)
    assert row["coverage_pct"] == 75.0
    assert row["test_rows"] == 3.0
    assert row["mae"] == pytest.approx(40.1 / 3)


def test_kpis_missing_segments(spark):
    row = kp.compute_kpis(scored(spark, [1.0], high=False, hour=20), SETTINGS).first()
    assert row["high_wait_mae"] is None
    assert row["peak_hours_mae"] is None
    row = kp.compute_kpis(scored(spark, [1.0, -3.0], hour=11), SETTINGS).first()
    assert (row["peak_hours_mae"], row["bias"], row["rmse"]) == (2.0, -1.0, pytest.approx(5**0.5))


def kpi_frame(spark, maes):
    return spark.createDataFrame(list(maes.items()), "model string, mae double")


def test_best_candidate_ties_by_order_and_ignores_the_baseline(spark):
    frame = kpi_frame(spark, {MODEL_LOCAL: 5.0, MODEL_GLOBAL: 4.0, MODEL_ADDITIVE: 4.0,
                              SETTINGS.baseline: 1.0})
    row = kp.best_candidate(frame, SETTINGS).first()
    assert (row["model"], row["mae"], row["usable"]) == (MODEL_ADDITIVE, 4.0, True)
    none = kp.best_candidate(kpi_frame(spark, {MODEL_LOCAL: None, MODEL_GLOBAL: 0.0}), SETTINGS)
    assert none.first()["usable"] is False


@pytest.mark.parametrize(("new", "old", "ship"), [(9.9, 10.0, False), (9.89, 10.0, True), (50.0, None, True)])
def test_decision(spark, new, old, ship):
    best = kpi_frame(spark, {"m": new})
    previous = spark.createDataFrame(
        [] if old is None else [("p", old, "r")], "model_name string, mae double, run_id string"
    )
    row = kp.decide_promotion(best, previous, SETTINGS).first()
    assert row["ship"] is ship
    assert row["reason"]


@pytest.mark.parametrize("start", ["2026-03-02T08:17", "2026-03-02T08:00"])
def test_slot_sequence(spark, start):
    slots = spark.range(1).select(
        go.slot_sequence(clock.naive(at(start)), SETTINGS).alias("s")
    ).first()["s"]
    assert slots[0] == at("2026-03-02T08:30")
    assert len(slots) == 336


@pytest.mark.parametrize(
    ("p", "lo", "hi", "fixed"),
    [(-1.0, -3.0, -2.0, (0.0, 0.0, 0.0)), (5.0, 7.0, 4.0, (5.0, 5.0, 5.0)), (5.0, -1.0, 9.0, (5.0, 0.0, 9.0)),
     (5.0, None, 9.0, (5.0, None, 9.0)), (5.0, 2.0, None, (5.0, 2.0, None))],
)
def test_bound_repair(spark, p, lo, hi, fixed):
    bounds = go.repaired_bounds(*(F.lit(x).cast("double") for x in (p, lo, hi)))
    row = spark.range(1).select(*(c.alias(n) for n, c in bounds.items())).first()
    assert tuple(row) == fixed


def test_forecast_grid_stays_in_opening_hours(spark):
    rows = silver(spark, [("North", "a", "2026-03-02T12:00", 1), ("South", "b", "2026-03-02T12:00", 1)])
    grid = go.forecast_grid(go.active_entities(rows), clock.naive(at("2026-03-02T08:00")), SETTINGS)
    counts = {r["entity"]: r["count"] for r in grid.groupBy("entity").count().collect()}
    slots = {r["park_name"]: r["slots"] for r in
             go.slots_per_site(si.site_table(spark, SETTINGS), SETTINGS).collect()}
    assert counts == {"North::a": slots["North"], "South::b": slots["South"]}


def test_active_entity_has_its_latest_name(spark):
    rows = silver(spark, [("North", "a", "2026-03-02T12:00", 1), ("North", "a", "2026-03-02T13:00", 1)])
    hour = F.hour("ts_local")
    named = rows.withColumn("ride_name", F.when(hour == 13, "new").otherwise("old"))
    assert go.active_entities(named).first()["ride_name"] == "new"


def test_peak_hour_tie(spark):
    rows = silver(spark, [("North", "a", "2026-03-02T08:00", 5), ("North", "a", "2026-03-02T09:00", 5),
                          ("North", "a", "2026-03-02T10:00", 1)])
    assert ck.peak_hour(rows).first()["peak_hour"] == 8


def test_silver_checks_and_gate(spark):
    rows = silver(spark, [("North", "a", "2026-03-02T08:00", 5), ("North", "a", "2026-03-02T12:00", 0)])
    now = clock.naive(at("2026-03-02T13:00"))
    checks = ck.silver_checks(rows, replace(SETTINGS, min_entities=2), now, last_rows=5)
    failed = {r["check_id"] for r in checks.where("not passed").collect()}
    assert failed == {"CHK-01", "CHK-02", "CHK-06"}
    with pytest.raises(ck.QualityCheckError) as error:
        ck.gate(checks)
    assert str(error.value).count("; ") == 2
    ck.gate(checks.where("passed"))


def test_empty_silver_fails_its_checks(spark):
    rows = silver(spark, [("North", "a", "2026-03-02T08:00", 5)]).where("wait_time < 0")
    failed = ck.failures(ck.silver_checks(rows, SETTINGS, clock.naive(at("2026-03-02"))))
    assert failed


def predictions(spark, errors, model="baseline_ride_mean"):
    rows = [("backtest", model, "North", "a", at("2026-03-02"), e) for e in errors]
    return spark.createDataFrame(rows, "row_kind string, model_name string, park_name string, "
                                       "ride_key string, ts_local timestamp_ntz, error_min double")


def test_histogram_bins(spark):
    errors = [-41.0, -40.0, -35.0, 0.0, 39.9, 40.0, 1e9]
    rows = rp.error_histogram(predictions(spark, errors), SETTINGS).collect()
    found = {r["bin"]: r["rows"] for r in rows if r["rows"]}
    assert len(rows) == 18
    assert found == {0: 1, 1: 1, 2: 1, 9: 1, 16: 1, 17: 2}
    sides = {r["bin"]: r["side"] for r in rows}
    assert (sides[0], sides[8], sides[9], sides[17]) == ("under", "zero", "zero", "over")
    assert sum(r["share_pct"] for r in rows) == pytest.approx(100)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("abc", max_size=3), min_size=1, max_size=50, unique=True))
def test_row_index_is_the_sorted_position(spark, words):
    rows = with_row_index(spark.createDataFrame([(w,) for w in words], "w string"), ["w"]).collect()
    assert {r["w"]: r["row_index"] for r in rows} == {w: i for i, w in enumerate(sorted(words))}


def test_row_index_over_many_partitions(spark):
    rows = with_row_index(spark.range(10_000).repartition(13), ["id"])
    assert rows.where("id <> row_index").count() == 0
    assert rows.count() == 10_000
