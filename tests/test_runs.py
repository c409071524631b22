"""The four statuses of the weekly run, and its failure paths."""

from dataclasses import replace
from datetime import datetime, timedelta
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from slotcast.operators import checks as ck
from slotcast.operators import features as fe
from slotcast.operators import silver as si
from slotcast.operators.models import registry
from slotcast.plans import weekly
from slotcast.session import scratch_path
from slotcast.sources.store import TableStore
from tests.helpers import SETTINGS, bronze, seasonal_rows

NOW = datetime(2026, 2, 2, 6)  # the fixture's last slot is two hours before closing


@pytest.fixture(scope="module")
def observations(spark):
    """Raw observations whose silver is the seasonal fixture (local time is UTC - 8)."""
    rows = seasonal_rows(noise=1)
    raw = [(i, int(w), (datetime.fromisoformat(t) + timedelta(hours=8)).isoformat(), k, p)
           for i, (p, k, t, w) in enumerate(rows)]
    return bronze(spark, raw)


def run_at(store, days=0.0, **changes):
    return weekly.Run(store, replace(SETTINGS, **changes), NOW + timedelta(days=days))


@pytest.fixture
def store(spark, scratch):
    return TableStore(spark, scratch("store"))


def statuses(store, table="predictions"):
    return {r["run_status"] for r in store.read(table).select("run_status").distinct().collect()}


def test_statuses_one_after_the_other(spark, store, observations):
    first = weekly.run_weekly(run_at(store), observations)
    assert first["run_status"] == "fresh_model" and first["previous_mae"] is None
    silver = store.read("silver")
    profile = si.silver_profile(silver).first()
    assert first["raw_rows"] == observations.count() and first["silver_rows"] == silver.count()
    assert (first["sites"], first["mean_wait"], first["zero_pct"]) == (
        profile["sites"], pytest.approx(profile["mean_wait"]), pytest.approx(profile["zero_pct"]))
    assert (first["first_local"], first["last_local"]) == (
        profile["first_local"], profile["last_local"])
    train, test = fe.chrono_split(silver, SETTINGS)
    assert (first["train_rows"], first["test_rows"]) == (train.count(), test.count())
    assert first["cutoff"] == fe.time_cutoff(silver, SETTINGS).first()["cutoff"]
    assert first["fitted"] == dict.fromkeys(SETTINGS.model_order, 2)
    assert first["skipped"] == dict.fromkeys(SETTINGS.model_order, 0)
    assert first["uncovered"] == 0 and first["expired"] == []
    pointer = store.serving()
    assert pointer["run_id"] == first["run_id"] and pointer["ride_count"] == 2
    kpis = store.read("kpis")
    assert kpis.count() == 36
    assert kpis.where("is_serving").select("model").distinct().first()["model"] == first["serving_model"]
    rows = store.read("predictions")
    assert rows.where("row_kind = 'forecast'").count() == first["forecast_rows"] == 2 * 196
    assert {r["model_name"] for r in rows.where("row_kind = 'backtest'").select("model_name")
            .distinct().collect()} == set(SETTINGS.model_order)

    second = weekly.run_weekly(run_at(store, 1), observations)
    assert second["run_status"] == "kept_previous_model"
    assert second["serving_run_id"] == first["run_id"]
    assert store.serving()["run_id"] == first["run_id"]
    assert second["backtest_rows"] == first["backtest_rows"]
    assert statuses(store) == {"kept_previous_model"} == statuses(store, "kpis")

    third = weekly.run_weekly(run_at(store, 3), observations)
    assert third["run_status"] == "stale_input" and third["new_model_mae"] is None
    assert third["raw_rows"] == first["raw_rows"] and third["train_rows"] is None
    assert third["fitted"] == {} and third["uncovered"] == 0
    window = store.read("predictions").where("row_kind = 'forecast'").agg(F.max("ts_local")).first()[0]
    assert window > NOW + timedelta(days=9)

    kpi_version = store.pointer()["tables"]["kpis"]
    with pytest.raises(ck.QualityCheckError):
        weekly.run_or_fall_back(run_at(store, 4, min_entities=99), observations)
    assert statuses(store) == {"fallback_after_failure"}
    assert statuses(store, "kpis") == {"stale_input"}
    assert store.pointer()["tables"]["kpis"] == kpi_version
    assert store.candidates() == {}
    assert store.serving()["run_id"] == first["run_id"]

    frame = weekly.summary_frame(store, third)
    assert frame.first()["decision"].startswith("input is")


def test_first_run_that_fails_leaves_nothing(spark, store, observations):
    with pytest.raises(ck.QualityCheckError):
        weekly.run_or_fall_back(run_at(store, min_entities=99), observations)
    assert store.pointer() is None and store.candidates() == {}


def test_stale_first_run_raises(spark, store, observations):
    with pytest.raises(weekly.RunError, match="no serving model"):
        weekly.run_weekly(run_at(store, 30), observations)


def test_cleaning_everything_away_raises(spark, store, observations):
    nothing = observations.withColumn("park_name", F.lit("Elsewhere"))
    with pytest.raises(weekly.RunError, match="every row"):
        weekly.run_weekly(run_at(store), nothing)


@pytest.fixture(scope="module")
def served(spark, observations):
    """A store after one good run; the tests below use it in order."""
    store = TableStore(spark, scratch_path(spark, "store"))
    weekly.run_weekly(run_at(store), observations)
    return store


def test_bounds_and_keys_of_gold(served):
    rows = served.read("predictions")
    assert rows.where("lower_bound > predicted_wait_min OR predicted_wait_min > upper_bound "
                      "OR predicted_wait_min < 0").isEmpty()
    problems = ck.serving_constraints(served.read("kpis"), rows).where("violations > 0")
    assert problems.isEmpty()
    silver = served.read("silver")
    assert silver.count() == silver.select("park_name", "ride_key", "ts_local").distinct().count()
    assert si.silver_profile(silver).first()["entities"] == 2


def test_fallback_refuses_an_unchecked_forecast(served):
    before = served.pointer()
    assert weekly.run_fallback(run_at(served, 1, row_band=(2.0, 3.0))) is False
    assert served.pointer() == before
    assert weekly.run_fallback(run_at(served, 1)) is True


def test_mismatched_run_ids_are_refused(served, observations):
    """A hand-made promotion of KPIs of another run: neither run nor fallback may serve it."""
    served.write("kpis", served.read("kpis").withColumn("run_id", F.lit("other")), "by-hand")
    served.promote("kpis")
    before = served.pointer()
    with pytest.raises(weekly.RunError, match="refusing to mix"):
        weekly.run_weekly(run_at(served, 3), observations)
    assert weekly.run_fallback(run_at(served, 3)) is False
    assert served.pointer() == before


def test_versions_without_a_promotion_are_listed(spark, store):
    rows = spark.range(3)
    for run in ("a", "b", "c", "d"):
        store.write("silver", rows, run)
        if run != "b":
            rows.write.parquet(f"{store.root}/models/run={run}/params")
            store.promote("silver", serving={"run_id": run, "model_name": "m", "trained_at": "t"})
        store.discard()

    def found(keep):
        listed = registry.unreachable(store, replace(SETTINGS, retain_runs=keep)).collect()
        return {(r["name"], r["run"][:1], r["last_named"]) for r in listed}

    assert found(3) == {("silver", "b", None)}
    assert found(2) == {("silver", "b", None), ("silver", "a", 1), ("models", "a", 1)}
    # A fallback promotes only the predictions: the other tables stay reachable by its row.
    store.write("predictions", rows, "e")
    store.promote("predictions")
    assert found(1) == {("silver", "b", None), ("silver", "a", 1), ("models", "a", 1),
                        ("silver", "c", 2), ("models", "c", 2)}
    empty = TableStore(spark, store.root + "-none")
    assert registry.unreachable(empty, SETTINGS).count() == 0


def test_families_are_fitted_at_once(store, monkeypatch):
    together = Barrier(len(SETTINGS.model_order))

    def fit(name, train, settings, trained_at, watch):
        together.wait(30)  # breaks if one family waits for another
        if train is None and name == SETTINGS.baseline:
            raise registry.ModelError("no rows")
        return name, trained_at

    monkeypatch.setattr(registry, "fit", fit)
    run = run_at(store)
    assert weekly.fit_models(run, "rows") == {n: (n, run.trained_at) for n in SETTINGS.model_order}
    with pytest.raises(registry.ModelError):
        weekly.fit_models(run, None)
