from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from queries import models as registered
from slotcast.config import MODEL_ADDITIVE, MODEL_GLOBAL, MODEL_LOCAL, TreeParams
from slotcast.operators import features as fe
from slotcast.operators import kpis as kp
from slotcast.operators.models import additive, baseline, cells, global_trees, local_effects, registry
from slotcast.session import materialize
from slotcast.sources.store import TableStore
from tests.helpers import SETTINGS, seasonal_rows, silver

TRAINED = "2026-03-01T00:00:00+00:00"


@pytest.fixture(scope="module")
def data(spark):
    rows = materialize(silver(spark, seasonal_rows(noise=1)), "silver")
    return fe.chrono_split(rows, SETTINGS)


def mae(scored):
    return scored.agg(F.avg(F.abs(F.col("yhat") - F.col("wait_time")))).first()[0]


def test_baseline_and_unknown_entity(spark, data):
    train, test = data
    params = baseline.fit(train.where("ride_key = 'a'"))
    rows = baseline.score(test, params)
    assert rows.where("ride_key = 'b' AND yhat IS NULL").count() == rows.where("ride_key = 'b'").count()
    mean = train.where("ride_key = 'a'").agg(F.avg("wait_time")).first()[0]
    row = rows.where("ride_key = 'a'").first()
    assert (row["yhat"], row["lo"], row["hi"]) == (pytest.approx(mean),) * 3


def test_additive_fit_on_cells_equals_least_squares_on_rows(spark, data):
    """The same ridge solved on every row, by brute force."""
    train, test = data
    params = additive.fit(train, SETTINGS)
    scored = additive.score(test, materialize(params, "p"), SETTINGS).where("ride_key = 'a'")
    got = scored.select("ts_local", "yhat", "lo", "hi").toPandas().sort_values("ts_local")

    rows = train.where("ride_key = 'a'").select(
        "ts_local", "wait_time", additive.holiday_index(F.to_date("ts_local")).alias("h")).toPandas()

    def design(ts, holiday):
        slot = ts.dt.dayofweek * 48 + ts.dt.hour * 2 + ts.dt.minute // 30
        x = additive.seasonal_design(slot.to_numpy(float), 48)
        flags = holiday.fillna(-1).to_numpy()[:, None] == np.arange(len(additive.HOLIDAY_NAMES))
        return np.hstack([x, flags])

    x, y = design(rows["ts_local"], rows["h"]), rows["wait_time"].to_numpy()
    penalty = np.sqrt(np.diag([0.0] + [SETTINGS.additive_ridge] * (x.shape[1] - 1)))
    beta = np.linalg.lstsq(np.vstack([x, penalty]), np.r_[y, np.zeros(x.shape[1])], rcond=None)[0]
    expected = design(got["ts_local"], pd.Series([np.nan] * len(got))) @ beta
    assert np.allclose(got["yhat"], expected, atol=1e-8)
    sigma = np.sqrt(np.mean((y - x @ beta) ** 2))
    assert np.allclose(got["hi"] - got["yhat"], 1.2815515655446004 * sigma)
    assert np.allclose(got["yhat"] - got["lo"], 1.2815515655446004 * sigma)


def test_an_entity_without_a_solution_is_skipped_alone(spark, data):
    """Without a penalty one slot of the week cannot tell the 15 coefficients apart."""
    train, _ = data
    rows = [("North", "stuck", f"2026-0{m}-02T12:00", 5.0) for m in (2, 3)] * 40
    stuck = silver(spark, rows)
    both = train.select(*stuck.columns).unionByName(stuck)
    assert {r["entity"] for r in additive.fit(both, SETTINGS).select("entity").collect()} == {
        "North::a", "North::b", "North::stuck"}
    bare = additive.fit(both, replace(SETTINGS, additive_ridge=0.0)).select("entity").collect()
    assert {r["entity"] for r in bare} == {"North::a", "North::b"}


def test_cholesky_and_its_passes_against_numpy(spark):
    draw, n = np.random.default_rng(2), 6
    rows = []
    for k in range(20):
        x = draw.normal(size=(9, n))
        matrix, right = x.T @ x, draw.normal(size=n)
        if k == 0:
            matrix[2, 2] = -1.0
        lower = [float(matrix[i, j]) for i in range(n) for j in range(i + 1)]
        rows.append((k, lower, right.tolist(), np.linalg.solve(matrix, right).tolist()))
    found = spark.createDataFrame(
        rows, "k int, m array<double>, b array<double>, x array<double>"
    ).withColumn("lower", additive.cholesky(F.col("m"), n)).withColumn(
        "got", additive.solve(F.col("lower"), F.col("b"), n)).collect()
    assert None in found[0]["got"]
    assert all(np.allclose(r["got"], r["x"]) for r in found[1:])


def test_short_histories_are_skipped(spark, data):
    train, _ = data
    strict = replace(SETTINGS, min_train_rows=10**6)
    assert additive.fit(train, strict).isEmpty()
    report = cells.fit_report(cells.eligibility(train, strict)).first()
    assert (report["fitted"], report["skipped"]) == (0, 2)
    with pytest.raises(registry.ModelError):
        registry.fit(MODEL_LOCAL, train, strict, TRAINED)


def test_design_cells_keep_all_rows_whatever_the_skew(spark):
    """A unit with most of the rows is no bigger a group than any other."""
    rows = seasonal_rows(days=14, units=("a",)) * 5 + seasonal_rows(days=14, units=("b",))
    found = additive.design_cells(silver(spark, rows), SETTINGS).groupBy("entity").agg(
        F.count(F.lit(1)).alias("cells"), F.sum("n").alias("rows")).collect()
    by = {r["entity"]: r for r in found}
    assert by["North::a"]["cells"] == by["North::b"]["cells"]
    assert by["North::a"]["rows"] == 5 * by["North::b"]["rows"]


@pytest.mark.parametrize("name", [MODEL_ADDITIVE, MODEL_GLOBAL, MODEL_LOCAL])
def test_families_beat_the_baseline_and_keep_the_contract(spark, data, name):
    train, test = data
    model = registry.fit(name, train, SETTINGS, TRAINED)
    scored = model.score(test, SETTINGS)
    assert scored.count() == test.count()
    assert mae(scored) < mae(baseline.score(test, baseline.fit(train)))
    assert scored.where("lo > yhat OR yhat > hi").isEmpty()
    stranger = test.withColumn("ride_key", F.lit("unknown"))
    assert model.score(stranger, SETTINGS).where("yhat IS NOT NULL").isEmpty()


def test_local_effects_are_stagewise_means(spark, data):
    """Against the same stages on rows in pandas."""
    train, test = data
    params = local_effects.fit(train, SETTINGS)
    rows = fe.with_entity(train).toPandas()
    one = params.first()
    own = rows[rows["entity"] == one["entity"]].copy()
    assert one["n"] == len(own) and np.isclose(one["base"], own["wait_time"].mean())
    ts, left = own["ts_local"].dt, own["wait_time"] - own["wait_time"].mean()
    keys = {"hour": ts.hour, "weekday": ts.weekday, "month": ts.month}
    for name, key in keys.items():
        groups = left.groupby(key)
        effect = groups.sum() / (groups.count() + SETTINGS.local_shrinkage)
        assert {k: round(v, 6) for k, v in one[name].items()} == effect.round(6).to_dict()
        left = left - key.map(effect)
    plan = local_effects.score(test, params, SETTINGS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_residual_quantiles_are_linear(spark, data):
    train, _ = data
    scored = materialize(baseline.score(train, baseline.fit(train)), "s")
    got = {r["entity"]: r for r in cells.residual_quantiles(scored, SETTINGS).collect()}
    pdf = scored.toPandas()
    for entity, group in pdf.groupby("entity"):
        residual = group["wait_time"] - group["yhat"]
        assert got[entity]["res_lo"] == pytest.approx(residual.quantile(0.1))
        assert got[entity]["res_hi"] == pytest.approx(residual.quantile(0.9))


def test_category_codes(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "x string")
    codes = global_trees.category_index(rows, "x")
    assert {r["value"]: r["code"] for r in codes.collect()} == {"a": 0, "b": 1, "c": 2}
    other = spark.createDataFrame([("c",), ("z",)], "x string")
    coded = {r["x"]: r["x_code"] for r in global_trees.apply_category(other, codes, "x").collect()}
    assert coded == {"c": 2, "z": None}


def test_registered_queries_fit_the_documented_trees():
    assert registered.S.trees == registered.WEEKLY.trees == TreeParams()
    assert not hasattr(registered, "QUICK")


def test_trees_tell_more_units_apart_than_64(spark):
    """One deep tree has a leaf for each of 200 levels, also for a unit of one row among many."""
    hours = [f"2026-01-{d:02}T{h:02}:00:00" for d in (5, 6) for h in (9, 11, 13, 15, 17, 19)]
    rows = [("North", f"u{u:03}", t, 3 * u) for u in range(200) for t in (hours if u else hours[:1])]
    whole = TreeParams(trees=1, depth=8, rate=1.0, row_sample=1.0, column_sample=1.0)
    settings, train = replace(SETTINGS, trees=whole), materialize(silver(spark, rows), "units")
    scored = registry.fit(MODEL_GLOBAL, train, settings, TRAINED).score(train, settings)
    assert scored.select("yhat").distinct().count() == 200
    assert scored.agg(F.max(F.abs(F.col("yhat") - F.col("wait_time")))).first()[0] < 1e-6
    assert global_trees.bins_for(10**6, 109) ** 2 >= 10**6 and global_trees.bins_for(10, 5000) > 5000
    with pytest.raises(ValueError, match="bins"):
        global_trees.bins_for(10, 50_000)


@pytest.mark.parametrize("name", [MODEL_ADDITIVE, MODEL_GLOBAL, MODEL_LOCAL])
def test_saved_models_score_the_same(spark, data, scratch, name):
    train, test = data
    model, store = registry.fit(name, train, SETTINGS, TRAINED), TableStore(spark, scratch("store"))
    count = registry.save(model, store, "r1")
    pointer = {"run_id": "r1", "model_name": name, "trained_at": TRAINED, "ride_count": count}
    loaded = registry.load(store, pointer, SETTINGS)
    assert (loaded.trained_at, count) == (TRAINED, 2)
    columns = ["ride_key", "ts_local", "yhat", "lo", "hi"]
    before, after = model.score(test, SETTINGS), loaded.score(test, SETTINGS)
    assert before.select(*columns).exceptAll(after.select(*columns)).isEmpty()


def test_a_model_that_disagrees_is_refused(spark, data, scratch):
    train, _ = data
    model, store = registry.fit(MODEL_ADDITIVE, train, SETTINGS, TRAINED), TableStore(spark, scratch("s"))
    registry.save(model, store, "r1")
    pointer = {"run_id": "r1", "model_name": MODEL_ADDITIVE}
    with pytest.raises(registry.ModelError, match="manifest says"):
        registry.load(store, {**pointer, "model_name": MODEL_LOCAL}, SETTINGS)
    with pytest.raises(registry.ModelError, match="cannot load"):
        registry.load(store, {**pointer, "run_id": "r0"}, SETTINGS)
    renamed = replace(SETTINGS, candidates=("x", "y", "z"))
    with pytest.raises(registry.ModelError, match="unknown model family"):
        registry.load(store, pointer, renamed)
    path = f"{store.root}/models/run=r1/params"
    spark.read.parquet(path).limit(1).write.parquet(scratch("params"))
    one = spark.read.parquet(path).limit(1).collect()
    spark.createDataFrame(one, additive.PARAMS).write.mode("overwrite").parquet(path)
    with pytest.raises(registry.ModelError, match="differ"):
        registry.load(store, pointer, SETTINGS)


def test_retention(spark):
    runs = spark.createDataFrame([(f"r{i}",) for i in range(7)], "run_id string")
    found = registry.expired_runs(runs, "r1", SETTINGS)
    assert sorted(r["run_id"] for r in found.collect()) == ["r0", "r2"]
    assert registry.expired_runs(runs, None, SETTINGS).count() == 3


def test_high_wait_is_measured_on_train(spark, data):
    train, test = data
    high = fe.high_wait_entities(train, replace(SETTINGS, high_wait_mean=50.0))
    assert {r["entity"] for r in high.collect()} == {"North::b"}
    flagged = kp.flag_high(test, high)
    assert flagged.where("is_high").select("ride_key").distinct().collect()[0][0] == "b"


def test_the_booster_reads_points_without_their_lineage(spark, data, monkeypatch):
    seen = []
    fit = global_trees.GBTRegressor.fit
    monkeypatch.setattr(global_trees.GBTRegressor, "fit", lambda self, rows: seen.append(rows) or fit(self, rows))
    few = replace(SETTINGS, trees=TreeParams(trees=2, depth=2))
    model = global_trees.fit(data[0], few)
    assert [type(s).__name__ for s in model.stages] == ["VectorAssembler", "GBTRegressionModel"]
    plan = seen[0]._jdf.queryExecution().sparkPlan().toString()
    assert "ExistingRDD" in plan and "FileScan" not in plan and "Sort" not in plan
