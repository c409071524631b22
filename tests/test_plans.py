"""The shape of the plans: what a larger cluster would run."""

import re

from pyspark.sql import functions as F

from queries import fixtures as fx
from slotcast.operators import features as fe
from slotcast.operators import gold as go
from slotcast.operators import kpis as kp
from slotcast.operators import silver as si
from slotcast.operators.models import additive, baseline
from slotcast.session import materialize
from tests.helpers import SETTINGS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange (hash|range|single|round)", text, re.IGNORECASE))


def no_products(text):
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_no_sort_over_observations(spark, sf):
    """Only rows of repeated ids and rows without one reach the ordered choice."""
    text = plan(si.first_per_id(fx.dirty_bronze(spark, sf)))
    no_products(text)
    assert "SortMergeJoin" not in text
    alone, chosen = text.split("SortAggregate", 1)[0], text.split("SortAggregate", 1)[1]
    assert "Exchange" not in alone.replace("BroadcastExchange", "").replace("ReusedExchange", "")
    assert "partial_min(struct(" in chosen and "_again" in chosen and "isnull(wait_time_id" in chosen
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_silver_combines_before_every_shuffle_of_observations(spark, sf):
    observed = si.clean(fx.bronze(spark, sf), fx.SETTINGS)
    means = plan(si.slot_means(observed, fx.SETTINGS))
    no_products(means)
    assert "SortMergeJoin" not in means and "partial_avg" in means
    # Observations are never shuffled by unit, only their slots are.
    by_unit = means.index("Exchange hashpartitioning(park_name")
    assert "Aggregate" in means[by_unit:].split("\n")[1]
    # The rest reads the written slots, and sorts none of them before the window of each unit.
    text = plan(si.build_silver(fx.bronze(spark, sf), fx.SETTINGS))
    no_products(text)
    assert "SortAggregate" not in text and "SortMergeJoin" not in text
    assert "spelled-" in text and "partial_min(nth_name" in text
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2


def test_split_is_a_pushed_filter(spark, sf):
    silver = materialize(si.build_silver(fx.bronze(spark, sf), fx.SETTINGS), "silver")
    train, _ = fe.chrono_split(silver, fx.SETTINGS)
    text = plan(train)
    no_products(text)
    assert "Subquery" in text and "ts_local" in text


def test_narrow_operators_do_not_shuffle(spark, sf):
    silver = materialize(si.build_silver(fx.bronze(spark, sf), fx.SETTINGS), "silver")
    assert shuffles(plan(fe.build_features(silver))) == 0
    grid = go.forecast_grid(
        fe.with_entity(silver).select("entity", "park_name", "ride_key", "ride_name"),
        fx.now_local(), fx.SETTINGS)
    text = plan(grid)
    no_products(text)
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 0


def test_kpis_are_one_small_shuffle(spark, sf):
    silver = materialize(si.build_silver(fx.bronze(spark, sf), fx.SETTINGS), "silver")
    train, test = fe.chrono_split(silver, fx.SETTINGS)
    scored = materialize(fx.baseline_scored(train, test), "scored")
    text = plan(kp.compute_kpis(scored, fx.SETTINGS))
    assert shuffles(text) == 1 and "partial_avg" in text


def test_fits_see_cells_not_rows(spark, sf):
    silver = materialize(si.build_silver(fx.bronze(spark, sf), fx.SETTINGS), "silver")
    text = plan(additive.fit(silver, fx.SETTINGS))
    assert "Pandas" not in text and "Python" not in text and "partial_sum" in text
    params = materialize(baseline.fit(silver), "params")
    scored = plan(baseline.score(silver, params))
    assert "Python" not in scored and "Pandas" not in scored


def test_a_hot_key_changes_no_result(spark):
    """A third of all rows on one unit, one slot and one id."""
    from tests.helpers import at, bronze

    rows = [(i, i % 50, f"2026-03-02T{18 + i % 4}:{i % 60:02d}", f"u{i % 7}", "North")
            for i in range(600)]
    hot = [(None, 7, "2026-03-02T20:00", "hot", "North")] * 150
    hot += [(9_000 + i, 11, "2026-03-02T20:10", "hot", "North") for i in range(150)]
    got = si.build_silver(bronze(spark, rows + hot), SETTINGS)
    row = got.where("ride_key = 'hot'").first()
    # One row stands for all null ids; the other copies are distinct observations.
    assert row["wait_time"] == (7 + 150 * 11) / 151
    assert row["ts_local"] == at("2026-03-02T12:00")
    assert got.where(F.col("ride_key") != "hot").count() == 7 * 4 * 2
