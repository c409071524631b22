from collections import defaultdict
from dataclasses import replace
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slotcast.operators import silver as si
from slotcast.session import materialize
from tests.helpers import SETTINGS, SITES, at, bronze

NOON = "2026-03-02T20:00"


def test_wait_range(spark):
    rows = bronze(spark, [(i, w, NOON, "a", "North") for i, w in enumerate([-1, 0, 899, 900, None])])
    kept = {r["wait_time"] for r in si.valid_waits(rows, SETTINGS).collect()}
    assert kept == {0, 899}


def test_first_per_id_keeps_the_earliest(spark):
    rows = bronze(spark, [
        (1, 9, NOON, "a", "North", "2026-03-02"), (1, 5, NOON, "a", "North", "2026-03-01"),
        (None, 3, NOON, "b", "North"), (None, 2, NOON, "c", "North"), (2, 1, NOON, "a", "North"),
    ])
    kept = {(r["wait_time_id"], r["wait_time"]) for r in si.first_per_id(rows).collect()}
    assert kept == {(1, 5), (None, 2), (2, 1)}
    assert si.first_per_id(rows.drop("wait_time_id")).count() == 5


def test_opening_hours(spark):
    rows = [(h, 1, f"2026-03-02T{(h + 8) % 24:02d}:00" if h < 16 else f"2026-03-03T{h - 16:02d}:00",
             "a", "North") for h in (7, 8, 21, 22)]
    local = si.localize(bronze(spark, rows), SETTINGS)
    assert {r["wait_time_id"] for r in si.open_hours(local, SETTINGS).collect()} == {8, 21}


def test_first_trusted_date(spark):
    rows = [(1, 1, "2026-01-31T20:00", "a", "Late"), (2, 1, "2026-02-01T20:00", "a", "Late")]
    local = si.localize(bronze(spark, rows), SETTINGS)
    assert [r["wait_time_id"] for r in si.open_hours(local, SETTINGS).collect()] == [2]


def test_names_and_sites(spark):
    rows = bronze(spark, [
        (1, 1, NOON, "  x ", "North"), (2, 1, NOON, " 0 ", "North"), (3, 1, NOON, "", "North"),
        (4, 1, NOON, None, "North"), (5, 1, NOON, "x", "Gone"), (6, 1, NOON, "x", "Elsewhere"),
        (7, 1, NOON, "x", None), (8, 1, NOON, "™", "North"), (9, 1, None, "x", "North"),
    ])
    kept = si.clean(rows, SETTINGS).collect()
    assert [(r["wait_time_id"], r["ride_name"]) for r in kept] == [(1, "x")]
    assert {r["wait_time_id"] for r in si.known_sites(rows, SETTINGS).collect()} == {1, 2, 3, 4, 8, 9}


def test_spellings_collapse_to_the_mean_of_their_means(spark):
    rows = bronze(spark, [
        (1, 10, NOON, "x y", "North"), (2, 20, NOON, "x y", "North"), (3, 40, NOON, "x_y", "North"),
    ])
    row = si.build_silver(rows, SETTINGS).collect()
    assert [(r["ride_key"], r["ride_name"], r["wait_time"]) for r in row] == [("x_y", "x y", 27.5)]


def test_min_history_is_inclusive(spark):
    rows = [(i, 1, (at(NOON) + timedelta(minutes=30 * i)).isoformat(), "a", "South") for i in range(5)]
    rows += [(10 + i, 1, (at(NOON) + timedelta(minutes=30 * i)).isoformat(), "b", "South") for i in range(4)]
    silver = si.build_silver(bronze(spark, rows), replace(SETTINGS, min_obs=5))
    assert {r["ride_key"] for r in silver.collect()} == {"a"}


def brute_force(rows):
    """Silver in plain Python, row by row."""
    zone, sites = ZoneInfo("America/Los_Angeles"), {s.name: s for s in SITES}
    seen, slots = set(), defaultdict(list)
    for i, wait, when, name, site, *_ in sorted(rows, key=lambda r: (r[1] is not None, r[1])):
        if i in seen:
            continue
        seen.add(i)
        if wait is None or not 0 <= wait < 900 or site not in sites or site == "Gone":
            continue
        name = name.strip()
        local = datetime.fromisoformat(when).replace(tzinfo=ZoneInfo("UTC")).astimezone(zone)
        local, s = local.replace(tzinfo=None), sites[site]
        if not (s.open_hour <= local.hour < s.close_hour and local.date() >= s.first_date):
            continue
        slot = local.replace(minute=local.minute // 30 * 30, second=0)
        slots[site, name.replace(" ", "_"), slot, name].append(wait)
    grid = defaultdict(list)
    for (site, key, slot, _), waits in slots.items():
        grid[site, key, slot].append(sum(waits) / len(waits))
    return {k: sum(m) / len(m) for k, m in grid.items()}


ROWS = st.lists(
    st.tuples(
        st.integers(0, 40), st.one_of(st.none(), st.integers(-5, 1000)),
        st.integers(0, 4 * 24 * 60).map(lambda m: (at("2026-03-06") + timedelta(minutes=m)).isoformat()),
        st.sampled_from(["a", "b c", "b_c", " a"]),
        st.sampled_from(["North", "South", "Late", "Gone", "Elsewhere"]),
    ),
    min_size=1, max_size=80, unique_by=lambda r: (r[0], r[1]),
)


@settings(max_examples=15, deadline=None)
@given(ROWS)
def test_silver_equals_brute_force(spark, rows):
    got = si.build_silver(bronze(spark, rows), SETTINGS).collect()
    found = {(r["park_name"], r["ride_key"], r["ts_local"]): r["wait_time"] for r in got}
    assert len(found) == len(got)
    assert all(r["ts_local"].minute in (0, 30) and r["ts_local"].second == 0 for r in got)
    expected = brute_force(rows)
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(v) for k, v in expected.items())


def test_utc_defect_would_cut_the_evening(spark):
    """19:30 local is 03:30 UTC: it must survive the hours filter."""
    rows = bronze(spark, [(1, 60, "2026-03-03T03:30", "a", "North")])
    assert si.build_silver(rows, SETTINGS).first()["ts_local"] == at("2026-03-02T19:30")


def test_profile_and_age(spark):
    silver = materialize(si.build_silver(bronze(spark, [
        (1, 0, NOON, "a", "North"), (2, 10, "2026-03-02T20:30", "a", "North"),
        (3, 20, NOON, "b", "South"),
    ]), SETTINGS), "silver")
    row = si.silver_profile(silver).first()
    assert (row["grid_rows"], row["entities"], row["sites"], row["mean_wait"]) == (3, 2, 2, 10)
    assert row["zero_pct"] == pytest.approx(100 / 3)
    now = F.lit("2026-03-03 00:30:00").cast("timestamp_ntz")
    assert si.data_age_hours(silver, now).first()["age_hours"] == 12.0
    empty = silver.where("wait_time < 0")
    assert si.data_age_hours(empty, now).first()["age_hours"] == float("inf")


def test_ids_repeated_any_number_of_times_are_found(spark):
    """Odd and even counts in one run of 64 ids, beside single, negative, huge and missing ids."""
    times = {0: 1, 1: 2, 2: 3, 3: 4, 63: 1, 64: 2, 65: 1, 200: 3, 201: 3, 300: 5, 301: 1,
             -1: 2, -64: 1, -65: 3, 2**63 - 1: 2, -(2**63): 2, 2**40: 1, None: 3}
    rows = [(i, n - k, NOON, f"r{k}", "North", f"2026-03-0{9 - k}")
            for i, n in times.items() for k in range(n)]
    kept = {r["wait_time_id"]: r["wait_time"] for r in si.first_per_id(bronze(spark, rows)).collect()}
    assert kept == dict.fromkeys(times, 1)
    assert si.first_per_id(bronze(spark, rows)).count() == len(times)


def test_many_repeated_ids_shuffle_no_single_row(spark):
    """However many ids are repeated, rows of single ids meet no shuffle and no sort."""
    ids = spark.range(400_000).select(
        F.explode(F.array("id", F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") + 10**9)))
        .alias("wait_time_id"))
    # Wider than the broadcast threshold as a list of ids, narrower as a filter.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100000")
    try:
        first = si.first_per_id(ids.withColumn("wait_time", F.col("wait_time_id") % 7))
        text = first._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
    assert text.count("Exchange hashpartitioning") == 1
    assert first.count() == 600_000 and first.distinct().count() == 600_000
