"""Ingest, landing, store, serving and streams."""

import json
import os
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from slotcast.functions import clock, skew
from slotcast.operators import gold as go
from slotcast.operators import ingest as ing
from slotcast.operators.checks import QualityCheckError
from slotcast.plans.ingest_run import run_ingest
from slotcast.plans.publish import run_publish
from slotcast.plans.report_job import run_report
from slotcast.schemas import BRONZE, KPIS, LANDING, LANDING_COLUMNS, PREDICTIONS
from slotcast.sources import catalog, landing
from slotcast.sources import serving as sv
from slotcast.sources import upstream as up
from slotcast.sources.bronze import Bronze
from slotcast.sources.store import TableStore
from slotcast.streaming import landing_stream as ls
from slotcast.streaming import silence_stream as quiet
from slotcast.streaming import slot_stream as ss
from slotcast.streaming.id_stream import IdRangeReader, drain_ids
from tests.helpers import SETTINGS, at, bronze, silver

NOW = datetime(2026, 3, 1, 6)
NOON = "2026-03-02T20:00"


def upstream(spark, n):
    fact = spark.range(1, n + 1).select(
        F.col("id").alias("wait_time_id"), (F.col("id") % 90).alias("wait_time"),
        F.expr("timestamp_ntz '2026-01-10 18:00:00' + make_interval(0,0,0,0,0,id)").alias(
            "wait_time_upd_dt"),
        (F.col("id") % 3).alias("at_id"),
    )
    units = spark.createDataFrame([(0, "a", 1), (1, "b", 1)], "at_id long, at_name string, tp_id long")
    sites = spark.createDataFrame([(1, "North")], "tp_id long, tp_name string")
    return fact, units, sites


def test_orphans_drop_and_the_mark_is_strict(spark):
    rows = up.read_since(*upstream(spark, 9), 3)
    assert sorted(r["wait_time_id"] for r in rows.collect()) == [4, 6, 7, 9]
    assert rows.columns == LANDING_COLUMNS
    capped = up.read_since(*upstream(spark, 9), 3, 2)
    assert [r["wait_time_id"] for r in capped.collect()] == [4, 6]


def test_a_hot_unit_is_split(spark):
    fact, units, sites = upstream(spark, 3000)
    fact = fact.withColumn("at_id", F.when(F.col("wait_time_id") % 3 > 0, 0).otherwise(
        F.col("wait_time_id") % 400))
    units = spark.range(400).select(F.col("id").alias("at_id"), F.concat(F.lit("u"), "id").alias("at_name"),
                                    F.when(F.col("id") < 300, 1).otherwise(2).alias("tp_id"))
    dealt, copies = skew.salted(fact, units, "at_id", 16, 10)
    sizes = {(r["at_id"], r["_salt"]): r["n"] for r in
             dealt.groupBy("at_id", "_salt").agg(F.count(F.lit(1)).alias("n")).collect()}
    hot = [n for (unit, _), n in sizes.items() if unit == 0]
    assert len(hot) == 16 and sum(hot) > 2000 and max(hot) < 2000 / 16 * 2
    assert {salt for unit, salt in sizes if unit != 0} == {0}
    assert copies.count() == 400 + 15 and copies.where("at_id = 0").count() == 16
    spread = up.observations(fact, units, sites, spread=True)
    assert spread.exceptAll(up.observations(fact, units, sites)).isEmpty()
    assert spread.count() == up.observations(fact, units, sites).count() > 2000
    text = spread._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and text.count("SortMergeJoin") == 2
    assert skew.spread_join(fact.limit(0), units, "at_id").count() == 0


def test_a_capped_batch_is_the_oldest_rows(spark):
    """Ids with gaps, in one case all far apart, against sorting by hand."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    _, units, sites = upstream(spark, 1)

    @settings(max_examples=8, deadline=None)
    @given(st.sets(st.integers(1, 400), min_size=1, max_size=60), st.integers(1, 70),
           st.sampled_from([1, 1000]))
    def check(ids, n, spread):
        fact = spark.createDataFrame([(i * spread, 1, at(NOON), 0) for i in ids],
                                     "wait_time_id long, wait_time long, "
                                     "wait_time_upd_dt timestamp_ntz, at_id long")
        got = up.read_since(fact, units, sites, 20 * spread, n).collect()
        expected = sorted(i * spread for i in ids if i > 20)[:n]
        assert [r["wait_time_id"] for r in got] == expected

    check()


def test_unreadable_wait_is_null_and_unreadable_time_raises(spark):
    row = (1, "closed", "2026-01-01 00:00:00", 1, "a", 1, "North")
    schema = ("wait_time_id long, wait_time string, ts_utc string, at_id long, ride_name string, "
              "tp_id long, park_name string")
    good = up.coerce_landing(spark.createDataFrame([row, (2, "12.0", *row[2:])], schema))
    assert good.schema == LANDING
    assert [r["wait_time"] for r in good.orderBy("wait_time_id").collect()] == [None, 12]
    bad = up.coerce_landing(spark.createDataFrame([(1, "1", "soon", *row[3:])], schema))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.collect()


def test_merge_inserts_only_and_keeps_duplicates_of_a_batch(spark):
    target = bronze(spark, [(1, 10, NOON, "a", "North"), (5, 50, NOON, "a", "North")])
    batch = bronze(spark, [(5, 99, NOON, "a", "North"), (6, 60, NOON, "a", "North"),
                           (6, 61, NOON, "a", "North")])
    merged = ing.merge(batch, target)
    assert sorted((r["wait_time_id"], r["wait_time"]) for r in merged.collect()) == [
        (1, 10), (5, 50), (6, 60), (6, 61),
    ]
    assert ing.merge(batch, merged).count() == 4


def test_merge_pushes_the_bound_into_the_bronze_scan(spark, scratch):
    path = scratch("bronze")
    bronze(spark, [(i, 1, NOON, "a", "North") for i in range(50)]).write.parquet(path)
    batch = bronze(spark, [(49, 1, NOON, "a", "North")])
    plan = ing.new_rows(batch, spark.read.parquet(path), 40)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(wait_time_id,40)" in text
    assert "ReadSchema: struct<wait_time_id:bigint>" in text


def test_ingest_run(spark, scratch):
    paths = scratch("bronze"), scratch("landing")
    source, small = upstream(spark, 30), replace(SETTINGS, batch_rows=6)
    dry = run_ingest(spark, source, *paths, small, NOW, dry_run=True)
    assert (dry["gap"], dry["rows"]) == (30, 0)
    one = run_ingest(spark, source, *paths, small, NOW)
    assert (one["rows"], one["batches"], one["bronze_rows"]) == (6, 1, 6)
    rest = run_ingest(spark, source, *paths, small, NOW, drain=True)
    assert (rest["rows"], rest["bronze_rows"], rest["bronze_max"]) == (14, 20, 30)
    assert rest["batches"] > 1
    assert rest["caught_up"]
    again = run_ingest(spark, source, *paths, replace(small, batch_rows=None), NOW, drain=True)
    assert (again["rows"], again["bronze_rows"]) == (0, 20)


def test_the_width_of_a_transfer_changes_no_row(spark, scratch):
    found = []
    for width in (2, 7, None):
        path, narrow = scratch("b"), replace(SETTINGS, batch_rows=width)
        done = run_ingest(spark, upstream(spark, 30), path, scratch("l"), narrow, NOW, drain=True)
        assert (done["rows"], done["caught_up"]) == (20, True)
        rows = spark.read.parquet(path).drop("_ingested_at").collect()
        found.append(sorted(map(tuple, rows)))
    assert found[0] == found[1] == found[2]


def stored(spark, scratch, ids, width=10):
    table = Bronze(spark, scratch("bronze"), width)
    table.ensure()
    table.merge(bronze(spark, [(i, 1, NOON, "a", "North") for i in ids]), min(ids), max(ids))
    return table


def test_the_merge_opens_only_folders_of_the_batch(spark, scratch):
    table = stored(spark, scratch, range(1, 61))
    assert sorted(f for f in os.listdir(table.path) if f.startswith("id_range")) == [
        f"id_range={k}" for k in range(7)
    ]
    plan = table.between(45, 52)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "id_range" in filters and "4" in filters and "5" in filters
    assert "GreaterThanOrEqual(wait_time_id,45)" in plan
    assert sorted(r[0] for r in table.between(45, 52).select("wait_time_id").collect()) == list(
        range(45, 53))
    files = {r[0] for r in table.between(45, 52).select(F.input_file_name()).distinct().collect()}
    assert {f.split("id_range=")[1][0] for f in files} == {"4", "5"}


def test_spans_say_where_bronze_can_hold_an_id(spark, scratch):
    table = stored(spark, scratch, [1, 2, 33, 39])
    assert table.may_hold(2, 5) and table.may_hold(34, 50)
    assert not table.may_hold(3, 20) and not table.may_hold(40, 90)
    # Sent again, with one row that is new, and one id twice: inserted once each time it is there.
    again = bronze(spark, [(i, 5, NOON, "a", "North") for i in (33, 34, 39, 50, 50)])
    for _ in range(2):
        table.merge(again, 33, 50)
    found = sorted((r["wait_time_id"], r["wait_time"]) for r in table.read().collect())
    assert found == [(1, 1), (2, 1), (33, 1), (34, 5), (39, 1), (50, 5), (50, 5)]
    assert ing.high_water(table.newest_range()).first()["mark"] == 50


def test_id_ranges_cover_every_id_once():
    for start, top, width in ((0, 30, 6), (9, 30, 6), (9, 9, 6), (0, 1, 100), (7, 100_000, 3)):
        reader = IdRangeReader(start, top, width)
        slices = reader.partitions(reader.initialOffset(), reader.latestOffset())
        ranges = [r for s in slices for r in reader.read(s)]
        assert [x for low, high in ranges for x in range(low, high + 1)] == list(
            range(start + 1, top + 1))
        assert all(low // width == high // width for low, high in ranges) and len(slices) <= 17
    assert IdRangeReader(50, 20, 5).initialOffset() == {"id": 20}


def test_a_drain_that_was_cut_off_comes_again_with_its_ids(spark, scratch):
    checkpoint, seen = scratch("cp"), []

    def broken(low, high, ranges, epoch):
        seen.append((low, high, ranges, epoch))
        raise RuntimeError("the connection is gone")

    with pytest.raises(Exception, match="connection is gone"):
        drain_ids(spark, broken, 10, 30, 10, checkpoint).awaitTermination()
    for top in (40, 40, 55):
        drain_ids(
            spark, lambda *x: seen.append(x), 99, top, 10, checkpoint
        ).awaitTermination()
    # The batch that failed keeps its end, then what came since; a stream without news does nothing.
    assert seen == [(11, 30, 3, 0), (11, 30, 3, 0), (31, 40, 2, 1), (41, 55, 2, 2)]


def test_jdbc_reads_are_bounded_by_the_ids_they_ask_for(spark, scratch, monkeypatch):
    asked, (fact, units, sites) = [], upstream(spark, 30)

    def read_jdbc(_spark, _url, table, _options=None, column=None, bounds=None, partitions=None):
        asked.append((table, column, bounds))
        if "max(" in table:
            return fact.agg(F.max("wait_time_id"))
        return {"wait_times": fact, "attractions": units, "themeparks": sites}[table]

    monkeypatch.setattr(up, "read_jdbc", read_jdbc)
    paths = scratch("bronze"), scratch("landing")
    done = run_ingest(spark, up.Jdbc(spark, "jdbc:none"), *paths, SETTINGS, NOW, drain=True)
    assert (done["rows"], done["bronze_rows"]) == (20, 20)
    assert ("wait_times", "wait_time_id", (1, 31)) in asked
    assert all(bounds for table, _, bounds in asked if table == "wait_times")


def test_landing_replaces_a_batch_sent_twice(spark, scratch):
    root, rows = scratch("landing"), bronze(spark, [(7, 1, NOON, "a", "North")])
    first = landing.land_batch(rows, root, 7, NOW)
    assert landing.land_batch(rows, root, 7, NOW) == first
    assert "dt=2026-03-01/batch=000000000007-" in first
    assert landing.read_batch(spark, first).count() == 1
    assert landing.read_batch(spark, root).count() == 1


# ---- store --------------------------------------------------------------------------


def test_store_promotes_and_discards(spark, scratch):
    store = TableStore(spark, scratch("store"))
    assert store.pointer() is None and not store.exists("t") and store.count("t") is None
    store.write("t", spark.range(3), "r1")
    assert not store.exists("t")
    store.promote("t")
    assert store.count("t") == 3
    store.write("t", spark.range(9), "r2")
    store.discard("t")
    assert store.count("t") == 3 and store.candidates() == {}
    # A table may be rewritten from its own last version.
    store.write("t", store.read("t").union(spark.range(1)), "r3")
    store.promote("t")
    assert store.count("t") == 4
    assert store.serving() is None
    store.promote(serving={"run_id": "r", "model_name": "m", "trained_at": "x", "ride_count": 1})
    assert store.serving()["model_name"] == "m" and store.count("t") == 4
    assert store.register() == ["t_last"]
    assert spark.sql("SELECT count(*) AS n FROM t_last").first()["n"] == 4


def test_catalog_names(spark, scratch):
    location = scratch("tables")
    catalog.ensure_schema(spark, "default")
    for _ in range(2):
        catalog.ensure_bronze(spark, "raw_observations", f"{location}/bronze")
    assert catalog.table_exists(spark, "raw_observations")
    assert catalog.table_count(spark, "raw_observations") == 0
    spark.range(2).write.parquet(f"{location}/v1")
    spark.range(5).write.parquet(f"{location}/v2")
    assert catalog.promote_view(spark, f"{location}/v1", "numbers_last").count() == 2
    assert catalog.promote_view(spark, f"{location}/v2", "numbers_last").count() == 5
    assert catalog.drop_tables(spark, "no such name", "numbers_last", "raw_observations") == [
        "no such name"
    ]
    assert not catalog.table_exists(spark, "numbers_last")
    assert not catalog.table_exists(spark, "raw_observations")


# ---- serving ------------------------------------------------------------------------


def a_pair(spark, n=12):
    kpis = spark.createDataFrame([("m", "mae", 1.0, True, "t")], "model string, kpi_name string, "
                                 "kpi_value double, is_serving boolean, trained_at string")
    base = silver(spark, [("North", f"u{i:02d}", "2026-03-02T12:00", i) for i in range(n)])
    rows = base.withColumns({"model": F.lit("m"), "yhat": F.col("wait_time"),
                             "lo": F.col("wait_time") - 1, "hi": F.col("wait_time") + 1})
    forecast = go.forecast_rows(rows, "m", SETTINGS)
    both = go.gold_union(forecast, go.backtest_rows(rows))
    stamps = ("r1", "fresh_model", NOW, "t")
    return go.stamp(kpis, *stamps), go.stamp(both, *stamps)


def test_schemas_of_the_pair(spark):
    kpis, predictions = a_pair(spark)
    assert [(f.name, f.dataType) for f in kpis.schema] == [(f.name, f.dataType) for f in KPIS]
    assert [(f.name, f.dataType) for f in predictions.schema] == [
        (f.name, f.dataType) for f in PREDICTIONS
    ]


def test_records(spark):
    rows = spark.createDataFrame(
        [(1, float("nan"), at("2026-03-02T12:00"), None), (2, float("inf"), None, "x"),
         (3, 0.12345678901234, None, None)],
        "k long, v double, t timestamp_ntz, s string",
    )
    found = [json.loads(r["record"]) for r in sv.to_records(rows).orderBy("k").collect()]
    assert found[0] == {"k": 1, "v": None, "t": "2026-03-02T12:00:00.000", "s": None}
    assert found[1]["v"] is None
    assert found[2]["v"] == 0.123456789


def test_delivery_sends_whole_chunks(spark, scratch):
    out = scratch("delivered")
    os.makedirs(out)

    def send(chunk_id, records):
        with open(f"{out}/{chunk_id}.json", "w") as f:
            json.dump(records, f)

    kpis, predictions = a_pair(spark, 12)
    twice = predictions.unionByName(predictions)
    key = ["row_kind", "park_name", "ride_key", "ts_local"]
    sv.deliver(twice, key, replace(SETTINGS, chunk_rows=10), send)
    sizes = {n: len(json.load(open(f"{out}/{n}"))) for n in os.listdir(out)}
    assert sizes == {"0.json": 10, "1.json": 10, "2.json": 4}


def test_each_chunk_is_delivered_once(spark, scratch):
    """One chunk fails at first, beside others of its task; a second delivery sends what changed."""
    out = scratch("delivered")
    os.makedirs(out)

    def send(chunk_id, records):
        tried = f"{out}/tried-{chunk_id}-{len(os.listdir(out))}"
        open(tried, "w").close()
        if chunk_id in (1, 4) and not any(f.startswith(f"failed-{chunk_id}") for f in os.listdir(out)):
            open(f"{out}/failed-{chunk_id}", "w").close()
            raise ConnectionError("gone")
        with open(f"{out}/got-{chunk_id}-{len(records)}-{len(os.listdir(out))}", "w") as f:
            json.dump(records, f)

    def got():
        return sorted(f.split("-")[1] for f in os.listdir(out) if f.startswith("got-"))

    rows = spark.range(47).select(F.col("id"), (F.col("id") % 7).alias("v")).coalesce(1)
    small, ledger = replace(SETTINGS, chunk_rows=10), sv.Ledger(spark, scratch("ledger"))
    assert sv.deliver(rows, ["id"], small, send, ledger) == {"sent": 5, "skipped": 0}
    assert got() == list("01234")
    assert sv.deliver(rows, ["id"], small, send, ledger) == {"sent": 0, "skipped": 5}
    changed = rows.withColumn("v", F.when(F.col("id") == 25, 99).otherwise(F.col("v")))
    assert sv.deliver(changed, ["id"], small, send, ledger) == {"sent": 1, "skipped": 4}
    assert got() == list("012234") and ledger.read().count() == 6
    with pytest.raises(sv.RepeatedKeyError):
        sv.deliver(rows.unionByName(changed), ["id"], small, send, ledger)


def test_rows_are_cut_where_they_were_sorted(spark):
    """Copies of any kind become one, other values are refused, and numbering moves no row."""
    nan, schema = float("nan"), "k bigint, j string, x double, s string"
    rows = [(n, None, n / 7, None) for n in range(40)]
    odd = [(None, "a", nan, "s"), (None, None, None, None), (50, "b", 0.0, ""), (50, None, nan, None)]
    again = [*rows[::3], *odd, (50, "b", -0.0, ""), *odd]
    frame = spark.createDataFrame(rows + odd + again, schema).repartition(7)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        by_number = sv.with_chunks(frame, ["x", "k", "j", "s"], SETTINGS).orderBy("row_index")
        assert [r["k"] for r in by_number.collect()] == [None, 0, 50, *range(1, 40), None, 50]
        cut = sv.with_chunks(frame, ["k", "j"], replace(SETTINGS, chunk_rows=10))
        text = cut._jdf.queryExecution().executedPlan().toString()
        got = sorted(cut.collect(), key=lambda r: r["row_index"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert "hashpartitioning(_part" not in text and "SortMergeJoin" not in text
    assert [r["row_index"] for r in got] == list(range(44))
    assert [r["chunk_id"] for r in got] == [n // 10 for n in range(44)]
    keys = [(r["k"], r["j"]) for r in got]
    assert keys[:2] == [(None, None), (None, "a")] and keys[2:42] == [(n, None) for n in range(40)]
    assert keys[42:] == [(50, None), (50, "b")]
    for other in ((7, None, None, None), (None, None, 1.0, None), (50, None, nan, "t")):
        spoiled = frame.unionByName(spark.createDataFrame([other], schema))
        with pytest.raises(sv.RepeatedKeyError):
            sv.with_chunks(spoiled, ["k", "j"], SETTINGS)


def test_chunks_that_never_arrive_are_named(spark, scratch):
    def send(chunk_id, records):
        if chunk_id == 2:
            raise TimeoutError("no answer")

    ledger = sv.Ledger(spark, scratch("ledger"))
    with pytest.raises(sv.DeliveryError, match="1 of 4 chunks .* chunk 2: TimeoutError: no answer"):
        sv.deliver(spark.range(35), ["id"], replace(SETTINGS, chunk_rows=10), send, ledger, 2)
    assert sorted(r["chunk_id"] for r in ledger.read().collect()) == [0, 1, 3]


def test_the_publish_job_refuses_what_a_guard_finds(spark, scratch):
    kpis, predictions = a_pair(spark)
    early, late = clock.naive(datetime(2000, 1, 1)), clock.naive(datetime(2100, 1, 1))

    def served(left, right):
        store = TableStore(spark, scratch("source"))
        store.write("kpis", left, "r")
        store.write("predictions", right, "r")
        store.promote("kpis", "predictions")
        return store

    target = TableStore(spark, scratch("target"))
    done = run_publish(served(kpis, predictions), target, early)
    assert (done["published_kpis"], done["published_rows"]) == (1, 24)
    spoiled = [
        (kpis, predictions, late),
        (kpis.where("false"), predictions, early),
        (kpis, predictions.where("row_kind <> 'forecast'"), early),
        (kpis.withColumn("run_id", F.lit("other")), predictions, early),
        (kpis, predictions.unionByName(predictions.limit(1)), early),
    ]
    for left, right, now in spoiled:
        with pytest.raises(QualityCheckError):
            run_publish(served(left, right), target, now)
    assert [t.count() for t in sv.fetch_pair(target)] == [1, 24]
    differing = predictions.unionByName(
        predictions.limit(1).withColumn("predicted_wait_min", F.lit(99.0)))
    with pytest.raises(sv.RepeatedKeyError):
        sv.publish_pair(target, kpis, differing, "r3")


def test_a_load_that_breaks_is_tried_again(spark, scratch, monkeypatch):
    source, target = TableStore(spark, scratch("a")), TableStore(spark, scratch("b"))
    sv.publish_pair(source, *a_pair(spark), "r1")
    load, calls = sv.publish_pair, []

    def breaks(*args):
        calls.append(args)
        if len(calls) < 3:
            target.write("kpis", args[1], "half")
            raise ConnectionError("reset")
        return load(*args)

    monkeypatch.setattr(sv, "publish_pair", breaks)
    early = clock.naive(datetime(2000, 1, 1))
    done = run_publish(source, target, early, pause_s=0)
    assert len(calls) == 3 and done["published_rows"] == sv.fetch_pair(target)[1].count()
    assert target.candidates() == {}
    calls.clear()
    with pytest.raises(ConnectionError):
        run_publish(source, TableStore(spark, scratch("c")), early, attempts=2, pause_s=0)
    assert len(calls) == 2


def test_the_report_is_of_one_checked_pair(spark, scratch):
    store, out = TableStore(spark, scratch("a")), scratch("report")
    sv.publish_pair(store, *a_pair(spark), "r1")
    with pytest.raises(QualityCheckError):
        run_report(store, SETTINGS, clock.naive(datetime(2100, 1, 1)), out)
    assert not os.path.exists(out)
    rows = run_report(store, SETTINGS, clock.naive(datetime(2000, 1, 1)), out)
    counts = {r["section"]: r["rows"] for r in rows.collect()}
    assert set(counts) == set(os.listdir(out)) and counts["tiles"] == 7 and counts["provenance"] == 1
    assert spark.read.parquet(f"{out}/provenance").first()["run_id"] == sv.fetch_pair(store)[0].first()["run_id"]


def test_publishing_swaps_both_or_none(spark, scratch):
    store = TableStore(spark, scratch("serving"))
    kpis, predictions = a_pair(spark)
    counts = sv.publish_pair(store, kpis, predictions, "r1").first()
    assert (counts["kpis"], counts["predictions"]) == (1, 24)
    with pytest.raises(sv.EmptyStagingError):
        sv.publish_pair(store, kpis.where("false"), predictions.limit(1), "r2")
    left, right = sv.fetch_pair(store)
    assert (left.count(), right.count()) == (1, 24)
    found = sv.serve(right, {"row_kind": "forecast", "park_name": "North"}, ["ride_key"], 3)
    assert [r["ride_key"] for r in found.collect()] == ["u00", "u01", "u02"]
    plan = sv.serve(right, {"row_kind": "forecast", "park_name": "North"})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(row_kind" in text and "EqualTo(park_name,North)" in text


def test_pair_round_trip(spark, scratch):
    folder, (kpis, predictions) = scratch("pair"), a_pair(spark)
    sv.save_pair(kpis, predictions, folder)
    left, right = sv.load_pair(spark, folder)
    assert left.exceptAll(kpis).isEmpty() and right.exceptAll(predictions).isEmpty()


# ---- streams ------------------------------------------------------------------------


def land(spark, scratch, rows, files=3):
    root = scratch("landing")
    frame = bronze(spark, rows).select(*LANDING_COLUMNS)
    frame.repartitionByRange(files, "ts_utc").write.parquet(f"{root}/dt=2026-03-01")
    return root


ROWS = [(i, i % 90, f"2026-03-02T{i % 24:02d}:{i % 60:02d}", f"n{i % 3}", "North")
        for i in range(200)]


def test_replayed_stream_adds_nothing(spark, scratch):
    root, target = land(spark, scratch, ROWS), scratch("bronze")
    for _ in range(2):
        query = ls.drain_to_bronze(spark, root, target, scratch("cp"), NOW, max_files=1)
        query.awaitTermination()
    rows = spark.read.schema(BRONZE).parquet(target)
    assert rows.count() == 200 and rows.select("wait_time_id").distinct().count() == 200


def test_stream_resumes_from_its_checkpoint(spark, scratch):
    root, target, checkpoint = land(spark, scratch, ROWS), scratch("bronze"), scratch("cp")
    ls.drain_to_bronze(spark, root, target, checkpoint, NOW).awaitTermination()
    more = [(1000, 5, NOON, "a", "North")]
    bronze(spark, more).select(*LANDING_COLUMNS).write.parquet(f"{root}/dt=2026-03-02")
    query = ls.drain_to_bronze(spark, root, target, checkpoint, NOW)
    query.awaitTermination()
    # Only the new file is read (its ids first, then its rows).
    assert sum(p["numInputRows"] for p in query.recentProgress) <= 2
    assert spark.read.schema(BRONZE).parquet(target).count() == 201


def test_drained_slot_means_equal_batch(spark, scratch):
    root, out = land(spark, scratch, ROWS), scratch("out")
    means = ss.slot_means(ls.read_landing(spark, root, 1), SETTINGS, "10 days")
    ss.drain_slot_means(means, out, scratch("cp")).awaitTermination()
    found = ss.latest_slot_means(spark, out)
    rows = spark.read.schema(LANDING).parquet(root).select(*LANDING_COLUMNS)
    batch = ss.slot_means(rows, SETTINGS, "10 days")
    assert found.count() == batch.count()
    assert found.select(*batch.columns).exceptAll(batch).isEmpty()


def test_closed_windows_are_a_part_of_batch(spark, scratch):
    root, out = land(spark, scratch, ROWS), scratch("out")
    means = ss.slot_means(ls.read_landing(spark, root), SETTINGS, "1 hour")
    query = (means.writeStream.outputMode("append").format("parquet").option("path", out)
             .option("checkpointLocation", scratch("cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    rows = spark.read.schema(LANDING).parquet(root).select(*LANDING_COLUMNS)
    batch = ss.slot_means(rows, SETTINGS, "1 hour")
    closed = spark.read.parquet(out)
    assert 0 < closed.count() < batch.count()
    assert closed.select(*batch.columns).exceptAll(batch).isEmpty()


def test_freshness_per_batch(spark, scratch):
    root, out = land(spark, scratch, ROWS), scratch("out")
    query = ls.freshness_stream(ls.read_landing(spark, root, 1), out, scratch("cp"),
                                SETTINGS.time_zone, at("2026-03-02T15:59"))
    query.awaitTermination()
    ages = [r["age_hours"] for r in spark.read.parquet(out).collect()]
    assert len(ages) == 3 and min(ages) == 0.0


def in_order(spark, scratch, rows, files):
    """Landed files of rows that follow each other in time."""
    root = scratch("landing")
    for k in range(files):
        part = rows[k * len(rows) // files : (k + 1) * len(rows) // files]
        bronze(spark, part).select(*LANDING_COLUMNS).coalesce(1).write.parquet(f"{root}/dt=2026-03-{k + 1:02d}")
    return root


def days_of_rows(days):
    return [(d * 100 + k, k, f"2026-03-{d + 1:02d}T{k:02d}:10", f"u{k % 3}", "North")
            for d in range(days) for k in range(24)]


def test_closed_slots_are_written_once_and_forgotten(spark, scratch):
    root, out = in_order(spark, scratch, days_of_rows(12), 12), scratch("out")
    means = ss.slot_means(ls.read_landing(spark, root, 1), SETTINGS, "1 day")
    query = ss.drain_closed_slots(means, out, scratch("cp"))
    query.awaitTermination()
    closed = spark.read.parquet(out)
    assert closed.count() == closed.dropDuplicates(["park_name", "ride_name", "ts_utc"]).count()
    rows = spark.read.schema(LANDING).parquet(root).select(*LANDING_COLUMNS)
    batch = ss.slot_means(rows, SETTINGS, "1 day")
    # A slot is closed when its end is a day before the newest observation, 23:10 of the last day.
    due = batch.where("ts_utc + interval 30 minutes <= timestamp_ntz '2026-03-11 23:10:00'")
    assert closed.count() == due.count() > 200
    assert closed.select(*batch.columns).exceptAll(due).isEmpty()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(held) <= 3 * 24 and held[-1] <= 25


def test_zones_off_the_grid_are_refused(spark):
    for zone in ("America/Los_Angeles", "Asia/Kolkata", "Australia/Adelaide"):
        ss.check_zone(zone, 30)
    for zone, grid in (("Asia/Kathmandu", 30), ("Australia/Eucla", 30), ("Asia/Kolkata", 60)):
        with pytest.raises(ValueError, match="off the"):
            ss.check_zone(zone, grid)


def test_silent_units_are_reported_and_forgotten(spark, scratch):
    """u0 speaks to the end, u1 stops for good, u2 stops and comes back."""
    spoken = {"u0": range(0, 80), "u1": range(0, 20), "u2": [*range(0, 20), *range(60, 80)]}
    rows = sorted(
        (f"2026-03-{1 + h // 24:02d}T{h % 24:02d}:00", u) for u, hours in spoken.items() for h in hours
    )
    rows = [(k, 1, at_, u, "North") for k, (at_, u) in enumerate(rows)]
    root, out = in_order(spark, scratch, rows, 10), scratch("out")
    changes = quiet.silence(ls.read_landing(spark, root, 1), 600, "1 hour")
    query = quiet.drain_silence(changes, out, scratch("cp"))
    query.awaitTermination()
    found = {r["ride_name"]: (r["newest_utc"], r["silent"])
             for r in quiet.unit_freshness(spark, out).collect()}
    assert found == {
        "u0": (at("2026-03-04T07:00"), False),
        "u1": (at("2026-03-01T19:00"), True),
        "u2": (at("2026-03-04T07:00"), False),
    }
    silent = {(r["ride_name"], r["newest_micros"]) for r in spark.read.parquet(out).where("silent").collect()}
    stopped = 1772391600_000000
    assert silent == {("u1", stopped), ("u2", stopped)}
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 2
