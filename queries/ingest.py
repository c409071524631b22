"""Incremental ingest on an upstream of orders (facts), customers (units), nations (sites).

The target holds the older part of the upstream, up to 3/4 of the id range; a transfer
that was interrupted is read again from half of the range on, so batch and target overlap.
Together they cover the whole tables.
"""

from dataclasses import replace

from pyspark.sql import functions as F

from queries import fixtures as fx
from queries.registry import query, table, with_ctes
from slotcast.operators import ingest as ing
from slotcast.plans.ingest_run import run_ingest
from slotcast.schemas import BRONZE, LANDING_COLUMNS
from slotcast.sources import upstream as up
from slotcast.sources.bronze import Bronze
from slotcast.sources.landing import land_batch, read_batch
from slotcast.session import scratch_path


def _tables(spark, sf):
    fact = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("wait_time_id"),
        F.floor("o_totalprice").alias("wait_time"),
        F.col("o_orderdate").alias("wait_time_upd_dt"),
        F.col("o_custkey").alias("at_id"),
    )
    units = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("at_id"),
        F.col("c_name").alias("at_name"),
        F.col("c_nationkey").alias("tp_id"),
    )
    sites = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("tp_id"), F.col("n_name").alias("tp_name")
    )
    return fact, units, sites


def _mark(fact, share):
    """Id at a share of the id range, as a scalar subquery."""
    top = F.max("wait_time_id")
    return fact.agg(F.floor(top * F.lit(share)).cast("bigint")).scalar()


def _rows(spark, sf, share):
    fact, units, sites = _tables(spark, sf)
    return up.read_since(fact, units, sites, _mark(fact, share))


def _target(spark, sf):
    fact, units, sites = _tables(spark, sf)
    old = up.observations(fact.where(F.col("wait_time_id") <= _mark(fact, 0.75)), units, sites)
    return ing.stamp_ingested(old, fx.INGESTED)


def _batch(spark, sf):
    return ing.stamp_ingested(_rows(spark, sf, 0.5), fx.INGESTED)


UP = """up AS (SELECT o_orderkey AS wait_time_id, CAST(floor(o_totalprice) AS BIGINT) AS wait_time,
    o_orderdate AS ts_utc, c_custkey AS at_id, c_name AS ride_name,
    CAST(n_nationkey AS BIGINT) AS tp_id, n_name AS park_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
MARKS = """marks AS (SELECT CAST(floor(max(o_orderkey) * 0.5) AS BIGINT) AS half,
    CAST(floor(max(o_orderkey) * 0.75) AS BIGINT) AS most FROM orders)"""
CTES = [
    UP, MARKS,
    "target AS (SELECT up.* FROM up, marks WHERE wait_time_id <= most)",
    "batch AS (SELECT up.* FROM up, marks WHERE wait_time_id > half)",
    "fresh AS (SELECT * FROM batch WHERE wait_time_id NOT IN (SELECT wait_time_id FROM target))",
]


@query("ingest_upstream_join", with_ctes([UP], "SELECT * FROM up"))
def upstream_join(spark, sf):
    return up.observations(*_tables(spark, sf))


@query("ingest_skewed_join", with_ctes(
    [UP.replace("FROM orders JOIN", "FROM hot_orders JOIN").replace("up AS", "hot_up AS")],
    "SELECT * FROM hot_up").replace("WITH ", """WITH hot_orders AS (SELECT * REPLACE (
      CASE WHEN o_orderkey % 3 = 0 THEN (SELECT min(c_custkey) FROM customer) ELSE o_custkey END
      AS o_custkey) FROM orders), """, 1))
def skewed_join(spark, sf):
    """A third of all facts on one unit, and no dimension broadcast."""
    fact, units, sites = _tables(spark, sf)
    first = units.agg(F.min("at_id")).scalar()
    hot = F.when(F.col("wait_time_id") % 3 == 0, first).otherwise(F.col("at_id"))
    return up.observations(fact.withColumn("at_id", hot), units, sites, spread=True)


@query("ingest_orphans_drop", with_ctes([UP], """SELECT count(*) AS facts,
    (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey
     WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)) AS kept
    FROM orders"""))
def orphans_drop(spark, sf):
    """Sites of some regions are gone upstream: their observations drop out of the join."""
    fact, units, _ = _tables(spark, sf)
    sites = table(spark, sf, "nation").where(F.col("n_regionkey") < 3).select(
        F.col("n_nationkey").alias("tp_id"), F.col("n_name").alias("tp_name")
    )
    kept = up.observations(fact, units, sites).agg(F.count(F.lit(1))).scalar()
    return fact.agg(F.count(F.lit(1)).alias("facts")).withColumn("kept", kept)


@query("ingest_upstream_max", with_ctes([UP], """SELECT
    (SELECT coalesce(max(o_orderkey), 0) FROM orders) AS upstream_max,
    (SELECT coalesce(max(o_orderkey), 0) FROM orders WHERE o_orderkey < 0) AS empty_max"""))
def upstream_max(spark, sf):
    fact = _tables(spark, sf)[0]
    empty = ing.high_water(fact.where(F.col("wait_time_id") < 0)).scalar()
    return ing.high_water(fact, "upstream_max").withColumn("empty_max", empty)


@query("ingest_high_water_mark", with_ctes(
    CTES, "SELECT coalesce(max(wait_time_id), 0) AS mark FROM target"))
def high_water_mark(spark, sf):
    return ing.high_water(_target(spark, sf))


@query("ingest_read_since", with_ctes(CTES, "SELECT * FROM batch"))
def read_since(spark, sf):
    return _rows(spark, sf, 0.5)


@query("ingest_capped_batch", with_ctes(
    CTES, "SELECT * FROM batch ORDER BY wait_time_id LIMIT 200000"))
def capped_batch(spark, sf):
    fact, units, sites = _tables(spark, sf)
    return up.read_since(fact, units, sites, _mark(fact, 0.5), fx.SETTINGS.batch_rows)


@query("ingest_coercing_casts", """SELECT event_id AS wait_time_id,
    CASE event_type WHEN 'error' THEN NULL ELSE floor(value) END AS wait_time,
    ts AS ts_utc FROM events""")
def coercing_casts(spark, sf):
    """Waits and times as text; the waits of one site are unreadable."""
    wait = F.floor("value").cast("string")
    rows = fx.landing(spark, sf).join(
        table(spark, sf, "events").select(F.col("event_id").alias("wait_time_id"), "value"),
        "wait_time_id",
    )
    text = F.when(F.col("park_name") == "error", F.lit("closed")).otherwise(wait)
    raw = rows.withColumns({"wait_time": text, "ts_utc": F.col("ts_utc").cast("string")})
    typed = up.coerce_landing(raw).select("wait_time_id", "wait_time", "ts_utc")
    return typed.withColumn("wait_time", F.col("wait_time").cast("double"))


@query("ingest_stamp", with_ctes(
    CTES, f"SELECT *, {fx.ts(fx.INGESTED)} AS _ingested_at FROM batch"))
def stamp(spark, sf):
    rows = _batch(spark, sf)
    return rows.withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp_ntz"))


@query("ingest_insert_only_rows", with_ctes(CTES, "SELECT * FROM fresh"))
def insert_only_rows(spark, sf):
    return ing.new_rows(_batch(spark, sf), _target(spark, sf)).select(*LANDING_COLUMNS)


@query("ingest_merge", with_ctes(
    CTES, "SELECT * FROM target UNION ALL SELECT * FROM fresh"))
def merge(spark, sf):
    return ing.merge(_batch(spark, sf), _target(spark, sf)).select(*LANDING_COLUMNS)


@query("ingest_merge_batch_duplicates", with_ctes(
    CTES, """SELECT wait_time_id, count(*) AS copies
    FROM (SELECT * FROM target UNION ALL SELECT * FROM fresh UNION ALL SELECT * FROM fresh)
    GROUP BY wait_time_id"""))
def merge_batch_duplicates(spark, sf):
    """Equal ids inside one batch are all inserted; none is when the target holds the id."""
    batch = _batch(spark, sf)
    merged = ing.merge(batch.unionByName(batch), _target(spark, sf))
    return merged.groupBy("wait_time_id").agg(F.count(F.lit(1)).alias("copies"))


@query("ingest_batch_range", with_ctes(
    CTES, """SELECT min(wait_time_id) AS low, max(wait_time_id) AS high, count(*) AS rows
    FROM batch"""))
def batch_range(spark, sf):
    return ing.batch_range(_batch(spark, sf))


@query("ingest_gap_report", with_ctes(CTES, """SELECT mark, upstream_max,
    greatest(0, upstream_max - mark) AS gap
    FROM (SELECT (SELECT max(wait_time_id) FROM target) AS mark,
                 (SELECT max(o_orderkey) FROM orders) AS upstream_max)"""))
def gap_report(spark, sf):
    return ing.gap_report(_tables(spark, sf)[0], _target(spark, sf))


@query("ingest_summary", with_ctes(CTES, """SELECT count(*) AS rows, max(wait_time_id) AS max_id
    FROM (SELECT * FROM target UNION ALL SELECT * FROM fresh)"""))
def summary(spark, sf):
    return ing.ingest_summary(ing.merge(_batch(spark, sf), _target(spark, sf)))


@query("ingest_landed_file", with_ctes(CTES, "SELECT * FROM batch"))
def landed_file(spark, sf):
    """A batch written to the landing area and read back by its exact path."""
    batch = _batch(spark, sf)
    path = land_batch(batch, scratch_path(spark, "landing"), 0, fx.NOW_UTC)
    return read_batch(spark, path)


@query("ingest_replay", with_ctes(CTES, "SELECT * FROM up"))
def replay(spark, sf):
    """The same batch merged twice leaves bronze as merged once."""
    batch = _batch(spark, sf)
    once = ing.merge(batch, _target(spark, sf))
    return ing.merge(batch, once).select(*LANDING_COLUMNS)




@query("ingest_capped_batch_small", with_ctes(
    CTES, "SELECT * FROM batch ORDER BY wait_time_id LIMIT 1000"))
def capped_batch_small(spark, sf):
    """A transfer of 1,000 rows from the backlog; the cap is what is shown."""
    fact, units, sites = _tables(spark, sf)
    return up.read_since(fact, units, sites, _mark(fact, 0.5), 1000)


MOVED = with_ctes([UP], "SELECT * REPLACE (wait_time_id + 1 AS wait_time_id) FROM up")


def _drained(spark, sf, shares):
    """Bronze after one drain for each share of the id range that the upstream held at the time.

    The mark of an empty bronze is 0 and the predicate is strict, so the ids are moved by one.
    """
    bronze, landing = scratch_path(spark, "bronze"), scratch_path(spark, "landing")
    fact, units, sites = _tables(spark, sf)
    top = fact.agg(F.max("wait_time_id")).first()[0] or 0
    settings = replace(fx.SETTINGS, batch_rows=1 + top // 3, bronze_range_ids=1 + top // 5)
    moved = fact.withColumn("wait_time_id", F.col("wait_time_id") + 1)
    for share in shares:
        known = moved.where(F.col("wait_time_id") <= int(top * share) + 1)
        run_ingest(spark, (known, units, sites), bronze, landing, settings, fx.NOW_UTC, drain=True)
    return spark.read.schema(BRONZE).parquet(bronze).select(*LANDING_COLUMNS)


@query("ingest_drain", MOVED)
def drain(spark, sf):
    """The whole upstream through the stream of ids, as one batch."""
    return _drained(spark, sf, [1])


@query("ingest_drain_resumed", MOVED)
def drain_resumed(spark, sf):
    """Three drains of a growing upstream; each goes on where the checkpoint of the last one ends."""
    return _drained(spark, sf, [0.4, 0.41, 1])


@query("io_bronze_ranges", with_ctes(CTES, """SELECT batch.* FROM batch, marks
    WHERE wait_time_id <= most"""))
def bronze_ranges(spark, sf):
    """Two overlapping transfers merged into folders of ids; the read names the folders it needs."""
    low, high = _tables(spark, sf)[0].agg(
        F.floor(F.max("wait_time_id") * 0.5) + 1, F.floor(F.max("wait_time_id") * 0.75)
    ).first()
    bronze = Bronze(spark, scratch_path(spark, "bronze"), 1 + high // 7)
    bronze.ensure()
    for rows in (_target(spark, sf), _batch(spark, sf)):
        path = land_batch(rows, scratch_path(spark, "landing"), 0, fx.NOW_UTC)
        landed = ing.stamp_ingested(read_batch(spark, path), fx.INGESTED)
        span = ing.batch_range(landed).first()
        if span["rows"]:
            bronze.merge(landed, span["low"], span["high"])
    return bronze.between(low, high).select(*LANDING_COLUMNS)
