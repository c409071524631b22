"""Table versions, the published pair, records, chunks and the serving query."""

import uuid

from pyspark.sql import functions as F

from queries import fixtures as fx
from queries.gold import PAIR, RUN_ID, VALUES, pair
from queries.registry import query, rounded, table, with_ctes
from slotcast.plans.publish import run_publish
from slotcast.schemas import PREDICTION_KEY, SILVER
from slotcast.session import scratch_path
from slotcast.sources import catalog
from slotcast.sources import serving as sv
from slotcast.sources.store import TableStore

S = fx.SETTINGS
PAIR_SELECT = f"""SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in VALUES)})
    FROM predictions"""


def _store(spark):
    return TableStore(spark, scratch_path(spark, "store"))


@query("io_read_table", "SELECT * FROM lineitem")
def read_table(spark, sf):
    return table(spark, sf, "lineitem")


@query("io_table_count", """SELECT (SELECT count(*) FROM lineitem) AS lineitem,
    (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM events) AS events""")
def table_count(spark, sf):
    def rows(name):
        return table(spark, sf, name).agg(F.count(F.lit(1)).alias(name))

    return rows("lineitem").select(
        "lineitem", rows("orders").scalar().alias("orders"), rows("events").scalar().alias("events")
    )


@query("io_write_and_promote", with_ctes(fx.SILVER, """SELECT park_name, ride_key, ride_name,
    ts_local, ts_utc, round(wait_time, 6) AS wait_time FROM silver"""))
def write_and_promote(spark, sf):
    """A version is written, replaced by a second one, promoted, and read by its name."""
    store, silver = _store(spark), fx.silver(spark, sf)
    store.write("silver", silver.where(F.col("wait_time") < 0), "a")
    store.write("silver", silver, "b")
    store.promote("silver")
    store.write("silver", silver.where(F.col("wait_time") < 0), "c")
    store.discard("silver")
    return rounded(store.read("silver", SILVER), "wait_time")


@query("io_publish_pair", with_ctes(PAIR, """SELECT (SELECT count(*) FROM kpi_pair) AS kpis,
    (SELECT count(*) FROM predictions) AS predictions"""))
def publish_pair(spark, sf):
    return sv.publish_pair(_store(spark), *pair(spark, sf), RUN_ID)


@query("io_publish_job", with_ctes(PAIR, """SELECT (SELECT count(*) FROM kpi_pair) AS kpis,
    (SELECT count(*) FROM predictions) AS predictions"""))
def publish_job(spark, sf):
    """The whole job: what one store serves is fetched, checked, saved, loaded and swapped."""
    source, target = _store(spark), _store(spark)
    sv.publish_pair(source, *pair(spark, sf), RUN_ID)
    run_publish(source, target, fx.now_local(), scratch_path(spark, "saved"))
    kpis, predictions = sv.fetch_pair(target)
    return kpis.agg(F.count(F.lit(1)).alias("kpis")).withColumn(
        "predictions", predictions.agg(F.count(F.lit(1))).scalar()
    )


@query("io_fetch_pair", with_ctes(PAIR, PAIR_SELECT))
def fetch_pair(spark, sf):
    store = _store(spark)
    sv.publish_pair(store, *pair(spark, sf), RUN_ID)
    return rounded(sv.fetch_pair(store)[1], *VALUES)


KPI_SELECT = "SELECT * REPLACE (round(kpi_value, 6) AS kpi_value) FROM kpi_pair"


@query("io_fetch_kpis", with_ctes(PAIR, KPI_SELECT))
def fetch_kpis(spark, sf):
    """The other half of the published pair."""
    store = _store(spark)
    sv.publish_pair(store, *pair(spark, sf), RUN_ID)
    return rounded(sv.fetch_pair(store)[0], "kpi_value")


@query("io_kpis_parquet", with_ctes(PAIR, KPI_SELECT))
def kpis_parquet(spark, sf):
    folder = scratch_path(spark, "pair")
    sv.save_pair(*pair(spark, sf), folder)
    return rounded(sv.load_pair(spark, folder)[0], "kpi_value")


@query("io_catalog_tables", """SELECT step, present, rows FROM (SELECT count(*) AS n FROM events),
    (VALUES ('before', FALSE, 0), ('created', TRUE, 0), ('filled', TRUE, 1), ('kept', TRUE, 1),
      ('dropped', FALSE, 0)) v(step, present, part),
    LATERAL (SELECT CASE WHEN present THEN CAST(part * n AS DOUBLE) END AS rows)""")
def catalog_tables(spark, sf):
    """A bronze table by its name: created once, filled, created again without effect, dropped."""
    schema = f"slotcast_{uuid.uuid4().hex[:12]}"
    name, seen = f"{schema}.raw_observations", []

    def look(step):
        present = catalog.table_exists(spark, name)
        seen.append((step, present, float(catalog.table_count(spark, name)) if present else None))

    catalog.ensure_schema(spark, schema)
    look("before")
    catalog.ensure_bronze(spark, name, scratch_path(spark, "catalog"))
    look("created")
    fx.bronze(spark, sf).write.insertInto(name)
    look("filled")
    catalog.ensure_bronze(spark, name)
    look("kept")
    if catalog.drop_tables(spark, name) or catalog.drop_tables(spark, f"{schema}.absent"):
        raise RuntimeError("a table could not be dropped")
    look("dropped")
    spark.sql(f"DROP SCHEMA {schema}")
    return spark.createDataFrame(seen, "step string, present boolean, rows double")


@query("io_pair_parquet", with_ctes(PAIR, PAIR_SELECT))
def pair_parquet(spark, sf):
    folder = scratch_path(spark, "pair")
    sv.save_pair(*pair(spark, sf), folder)
    return rounded(sv.load_pair(spark, folder)[1], *VALUES)


@query("io_json_records", """SELECT o_orderkey,
    CASE WHEN x IS NULL OR NOT isfinite(x) THEN NULL ELSE round(x / 7000000, 10) END AS x,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS at, o_orderstatus AS status,
    CAST(4 AS INTEGER) AS keys
    FROM (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN NULL
      WHEN '2-HIGH' THEN CAST('NaN' AS DOUBLE) WHEN '3-MEDIUM' THEN CAST('Infinity' AS DOUBLE)
      ELSE o_totalprice END AS x FROM orders)""")
def json_records(spark, sf):
    """Records read back: the fields, and that no key is left out for a null."""
    p = F.col("o_orderpriority")
    x = (
        F.when(p == "1-URGENT", F.lit(None))
        .when(p == "2-HIGH", F.lit(float("nan")))
        .when(p == "3-MEDIUM", F.lit(float("inf")))
        .otherwise(F.col("o_totalprice"))
    )
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"),
        (x.cast("double") / 7000000).alias("x"),
        F.col("o_orderdate").alias("at"),
        F.col("o_orderstatus").alias("status"),
    )
    record = F.from_json("record", "k bigint, x double, at string, status string")
    parsed = sv.to_records(rows).select(
        record.alias("r"), F.size(F.json_object_keys("record")).alias("keys")
    )
    return parsed.select(F.col("r.k").alias("o_orderkey"), "r.x", "r.at", "r.status", "keys")


@query("io_chunks", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(floor((row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
      l_shipdate, l_extendedprice) - 1) / 5000) AS BIGINT) AS chunk_id
    FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
          l_extendedprice FROM lineitem)""")
def chunks(spark, sf):
    """Line items in key order, cut into chunks of 5,000."""
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    rows = sv.with_chunks(table(spark, sf, "lineitem").select(*key), key, S)
    return rows.select(*key[:4], "chunk_id")


@query("io_delivery_ledger", """WITH items AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey,
      l_shipdate, l_extendedprice FROM lineitem),
    half AS (SELECT count(*) AS n FROM items WHERE l_orderkey <= (SELECT max(l_orderkey) // 2 FROM lineitem)),
    cut AS (SELECT (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_shipdate,
      l_extendedprice) - 1) // 5000 AS chunk_id FROM items)
    SELECT chunk_id, count(*) AS rows FROM cut GROUP BY chunk_id
    UNION ALL SELECT n // 5000, n % 5000 FROM half WHERE n % 5000 > 0""")
def delivery_ledger(spark, sf):
    """Half of the line items delivered, then all: full chunks that have arrived go out once."""
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice"]
    items = table(spark, sf, "lineitem").select(*key)
    top = items.agg(F.max("l_orderkey")).first()[0] or 0
    ledger = sv.Ledger(spark, scratch_path(spark, "ledger"))
    for rows in (items.where(F.col("l_orderkey") <= top // 2), items):
        sv.deliver(rows, key, S, lambda chunk_id, records: None, ledger)
    return ledger.read().select("chunk_id", "rows")


@query("io_prediction_chunks", with_ctes(PAIR, f"""SELECT chunk_id, count(*) AS rows FROM
    (SELECT CAST(floor((row_number() OVER (ORDER BY {', '.join(PREDICTION_KEY)}) - 1) / 5000)
     AS BIGINT) AS chunk_id FROM predictions) GROUP BY chunk_id"""))
def prediction_chunks(spark, sf):
    rows = sv.with_chunks(pair(spark, sf)[1], PREDICTION_KEY, S)
    return rows.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("rows"))


@query("io_serving_query", with_ctes(PAIR, """SELECT park_name, ride_key, ts_local,
    round(predicted_wait_min, 6) AS predicted_wait_min, round(lower_bound, 6) AS lower_bound,
    round(upper_bound, 6) AS upper_bound FROM predictions
    WHERE row_kind = 'forecast' AND park_name = 'click'
    ORDER BY park_name, ts_local, ride_key, model_name LIMIT 5"""))
def serving_query(spark, sf):
    """The published forecast of one site, first rows of the week."""
    store = _store(spark)
    sv.publish_pair(store, *pair(spark, sf), RUN_ID)
    columns = ["park_name", "ride_key", "ts_local", "predicted_wait_min", "lower_bound",
               "upper_bound"]
    rows = sv.serve(
        sv.fetch_pair(store)[1], {"row_kind": "forecast", "park_name": "click"}, columns, 5
    )
    return rounded(rows, "predicted_wait_min", "lower_bound", "upper_bound")
