"""Scalar functions over whole columns of the driver's tables."""

from pyspark.sql import functions as F

from queries import fixtures as fx
from queries.registry import query, table
from slotcast.functions import clock, numbers, text
from slotcast.operators import report as rp
from slotcast.operators import silver as si

# Wall times all through the year, clock changes included, from the orders.
WALL = "o_orderdate + to_microseconds(CAST(o_totalprice * 1000000 AS BIGINT) % 86400000000)"


def _wall(spark, sf):
    price = F.round(F.col("o_totalprice") * 1000000).cast("bigint") % 86400000000
    moment = clock.from_micros(clock.micros(F.col("o_orderdate")) + price)
    return table(spark, sf, "orders").select("o_orderkey", moment.alias("wall"))


@query("scalar_to_local", f"""SELECT o_orderkey, {WALL} AS wall, {fx.loc(WALL)} AS ts_local
    FROM orders""")
def to_local(spark, sf):
    local = clock.to_local(clock.utc_instant(F.col("wall")), fx.ZONE)
    return _wall(spark, sf).withColumn("ts_local", local)


@query("scalar_to_utc", f"""SELECT o_orderkey, wall, {fx.utc('wall')} AS ts_utc
    FROM (SELECT o_orderkey, {WALL} AS wall FROM orders)""")
def to_utc(spark, sf):
    return _wall(spark, sf).withColumn("ts_utc", clock.to_utc(F.col("wall"), fx.ZONE))


@query("scalar_utc_from_text", """SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderstatus = 'O'
         THEN o_orderdate + INTERVAL 7 HOUR ELSE o_orderdate END AS instant FROM orders""")
def utc_from_text(spark, sf):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    value = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("not "), iso))
        .when(F.col("o_orderstatus") == "O", F.concat(iso, F.lit("-07:00")))
        .otherwise(iso)
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", clock.utc_instant(value).alias("instant")
    )


@query("scalar_now_local", f"""SELECT {fx.loc('newest')} AS newest_local,
    timezone('{fx.ZONE}', now()) > {fx.loc('newest')} AS is_past
    FROM (SELECT max(ts) AS newest FROM events)""")
def now_local(spark, sf):
    """Local clock of the session beside the newest observation."""
    rows = fx.landing(spark, sf).agg(F.max("ts_utc").alias("newest_utc"))
    now = clock.to_local(clock.as_naive(F.current_timestamp()), fx.ZONE)
    newest = clock.to_local(F.col("newest_utc"), fx.ZONE)
    return rows.select(newest.alias("newest_local"), (now > newest).alias("is_past"))


@query("scalar_data_age", f"""SELECT round(date_diff('microsecond', max({fx.loc('ts')}),
    {fx.ts(fx.NOW_LOCAL)}) / 3.6e9, 6) AS age_hours FROM events""")
def data_age(spark, sf):
    rows = si.localize(fx.landing(spark, sf), fx.SETTINGS)
    return si.data_age_hours(rows, fx.now_local()).select(
        F.round("age_hours", 6).alias("age_hours")
    )


@query("scalar_run_id", "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS run_id FROM events")
def run_id(spark, sf):
    return table(spark, sf, "events").select("event_id", clock.run_id(F.col("ts")).alias("run_id"))


@query("scalar_canonical_key", f"SELECT doc_id, {fx.key('text')} AS doc_key FROM documents")
def canonical_key(spark, sf):
    key = text.canonical_key(F.col("text")).alias("doc_key")
    return table(spark, sf, "documents").select("doc_id", key)


@query("scalar_strip", f"""SELECT doc_id,
    {fx.strip("chr(160) || chr(9) || text || chr(8195) || chr(10)")} AS stripped FROM documents""")
def strip(spark, sf):
    padded = F.concat(F.lit("\u00a0\t"), F.col("text"), F.lit("\u2003\n"))
    return table(spark, sf, "documents").select("doc_id", text.strip(padded).alias("stripped"))


@query("scalar_entity", f"""SELECT c_custkey, e AS entity, replace(e, '::', '__') || '.json' AS file
    FROM (SELECT c_custkey, {fx.entity('c_mktsegment', fx.key('c_name'))} AS e FROM customer)""")
def entity(spark, sf):
    e = text.entity(F.col("c_mktsegment"), text.canonical_key(F.col("c_name")))
    return table(spark, sf, "customer").select(
        "c_custkey", e.alias("entity"), text.entity_filename(e).alias("file")
    )


@query("scalar_as_naive", "SELECT event_id, ts AS ts_naive FROM events")
def as_naive(spark, sf):
    instant = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select("event_id", clock.as_naive(instant).alias("ts_naive"))


MISSING = """CASE o_orderpriority WHEN '1-URGENT' THEN NULL
    WHEN '2-HIGH' THEN CAST('NaN' AS DOUBLE) WHEN '3-MEDIUM' THEN CAST('-Infinity' AS DOUBLE)
    ELSE o_totalprice END"""


def _with_missing(spark, sf):
    priority = F.col("o_orderpriority")
    value = (
        F.when(priority == "1-URGENT", F.lit(None))
        .when(priority == "2-HIGH", F.lit(float("nan")))
        .when(priority == "3-MEDIUM", F.lit(float("-inf")))
        .otherwise(F.col("o_totalprice"))
    )
    return table(spark, sf, "orders").select("o_orderkey", value.cast("double").alias("x"))


@query("scalar_number_format", f"""SELECT o_orderkey,
    CASE WHEN x IS NULL OR NOT isfinite(x) THEN 'n/a' ELSE format('{{:,.1f}}', x) END AS one_digit,
    CASE WHEN x IS NULL OR NOT isfinite(x) THEN 'n/a' ELSE format('{{:,.0f}}', x) END AS no_digit,
    coalesce(isfinite(x), false) AS finite
    FROM (SELECT o_orderkey, {MISSING} AS x FROM orders)""")
def number_format(spark, sf):
    x = F.col("x")
    return _with_missing(spark, sf).select(
        "o_orderkey",
        numbers.fmt(x).alias("one_digit"),
        numbers.fmt(x, 0).alias("no_digit"),
        numbers.is_finite(x).alias("finite"),
    )


@query("scalar_date_labels", """SELECT event_id, strftime(ts, '%b %d') AS day_label,
    lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':00' AS hour_label,
    strftime(ts, '%Y-%m-%d %H:%M') AS minute_label,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS iso_label FROM events""")
def date_labels(spark, sf):
    ts = F.col("ts")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return table(spark, sf, "events").select(
        "event_id",
        clock.day_label(ts).alias("day_label"),
        clock.hour_label(F.hour(ts)).alias("hour_label"),
        clock.minute_label(ts).alias("minute_label"),
        clock.iso_text_label(iso).alias("iso_label"),
    )


@query("scalar_value_map", """SELECT event_id, coalesce(label, s) AS label,
    coalesce(class, 'neutral') AS class
    FROM (SELECT event_id, CASE event_type WHEN 'click' THEN 'fresh_model'
      WHEN 'view' THEN 'kept_previous_model' WHEN 'purchase' THEN 'fallback_after_failure'
      WHEN 'signup' THEN 'stale_input' ELSE event_type END AS s FROM events)
    LEFT JOIN (VALUES ('fresh_model', 'Fresh model', 'good'),
      ('kept_previous_model', 'Kept previous model', 'neutral'),
      ('fallback_after_failure', 'Fallback after a failed run', 'serious'),
      ('stale_input', 'Stale input - forecast only', 'serious')) m(status, label, class)
      ON s = status""")
def value_map(spark, sf):
    kind = F.col("event_type")
    status = (
        F.when(kind == "click", "fresh_model").when(kind == "view", "kept_previous_model")
        .when(kind == "purchase", "fallback_after_failure").when(kind == "signup", "stale_input")
        .otherwise(kind)
    )
    mapped = numbers.value_label(status, rp.STATUS_LABELS, "neutral")
    return table(spark, sf, "events").select("event_id", mapped.alias("m")).select(
        "event_id", "m.label", "m.class"
    )


@query("scalar_shorten", """SELECT doc_id, CASE WHEN length(text) > 28
    THEN left(text, 27) || '…' ELSE text END AS label FROM documents""")
def shorten(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.shorten(F.col("text")).alias("label"))


@query("scalar_arithmetic", f"""SELECT o_orderkey,
    CASE WHEN x IS NULL OR NOT isfinite(x) THEN NULL
         ELSE greatest(0.0, x - 200000) END AS clipped,
    CASE WHEN x IS NULL OR NOT isfinite(x) THEN NULL
         ELSE abs(x - 200000) END AS size,
    CASE WHEN x IS NULL OR NOT isfinite(x) THEN NULL
         ELSE round(sqrt(abs(x - 200000)), 6) END AS root
    FROM (SELECT o_orderkey, {MISSING} AS x FROM orders)""")
def arithmetic(spark, sf):
    shifted = numbers.finite_or_null(F.col("x")) - 200000
    return _with_missing(spark, sf).select(
        "o_orderkey",
        numbers.clip_low(shifted).alias("clipped"),
        F.abs(shifted).alias("size"),
        F.round(F.sqrt(F.abs(shifted)), 6).alias("root"),
    )
