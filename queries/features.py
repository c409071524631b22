"""Calendar features, the chronological split and the high-wait segment."""

from pyspark.sql import functions as F

from queries import fixtures as fx
from queries.registry import query, rounded, table, with_ctes
from slotcast.functions import holidays
from slotcast.operators import features as fe

S = fx.SETTINGS

# The public holidays of every year in question, each rule by date arithmetic.
HOLIDAYS = """years AS (SELECT CAST(y AS INTEGER) AS y FROM range(1990, 2031) r(y)),
fixed AS (
  SELECT make_date(y, m, d) AS day, name FROM years, (VALUES
    (1, 1, 'New Year''s Day'), (6, 19, 'Juneteenth National Independence Day'),
    (7, 4, 'Independence Day'), (11, 11, 'Veterans Day'), (12, 25, 'Christmas Day')) f(m, d, name)
  WHERE m <> 6 OR y >= 2021),
observed AS (
  SELECT CASE isodow(day) WHEN 6 THEN day - 1 WHEN 7 THEN day + 1 END AS day,
         name || ' (observed)' AS name
  FROM fixed WHERE isodow(day) IN (6, 7)),
ruled AS (
  SELECT CAST(first + CAST((wd - isodow(first) + 7) % 7 AS INTEGER) + 7 * (k - 1) AS DATE) AS day,
         name
  FROM (SELECT make_date(y, m, 1) AS first, wd, k, name FROM years, (VALUES
    (1, 1, 3, 'Martin Luther King Jr. Day'), (2, 1, 3, 'Washington''s Birthday'),
    (9, 1, 1, 'Labor Day'), (10, 1, 2, 'Columbus Day'), (11, 4, 4, 'Thanksgiving Day'))
    w(m, wd, k, name))
  UNION ALL
  SELECT CAST(last_day(make_date(y, 5, 1)) - CAST((isodow(last_day(make_date(y, 5, 1))) - 1) AS INTEGER)
              AS DATE), 'Memorial Day' FROM years),
holidays AS (
  SELECT CAST(day AS DATE) AS day, min(name) AS name
  FROM (SELECT * FROM fixed UNION ALL SELECT * FROM observed UNION ALL SELECT * FROM ruled)
  GROUP BY 1)"""


def features_sql(source: str) -> str:
    pi2 = "2 * pi()"
    return f"""SELECT s.*, hour(ts_local) AS hour, minute(ts_local) AS minute,
    isodow(ts_local) - 1 AS dayofweek, month(ts_local) AS month,
    CAST(isodow(ts_local) IN (6, 7) AS INTEGER) AS is_weekend,
    CAST(h.day IS NOT NULL AS INTEGER) AS is_holiday,
    sin({pi2} * hour(ts_local) / 24) AS hour_sin, cos({pi2} * hour(ts_local) / 24) AS hour_cos,
    sin({pi2} * month(ts_local) / 12) AS month_sin, cos({pi2} * month(ts_local) / 12) AS month_cos
  FROM {source} s LEFT JOIN holidays h ON CAST(s.ts_local AS DATE) = h.day"""


@query("feature_calendar_parts", """SELECT o_orderkey, CAST(hour(ts) AS INTEGER) AS hour,
    CAST(minute(ts) AS INTEGER) AS minute, CAST(isodow(ts) - 1 AS INTEGER) AS dayofweek,
    CAST(month(ts) AS INTEGER) AS month, CAST(isodow(ts) IN (6, 7) AS INTEGER) AS is_weekend
    FROM (SELECT o_orderkey, o_orderdate + to_seconds(CAST(o_totalprice AS BIGINT) % 86400) AS ts
          FROM orders)""")
def calendar_parts(spark, sf):
    from slotcast.functions.clock import from_micros, micros

    seconds = F.bround(F.col("o_totalprice")).cast("bigint") % 86400
    ts = from_micros(micros(F.col("o_orderdate")) + seconds * 1000000)
    parts = fe.calendar(F.col("ts"))
    names = ["hour", "minute", "dayofweek", "month", "is_weekend"]
    return table(spark, sf, "orders").select("o_orderkey", ts.alias("ts")).select(
        "o_orderkey", *(parts[n].alias(n) for n in names)
    )


@query("feature_holidays", f"""WITH {HOLIDAYS}
    SELECT o_orderkey, CAST(o_orderdate AS DATE) + 9000 AS day,
    h.name AS holiday, CAST(h.day IS NOT NULL AS INTEGER) AS is_holiday
    FROM orders LEFT JOIN holidays h ON CAST(o_orderdate AS DATE) + 9000 = h.day""")
def holiday_flag(spark, sf):
    day = F.date_add(F.to_date("o_orderdate"), 9000)
    rows = table(spark, sf, "orders").select("o_orderkey", day.alias("day"))
    return rows.withColumns(
        {
            "holiday": holidays.holiday_name(F.col("day")),
            "is_holiday": holidays.is_holiday(F.col("day")),
        }
    )


@query("feature_build", f"""WITH {', '.join(fx.SILVER)}, {HOLIDAYS}, f AS ({features_sql('silver')})
    SELECT park_name, ride_key, ts_local, CAST(hour AS INTEGER) AS hour,
    CAST(minute AS INTEGER) AS minute, CAST(dayofweek AS INTEGER) AS dayofweek,
    CAST(month AS INTEGER) AS month, is_weekend, is_holiday, round(hour_sin, 6) AS hour_sin,
    round(hour_cos, 6) AS hour_cos, round(month_sin, 6) AS month_sin,
    round(month_cos, 6) AS month_cos FROM f""")
def build(spark, sf):
    rows = fe.build_features(fx.silver(spark, sf))
    rows = rows.select("park_name", "ride_key", "ts_local", *fe.CALENDAR_FEATURES)
    return rounded(rows, "hour_sin", "hour_cos", "month_sin", "month_cos")


@query("split_time_cutoff", with_ctes(fx.SPLIT, "SELECT cutoff FROM cut"))
def cutoff(spark, sf):
    return fe.time_cutoff(fx.silver(spark, sf), S)


@query("split_chronological", with_ctes(fx.SPLIT, """
    SELECT 'train' AS side, park_name, ride_key, ts_local FROM train
    UNION ALL SELECT 'test', park_name, ride_key, ts_local FROM test"""))
def chronological(spark, sf):
    train, test = fx.split(spark, sf)
    keys = ["park_name", "ride_key", "ts_local"]
    return train.select(F.lit("train").alias("side"), *keys).unionByName(
        test.select(F.lit("test").alias("side"), *keys)
    )


@query("split_profile", with_ctes(fx.SPLIT, """
    SELECT 'train' AS side, count(*) AS rows, max(ts_local) AS last_local FROM train
    UNION ALL SELECT 'test', count(*), max(ts_local) FROM test"""))
def profile(spark, sf):
    return fe.split_profile(*fx.split(spark, sf))


@query("segment_high_wait", with_ctes(fx.SPLIT, """
    SELECT entity, round(avg(wait_time), 6) AS mean_wait FROM train GROUP BY entity
    HAVING avg(wait_time) > 10"""))
def high_wait(spark, sf):
    train, _ = fx.split(spark, sf)
    return rounded(fe.high_wait_entities(train, S), "mean_wait")
