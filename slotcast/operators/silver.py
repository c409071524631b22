"""Bronze to silver: one cleaned value per unit and 30-minute slot of the local clock."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from slotcast.config import Settings
from slotcast.functions import clock, text
from slotcast.functions.idfilter import Repeated
from slotcast.schemas import SILVER_COLUMNS, SLOT_KEY, UNIT_KEY
from slotcast.session import materialize

#: Counts a frame while it is computed: (frame, name, metrics) to the same frame.
Watched = Callable[..., DataFrame]


def site_table(spark: SparkSession, settings: Settings) -> DataFrame:
    """The configured sites as a table.

    It is an inlined literal, so its size is known to the planner, which broadcasts it by
    its own threshold; a larger site table passed to the operators is shuffled instead.
    """
    rows = [
        F.struct(
            F.lit(s.name).alias("park_name"),
            F.lit(s.open_hour).alias("open_hour"),
            F.lit(s.close_hour).alias("close_hour"),
            F.lit(s.first_date).alias("first_date"),
        )
        for s in settings.sites
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def repeated_ids(bronze: DataFrame, watch: Watched | None = None) -> Repeated:
    """A filter that the ids of two or more observations pass, and few others.

    Only ids are read, combined inside each task. This is the one pass that sees every
    observation, so ``watch`` counts them here, as ``raw``.
    """
    ids = bronze.select(F.col("wait_time_id").cast("bigint").alias("wait_time_id"))
    if watch is not None:
        ids = watch(ids, "raw", rows=F.count(F.lit(1)))
    return Repeated(ids, "wait_time_id")


def first_per_id(bronze: DataFrame, watch: Watched | None = None) -> DataFrame:
    """One row per id, the earliest ingested; equal ids beyond it are dropped.

    Most ids occur once, and their rows pass through as they are: nothing sorts or shuffles
    them, however many ids are repeated, as the filter of those is bounded and broadcast. Only
    rows that pass it and those without an id are compared; a single row among them
    is its own minimum. The row is the minimum over (ingest time, then the other columns), so
    the choice does not depend on row order, and an id that fills a third of the table (null
    ids all count as one) leaves each task as one row.
    """
    if "wait_time_id" not in bronze.columns:
        return bronze
    order = ["_ingested_at"] if "_ingested_at" in bronze.columns else []
    rest = [c for c in bronze.columns if c not in ("wait_time_id", *order)]
    marked = repeated_ids(bronze, watch).mark(bronze, "_again")
    compared = F.col("_again") | F.col("wait_time_id").isNull()
    first = F.min(F.struct(*order, *rest)).alias("_row")
    chosen = (
        marked.where(compared).groupBy("wait_time_id").agg(first).select("wait_time_id", "_row.*")
    )
    alone = marked.where(~F.col("_again") & F.col("wait_time_id").isNotNull())
    return alone.select(*bronze.columns).unionByName(chosen.select(*bronze.columns))


def valid_waits(df: DataFrame, settings: Settings) -> DataFrame:
    """0 <= wait < limit; null fails."""
    return df.where((F.col("wait_time") >= 0) & (F.col("wait_time") < settings.max_wait))


def clean_names(df: DataFrame, settings: Settings) -> DataFrame:
    """Strip names, then drop the excluded ones. A null name is dropped."""
    stripped = df.withColumn("ride_name", text.strip(F.col("ride_name")))
    return stripped.where(~F.col("ride_name").isin(*settings.excluded_names))


def known_sites(df: DataFrame, settings: Settings, sites: DataFrame | None = None) -> DataFrame:
    """Drop denied sites, keep configured ones; a null site is neither."""
    sites = site_table(df.sparkSession, settings) if sites is None else sites
    allowed = sites.select("park_name").where(~F.col("park_name").isin(*settings.excluded_sites))
    return df.join(allowed, "park_name", "left_semi").select(*df.columns)


def localize(df: DataFrame, settings: Settings) -> DataFrame:
    """Add ``ts_local``; rows without a usable time are dropped."""
    ts = F.col("ts_utc")
    if not isinstance(df.schema["ts_utc"].dataType, T.TimestampNTZType):
        ts = clock.utc_instant(ts)
    timed = df.where(ts.isNotNull())
    return timed.withColumn("ts_local", clock.to_local(ts, settings.time_zone))


def open_hours(df: DataFrame, settings: Settings, sites: DataFrame | None = None) -> DataFrame:
    """Keep rows in their site's local opening hours, from its first trusted date on.

    An equi-join on the site with the hour range as residual, so it needs no cross product.
    """
    sites = site_table(df.sparkSession, settings) if sites is None else sites
    hour = F.hour("ts_local")
    inside = (
        (hour >= F.col("open_hour"))
        & (hour < F.col("close_hour"))
        & (F.to_date("ts_local") >= F.col("first_date"))
    )
    return df.join(sites, "park_name").where(inside).select(*df.columns)


def with_key(df: DataFrame) -> DataFrame:
    return df.withColumn("ride_key", text.canonical_key(F.col("ride_name")))


def keyed(df: DataFrame) -> DataFrame:
    """Add ``ride_key``; names without any key character are dropped."""
    return with_key(df.where(text.has_key(F.col("ride_name"))))


def slot_means(df: DataFrame, settings: Settings) -> DataFrame:
    """Mean per (site, spelled name, slot), with the name's key. Empty slots have no row.

    Sums and counts are combined before the shuffle, and the shuffle is on the whole group
    key, so a unit with most of the observations is spread over its slots. The key follows
    from the name, so it is computed per slot instead of per observation.
    """
    slot = clock.slot_start(F.col("ts_local"), settings.grid_minutes).alias("ts_local")
    known = df.where(F.col("park_name").isNotNull() & F.col("ride_name").isNotNull())
    means = known.groupBy("park_name", "ride_name", slot).agg(
        F.avg("wait_time").alias("wait_time")
    )
    return with_key(means).select("park_name", "ride_key", "ride_name", "ts_local", "wait_time")


def numbered_names(spelled: DataFrame) -> DataFrame:
    """The spellings of each unit with their place in order, from 1; written once.

    A window holds the distinct spellings of one unit, not its rows.
    """
    names = spelled.select(*UNIT_KEY, "ride_name").distinct()
    place = F.row_number().over(W.partitionBy(*UNIT_KEY).orderBy("ride_name"))
    return materialize(names.withColumn("nth_name", place), "names")


def collapse_spellings(grid: DataFrame) -> DataFrame:
    """One row per slot: the plain mean of the spellings' means, and the smallest name.

    The smallest name is taken as the smallest number of a spelling, which a hash aggregate can
    hold; a minimum of texts would sort the grid before and after its shuffle. The grid by
    spelling is written first, as its names and its rows are both read from it.
    """
    spelled = materialize(grid, "spelled")
    names = numbered_names(spelled)
    slots = (
        spelled.join(names, [*UNIT_KEY, "ride_name"])
        .groupBy(*SLOT_KEY)
        .agg(F.min("nth_name").alias("nth_name"), F.avg("wait_time").alias("wait_time"))
    )
    return slots.join(names, [*UNIT_KEY, "nth_name"]).select(
        *SLOT_KEY, "ride_name", "wait_time"
    )


def long_histories(grid: DataFrame, settings: Settings) -> DataFrame:
    """Keep units with at least ``min_obs`` slots.

    The grid has one row per unit and slot, so a unit's window holds no more rows than its
    history has slots (17,520 in a year of half hours), however many observations it had.
    A semi-join with the counts is no way round the window: the optimizer moves it below
    the aggregations, where it shuffles all observations by unit and reads them twice.
    """
    slots = F.count(F.lit(1)).over(W.partitionBy(*UNIT_KEY))
    return grid.withColumn("_n", slots).where(F.col("_n") >= settings.min_obs).drop("_n")


def with_utc(grid: DataFrame, settings: Settings) -> DataFrame:
    utc = clock.to_utc(F.col("ts_local"), settings.time_zone)
    return grid.withColumn("ts_utc", utc).select(*SILVER_COLUMNS)


def clean(
    bronze: DataFrame,
    settings: Settings,
    sites: DataFrame | None = None,
    watch: Watched | None = None,
) -> DataFrame:
    """All row-wise steps before the grid, on only the columns the grid needs.

    The join with the opening hours also is the allow list of sites, so it is the only one.
    """
    needed = ["wait_time_id", "_ingested_at", "wait_time", "ts_utc", "ride_name", "park_name"]
    sites = site_table(bronze.sparkSession, settings) if sites is None else sites
    allowed = sites.where(~F.col("park_name").isin(*settings.excluded_sites))
    work = bronze.select(*(c for c in needed if c in bronze.columns))
    work = clean_names(valid_waits(first_per_id(work, watch), settings), settings)
    work = open_hours(localize(work, settings), settings, allowed)
    return work.where(text.has_key(F.col("ride_name")))


def slot_grid(
    bronze: DataFrame,
    settings: Settings,
    sites: DataFrame | None = None,
    watch: Watched | None = None,
) -> DataFrame:
    """Cleaned slots of every unit, however short its history."""
    return collapse_spellings(slot_means(clean(bronze, settings, sites, watch), settings))


def build_silver(
    bronze: DataFrame,
    settings: Settings,
    sites: DataFrame | None = None,
    watch: Watched | None = None,
) -> DataFrame:
    """Silver; with ``watch``, its profile is counted while it is written (see ``profiled``)."""
    grid = long_histories(slot_grid(bronze, settings, sites, watch), settings)
    silver = with_utc(grid, settings)
    return silver if watch is None else profiled(silver, settings, watch)


def profiled(silver: DataFrame, settings: Settings, watch: Watched) -> DataFrame:
    """Rows, their sites, mean, share of zeros and time range, as ``silver`` of the watch."""
    here = [F.max((F.col("park_name") == s.name).cast("int")) for s in settings.sites]
    return watch(
        silver,
        "silver",
        silver_rows=F.count(F.lit(1)),
        sites=sum((F.coalesce(h, F.lit(0)) for h in here), F.lit(0)),
        mean_wait=F.avg("wait_time"),
        zero_pct=F.count_if(F.col("wait_time") == 0) * 100.0
        / F.nullif(F.count(F.lit(1)), F.lit(0)),
        first_local=F.min("ts_local"),
        last_local=F.max("ts_local"),
    )


def silver_profile(silver: DataFrame, raw_rows: DataFrame | None = None) -> DataFrame:
    """Row, unit and site counts, mean, share of zeros and time range, in one pass."""
    raw = F.lit(None).cast("bigint") if raw_rows is None else raw_rows.agg(
        F.count(F.lit(1))
    ).scalar()
    per_unit = silver.groupBy(*UNIT_KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("wait_time").alias("total"),
        F.count_if(F.col("wait_time") == 0).alias("zeros"),
        F.min("ts_local").alias("first"),
        F.max("ts_local").alias("last"),
    )
    return per_unit.agg(
        F.sum("n").alias("grid_rows"),
        F.count(F.lit(1)).alias("entities"),
        F.count_distinct("park_name").alias("sites"),
        (F.sum("total") / F.sum("n")).alias("mean_wait"),
        (F.sum("zeros") * 100.0 / F.sum("n")).alias("zero_pct"),
        F.min("first").alias("first_local"),
        F.max("last").alias("last_local"),
    ).select(raw.alias("raw_rows"), "*")


def data_age_hours(silver: DataFrame, now_local) -> DataFrame:
    """Hours from the newest slot to now; infinity when there is no row."""
    age = clock.hours_between(now_local, F.max("ts_local"))
    return silver.agg(F.coalesce(age, F.lit(float("inf"))).alias("age_hours"))
