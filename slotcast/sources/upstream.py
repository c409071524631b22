"""The upstream observation tables: a fact table, its units and their sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slotcast.functions.skew import spread_join
from slotcast.schemas import LANDING, LANDING_COLUMNS

MAX_ID = 2**63 - 1


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    options: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 32,
) -> DataFrame:
    """One upstream table over JDBC, read in parallel ranges of ``partition_column``.

    Filters and columns of later operators are pushed into the generated SQL.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.options(**(options or {})).load()


class Frames:
    """The upstream as three DataFrames. A range of ids reaches the scan as a pushed filter."""

    def __init__(self, fact: DataFrame, units: DataFrame, sites: DataFrame):
        self.fact, self.units, self.sites = fact, units, sites

    def top(self) -> int:
        """Highest id, 0 when there is none: one scan of the id column."""
        return self.fact.agg(F.max("wait_time_id")).first()[0] or 0

    def facts(self, low: int, high: int) -> DataFrame:
        return self.fact.where(F.col("wait_time_id").between(low, high))


class Jdbc:
    """The upstream behind JDBC. Each read of facts is split evenly over the ids that it asks for."""

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        tables: tuple[str, str, str] = ("wait_times", "attractions", "themeparks"),
        options: dict[str, str] | None = None,
        partitions: int = 32,
    ):
        self.spark, self.url, self.tables = spark, url, tables
        self.options, self.partitions = options or {}, partitions

    @property
    def units(self) -> DataFrame:
        return read_jdbc(self.spark, self.url, self.tables[1], self.options)

    @property
    def sites(self) -> DataFrame:
        return read_jdbc(self.spark, self.url, self.tables[2], self.options)

    def top(self) -> int:
        """Asked of the database, which answers with one row."""
        asked = f"(SELECT max(wait_time_id) AS top FROM {self.tables[0]}) newest"
        return read_jdbc(self.spark, self.url, asked, self.options).first()[0] or 0

    def facts(self, low: int, high: int) -> DataFrame:
        rows = read_jdbc(
            self.spark, self.url, self.tables[0], self.options, "wait_time_id", (low, high + 1),
            self.partitions,
        )
        return rows.where(F.col("wait_time_id").between(low, high))


def coerce_landing(df: DataFrame) -> DataFrame:
    """The seven landing columns, typed.

    A wait that is no number becomes null. Any other value that does not fit is an error:
    the session runs in ANSI mode, so ``cast`` raises. Text such as ``'12.0'`` is a number.
    """

    def typed(name: str) -> Column:
        target = LANDING[name].dataType
        if name == "wait_time":
            number = F.col(name).try_cast("double").try_cast("bigint")
            return F.coalesce(F.col(name).try_cast("bigint"), number).alias(name)
        return F.col(name).cast(target).alias(name)

    return df.select(*(typed(c) for c in LANDING_COLUMNS))


def observations(
    fact: DataFrame, units: DataFrame, sites: DataFrame, spread: bool = False
) -> DataFrame:
    """Observations with unit and site names; an observation without either drops out.

    fact(wait_time_id, wait_time, wait_time_upd_dt, at_id), units(at_id, at_name, tp_id),
    sites(tp_id, tp_name). No join is hinted: the dimensions are broadcast while their
    statistics stay below the session's threshold, and are shuffled beyond it.

    ``spread`` is for dimensions beyond that threshold where a few units have most of the
    observations: units get their sites first, so that facts are joined once, and facts of
    a hot unit, or units of a hot site, are dealt to several tasks.
    """
    if spread:
        named = spread_join(units.select("at_id", "at_name", "tp_id"), sites, "tp_id")
        joined = spread_join(fact, named, "at_id")
    else:
        joined = fact.join(units, "at_id").join(sites, "tp_id")
    return coerce_landing(
        joined.select(
            "wait_time_id",
            "wait_time",
            F.col("wait_time_upd_dt").alias("ts_utc"),
            "at_id",
            F.col("at_name").alias("ride_name"),
            "tp_id",
            F.col("tp_name").alias("park_name"),
        )
    )


def read_since(
    fact: DataFrame,
    units: DataFrame,
    sites: DataFrame,
    mark: int | Column,
    batch_rows: int | None = None,
) -> DataFrame:
    """Observations above the high-water mark; the oldest ``batch_rows`` of them if given.

    The mark reaches the scan of the fact table as a pushed filter. Leave the cap out to
    take everything in one parallel read.
    """
    rows = observations(fact.where(F.col("wait_time_id") > mark), units, sites)
    if batch_rows is None:
        return rows
    near = rows.where(F.col("wait_time_id") <= batch_bound(rows, batch_rows))
    return near.orderBy("wait_time_id").limit(batch_rows)


def read_range(source: Frames | Jdbc, low: int, high: int) -> DataFrame:
    """Observations with ids from ``low`` to ``high``."""
    return observations(source.facts(low, high), source.units, source.sites)


def batch_bound(rows: DataFrame, batch_rows: int) -> Column:
    """An id below which the oldest ``batch_rows`` rows lie, and not many more.

    A top-k over the whole backlog would send k rows of every partition to one task. Here
    the rows are counted in id ranges of k, which combines inside each task, and only the
    first ranges are summed up, at most k of them, as none is empty. The batch is then cut
    from rows below the bound, which is pushed into the fact scan.
    """
    part = F.expr(f"wait_time_id div {batch_rows}").alias("part")
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    first = counts.orderBy("part").limit(batch_rows)
    upto = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow))
    full = first.select("part", upto.alias("upto")).where(F.col("upto") >= batch_rows)
    bound = (F.min("part") + 1) * F.lit(batch_rows) - 1
    return full.agg(F.coalesce(bound, F.lit(MAX_ID)).alias("bound")).scalar()
