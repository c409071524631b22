"""Session conventions: UTC wall clock, and where intermediate tables live."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def pin_utc(spark: SparkSession) -> SparkSession:
    """Naive timestamps pass through TIMESTAMP unchanged only when the session is in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a folder of the warehouse, which all executors reach as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/slotcast/{label}-{uuid.uuid4().hex}"


#: Whether a query's shuffle files go when it ends, not when the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize_and_drop(df: DataFrame, label: str) -> DataFrame:
    """``materialize``; the files that ``df`` shuffled are gone afterwards, so steps do not add up on disk."""
    conf = df.sparkSession.conf
    before = conf.get(DROP_SHUFFLES, None)
    conf.set(DROP_SHUFFLES, "true")
    try:
        # The setting is read when a plan is made, so the plan is made anew.
        return materialize(df.select("*"), label)
    finally:
        conf.unset(DROP_SHUFFLES) if before is None else conf.set(DROP_SHUFFLES, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage like a checkpoint, and keeps what a checkpoint loses: later readers prune
    columns, push filters, and know the true size, so broadcasts are decided by statistics.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
