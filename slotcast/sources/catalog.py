"""Named tables in the session's catalog, for users who work with SQL names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotcast.schemas import BRONZE


def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def ensure_bronze(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the bronze table if it is missing; an existing one is left as it is."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BRONZE.fields)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_count(spark: SparkSession, name: str) -> int:
    return spark.table(name).count()


def drop_tables(spark: SparkSession, *names: str) -> list[str]:
    """Drop tables or views; one that cannot be dropped does not stop the others."""
    failed = []
    for name in names:
        try:
            kind = "TABLE" if not _is_view(spark, name) else "VIEW"
            spark.sql(f"DROP {kind} IF EXISTS {name}")
        except Exception:
            failed.append(name)
    return failed


def _is_view(spark: SparkSession, name: str) -> bool:
    if not spark.catalog.tableExists(name):
        return False
    return spark.catalog.getTable(name).tableType in ("VIEW", "TEMPORARY")


def promote_view(spark: SparkSession, snapshot: str, name: str) -> DataFrame:
    """Point the view ``name`` at a Parquet snapshot; one statement, so readers see one."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{snapshot}`")
    return spark.table(name)
