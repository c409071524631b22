"""One ingest run: read upstream above the mark, land, merge; a drain takes the whole backlog."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.config import Settings
from slotcast.operators import ingest as ing
from slotcast.session import pin_utc
from slotcast.sources import upstream as up
from slotcast.sources.bronze import Bronze
from slotcast.sources.landing import land_batch, read_batch
from slotcast.streaming.id_stream import drain_ids


def run_ingest(
    spark: SparkSession,
    upstream: tuple[DataFrame, DataFrame, DataFrame] | up.Frames | up.Jdbc,
    bronze_path: str,
    landing: str,
    settings: Settings,
    now_utc: datetime,
    drain: bool = False,
    dry_run: bool = False,
) -> dict:
    """Summary of the run. A dry run only reports the gap.

    Without ``drain`` one batch of the oldest ``batch_rows`` rows is taken. A drain takes the whole
    backlog in one parallel read and one parallel append; ``batches`` then counts the id ranges of
    width ``batch_rows`` in it, which decide nothing about what arrives.

    The mark of a first drain is read from bronze; from then on its checkpoint, beside the
    rows, says what is through. A drain that was cut off is repeated with the same ids, and the
    merge drops what is there already.
    """
    pin_utc(spark)
    source = up.Frames(*upstream) if isinstance(upstream, tuple) else upstream
    bronze = Bronze(spark, bronze_path, settings.bronze_range_ids)
    bronze.ensure()

    mark = ing.high_water(bronze.newest_range()).first()["mark"]
    top = source.top()
    report = {"mark": mark, "upstream_max": top, "gap": max(0, top - mark)}
    report |= {"rows": 0, "batches": 0, "caught_up": top <= mark}
    if dry_run:
        return report

    def take(batch: DataFrame, low: int, ranges: int, number: int = 0) -> None:
        # Batches of one run may share a second; the stamp is what tells them apart.
        path = land_batch(batch, landing, low, now_utc + timedelta(seconds=number))
        landed = read_batch(spark, path)
        span = ing.batch_range(landed).first()
        if span["rows"]:
            bronze.merge(ing.stamp_ingested(landed, now_utc), span["low"], span["high"])
            report["rows"] += span["rows"]
            report["batches"] += ranges

    if drain:
        drain_ids(
            spark,
            lambda low, high, n, epoch: take(up.read_range(source, low, high), low, n, epoch),
            mark,
            top,
            settings.batch_rows,
            f"{bronze_path}/_drain",
        ).awaitTermination()
    else:
        rows = up.read_since(
            source.facts(mark + 1, max(top, mark + 1)), source.units, source.sites, mark,
            settings.batch_rows,
        )
        take(rows, mark + 1, 1)
    report["caught_up"] = drain or report["rows"] == 0
    total = ing.ingest_summary(bronze.read()).select(
        F.col("rows").alias("bronze_rows"), F.col("max_id").alias("bronze_max")
    )
    return {**report, **total.first().asDict()}
