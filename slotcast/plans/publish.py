"""The publish job: fetch a consistent pair, check it, save it if wanted, load and swap."""

from __future__ import annotations

import logging
import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.operators import checks
from slotcast.sources import serving
from slotcast.sources.store import TableStore

log = logging.getLogger("slotcast")


def checked_pair(store: TableStore, now_local: Column) -> tuple[DataFrame, DataFrame]:
    """Both tables as one pointer row names them, or an error that names every failed check."""
    kpis, predictions = serving.fetch_pair(store)
    checks.gate(checks.pair_checks(kpis, predictions, now_local))
    # A row for each constraint.
    broken = checks.serving_constraints(kpis, predictions).where(F.col("violations") > 0).collect()
    if broken:
        named = "; ".join(f"{r['rule']}: {r['violations']}" for r in broken)
        raise checks.QualityCheckError(named)
    return kpis, predictions


REFUSED = (serving.EmptyStagingError, serving.RepeatedKeyError, checks.QualityCheckError)


def run_publish(
    source: TableStore,
    target: TableStore,
    now_local: Column,
    save_to: str | None = None,
    attempts: int = 3,
    pause_s: float = 5.0,
) -> dict:
    """Publish what ``source`` serves to ``target``; readers of it see both tables change at once.

    A refused pair leaves the target as it was and is not tried again. A load that breaks is, up to
    ``attempts`` times with a longer pause each time: the same pair gives the same tables.
    """
    kpis, predictions = checked_pair(source, now_local)
    if save_to:
        serving.save_pair(kpis, predictions, save_to)
    summary = checks.pair_summary(kpis, predictions).first().asDict()
    for attempt in range(1, attempts + 1):
        try:
            counts = serving.publish_pair(target, kpis, predictions, summary["run_id"]).first()
            break
        except REFUSED:
            raise
        except Exception:
            target.discard("kpis", "predictions")
            if attempt == attempts:
                raise
            log.exception("publishing failed, attempt %d of %d", attempt, attempts)
            time.sleep(pause_s * attempt)
    return {**summary, "published_kpis": counts["kpis"], "published_rows": counts["predictions"]}
