"""The weekly run: clean, check, fit, measure, decide, forecast, check, promote.

Readers only ever see promoted versions. A run writes candidates, checks them, and moves
the pointer last, in one step for all tables and the model. Fact data stays in Spark; the
driver receives check rows, scalars and the run summary.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.config import (
    STATUS_FALLBACK,
    STATUS_FRESH,
    STATUS_KEPT,
    STATUS_STALE,
    Settings,
)
from slotcast.functions import clock
from slotcast.operators import checks as ck
from slotcast.operators import features as fe
from slotcast.operators import gold as go
from slotcast.operators import kpis as kp
from slotcast.operators import silver as si
from slotcast.operators.models import registry
from slotcast.watch import Watch
from slotcast.schemas import KPIS, PREDICTIONS, SILVER, UNIT_KEY
from slotcast.session import materialize, pin_utc
from slotcast.sources.store import TableStore

log = logging.getLogger("slotcast")

TABLES = ("silver", "kpis", "predictions")
SUMMARY = (
    "run_id string, run_status string, serving_model string, serving_run_id string, "
    "new_model_mae double, previous_mae double, decision string, silver_rows bigint, "
    "attractions bigint, forecast_rows bigint, backtest_rows bigint, input_age_hours double, "
    "raw_rows bigint, sites int, mean_wait double, zero_pct double, first_local timestamp_ntz, "
    "last_local timestamp_ntz, cutoff timestamp_ntz, train_rows bigint, test_rows bigint, "
    "fitted map<string,bigint>, skipped map<string,bigint>, uncovered bigint, "
    "expired array<string>"
)


class RunError(Exception):
    """A failure the run found itself."""


@dataclass(frozen=True)
class Run:
    """One run: where it writes, its settings and its clock."""

    store: TableStore
    settings: Settings
    now_utc: datetime
    watch: Watch = field(default_factory=Watch)

    @property
    def run_id(self) -> str:
        return clock.run_id_text(self.now_utc)

    @property
    def now_local(self):
        return clock.now_local(self.now_utc, self.settings.time_zone)

    @property
    def trained_at(self) -> str:
        return f"{self.now_utc.isoformat()}+00:00"


def _units(silver: DataFrame) -> int:
    return silver.select(*UNIT_KEY).distinct().count()


def _last(store: TableStore, table: str) -> DataFrame:
    schemas = {"silver": SILVER, "kpis": KPIS, "predictions": PREDICTIONS}
    return store.read(table, schemas[table])


def _incumbent(store: TableStore) -> dict | None:
    """Serving model, MAE and run as published; None on the first run."""
    if not store.exists("kpis"):
        return None
    row = kp.incumbent(_last(store, "kpis")).first()
    return row.asDict() if row is not None else None


def reload_serving(run: Run, previous: dict | None, why: str):
    """Pointer and model that serve now; refuses on any disagreement."""
    pointer = run.store.serving()
    if pointer is None:
        raise RunError(f"{why}, but no serving model is on record")
    if previous and previous["run_id"] and previous["run_id"] != pointer["run_id"]:
        raise RunError(
            f"the KPI table is of run {previous['run_id']}, the serving model of run "
            f"{pointer['run_id']}: refusing to mix them"
        )
    return pointer, registry.load(run.store, pointer, run.settings)


def forecast(run: Run, model: registry.FittedModel, silver: DataFrame) -> DataFrame:
    entities = go.covered_entities(go.active_entities(silver), model.entities)
    entities = run.watch(entities, "covered", entities=F.count(F.lit(1)))
    grid = go.forecast_grid(entities, run.now_local, run.settings)
    return go.forecast_rows(model.score(grid, run.settings), model.family, run.settings)


def write_silver(run: Run, bronze: DataFrame) -> DataFrame:
    """Silver candidate, checked against the last version."""
    built = si.build_silver(bronze, run.settings, watch=run.watch)
    silver = run.store.write("silver", built, run.run_id)
    if silver.isEmpty():
        raise RunError("cleaning removed every row: check times and site names")
    last_rows = run.store.count("silver")
    ck.gate(ck.silver_checks(silver, run.settings, run.now_local, last_rows))
    return silver


def write_and_promote(
    run: Run, kpis: DataFrame, predictions: DataFrame, active: int, serving: dict | None = None
) -> DataFrame:
    """Gold candidates, the gate, and one promotion of all three tables."""
    kpis = run.store.write("kpis", kpis, run.run_id)
    predictions = run.store.write(
        "predictions", predictions, run.run_id, partition_by=["row_kind"],
        sort_by=["park_name", "ts_local"],
    )
    ck.gate(
        ck.kpi_checks(kpis, run.settings),
        ck.prediction_checks(predictions, run.settings, active),
    )
    run.store.promote(*TABLES, serving=serving)
    return predictions


def fit_models(run: Run, train: DataFrame) -> dict[str, registry.FittedModel]:
    """All families at once: the others fit while the booster goes from one short job to the next."""

    def one(name: str) -> registry.FittedModel:
        return registry.fit(name, train, run.settings, run.trained_at, run.watch)

    names = run.settings.model_order
    with ThreadPoolExecutor(len(names)) as pool:
        inherits = inheritable_thread_target(run.store.spark)
        fits = [pool.submit(inherits(one), name) for name in names]
    return {name: fit.result() for name, fit in zip(names, fits, strict=True)}


def score_models(
    run: Run, models: list[registry.FittedModel], train: DataFrame, test: DataFrame
) -> DataFrame:
    """Test rows scored by every model, written once: KPIs and backtests both read them."""
    flagged = kp.flag_high(test, fe.high_wait_entities(train, run.settings))
    scored = None
    for model in models:
        rows = model.score(flagged, run.settings)
        scored = rows if scored is None else scored.unionByName(rows)
    tested = F.count_if(F.col("model") == run.settings.baseline)
    return materialize(run.watch(scored, "scored", test_rows=tested), "scored")


def _report(run: Run, active: int) -> dict:
    """Profile, split, fits and coverage, as counted on the way; empty for what did not run."""
    watch, order = run.watch, run.settings.model_order
    fits = {name: watch.get(name) for name in order}
    known = fits[run.settings.baseline]
    covered = watch.get("covered").get("entities")
    return {
        "raw_rows": watch.get("raw").get("rows"),
        **watch.get("silver"),
        "train_rows": known.get("train_rows"),
        "test_rows": watch.get("scored").get("test_rows"),
        "fitted": {n: f["fitted"] for n, f in fits.items() if f},
        "skipped": {n: known["fitted"] - f["fitted"] for n, f in fits.items() if f},
        "uncovered": None if covered is None else active - covered,
    }


def _expired(run: Run) -> list[str]:
    """The last step: versions that no kept promotion names. Their names, a few a run."""
    rows = registry.unreachable(run.store, run.settings).orderBy("name", "run").collect()
    return [f"{r['name']}/run={r['run']}" for r in rows]


def _summary(run: Run, status: str, model, serving_run: str, active, predictions, **extra):
    counts = go.row_counts(predictions).first()
    return {
        **_report(run, active),
        "expired": _expired(run),
        "run_id": run.run_id,
        "run_status": status,
        "serving_model": model.family,
        "serving_run_id": serving_run,
        "new_model_mae": None,
        "previous_mae": None,
        "attractions": active,
        "forecast_rows": counts["forecast_rows"],
        "backtest_rows": counts["backtest_rows"],
        "input_age_hours": None,
        **extra,
    }


def _round(value: float | None, digits: int) -> float | None:
    return None if value is None else round(value, digits)


def run_forecast_only(run: Run, silver: DataFrame, age_hours: float) -> dict:
    """Stale input: nothing to learn, so the serving model forecasts from the new clock."""
    previous = _incumbent(run.store)
    pointer, model = reload_serving(run, previous, "the input is stale")
    kpis, backtest = go.carry_forward(_last(run.store, "kpis"), _last(run.store, "predictions"))
    stamps = (pointer["run_id"], STATUS_STALE, run.now_utc, pointer["trained_at"])
    rows = go.gold_union(forecast(run, model, silver), backtest)
    active = _units(silver)
    written = write_and_promote(
        run, go.stamp(kpis, *stamps), go.stamp(rows, *stamps), active
    )
    limit = run.settings.max_input_age_hours
    return _summary(
        run, STATUS_STALE, model, pointer["run_id"], active, written,
        previous_mae=_round(previous["mae"] if previous else None, 3),
        decision=f"input is {age_hours:.1f} h old (limit {limit:g} h): forecast only",
        input_age_hours=round(age_hours, 1),
    )


def run_weekly(run: Run, bronze: DataFrame) -> dict:
    """One run on the bronze table; raises and promotes nothing when a check fails."""
    pin_utc(run.store.spark)
    settings = run.settings
    silver = write_silver(run, bronze)
    age = si.data_age_hours(silver, run.now_local).first()["age_hours"]
    if age > settings.max_input_age_hours:
        return run_forecast_only(run, silver, age)

    cutoff = fe.time_cutoff(silver, settings).first()["cutoff"]
    train, test = fe.chrono_split(silver, settings, clock.naive(cutoff))
    models = fit_models(run, train)
    scored = score_models(run, list(models.values()), train, test)
    kpis = materialize(kp.compute_kpis(scored, settings), "kpis")

    best = kp.best_candidate(kpis, settings)
    previous = _incumbent(run.store)
    schema = "model_name string, mae double, run_id string"
    old = [] if previous is None else [tuple(previous[c] for c in ("model_name", "mae", "run_id"))]
    found = best.first()
    if not found["usable"]:
        raise RunError(f"the best MAE is {found['mae']}: refusing to decide on it")
    choice = kp.decide_promotion(
        best, run.store.spark.createDataFrame(old, schema), settings
    ).first()

    serving = None
    if choice["ship"]:
        model, status, serving_run = models[choice["model"]], STATUS_FRESH, run.run_id
        count = registry.save(model, run.store, run.run_id)
        trained = {name: run.trained_at for name in settings.model_order}
        kpi_rows = kp.build_kpi_table(kpis, model.family, trained)
        backtest = go.backtest_rows(scored)
        trained_at = model.trained_at
        serving = {
            "run_id": run.run_id,
            "model_name": model.family,
            "trained_at": trained_at,
            "ride_count": count,
        }
    else:
        pointer, model = reload_serving(run, previous, "the decision kept the incumbent")
        status, serving_run, trained_at = STATUS_KEPT, pointer["run_id"], pointer["trained_at"]
        kpi_rows, backtest = go.carry_forward(
            _last(run.store, "kpis"), _last(run.store, "predictions")
        )

    stamps = (serving_run, status, run.now_utc, trained_at)
    rows = go.gold_union(forecast(run, model, silver), backtest)
    active = _units(silver)
    written = write_and_promote(
        run, go.stamp(kpi_rows, *stamps), go.stamp(rows, *stamps), active, serving
    )
    return _summary(
        run, status, model, serving_run, active, written,
        new_model_mae=_round(choice["new_mae"], 3),
        previous_mae=_round(choice["old_mae"], 3),
        decision=choice["reason"],
        input_age_hours=round(age, 1),
        cutoff=cutoff,
    )


def run_fallback(run: Run) -> bool:
    """After a failure: a new forecast window from the last silver and the serving model.

    Only the predictions move. Returns whether they did, and never raises, so that it
    cannot hide the failure it answers.
    """
    try:
        store = run.store
        pointer = store.serving()
        if pointer is None or not store.exists("silver"):
            log.warning("fallback: nothing to fall back to")
            return False
        if store.exists("kpis"):
            published = _last(store, "kpis").select("run_id").first()
            if published is not None and published["run_id"] != pointer["run_id"]:
                log.error("fallback: KPI table and serving model are of different runs")
                return False
        model = registry.load(store, pointer, run.settings)
        silver = _last(store, "silver")
        old = _last(store, "predictions") if store.exists("predictions") else None
        fresh = forecast(run, model, silver)
        stamps = (pointer["run_id"], STATUS_FALLBACK, run.now_utc, pointer["trained_at"])
        rows = store.write(
            "predictions", go.replace_forecast(fresh, old, *stamps), run.run_id,
            partition_by=["row_kind"], sort_by=["park_name", "ts_local"],
        )
        only_new = rows.where(F.col("row_kind") == "forecast")
        ck.gate(ck.prediction_checks(only_new, run.settings, _units(silver)))
        store.promote("predictions")
        return True
    except Exception:
        log.exception("fallback failed; nothing was changed")
        run.store.discard()
        return False


def run_or_fall_back(run: Run, bronze: DataFrame) -> dict:
    """The weekly run; on failure the candidates go, the fallback runs, the error stays."""
    try:
        return run_weekly(run, bronze)
    except Exception:
        run.store.discard()
        refreshed = run_fallback(run)
        log.error("run %s failed; forecast %s", run.run_id,
                  "refreshed by the fallback" if refreshed else "not refreshed")
        raise


def summary_frame(store: TableStore, summary: dict) -> DataFrame:
    columns = [c.split()[0] for c in SUMMARY.split(", ")]
    return store.spark.createDataFrame([tuple(summary.get(c) for c in columns)], SUMMARY)
