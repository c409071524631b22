"""Settings of the engine. Every threshold an operator uses is a field here."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime


@dataclass(frozen=True)
class Site:
    """A site with its local opening hours (close exclusive) and first trusted date."""

    name: str
    open_hour: int
    close_hour: int
    first_date: date


# ---- fixed values -------------------------------------------------------------------
# Sites, labels and status words that readers of the output tables filter on.
DEFAULT_SITES = (
    Site("Disneyland", 8, 24, date(2025, 12, 6)),
    Site("Disney California Adventure Park", 8, 22, date(2025, 12, 6)),
    Site("Universal Studios Hollywood", 8, 22, date(2025, 12, 6)),
    Site("SeaWorld San Diego", 10, 20, date(2025, 12, 6)),
    Site("Six Flags Magic Mountain", 10, 21, date(2026, 2, 15)),
)
DEFAULT_EXCLUDED_SITES = ("SeaWorld San Diego Obsolete",)
DEFAULT_EXCLUDED_NAMES = ("0", "")

MODEL_ADDITIVE = "prophet_fleet"
MODEL_GLOBAL = "xgb_global"
MODEL_LOCAL = "xgb_local_fleet"
MODEL_BASELINE = "baseline_ride_mean"

STATUS_FRESH = "fresh_model"
STATUS_KEPT = "kept_previous_model"
STATUS_FALLBACK = "fallback_after_failure"
STATUS_STALE = "stale_input"

KPI_NAMES = (
    "mae",
    "rmse",
    "pct_severe_miss",
    "pct_within_10min",
    "bias",
    "high_wait_mae",
    "peak_hours_mae",
    "coverage_pct",
    "test_rows",
)
# ---- end of fixed values ------------------------------------------------------------


@dataclass(frozen=True)
class TreeParams:
    """Boosting parameters, shared by the global and the per-entity trees."""

    depth: int = 6
    trees: int = 200
    rate: float = 0.05
    row_sample: float = 0.9
    column_sample: float = 0.9
    seed: int = 42
    ridge: float = 1.0


@dataclass(frozen=True)
class Settings:
    sites: tuple[Site, ...] = DEFAULT_SITES
    excluded_sites: tuple[str, ...] = DEFAULT_EXCLUDED_SITES
    excluded_names: tuple[str, ...] = DEFAULT_EXCLUDED_NAMES
    time_zone: str = "America/Los_Angeles"

    max_wait: int = 900
    grid_minutes: int = 30
    min_obs: int = 100
    min_train_rows: int = 50
    test_fraction: float = 0.20
    forecast_days: int = 7
    interval_width: float = 0.80

    improvement_factor: float = 0.99
    high_wait_mean: float = 10.0
    peak_hours: tuple[int, int] = (11, 20)
    severe_miss: float = 15.0
    within: float = 10.0

    min_entities: int = 50
    max_zero_pct: float = 75.0
    min_row_ratio: float = 0.5
    min_coverage: float = 0.95
    row_band: tuple[float, float] = (0.75, 1.05)
    collection_start: datetime = datetime(2025, 12, 1)
    peak_check_hours: tuple[int, int] = (11, 20)
    max_input_age_hours: float = 36.0

    # Rows of one ingest transfer; None reads the whole backlog in one parallel job.
    batch_rows: int | None = 200_000
    # Ids of one bronze folder; fixed for the life of a table.
    bronze_range_ids: int = 10_000_000
    chunk_rows: int = 5_000
    retain_runs: int = 4

    candidates: tuple[str, ...] = (MODEL_ADDITIVE, MODEL_GLOBAL, MODEL_LOCAL)
    baseline: str = MODEL_BASELINE
    trees: TreeParams = TreeParams()
    # Ridge penalty of the additive fleet; keeps sparse calendars solvable.
    additive_ridge: float = 0.1
    # Rows without any effect that each effect of the local family is averaged with.
    local_shrinkage: float = 10.0

    @property
    def model_order(self) -> tuple[str, ...]:
        return (*self.candidates, self.baseline)

    @property
    def quantile_bounds(self) -> tuple[float, float]:
        tail = (1.0 - self.interval_width) / 2.0
        return tail, 1.0 - tail
