"""Additive-seasonal fleet: one model per entity with daily and weekly seasonality, an
effect per holiday, and flat growth.

The design is a function of (weekday, time of day, holiday), so rows are first summed into
those cells; the normal equations of the cells are those of the rows. An entity has at most one
cell per slot of the week and holiday, so they fit one row, on which array functions solve the
equations by Cholesky's method and tabulate the seasonal curve and the holiday effects. No
Python worker takes part, in the fit or in the score, which is a join and two array look-ups. An
entity whose equations have no solution has no parameters, like one with too few rows.

A day has one holiday at most, so the holidays' block of the equations is diagonal and is
eliminated first: what is left to solve are the 15 seasonal coefficients.

The 80 % interval is ``yhat +- z * sigma`` with the residual spread of the fit: with flat
growth, noise is the interval's only source.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.config import Settings
from slotcast.functions.holidays import HOLIDAY_NAMES, holiday_index
from slotcast.operators.features import with_entity
from slotcast.operators.models import cells

# ---- fixed values -------------------------------------------------------------------
WEEKLY_ORDER = 3
DAILY_ORDER = 4
# ---- end of fixed values ------------------------------------------------------------

PARAMS = (
    "entity string, n bigint, sigma double, weekly_curve array<double>, "
    "holiday_effect array<double>"
)


def week_slot(ts: Column, minutes: int) -> Column:
    """Position of a slot in the week, from Monday 00:00."""
    of_day = F.hour(ts) * (60 // minutes) + F.floor(F.minute(ts) / F.lit(minutes))
    return (F.weekday(ts) * (24 * 60 // minutes) + of_day).cast("int")


def design_cells(train: DataFrame, settings: Settings) -> DataFrame:
    """Counts and sums per entity, slot of the week and holiday (-1 for none)."""
    ts = F.col("ts_local")
    return (
        with_entity(train)
        .where(F.col("wait_time").isNotNull())
        .groupBy(
            "entity",
            week_slot(ts, settings.grid_minutes).alias("week_slot"),
            F.coalesce(holiday_index(F.to_date(ts)), F.lit(-1)).alias("holiday"),
        )
        .agg(*cells.sums())
    )


def seasonal_design(slots: np.ndarray, per_day: int) -> np.ndarray:
    """Intercept with weekly and daily Fourier terms for slots of the week."""
    columns = [np.ones(len(slots))]
    for period, order in ((7 * per_day, WEEKLY_ORDER), (per_day, DAILY_ORDER)):
        for k in range(1, order + 1):
            angle = 2 * np.pi * k * slots / period
            columns += [np.sin(angle), np.cos(angle)]
    return np.column_stack(columns)


def seasonal_terms(slot: Column, per_day: int) -> Column:
    """The same for one slot, as an array."""
    terms = [F.lit(1.0)]
    for period, order in ((7 * per_day, WEEKLY_ORDER), (per_day, DAILY_ORDER)):
        for k in range(1, order + 1):
            angle = slot * F.lit(2 * math.pi * k / period)
            terms += [F.sin(angle), F.cos(angle)]
    return F.array(*terms)


SEASONAL = 1 + 2 * (WEEKLY_ORDER + DAILY_ORDER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often a lambda looks at it."""
    return F.transform(F.array(value), body)[0]


def total_of(items: Column, value: Callable[[Column], Column]) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda sum_, x: sum_ + value(x))


def dot(a: Column, b: Column) -> Column:
    return total_of(F.zip_with(a, b, lambda x, y: x * y), lambda x: x)


def _places(n: int) -> Column:
    return F.array(*[F.lit(k) for k in range(n)])


def _triangle(n: int) -> Column:
    """Row and column of the lower triangle, row by row."""
    return F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(n) for j in range(i + 1)]
    )


def _row(lower: Column, i: Column, n: Column) -> Column:
    """The first ``n`` entries of row ``i`` of a lower triangle."""
    return F.slice(lower, (i * (i + 1) / 2).cast("int") + 1, n)


def cholesky(matrix: Column, n: int) -> Column:
    """Lower triangle L of ``matrix`` (its lower triangle) = L L'; null where there is none."""

    def entry(known: Column, at: Column) -> Column:
        i, j = at["i"], at["j"]
        left = F.get(matrix, F.size(known)) - dot(_row(known, i, j), _row(known, j, j))
        pivot = F.when(left > 0, F.sqrt(left))
        below = F.try_divide(left, F.get(known, (j * (j + 3) / 2).cast("int")))
        return F.concat(known, F.array(F.when(i == j, pivot).otherwise(below)))

    return F.aggregate(_triangle(n), F.array().cast("array<double>"), entry)


def solve(lower: Column, right: Column, n: int) -> Column:
    """The solution of L L' x = right, by a forward and a backward pass."""
    none = F.array().cast("array<double>")

    def diagonal(i: Column) -> Column:
        return F.get(lower, (i * (i + 3) / 2).cast("int"))

    def down(known: Column, i: Column) -> Column:
        left = F.get(right, i) - dot(_row(lower, i, i), known)
        return F.concat(known, F.array(F.try_divide(left, diagonal(i))))

    def back(middle: Column) -> Column:
        def up(known: Column, i: Column) -> Column:
            # ``known`` holds the last coefficient first.
            below = F.transform(
                F.slice(F.reverse(_places(n)), 1, F.lit(n - 1) - i),
                lambda m: F.get(lower, (m * (m + 1) / 2).cast("int") + i),
            )
            left = F.get(middle, i) - dot(below, known)
            return F.concat(known, F.array(F.try_divide(left, diagonal(i))))

        return F.reverse(F.aggregate(F.reverse(_places(n)), none, up))

    return let(F.aggregate(_places(n), none, down), back)


def _holiday_sums(cells_: Column) -> Column:
    """n, total and n * terms of each holiday, in the order of ``HOLIDAY_NAMES``."""

    def sums(own: Column) -> Column:
        return F.struct(
            total_of(own, lambda c: c["n"]).alias("n"),
            total_of(own, lambda c: c["total"]).alias("total"),
            F.transform(
                _places(SEASONAL), lambda k: total_of(own, lambda c: c["n"] * F.get(c["x"], k))
            ).alias("x"),
        )

    return F.transform(
        _places(len(HOLIDAY_NAMES)), lambda h: let(F.filter(cells_, lambda c: c["holiday"] == h), sums)
    )


def _share(value: Column, weight: Column) -> Column:
    """A holiday that the rows lack has no weight and no effect, where no penalty gives it one."""
    return F.when(weight == 0, 0.0).otherwise(F.try_divide(value, weight))


def _coefficients(cells_: Column, holidays: Column, ridge: float) -> Column:
    """Seasonal coefficients of the equations that are left once the holidays are eliminated."""

    def product(at: Column) -> Column:
        i, j = at["i"], at["j"]
        whole = total_of(cells_, lambda c: c["n"] * F.get(c["x"], i) * F.get(c["x"], j))
        gone = total_of(
            holidays, lambda h: _share(F.get(h["x"], i) * F.get(h["x"], j), h["n"] + F.lit(ridge))
        )
        penalty = F.when((i == j) & (i > 0), ridge).otherwise(0.0)
        return whole - gone + penalty

    def right(k: Column) -> Column:
        whole = total_of(cells_, lambda c: c["total"] * F.get(c["x"], k))
        gone = total_of(
            holidays, lambda h: _share(F.get(h["x"], k) * h["total"], h["n"] + F.lit(ridge))
        )
        return whole - gone

    return let(
        F.transform(_triangle(SEASONAL), product),
        lambda matrix: let(
            cholesky(matrix, SEASONAL),
            lambda lower: let(
                F.transform(_places(SEASONAL), right), lambda sums: solve(lower, sums, SEASONAL)
            ),
        ),
    )


def _answers(cells_: Column, settings: Settings) -> Column:
    """weekly_curve, holiday_effect and loss (squared residuals less squares) of one entity."""
    per_day = 24 * 60 // settings.grid_minutes
    ridge = settings.additive_ridge

    def tabulated(beta: Column, holidays: Column) -> Column:
        effects = F.transform(
            holidays, lambda h: _share(h["total"] - dot(h["x"], beta), h["n"] + F.lit(ridge))
        )

        def loss(cell: Column, effect: Column) -> Column:
            fitted = dot(cell["x"], beta) + F.coalesce(F.get(effect, cell["holiday"]), F.lit(0.0))
            return let(fitted, lambda y: cell["n"] * y * y - F.lit(2.0) * y * cell["total"])

        return let(
            effects,
            lambda effect: F.struct(
                F.transform(
                    F.sequence(F.lit(0), F.lit(7 * per_day - 1)),
                    lambda s: dot(seasonal_terms(s.cast("double"), per_day), beta),
                ).alias("weekly_curve"),
                effect.alias("holiday_effect"),
                total_of(cells_, lambda c: loss(c, effect)).alias("loss"),
            ),
        )

    return let(
        _holiday_sums(cells_),
        lambda holidays: let(
            _coefficients(cells_, holidays, ridge), lambda beta: tabulated(beta, holidays)
        ),
    )


def fit(train: DataFrame, settings: Settings) -> DataFrame:
    """One parameter row per entity with enough rows and a solution."""
    per_day = 24 * 60 // settings.grid_minutes
    terms = seasonal_terms(F.col("week_slot").cast("double"), per_day)
    cell = F.struct("holiday", F.col("n").cast("double").alias("n"), "total", terms.alias("x"))
    held = (
        design_cells(train, settings)
        .groupBy("entity")
        .agg(
            F.sum("n").alias("n"), F.sum("squares").alias("squares"),
            # A cell per slot of the week and holiday, however many rows.
            F.collect_list(cell).alias("cells"),
        )
        .where(F.col("n") >= settings.min_train_rows)
    )
    fitted = held.withColumn("fit", let(F.col("cells"), lambda c: _answers(c, settings)))
    rss = F.greatest(F.col("squares") + F.col("fit.loss"), F.lit(0.0))
    params = fitted.select(
        "entity", "n", F.sqrt(rss / F.col("n")).alias("sigma"), "fit.weekly_curve",
        "fit.holiday_effect",
    )
    known = reduce(
        Column.__and__, [F.col("sigma").isNotNull(), ~F.isnan("sigma"),
                         F.forall("weekly_curve", lambda y: y.isNotNull() & ~F.isnan(y))]
    )
    return params.where(known)


def score(rows: DataFrame, params: DataFrame, settings: Settings) -> DataFrame:
    ts = F.col("ts_local")
    half = F.col("sigma") * F.lit(NormalDist().inv_cdf(settings.quantile_bounds[1]))
    seasonal = F.get(F.col("weekly_curve"), week_slot(ts, settings.grid_minutes))
    effect = F.get(F.col("holiday_effect"), holiday_index(F.to_date(ts)))
    return (
        with_entity(rows)
        .join(params.drop("n"), "entity", "left")
        .withColumn("yhat", seasonal + F.coalesce(effect, F.lit(0.0)))
        .withColumns({"lo": F.col("yhat") - half, "hi": F.col("yhat") + half})
        .drop("sigma", "weekly_curve", "holiday_effect")
    )
