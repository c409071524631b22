"""Number helpers. A missing number is NULL everywhere inside the engine, never NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def is_finite(x: Column) -> Column:
    """False for null, NaN and both infinities."""
    x = x.cast("double")
    return F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(INFINITY)), F.lit(False))


def finite_or_null(x: Column) -> Column:
    return F.when(is_finite(x), x.cast("double"))


def fmt(x: Column, digits: int = 1) -> Column:
    """Thousands separators and ``digits`` decimals; ``n/a`` where there is no finite number."""
    return F.when(is_finite(x), F.format_number(x.cast("double"), digits)).otherwise(F.lit("n/a"))


def pct(condition: Column) -> Column:
    """Share of rows, in percent, among rows where the condition is known."""
    return F.avg(F.when(condition, 1.0).when(~condition, 0.0)) * 100


def clip_low(x: Column) -> Column:
    """max(0, x), null for null (``greatest`` would turn a null into 0)."""
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def value_label(value: Column, mapping: dict[str, tuple[str, str]], default_class: str) -> Column:
    """Look a value up in a fixed map; an unknown value is its own label."""
    label, css = value, F.lit(default_class)
    for key, (text, name) in mapping.items():
        label = F.when(value == key, F.lit(text)).otherwise(label)
        css = F.when(value == key, F.lit(name)).otherwise(css)
    return F.struct(label.alias("label"), css.alias("class"))
