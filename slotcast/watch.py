"""Counts of a run, taken from the passes that run anyway."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation


class Watch:
    """Metrics by name. A frame that is watched must be computed exactly once, by one action.

    They are sums over finished tasks: where a lost executor makes Spark compute a stage again,
    a metric can come out higher than the truth, so nothing is decided on them.
    """

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def __call__(self, df: DataFrame, name: str, **metrics: Column) -> DataFrame:
        self._seen[name] = Observation(f"{name}-{uuid.uuid4().hex}")
        return df.observe(self._seen[name], *[m.alias(n) for n, m in metrics.items()])

    def get(self, name: str) -> dict:
        """Metrics of a pass that is over; empty if nothing was watched under the name."""
        return dict(self._seen[name].get) if name in self._seen else {}


def unwatched(df: DataFrame, name: str, **metrics: Column) -> DataFrame:
    """What operators do where nobody asks for counts."""
    return df
