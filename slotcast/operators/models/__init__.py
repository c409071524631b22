"""Model families. Each one has ``fit(train)``, giving a parameter table, and
``score(rows, params)``, giving the rows with ``yhat``, ``lo`` and ``hi`` (null for an
entity the model does not know).

All families are functions of the calendar, so fits work on *cells*: one row per entity
and distinct calendar position with the count, sum and sum of squares of its rows. Cells
come from one map-side combined aggregation; an entity has as many cells as the calendar
has positions, however many rows it has.
"""

from slotcast.operators.models import additive, baseline, global_trees, local_effects

__all__ = ["additive", "baseline", "global_trees", "local_effects"]
