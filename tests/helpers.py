"""Small frames for tests."""

from datetime import date, datetime, timedelta

from slotcast.config import Settings, Site, TreeParams
from slotcast.schemas import BRONZE, SILVER

SITES = (
    Site("North", 8, 22, date(2026, 1, 1)),
    Site("South", 0, 24, date(2026, 1, 1)),
    Site("Late", 8, 22, date(2026, 2, 1)),
)
SETTINGS = Settings(
    sites=SITES, excluded_sites=("Gone",), min_obs=1, min_train_rows=10, min_entities=1,
    collection_start=datetime(2025, 12, 1), trees=TreeParams(trees=4, depth=3, rate=0.4),
)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def one(df):
    return df.first()


def bronze(spark, rows):
    """Rows of (id, wait, utc text, name, site[, ingested text])."""
    data = [
        (i, w, None if t is None else at(t), 1, n, 1, p, at(rest[0] if rest else "2026-03-01"))
        for i, w, t, n, p, *rest in rows
    ]
    return spark.createDataFrame(data, BRONZE)


def silver(spark, rows):
    """Rows of (site, key, local text, wait)."""
    data = [(p, k, k.replace("_", " "), at(t), at(t) + timedelta(hours=8), float(w))
            for p, k, t, w in rows]
    return spark.createDataFrame(data, SILVER)


def seasonal_rows(days=28, units=("a", "b"), start="2026-01-05", noise=0):
    """Half-hour slots with a daily and weekly pattern; units differ in level."""
    out = []
    first = at(start)
    for d in range(days):
        for slot in range(16, 44):
            ts = first + timedelta(days=d, minutes=30 * slot)
            for u, unit in enumerate(units):
                wait = 60 - 4 * abs(ts.hour - 14) + 10 * u + (8 if ts.weekday() >= 5 else 0)
                wait += ((d * 7 + slot * 3) % 5 - 2) * noise
                out.append(("North", unit, ts.isoformat(), wait))
    return out
