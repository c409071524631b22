import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slotcast.functions import clock, holidays, numbers, text
from slotcast.operators import features as fe
from tests.helpers import at

ZONE = "America/Los_Angeles"


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_to_local(spark):
    assert value(spark, clock.to_local(clock.naive(at("2026-01-01")), ZONE)) == at("2025-12-31T16:00")


@pytest.mark.parametrize(
    ("local", "utc"),
    [
        ("2025-11-02T01:30", "2025-11-02T08:30"),  # happens twice: the first time
        ("2026-03-08T02:30", "2026-03-08T10:00"),  # never happens: the first valid instant
        ("2026-03-08T03:00", "2026-03-08T10:00"),
        ("2026-07-01T12:00", "2026-07-01T19:00"),
        ("2026-01-01T12:00", "2026-01-01T20:00"),
    ],
)
def test_to_utc(spark, local, utc):
    assert value(spark, clock.to_utc(clock.naive(at(local)), ZONE)) == at(utc)


def test_utc_instant(spark):
    assert value(spark, clock.utc_instant(F.lit("2026-01-01 05:00:00-03:00"))) == at("2026-01-01T08:00")
    assert value(spark, clock.utc_instant(F.lit("2026-01-01 05:00:00"))) == at("2026-01-01T05:00")
    assert value(spark, clock.utc_instant(F.lit("soon"))) is None


@pytest.mark.parametrize(
    ("name", "key"),
    [
        ("Lil’ Café™ ²x_é-–", "Lil_Café_²x_é-"),
        (None, ""), ("0", "0"), ("a  b", "a_b"), ("a - b", "a_-_b"), ("™ ®", ""),
        (" x ", "x"), ("a\tb", "a\tb"), ("_ _", "_"),
    ],
)
def test_canonical_key(spark, name, key):
    assert value(spark, text.canonical_key(F.lit(name).cast("string"))) == key


@pytest.mark.parametrize("char", ["\U0001d2c0", "\U00010d40", "\U0001e5d0"])
def test_key_keeps_characters_newer_than_the_jvm(spark, char):
    assert value(spark, text.canonical_key(F.lit(f"{char} ride!"))) == f"{char}_ride"
    assert value(spark, text.has_key(F.lit(char)))


NAMES = st.lists(
    st.text(st.characters(codec="utf-8", exclude_categories=["Cs", "Cn", "Co"], exclude_characters="\x00"),
            max_size=12),
    min_size=1, max_size=60,
)


@settings(max_examples=12, deadline=None, derandomize=True)
@given(NAMES)
def test_key_and_strip_agree_with_python(spark, names):
    # Only characters that the oldest Unicode version at hand knows, in the class it still has.
    old = unicodedata.ucd_3_2_0.category
    names = ["".join(c for c in n if old(c) == unicodedata.category(c)) for n in names]
    names = [n for n in names if n]
    if not names:
        return
    rows = spark.createDataFrame([(n,) for n in names], "n string").select(
        "n", text.strip(F.col("n")).alias("s"), text.canonical_key(F.col("n")).alias("k"),
        text.has_key(F.col("n")).alias("h"),
    ).collect()
    for r in rows:
        assert r["s"] == r["n"].strip()
        kept = "".join(
            c for c in r["n"]
            if c in "_-" or c.isspace() or unicodedata.category(c)[0] in "LN"
        )
        assert r["k"] == re.sub("_+", "_", kept.strip().replace(" ", "_"))
        assert r["h"] == (r["k"] != "")


def test_entity(spark):
    e = text.entity(F.lit("North Park"), F.lit("x_1"))
    assert value(spark, e) == "North_Park::x_1"
    assert value(spark, text.entity_filename(e)) == "North_Park__x_1.json"


@pytest.mark.parametrize(
    ("x", "shown"),
    [(None, "n/a"), (float("nan"), "n/a"), (float("-inf"), "n/a"), (1234.56, "1,234.6"), (0.0, "0.0")],
)
def test_fmt(spark, x, shown):
    assert value(spark, numbers.fmt(F.lit(x).cast("double"))) == shown


def test_shorten(spark):
    assert value(spark, text.shorten(F.lit("x" * 28))) == "x" * 28
    assert value(spark, text.shorten(F.lit("x" * 29))) == "x" * 27 + "…"


def test_labels(spark):
    ts = clock.naive(at("2026-01-03T07:05:09"))
    assert value(spark, clock.day_label(ts)) == "Jan 03"
    assert value(spark, clock.hour_label(F.hour(ts))) == "07:00"
    assert value(spark, clock.minute_label(ts)) == "2026-01-03 07:05"
    assert value(spark, clock.run_id(ts)) == "20260103T070509Z"


def test_calendar_weekend(spark):
    parts = fe.calendar(clock.naive(at("2026-01-03T10:30")))
    assert value(spark, parts["dayofweek"]) == 5
    assert value(spark, parts["is_weekend"]) == 1


@pytest.mark.parametrize(
    ("day", "name"),
    [
        ("2026-11-26", "Thanksgiving Day"), ("2026-05-25", "Memorial Day"),
        ("2026-07-03", "Independence Day (observed)"), ("2026-07-04", "Independence Day"),
        ("2021-12-31", "New Year's Day (observed)"), ("2023-01-02", "New Year's Day (observed)"),
        ("2020-06-19", None), ("2021-06-18", "Juneteenth National Independence Day (observed)"),
        ("2024-01-15", "Martin Luther King Jr. Day"), ("2024-02-19", "Washington's Birthday"),
        ("2024-09-02", "Labor Day"), ("2024-10-14", "Columbus Day"), ("2024-10-15", None),
    ],
)
def test_holidays(spark, day, name):
    date = F.lit(day).cast("date")
    assert value(spark, holidays.holiday_name(date)) == name
    assert value(spark, holidays.is_holiday(date)) == int(name is not None)
    index = value(spark, holidays.holiday_index(date))
    assert (holidays.HOLIDAY_NAMES[index] if index is not None else None) == name
