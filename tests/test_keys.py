"""Conformed keys: boundaries and the rule that no key is ever null."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from millgauge.functions import keys
from millgauge.operators.production import conform
from millgauge.schemas import PAYLOAD
from millgauge.sources import seeds
from millgauge.operators import dimensions

UTC = dt.timezone.utc


def reading(spark, at="2026-08-10 09:30", temperature=60.0, status="RUNNING", machine="M-101"):
    when = dt.datetime.fromisoformat(at).replace(tzinfo=UTC)
    return spark.createDataFrame([(machine, when, temperature, 12.5, 1.2, status, 10, 10)], PAYLOAD)


@pytest.fixture
def dims(spark):
    return dimensions.load_machines(seeds.machine_master(spark)), seeds.statuses(spark)


@pytest.mark.parametrize("version", ["as_of", "current"])
@pytest.mark.parametrize("clock,shift", [("05:59", 3), ("06:00", 1), ("13:59", 1), ("14:00", 2), ("21:59", 2),
                                         ("22:00", 3), ("00:00", 3)])
def test_shift(spark, dims, clock, shift, version):
    row = conform(reading(spark, f"2026-08-10 {clock}"), *dims, version=version).first()
    assert row.shift_key == shift


def test_date_and_time_key(spark, dims):
    row = conform(reading(spark), *dims).first()
    assert (row.date_key, row.time_key) == (20260810, 570)


def test_unknown_members(spark, dims):
    row = conform(reading(spark, machine="M-999", status="ODD"), *dims).first()
    assert (row.machine_key, row.status_key) == (-1, -1)
    row = conform(reading(spark, status=None), *dims).first()
    assert row.status_key == -1 and row.machine_key != -1


def test_status_ignores_case(spark, dims):
    assert conform(reading(spark, status="running"), *dims).first().status_key == 1


@pytest.mark.parametrize("temperature,flag", [(60.0, 1), (150.0, 1), (150.1, 2), (-20.0, 1), (-20.1, 2), (None, 1)])
def test_flags(spark, dims, temperature, flag):
    assert conform(reading(spark, temperature=temperature), *dims).first().flags_key == flag


def test_payload_contract():
    required = {f.name for f in PAYLOAD.fields if not f.nullable}
    assert required == {"machine_id", "event_time"}


def test_dimension_sizes(spark):
    assert dimensions.dim_date(spark).count() == 4018
    assert dimensions.dim_time(spark).count() == 1440
    assert seeds.statuses(spark).count() == 7
    assert seeds.reading_flags(spark).select("is_outlier", "is_backfilled", "is_estimated").distinct().count() == 8


def test_no_two_lists_of_parts_share_a_key(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), ("a", ""), ("\\N", "a"), (None, None), ("a\\", "b"), ("a", "\\b"), ("a\\|b", "c")]
    df = spark.createDataFrame(rows, "x string, y string")
    found = df.select(keys.hashed_key(F.col("x"), F.col("y")).alias("k")).collect()
    assert len({r.k for r in found}) == len(rows)
