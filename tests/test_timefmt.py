import datetime as dt

import pytest
from pyspark.sql import functions as F

from surgewatch.functions import timefmt as TF

UTC = dt.timezone.utc
E = int(dt.datetime(2025, 8, 19, 2, 15, 23, tzinfo=UTC).timestamp())


@pytest.mark.parametrize("text,epoch", [
    ("Mon Aug 19 02:15:23 +0000 2025", E),
    ("Tue Aug 19 11:15:23 +0900 2025", E),
    ("2025-08-19T02:15:23Z", E),
    ("2025-08-19T11:15:23+09:00", E),
    ("Xyz Aug 19 02:15:23 +0000 2025", None),
    ("garbage", None),
    (None, None),
])
def test_parse_created_at(spark, text, epoch):
    df = spark.createDataFrame([(text,)], "s string")
    got = df.select(F.unix_seconds(TF.parse_created_at("s"))).first()[0]
    assert got == epoch


@pytest.mark.parametrize("text,epoch", [
    ("2025-08-19T02:15:23Z", E), ("2025-08-19T02:15:23z", E), ("2025-08-19T02:15:23", E),
    (" 2025-08-19T04:15:23+02:00 ", E), ("", None), ("not a time", None), (None, None),
])
def test_iso_to_epoch(spark, text, epoch):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(TF.iso_to_epoch("s")).first()[0] == epoch


def test_epoch_to_iso(spark):
    df = spark.createDataFrame([(E,), (0,), (None,)], "e long")
    assert [r[0] for r in df.select(TF.epoch_to_iso("e")).collect()] == [
        "2025-08-19T02:15:23+00:00", "", ""]


def test_date_to_epoch(spark):
    df = spark.createDataFrame([("2025-08-19",), ("2025-8-9",), ("2025-08-19x",), (None,)], "d string")
    midnight = int(dt.datetime(2025, 8, 19, tzinfo=UTC).timestamp())
    nine = int(dt.datetime(2025, 8, 9, tzinfo=UTC).timestamp())
    assert [r[0] for r in df.select(TF.date_to_epoch("d")).collect()] == [midnight, nine, None, None]
