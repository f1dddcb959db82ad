from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings, strategies as st

from corpuslake.operators.timestamps import _days, compiled, instants, normalise

import numpy as np
import pyarrow as pa

PLAIN, CAPTURE = compiled(False), compiled(True)


def us(*a):
    return int(datetime(*a, tzinfo=timezone.utc).timestamp() * 1e6)


def one(text, zone=None, before=None, capture=False):
    zones = pa.array([zone]) if zone else None
    end = pa.array([before], pa.timestamp("us", "UTC")) if before else None
    return instants(pa.array([text]), zones, end, CAPTURE if capture else PLAIN, capture).to_pylist()[0]


@pytest.mark.parametrize(
    "text, want",
    [
        ("2024-07-04T07:48:52.968472+00:00", us(2024, 7, 4, 7, 48, 52, 968472)), ("2024-03-03T06:09:45Z", us(2024, 3, 3, 6, 9, 45)),
        ("2023-09-13T22:38:20.839149974Z", us(2023, 9, 13, 22, 38, 20, 839149)), ("Sun, 24 Dec 2023 22:28:44 GMT", us(2023, 12, 24, 22, 28, 44)),
        ("Dec 11, 2023 8:55:38 PM EST", us(2023, 12, 12, 1, 55, 38)), ("1737018574", 1737018574000000), ("1734554414472", 1734554414472000),
        ("1738733350409373", 1738733350409373), ("1727307737.237", 1727307737237000), ("20240605T123803Z", us(2024, 6, 5, 12, 38, 3)),
        ("2023-05-17T07:42:18,323Z", us(2023, 5, 17, 7, 42, 18, 323000)), ("2024-01-04T13:26:29-05:00[America/New_York]", us(2024, 1, 4, 18, 26, 29)),
        (" 2024-01-08 05:30:19 -0800 ", us(2024, 1, 8, 13, 30, 19)), ("2024-02-30T07:15:00Z", None), ("2024-01-01 24:00:00Z", None),
        ("13/01/2024 01:00:00 AM", None), ("", None), ("  ", None), (None, None), ("see log", None), ("2024-01-01", None), ("2024-01-01T01:00:00XYZ", None),
    ],
)
def test_formats(text, want):
    assert one(text, "UTC") == want


def test_local_clock_changes():
    ny = "America/New_York"
    assert one("2024-03-10 02:30:00", ny) is None  # skipped
    assert one("11/03/2024 01:30:00 AM", ny) == us(2024, 11, 3, 5, 30)  # the first
    late = datetime(2024, 11, 3, 6, 40, tzinfo=timezone.utc)
    assert one("2024-11-03 01:30:00", ny, late) == us(2024, 11, 3, 6, 30)
    assert one("2024-11-03 01:30:00", ny, late + timedelta(hours=2)) == us(2024, 11, 3, 5, 30)
    assert one("2024-07-01 12:00:00", "Nowhere/None") is None
    assert one("4/9/2024 12:05 AM", ny) == us(2024, 4, 9, 4, 5)


@pytest.mark.parametrize("text, want", [("20211119", us(2021, 11, 19)), ("202308121736", us(2023, 8, 12, 17, 36)), ("2021", us(2021, 1, 1)), ("20231231256000", None), ("1712359866", 1712359866000000)])
def test_captures(text, want):
    assert one(text, capture=True) == want


@given(st.dates())
def test_days(day):
    a = [np.array([x]) for x in (day.year, day.month, day.day)]
    assert _days(*a)[0] == (day - datetime(1970, 1, 1).date()).days


@settings(max_examples=200)
@given(st.text(max_size=40))
def test_any_text_is_taken(text):
    one(text, "UTC")
    one(text, capture=True)


def test_frame(spark):
    df = spark.createDataFrame([(1, "2024-01-01T00:00:00Z", "x"), (1, "2024-01-01T00:00:00Z", "x"), (None, None, None)], "id int, v string, micros string")
    got = normalise(df, "v", "out")
    assert [tuple(r) for r in got.orderBy("id").collect()][1:] == [(1, "2024-01-01T00:00:00Z", "x", 1704067200000000)] * 2
    assert normalise(df.limit(0), "v", "out").count() == 0
    with pytest.raises(ValueError):
        normalise(df, "v", "micros")
