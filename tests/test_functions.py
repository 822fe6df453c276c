import datetime as dt
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from lakeloom.functions import events as ev, shaping
from pyspark.sql import functions as F
from tests.conftest import rows_of

MOMENT = dt.datetime(2024, 2, 1)


def test_match_column_ignores_case(spark):
    df = spark.createDataFrame([(1, 2)], "VendorID int, tipAmount int")
    assert shaping.match_column(df, "vendorid") == "VendorID"
    assert shaping.match_column(df, "absent") is None


def test_canonical_columns_rename_and_report(spark):
    df = spark.createDataFrame([(1, 2)], "VENDORID int, other int")
    assert shaping.canonical_columns(df, ["vendorID"]).columns == ["vendorID", "other"]
    with pytest.raises(ValueError, match="pickup"):
        shaping.canonical_columns(df, ["vendorID", "pickup"])


def test_conform_types_nulls_and_defaults(spark):
    df = spark.createDataFrame([("7", "x"), (None, "2.5")], "sequence string, temperatureC string")
    out = shaping.conform(df, {"sequence": "bigint", "temperatureC": "double", "status": "string"},
                          defaults={"sequence": F.lit(-1)})
    assert out.dtypes == [("sequence", "bigint"), ("temperatureC", "double"), ("status", "string")]
    assert rows_of(out) == [(-1, 2.5, None), (7, None, None)]


def test_malformed_json_keeps_the_event(spark):
    df = spark.createDataFrame(
        [(bytearray(b"{oops"), MOMENT, "5", 5, "0"), (bytearray(b'{"sequence": 3, "deviceId": "a"}'), MOMENT, "6", 6, "0")],
        "body binary, enqueuedTime timestamp, offset string, sequenceNumber bigint, partition string",
    )
    out = ev.decode_envelope(df, MOMENT).select("sequence", "deviceId", "offset", "partitionId")
    assert rows_of(out) == [(3, "a", "6", "0"), (None, None, "5", "0")]


@pytest.mark.parametrize("text,expected", [
    ("2024-01-01T10:00:00.123456+00:00", dt.datetime(2024, 1, 1, 10, 0, 0, 123456)),
    ("2024-01-01T10:00:00.123Z", dt.datetime(2024, 1, 1, 10, 0, 0, 123000)),
    ("2024-01-01 10:00:00", dt.datetime(2024, 1, 1, 10)),
    ("", None), ("soon", None), (None, None),
])
def test_event_time_forms(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").select(ev.event_time("t").cast("timestamp_ntz"))
    assert df.first()[0] == expected


def _identified(spark, rows, strict=False):
    df = spark.createDataFrame(rows, "partitionId string, offset string, deviceId string, timestamp string, sequence bigint")
    return [row[0] for row in df.select(ev.event_id(strict)).collect()]


def test_event_id_values(spark):
    bus, batch = _identified(spark, [("1", "9", "d", "t", 3), (None, "9", "d", "t", 3)])
    assert bus == hashlib.sha256(b"eh||1||9").hexdigest()
    assert batch == hashlib.sha256(b"batch||d||t||3").hexdigest()


def test_strict_event_id_separates_missing_parts(spark):
    rows = [(None, None, "x", None, 1), (None, None, None, "x", 1), (None, None, None, None, None)]
    loose = _identified(spark, rows)
    strict = _identified(spark, rows, strict=True)
    assert loose[0] == loose[1] and None not in loose
    assert strict[0] != strict[1] and strict[2] is None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet=" abZ", max_size=6))
def test_normalized_matches_python(spark, text):
    df = spark.createDataFrame([(text, text)], "a string, b string")
    assert tuple(shaping.normalized(df, trims=["a"], uppers=["b"]).first()) == (text.strip(" "), text.strip(" ").upper())


def test_random_ids(spark):
    guids = [row[0] for row in spark.range(50).select(shaping.row_guid()).collect()]
    assert len(set(guids)) == 50 and all(len(guid) == 36 for guid in guids)
    assert shaping.new_run_id() != shaping.new_run_id()


def test_default_load_time_is_the_clock(spark):
    before = dt.datetime.now() - dt.timedelta(minutes=1)
    assert spark.range(1).select(shaping.load_time()).first()[0] > before


def test_run_scope(spark):
    df = shaping.with_run_lineage(spark.range(2), "s", "r1", MOMENT).unionByName(
        shaping.with_run_lineage(spark.range(3), "s", "r2", MOMENT))
    assert shaping.scoped_to_run(df, "r2").count() == 3
    assert shaping.scoped_to_run(df, None).count() == 5
