from datetime import datetime

import pytest
from pyspark.sql import functions as F

from roentra.functions import identity, messages, scores, times


def values(spark, rows, ddl, expr):
    df = spark.createDataFrame([(r,) for r in rows], ddl)
    return [r[0] for r in df.select(expr).collect()]


def test_pseudonym(spark):
    out = values(
        spark, ["patient-123", "patient-123", "patient-456", "", None], "x string",
        identity.pseudonym(F.col("x")),
    )
    assert out[0] == out[1] == "1985450135cd5118"
    assert out[2] != out[0] and "patient" not in out[2]
    assert out[3] is None and out[4] is None


@pytest.mark.parametrize(
    "text,bucket",
    [
        ("51", "50-59"), ("38", "30-39"), ("9", "0-9"), ("100", "100-109"), ("", "UNKNOWN"),
        (None, "UNKNOWN"), ("abc", "UNKNOWN"), ("51.7", "UNKNOWN"), (" 51 ", "50-59"),
        ("+51", "50-59"), ("-5", "-10--1"), ("5_1", "50-59"), ("_51", "UNKNOWN"),
        ("99999999999999999999", "UNKNOWN"),
    ],
)
def test_age_bucket(spark, text, bucket):
    assert values(spark, [text], "x string", identity.age_bucket(F.col("x"))) == [bucket]


def test_age_tag(spark):
    out = values(
        spark, ["051Y", "051YY", "006M", "", None], "x string",
        identity.age_number_text(F.col("x")),
    )
    assert out == ["051", "051", "006M", None, None]


def test_file_names(spark):
    paths = ["raw/a.dcm", "a.dcm.dcm", "/x/y/b.DCM", "a.dcmx"]
    out = values(spark, paths, "x string", identity.image_key(F.col("x")))
    assert out == ["a", "a", "b.DCM", "ax"]
    joined = values(spark, ["a.dcm"], "x string", identity.join_path("raw/", F.col("x")))
    assert joined == ["raw/a.dcm"]
    swapped = values(spark, ["a.dcm"], "x string", identity.swap_suffix(F.col("x"), ".dcm", ".png"))
    assert swapped == ["a.png"]


def test_bucket_lower_bound(spark):
    out = values(
        spark, ["150-159", "UNKNOWN", None, "-10--1", "0-9"], "x string",
        identity.bucket_lower_bound(F.col("x")),
    )
    assert out == [150, None, None, None, 0]


@pytest.mark.parametrize(
    "text,event",
    [
        ('{"patient_id":"p","n":1.5}', {"patient_id": "p", "n": "1.5"}),
        ('{"patient_id":null}', {"patient_id": None}),
        (' {"a":{"b":[1]}} ', {"a": '{"b":[1]}'}),
        ("{}", {}),
        ('{"patient_id":1} xyz', None),
        ('{"patient_id":1}{"x":1}', None),
        ('{"patient_id":1}] [{"a":1}', None),
        ('{"patient_id":1}} {"a":{}', None),
        ('{"patient_id":1,"tags":["]"]}', {"patient_id": "1", "tags": '["]"]'}),
        ('{"a":1},{"b":2}', None),
        ('{"patient_id":1', None),
        ("{'patient_id':1}", None),
        ("[1,2]", None), ("null", None), ("1", None), ('"s"', None), ("", None), (None, None),
    ],
)
def test_json_object(spark, text, event):
    assert values(spark, [text], "x string", messages.json_object(F.col("x"))) == [event]


def test_payload_text_rejects_bad_utf8(spark):
    out = values(
        spark, [bytearray(b"ok"), bytearray(b"\xff\xfe")], "x binary",
        messages.payload_text(F.col("x")),
    )
    assert out == ["ok", None]


def test_times(spark):
    ts = [datetime(2024, 1, 2, 3, 4, 5, 6)]
    assert values(spark, ts, "x timestamp_ntz", times.iso_utc(F.col("x"))) == [
        "2024-01-02T03:04:05.000006+00:00"
    ]
    assert values(spark, ts, "x timestamp_ntz", times.minute_label(F.col("x"))) == ["2024-01-02 03:04"]
    row = spark.range(1).select(
        times.utc_now().alias("now"), times.epoch_seconds_now().alias("epoch"),
        F.unix_micros(F.current_timestamp()).alias("micros"),
    ).first()
    assert abs(int(row["epoch"] * 1_000_000) - row["micros"]) < 1
    from datetime import UTC
    assert abs((datetime.now(UTC).replace(tzinfo=None) - row["now"]).total_seconds()) < 60


def test_utc_now_ignores_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        row = spark.range(1).select(times.iso_utc(times.utc_now()).alias("t")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    from datetime import UTC
    stamp = datetime.fromisoformat(row["t"])
    assert abs((datetime.now(UTC) - stamp).total_seconds()) < 60


def test_softplus_is_stable(spark):
    out = values(spark, [-1000.0, 0.0, 1000.0], "x double", scores.softplus(F.col("x")))
    assert out == [0.0, pytest.approx(0.6931471805599453), 1000.0]
