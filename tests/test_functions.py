from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from leadmill.functions import (
    epoch_ns_to_ts,
    fact_key,
    first_date_field,
    first_whole_day,
    hour_boundaries,
    outcome_label,
    packed_key,
    parse_batch_id,
    safe_cast,
    stamp,
    strip_path_prefix,
    surrogate_key,
    unpacked_key,
    zero_safe_ratio,
)
from leadmill.functions.times import calendar_parts


def one(spark, column, **values):
    df = spark.range(1)
    for name, (value, dtype) in values.items():
        df = df.withColumn(name, F.lit(value).cast(dtype))
    return df.select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-05-31_123456", datetime(2025, 5, 31, 12, 34, 56)),
        ("bad_format", None),
        ("2025-02-30_000000", None),
        ("2025-05-31_1234567", None),
        (None, None),
    ],
)
def test_batch_id(spark, text, expected):
    assert one(spark, parse_batch_id(F.col("b")), b=(text, "string")) == expected


def test_safe_cast_adds_absent_column(spark):
    df = safe_cast(spark.createDataFrame([("123",)], ["col1"]), "col2", "int")
    assert dict(df.dtypes)["col2"] == "int"
    assert df.first()["col2"] is None


@pytest.mark.parametrize(
    "text, dtype, expected",
    [
        ("123", "int", 123),
        ("-5", "int", 5),
        ("1,234 pcs", "int", 1234),
        ("", "int", None),
        ("abc", "int", None),
        ("99999999999", "int", None),
        ("-1.5e3", "float", pytest.approx(1.53)),
        ("1.2.3", "float", None),
        ("2024-02-30", "date", None),
        ("2024-02-29", "date", date(2024, 2, 29)),
    ],
)
def test_safe_cast(spark, text, dtype, expected):
    df = safe_cast(spark.createDataFrame([(text,)], "col1 string"), "col1", dtype)
    assert dict(df.dtypes)["col1"] == dtype
    assert df.first()["col1"] == expected


@pytest.mark.parametrize(
    "ns, expected",
    [
        (1_700_000_000_123_456_789, datetime(2023, 11, 14, 22, 13, 20, 123456)),
        (0, datetime(1970, 1, 1)),
        (-1, datetime(1969, 12, 31, 23, 59, 59, 999999)),
        (None, None),
    ],
)
def test_epoch_ns(spark, ns, expected):
    assert one(spark, epoch_ns_to_ts(F.col("n")), n=(ns, "bigint")) == expected


def test_epoch_ns_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert one(spark, epoch_ns_to_ts(F.col("n")), n=(0, "bigint")) == datetime(1970, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_surrogate_keys(spark):
    import hashlib

    null = "_dbt_utils_surrogate_key_null_"
    values = dict(a=("x", "string"), b=(None, "string"), d=("2024-01-02", "date"))
    assert one(spark, surrogate_key("a"), **values) == hashlib.md5(b"x").hexdigest()
    assert one(spark, surrogate_key("a", "b", "d"), **values) == hashlib.md5(
        f"x-{null}-2024-01-02".encode()
    ).hexdigest()
    assert one(spark, fact_key("a", "b", "a"), **values) == hashlib.md5(b"xx").hexdigest()


def test_hour_boundaries(spark):
    def hours(a, b):
        return one(spark, hour_boundaries(F.col("a"), F.col("b")), a=(a, "timestamp_ntz"), b=(b, "timestamp_ntz"))

    assert hours("2024-01-01 10:59:59", "2024-01-01 11:00:00") == 1
    assert hours("2024-01-01 10:00:00", "2024-01-01 10:59:59") == 0
    assert hours("2024-01-02 01:00:00", "2024-01-01 23:00:00") == -2


def test_calendar_parts(spark):
    parts = calendar_parts(F.lit("2024-12-30").cast("date"))
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first().asDict()
    assert row == dict(year=2024, month=12, day=30, day_of_week=1, day_of_year=365, quarter=4, week_of_year=1)
    sunday = calendar_parts(F.lit("2024-12-29").cast("date"))["day_of_week"]
    assert one(spark, sunday) == 0


def test_first_whole_day(spark):
    assert one(spark, first_whole_day(F.col("t")), t=("2024-01-01 00:00:00", "timestamp_ntz")) == date(2024, 1, 1)
    assert one(spark, first_whole_day(F.col("t")), t=("2024-01-01 10:00:00", "timestamp_ntz")) == date(2024, 1, 2)


def test_first_date_field(spark):
    df = spark.createDataFrame([(1, 0, 5)], "id int, CLOSE_DATE bigint, open_date bigint")
    out = df.select(first_date_field(df))
    assert out.columns == ["close_date_ts"] and out.first()[0] == datetime(1970, 1, 1)
    none = df.select("id")
    assert none.select(first_date_field(none)).columns == ["generic_date_ts"]


def test_values(spark):
    ratio = zero_safe_ratio(F.col("a"), F.col("b"))
    assert one(spark, ratio, a=(1, "int"), b=(4, "int")) == 0.25
    assert one(spark, ratio, a=(1, "int"), b=(0, "int")) is None
    assert one(spark, ratio, a=(1, "int"), b=(None, "int")) is None
    label = outcome_label(F.col("o"), F.col("l"), F.col("c"))
    s = "string"
    assert one(spark, label, o=("1", s), l=("1", s), c=("1", s)) == "Has Opportunity"
    assert one(spark, label, o=(None, s), l=("1", s), c=("1", s)) == "Has Lead"
    assert one(spark, label, o=(None, s), l=(None, s), c=("1", s)) == "Has Contact"
    assert one(spark, label, o=(None, s), l=(None, s), c=(None, s)) == "No Link"
    assert one(spark, strip_path_prefix(F.col("p"), "s3://b/"), p=("s3://b/x/y", s)) == "x/y"
    assert one(spark, stamp(datetime(2024, 1, 2, 3, 4, 5, 6))) == datetime(2024, 1, 2, 3, 4, 5, 6)


def test_packed_keys_come_back(spark):
    """Keys that hash their id travel as nothing; any other, and NULL, as they are."""
    df = spark.createDataFrame([("1", None), ("2", ""), ("3", "=x"), ("4", "odd"), (None, None)], "id string, own string")
    for key in (F.col("own"), surrogate_key("id")):
        rows = df.withColumn("sk", key).withColumn("p", packed_key("sk", "id")).withColumn("back", unpacked_key("p", "id"))
        assert rows.where("NOT sk <=> back").count() == 0
    assert {r["p"] for r in rows.collect()} == {""}
