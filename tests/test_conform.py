from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from leadmill.operators.conform import clean, conform, dedupe_by_key, drop_unset_times, schema_report, with_partitions
from leadmill.registry import ENTITIES, key_of

from conftest import rows


def test_schema_report(spark):
    report = schema_report("t", ["COL1", "COL2"], spark.createDataFrame([("value",)], ["COL1"]))
    assert not report.ok and report.missing == ["COL2"] and report.extra == []
    assert report.to_df(spark).first().asDict() == dict(table="t", missing=["COL2"], extra=[], ok=False)
    assert schema_report("t", ["a"], spark.createDataFrame([(1, 2)], ["a", "b"])).extra == ["b"]


def test_unset_times(spark):
    times = [
        (1, "1970-01-01 00:00:00"), (2, "1970-01-01 00:00:00.5"), (3, "1970-01-01 00:00:01"),
        (4, "1969-12-31 23:59:59.5"), (5, None), (6, "2024-01-01 00:00:00"),
    ]
    df = spark.createDataFrame(times, "id int, t string")
    for dtype in ("timestamp", "timestamp_ntz"):
        typed = df.withColumn("t", F.col("t").cast(dtype))
        assert [r[0] for r in rows(drop_unset_times(typed).select("id"))] == [3, 6]
    ns = spark.createDataFrame([(1, 0), (2, 999_999_999), (3, 1_000_000_000), (4, -1), (5, None)], "id int, t bigint")
    assert [r[0] for r in rows(drop_unset_times(ns, ["t"]).select("id"))] == [3]


def test_clean_and_conform(spark):
    raw = spark.createDataFrame(
        [("1", "Acme", "12.345", 1_700_000_000_000_000_000, "x"), ("2", "Void", "n/a", 0, "y")],
        "ACCOUNT_ID string, ACCOUNT_NAME string, ANNUAL_REVENUE string, CREATED_DATE bigint, NOTE string",
    )
    spec = ENTITIES["account"]
    out = conform(spec, clean(spec, raw))
    assert out.columns == [*spec.fields, "note"]
    assert dict(out.dtypes)["annual_revenue"] == "decimal(15,2)" and dict(out.dtypes)["website"] == "string"
    (row,) = out.collect()
    assert row["annual_revenue"] == Decimal("12.35") and row["industry"] is None
    assert row["created_date"] == datetime(2023, 11, 14, 22, 13, 20)
    parted = with_partitions(spec, out)
    assert str(parted.first()["created_year"]) == "2023-01-01"


def test_dedupe_keeps_newest_and_limits_before_shuffle(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 900, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    out = dedupe_by_key(df, "k", [F.col("v").desc()])
    assert out.count() == 101 and out.where("k = 0").first()["v"] == 899
    plan = out._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_key_choice(spark):
    from pyspark.sql import types as T

    assert key_of("lead") == "lead_id"
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType(), False)])
    assert key_of("other", schema) == "b"
    assert key_of("other", T.StructType(schema.fields[:1])) == "a"
