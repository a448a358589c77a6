"""Key checks of facts."""

import pytest

from leadmill.operators import quality
from leadmill.operators.quality import FACT_KEYS, key_checks, packed_hex
from pyspark.sql import functions as F

HEX = "0123456789abcdef" * 2
KEYS = [None, None, "", "a", "a", "0a", "0A", "0A", HEX, HEX, HEX, HEX.upper(), HEX[:-1], "zz" * 16, " " + HEX]


@pytest.mark.parametrize("fact", sorted(FACT_KEYS))
def test_keys_of_any_form(spark, fact):
    rows = spark.createDataFrame([(k,) for k in KEYS], f"{FACT_KEYS[fact]} string")
    assert [tuple(r) for r in key_checks({fact: rows}).collect()] == [(fact, len(KEYS), 2, 3)]
    unique = rows.distinct().where(f"{FACT_KEYS[fact]} IS NOT NULL")
    assert [tuple(r) for r in key_checks({fact: unique}).collect()] == [(fact, 9, 0, 0)]
    assert [tuple(r) for r in key_checks({fact: rows.limit(0)}).collect()] == [(fact, 0, 0, 0)]


def test_hashes_that_repeat_are_settled_by_keys(spark, monkeypatch):
    rows = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "lead_sk string")
    monkeypatch.setattr(F, "xxhash64", lambda c: F.lit(1).cast("bigint"))
    got = key_checks({"fct_lead_to_opportunity_conversion": rows}).collect()
    assert [tuple(r) for r in got] == [("fct_lead_to_opportunity_conversion", 4, 0, 1)]


def test_unique_keys_are_told_by_their_hashes(spark, monkeypatch):
    """No key, which is four times as long, is dealt where no hash repeats."""
    monkeypatch.setattr(quality, "packed_hex", None)
    rows = spark.range(50).selectExpr("md5(CAST(id AS STRING)) AS daily_performance_sk")
    assert [tuple(r) for r in key_checks({"fct_daily_performance": rows}).collect()] == [("fct_daily_performance", 50, 0, 0)]


def test_packed_hex_is_half_as_long_and_keeps_keys_apart(spark):
    packed, other = packed_hex(F.col("k"))
    rows = spark.createDataFrame([(k,) for k in KEYS], "k string").select("k", packed.alias("p"), other.alias("o"))
    assert rows.where(F.col("k") == HEX).select(F.length("p"), "o").distinct().collect() == [(16, None)]
    assert rows.select("p", "o").distinct().count() == rows.select("k").distinct().count()
    assert rows.where("k IS NOT NULL AND p IS NULL AND o IS NULL").count() == 0
