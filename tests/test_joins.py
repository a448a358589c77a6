import random

import pytest
from pyspark.sql import functions as F

from leadmill.functions import first_whole_day
from leadmill.operators.aggregates import conditional_distinct
from leadmill.operators.joins import disjunctive_left_join, fanout_left_join, one_to_many, range_join

from conftest import same_rows


@pytest.fixture(scope="module")
def sides(spark):
    """NULL-heavy ids; key '0' holds a third of the rows of either side."""
    rnd = random.Random(7)

    def key():
        return rnd.choice([None, "0", "0", *map(str, range(1, 5))])

    def when():
        return f"2024-01-{rnd.randint(1, 28):02d} {rnd.randint(0, 23):02d}:00:00"

    left = [(i, key(), key(), key(), when()) for i in range(120)]
    right = [(i, key(), key(), key(), when()) for i in range(90)]
    a = spark.createDataFrame(left, "id int, g string, c string, l string, t string").withColumn(
        "t", F.col("t").cast("timestamp_ntz")
    )
    b = spark.createDataFrame(right, "rid int, rg string, rc string, rl string, rt string").withColumn(
        "rt", F.col("rt").cast("timestamp_ntz")
    )
    return a, b


@pytest.fixture
def no_broadcast_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_or_of_equalities(sides):
    a, b = sides
    plain = a.join(b, (a.c == b.rc) | (a.l == b.rc), "left")
    same_rows(disjunctive_left_join(a, b, [[("c", "rc")], [("l", "rc")]]), plain)


def test_equality_and_or(sides):
    a, b = sides
    plain = a.join(b, (a.g == b.rg) & ((a.c == b.rc) | (a.l == b.rl)), "left")
    arms = [[("g", "rg"), ("c", "rc")], [("g", "rg"), ("l", "rl")]]
    same_rows(disjunctive_left_join(a, b, arms), plain)


def test_left_key_may_repeat(sides):
    a, b = sides
    plain = a.join(b, (a.c == b.rc) | (a.l == b.rl), "left")
    same_rows(disjunctive_left_join(a, b, [[("c", "rc")], [("l", "rl")]]), plain)


@pytest.mark.parametrize("days", [0, 1, 5, 30])
def test_interval(sides, days):
    a, b = sides
    inside = F.to_date(b.rt).between(F.to_date(a.t), F.date_add(F.to_date(a.t), days))
    plain = a.join(b, ((a.c == b.rc) | (a.l == b.rc)) & inside, "left")
    out = disjunctive_left_join(a, b, [[("c", "rc")], [("l", "rc")]], within_days=("rt", "t", days))
    same_rows(out, plain)
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("parts, min_rows", [(1000, 1), (4, 1), (2, 1), (1000, 3), (1000, 10_000)])
def test_fanout(sides, parts, min_rows):
    a, b = sides
    right = b.select(F.col("rc").alias("c"), "rid", "rt")
    plain = a.join(right, "c", "left")
    same_rows(fanout_left_join(a, right, "c", parts, min_rows), plain)


def test_fanout_keeps_unmatched_hot_keys(spark, sides):
    a, b = sides
    right = b.select(F.col("rc").alias("c"), "rid").where("c <> '0'")
    same_rows(fanout_left_join(a, right, "c", 10, 1), a.join(right, "c", "left"))
    everywhere = a.select("c").unionByName(right.select("c"))
    same_rows(fanout_left_join(a, right, "c", 10, 1, left_rows=everywhere), a.join(right, "c", "left"))


def test_fanout_splits_a_hot_key(spark):
    a = spark.range(400).select(F.lit("hot").alias("k"), F.col("id").alias("x"))
    b = spark.range(300).select(F.lit("hot").alias("k"), F.col("id").alias("y"))
    cells = fanout_left_join(a, b, "k", parts=8, min_rows=10)
    assert cells.count() == 400 * 300
    assert cells.select("x", "y").distinct().count() == 400 * 300


def test_one_to_many(sides, spark):
    _, b = sides
    one = spark.createDataFrame([("0", "x"), ("1", "y"), ("9", None), (None, "z")], "rc string, v string")
    plain = one.join(b, "rc", "left")
    same_rows(one_to_many(one, b, "rc"), plain)
    same_rows(one_to_many(one, b, "rc", many_keys=b.select("rc")), plain)


@pytest.fixture(scope="module")
def ranges(spark):
    data = [
        (1, "2024-01-01 00:00:00", "2024-01-03 12:00:00"), (2, "2024-01-01 10:00:00", "2024-01-03 00:00:00"),
        (3, "2024-01-05 00:00:00", None), (4, "2024-01-09 00:00:00", "2024-01-02 00:00:00"), (5, None, None),
        (6, "2030-01-01 00:00:00", "2030-01-05 00:00:00"),
    ]
    df = spark.createDataFrame(data, "id int, s string, e string")
    df = df.select("id", F.col("s").cast("timestamp_ntz").alias("s"), F.col("e").cast("timestamp_ntz").alias("e"))
    calendar = spark.sql("SELECT explode(sequence(DATE'2023-12-30', DATE'2024-01-10')) AS d").where("d <> '2024-01-02'")
    return df, calendar


@pytest.mark.parametrize("how", ["inner", "left"])
def test_range_join(ranges, how):
    df, calendar = ranges
    today = F.lit("2024-01-08").cast("date")
    inside = (df.s <= calendar.d) & (F.coalesce(df.e, today.cast("timestamp_ntz")) >= calendar.d)
    last = F.coalesce(F.to_date("e"), today)
    same_rows(
        range_join(df, "id", first_whole_day(F.col("s")), last, calendar, "d", how), df.join(calendar, inside, how)
    )


def test_conditional_distinct(sides):
    a, _ = sides
    plain = a.groupBy("g").agg(
        F.count_distinct("c").alias("all"), F.count_distinct(F.when(F.col("l") == "0", F.col("c"))).alias("zero")
    )
    same_rows(conditional_distinct(a, ["g"], "c", {"all": None, "zero": F.col("l") == "0"}), plain)


@pytest.mark.parametrize("min_rows", [3, 100_000])
def test_fanout_with_one_row_for_a_key(spark, sides, no_broadcast_joins, min_rows):
    """One row of a key with all its left and right rows, hot keys cut or not, keys without either kept."""
    a, b = sides
    one = spark.createDataFrame([(None, 0), *[(str(k), k + 1) for k in range(8)]], "c string, o int")
    left, right = a.select("id", "c"), b.select("rid", F.col("rc").alias("c"))
    plain = one.join(left, "c", "left").join(right, "c", "left").select("c", "o", "id", "rid")
    out = fanout_left_join(left, right, "c", parts=10, min_rows=min_rows, one=one)
    same_rows(out, plain)


def test_rows_that_meet_one_and_many_move_once(spark, sides, no_broadcast_joins):
    a, b = sides
    one = spark.createDataFrame([("0", 1)], "c string, o int")
    out = fanout_left_join(a.select("id", "c"), b.select("rid", F.col("rc").alias("c")), "c", one=one)
    plan = out._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "__left_a" in line]
    assert len(moved) == 1
