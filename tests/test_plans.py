"""Plans: no nested loops, no cross products, filters and columns down at the scans."""

import re

import pytest
from pyspark.sql import functions as F

import leadmill.workload.flow_queries  # noqa: F401 - registers its queries and those it builds on
from leadmill.operators.conform import clean
from leadmill.operators.watermarks import newer_than
from leadmill.registry import ENTITIES
from leadmill.workload.queries import QUERIES, Tables
from test_oracle import DIR

WITH_HOT_KEYS = {"fact_marketing_performance", "fct_daily_performance", "fanout_left_join", "dq_keys", "dq_columns"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"stream_ingest", "schema_report_per_batch"}))
def test_no_nested_loops(spark, no_broadcast, name):
    """With tables too big to broadcast, every join is still an equi join."""
    plan = plan_of(QUERIES[name](spark, DIR))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    for line in plan.splitlines():
        if "BroadcastExchange" in line:
            # The calendar, and lists of hot keys whose length is bounded by their definition.
            assert "input[0, date, " in line or name in WITH_HOT_KEYS
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_epoch_filter_reaches_the_scan(spark, tmp_path):
    data = spark.sql(
        "SELECT '1' AS account_id, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS created_date, 'x' AS industry"
    )
    data.write.parquet(str(tmp_path / "t"))
    plan = plan_of(clean(ENTITIES["account"], spark.read.parquet(str(tmp_path / "t"))))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(created_date", plan)


def test_watermark_reaches_the_scan(spark, tmp_path):
    data = spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS last_modified_timestamp")
    data.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(newer_than(table, table))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(last_modified_timestamp,ScalarSubquery", plan)


def test_models_read_only_the_columns_they_use(spark):
    plan = plan_of(Tables(spark, DIR)("marketing.dim_contact_engagement").select("contact_id", "total_engagements"))
    events = [line for line in plan.splitlines() if "events.parquet" in line]
    assert events and all("props" not in line and "value" not in line for line in events)


def test_distinct_counts_do_not_copy_the_input(spark):
    for name in ("dim_campaign_performance", "dim_contact_engagement", "fct_campaign_performance", "conditional_distinct"):
        assert "Expand" not in plan_of(QUERIES[name](spark, DIR)), name


@pytest.mark.parametrize("name", ["disjunctive_left_join", "equi_or_join", "interval_or_join"])
def test_either_or_joins_have_no_matches_on_the_right(spark, no_broadcast, name):
    """Spark cannot split a hot key on the right of a left join."""
    plan = plan_of(QUERIES[name](spark, DIR))
    assert "LeftOuter" not in plan and "LeftAnti" in plan


def test_days_are_not_gathered(spark):
    assert "collect_list" not in plan_of(QUERIES["fct_daily_performance"](spark, DIR))


def test_sides_of_many_rows_are_not_broadcast(spark, tmp_path):
    """A small compressed file can hold a million keys, which are large as text."""
    spark.range(1_500_000).write.parquet(str(tmp_path / "ids"))
    ids = spark.read.parquet(str(tmp_path / "ids")).selectExpr("CAST(id AS STRING) AS k")
    plan = plan_of(ids.join(ids.withColumnRenamed("k", "other"), F.col("k") == F.col("other"), "left"))
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_checks_of_facts_share_no_plan(spark):
    plan = plan_of(QUERIES["dq_keys"](spark, DIR))
    assert "Exchange" not in plan and "Scan parquet" not in plan


def test_counting_a_fact_leaves_out_what_it_does_not_need(spark, no_broadcast):
    """The rows of the daily fact depend on keys alone; no engagement has to be summed up to count them."""
    plan = plan_of(Tables(spark, DIR)("marketing.fct_daily_performance").groupBy().count())
    assert "events.parquet" not in plan


def test_event_rows_meet_their_engagements_once(spark, no_broadcast):
    """No list of an event's distances is made to be joined back to the event's rows."""
    from leadmill.plans.models import FACT_MODELS
    from leadmill.workload.views import AS_OF

    t = Tables(spark, DIR)
    outcome, engagement = (t(f"marketing.{n}").limit(100) for n in ("dim_event_outcome", "dim_email_engagement"))
    outcome.write.mode("overwrite").saveAsTable("plan_outcome")
    engagement.write.mode("overwrite").saveAsTable("plan_engagement")
    inputs = {"dim_event_outcome": spark.table("plan_outcome"), "dim_email_engagement": spark.table("plan_engagement")}
    plan = plan_of(FACT_MODELS["fct_event_performance"].build(**inputs, as_of=AS_OF))
    for name in ("plan_outcome", "plan_engagement"):
        spark.sql(f"DROP TABLE {name}")
    assert plan.count("SortMergeJoin") == 1


def test_inputs_linked_by_the_driving_key_are_cut_by_the_keys(spark):
    from leadmill.operators.watermarks import restrict_inputs
    from leadmill.plans.models import FACT_MODELS

    inputs = {
        "dim_event_outcome": spark.createDataFrame([("e1", 1), ("e2", 2)], "event_id string, driving_row int"),
        "dim_email_engagement": spark.createDataFrame([("e1",), ("e2",), (None,)], "campaign_name string"),
    }
    out = restrict_inputs(FACT_MODELS["fct_event_performance"], inputs, spark.createDataFrame([("e2",)], "event_id string"))
    assert out["dim_email_engagement"]._jdf.queryExecution().analyzed().toString().count("driving_row") == 0
    assert [r[0] for r in out["dim_email_engagement"].collect()] == ["e2"]


def test_inputs_that_point_at_the_same_columns_are_looked_up_at_once(spark, no_broadcast):
    """Four inputs point at a send's campaign, and five at an engagement's send: one semi join for each list."""
    from leadmill.operators.watermarks import affected_keys
    from leadmill.plans.models import FACT_MODELS

    spec, t = FACT_MODELS["fact_marketing_performance"], Tables(spark, DIR)
    inputs = {name: t(ref) for name, ref in spec.inputs.items()}
    plan = affected_keys(spec, inputs, inputs)._jdf.queryExecution().optimizedPlan().toString()
    # The sends' campaigns, and the engagements' sends, contacts and leads' contacts.
    assert plan.count("Join LeftSemi") <= 4


def test_many_keys_cut_the_driving_input_alone(spark):
    from leadmill.operators.watermarks import restrict_inputs
    from leadmill.plans.models import FACT_MODELS

    spec, t = FACT_MODELS["fct_campaign_performance"], Tables(spark, DIR)
    inputs = {name: t(ref) for name, ref in spec.inputs.items()}
    keys = inputs["dim_campaign"].where("campaign_id <> '7'").select("campaign_id")
    out = restrict_inputs(spec, inputs, keys, few=False)
    assert [name for name in inputs if out[name] is not inputs[name]] == ["dim_campaign"]
    assert out["dim_campaign"].count() == inputs["dim_campaign"].count() - 1


def test_names_do_not_travel_through_the_joins_of_members(spark, no_broadcast):
    """The join that fetches a member's campaign name is the last one."""
    plan = Tables(spark, DIR)("marketing.dim_campaign_member_engagement")._jdf.queryExecution().optimizedPlan().toString()
    top = next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    assert "(campaign_id#" in top and "related" not in top


@pytest.mark.parametrize("name", ["dim_opportunity", "dim_opportunity_performance", "fact_marketing_performance"])
def test_hashes_do_not_travel(spark, no_broadcast, name):
    """Surrogate keys, which do not compress, are left out of shuffles and made again from the ids."""
    df = QUERIES[name](spark, DIR)
    text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", text)
    assert moved and not [columns for columns in moved if re.search(r"_sk#", columns.replace("__sk#", ""))]


@pytest.mark.parametrize("name", ["dim_campaign_member_engagement", "fct_daily_performance"])
def test_hashes_of_members_do_not_travel(spark, no_broadcast, name):
    """The daily fact's five keys are made from ids where its rows come together; so is the one of the members before."""
    df = QUERIES[name](spark, DIR)
    text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", text)
    assert moved and not [columns for columns in moved if re.search(r"(campaign|member|lead|opportunity)_sk#", columns)]


def test_results_are_written_with_zstd(spark):
    """Hashes in hex take half the space; a codec that the cluster sets stays."""
    key = "spark.sql.parquet.compression.codec"
    spark.conf.unset(key)
    Tables(spark, DIR)
    assert spark.conf.get(key) == "zstd"
