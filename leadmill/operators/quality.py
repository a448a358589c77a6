"""Data-quality checks and run summaries."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leadmill.operators.conform import SchemaReport, schema_report
from leadmill.operators.upsert import duplicate_keys

# The key of each fact, and the columns each fact promises.
FACT_KEYS = {
    "fact_marketing_performance": "fact_sk",
    "fct_campaign_performance": "campaign_date_sk",
    "fct_daily_performance": "daily_performance_sk",
    "fct_event_performance": "event_outcome_sk",
    "fct_lead_to_opportunity_conversion": "lead_sk",
}
# Facts whose declared key is coarser than their rows, so that some keys are used twice.
COARSE_KEYS = ("fact_marketing_performance", "fct_event_performance")
FACT_COLUMNS = {
    "fact_marketing_performance": (
        "fact_sk engagement_sk engagement_id engagement_type engagement_timestamp link_url is_open is_click "
        "send_sk send_id email_template_id send_date subject_line campaign_sk campaign_id campaign_name "
        "contact_sk contact_id contact_first_name contact_last_name lead_sk lead_id lead_first_name "
        "lead_last_name opportunity_sk opportunity_id opportunity_name event_sk event_id event_type member_sk "
        "member_id engagement_date engagement_hour days_since_campaign_start last_modified_timestamp"
    ).split(),
    "fct_campaign_performance": (
        "campaign_date_sk date_key campaign_sk campaign_id campaign_name status unique_contacts_engaged "
        "total_members total_engagements total_opens link_clicks opportunities_generated opportunity_amount "
        "last_modified_timestamp"
    ).split(),
    "fct_daily_performance": (
        "daily_performance_sk campaign_sk member_sk contact_sk lead_sk opportunity_sk date_key campaign_budget "
        "unique_recipients total_opens total_clicks total_engagements email_opens event_attendances is_converted "
        "days_to_convert opportunity_amount days_open is_won open_rate click_through_rate "
        "last_modified_timestamp"
    ).split(),
    "fct_event_performance": (
        "event_outcome_sk event_id subject outcome_status days_to_opportunity opportunity_id "
        "total_engagements_before_event pre_event_clicks hours_before_opportunity last_modified_timestamp"
    ).split(),
    "fct_lead_to_opportunity_conversion": (
        "lead_sk lead_id first_name last_name status is_converted conversion_date days_to_convert "
        "opportunities_created total_pipeline last_modified_timestamp"
    ).split(),
}


def unique_failures(df: DataFrame, key: str) -> DataFrame:
    return duplicate_keys(df, key)


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def column_contract(fact: str, df: DataFrame) -> SchemaReport:
    return schema_report(fact, FACT_COLUMNS[fact], df)


def one_by_one(lines: Iterable[DataFrame]) -> DataFrame:
    """Frames of one row each as a single frame, computed one after another.

    As one plan, all broadcasts and all stages of all facts would be in the driver's memory at the same time.
    """
    rows, schema = [], None
    for line in lines:
        rows += line.collect()
        schema, spark = line.schema, line.sparkSession
    return spark.createDataFrame(rows, schema)


def packed_hex(key: Column) -> tuple[Column, Column]:
    """A key in half its length if it is lower-case hex, and in whole if it is not; the other one is NULL."""
    packed = F.unhex(key)
    is_hex = F.coalesce(F.lower(F.hex(packed)) == key, F.lit(False))
    return F.when(is_hex, packed), F.when(~is_hex, key)


def key_checks(facts: Mapping[str, DataFrame]) -> DataFrame:
    """One row per fact: rows, rows without key, keys used twice.

    Where no 64-bit hash repeats, no key does. So keys themselves are counted only where they are known to repeat, or
    where a hash does. Hashes are dealt as they are: they hardly repeat, and to combine them first would fill the memory
    of the tasks that make them.
    """

    def counted(name: str, keys: DataFrame) -> DataFrame:
        used = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in keys.columns])
        per_key = keys.groupBy(*keys.columns).agg(F.count(F.lit(1)).alias("n"))
        return per_key.agg(
            F.lit(name).alias("fact"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(~used, F.col("n"))), F.lit(0)).alias("null_keys"),
            F.count_if(used & (F.col("n") > 1)).alias("duplicate_keys"),
        )

    def check(name: str, df: DataFrame) -> DataFrame:
        key = F.col(FACT_KEYS[name])
        if name not in COARSE_KEYS:
            hashes = df.select(F.when(key.isNotNull(), F.xxhash64(key)).alias("hash")).repartition("hash")
            line = counted(name, hashes)
            found = line.collect()
            if not found[0]["duplicate_keys"]:
                return df.sparkSession.createDataFrame(found, line.schema)
        packed, other = packed_hex(key)
        return counted(name, df.select(packed.alias("packed"), other.alias("other")))

    return one_by_one(check(n, df) for n, df in facts.items())


def run_summary(results: DataFrame) -> DataFrame:
    """Totals of a run over one row per table: ``status``, ``new_files``, ``load_status``, ``loaded_files``."""
    return results.agg(
        F.count(F.lit(1)).alias("tables_processed"),
        F.count_if(F.col("status") == "success").alias("tables_successful"),
        F.count_if(F.col("new_files") > 0).alias("tables_with_new_files"),
        F.count_if(F.col("load_status") == "success").alias("load_success"),
        F.coalesce(F.sum("loaded_files"), F.lit(0)).alias("total_files_loaded"),
    )

