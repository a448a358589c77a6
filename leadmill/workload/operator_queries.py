"""Registered queries of the single operators, on the same views."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leadmill.functions import (
    epoch_ns_to_ts,
    fact_key,
    first_date_field,
    first_whole_day,
    hour_boundaries,
    outcome_label,
    parse_batch_id,
    safe_cast,
    stamp,
    surrogate_key,
    zero_safe_ratio,
)
from leadmill.functions.times import day
from leadmill.operators.aggregates import conditional_distinct
from leadmill.operators.conform import clean, conform, dedupe_by_key, lower_names, schema_report, with_partitions
from leadmill.operators.joins import disjunctive_left_join, fanout_left_join, range_join
from leadmill.operators.quality import (
    FACT_COLUMNS,
    FACT_KEYS,
    column_contract,
    key_checks,
    not_null_failures,
    one_by_one,
    run_summary,
    unique_failures,
)
from leadmill.operators.rejects import first_rejects, load_rejects
from leadmill.operators.upsert import merge_rows
from leadmill.operators.watermarks import advance, affected_keys, both_sides, newer_than, restrict_inputs
from leadmill.plans.flow import newest_rows
from leadmill.plans.models import MODELS_BY_REF
from leadmill.registry import ENTITIES, STAMP
from leadmill.session import scratch_dir
from leadmill.sources.batches import discover_batches, newer_batches
from leadmill.streaming.ingest import read_landing, run_available
from leadmill.workload.oracle import STAMPED, TODAY, sk
from leadmill.workload.queries import Tables, register
from leadmill.workload.views import AS_OF, BATCH_SQL, LANDED_SQL, VIEW_SQL_EXTRA, sql_on

OPP = ENTITIES["opportunity"]
EARLIER = datetime(2024, 2, 3)
EARLIER_SQL = f"TIMESTAMP '{EARLIER:%Y-%m-%d %H:%M:%S}'"
AFTER_BATCH = "1999-01-01_000000"

LANDED_NAMES = (
    "opportunity_id", "opportunity_name", "account_id", "stage_name", "amount", "close_date", "created_date",
    "source_note", "batch_id", "file_path",
)
EXTRA = {
    "landed_as_is": VIEW_SQL_EXTRA["landed_opportunity"],
    "landed_opportunity": f"SELECT {', '.join(f'{c} AS {c}' for c in LANDED_NAMES)} FROM landed_as_is",
    "opportunity_changes": VIEW_SQL_EXTRA["opportunity_changes"],
    "batches": f"SELECT o_orderkey, {BATCH_SQL} AS batch_id FROM orders",
    "parsed_batches": r"""SELECT o_orderkey, batch_id,
        CASE WHEN regexp_full_match(batch_id, '\d{4}-\d{2}-\d{2}_\d{6}')
             THEN TRY_STRPTIME(batch_id, '%Y-%m-%d_%H%M%S') END AS batch_time FROM batches""",
}


def floor_micros(ns: str) -> str:
    return f"make_timestamp(({ns} - ((({ns}) % 1000) + 1000) % 1000) // 1000)"


EXTRA["cleaned_opportunity"] = f"""
    SELECT opportunity_id, opportunity_name, account_id, stage_name, amount, {floor_micros('close_date')} AS close_date,
           {floor_micros('created_date')} AS created_date, source_note, batch_id, file_path
    FROM landed_opportunity WHERE close_date >= 1000000000 AND created_date >= 1000000000"""


def landed(t: Tables) -> DataFrame:
    return t.raw["landed_opportunity"]


def batches(t: Tables) -> DataFrame:
    return sql_on(EXTRA["batches"], orders=t.base["orders"])


# --- batches -----------------------------------------------------------------------------------

@register(
    "batch_discovery",
    "SELECT DISTINCT batch_id, batch_time FROM parsed_batches WHERE batch_time IS NOT NULL", EXTRA,
)
def batch_discovery(t: Tables) -> DataFrame:
    return discover_batches(batches(t))


@register("batch_id_parse", "SELECT * FROM parsed_batches", EXTRA)
def batch_id_parse(t: Tables) -> DataFrame:
    return batches(t).withColumn("batch_time", parse_batch_id(F.col("batch_id")))


@register(
    "incremental_batches",
    f"""SELECT batch_id, COUNT(*) AS files FROM parsed_batches
        WHERE batch_time IS NOT NULL AND batch_id > '{AFTER_BATCH}' GROUP BY batch_id""", EXTRA,
)
def incremental_batches(t: Tables) -> DataFrame:
    valid = batches(t).where(parse_batch_id(F.col("batch_id")).isNotNull())
    return newer_batches(valid, AFTER_BATCH).groupBy("batch_id").agg(F.count(F.lit(1)).alias("files"))


# --- cleaning and conformance ------------------------------------------------------------------

@register("clean_epoch_filter", "SELECT opportunity_id, close_date, created_date FROM cleaned_opportunity", EXTRA)
def clean_epoch_filter(t: Tables) -> DataFrame:
    return clean(OPP, landed(t)).select("opportunity_id", "close_date", "created_date")


@register(
    "epoch_ns_to_ts",
    f"""SELECT opportunity_id, {floor_micros('close_date')} AS close_time,
               date_trunc('month', {floor_micros('created_date')})::DATE AS created_month FROM landed_opportunity""",
    EXTRA,
)
def epoch_ns(t: Tables) -> DataFrame:
    return lower_names(landed(t)).select(
        "opportunity_id",
        epoch_ns_to_ts(F.col("close_date")).alias("close_time"),
        F.trunc(epoch_ns_to_ts(F.col("created_date")), "month").alias("created_month"),
    )


@register(
    "any_date_field",
    f"SELECT opportunity_id, {floor_micros('close_date')} AS close_date_ts FROM landed_opportunity", EXTRA,
)
def any_date_field(t: Tables) -> DataFrame:
    df = landed(t)
    return df.select(F.col("OPPORTUNITY_ID").alias("opportunity_id"), first_date_field(df))


@register(
    "safe_cast_int",
    "SELECT opportunity_id, TRY_CAST(regexp_replace(amount, '[^0-9]', '', 'g') AS INT) AS amount, "
    "CAST(NULL AS INT) AS absent FROM landed_opportunity", EXTRA,
)
def safe_cast_int(t: Tables) -> DataFrame:
    df = safe_cast(lower_names(landed(t)).select("opportunity_id", "amount"), "amount", "int")
    return safe_cast(df, "absent", "int")


@register(
    "safe_cast_float",
    "SELECT opportunity_id, TRY_CAST(regexp_replace(amount, '[^0-9.]', '', 'g') AS FLOAT) AS amount "
    "FROM landed_opportunity", EXTRA,
)
def safe_cast_float(t: Tables) -> DataFrame:
    return safe_cast(lower_names(landed(t)).select("opportunity_id", "amount"), "amount", "float")


@register(
    "conform_schema",
    """SELECT opportunity_id, opportunity_name, account_id, stage_name,
              TRY_CAST(amount AS DECIMAL(15,2)) AS amount, close_date, CAST(NULL AS VARCHAR) AS campaign_id,
              created_date, source_note, batch_id, file_path FROM cleaned_opportunity""", EXTRA,
)
def conform_schema(t: Tables) -> DataFrame:
    return conform(OPP, clean(OPP, landed(t)))


def _reports(t: Tables) -> list[tuple[str, DataFrame]]:
    return [(n, t(f"raw.{n}")) for n in ENTITIES] + [("opportunity", lower_names(landed(t)))]


def _report_sql(table: str, source: str, missing: str, extra: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{missing}' AS missing, '{extra}' AS extra, {not missing} AS ok, "
        f"COUNT(*) AS \"rows\" FROM {source}"
    )


@register(
    "schema_report",
    " UNION ALL ".join(
        [_report_sql(n, f"raw_{n}", "", STAMP) for n in ENTITIES]
        + [_report_sql("opportunity", "landed_opportunity", "campaign_id", "source_note,batch_id,file_path")]
    ),
    EXTRA,
)
def schema_reports(t: Tables) -> DataFrame:
    def line(name: str, df: DataFrame) -> DataFrame:
        r = schema_report(name, list(ENTITIES[name].fields), df)
        return df.agg(
            F.lit(r.table).alias("table"), F.lit(",".join(r.missing)).alias("missing"),
            F.lit(",".join(r.extra)).alias("extra"), F.lit(r.ok).alias("ok"), F.count(F.lit(1)).alias("rows"),
        )

    return reduce(DataFrame.unionByName, [line(n, df) for n, df in _reports(t)])


def _partition_sql(name: str) -> str:
    parts = [
        f"CAST({c if u == 'value' else f'CAST(date_trunc({u!r}, {c}) AS DATE)'} AS VARCHAR)"
        for c, u in ENTITIES[name].partitions.values()
    ]
    text = " || '/' || ".join(parts)
    return f"SELECT '{name}' AS entity, {text} AS partition_value, COUNT(*) AS \"rows\" FROM raw_{name} GROUP BY ALL"


@register("partition_columns", " UNION ALL ".join(_partition_sql(n) for n in ENTITIES))
def partition_columns(t: Tables) -> DataFrame:
    def per_partition(name: str) -> DataFrame:
        spec = ENTITIES[name]
        text = F.concat_ws("/", *[F.col(c).cast("string") for c in spec.partition_columns])
        return (
            with_partitions(spec, t(f"raw.{name}"))
            .groupBy(F.lit(name).alias("entity"), text.alias("partition_value"))
            .agg(F.count(F.lit(1)).alias("rows"))
        )

    return reduce(DataFrame.unionByName, [per_partition(n) for n in ENTITIES])


# --- upserts, rejects, state -------------------------------------------------------------------

@register(
    "dedupe_by_key",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def latest_per_user(t: Tables) -> DataFrame:
    return dedupe_by_key(t.base["events"], "user_id", [F.col("ts").desc(), F.col("event_id").desc()])


def changes(t: Tables) -> DataFrame:
    return t.raw["opportunity_changes"]


_MERGED = """
    SELECT opportunity_id, opportunity_name, account_id, stage_name, amount, close_date, campaign_id, created_date,
           last_modified_timestamp
    FROM raw_opportunity WHERE opportunity_id NOT IN (SELECT opportunity_id FROM opportunity_changes)
    UNION ALL
    SELECT c.opportunity_id, NULL, NULL, c.stage_name, c.amount, NULL, NULL, c.created_date, {stamp}
    FROM opportunity_changes c LEFT JOIN raw_opportunity o ON o.opportunity_id = c.opportunity_id"""
_LOADED_AT = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"


@register("pk_upsert", _MERGED.format(stamp=_LOADED_AT), EXTRA)
def pk_upsert(t: Tables) -> DataFrame:
    return merge_rows(t("raw.opportunity"), changes(t), OPP.key, loaded_at=AS_OF)


@register("upsert_touch", _MERGED.format(stamp=f"COALESCE(o.last_modified_timestamp, {_LOADED_AT})"), EXTRA)
def upsert_keeps_stamp(t: Tables) -> DataFrame:
    return merge_rows(t("raw.opportunity"), changes(t), OPP.key, loaded_at=AS_OF, touch_on_update=False)


@register(
    "schema_sync",
    """SELECT opportunity_id, stage_name, amount, created_date, CAST(NULL AS BIGINT) AS owner FROM raw_opportunity
       WHERE opportunity_id NOT IN (SELECT opportunity_id FROM opportunity_changes)
       UNION ALL SELECT opportunity_id, stage_name, amount, created_date, owner FROM opportunity_changes""", EXTRA,
)
def schema_sync(t: Tables) -> DataFrame:
    return merge_rows(t("raw.opportunity"), changes(t), OPP.key, on_schema_change="sync_all_columns")


_REJECTS = f"""
    SELECT file_path, 'cannot read amount as decimal(15,2)' AS message, batch_id, COUNT(*) AS "count",
           {_LOADED_AT} AS load_timestamp
    FROM cleaned_opportunity WHERE amount IS NOT NULL AND TRY_CAST(amount AS DECIMAL(15,2)) IS NULL
    GROUP BY file_path, batch_id"""


@register("load_rejects", _REJECTS, EXTRA)
def rejects(t: Tables) -> DataFrame:
    return load_rejects(OPP, clean(OPP, landed(t)), AS_OF)


@register(
    "first_load_errors",
    f"SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY file_path, message, batch_id) AS rank "
    f"FROM ({_REJECTS}) QUALIFY rank <= 3", EXTRA,
)
def first_load_errors(t: Tables) -> DataFrame:
    out = first_rejects(load_rejects(OPP, clean(OPP, landed(t)), AS_OF), "file_path")
    return out.withColumn("rank", F.col("rank").cast("bigint"))


def _per_entity(name: str) -> str:
    return (
        f"SELECT '{name}' AS \"table\", COUNT(DISTINCT last_modified_timestamp) AS new_files, "
        f"epoch_ms(MIN({STAMP})) AS first_ms, epoch_ms(MAX({STAMP})) AS last_ms FROM raw_{name}"
    )


_RESULTS = " UNION ALL ".join(_per_entity(n) for n in ENTITIES)


def table_results(t: Tables) -> DataFrame:
    """New load days of every entity, as the outcome of a run."""

    def millis(c: Column) -> Column:
        return F.unix_date(F.to_date(c)).cast("bigint") * 86_400_000

    loads = reduce(
        DataFrame.unionByName, [t(f"raw.{n}").select(F.lit(n).alias("table"), STAMP) for n in ENTITIES]
    )
    return loads.groupBy("table", STAMP).agg(F.count(F.lit(1))).groupBy("table").agg(
        F.count(STAMP).alias("new_files"),
        millis(F.min(STAMP)).alias("first_ms"),
        millis(F.max(STAMP)).alias("last_ms"),
    )


@register(
    "run_summary",
    f"""SELECT COUNT(*) AS tables_processed, COUNT(*) FILTER (WHERE new_files < 8) AS tables_successful,
               COUNT(*) FILTER (WHERE new_files > 0) AS tables_with_new_files,
               COUNT(*) FILTER (WHERE new_files >= 7) AS load_success,
               CAST(SUM(new_files) AS BIGINT) AS total_files_loaded FROM ({_RESULTS})""",
)
def summary(t: Tables) -> DataFrame:
    return run_summary(
        table_results(t).select(
            F.when(F.col("new_files") < 8, "success").otherwise("error").alias("status"), "new_files",
            F.when(F.col("new_files") >= 7, "success").otherwise("error").alias("load_status"),
            F.col("new_files").alias("loaded_files"),
        )
    )


@register(
    "watermark_state",
    f"""SELECT "table", CASE WHEN "table" = 'email_template' THEN first_ms ELSE last_ms END AS watermark,
               CASE WHEN "table" = 'email_template' THEN {EARLIER_SQL} ELSE {_LOADED_AT} END AS updated_at
        FROM ({_RESULTS})""",
)
def watermark_state(t: Tables) -> DataFrame:
    """State of an earlier run, moved forward for all tables but one that failed."""
    results = table_results(t)
    state = results.select("table", F.col("first_ms").alias("watermark"), stamp(EARLIER).alias("updated_at"))
    progress = results.select(
        "table", F.when(F.col("table") != "email_template", F.col("last_ms")).alias("watermark")
    )
    return advance(state, progress, AS_OF)


# --- incremental models ------------------------------------------------------------------------

def dated(t: Tables, entity: str) -> DataFrame:
    """A staging table whose rows carry the stamps of their raw rows."""
    stamps = t(f"raw.{entity}").select(F.col(ENTITIES[entity].key).alias("__key"), F.col(STAMP).alias("__stamp"))
    rows = t(f"staging.{entity}")
    return rows.join(stamps, rows[ENTITIES[entity].key] == stamps["__key"]).select(
        *[c for c in rows.columns if c != STAMP], F.col("__stamp").alias(STAMP)
    )


_CONTACT_MODEL = MODELS_BY_REF["marketing.dim_contact_engagement"]
_DATED = {
    "dated_contact": "SELECT s.* REPLACE (r.last_modified_timestamp AS last_modified_timestamp) "
    "FROM stg_contact s JOIN raw_contact r USING (contact_id)",
    "dated_engagement": "SELECT s.* REPLACE (r.last_modified_timestamp AS last_modified_timestamp) "
    "FROM stg_email_engagement s JOIN raw_email_engagement r USING (engagement_id)",
}


def _contact_engagement_sql(contact: str, engagement: str, stamped: str) -> str:
    return f"""
        SELECT p.contact_sk, p.contact_id, p.first_name, p.last_name, p.email,
               COUNT(DISTINCT g.engagement_id) AS total_engagements,
               COUNT(DISTINCT g.engagement_id) FILTER (WHERE g.engagement_type = 'Open') AS email_opens,
               COUNT(DISTINCT g.engagement_id) FILTER (WHERE g.engagement_type = 'Click') AS link_clicks,
               MAX(g.engagement_timestamp) AS last_engagement_date, {stamped}
        FROM {contact} p LEFT JOIN {engagement} g ON g.contact_id = p.contact_id GROUP BY ALL"""


def _earlier(df: DataFrame) -> DataFrame:
    return df.where(F.col(STAMP) <= stamp(EARLIER))


def _contact_inputs(t: Tables) -> dict[str, DataFrame]:
    return {"contact": dated(t, "contact"), "email_engagement": dated(t, "email_engagement")}


@register(
    "model_watermark",
    f"SELECT {sk('contact_id')} AS contact_sk, contact_id, first_name, last_name, email, phone, created_date, {STAMPED} "
    f"FROM raw_contact WHERE {STAMP} > {EARLIER_SQL}",
)
def model_watermark(t: Tables) -> DataFrame:
    """New rows of a staging model whose table was last built from the earlier raw rows."""
    raw = t("raw.contact")
    return MODELS_BY_REF["staging.contact"].build(newer_than(raw, _earlier(raw)), as_of=AS_OF)


@register(
    "model_delta_both_sides",
    _contact_engagement_sql(
        f"(SELECT * FROM dated_contact WHERE {STAMP} > {EARLIER_SQL})",
        f"(SELECT * FROM dated_engagement WHERE {STAMP} > {EARLIER_SQL})",
        STAMPED,
    ),
    _DATED,
)
def model_delta_both_sides(t: Tables) -> DataFrame:
    inputs = _contact_inputs(t)
    target = _CONTACT_MODEL.build(**{k: _earlier(v) for k, v in inputs.items()}, as_of=EARLIER)
    return _CONTACT_MODEL.build(**both_sides(_CONTACT_MODEL, inputs, target), as_of=AS_OF)


@register(
    "model_delta_affected",
    _contact_engagement_sql(
        "dated_contact", "dated_engagement",
        f"""CASE WHEN MAX(p.last_modified_timestamp) > {EARLIER_SQL} OR MAX(g.last_modified_timestamp) > {EARLIER_SQL}
                 THEN {_LOADED_AT} ELSE {EARLIER_SQL} END AS last_modified_timestamp""",
    ),
    _DATED,
)
def model_delta_affected(t: Tables) -> DataFrame:
    """The model's table after a delta run: recomputed rows, and the ones no change can reach."""
    inputs = _contact_inputs(t)
    target = _CONTACT_MODEL.build(**{k: _earlier(v) for k, v in inputs.items()}, as_of=EARLIER)
    changed = {k: newer_than(v, target) for k, v in inputs.items()}
    keys = affected_keys(_CONTACT_MODEL, inputs, changed)
    rows = _CONTACT_MODEL.build(**restrict_inputs(_CONTACT_MODEL, inputs, keys), as_of=AS_OF)
    kept = target.join(keys.select(F.col("contact_id").alias("__key")), F.col("contact_id") == F.col("__key"), "left_anti")
    return kept.unionByName(rows)


# --- keys and scalar rules ---------------------------------------------------------------------

@register("surrogate_key_1", f"SELECT contact_id, {sk('contact_id')} AS contact_sk FROM raw_contact")
def surrogate_key_1(t: Tables) -> DataFrame:
    return t("raw.contact").select("contact_id", surrogate_key("contact_id").alias("contact_sk"))


@register(
    "surrogate_key_n",
    f"SELECT member_id, {sk('campaign_id', 'contact_id', 'lead_id')} AS link_sk FROM raw_campaign_member",
)
def surrogate_key_n(t: Tables) -> DataFrame:
    key = surrogate_key("campaign_id", "contact_id", "lead_id")
    return t("raw.campaign_member").select("member_id", key.alias("link_sk"))


@register(
    "fact_key",
    "SELECT member_id, md5(COALESCE(member_id, '') || COALESCE(lead_id, '')) AS link_sk FROM raw_campaign_member",
)
def plain_key(t: Tables) -> DataFrame:
    return t("raw.campaign_member").select("member_id", fact_key("member_id", "lead_id").alias("link_sk"))


@register(
    "min_hours_between",
    f"""SELECT contact_id, MIN(datediff('hour', engagement_timestamp, {_LOADED_AT})) AS hours
        FROM raw_email_engagement GROUP BY contact_id""",
)
def min_hours_between(t: Tables) -> DataFrame:
    hours = hour_boundaries(F.col("engagement_timestamp"), stamp(AS_OF))
    return t("raw.email_engagement").groupBy("contact_id").agg(F.min(hours).alias("hours"))


@register(
    "zero_safe_rate",
    """SELECT campaign_id, CASE WHEN unique_recipients > 0 THEN CAST(total_opens AS DOUBLE) / unique_recipients END
              AS open_rate,
              CASE WHEN total_opens > 0 THEN CAST(total_clicks AS DOUBLE) / total_opens END AS click_through_rate
       FROM dim_campaign_performance""",
)
def zero_safe_rate(t: Tables) -> DataFrame:
    opens, clicks = F.col("total_opens"), F.col("total_clicks")
    return t("marketing.dim_campaign_performance").select(
        "campaign_id",
        zero_safe_ratio(opens, F.col("unique_recipients")).alias("open_rate"),
        zero_safe_ratio(clicks, opens).alias("click_through_rate"),
    )


@register(
    "outcome_label",
    """SELECT event_id, CASE WHEN related_campaign_id IS NULL THEN 'x' WHEN related_lead_id IS NOT NULL THEN 'Has Lead'
              WHEN related_contact_id IS NOT NULL THEN 'Has Contact' ELSE 'No Link' END AS outcome FROM raw_event""",
)
def label(t: Tables) -> DataFrame:
    nothing = F.lit(None).cast("string")
    outcome = outcome_label(nothing, F.col("related_lead_id"), F.col("related_contact_id"))
    return t("raw.event").select("event_id", outcome.alias("outcome"))


# --- joins -------------------------------------------------------------------------------------

def _members(t: Tables) -> DataFrame:
    return t("raw.campaign_member").select("member_id", "campaign_id", "contact_id", "lead_id")


@register(
    "disjunctive_left_join",
    """SELECT m.member_id, m.contact_id, m.lead_id, g.engagement_id, g.contact_id AS engaged
       FROM raw_campaign_member m LEFT JOIN raw_email_engagement g
         ON m.contact_id = g.contact_id OR m.lead_id = g.contact_id""",
)
def or_join(t: Tables) -> DataFrame:
    engagements = t("raw.email_engagement").select("engagement_id", F.col("contact_id").alias("engaged"))
    arms = [[("contact_id", "engaged")], [("lead_id", "engaged")]]
    joined = disjunctive_left_join(_members(t), engagements, arms)
    return joined.drop("campaign_id")


@register(
    "equi_or_join",
    """SELECT m.member_id, m.campaign_id, v.event_id, v.related_contact_id, v.related_lead_id
       FROM raw_campaign_member m LEFT JOIN raw_event v ON m.campaign_id = v.related_campaign_id
         AND (m.contact_id = v.related_contact_id OR m.lead_id = v.related_lead_id)""",
)
def equi_or_join(t: Tables) -> DataFrame:
    events = t("raw.event").select("event_id", "related_campaign_id", "related_contact_id", "related_lead_id")
    same_campaign = ("campaign_id", "related_campaign_id")
    arms = [[same_campaign, ("contact_id", "related_contact_id")], [same_campaign, ("lead_id", "related_lead_id")]]
    joined = disjunctive_left_join(_members(t), events, arms)
    return joined.select("member_id", "campaign_id", "event_id", "related_contact_id", "related_lead_id")


@register(
    "interval_or_join",
    """SELECT v.event_id, v.start_date_time, o.opportunity_id, o.created_date AS opened
       FROM raw_event v LEFT JOIN raw_opportunity o
         ON (v.related_contact_id = o.account_id OR v.related_lead_id = o.account_id)
        AND CAST(o.created_date AS DATE) BETWEEN CAST(v.start_date_time AS DATE)
                                             AND CAST(v.start_date_time AS DATE) + 30""",
)
def interval_or_join(t: Tables) -> DataFrame:
    events = t("raw.event").select("event_id", "start_date_time", "related_contact_id", "related_lead_id")
    opps = t("raw.opportunity").select("opportunity_id", "account_id", F.col("created_date").alias("opened"))
    arms = [[("related_contact_id", "account_id")], [("related_lead_id", "account_id")]]
    joined = disjunctive_left_join(events, opps, arms, within_days=("opened", "start_date_time", 30))
    return joined.select("event_id", "start_date_time", "opportunity_id", "opened")


_RANGE = f"t.date_key >= k.start_date AND t.date_key <= COALESCE(k.end_date, {TODAY})"


def _ranges(t: Tables, how: str) -> DataFrame:
    campaigns = t("raw.campaign").select("campaign_id", "start_date", "end_date")
    last = F.coalesce(F.to_date("end_date"), day(AS_OF))
    calendar = t("marketing.dim_date").select("date_key")
    return range_join(campaigns, "campaign_id", first_whole_day(F.col("start_date")), last, calendar, "date_key", how)


@register(
    "range_join_inner",
    f"SELECT k.campaign_id, k.start_date, k.end_date, t.date_key FROM raw_campaign k JOIN dim_date t ON {_RANGE}",
)
def range_join_inner(t: Tables) -> DataFrame:
    return _ranges(t, "inner")


@register(
    "range_join_left",
    f"SELECT k.campaign_id, k.start_date, k.end_date, t.date_key FROM raw_campaign k LEFT JOIN dim_date t ON {_RANGE}",
)
def range_join_left(t: Tables) -> DataFrame:
    return _ranges(t, "left")


@register(
    "theta_join",
    f"""SELECT v.event_outcome_sk, v.event_id, v.days_to_opportunity, g.engagement_id, g.engagement_timestamp
        FROM dim_event_outcome v LEFT JOIN dim_email_engagement g ON v.event_id = g.campaign_name
         AND g.engagement_timestamp < {TODAY} - CAST(v.days_to_opportunity AS INT)""",
)
def theta_join(t: Tables) -> DataFrame:
    v = t("marketing.dim_event_outcome").select("event_outcome_sk", "event_id", "days_to_opportunity")
    g = t("marketing.dim_email_engagement").select("engagement_id", "engagement_timestamp", "campaign_name")
    cutoff = F.date_sub(day(AS_OF), F.col("days_to_opportunity").cast("int")).cast("timestamp_ntz")
    joined = v.join(g, (v["event_id"] == g["campaign_name"]) & (F.col("engagement_timestamp") < cutoff), "left")
    return joined.drop("campaign_name")


@register(
    "fanout_left_join",
    """SELECT m.member_id, m.contact_id, o.opportunity_id, o.amount
       FROM raw_campaign_member m LEFT JOIN raw_opportunity o ON o.account_id = m.contact_id""",
)
def fanout(t: Tables) -> DataFrame:
    """Members with all opportunities of their contact; contacts with many rows are split."""
    opps = t("raw.opportunity").select(F.col("account_id").alias("contact_id"), "opportunity_id", "amount")
    members = t("raw.campaign_member").select("member_id", "contact_id")
    return fanout_left_join(members, opps, "contact_id", parts=20, min_rows=8)


# --- aggregation and quality -------------------------------------------------------------------

@register(
    "conditional_distinct",
    """SELECT d.campaign_id, COUNT(DISTINCT g.contact_id) AS contacts,
              COUNT(DISTINCT CASE WHEN g.engagement_type = 'Open' THEN g.contact_id END) AS openers,
              COUNT(DISTINCT CASE WHEN g.engagement_type = 'Click' THEN g.contact_id END) AS clickers
       FROM raw_email_engagement g JOIN raw_email_send d ON d.send_id = g.send_id GROUP BY d.campaign_id""",
)
def distinct_contacts(t: Tables) -> DataFrame:
    sends = t("raw.email_send").select("send_id", "campaign_id")
    rows = t("raw.email_engagement").select("send_id", "contact_id", "engagement_type").join(sends, "send_id")
    kind = F.col("engagement_type")
    return conditional_distinct(
        rows, ["campaign_id"], "contact_id",
        {"contacts": None, "openers": kind == "Open", "clickers": kind == "Click"},
    )


@register(
    "dq_unique",
    'SELECT event_outcome_sk, COUNT(*) AS "rows" FROM fct_event_performance GROUP BY 1 HAVING COUNT(*) > 1',
)
def dq_unique(t: Tables) -> DataFrame:
    return unique_failures(t("marketing.fct_event_performance"), "event_outcome_sk")


@register(
    "dq_not_null",
    "SELECT opportunity_id, close_date FROM dim_opportunity WHERE close_date IS NULL",
)
def dq_not_null(t: Tables) -> DataFrame:
    return not_null_failures(t("marketing.dim_opportunity"), "close_date").select("opportunity_id", "close_date")


def _key_check_sql(fact: str, key: str) -> str:
    return f"""SELECT '{fact}' AS fact, CAST(SUM(n) AS BIGINT) AS "rows",
        CAST(COALESCE(SUM(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_keys,
        COUNT(*) FILTER (WHERE k IS NOT NULL AND n > 1) AS duplicate_keys
        FROM (SELECT {key} AS k, COUNT(*) AS n FROM {fact} GROUP BY 1)"""


@register("dq_keys", " UNION ALL ".join(_key_check_sql(f, k) for f, k in FACT_KEYS.items()))
def dq_keys(t: Tables) -> DataFrame:
    return key_checks({f: t(f"marketing.{f}") for f in FACT_KEYS})


@register(
    "dq_columns",
    " UNION ALL ".join(
        f"SELECT '{f}' AS fact, {len(cols)} AS documented, 0 AS missing, 0 AS extra, COUNT(*) AS \"rows\" FROM {f}"
        for f, cols in FACT_COLUMNS.items()
    ),
)
def dq_columns(t: Tables) -> DataFrame:
    def line(fact: str) -> DataFrame:
        df = t(f"marketing.{fact}")
        r = column_contract(fact, df)
        return df.agg(
            F.lit(fact).alias("fact"), F.lit(len(FACT_COLUMNS[fact])).alias("documented"),
            F.lit(len(r.missing)).alias("missing"), F.lit(len(r.extra)).alias("extra"),
            F.count(F.lit(1)).alias("rows"),
        )

    return one_by_one(line(f) for f in FACT_COLUMNS)


# --- streaming ---------------------------------------------------------------------------------

@register(
    "stream_ingest",
    """SELECT opportunity_id, opportunity_name, account_id, stage_name, TRY_CAST(amount AS DECIMAL(15,2)) AS amount,
              close_date, CAST(NULL AS VARCHAR) AS campaign_id, created_date
       FROM cleaned_opportunity""", EXTRA,
)
def stream_ingest(t: Tables) -> DataFrame:
    """Orders as a file stream: land, clean, conform, write each micro-batch, keep the newest row per key."""
    out, checkpoint = scratch_dir(t.spark, "ingest"), scratch_dir(t.spark, "ingest-checkpoint")

    def write(batch: DataFrame, epoch: int) -> None:
        rows = conform(OPP, clean(OPP, sql_on(LANDED_SQL, orders=batch)))
        rows.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    # As a pattern, the path may stand for one file or for a folder of files.
    path = f"{t.base.sf_dir}/[o]rders.parquet"
    run_available(read_landing(t.spark, path, t.base["orders"].schema), checkpoint, write)
    return newest_rows(OPP, t.spark.read.parquet(out)).select(*OPP.fields)

