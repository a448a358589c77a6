"""Dimension models.

Inputs are unique on their declared keys; the upsert that wrote them checks that. A count of distinct
keys over joined rows is therefore a plain count over the table the key belongs to, and the models
aggregate each input by its join key first, so that no join multiplies rows before they are counted.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from leadmill.functions import calendar_parts, day_diff, flag, outcome_label, packed_key, stamp, surrogate_key, unpacked_key
from leadmill.functions.times import day
from leadmill.operators.joins import disjunctive_left_join
from leadmill.registry import STAMP


def stamped(df: DataFrame, as_of: datetime) -> DataFrame:
    return df.withColumn(STAMP, stamp(as_of))


def lookup(df: DataFrame, other: DataFrame, key: str, other_key: str, *cols: str | Column, how: str = "left") -> DataFrame:
    """Fetch columns of the row of ``other`` whose key equals ``df[key]``."""
    small = other.select(F.col(other_key).alias("__key"), *cols)
    return df.join(small, df[key] == small["__key"], how).drop("__key")


def or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("bigint"))


def dim_campaign(campaign: DataFrame, as_of: datetime) -> DataFrame:
    out = campaign.select(
        surrogate_key("campaign_id").alias("campaign_sk"),
        "campaign_id", "campaign_name", "start_date", "end_date", "status", "budget",
    )
    return stamped(out, as_of)


def dim_campaign_member_engagement(
    campaign_member: DataFrame,
    campaign: DataFrame,
    email_engagement: DataFrame,
    event: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """Engagements and events of each campaign member.

    A member's engagements are those of its contact id and those of its lead id used as a contact id;
    the two sets are disjoint unless the ids are equal. Its events are those of its campaign with its
    contact or its lead; events with both are counted once. On the way, the surrogate key is left out where it hashes its id.
    """
    per_contact = email_engagement.groupBy("contact_id").agg(
        F.count("engagement_id").alias("n"),
        F.count(F.when(flag(F.col("engagement_type"), "Open"), F.col("engagement_id"))).alias("opens"),
        F.max("engagement_timestamp").alias("last"),
        F.max(F.col("engagement_timestamp").isNull()).alias("untimed"),
    )

    def engaged(df: DataFrame, key: Column, p: str) -> DataFrame:
        side = per_contact.select(
            F.col("contact_id").alias(f"{p}_key"),
            *[F.col(c).alias(f"{p}_{c}") for c in ("n", "opens", "last", "untimed")],
        )
        return df.join(side, key == side[f"{p}_key"], "left")

    def attended(df: DataFrame, p: str, pairs: dict[str, str]) -> DataFrame:
        side = (
            event.where(" AND ".join(f"{c} IS NOT NULL" for c in pairs.values()))
            .groupBy(*pairs.values())
            .agg(F.count("event_id").alias(f"{p}_n"), F.max("start_date_time").alias(f"{p}_last"))
            .withColumnsRenamed({c: f"{p}_{c}" for c in pairs.values()})
        )
        on = [df[m] == side[f"{p}_{c}"] for m, c in pairs.items()]
        return df.join(side, on, "left").drop(*[f"{p}_{c}" for c in pairs.values()])

    m = campaign_member.select(
        packed_key("member_sk", "member_id").alias("__sk"),
        "member_id", "campaign_id", "contact_id", "lead_id", "status", "first_responded_date",
    )
    m = engaged(m, F.col("contact_id"), "ec")
    m = engaged(m, F.when(~F.col("lead_id").eqNullSafe(F.col("contact_id")), F.col("lead_id")), "el")
    # Counts are never NULL where there is a match. Sums, not their parts, go on through the next joins.
    no_engagement = F.col("ec_n").isNull() & F.col("el_n").isNull()
    untimed = F.coalesce(F.col("ec_untimed"), F.lit(False)) | F.coalesce(F.col("el_untimed"), F.lit(False))
    m = m.select(
        *[c for c in m.columns if not c.startswith(("ec_", "el_"))],
        (or_zero("ec_n") + or_zero("el_n")).alias("total_engagements"),
        (or_zero("ec_opens") + or_zero("el_opens")).alias("email_opens"),
        F.greatest("ec_last", "el_last").alias("e_last"),
        (no_engagement | untimed).alias("e_open"),
    )
    by_campaign = {"campaign_id": "related_campaign_id"}
    by_contact = {"contact_id": "related_contact_id"}
    by_lead = {"lead_id": "related_lead_id"}
    m = attended(m, "vc", by_campaign | by_contact)
    m = attended(m, "vl", by_campaign | by_lead)
    m = attended(m, "vb", by_campaign | by_contact | by_lead)

    # The name comes last, so that it does not travel through the other joins.
    m = lookup(m, campaign, "campaign_id", "campaign_id", "campaign_name")
    last_event = F.when(F.col("e_open"), F.greatest("vc_last", "vl_last"))
    out = m.select(
        unpacked_key("__sk", "member_id").alias("member_sk"), "member_id", "campaign_id", "campaign_name", "contact_id", "lead_id",
        F.col("status").alias("member_status"),
        "first_responded_date",
        "total_engagements", "email_opens",
        (or_zero("vc_n") + or_zero("vl_n") - or_zero("vb_n")).alias("event_attendances"),
        F.greatest("e_last", last_event).alias("last_engagement_date"),
    )
    return stamped(out, as_of)


def dim_campaign_performance(
    campaign: DataFrame, email_send: DataFrame, email_engagement: DataFrame, as_of: datetime
) -> DataFrame:
    """Recipients, opens and clicks of each campaign over its sends."""
    typed = lambda t: F.count(F.when(flag(F.col("engagement_type"), t), F.col("engagement_sk")))
    per_contact = (
        lookup(
            email_engagement.select("send_id", "contact_sk", "engagement_type", "engagement_sk"),
            email_send, "send_id", "send_id", F.col("campaign_id").alias("__campaign"), how="inner",
        )
        .groupBy("__campaign", "contact_sk")
        .agg(typed("Open").alias("opens"), typed("Click").alias("clicks"))
    )
    per_campaign = per_contact.groupBy("__campaign").agg(
        F.count("contact_sk").alias("unique_recipients"),
        F.sum("opens").alias("total_opens"),
        F.sum("clicks").alias("total_clicks"),
    )
    out = campaign.join(per_campaign, F.col("campaign_id") == F.col("__campaign"), "left").select(
        "campaign_sk", "campaign_id", "campaign_name", "status", "start_date", "end_date",
        *[or_zero(c).alias(c) for c in ("unique_recipients", "total_opens", "total_clicks")],
    )
    return stamped(out, as_of)


def dim_contact_engagement(contact: DataFrame, email_engagement: DataFrame, as_of: datetime) -> DataFrame:
    typed = lambda t: F.count(F.when(flag(F.col("engagement_type"), t), F.col("engagement_id")))
    per_contact = email_engagement.groupBy(F.col("contact_id").alias("__contact")).agg(
        F.count("engagement_id").alias("total_engagements"),
        typed("Open").alias("email_opens"),
        typed("Click").alias("link_clicks"),
        F.max("engagement_timestamp").alias("last_engagement_date"),
    )
    out = contact.join(per_contact, F.col("contact_id") == F.col("__contact"), "left").select(
        "contact_sk", "contact_id", "first_name", "last_name", "email",
        *[or_zero(c).alias(c) for c in ("total_engagements", "email_opens", "link_clicks")],
        "last_engagement_date",
    )
    return stamped(out, as_of)


def dim_date(account: DataFrame, as_of: datetime) -> DataFrame:
    """Calendar: every day from the first account's creation date to today; none if that lies ahead."""
    start = account.agg(F.min(F.to_date("created_date")).alias("first"))
    today = day(as_of)
    spine = start.select(
        F.explode(F.when(F.col("first") <= today, F.sequence(F.col("first"), today))).alias("date_key")
    )
    return spine.select("date_key", *[c.alias(n) for n, c in calendar_parts(F.col("date_key")).items()])


def dim_email_engagement(
    email_engagement: DataFrame,
    email_send: DataFrame,
    email_template: DataFrame,
    campaign: DataFrame,
    contact: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """Engagements with what was sent, by which template and campaign, and to whom.

    Sends pick up template and campaign before they meet the far larger engagements.
    """
    sends = lookup(email_send, email_template, "email_template_id", "template_id", "template_name", how="inner")
    sends = lookup(sends, campaign, "campaign_id", "campaign_id", "campaign_name")
    out = lookup(
        email_engagement.select("engagement_id", "engagement_type", "contact_id", "send_id", "engagement_timestamp"),
        sends, "send_id", "send_id", "subject_line", "template_name", "campaign_name", how="inner",
    )
    out = lookup(out, contact, "contact_id", "contact_id", "first_name", "last_name")
    out = out.select(
        surrogate_key("engagement_id").alias("engagement_sk"),
        "engagement_id", "engagement_type", "contact_id", "first_name", "last_name", "send_id",
        "subject_line", "template_name", "campaign_name",
        F.col("engagement_timestamp").cast("timestamp_ntz").alias("engagement_timestamp"),
    )
    return stamped(out, as_of)


def dim_event_outcome(event: DataFrame, opportunity: DataFrame, as_of: datetime, window_days: int = 30) -> DataFrame:
    """Events with the opportunities opened for their contact or lead in the days after."""
    opp = opportunity.select(
        "account_id", "opportunity_id", "opportunity_name", "stage_name", "amount",
        F.col("created_date").alias("opened"),
    )
    joined = disjunctive_left_join(
        event.select("event_id", "subject", "start_date_time", "related_lead_id", "related_contact_id"),
        opp,
        [[("related_contact_id", "account_id")], [("related_lead_id", "account_id")]],
        within_days=("opened", "start_date_time", window_days),
    )
    out = joined.select(
        surrogate_key("event_id", "opportunity_id").alias("event_outcome_sk"),
        "event_id", "subject", "opportunity_id", "opportunity_name", "stage_name", "amount",
        day_diff(F.col("opened"), F.col("start_date_time")).alias("days_to_opportunity"),
        outcome_label(F.col("opportunity_id"), F.col("related_lead_id"), F.col("related_contact_id")).alias(
            "outcome_status"
        ),
    )
    return stamped(out, as_of)


def dim_lead(lead: DataFrame, contact: DataFrame, as_of: datetime) -> DataFrame:
    out = lookup(
        lead, contact, "converted_contact_id", "contact_id",
        F.col("first_name").alias("converted_first_name"), F.col("last_name").alias("converted_last_name"),
    ).select(
        surrogate_key("lead_id").alias("lead_sk"),
        "lead_id", "first_name", "last_name", "company", "email", "phone", "status", "converted_contact_id",
        "converted_first_name", "converted_last_name", F.to_date("created_date").alias("created_date"),
    )
    return stamped(out, as_of)


def dim_lead_conversion(lead: DataFrame, contact: DataFrame, as_of: datetime) -> DataFrame:
    first_seen = contact.groupBy("contact_id").agg(F.min("created_date").alias("conversion_date"))
    out = lookup(lead, first_seen, "converted_contact_id", "contact_id", "conversion_date").select(
        surrogate_key("lead_id").alias("lead_sk"),
        "lead_id", "first_name", "last_name", "company", "email", "phone", "status",
        F.col("converted_contact_id").isNotNull().alias("is_converted"),
        "converted_contact_id", "conversion_date",
        day_diff(F.col("conversion_date"), F.col("created_date")).alias("days_to_convert"),
    )
    return stamped(out, as_of)


def dim_opportunity(opportunity: DataFrame, account: DataFrame, campaign: DataFrame, as_of: datetime) -> DataFrame:
    """Opportunities with their account and campaign.

    The campaign, which adds less to the rows than the account does, comes first.
    """
    out = opportunity.withColumn("__sk", packed_key("opportunity_sk", "opportunity_id"))
    out = lookup(out, campaign, "campaign_id", "campaign_id", "campaign_name")
    out = lookup(out, account, "account_id", "account_id", "account_name", "industry").select(
        unpacked_key("__sk", "opportunity_id").alias("opportunity_sk"), "opportunity_id", "opportunity_name", "stage_name", "amount", "close_date",
        "account_id", "account_name", "industry", "campaign_name",
        day_diff(F.col("close_date"), day(as_of)).alias("days_to_close"),
    )
    return stamped(out, as_of)


def dim_opportunity_performance(
    opportunity: DataFrame, account: DataFrame, campaign: DataFrame, as_of: datetime
) -> DataFrame:
    """Opportunities with their account and campaign, the campaign first as in ``dim_opportunity``."""
    out = opportunity.withColumn("__sk", packed_key("opportunity_sk", "opportunity_id"))
    out = lookup(out, campaign, "campaign_id", "campaign_id", "campaign_name")
    out = lookup(out, account, "account_id", "account_id", "account_name").select(
        unpacked_key("__sk", "opportunity_id").alias("opportunity_sk"), "opportunity_id", "opportunity_name", "account_id", "account_name", "stage_name",
        "amount", "close_date", "campaign_id", "campaign_name",
        day_diff(F.coalesce(F.to_date("close_date"), day(as_of)), F.col("created_date")).alias("days_open"),
        flag(F.col("stage_name"), "Closed Won").alias("is_won"),
    )
    return stamped(out, as_of)
