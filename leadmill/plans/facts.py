"""Fact models. Inputs are unique on their declared keys, as for the dimensions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from leadmill.functions import (
    day_diff,
    fact_key,
    first_whole_day,
    flag,
    hour_boundaries,
    packed_key,
    stamp,
    surrogate_key,
    unpacked_key,
    zero_safe_ratio,
)
from leadmill.functions.times import day
from leadmill.operators.joins import days_between, disjunctive_pairs, fanout_left_join, one_to_many
from leadmill.plans.dimensions import lookup, stamped
from leadmill.registry import STAMP

MONEY_SUM = "decimal(38,2)"
COUNT_SUM = "decimal(38,0)"


def fact_marketing_performance(
    email_engagement: DataFrame,
    email_send: DataFrame,
    campaign: DataFrame,
    contact: DataFrame,
    lead: DataFrame,
    opportunity: DataFrame,
    event: DataFrame,
    campaign_member: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """Engagements with send, campaign, contact, leads, and the opportunities, events and members that
    share the campaign and either the contact or a lead.

    Which opportunities, events and members belong to an engagement depends only on its campaign,
    contact and lead. They are matched once per distinct combination, by equi joins on campaign and
    contact and on campaign and lead, and then meet the engagements by one common key. On the way, surrogate keys are
    left out where they hash their ids.
    """
    own = lambda sk, key: packed_key(sk, key).alias(f"{sk}__packed")
    sends = lookup(
        email_send.select(own("send_sk", "send_id"), "send_id", "email_template_id", "send_date", "subject_line", "campaign_id"),
        campaign.select(
            own("campaign_sk", "campaign_id"), F.col("campaign_id").alias("known_campaign"), "campaign_name", "start_date"
        ),
        "campaign_id", "known_campaign", "campaign_sk__packed", "known_campaign", "campaign_name", "start_date",
    ).drop("campaign_id")
    contacts = contact.select(
        own("contact_sk", "contact_id"), F.col("contact_id").alias("known_contact"), "first_name", "last_name"
    )
    leads = lead.select(
        own("lead_sk", "lead_id"), "lead_id", F.col("first_name").alias("lead_first_name"),
        F.col("last_name").alias("lead_last_name"), "converted_contact_id",
    )

    base = lookup(
        email_engagement.select(
            own("engagement_sk", "engagement_id"),
            *[c for c in email_engagement.columns if c not in ("engagement_sk", "contact_sk", STAMP)],
        ),
        sends.withColumnRenamed("send_id", "known_send"),
        "send_id", "known_send", *[c for c in sends.columns if c != "send_id"],
        F.col("known_send").alias("sent_id"),
    )
    people = one_to_many(contacts, leads.withColumnRenamed("converted_contact_id", "known_contact"), "known_contact")
    base = fanout_left_join(
        base, people.withColumn("contact_id", F.col("known_contact")), "contact_id",
        left_rows=email_engagement.select("contact_id"),
        left_spread=["engagement_id"], right_spread=["lead_id"],
    )

    touched = lookup(
        email_engagement.select("send_id", "contact_id"), sends, "send_id", "send_id", "known_campaign", how="inner"
    )
    touched = touched.where("known_campaign IS NOT NULL AND contact_id IS NOT NULL").select(
        "known_campaign", "contact_id"
    ).distinct()
    touched = lookup(touched, contacts, "contact_id", "known_contact", "known_contact")
    touched = lookup(touched, leads, "known_contact", "converted_contact_id", "lead_id")

    combo = ["known_campaign", "contact_id", "lead_id"]
    opp = opportunity.select(
        own("opportunity_sk", "opportunity_id"), "opportunity_id", "opportunity_name",
        F.col("campaign_id").alias("opp_campaign"), F.col("account_id").alias("opp_account"),
    )
    ev = event.select(
        own("event_sk", "event_id"), "event_id", F.col("type").alias("event_type"), F.col("start_date_time").alias("event_start"),
        F.col("related_campaign_id").alias("event_campaign"), F.col("related_contact_id").alias("event_contact"),
        F.col("related_lead_id").alias("event_lead"),
    )
    member = campaign_member.select(
        own("member_sk", "member_id"), "member_id", F.col("campaign_id").alias("member_campaign"),
        F.col("contact_id").alias("member_contact"), F.col("lead_id").alias("member_lead"),
    )
    sides = [
        (opp, [[("known_campaign", "opp_campaign"), ("known_contact", "opp_account")],
               [("known_campaign", "opp_campaign"), ("lead_id", "opp_account")]]),
        (ev, [[("known_campaign", "event_campaign"), ("contact_id", "event_contact")],
              [("known_campaign", "event_campaign"), ("lead_id", "event_lead")]]),
        (member, [[("known_campaign", "member_campaign"), ("contact_id", "member_contact")],
                  [("known_campaign", "member_campaign"), ("lead_id", "member_lead")]]),
    ]
    rows = base
    for side, arms in sides:
        pairs = disjunctive_pairs(touched, side, combo, arms, distinct_left=False)
        on = [rows[c] == pairs[f"__l_{c}"] for c in combo[:2]]
        on.append(rows["lead_id"].eqNullSafe(pairs["__l_lead_id"]))
        rows = rows.join(pairs, on, "left").drop(*[f"__l_{c}" for c in combo])

    keys = {
        "engagement_sk": "engagement_id", "send_sk": "sent_id", "campaign_sk": "known_campaign", "contact_sk": "known_contact",
        "lead_sk": "lead_id", "opportunity_sk": "opportunity_id", "event_sk": "event_id", "member_sk": "member_id",
    }
    rows = rows.withColumns({sk: unpacked_key(f"{sk}__packed", key) for sk, key in keys.items()})
    at = F.coalesce(F.col("engagement_timestamp"), F.col("event_start"))
    return rows.select(
        fact_key("engagement_sk", "event_sk", "opportunity_sk").alias("fact_sk"),
        "engagement_sk", "engagement_id", "engagement_type", "engagement_timestamp", "link_url",
        flag(F.col("engagement_type"), "Open").alias("is_open"),
        flag(F.col("engagement_type"), "Click").alias("is_click"),
        "send_sk", F.col("sent_id").alias("send_id"), "email_template_id", "send_date", "subject_line",
        "campaign_sk", F.col("known_campaign").alias("campaign_id"), "campaign_name",
        "contact_sk", F.col("known_contact").alias("contact_id"),
        F.col("first_name").alias("contact_first_name"), F.col("last_name").alias("contact_last_name"),
        "lead_sk", "lead_id", "lead_first_name", "lead_last_name",
        "opportunity_sk", "opportunity_id", "opportunity_name",
        "event_sk", "event_id", "event_type",
        "member_sk", "member_id",
        F.to_date(at).alias("engagement_date"),
        F.hour(at).cast("bigint").alias("engagement_hour"),
        day_diff(at, F.col("start_date")).alias("days_since_campaign_start"),
        stamp(as_of).alias(STAMP),
    )


def campaign_days(campaign: DataFrame, dates: DataFrame, as_of: datetime) -> DataFrame:
    """``campaign_id`` and each calendar date within the campaign; an open campaign runs until today."""
    last = F.coalesce(F.to_date("end_date"), day(as_of))
    days = campaign.select(
        "campaign_id", F.explode(days_between(first_whole_day(F.col("start_date")), last)).alias("date_key")
    )
    return days.join(dates.select("date_key"), "date_key")


def fct_campaign_performance(
    dim_campaign: DataFrame,
    dim_date: DataFrame,
    dim_campaign_member_engagement: DataFrame,
    dim_email_engagement: DataFrame,
    dim_opportunity_performance: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """Campaign results on each of its days.

    The model is defined on the product of a campaign's members, their engagements and the campaign's
    opportunities, and its sums count every combination. That product is never built: a sum over it
    equals the sum over one side times the row counts of the other sides, taken per campaign.
    """
    engagements = dim_email_engagement.groupBy("contact_id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.count(F.when(flag(F.col("engagement_type"), "Click"), F.col("engagement_id"))).alias("clicks"),
    )
    members = dim_campaign_member_engagement.groupBy("campaign_id", "contact_id").agg(
        F.count("member_id").alias("members"),
        F.count(F.lit(1)).alias("member_rows"),
        F.sum("total_engagements").alias("engaged"),
        F.sum("email_opens").alias("opened"),
    )
    # Products of counts outgrow 64 bits long before the counts do.
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    copies = F.coalesce(F.col("copies"), F.lit(1))
    members = (
        lookup(members, engagements, "contact_id", "contact_id", "copies", "clicks")
        .groupBy("campaign_id")
        .agg(
            F.count("contact_id").alias("unique_contacts_engaged"),
            F.sum("members").alias("total_members"),
            F.sum(wide("engaged") * copies).cast(COUNT_SUM).alias("engaged"),
            F.sum(wide("opened") * copies).cast(COUNT_SUM).alias("opened"),
            F.coalesce(F.sum("clicks"), F.lit(0)).alias("link_clicks"),
            F.sum(F.col("member_rows") * copies).alias("member_copies"),
        )
    )
    opps = dim_opportunity_performance.groupBy("campaign_id").agg(
        F.count("opportunity_id").alias("opportunities_generated"),
        F.count(F.lit(1)).alias("opp_copies"),
        F.sum("amount").alias("amount"),
    )
    base = dim_campaign.select("campaign_sk", "campaign_id", "campaign_name", "status", "start_date", "end_date")
    base = lookup(base, members, "campaign_id", "campaign_id", *[c for c in members.columns if c != "campaign_id"])
    base = lookup(base, opps, "campaign_id", "campaign_id", *[c for c in opps.columns if c != "campaign_id"])
    days = campaign_days(dim_campaign, dim_date, as_of)
    base = base.drop("start_date", "end_date").join(days, "campaign_id")

    zero = F.lit(0).cast("bigint")
    opp_copies = F.coalesce(F.col("opp_copies"), F.lit(1))
    member_copies = F.coalesce(F.col("member_copies"), F.lit(1))
    out = base.select(
        surrogate_key("campaign_sk", "date_key").alias("campaign_date_sk"),
        "date_key", "campaign_sk", "campaign_id", "campaign_name", "status",
        F.coalesce("unique_contacts_engaged", zero).alias("unique_contacts_engaged"),
        F.coalesce("total_members", zero).alias("total_members"),
        (F.col("engaged") * opp_copies).cast(COUNT_SUM).alias("total_engagements"),
        (F.col("opened") * opp_copies).cast(COUNT_SUM).alias("total_opens"),
        F.coalesce("link_clicks", zero).alias("link_clicks"),
        F.coalesce("opportunities_generated", zero).alias("opportunities_generated"),
        (F.col("amount") * member_copies).cast(MONEY_SUM).alias("opportunity_amount"),
    )
    return stamped(out, as_of)


def fct_daily_performance(
    dim_campaign: DataFrame,
    dim_campaign_performance: DataFrame,
    dim_campaign_member_engagement: DataFrame,
    dim_contact_engagement: DataFrame,
    dim_lead_conversion: DataFrame,
    dim_opportunity_performance: DataFrame,
    dim_date: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """Every combination of a campaign's members, their leads, its opportunities and its days.

    The rows of the result are that product, so the joins are cut into balanced cells. Only a campaign's
    first and last calendar date travel through them; the days between come out at the end, since the
    calendar has every day from its first to its last. A campaign meets its members and opportunities in the same
    cells, so that members move once for both. On the way, surrogate keys are left out where they hash their ids.
    """
    own = lambda sk, key: packed_key(sk, key).alias(f"{sk}__packed")
    days = (
        campaign_days(dim_campaign, dim_date, as_of)
        .groupBy("campaign_id")
        .agg(F.min("date_key").alias("first_day"), F.max("date_key").alias("last_day"))
    )
    camp = dim_campaign.select(own("campaign_sk", "campaign_id"), "campaign_id", F.col("budget").alias("campaign_budget"))
    camp = lookup(
        camp, dim_campaign_performance, "campaign_id", "campaign_id",
        "unique_recipients", "total_opens", "total_clicks",
    )
    camp = lookup(camp, days, "campaign_id", "campaign_id", "first_day", "last_day")

    members = dim_campaign_member_engagement.select(
        own("member_sk", "member_id"), "member_id", "campaign_id", "contact_id", "total_engagements", "email_opens",
        "event_attendances",
    )
    people = one_to_many(
        dim_contact_engagement.select("contact_id", own("contact_sk", "contact_id")),
        dim_lead_conversion.select(
            own("lead_sk", "lead_id"), "lead_id", "is_converted", "days_to_convert", F.col("converted_contact_id").alias("contact_id")
        ),
        "contact_id",
    )
    members = fanout_left_join(
        members, people, "contact_id",
        left_rows=dim_campaign_member_engagement.select("contact_id"),
        left_spread=["member_id"], right_spread=["lead_id"],
    )
    opps = dim_opportunity_performance.select(
        own("opportunity_sk", "opportunity_id"), "opportunity_id", F.col("amount").alias("opportunity_amount"), "days_open",
        "is_won", "campaign_id",
    )
    per_campaign = dim_campaign_member_engagement.select("campaign_id")
    rows = fanout_left_join(
        members, opps, "campaign_id", left_rows=per_campaign,
        left_spread=["member_id", "lead_id"], right_spread=["opportunity_id"], one=camp,
    )
    keys = {
        "campaign_sk": "campaign_id", "member_sk": "member_id", "contact_sk": "contact_id", "lead_sk": "lead_id",
        "opportunity_sk": "opportunity_id",
    }
    rows = rows.withColumns({sk: unpacked_key(f"{sk}__packed", key) for sk, key in keys.items()})
    rows = rows.withColumn("date_key", F.explode_outer(days_between(F.col("first_day"), F.col("last_day"))))
    out = rows.select(
        surrogate_key("campaign_sk", "member_sk", "contact_sk", "lead_sk", "opportunity_sk", "date_key").alias(
            "daily_performance_sk"
        ),
        "campaign_sk", "member_sk", "contact_sk", "lead_sk", "opportunity_sk", "date_key", "campaign_budget",
        "unique_recipients", "total_opens", "total_clicks", "total_engagements", "email_opens",
        "event_attendances", "is_converted", "days_to_convert", "opportunity_amount", "days_open", "is_won",
        zero_safe_ratio(F.col("total_opens"), F.col("unique_recipients")).alias("open_rate"),
        zero_safe_ratio(F.col("total_clicks"), F.col("total_opens")).alias("click_through_rate"),
    )
    return stamped(out, as_of)


def fct_event_performance(
    dim_event_outcome: DataFrame,
    dim_email_engagement: DataFrame,
    as_of: datetime,
    event_column: str = "event_id",
    engagement_column: str = "campaign_name",
) -> DataFrame:
    """Engagements that came before an event's opportunity, at event and opportunity grain.

    The cut-off is a midnight, so engagements are summed up per day first; the smallest distance in hours belongs to
    the latest engagement. A name's days, which are no more than the calendar has, then meet the event's rows as one
    list: one row for each name, and no join over pairs of rows and days.
    """
    daily = (
        dim_email_engagement.where(F.col("engagement_timestamp").isNotNull() & F.col(engagement_column).isNotNull())
        .groupBy(F.col(engagement_column).alias("__name"), F.to_date("engagement_timestamp").alias("__day"))
        .agg(
            F.count("engagement_id").alias("n"),
            F.count(F.when(flag(F.col("engagement_type"), "Click"), F.col("engagement_id"))).alias("clicks"),
            F.max("engagement_timestamp").alias("latest"),
        )
    )
    per_name = daily.groupBy("__name").agg(F.collect_list(F.struct("__day", "n", "clicks", "latest")).alias("__daily"))
    days = F.col("days_to_opportunity").cast("int")
    cut_off = F.date_sub(day(as_of), days)
    target = F.date_add(day(as_of), days).cast("timestamp_ntz")
    zero = F.lit(0).cast("bigint")
    out = dim_event_outcome.join(per_name, dim_event_outcome[event_column] == per_name["__name"], "left")
    out = out.withColumn("__before", F.filter("__daily", lambda d: d["__day"] < cut_off))
    out = out.select(
        surrogate_key("event_id").alias("event_outcome_sk"),
        "event_id", "subject", "outcome_status", "days_to_opportunity", "opportunity_id",
        F.coalesce(F.aggregate("__before", zero, lambda total, d: total + d["n"]), zero).alias("total_engagements_before_event"),
        F.coalesce(F.aggregate("__before", zero, lambda total, d: total + d["clicks"]), zero).alias("pre_event_clicks"),
        hour_boundaries(F.array_max(F.transform("__before", lambda d: d["latest"])), target).alias("hours_before_opportunity"),
    )
    return stamped(out, as_of)


def fct_lead_to_opportunity_conversion(
    dim_lead: DataFrame, dim_lead_conversion: DataFrame, dim_opportunity: DataFrame, as_of: datetime
) -> DataFrame:
    per_account = dim_opportunity.groupBy("account_id").agg(
        F.count("opportunity_id").alias("opportunities"), F.sum("amount").alias("pipeline")
    )
    out = lookup(
        dim_lead.select("lead_id", "first_name", "last_name", "status", "converted_contact_id"),
        dim_lead_conversion, "lead_id", "lead_id", "is_converted", "conversion_date", "days_to_convert",
    )
    out = lookup(out, per_account, "converted_contact_id", "account_id", "opportunities", "pipeline").select(
        surrogate_key("lead_id").alias("lead_sk"),
        "lead_id", "first_name", "last_name", "status", "is_converted", "conversion_date", "days_to_convert",
        F.coalesce("opportunities", F.lit(0)).alias("opportunities_created"),
        F.col("pipeline").cast(MONEY_SUM).alias("total_pipeline"),
    )
    return stamped(out, as_of)
