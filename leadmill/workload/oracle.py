"""Plain SQL definitions of what the models compute, for the checking engine.

These follow the models' definitions literally (joins with OR and BETWEEN, distinct counts over joined
rows), independently of how the Spark side arranges the work.
"""

from __future__ import annotations

from leadmill.functions.keys import KEY_SEPARATOR, NULL_KEY_TEXT
from leadmill.plans.staging import SURROGATE_KEYS
from leadmill.registry import ENTITIES
from leadmill.workload.views import AS_OF, VIEW_SQL, oracle_view

TODAY = f"DATE '{AS_OF:%Y-%m-%d}'"
STAMPED = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}' AS last_modified_timestamp"


def sk(*cols: str) -> str:
    parts = [f"COALESCE(CAST({c} AS VARCHAR), '{NULL_KEY_TEXT}')" for c in cols]
    return f"md5({f' || {KEY_SEPARATOR!r} || '.join(parts)})"


CTES: dict[str, str] = {f"raw_{name}": oracle_view(name) for name in VIEW_SQL}

for _name, _spec in ENTITIES.items():
    if _name != "email_engagement":
        CTES[f"stg_{_name}"] = (
            f"SELECT {sk(_spec.key)} AS {SURROGATE_KEYS[_name]}, {', '.join(_spec.fields)}, {STAMPED} "
            f"FROM raw_{_name}"
        )

CTES["stg_email_engagement"] = f"""
    SELECT {sk('g.engagement_id')} AS engagement_sk, g.engagement_id, g.send_id, g.contact_id, p.contact_sk,
           g.engagement_type, g.engagement_timestamp, g.link_url, {STAMPED}
    FROM raw_email_engagement g LEFT JOIN stg_contact p ON p.contact_id = g.contact_id"""

CTES["dim_campaign"] = f"""
    SELECT {sk('campaign_id')} AS campaign_sk, campaign_id, campaign_name, start_date, end_date, status, budget,
           {STAMPED}
    FROM stg_campaign"""

CTES["dim_campaign_member_engagement"] = f"""
    SELECT m.member_sk, m.member_id, m.campaign_id, k.campaign_name, m.contact_id, m.lead_id,
           m.status AS member_status, m.first_responded_date,
           COUNT(DISTINCT g.engagement_id) AS total_engagements,
           COUNT(DISTINCT g.engagement_id) FILTER (WHERE g.engagement_type = 'Open') AS email_opens,
           COUNT(DISTINCT v.event_id) AS event_attendances,
           MAX(COALESCE(g.engagement_timestamp, v.start_date_time)) AS last_engagement_date, {STAMPED}
    FROM stg_campaign_member m
    LEFT JOIN stg_campaign k ON k.campaign_id = m.campaign_id
    LEFT JOIN stg_email_engagement g ON g.contact_id = m.contact_id OR g.contact_id = m.lead_id
    LEFT JOIN stg_event v ON v.related_campaign_id = m.campaign_id
         AND (v.related_contact_id = m.contact_id OR v.related_lead_id = m.lead_id)
    GROUP BY ALL"""

CTES["dim_campaign_performance"] = f"""
    SELECT k.campaign_sk, k.campaign_id, k.campaign_name, k.status, k.start_date, k.end_date,
           COUNT(DISTINCT g.contact_sk) AS unique_recipients,
           COUNT(DISTINCT g.engagement_sk) FILTER (WHERE g.engagement_type = 'Open') AS total_opens,
           COUNT(DISTINCT g.engagement_sk) FILTER (WHERE g.engagement_type = 'Click') AS total_clicks, {STAMPED}
    FROM stg_campaign k
    LEFT JOIN stg_email_send d ON d.campaign_id = k.campaign_id
    LEFT JOIN stg_email_engagement g ON g.send_id = d.send_id
    GROUP BY ALL"""

CTES["dim_contact_engagement"] = f"""
    SELECT p.contact_sk, p.contact_id, p.first_name, p.last_name, p.email,
           COUNT(DISTINCT g.engagement_id) AS total_engagements,
           COUNT(DISTINCT g.engagement_id) FILTER (WHERE g.engagement_type = 'Open') AS email_opens,
           COUNT(DISTINCT g.engagement_id) FILTER (WHERE g.engagement_type = 'Click') AS link_clicks,
           MAX(g.engagement_timestamp) AS last_engagement_date, {STAMPED}
    FROM stg_contact p LEFT JOIN stg_email_engagement g ON g.contact_id = p.contact_id
    GROUP BY ALL"""

CTES["dim_date"] = f"""
    SELECT d AS date_key, year(d) AS year, month(d) AS month, day(d) AS day, dayofweek(d) AS day_of_week,
           dayofyear(d) AS day_of_year, quarter(d) AS quarter, weekofyear(d) AS week_of_year
    FROM (SELECT CAST(UNNEST(generate_series(CAST(MIN(created_date) AS DATE), {TODAY}, INTERVAL 1 DAY)) AS DATE) AS d
          FROM stg_account)"""

CTES["dim_email_engagement"] = f"""
    SELECT {sk('g.engagement_id')} AS engagement_sk, g.engagement_id, g.engagement_type, g.contact_id,
           p.first_name, p.last_name, d.send_id, d.subject_line, t.template_name, k.campaign_name,
           g.engagement_timestamp, {STAMPED}
    FROM stg_email_engagement g
    JOIN stg_email_send d ON d.send_id = g.send_id
    JOIN stg_email_template t ON t.template_id = d.email_template_id
    LEFT JOIN stg_campaign k ON k.campaign_id = d.campaign_id
    LEFT JOIN stg_contact p ON p.contact_id = g.contact_id"""

CTES["dim_event_outcome"] = f"""
    SELECT {sk('v.event_id', 'o.opportunity_id')} AS event_outcome_sk, v.event_id, v.subject, o.opportunity_id,
           o.opportunity_name, o.stage_name, o.amount,
           datediff('day', CAST(v.start_date_time AS DATE), CAST(o.created_date AS DATE)) AS days_to_opportunity,
           CASE WHEN o.opportunity_id IS NOT NULL THEN 'Has Opportunity'
                WHEN v.related_lead_id IS NOT NULL THEN 'Has Lead'
                WHEN v.related_contact_id IS NOT NULL THEN 'Has Contact' ELSE 'No Link' END AS outcome_status,
           {STAMPED}
    FROM stg_event v LEFT JOIN stg_opportunity o
      ON (o.account_id = v.related_contact_id OR o.account_id = v.related_lead_id)
     AND CAST(o.created_date AS DATE) BETWEEN CAST(v.start_date_time AS DATE)
                                          AND CAST(v.start_date_time AS DATE) + 30"""

CTES["dim_lead"] = f"""
    SELECT {sk('a.lead_id')} AS lead_sk, a.lead_id, a.first_name, a.last_name, a.company, a.email, a.phone, a.status,
           a.converted_contact_id, p.first_name AS converted_first_name, p.last_name AS converted_last_name,
           CAST(a.created_date AS DATE) AS created_date, {STAMPED}
    FROM stg_lead a LEFT JOIN stg_contact p ON p.contact_id = a.converted_contact_id"""

CTES["dim_lead_conversion"] = f"""
    SELECT lead_sk, lead_id, first_name, last_name, company, email, phone, status,
           converted_contact_id IS NOT NULL AS is_converted, converted_contact_id, conversion_date,
           datediff('day', CAST(created_date AS DATE), CAST(conversion_date AS DATE)) AS days_to_convert, {STAMPED}
    FROM (SELECT {sk('a.lead_id')} AS lead_sk, a.lead_id, a.first_name, a.last_name, a.company, a.email, a.phone,
                 a.status, a.converted_contact_id, a.created_date, MIN(p.created_date) AS conversion_date
          FROM stg_lead a LEFT JOIN stg_contact p ON p.contact_id = a.converted_contact_id GROUP BY ALL)"""

CTES["dim_opportunity"] = f"""
    SELECT o.opportunity_sk, o.opportunity_id, o.opportunity_name, o.stage_name, o.amount, o.close_date, o.account_id,
           a.account_name, a.industry, k.campaign_name,
           datediff('day', {TODAY}, CAST(o.close_date AS DATE)) AS days_to_close, {STAMPED}
    FROM stg_opportunity o
    LEFT JOIN stg_account a ON a.account_id = o.account_id
    LEFT JOIN stg_campaign k ON k.campaign_id = o.campaign_id"""

CTES["dim_opportunity_performance"] = f"""
    SELECT o.opportunity_sk, o.opportunity_id, o.opportunity_name, o.account_id, a.account_name, o.stage_name,
           o.amount, o.close_date, o.campaign_id, k.campaign_name,
           datediff('day', CAST(o.created_date AS DATE), COALESCE(CAST(o.close_date AS DATE), {TODAY})) AS days_open,
           o.stage_name = 'Closed Won' AS is_won, {STAMPED}
    FROM stg_opportunity o
    LEFT JOIN stg_account a ON a.account_id = o.account_id
    LEFT JOIN stg_campaign k ON k.campaign_id = o.campaign_id"""

# Who an engagement reaches in its campaign: a contact, known or not, and each lead that became that contact.
CTES["reached"] = """
    SELECT r.engagement_id, r.contact_id, send.campaign_id, person.contact_id AS person_id, stg_lead.lead_id
    FROM stg_email_engagement r
    LEFT JOIN (SELECT send_id, campaign_id FROM stg_email_send SEMI JOIN stg_campaign USING (campaign_id)) send
      USING (send_id)
    LEFT JOIN stg_contact person ON person.contact_id = r.contact_id
    LEFT JOIN stg_lead ON stg_lead.converted_contact_id = person.contact_id"""


def reached_by(table: str, columns: str, campaign: str, *arms: tuple[str, str]) -> str:
    """Pairs of an engagement's lead (or none) and what of ``table`` it reaches: by one equality or another, once."""
    return " UNION ".join(
        f"SELECT engagement_id, lead_id, {columns} FROM reached "
        f"JOIN (SELECT {columns}, {campaign} AS at_campaign, {theirs} AS who FROM {table}) "
        f"ON at_campaign = reached.campaign_id AND who = reached.{ours}"
        for ours, theirs in arms
    )


CTES["reached_opportunity"] = reached_by(
    "stg_opportunity", "opportunity_sk, opportunity_id, opportunity_name", "campaign_id",
    ("person_id", "account_id"), ("lead_id", "account_id"),
)
CTES["reached_event"] = reached_by(
    "stg_event", "event_sk, event_id, type, start_date_time", "related_campaign_id",
    ("contact_id", "related_contact_id"), ("lead_id", "related_lead_id"),
)
CTES["reached_member"] = reached_by(
    "stg_campaign_member", "member_sk, member_id", "campaign_id", ("contact_id", "contact_id"), ("lead_id", "lead_id")
)
_SAME = "{0}.engagement_id = reached.engagement_id AND {0}.lead_id IS NOT DISTINCT FROM reached.lead_id"

CTES["fact_marketing_performance"] = f"""
    SELECT md5(concat(engagement_sk, event_sk, opportunity_sk)) AS fact_sk,
           * EXCLUDE (moment, start_date), CAST(moment AS DATE) AS engagement_date, hour(moment) AS engagement_hour,
           datediff('day', CAST(start_date AS DATE), CAST(moment AS DATE)) AS days_since_campaign_start, {STAMPED}
    FROM (SELECT sent.engagement_sk, sent.engagement_id, sent.engagement_type, sent.engagement_timestamp, sent.link_url,
                 sent.engagement_type = 'Open' AS is_open, sent.engagement_type = 'Click' AS is_click,
                 stg_email_send.send_sk, stg_email_send.send_id, email_template_id, send_date, subject_line,
                 stg_campaign.campaign_sk, stg_campaign.campaign_id, stg_campaign.campaign_name, start_date,
                 stg_contact.contact_sk, stg_contact.contact_id,
                 stg_contact.first_name AS contact_first_name, stg_contact.last_name AS contact_last_name,
                 lead_sk, reached.lead_id, stg_lead.first_name AS lead_first_name, stg_lead.last_name AS lead_last_name,
                 opportunity_sk, opportunity_id, opportunity_name, event_sk, event_id, happened.type AS event_type,
                 member_sk, member_id, COALESCE(sent.engagement_timestamp, start_date_time) AS moment
          FROM reached
          JOIN stg_email_engagement sent ON sent.engagement_id = reached.engagement_id
          LEFT JOIN stg_email_send ON stg_email_send.send_id = sent.send_id
          LEFT JOIN stg_campaign ON stg_campaign.campaign_id = reached.campaign_id
          LEFT JOIN stg_contact ON stg_contact.contact_id = reached.person_id
          LEFT JOIN stg_lead ON stg_lead.lead_id = reached.lead_id
          LEFT JOIN reached_opportunity won ON {_SAME.format('won')}
          LEFT JOIN reached_event happened ON {_SAME.format('happened')}
          LEFT JOIN reached_member joined ON {_SAME.format('joined')})"""

CTES["fct_campaign_performance"] = f"""
    SELECT {sk('campaign_sk', 'date_key')} AS campaign_date_sk, *, {STAMPED}
    FROM (SELECT t.date_key, k.campaign_sk, k.campaign_id, k.campaign_name, k.status,
                 COUNT(DISTINCT m.contact_id) AS unique_contacts_engaged,
                 COUNT(DISTINCT m.member_id) AS total_members,
                 CAST(SUM(m.total_engagements) AS DECIMAL(38,0)) AS total_engagements,
                 CAST(SUM(m.email_opens) AS DECIMAL(38,0)) AS total_opens,
                 COUNT(DISTINCT g.engagement_id) FILTER (WHERE g.engagement_type = 'Click') AS link_clicks,
                 COUNT(DISTINCT o.opportunity_id) AS opportunities_generated,
                 CAST(SUM(o.amount) AS DECIMAL(38,2)) AS opportunity_amount
          FROM dim_campaign k
          JOIN dim_date t ON t.date_key BETWEEN k.start_date AND COALESCE(k.end_date, {TODAY})
          LEFT JOIN dim_campaign_member_engagement m ON m.campaign_id = k.campaign_id
          LEFT JOIN dim_email_engagement g ON g.contact_id = m.contact_id
          LEFT JOIN dim_opportunity_performance o ON o.campaign_id = k.campaign_id
          GROUP BY ALL)"""

# A member's people: the contact and each of its leads; of members without a contact, none.
CTES["member_people"] = """
    SELECT campaign_id, member_sk, total_engagements, email_opens, event_attendances, contact_sk, lead_sk, is_converted,
           days_to_convert
    FROM (SELECT campaign_id, member_sk, total_engagements, email_opens, event_attendances, contact_id
          FROM dim_campaign_member_engagement)
    LEFT JOIN (SELECT contact_id, contact_sk, lead_sk, is_converted, days_to_convert
               FROM (SELECT contact_id, contact_sk FROM dim_contact_engagement)
               LEFT JOIN dim_lead_conversion ON converted_contact_id = contact_id) USING (contact_id)"""

# Every day of a campaign's span; one null day for a campaign whose span holds none.
CTES["campaign_day"] = f"""
    SELECT campaign_id, UNNEST(CASE WHEN len(days) > 0 THEN days ELSE [NULL] END) AS date_key
    FROM (SELECT campaign_id, start_date, COALESCE(end_date, {TODAY}) AS last,
                 list_filter((SELECT list(date_key) FROM dim_date), lambda d: d BETWEEN start_date AND last) AS days
          FROM dim_campaign)"""

_DAILY_KEY = sk("campaign_sk", "member_sk", "contact_sk", "lead_sk", "opportunity_sk", "date_key")
CTES["fct_daily_performance"] = f"""
    SELECT {_DAILY_KEY} AS daily_performance_sk,
           campaign_sk, member_sk, contact_sk, lead_sk, opportunity_sk, date_key, campaign_budget, unique_recipients,
           total_opens, total_clicks, total_engagements, email_opens, event_attendances, is_converted, days_to_convert,
           opportunity_amount, days_open, is_won, open_rate, click_through_rate, {STAMPED}
    FROM (SELECT campaign_id, campaign_sk, budget AS campaign_budget FROM dim_campaign)
    JOIN (SELECT campaign_id, unique_recipients, total_opens, total_clicks,
                 CASE WHEN unique_recipients > 0 THEN CAST(total_opens AS DOUBLE) / unique_recipients END AS open_rate,
                 CASE WHEN total_opens > 0 THEN CAST(total_clicks AS DOUBLE) / total_opens END AS click_through_rate
          FROM dim_campaign_performance) USING (campaign_id)
    JOIN campaign_day USING (campaign_id)
    LEFT JOIN member_people USING (campaign_id)
    LEFT JOIN (SELECT campaign_id, opportunity_sk, amount AS opportunity_amount, days_open, is_won
               FROM dim_opportunity_performance) USING (campaign_id)"""

CTES["fct_event_performance"] = f"""
    SELECT {sk('event_id')} AS event_outcome_sk, *, {STAMPED}
    FROM (SELECT v.event_id, v.subject, v.outcome_status, v.days_to_opportunity, v.opportunity_id,
                 COUNT(DISTINCT g.engagement_id) AS total_engagements_before_event,
                 COUNT(DISTINCT g.engagement_id) FILTER (WHERE g.engagement_type = 'Click') AS pre_event_clicks,
                 MIN(datediff('hour', g.engagement_timestamp,
                     CAST({TODAY} + CAST(v.days_to_opportunity AS INT) AS TIMESTAMP))) AS hours_before_opportunity
          FROM dim_event_outcome v
          LEFT JOIN dim_email_engagement g ON g.campaign_name = v.event_id
               AND g.engagement_timestamp < {TODAY} - CAST(v.days_to_opportunity AS INT)
          GROUP BY ALL)"""

CTES["fct_lead_to_opportunity_conversion"] = f"""
    SELECT {sk('a.lead_id')} AS lead_sk, a.lead_id, a.first_name, a.last_name, a.status, c.is_converted,
           c.conversion_date, c.days_to_convert, COUNT(DISTINCT o.opportunity_id) AS opportunities_created,
           CAST(SUM(o.amount) AS DECIMAL(38,2)) AS total_pipeline, {STAMPED}
    FROM dim_lead a
    LEFT JOIN dim_lead_conversion c ON c.lead_id = a.lead_id
    LEFT JOIN dim_opportunity o ON o.account_id = a.converted_contact_id
    GROUP BY ALL"""


def with_ctes(query: str, extra: dict[str, str] | None = None) -> str:
    """``query`` with the definitions it uses, directly or not, in front of it."""
    defs = CTES | (extra or {})
    order: list[str] = []

    def visit(text: str) -> None:
        for name, body in defs.items():
            if name not in order and name in _words(text):
                visit(body)
                if name not in order:
                    order.append(name)

    visit(query)
    if not order:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({defs[n]})" for n in order) + "\n" + query


def _words(text: str) -> set[str]:
    return set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in text).split())
