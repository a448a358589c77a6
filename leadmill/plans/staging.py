"""Staging models: one per entity, a surrogate key in front of the declared columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from leadmill.functions import stamp, surrogate_key
from leadmill.registry import ENTITIES, STAMP

# Name of the surrogate key of each staging table.
SURROGATE_KEYS = {
    "account": "account_sk",
    "campaign": "campaign_sk",
    "campaign_member": "member_sk",
    "contact": "contact_sk",
    "email_engagement": "engagement_sk",
    "email_send": "send_sk",
    "email_template": "template_sk",
    "event": "event_sk",
    "lead": "lead_sk",
    "opportunity": "opportunity_sk",
}


def stage(entity: str, raw: DataFrame, as_of: datetime) -> DataFrame:
    spec = ENTITIES[entity]
    return raw.select(
        surrogate_key(spec.key).alias(SURROGATE_KEYS[entity]),
        *spec.fields,
        stamp(as_of).alias(STAMP),
    )


def stage_email_engagement(raw: DataFrame, contact: DataFrame, as_of: datetime) -> DataFrame:
    """The contact key that a raw engagement carries gives way to the one of its staged contact."""
    known = contact.select(F.col("contact_id").alias("__contact"), "contact_sk")
    joined = raw.drop("contact_sk").join(known, F.col("contact_id") == F.col("__contact"), "left")
    return stage("email_engagement", joined, as_of)
