"""Declared entities: columns, key, and how each is laid out in the lake."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TIME = "timestamp_ntz"
MONEY = "decimal(15,2)"


@dataclass(frozen=True)
class EntitySpec:
    name: str
    key: str
    fields: dict[str, str]
    # partition column -> (source column, unit); unit "value" partitions by the column itself
    partitions: dict[str, tuple[str, str]] = field(default_factory=dict)
    sort: tuple[str, ...] = ()

    @property
    def time_fields(self) -> list[str]:
        return [c for c, t in self.fields.items() if t == TIME]

    @property
    def partition_columns(self) -> list[str]:
        return list(self.partitions)

    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in self.fields.items()))


# The ten entities, their columns and types, keys, partitions and sort order.
# Times become zone-free timestamps and money becomes DECIMAL(15,2). A send is partitioned by the
# month of its date, because one partition per time value would mean one file per row.
ENTITIES: dict[str, EntitySpec] = {
    e.name: e
    for e in (
        EntitySpec(
            "account",
            "account_id",
            {
                "account_id": "string",
                "account_name": "string",
                "industry": "string",
                "website": "string",
                "annual_revenue": MONEY,
                "created_date": TIME,
            },
            {"created_year": ("created_date", "year")},
            ("created_date",),
        ),
        EntitySpec(
            "campaign",
            "campaign_id",
            {
                "campaign_id": "string",
                "campaign_name": "string",
                "start_date": TIME,
                "end_date": TIME,
                "status": "string",
                "budget": MONEY,
            },
            {"status": ("status", "value"), "start_month": ("start_date", "month")},
            ("status", "start_date"),
        ),
        EntitySpec(
            "contact",
            "contact_id",
            {
                "contact_id": "string",
                "first_name": "string",
                "last_name": "string",
                "email": "string",
                "phone": "string",
                "created_date": TIME,
            },
            {"created_month": ("created_date", "month")},
            ("created_date",),
        ),
        EntitySpec(
            "lead",
            "lead_id",
            {
                "lead_id": "string",
                "first_name": "string",
                "last_name": "string",
                "company": "string",
                "email": "string",
                "phone": "string",
                "status": "string",
                "converted_contact_id": "string",
                "created_date": TIME,
            },
            {"status": ("status", "value"), "created_month": ("created_date", "month")},
            ("status", "created_date"),
        ),
        EntitySpec(
            "campaign_member",
            "member_id",
            {
                "member_id": "string",
                "campaign_id": "string",
                "contact_id": "string",
                "lead_id": "string",
                "status": "string",
                "first_responded_date": TIME,
                "created_date": TIME,
            },
            {"status": ("status", "value"), "created_month": ("created_date", "month")},
            ("status", "created_date"),
        ),
        EntitySpec(
            "email_template",
            "template_id",
            {
                "template_id": "string",
                "template_name": "string",
                "subject": "string",
                "html_content": "string",
                "created_date": TIME,
            },
            {"created_year": ("created_date", "year")},
            ("created_date",),
        ),
        EntitySpec(
            "email_send",
            "send_id",
            {
                "send_id": "string",
                "campaign_id": "string",
                "email_template_id": "string",
                "send_date": TIME,
                "subject_line": "string",
                "total_sent": "int",
            },
            {"send_month": ("send_date", "month")},
            ("send_date",),
        ),
        EntitySpec(
            "email_engagement",
            "engagement_id",
            {
                "engagement_id": "string",
                "send_id": "string",
                "contact_id": "string",
                "contact_sk": "string",
                "engagement_type": "string",
                "engagement_timestamp": TIME,
                "link_url": "string",
            },
            {"engagement_day": ("engagement_timestamp", "day")},
            ("engagement_timestamp",),
        ),
        EntitySpec(
            "event",
            "event_id",
            {
                "event_id": "string",
                "subject": "string",
                "start_date_time": TIME,
                "end_date_time": TIME,
                "type": "string",
                "related_campaign_id": "string",
                "related_contact_id": "string",
                "related_lead_id": "string",
                "created_date": TIME,
            },
            {"type": ("type", "value")},
            ("type",),
        ),
        EntitySpec(
            "opportunity",
            "opportunity_id",
            {
                "opportunity_id": "string",
                "opportunity_name": "string",
                "account_id": "string",
                "stage_name": "string",
                "amount": MONEY,
                "close_date": TIME,
                "campaign_id": "string",
                "created_date": TIME,
            },
            {"stage_name": ("stage_name", "value")},
            ("stage_name",),
        ),
    )
}

STAMP = "last_modified_timestamp"


def key_of(name: str, schema: T.StructType | None = None) -> str:
    """Declared key; for an undeclared table the first NOT NULL column, else its first column."""
    if name in ENTITIES:
        return ENTITIES[name].key
    if schema is None or not schema.fields:
        raise ValueError(f"cannot determine a key for {name}")
    return next((f.name for f in schema.fields if not f.nullable), schema.fields[0].name)
