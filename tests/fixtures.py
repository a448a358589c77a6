"""Small random raw tables: NULL ids, dangling ids, hot keys, reversed and open ranges."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

from leadmill.registry import ENTITIES, STAMP

ROWS = {
    "account": 12, "campaign": 10, "contact": 12, "lead": 15, "campaign_member": 40, "email_template": 4,
    "email_send": 25, "email_engagement": 80, "event": 40, "opportunity": 40,
}
REFERENCES = {
    "campaign_id": "campaign", "contact_id": "contact", "lead_id": "lead", "converted_contact_id": "contact",
    "email_template_id": "email_template", "send_id": "email_send", "related_campaign_id": "campaign",
    "related_contact_id": "contact", "related_lead_id": "lead", "account_id": "account",
}


def random_row(rnd: random.Random, entity: str, i: int, stamped: datetime) -> tuple:
    spec = ENTITIES[entity]

    def value(name: str, dtype: str):
        if name == spec.key:
            return str(i)
        if name in REFERENCES:
            # A third of all rows point at id 0, some at nothing, some at ids that do not exist; one of
            # those is popular too.
            n = ROWS[REFERENCES[name]]
            return rnd.choice([None, "0", "0", str(rnd.randrange(n)), str(rnd.randrange(n + 3)), str(n + 9)])
        if name == "campaign_name":
            return str(i)
        if name == "engagement_type":
            return rnd.choice(["Open", "Click", "Other", None])
        if name == "stage_name":
            return rnd.choice(["Closed Won", "Proposal", None])
        if dtype == "timestamp_ntz":
            if rnd.random() < 0.2 and name != "created_date":
                return None
            return datetime(2024, 1, 1) + timedelta(hours=rnd.choice([0, 24, 24, rnd.randrange(40 * 24)]))
        if dtype.startswith("decimal"):
            return rnd.choice([None, Decimal(rnd.randrange(10000)) / 100])
        if dtype == "int":
            return rnd.randrange(100)
        return rnd.choice([None, f"{name}{rnd.randrange(5)}"])

    return (*[value(c, t) for c, t in spec.fields.items()], stamped)


def ddl(entity: str) -> str:
    return ", ".join(f"{c} {t}" for c, t in ENTITIES[entity].fields.items()) + f", {STAMP} timestamp_ntz"


def random_tables(seed: int, stamped: datetime) -> dict[str, list[tuple]]:
    rnd = random.Random(seed)
    return {e: [random_row(rnd, e, i, stamped) for i in range(n)] for e, n in ROWS.items()}


def random_changes(seed: int, stamped: datetime, share: float = 0.15) -> dict[str, list[tuple]]:
    """New versions of some rows, and some new rows."""
    rnd = random.Random(seed)
    out = {}
    for entity, n in ROWS.items():
        ids = [i for i in range(n) if rnd.random() < share] + [n + j for j in range(rnd.randrange(3))]
        out[entity] = [random_row(rnd, entity, i, stamped) for i in ids]
    return out


def frames(spark, tables: dict[str, list[tuple]]):
    return {e: spark.createDataFrame(data, ddl(e)) for e, data in tables.items()}
