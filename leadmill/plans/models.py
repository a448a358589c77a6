"""The model catalogue: what each model reads, its key, and how changes in its inputs reach its rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from leadmill.plans import dimensions as dims
from leadmill.plans import facts
from leadmill.plans.staging import stage, stage_email_engagement
from leadmill.registry import ENTITIES, STAMP

RAW, STAGING, MARKETING = "raw", "staging", "marketing"


@dataclass(frozen=True)
class Link:
    """How rows of an input point at rows of the model's driving input.

    ``arms`` are alternatives, each a mapping of driving column to input column. With ``via`` they
    point at another input instead, which in turn has its own link to the driving input.
    """

    arms: tuple[Mapping[str, str], ...]
    via: str | None = None


def schema_name(custom: str | None, target: str) -> str:
    """A model's database: its own, taken as it is, or the target's."""
    return custom.strip() if custom else target


@dataclass(frozen=True)
class ModelSpec:
    name: str
    database: str | None
    build: Callable[..., DataFrame]
    inputs: Mapping[str, str]  # argument of ``build`` -> table it comes from
    key: str | None = None
    driver: str | None = None  # the input whose rows are the model's grain
    driver_key: str | None = None  # column of the driving input that the model's rows carry as well
    links: Mapping[str, Link] = field(default_factory=dict)
    undated: frozenset[str] = frozenset()  # inputs that are read whole in every run
    watermark: str = STAMP  # column of the driving input and of the model that marks progress
    materialized: str = "incremental"  # or "table"
    full_refresh: bool = False  # incremental table whose rows are all recomputed and upserted
    on_schema_change: str = "ignore"  # or "sync_all_columns"
    alias: str | None = None
    # Driving rows whose result also depends on the date, given the day of the last run.
    ages: Callable[[Column], Column] | None = None

    @property
    def table(self) -> str:
        return f"{schema_name(self.database, STAGING)}.{self.alias or self.name}"


def link(*arms: Mapping[str, str], via: str | None = None) -> Link:
    return Link(arms, via)


def _staging() -> list[ModelSpec]:
    specs = []
    for entity, spec in ENTITIES.items():
        if entity == "email_engagement":
            specs.append(
                ModelSpec(
                    entity, STAGING, stage_email_engagement,
                    {"raw": f"raw.{entity}", "contact": "staging.contact"},
                    spec.key, "raw", spec.key, {"contact": link({"contact_id": "contact_id"})},
                    undated=frozenset({"contact"}),
                )
            )
        else:
            specs.append(
                ModelSpec(entity, STAGING, partial(stage, entity), {"raw": f"raw.{entity}"}, spec.key, "raw", spec.key)
            )
    return specs


def _from(database: str, *names: str) -> dict[str, str]:
    return {n: f"{database}.{n}" for n in names}


def _still_running(last: Column) -> Column:
    """Campaigns that get new days as time goes by."""
    return F.col("end_date").isNull() | (F.to_date("end_date") >= last)


_BY_CAMPAIGN = {"campaign_id": "campaign_id"}
_BY_CONTACT = {"contact_id": "contact_id"}

_DIMENSIONS = [
    ModelSpec(
        "dim_campaign", MARKETING, dims.dim_campaign, _from(STAGING, "campaign"),
        "campaign_sk", "campaign", "campaign_id",
    ),
    ModelSpec(
        "dim_campaign_member_engagement", MARKETING, dims.dim_campaign_member_engagement,
        _from(STAGING, "campaign_member", "campaign", "email_engagement", "event"),
        "member_sk", "campaign_member", "member_id",
        {
            "campaign": link(_BY_CAMPAIGN),
            "email_engagement": link(_BY_CONTACT, {"lead_id": "contact_id"}),
            "event": link(
                {"campaign_id": "related_campaign_id", "contact_id": "related_contact_id"},
                {"campaign_id": "related_campaign_id", "lead_id": "related_lead_id"},
            ),
        },
    ),
    ModelSpec(
        "dim_campaign_performance", MARKETING, dims.dim_campaign_performance,
        _from(STAGING, "campaign", "email_send", "email_engagement"),
        "campaign_sk", "campaign", "campaign_id", full_refresh=True,
    ),
    ModelSpec(
        "dim_contact_engagement", MARKETING, dims.dim_contact_engagement,
        _from(STAGING, "contact", "email_engagement"),
        "contact_sk", "contact", "contact_id", {"email_engagement": link(_BY_CONTACT)},
    ),
    ModelSpec("dim_date", MARKETING, dims.dim_date, _from(STAGING, "account"), materialized="table"),
    ModelSpec(
        "dim_email_engagement", MARKETING, dims.dim_email_engagement,
        _from(STAGING, "email_engagement", "email_send", "email_template", "campaign", "contact"),
        "engagement_sk", "email_engagement", "engagement_id",
        {
            "email_send": link({"send_id": "send_id"}),
            "email_template": link({"email_template_id": "template_id"}, via="email_send"),
            "campaign": link(_BY_CAMPAIGN, via="email_send"),
            "contact": link(_BY_CONTACT),
        },
        watermark="engagement_timestamp",
    ),
    ModelSpec(
        "dim_event_outcome", MARKETING, dims.dim_event_outcome, _from(STAGING, "event", "opportunity"),
        "event_outcome_sk", "event", "event_id",
        {"opportunity": link({"related_contact_id": "account_id"}, {"related_lead_id": "account_id"})},
    ),
    ModelSpec(
        "dim_lead", MARKETING, dims.dim_lead, _from(STAGING, "lead", "contact"),
        "lead_sk", "lead", "lead_id", {"contact": link({"converted_contact_id": "contact_id"})},
    ),
    ModelSpec(
        "dim_lead_conversion", MARKETING, dims.dim_lead_conversion, _from(STAGING, "lead", "contact"),
        "lead_sk", materialized="table",
    ),
    ModelSpec(
        "dim_opportunity", MARKETING, dims.dim_opportunity, _from(STAGING, "opportunity", "account", "campaign"),
        "opportunity_sk", "opportunity", "opportunity_id",
        {"account": link({"account_id": "account_id"}), "campaign": link(_BY_CAMPAIGN)},
        watermark="close_date",
        ages=lambda last: F.col("close_date").isNotNull(),
    ),
    ModelSpec(
        "dim_opportunity_performance", MARKETING, dims.dim_opportunity_performance,
        _from(STAGING, "opportunity", "account", "campaign"),
        "opportunity_sk", "opportunity", "opportunity_id",
        {"account": link({"account_id": "account_id"}), "campaign": link(_BY_CAMPAIGN)},
        ages=lambda last: F.col("close_date").isNull(),
    ),
]

_FACTS = [
    ModelSpec(
        "fact_marketing_performance", MARKETING, facts.fact_marketing_performance,
        _from(
            STAGING, "email_engagement", "email_send", "campaign", "contact", "lead", "opportunity", "event",
            "campaign_member",
        ),
        "fact_sk", "email_engagement", "engagement_id",
        {
            "email_send": link({"send_id": "send_id"}),
            "campaign": link(_BY_CAMPAIGN, via="email_send"),
            "contact": link(_BY_CONTACT),
            "lead": link({"contact_id": "converted_contact_id"}),
            "opportunity": link(_BY_CAMPAIGN, via="email_send"),
            "event": link({"campaign_id": "related_campaign_id"}, via="email_send"),
            "campaign_member": link(_BY_CAMPAIGN, via="email_send"),
        },
        on_schema_change="sync_all_columns",
        alias="FACT_MARKETING_PERFORMANCE",
    ),
    ModelSpec(
        "fct_campaign_performance", MARKETING, facts.fct_campaign_performance,
        _from(
            MARKETING, "dim_campaign", "dim_date", "dim_campaign_member_engagement", "dim_email_engagement",
            "dim_opportunity_performance",
        ),
        "campaign_date_sk", "dim_campaign", "campaign_id",
        {
            "dim_campaign_member_engagement": link(_BY_CAMPAIGN),
            "dim_email_engagement": link(_BY_CONTACT, via="dim_campaign_member_engagement"),
            "dim_opportunity_performance": link(_BY_CAMPAIGN),
        },
        undated=frozenset({"dim_date"}),
        ages=_still_running,
    ),
    ModelSpec(
        "fct_daily_performance", MARKETING, facts.fct_daily_performance,
        _from(
            MARKETING, "dim_campaign", "dim_campaign_performance", "dim_campaign_member_engagement",
            "dim_contact_engagement", "dim_lead_conversion", "dim_opportunity_performance", "dim_date",
        ),
        "daily_performance_sk", "dim_campaign", "campaign_sk",
        {
            "dim_campaign_performance": link(_BY_CAMPAIGN),
            "dim_campaign_member_engagement": link(_BY_CAMPAIGN),
            "dim_contact_engagement": link(_BY_CONTACT, via="dim_campaign_member_engagement"),
            "dim_lead_conversion": link({"contact_id": "converted_contact_id"}, via="dim_campaign_member_engagement"),
            "dim_opportunity_performance": link(_BY_CAMPAIGN),
        },
        undated=frozenset({"dim_date"}),
        ages=_still_running,
    ),
    ModelSpec(
        "fct_event_performance", MARKETING, facts.fct_event_performance,
        _from(MARKETING, "dim_event_outcome", "dim_email_engagement"),
        "event_outcome_sk", "dim_event_outcome", "event_id",
        {"dim_email_engagement": link({"event_id": "campaign_name"})},
        ages=lambda last: F.col("days_to_opportunity").isNotNull(),
    ),
    ModelSpec(
        "fct_lead_to_opportunity_conversion", MARKETING, facts.fct_lead_to_opportunity_conversion,
        _from(MARKETING, "dim_lead", "dim_lead_conversion", "dim_opportunity"),
        "lead_sk", "dim_lead", "lead_id",
        {
            "dim_lead_conversion": link({"lead_id": "lead_id"}),
            "dim_opportunity": link({"converted_contact_id": "account_id"}),
        },
    ),
]

STAGING_MODELS = {m.name: m for m in _staging()}
DIMENSION_MODELS = {m.name: m for m in _DIMENSIONS}
FACT_MODELS = {m.name: m for m in _FACTS}
# Staging tables and marts live in different databases, so their names never clash.
LAYERS = {"staging": STAGING_MODELS, "dimensions": DIMENSION_MODELS, "facts": FACT_MODELS}
MODELS_BY_REF = {f"{m.database}.{m.name}": m for layer in LAYERS.values() for m in layer.values()}


def derive(ref: str, raw: Mapping[str, DataFrame], as_of: datetime, memo: dict[str, DataFrame] | None = None) -> DataFrame:
    """The table ``ref`` computed from raw tables alone, through all models it depends on."""
    memo = {} if memo is None else memo
    if ref not in memo:
        database, name = ref.split(".")
        if database == RAW:
            memo[ref] = raw[name]
        else:
            spec = MODELS_BY_REF[ref]
            inputs = {arg: derive(source, raw, as_of, memo) for arg, source in spec.inputs.items()}
            memo[ref] = spec.build(**inputs, as_of=as_of)
    return memo[ref]


def build_order(layer: str) -> list[ModelSpec]:
    """Models of a layer, each after the ones it reads from."""
    models, done = LAYERS[layer], []

    def visit(spec: ModelSpec) -> None:
        if spec in done:
            return
        for source in spec.inputs.values():
            upstream = MODELS_BY_REF.get(source)
            if upstream is not None and upstream.name in models and models[upstream.name] is upstream:
                visit(upstream)
        done.append(spec)

    for spec in models.values():
        visit(spec)
    return done
