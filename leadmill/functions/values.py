"""Small scalar rules shared by models."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def zero_safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio; NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))


def flag(c: Column, value: str) -> Column:
    """Equality as a three-valued boolean."""
    return c == F.lit(value)


# What an event can have led to.
HAS_OPPORTUNITY, HAS_LEAD, HAS_CONTACT, NO_LINK = "Has Opportunity", "Has Lead", "Has Contact", "No Link"


def outcome_label(opportunity: Column, lead: Column, contact: Column) -> Column:
    """What an event led to, by the strongest link present."""
    return (
        F.when(opportunity.isNotNull(), HAS_OPPORTUNITY)
        .when(lead.isNotNull(), HAS_LEAD)
        .when(contact.isNotNull(), HAS_CONTACT)
        .otherwise(NO_LINK)
    )
