"""Aggregations that stay balanced under hot groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def conditional_distinct(
    df: DataFrame, group: Sequence[str], value: str, counts: Mapping[str, Column | None]
) -> DataFrame:
    """Distinct values per group, each count over the rows that meet a condition (None: all rows).

    The first step groups by group and value, so a hot group is spread over its values, and all counts
    share it; the second step adds up flags. Several distinct counts cost no copies of the input.
    """
    flags = {
        name: F.max(F.coalesce(cond, F.lit(False)) if cond is not None else F.lit(True))
        for name, cond in counts.items()
    }
    per_value = df.groupBy(*group, value).agg(*[c.alias(f"__{n}") for n, c in flags.items()])
    return per_value.groupBy(*group).agg(
        *[F.count_if(F.col(f"__{n}") & F.col(value).isNotNull()).alias(n) for n in counts]
    )
