"""Watermarks: what was processed already, and what a change touches."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadmill.functions import stamp
from leadmill.operators.upsert import merge_rows
from leadmill.plans.models import ModelSpec
from leadmill.registry import STAMP

# Fixed value: the watermark of an empty table.
NEVER = "1900-01-01 00:00:00"

STATE_SCHEMA = "table string, watermark bigint, updated_at timestamp_ntz"


def high_water(target: DataFrame, column: str = STAMP) -> Column:
    """Largest value of a column as a scalar subquery; a fixed early time for an empty table."""
    latest = F.coalesce(F.max(F.col(column).cast("timestamp_ntz")), F.lit(NEVER).cast("timestamp_ntz"))
    return target.agg(latest.alias("high_water")).scalar()


def newer_than(df: DataFrame, target: DataFrame, column: str = STAMP) -> DataFrame:
    """Rows of ``df`` beyond what ``target`` has seen. The bound reaches the scan as a pushed filter."""
    return df.where(F.col(column) > high_water(target, column))


def both_sides(spec: ModelSpec, inputs: Mapping[str, DataFrame], target: DataFrame) -> dict[str, DataFrame]:
    """Every input cut to its rows beyond the target's watermark.

    Joins then see new rows only: an unchanged dimension row is missing from them, as it is for the
    models that define their increments in this way. A business-time watermark cuts the driving input
    only.
    """
    out = dict(inputs)
    if spec.watermark != STAMP:
        out[spec.driver] = newer_than(inputs[spec.driver], target, spec.watermark)
        return out
    for name, df in inputs.items():
        if name not in spec.undated:
            out[name] = newer_than(df, target)
    return out


def _matching(df: DataFrame, other: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    keys = other.select(*[F.col(b).alias(f"__{b}") for b in pairs.values()]).distinct()
    return df.join(keys, reduce(lambda x, y: x & y, [F.col(a) == F.col(f"__{b}") for a, b in pairs.items()]), "left_semi")


def affected_keys(
    spec: ModelSpec,
    inputs: Mapping[str, DataFrame],
    changed: Mapping[str, DataFrame],
) -> DataFrame:
    """Keys of the driving input whose model rows a change in any input may alter.

    ``changed`` holds new versions of rows and, where a table keeps them, the versions they replaced; ``inputs`` need not
    hold the rows that are in ``changed``. A row that moves from one key to another touches both. All inputs that point at the same columns of another one
    are looked up in it at once, as one list of distinct keys.
    """

    def touched(name: str) -> list[DataFrame]:
        found, wanted = [changed[name]] if name in changed else [], defaultdict(list)
        for child, link in spec.links.items():
            if (link.via or spec.driver) != name:
                continue
            for rows in touched(child):
                for arm in link.arms:
                    cols = tuple(sorted(arm))
                    wanted[cols].append(rows.select(*[F.col(arm[c]).alias(c) for c in cols]))
        for cols, lists in wanted.items():
            found.append(_matching(inputs[name], reduce(DataFrame.unionByName, lists), {c: c for c in cols}))
        return found

    keys = [rows.select(spec.driver_key) for rows in touched(spec.driver)]
    return reduce(DataFrame.unionByName, keys).distinct()


def restrict_inputs(
    spec: ModelSpec, inputs: Mapping[str, DataFrame], keys: DataFrame, few: bool = True
) -> dict[str, DataFrame]:
    """Inputs cut to what the driving rows with the given keys can reach, for a recomputation.

    Where an input is linked by the driving key itself, the keys say what is reached, without a join to find them.
    Without ``few``, only the driving input is cut: many keys reach nearly all rows of the others, and rows that no
    driving row reaches add nothing to a model, so finding them would only move every input once more.
    """
    out = dict(inputs)
    out[spec.driver] = _matching(inputs[spec.driver], keys, {spec.driver_key: spec.driver_key})
    if not few:
        return out

    def cut(name: str) -> None:
        link = spec.links[name]
        parent = out[link.via or spec.driver]
        if link.via in (None, spec.driver) and {a for arm in link.arms for a in arm} == {spec.driver_key}:
            parent = keys
        shared = dict(set.intersection(*[set(arm.items()) for arm in link.arms]))
        targets = {tuple(arm.values()) for arm in link.arms}
        if shared:
            out[name] = _matching(inputs[name], parent, {b: a for a, b in shared.items()})
        elif len(targets) == 1:
            cols = targets.pop()
            wanted = reduce(
                DataFrame.unionByName,
                [parent.select(*[F.col(a).alias(b) for a, b in arm.items()]) for arm in link.arms],
            )
            out[name] = _matching(inputs[name], wanted, {b: b for b in cols})

    for name, link in spec.links.items():
        if link.via is None:
            cut(name)
    for name, link in spec.links.items():
        if link.via is not None:
            cut(name)
    return out


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def advance(state: DataFrame, progress: DataFrame, at: datetime) -> DataFrame:
    """State table after a run: one row per table, moved forward where ``progress`` has a value.

    ``progress`` holds ``table`` and ``watermark`` of the tables whose writes succeeded.
    """
    rows = progress.where("watermark IS NOT NULL").select(
        "table", F.col("watermark").cast("bigint").alias("watermark"), stamp(at).alias("updated_at")
    )
    return merge_rows(state, rows, "table")
