"""Upsert by key, as a DataFrame over old and new rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from leadmill.functions import stamp
from leadmill.operators.conform import dedupe_by_key
from leadmill.registry import STAMP


class DuplicateKeyError(ValueError):
    pass


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def single_source_rows(
    source: DataFrame, key: str, on_duplicate_key: str = "error", newest_first: Sequence[Column] = ()
) -> DataFrame:
    """Source rows with one row per key: fail on duplicates, or keep the newest."""
    if on_duplicate_key == "latest":
        return dedupe_by_key(source, key, newest_first or [F.col(STAMP).desc()])
    if on_duplicate_key != "error":
        raise ValueError(f"on_duplicate_key must be 'error' or 'latest', not {on_duplicate_key!r}")
    # Where no hash repeats, no key does. Keys themselves, which are long, are dealt only where one might.
    hashes = source.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("hash"))
    if not duplicate_keys(hashes, "hash").take(1):
        return source
    examples = [r[0] for r in duplicate_keys(source, key).take(3)]
    if examples:
        raise DuplicateKeyError(f"several source rows for {key} in {examples}")
    return source


def align(df: DataFrame, like: DataFrame) -> DataFrame:
    """Project to the columns and types of ``like``; columns that are absent become NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in like.schema.fields
        ]
    )


def sync_columns(target: DataFrame, source: DataFrame, mode: str = "ignore") -> tuple[DataFrame, DataFrame]:
    """Both sides with one set of columns.

    ``ignore`` keeps the target's columns. ``sync_all_columns`` takes over the source's: columns that
    are new come in as NULL for old rows, columns that are gone are dropped.
    """
    if mode == "ignore":
        return target, align(source, target)
    if mode == "sync_all_columns":
        return align(target, source), source
    raise ValueError(f"on_schema_change must be 'ignore' or 'sync_all_columns', not {mode!r}")


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    key: str,
    loaded_at: datetime | None = None,
    touch_on_update: bool = True,
    on_schema_change: str = "ignore",
    stamp_col: str = STAMP,
    newer_by: str | None = None,
) -> DataFrame:
    """The target after an upsert of ``source``, which has one row per key.

    ``newer_by`` names a column by which a source row must not be older than the row it updates; older ones are
    left out. With ``loaded_at`` the load writes the stamp column itself: new rows get it, and so do updated
    rows unless ``touch_on_update`` is off, in which case they keep the stamp they had.
    """
    if loaded_at is not None:
        source = source.withColumn(stamp_col, stamp(loaded_at))
    target, source = sync_columns(target, source, on_schema_change)
    if newer_by is not None and newer_by in target.columns:
        known = target.select(F.col(key).alias("__key"), F.col(newer_by).alias("__since"))
        late = (source[key] == known["__key"]) & (source[newer_by] < known["__since"])
        source = source.join(known, late, "left_anti")
    if loaded_at is not None and not touch_on_update:
        old = target.select(F.col(key).alias("__key"), F.col(stamp_col).alias("__stamp"))
        source = (
            source.join(old, source[key] == old["__key"], "left")
            .withColumn(stamp_col, F.coalesce("__stamp", stamp_col))
            .drop("__key", "__stamp")
        )
    kept = target.join(source.select(F.col(key).alias("__key")), F.col(key) == F.col("__key"), "left_anti")
    return kept.unionByName(source)


def keep_stamps(new: DataFrame, old: DataFrame, key: str, stamp_col: str = STAMP, *also: str) -> DataFrame:
    """Rows of ``new`` that did not change keep the stamp (and what else is named) that they have in ``old``."""
    marks = [stamp_col, *also]
    values = [c for c in new.columns if c not in marks]
    if set(new.columns) != set(old.columns):
        return new
    before = old.select(*[F.col(c).alias(f"__old_{c}") for c in new.columns])
    same = F.col(key) == F.col(f"__old_{key}")
    for c in values:
        if c != key:
            same = same & F.col(c).eqNullSafe(F.col(f"__old_{c}"))
    joined = new.join(before, same, "left")
    return joined.select(*values, *[F.coalesce(f"__old_{c}", c).alias(c) for c in marks])
