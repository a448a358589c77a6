"""Cleaning raw batches and conforming them to the declared entities."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from leadmill.functions import epoch_ns_to_ts, is_time_type
from leadmill.functions.casts import scrubbed
from leadmill.registry import TIME, EntitySpec

# A time must lie after the first second of the epoch to count as set.
FIRST_SET_TIME = "1970-01-01 00:00:01"
FIRST_SET_NS = 1_000_000_000


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def drop_unset_times(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows whose time columns all lie after the epoch's first second.

    NULL times count as unset. ``columns`` may name epoch-nanosecond columns too; by default all
    timestamp columns are checked. The comparison is on the bare column, so parquet can skip by it.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    if columns is None:
        columns = [c for c, t in types.items() if is_time_type(t)]

    def is_set(name: str) -> Column:
        if isinstance(types[name], T.LongType):
            return F.col(name) >= F.lit(FIRST_SET_NS)
        if isinstance(types[name], T.TimestampNTZType):
            return F.col(name) >= F.lit(FIRST_SET_TIME).cast(TIME)
        return F.unix_seconds(F.col(name).cast("timestamp")) > 0

    return reduce(lambda d, name: d.where(is_set(name)), columns, df)


def clean(spec: EntitySpec, raw: DataFrame) -> DataFrame:
    """Lower-case names, drop rows with unset times, turn epoch nanoseconds into timestamps."""
    df = lower_names(raw)
    times = [c for c in spec.time_fields if c in df.columns]
    df = drop_unset_times(df, [c for c in times if not isinstance(df.schema[c].dataType, T.StringType)])
    ns = {c: epoch_ns_to_ts(F.col(c)) for c in times if isinstance(df.schema[c].dataType, T.LongType)}
    return df.withColumns(ns) if ns else df


def conform(spec: EntitySpec, df: DataFrame, scrub: bool = False, keep_extra: bool = True) -> DataFrame:
    """Declared columns in their declared types; absent ones as typed NULLs, extra ones kept.

    Unreadable values become NULL. ``scrub`` strips foreign characters from text before numeric casts.
    """
    df = lower_names(df)

    def field(name: str, dtype: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast(dtype).alias(name)
        if scrub and dtype in ("int", "float"):
            return scrubbed(F.col(name), dtype).alias(name)
        return F.col(name).try_cast(dtype).alias(name)

    extra = [c for c in df.columns if c not in spec.fields] if keep_extra else []
    return df.select(*[field(c, t) for c, t in spec.fields.items()], *extra)


def with_partitions(spec: EntitySpec, df: DataFrame) -> DataFrame:
    """Add the derived partition columns: dates at the start of their year, month or day."""
    starts = {
        "year": lambda d: F.trunc(d, "year"),
        "month": lambda d: F.trunc(d, "month"),
        "day": lambda d: d,
    }
    derived = {
        name: starts[unit](F.to_date(source))
        for name, (source, unit) in spec.partitions.items()
        if unit != "value"
    }
    return df.withColumns(derived) if derived else df


@dataclass(frozen=True)
class SchemaReport:
    table: str
    missing: list[str]
    extra: list[str]
    batches: tuple[str, ...] = ()

    @property
    def ok(self) -> bool:
        return not self.missing

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(self.table, self.missing, self.extra, self.ok)],
            "table string, missing array<string>, extra array<string>, ok boolean",
        )


def schema_report(table: str, expected: Sequence[str], df: DataFrame) -> SchemaReport:
    """Declared columns that are missing and columns that are not declared."""
    return SchemaReport(
        table,
        [c for c in expected if c not in df.columns],
        [c for c in df.columns if c not in expected],
    )


def dedupe_by_key(df: DataFrame, key: str | Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The newest row of each key.

    Spark keeps one row per key and map task before it shuffles, so a key with very many versions
    does not end up in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")
