"""Casts that turn unreadable values into NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# What is scrubbed from text before a numeric cast.
NOT_INT_CHARS = "[^0-9]"
NOT_FLOAT_CHARS = "[^0-9.]"


def try_cast(c: Column, dtype: str) -> Column:
    return c.try_cast(dtype)


def scrubbed(c: Column, dtype: str) -> Column:
    """Numeric casts drop every character that is not a digit (or a dot, for floats) first."""
    text = c.cast("string")
    if dtype == "int":
        return F.regexp_replace(text, NOT_INT_CHARS, "").try_cast("int")
    if dtype == "float":
        return F.regexp_replace(text, NOT_FLOAT_CHARS, "").try_cast("float")
    return c.try_cast(dtype)


def safe_cast(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """Cast one column with scrubbing; a column that is absent becomes a typed NULL column."""
    if name not in df.columns:
        return df.withColumn(name, F.lit(None).cast(dtype))
    return df.withColumn(name, scrubbed(F.col(name), dtype))


def strip_path_prefix(path: Column, prefix: str) -> Column:
    """Path relative to ``prefix``; other paths are left alone."""
    return F.when(path.startswith(prefix), F.substr(path, F.lit(len(prefix) + 1))).otherwise(path)
