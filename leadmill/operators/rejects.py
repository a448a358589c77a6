"""Values that could not be read, counted per file and batch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadmill.functions import stamp
from leadmill.operators.conform import lower_names
from leadmill.registry import EntitySpec


def reject_messages(spec: EntitySpec, df: DataFrame) -> Column:
    """One message for each declared column whose value is present but cannot be cast."""
    found = [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(f"cannot read {c} as {t}"))
        for c, t in spec.fields.items()
        if c in df.columns and t != "string"
    ]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def load_rejects(
    spec: EntitySpec, raw: DataFrame, loaded_at: datetime, file_col: str = "file_path", batch_col: str = "batch_id"
) -> DataFrame:
    """Reject table: file, message, number of rows, load time, batch."""
    df = lower_names(raw)
    return (
        df.select(F.col(file_col).alias("file_path"), F.col(batch_col).alias("batch_id"),
                  F.explode(reject_messages(spec, df)).alias("message"))
        .groupBy("file_path", "message", "batch_id")
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("load_timestamp", stamp(loaded_at))
    )


def first_rejects(rejects: DataFrame, table_col: str, n: int = 3) -> DataFrame:
    """The first ``n`` reject lines of each table, for a report."""
    order = [F.col(c) for c in ("file_path", "message", "batch_id")]
    rank = F.row_number().over(Window.partitionBy(table_col).orderBy(*order))
    return rejects.withColumn("rank", rank).where(F.col("rank") <= n)


def write_reject_log(rejects: DataFrame, path: str) -> None:
    rejects.write.mode("append").json(path)
