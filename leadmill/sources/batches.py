"""Batch folders of parquet files: ``<root>/<YYYY-MM-DD_HHMMSS>/<entity>.parquet``.

A scan begins with the folder names, which say what is new; only new files are listed and opened. Files are
grouped by the schema in their footers, every group is read by itself, and the groups are brought to common
types before they are united. So a batch that differs in types or columns from others does no harm to them.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from leadmill.functions import epoch_ns_to_ts, is_time_type, parse_batch_id, stamp
from leadmill.functions.times import BATCH_ID_PATTERN
from leadmill.sources.footers import footers

FILE_SCHEMA = "file_path string, file_size bigint, committed_at timestamp_ntz, batch_id string"
# Schemas that are inferred side by side, and names that one path pattern may hold.
INFERRED, PATTERN_NAMES = 16, 200
# What Spark says of broken files.
BROKEN = ("CANNOT_READ_FILE_FOOTER", "is not a Parquet file", "PARQUET_TYPE", "UNABLE_TO_INFER_SCHEMA")


def batch_id_of(path: Column) -> Column:
    """Name of the folder that holds the entity's file or folder."""
    return F.regexp_extract(path, r"/([^/]+)/[^/]+\.parquet(/[^/]*)?$", 1)


def plain_path(path: Column) -> Column:
    """A file's path in the rows it gives, as listings of files write it: without percent signs for other characters."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def entity_glob(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/*/{entity}.parquet"


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what stands directly in a folder, sorted; none where there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not store.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(folder))


def new_batches(spark: SparkSession, root: str, after: str | None = None) -> list[str]:
    """Batch folders after the given one, oldest first; other names are left out."""
    names = [n for n in folder_names(spark, root) if re.match(BATCH_ID_PATTERN, n)]
    return [n for n in names if after is None or n > after]


def list_files(spark: SparkSession, root: str, entity: str, batches: Sequence[str] | None = None) -> DataFrame:
    """Files of one entity (of some batches) with batch, size and time; file contents are not read."""
    if batches is None:
        patterns = [entity_glob(root, entity)]
    else:
        patterns = []
        for i in range(0, len(batches), PATTERN_NAMES):
            names = ",".join(batches[i : i + PATTERN_NAMES])
            patterns.append(f"{root.rstrip('/')}/{{{names}}}/{entity}.parquet")
    found = [p for p in patterns if _matches(spark, p)]
    if not found:
        return spark.createDataFrame([], FILE_SCHEMA)
    return (
        spark.read.format("binaryFile")
        .load(found)
        .select(
            F.col("path").alias("file_path"),
            F.col("length").alias("file_size"),
            F.col("modificationTime").cast("timestamp_ntz").alias("committed_at"),
            batch_id_of(F.col("path")).alias("batch_id"),
        )
    )


def _matches(spark: SparkSession, pattern: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    store = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return len(store.globStatus(path) or []) > 0


def added_files(spark: SparkSession, root: str, entity: str, after: datetime | None = None) -> DataFrame:
    """Files that were committed after a time (all files without one), oldest first."""
    files = list_files(spark, root, entity)
    if after is not None:
        files = files.where(F.col("committed_at") > stamp(after))
    return files.orderBy("committed_at", "file_path")


def change_summary(files: DataFrame) -> DataFrame:
    """Number of new files and the latest of their commit times and batches."""
    return files.agg(
        F.count(F.lit(1)).alias("num_files"),
        F.max("committed_at").alias("last_committed_at"),
        F.max("batch_id").alias("last_batch_id"),
    )


def discover_batches(batch_ids: DataFrame, column: str = "batch_id") -> DataFrame:
    """Distinct batch ids with their times, in order; names that are no batch id are left out."""
    return (
        batch_ids.select(F.col(column).alias("batch_id"))
        .distinct()
        .withColumn("batch_time", parse_batch_id(F.col("batch_id")))
        .where("batch_time IS NOT NULL")
        .orderBy("batch_id")
    )


def newer_batches(df: DataFrame, after: str | None, column: str = "batch_id") -> DataFrame:
    """Rows of batches after the given one; all rows when there is none. Batch ids sort by time."""
    return df.where(F.col(column) > F.lit(after)) if after else df


@dataclass
class FileGroups:
    """Files by the schema in their footers, and the files whose footers cannot be read, with the reason.

    ``rows`` says how many rows a file's footer announces, where footers were read by tasks.
    """

    groups: list[tuple[T.StructType, list[str]]] = field(default_factory=list)
    unreadable: list[tuple[str, str]] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)


def _inferred(spark: SparkSession, path: str) -> tuple[T.StructType | None, str]:
    """The schema as Spark reads it, or why the file has none; a store that fails is an error."""
    try:
        return spark.read.parquet(path).schema, ""
    except Exception as error:  # noqa: BLE001 - only what the file itself is to blame for is kept
        said = [line for line in str(error).splitlines() if any(sign in line for sign in BROKEN)]
        if not said:
            raise
        return None, said[0].strip()[:200]


def by_footer(spark: SparkSession, paths: Iterable[str]) -> FileGroups:
    """Read the footers of the given files and no others: one job for all, and one for each kind of schema.

    Only a file that is no parquet file counts as unreadable. A store that cannot be reached is an error, as the file
    may be sound.
    """
    paths, out, found = sorted(paths), FileGroups(), defaultdict(list)
    if not paths:
        return out
    kinds: dict[str, list[str]] = {}
    for r in footers(spark, paths).collect():
        if r["message"] is not None:
            out.unreadable.append((r["file_path"], r["message"]))
        else:
            kinds.setdefault(r["shape"] or r["file_path"], []).append(r["file_path"])
            if r["rows"] is not None:
                out.rows[r["file_path"]] = r["rows"]
    with ThreadPoolExecutor(INFERRED) as pool:
        for files, (schema, error) in zip(kinds.values(), pool.map(lambda own: _inferred(spark, min(own)), kinds.values())):
            if schema is None:
                out.unreadable += [(path, error) for path in files]
            else:
                found[schema.json()].append((schema, files))
    out.unreadable.sort()
    out.groups = [(same[0][0], sorted(path for _, files in same for path in files)) for same in found.values()]
    out.groups.sort(key=lambda group: group[1][0])
    return out


def _is_time(dtype: T.DataType) -> bool:
    return is_time_type(dtype) or isinstance(dtype, T.LongType)


def unite(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames of one entity as one, by column name in any case.

    A column that has one type everywhere keeps it. Times that come as timestamps here and as epoch nanoseconds
    there become timestamps; any other difference is settled as text. Columns that a frame lacks are NULL there.
    """
    if len(frames) == 1:
        return frames[0]
    types: dict[str, list[T.DataType]] = defaultdict(list)
    names: dict[str, str] = {}
    for frame in frames:
        for f in frame.schema.fields:
            names.setdefault(f.name.lower(), f.name)
            types[f.name.lower()].append(f.dataType)

    def common(f: T.StructField) -> Column:
        seen, name = types[f.name.lower()], names[f.name.lower()]
        if all(t == seen[0] for t in seen):
            value = F.col(f.name)
        elif all(map(_is_time, seen)) and any(map(is_time_type, seen)):
            long = isinstance(f.dataType, T.LongType)
            value = epoch_ns_to_ts(F.col(f.name)) if long else F.col(f.name).cast("timestamp_ntz")
        else:
            value = F.col(f.name).cast("string")
        return value.alias(name)

    out = frames[0].select(*[common(f) for f in frames[0].schema.fields])
    for frame in frames[1:]:
        out = out.unionByName(frame.select(*[common(f) for f in frame.schema.fields]), allowMissingColumns=True)
    return out


def read_groups(spark: SparkSession, files: FileGroups, skip_corrupt: bool = False) -> DataFrame | None:
    """All rows of the readable files with ``batch_id`` and ``file_path``; None without any such file.

    ``skip_corrupt`` also reads past files whose data, not only whose footer, cannot be read.
    """
    path, frames = plain_path(F.col("_metadata.file_path")), []
    for schema, paths in files.groups:
        reader = spark.read.schema(schema)
        if skip_corrupt:
            reader = reader.option("ignoreCorruptFiles", "true")
        frames.append(reader.parquet(*paths).select("*", batch_id_of(path).alias("batch_id"), path.alias("file_path")))
    return unite(frames) if frames else None


def read_entity(
    spark: SparkSession, root: str, entity: str, after: str | None = None, skip_corrupt: bool = False
) -> DataFrame:
    """All rows of an entity's batches after the given one. Older files are neither listed nor opened.

    An unreadable file fails the read, or is left out with ``skip_corrupt``.
    """
    paths = [r[0] for r in list_files(spark, root, entity, new_batches(spark, root, after)).select("file_path").collect()]
    files = by_footer(spark, paths)
    if files.unreadable and not skip_corrupt:
        raise ValueError(f"unreadable files of {entity}: {files.unreadable[:3]}")
    rows = read_groups(spark, files, skip_corrupt)
    if rows is None:
        raise FileNotFoundError(f"PATH_NOT_FOUND: no readable file of {entity} in {root}" + (f" after {after}" if after else ""))
    return rows


def unread_files(spark: SparkSession, files: FileGroups, rows: DataFrame, entity: str, loaded_at: datetime) -> DataFrame:
    """A reject line for each file that was not read, or not to its end.

    ``rows`` are what was read. A file counts as read if it gave as many rows as its footer announces, so an empty
    file is not taken for a broken one.
    """
    whole = spark.createDataFrame(list(files.rows.items()), "file_path string, count bigint")
    for schema, paths in files.groups:
        unknown = [p for p in paths if p not in files.rows]
        if unknown:
            # Without columns only footers are read.
            path = plain_path(F.col("_metadata.file_path")).alias("file_path")
            whole = whole.unionByName(spark.read.schema(schema).parquet(*unknown).groupBy(path).count())
    lines = spark.createDataFrame([(p, m) for p, m in files.unreadable], "file_path string, message string")
    got = rows.groupBy(F.col("file_path").alias("__path")).agg(F.count(F.lit(1)).alias("__got"))
    short = whole.join(got, whole["file_path"] == got["__path"], "left").where("coalesce(__got, 0) < count")
    lines = lines.unionByName(short.select("file_path", F.lit("no readable rows").alias("message")))
    return lines.select(
        F.lit(entity).alias("entity"), "file_path", batch_id_of(F.col("file_path")).alias("batch_id"),
        F.when(F.col("message") == "no readable rows", F.col("message")).otherwise(F.lit("unreadable file")).alias("message"),
        F.lit(1).cast("bigint").alias("count"), stamp(loaded_at).alias("load_timestamp"),
    )


def read_cleaned(spark: SparkSession, out_dir: str, entity: str, after: str | None = None) -> DataFrame:
    """Cleaned batches of one entity with all columns that any of them has; older batches are not opened."""
    base = f"{out_dir.rstrip('/')}/{entity}"
    names = [n for n in folder_names(spark, base) if n.startswith("batch_id=")]
    paths = [f"{base}/{n}" for n in names if after is None or n.removeprefix("batch_id=") > after]
    if not paths:
        raise FileNotFoundError(f"PATH_NOT_FOUND: no cleaned batches of {entity} in {out_dir}" + (f" after {after}" if after else ""))
    frames = []
    for schema, files in by_footer(spark, paths).groups:
        # A batch's folder has one schema: it was written by one job.
        frames.append(spark.read.schema(schema).option("basePath", base).parquet(*files).select("*", F.col("_metadata.file_path").alias("__path")))
    rows = unite(frames)
    batch = F.regexp_extract("__path", r"/batch_id=([^/]+)/", 1)
    return rows.drop("batch_id").withColumn("batch_id", batch).drop("__path")
