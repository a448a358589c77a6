"""From landed batch folders to raw tables."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadmill.functions import parse_batch_id, stamp
from leadmill.operators.conform import SchemaReport, clean, conform, dedupe_by_key
from leadmill.operators.quality import run_summary
from leadmill.operators.rejects import first_rejects, load_rejects, write_reject_log
from leadmill.operators.tables import Warehouse, publish
from leadmill.operators.watermarks import advance, empty_state
from leadmill.registry import ENTITIES, EntitySpec
from leadmill.sources.batches import (
    FileGroups,
    by_footer,
    list_files,
    new_batches,
    read_groups,
    unread_files,
)

STATE_TABLE = "raw.load_state"
REJECT_TABLE = "raw.load_errors"
RESULT_SCHEMA = (
    "table string, status string, new_files bigint, load_status string, loaded_files bigint, "
    "watermark bigint, error string"
)

# Entities that load or clean side by side.
AT_ONCE = 10

log = logging.getLogger(__name__)


def batch_millis(batch_id: Column) -> Column:
    """Batch time in milliseconds."""
    t = parse_batch_id(batch_id)
    days = F.unix_date(F.to_date(t)).cast("bigint")
    return (days * 86_400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)) * 1000


def write_clean_batches(spec: EntitySpec, raw: DataFrame, out_dir: str) -> None:
    """Cleaned rows into one folder per batch; a batch without rows writes nothing."""
    (
        clean(spec, raw)
        .hint("rebalance", "batch_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(f"{out_dir.rstrip('/')}/{spec.name}")
    )


def group_reports(spec: EntitySpec, files: FileGroups) -> list[SchemaReport]:
    """What each group of files lacks of the declared columns, and has beyond them, with the group's batches."""
    reports = []
    for schema, paths in files.groups:
        names = [f.name.lower() for f in schema.fields]
        batches = sorted({path.split("/")[path.split("/").index(f"{spec.name}.parquet") - 1] for path in paths})
        missing = [c for c in spec.fields if c not in names]
        reports.append(SchemaReport(spec.name, missing, [c for c in names if c not in spec.fields], tuple(batches)))
    return sorted(reports, key=lambda r: r.batches)


@dataclass
class CleanRun:
    """A clean run: schema reports by batches, the watermark after it, entities without new files, and failures."""

    reports: list[SchemaReport] = field(default_factory=list)
    newest: str | None = None
    skipped: list[str] = field(default_factory=list)
    errors: dict[str, str] = field(default_factory=dict)


def clean_all(
    spark: SparkSession,
    root: str,
    out_dir: str,
    after: str | None = None,
    entities: Sequence[str] = tuple(ENTITIES),
) -> CleanRun:
    """Clean the new batches of every entity, the entities side by side.

    All batches of an entity are read by footer schema, so each is judged by its own columns. An entity that fails
    does not stop the others; the watermark then stays, and the run can be repeated as a whole.
    """
    batches = new_batches(spark, root, after)

    def one(name: str) -> tuple[list[SchemaReport], str | None]:
        spec = ENTITIES[name]
        files = by_footer(spark, [r[0] for r in list_files(spark, root, name, batches).select("file_path").collect()])
        if files.unreadable:
            raise ValueError(f"unreadable files: {files.unreadable[:3]}")
        reports, rows = group_reports(spec, files), read_groups(spark, files)
        if rows is not None:
            write_clean_batches(spec, rows, out_dir)
        return reports, max((b for r in reports for b in r.batches), default=None)

    out, newest = CleanRun(newest=after), []
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for name, job in [(name, pool.submit(one, name)) for name in entities]:
            try:
                reports, last = job.result()
            except Exception as error:  # noqa: BLE001 - reported per entity, the others go on
                log.exception("cleaning %s failed", name)
                out.errors[name] = str(error)
                continue
            out.reports += reports
            if last is None:
                out.skipped.append(name)
            else:
                newest.append(last)
    if newest and not out.errors:
        out.newest = max(newest)
    return out


def newest_rows(spec: EntitySpec, df: DataFrame) -> DataFrame:
    """A key that several batches bring along counts in its latest version."""
    return dedupe_by_key(df, spec.key, [F.col("batch_id").desc(), F.col("file_path").desc()])


def record_rejects(warehouse: Warehouse, rejects: DataFrame, files: DataFrame, table: str = REJECT_TABLE) -> None:
    """Put the rejects of ``files`` (file_path) in place of those that these files left before."""
    rejects = rejects.select("file_path", "message", "count", "load_timestamp", "entity", "batch_id")
    if warehouse.exists(table):
        warehouse.replace_keys(table, rejects, files.select("file_path").distinct(), "file_path")
    else:
        warehouse.write(table, rejects, ["entity", "batch_id"])


def load_batch(
    warehouse: Warehouse,
    spec: EntitySpec,
    raw: DataFrame,
    loaded_at: datetime,
    mode: str = "upsert",
    unread: DataFrame | None = None,
    files: DataFrame | None = None,
    lock: Lock | None = None,
    database: str = "raw",
    **upsert_options,
) -> None:
    """Clean, record rejects, conform, keep the newest row per key, and write the raw table.

    Rows keep their ``batch_id``, and an upsert never puts an older batch's row in place of a newer one's.
    ``files`` names the files that are loaded (by default those with rows), ``unread`` lists the ones that were not
    read, as reject lines. ``lock`` guards the table of rejects, which all entities share.
    """
    cleaned = clean(spec, raw)
    rejects = load_rejects(spec, cleaned, loaded_at).select(F.lit(spec.name).alias("entity"), "*")
    if unread is not None:
        rejects = rejects.unionByName(unread)
    with lock or Lock():
        record_rejects(warehouse, rejects, raw if files is None else files, f"{database}.{REJECT_TABLE.split('.')[1]}")
    rows = newest_rows(spec, conform(spec, cleaned)).drop("file_path")
    options = {"newer_by": "batch_id", **upsert_options} if mode == "upsert" else upsert_options
    publish(warehouse, spec, rows, database, mode=mode, loaded_at=loaded_at, **options)


def read_state(warehouse: Warehouse) -> DataFrame:
    if warehouse.exists(STATE_TABLE):
        return warehouse.read(STATE_TABLE)
    return empty_state(warehouse.spark)


def watermark_of(warehouse: Warehouse, table: str) -> str | None:
    """Batch id up to which a table is loaded."""
    row = read_state(warehouse).where(F.col("table") == table).select("watermark").first()
    if row is None:
        return None
    return datetime.fromtimestamp(row[0] / 1000, UTC).strftime("%Y-%m-%d_%H%M%S")


def load_all(
    warehouse: Warehouse,
    root: str,
    loaded_at: datetime,
    mode: str = "upsert",
    entities: Sequence[str] = tuple(ENTITIES),
    skip_corrupt: bool = False,
    reject_log: str | None = None,
    **upsert_options,
) -> tuple[DataFrame, DataFrame]:
    """Load the new batches of every entity, side by side; returns the result per table and the summary.

    A table that fails is reported and keeps its watermark, so that its batches are due again. With
    ``skip_corrupt`` an unreadable file does not fail its table; it is listed among the rejects and does not count
    as loaded. The first rejects of each table go to the log, and to ``reject_log`` as JSON lines.
    """
    spark, lock = warehouse.spark, Lock()

    def one(name: str) -> tuple:
        spec = ENTITIES[name]
        batches = new_batches(spark, root, watermark_of(warehouse, name))
        files = list_files(spark, root, name, batches).select("file_path", "batch_id").collect()
        if not files:
            return name, "success", 0, "skipped", 0, None, None
        newest = spark.range(1).select(batch_millis(F.lit(max(r["batch_id"] for r in files)))).first()[0]
        groups = by_footer(spark, [r["file_path"] for r in files])
        if groups.unreadable and not skip_corrupt:
            raise ValueError(f"unreadable files: {groups.unreadable[:3]}")
        raw, listed = read_groups(spark, groups, skip_corrupt), spark.createDataFrame(files)
        if raw is None:
            raw = spark.createDataFrame([], f"{spec.key} string, batch_id string, file_path string")
        unread = unread_files(spark, groups, raw, name, loaded_at) if skip_corrupt else None
        load_batch(warehouse, spec, raw, loaded_at, mode, unread, listed, lock, **upsert_options)
        missed = 0 if unread is None else unread.select("file_path").distinct().count()
        return name, "success", len(files), "success", len(files) - missed, newest, None

    results = []
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for name, job in [(name, pool.submit(one, name)) for name in entities]:
            try:
                results.append(job.result())
            except Exception as error:  # noqa: BLE001 - reported per table, the other tables go on
                log.exception("loading %s failed", name)
                results.append((name, "error", 0, "error", 0, None, str(error)))
    table_results = spark.createDataFrame(results, RESULT_SCHEMA)
    progress = table_results.where("status = 'success'").select("table", "watermark")
    warehouse.replace(STATE_TABLE, advance(read_state(warehouse), progress, loaded_at))
    report_rejects(warehouse, loaded_at, reject_log)
    return table_results, run_summary(table_results)


def report_rejects(warehouse: Warehouse, loaded_at: datetime, path: str | None = None) -> None:
    """The first rejects of a load to the log, and all of them to a folder of JSON lines."""
    if not warehouse.exists(REJECT_TABLE):
        return
    rejects = warehouse.read(REJECT_TABLE).where(F.col("load_timestamp") == stamp(loaded_at))
    for r in first_rejects(rejects, "entity").collect():
        log.warning("%s: %s (%s rows of %s)", r["entity"], r["message"], r["count"], r["file_path"])
    if path is not None:
        write_reject_log(rejects, path)
