"""Landed files as a stream: every file once, remembered by the stream's checkpoint."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from leadmill.operators.tables import Warehouse
from leadmill.plans.flow import load_batch
from leadmill.registry import EntitySpec
from leadmill.sources.batches import batch_id_of, by_footer, entity_glob, read_groups
from leadmill.functions import parse_batch_id

# Fixed value: the columns of Spark's reader of whole files. Contents are never asked for.
FILE_COLUMNS = "path string, modificationTime timestamp, length bigint, content binary"
# File names of a micro-batch, at most.
FILES_AT_ONCE = 1000


def read_landing(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Stream of the files that match a path pattern.

    Without a schema the one of the files that are there already is used, with all their columns.
    """
    if schema is None:
        schema = spark.read.option("mergeSchema", "true").parquet(path).schema
    return spark.readStream.schema(schema).parquet(path)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Process everything that has not been processed under this checkpoint, then stop."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query.start().awaitTermination()


def file_names(spark: SparkSession, pattern: str, at_once: int = FILES_AT_ONCE) -> DataFrame:
    """Stream of the paths of the files that match a pattern; their contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(FILE_COLUMNS).option("maxFilesPerTrigger", at_once)
    return reader.load(pattern).select(F.col("path").alias("file_path"), batch_id_of(F.col("path")).alias("batch_id"))


def parts_per_file(spark: SparkSession, pattern: str) -> int:
    """Files that a landed file consists of, on average: Spark lands a folder of parts under the file's name."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(pattern).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    landed, parts = (len(store.globStatus(path(p)) or ()) for p in (pattern, f"{pattern}/[!_.]*"))
    return max(1, math.ceil(parts / max(1, landed)))


def ingest(
    warehouse: Warehouse,
    root: str,
    spec: EntitySpec,
    checkpoint: str,
    loaded_at: Callable[[], datetime] = datetime.now,
    database: str = "raw",
    at_once: int = FILES_AT_ONCE,
    **upsert_options,
) -> None:
    """Upsert the new files of one entity into its raw table.

    The stream carries file names. Each micro-batch reads its files as a batch load does: grouped by the schema in
    their footers and brought to common types, so files that differ from those of other batches do no harm. A
    micro-batch that runs again after a failure upserts the same rows and changes nothing. The checkpoint moves only
    after the write; an unreadable file fails its micro-batch.

    ``at_once`` counts landed files. Each upsert rewrites what it touches, so the parts of a landed file, whose number
    grows with the writer's cores and rows, are not dealt to micro-batches of their own as long as ``FILES_AT_ONCE``
    names hold them.
    """
    pattern = entity_glob(root, spec.name)
    parts = at_once * parts_per_file(warehouse.spark, pattern)
    names = file_names(warehouse.spark, pattern, max(at_once, min(parts, FILES_AT_ONCE)))
    names = names.where(parse_batch_id(F.col("batch_id")).isNotNull())

    def load(batch: DataFrame, _: int) -> None:
        files = batch.collect()  # at most ``at_once`` or ``FILES_AT_ONCE`` names
        groups = by_footer(warehouse.spark, [r["file_path"] for r in files])
        if groups.unreadable:
            raise ValueError(f"unreadable files of {spec.name}: {groups.unreadable[:3]}")
        rows = read_groups(warehouse.spark, groups)
        if rows is not None:
            listed = warehouse.spark.createDataFrame(files)
            load_batch(warehouse, spec, rows, loaded_at(), files=listed, database=database, **upsert_options)

    run_available(names, checkpoint, load)
