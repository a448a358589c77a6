"""What the footers of parquet files say, read by tasks.

The functions of this module travel with the job, so executors need pyarrow but not this package.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from collections.abc import Iterable, Sequence

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Footers that one task reads, and bytes that are read of a file's end at first.
FOOTERS, TAIL = 64, 1 << 16
# How a parquet file ends, and where Spark notes its own schema.
MAGIC = b"PAR1"
ROW_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
LINE = pa.schema({"file_path": pa.string(), "shape": pa.string(), "rows": pa.int64(), "message": pa.string()})

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class NoParquet(ValueError):
    """A file's end is no footer."""


def _opened(path: str, stores: dict[str, tuple[fs.FileSystem, str]]) -> pa.NativeFile:
    """The file, or the first file of the folder."""
    scheme, host, name = re.fullmatch(r"(?:([A-Za-z][\w+.-]*):)?(?://([^/]*))?(/.*)", path, re.S).groups()
    at = f"{scheme or 'file'}://{host or ''}/"
    if at not in stores:
        stores[at] = fs.FileSystem.from_uri(at)
    store, base = stores[at]
    full = base.rstrip("/") + name
    if store.get_file_info(full).type == fs.FileType.Directory:
        inside = [i.path for i in store.get_file_info(fs.FileSelector(full)) if i.base_name.endswith(".parquet")]
        full = min(inside, default=full)
    return store.open_input_file(full)


def _footer(file: pa.NativeFile) -> tuple[str, int]:
    """What decides the schema of a file, as one text, and its number of rows. Only the end of the file is read."""
    size = file.size()
    file.seek(max(0, size - TAIL))
    end = file.read()
    if len(end) < 12 or end[-4:] != MAGIC:
        raise NoParquet("the file does not end as a parquet file")
    length = int.from_bytes(end[-8:-4], "little") + 8
    if length > size - len(MAGIC):
        raise NoParquet("the footer is longer than the file")
    if length > len(end):
        file.seek(size - length)
        end = file.read()
    try:
        found = pq.read_metadata(pa.BufferReader(MAGIC + end[-length:]))
    except Exception as error:  # the bytes are there, so it is what they say
        raise NoParquet(str(error).splitlines()[0][:200]) from error
    columns = [found.schema.column(i) for i in range(len(found.schema))]
    shape = [
        [c.path, c.physical_type, str(c.logical_type), str(c.converted_type), c.length, c.precision, c.scale]
        + [c.max_definition_level, c.max_repetition_level]
        for c in columns
    ]
    saved = (found.metadata or {}).get(ROW_SCHEMA, b"").decode("utf-8", "replace")
    return json.dumps([shape, saved]), found.num_rows


def footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Per file: ``shape`` (equal for files of equal schema), ``rows``, and ``message`` if its footer is none.

    Tasks read the ends of the files, ``FOOTERS`` each. All three are NULL where Arrow has no way to the store or the
    store fails; nothing is known of such a file then.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        stores: dict[str, tuple[fs.FileSystem, str]] = {}
        for batch in batches:
            lines = []
            for path in batch.column(0).to_pylist():
                shape, rows, message = None, None, None
                try:
                    with _opened(path, stores) as file:
                        shape, rows = _footer(file)
                    shape = hashlib.sha256(shape.encode()).hexdigest()
                except NoParquet as error:
                    message = str(error)
                except (OSError, pa.ArrowException):
                    pass
                lines.append({"file_path": path, "shape": shape, "rows": rows, "message": message})
            yield pa.RecordBatch.from_pylist(lines, LINE)

    names = spark.createDataFrame([(p,) for p in paths], "file_path string").repartition(max(1, -(-len(paths) // FOOTERS)))
    return names.mapInArrow(read, "file_path string, shape string, rows bigint, message string")
