"""What the operators of this subpackage share: whole texts as bytes, written intermediate tables, components."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.session import scratch_dir, tune

# Rows that Spark hands to a Python worker at once; workers cut them further by bytes.
ARROW_ROWS = "500"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of these operators, and where Python workers find this package if it is not installed."""
    tune(spark)
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    if not spark.sparkContext.getConf().contains("spark.sql.execution.arrow.maxRecordsPerBatch"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    if not spark.sparkContext.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None) or os.path.dirname(scratch_dir(spark, "llm"))
        spark.sparkContext.setCheckpointDir(shared)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame below the shared scratch folder and read it again. Lost executors cost no more than one stage."""
    spark = prepare(df.sparkSession)
    path = os.path.join(scratch_dir(spark, "llm"), f"{purpose}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id and text (null: empty) of every row, and nothing else unless named."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *extra,
    )


def as_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row begins and ends (n + 1 offsets). Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null(b"" if pa.types.is_binary(column.type) else "").cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return whole, ends - ends[0]


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = 2 << 20) -> Iterator[tuple]:
    """Cut batches to about ``limit`` bytes of text (one row at least): (rows, bytes, offsets)."""
    for batch in batches:
        data, ends = as_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
            to = min(to, batch.num_rows)
            yield batch.slice(at, to - at), data[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
            at = to


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): one row (node, root) for each node that has an edge.

    ``root`` is the smallest node of the component. Large-star and small-star steps alternate until nothing
    changes. Minima are combined before they are dealt, and are written before they are joined back, so that the
    adaptive skew join can split a hub's rows. Null ends and loops link nothing; no edges give no rows.
    """
    kind = dict(edges.dtypes)["a"]
    edges = (
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("a IS NOT NULL AND b IS NOT NULL AND u <> v")
        .distinct()
        .checkpoint()
    )
    print_of = (F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    state = tuple(edges.agg(*print_of).first())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).checkpoint()
        large = both.join(low, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct().checkpoint()
        low = large.groupBy("u").agg(F.min("v").alias("m")).checkpoint()
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        last, state = state, tuple(edges.agg(*print_of).first())
        if state == last:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").cast(kind).alias("node"), F.col("v").alias("root")).unionByName(roots)


# Byte by byte: lower-case A-Z; a word is a run of 0-9, a-z and bytes from 80 on.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_STEP = 0xD6E8FEB86659FD93
_BACK = pow(_STEP, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    return x


_CODE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[_LOWER]


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < n:
        grown = np.full(max(n, 1 << 16), base, np.uint64)
        grown[0] = 1
        _POWERS[base] = np.cumprod(grown, dtype=np.uint64)
    return _POWERS[base][:n]


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of several documents (their bytes joined): document, first byte, byte after the last, 64-bit hash."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_WORD[data]
    edge = inside[1:] != inside[:-1]
    # a word that runs on from one document into the next is two
    cut = ends[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(data))])
    cut = cut[inside[cut] & inside[cut + 1]]
    at = np.flatnonzero(edge)
    start, stop = at[::2], at[1::2]
    if len(cut):
        start, stop = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([stop, cut]))
    sums = np.zeros(len(data) + 1, np.uint64)
    if len(data):
        np.cumsum(_CODE[data] * _powers(_STEP, len(data)), out=sums[1:])
    code = mixed((sums[stop] - sums[start]) * _powers(_BACK, max(1, len(data)))[start])
    return np.searchsorted(ends, start, "right") - 1, start, stop, code


def grams(doc: np.ndarray, code: np.ndarray, n: int, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every n words in a row of one document, ``skip`` words left out between them."""
    step = skip + 1
    reach = (n - 1) * step
    if len(code) <= reach:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    m = len(code) - reach
    out = code[:m] + np.uint64(n * 16 + skip)
    for k in range(1, n):
        out = mixed(out) + code[k * step : k * step + m]
    own = np.flatnonzero(doc[:m] == doc[reach:])
    return own, mixed(out[own])
