"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are the distinct words, word pairs, pairs with one word left out, and triples of its whole
text, hashed to ``2 ** BITS`` places. Learning runs over a bounded sample of labelled documents, cut into shards
that learn side by side; after each round the shards' whole states are averaged place by place, in tasks that each sum
one block of places, and go into the next round. L1 leaves most weights at zero, so the model that scores all documents is a short list of at most
``2 ** BITS`` places, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.llm.common import as_bytes, grams, pieces, prepare, texts, words, written

BITS = 20
# (words in a row, words left out between them)
KINDS = ((1, 0), (2, 0), (2, 1), (3, 0))
# Labelled documents to learn from, at most; those with the lowest hash of their id are taken.
SAMPLE = 16_384
# Documents of a shard and bytes of its texts, at most about, and passes over all shards.
SHARD, SHARD_BYTES, ROUNDS = 4096, 64 << 20, 4
# Places whose changes travel as one block, as a power of two.
BLOCK_BITS = 16
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.0
CUT = 0.7


def features(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and place of every feature occurrence of several documents."""
    doc, _, _, code = words(data, ends)
    docs, places = [], []
    for n, skip in KINDS:
        at, gram = grams(doc, code, n, skip)
        docs.append(doc[at])
        places.append((gram >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(docs), np.concatenate(places)


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of FTRL-proximal's state: zero where L1 outweighs the gradients."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def learn(rows: Iterable[tuple[np.ndarray, int]], z: np.ndarray, n: np.ndarray) -> None:
    """One pass of FTRL-proximal over (distinct places, label), changing the state in place. The last place is the bias."""
    for at, label in rows:
        at = np.append(at, len(z) - 1)
        own, seen = z[at], n[at]
        w = weights(own, seen)
        gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        grown = seen + gradient * gradient
        z[at] = own + gradient - (np.sqrt(grown) - np.sqrt(seen)) / ALPHA * w
        n[at] = grown


@dataclass
class Model:
    """Places with a weight, and the bias."""

    places: np.ndarray
    weights: np.ndarray
    bias: float

    def scorer(self) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        table = np.zeros(1 << BITS, np.float32)
        table[self.places] = self.weights

        def score(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
            doc, place = features(data, ends)
            used = table[place] != 0
            pair = np.unique(doc[used] << BITS | place[used])
            total = np.bincount(pair >> BITS, table[pair & ((1 << BITS) - 1)], minlength=len(ends) - 1)
            return 1 / (1 + np.exp(-np.clip(total + self.bias, -35, 35)))

        return score


def learner(before: Broadcast) -> Callable[[pa.Table], pa.Table]:
    """A pass over a shard, from the given state: by how much it changes it, in blocks of places."""
    size = (1 << BITS) + 1
    blocks = -(-size >> BLOCK_BITS)

    def run(rows: pa.Table) -> pa.Table:
        old_z, old_n = before.value
        z, n = old_z.copy(), old_n.copy()
        order = np.argsort(rows.column("order").to_numpy(), kind="stable")
        rows = rows.take(pa.array(order))

        def examples() -> Iterator[tuple[np.ndarray, int]]:
            for batch in rows.to_batches(max_chunksize=200):
                data, ends = as_bytes(batch.column("text"))
                doc, place = features(data, ends)
                pair = np.unique(doc << BITS | place)
                cuts = np.searchsorted(pair, np.arange(len(ends)) << BITS)
                for a, b, label in zip(cuts, cuts[1:], batch.column("label").to_pylist()):
                    yield pair[a:b] & ((1 << BITS) - 1), label

        learn(examples(), z, n)
        change = np.zeros((2, blocks << BLOCK_BITS), np.float32)
        change[0, :size], change[1, :size] = z - old_z, n - old_n
        cells = [change[:, at << BLOCK_BITS : (at + 1) << BLOCK_BITS].tobytes() for at in range(blocks)]
        return pa.table({"block": pa.array(np.arange(blocks, dtype=np.int32)), "cells": pa.array(cells, pa.binary())})

    return run


def summed(rows: pa.Table) -> pa.Table:
    """One block's changes, added up over the shards."""
    total = np.zeros(2 << BLOCK_BITS)
    for cells in rows.column("cells").to_pylist():
        total += np.frombuffer(cells, np.float32)
    return pa.table({"block": rows.column("block").slice(0, 1), "cells": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn ``labels`` (doc_id, label 0 or 1) from at most ``sample`` of the documents that have one.

    Rows without an id, a label of 0 or 1, or a document teach nothing; of several labels of one document the
    larger one counts, of several texts of one document the smallest. Nothing to learn from: all scores are one half.
    """
    spark = prepare(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    known = known.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    known = known.withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(sample)
    chosen = texts(docs).join(F.broadcast(known), "doc_id")  # as many ids as the sample
    chosen = written(chosen.groupBy("doc_id", "label", "order").agg(F.min("text").alias("text")), "learn")
    rows, n_bytes = chosen.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    shards = max(1, -(-rows // SHARD), -(-n_bytes // SHARD_BYTES))
    chosen = chosen.withColumn("shard", F.pmod("order", F.lit(shards)).cast("int"))
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    for _ in range(ROUNDS):
        before = spark.sparkContext.broadcast((z, n))
        changes = chosen.groupBy("shard").applyInArrow(learner(before), "block int, cells binary")
        changes = changes.groupBy("block").applyInArrow(summed, "block int, cells binary")
        # the mean of all shards' states, eight bytes a place: a shard without a place leaves it as it was
        for row in changes.toLocalIterator():
            at = slice(row["block"] << BLOCK_BITS, min((row["block"] + 1) << BLOCK_BITS, size))
            change = np.frombuffer(row["cells"], np.float32).reshape(2, -1)[:, : at.stop - at.start]
            z[at] += change[0] / shards
            n[at] += change[1] / shards
        before.unpersist()
    w = weights(z, n)
    bias = float(w[-1])
    places = np.flatnonzero(w[:-1])
    return Model(places, w[places].astype(np.float32), bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: doc_id and score (0 to 1) of its whole text. Null and empty texts get the bias alone."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for rows, data, ends in pieces(batches, limit=1 << 20):
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(of(data, ends), pa.float64())], ["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` whose score is below ``cut``, with all their columns; nothing is shuffled."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for rows, data, ends in pieces(batches, limit=1 << 20):
            yield rows.filter(pa.array(of(data, ends) < cut))

    return docs.mapInArrow(run, docs.schema)


def remainder(modulus: int, column: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, by ``modulus``."""
    return F.crc32(F.col(column).cast("string")) % modulus
