"""Quality: a sparse ensemble of rules over text statistics.

Shallow trees are grown on a bounded sample of labelled documents, every path from a root becomes a rule (a
conjunction of conditions on statistics), and a logistic regression with an L1 penalty picks rules and weights.
What remains is compiled into one column expression over the statistics of all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.llm.common import pieces, prepare, texts, words, written

# Labelled documents to learn from, at most; those with the lowest hash of their id are taken.
SAMPLE = 32_768
TREES, DEPTH = 24, 3
PENALTY = 0.002
CUT = 0.7

_LETTERS, _DIGITS = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
_CLASSES = {
    "letters": _LETTERS + bytes(range(128, 256)),
    "capitals": _LETTERS[26:],
    "digits": _DIGITS,
    "blanks": b" \t\r",
    "lines": b"\n",
    "stops": b".!?",
    "commas": b",;:",
    "bars": b"|",
    "signs": b"#$%&*@^~+=<>_\\/{}[]",
    "others": b"\"'()-`",
}
STATISTICS = (
    "log_bytes",
    "log_words",
    "word_bytes",
    "distinct_words",
    "top_word",
    "repeated_pairs",
    *(f"share_{name}" for name in _CLASSES if name not in ("lines", "stops")),
    "words_per_line",
    "words_per_stop",
)


def measure(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The statistics of several documents (their bytes joined), a row for each; empty texts have zeros."""
    n, size = len(ends) - 1, np.diff(ends)
    whole = np.maximum(size, 1)
    doc, start, stop, code = words(data, ends)
    many = np.bincount(doc, minlength=n)
    count = np.maximum(many, 1)
    sums = {}
    for name, members in _CLASSES.items():
        table = np.zeros(256, bool)
        table[list(members)] = True
        run = np.concatenate([[0], np.cumsum(table[data])])
        sums[name] = run[ends[1:]] - run[ends[:-1]]
    order = np.lexsort((code, doc))
    first = np.ones(len(order), bool)
    first[1:] = (code[order][1:] != code[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    at = np.flatnonzero(first)
    times = np.diff(at, append=len(order))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, doc[order][at], times)
    same = np.zeros(len(doc), bool)
    same[1:] = (code[1:] == code[:-1]) & (doc[1:] == doc[:-1])
    columns = [
        np.log1p(size),
        np.log1p(many),
        np.bincount(doc, stop - start, minlength=n) / count,
        np.bincount(doc[order][at], minlength=n) / count,
        top / count,
        np.bincount(doc[same], minlength=n) / count,
        *(sums[name] / whole for name in _CLASSES if name not in ("lines", "stops")),
        np.log1p(many / (1 + sums["lines"])),
        np.log1p(many / (1 + sums["stops"])),
    ]
    return np.stack(columns, axis=1)


def statistics(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id and the statistics of its whole text, for every row; ``extra`` columns go along."""
    own = texts(docs, *extra)
    kept = own.drop("text").columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, ends in pieces(batches, limit=1 << 20):
            values = measure(data, ends)
            columns = [rows.column(c) for c in kept] + [pa.array(values[:, i]) for i in range(values.shape[1])]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *STATISTICS])

    schema = own.drop("text").schema
    for name in STATISTICS:
        schema = schema.add(name, "double")
    return own.mapInArrow(run, schema)


# A condition is (statistic, whether it is above, bound); a rule holds if all of its conditions do.
Rule = tuple[tuple[str, bool, float], ...]


def paths(described: str) -> list[Rule]:
    """All paths from the roots, inner ones included, of trees as Spark describes them."""
    found: dict[Rule, None] = {}
    stack: list[tuple[str, bool, float]] = []
    for line in described.splitlines():
        depth = len(line) - len(line.lstrip())
        step = re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line)
        if re.match(r"\s*Tree \d+", line):
            base, stack = depth, []
        elif step:
            level = depth - base
            while stack and stack[-1][0] >= level:
                stack.pop()
            stack.append((level, (STATISTICS[int(step[1])], step[2] == ">", float(step[3]))))
            found[tuple(condition for _, condition in stack)] = None
    return list(found)


def holds(rule: Rule) -> Column:
    out = F.lit(True)
    for name, above, bound in rule:
        out = out & (F.col(name) > bound if above else F.col(name) <= bound)
    return out


@dataclass
class Ensemble:
    """Rules with their weights, and the intercept."""

    rules: list[tuple[Rule, float]]
    intercept: float

    def score(self) -> Column:
        """The probability of label 1, as an expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ensemble:
    """Learn ``labels`` (doc_id, label 0 or 1) from at most ``sample`` of the documents that have one.

    Rows without an id, a label of 0 or 1, or a document teach nothing; of several labels of one document the
    larger one counts. With labels of one kind only, or none, every document gets their share (none: one half).
    """
    prepare(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("double").alias("label"))
    known = known.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # as many rows as the sample
    learn = statistics(chosen, "label")
    learn = written(learn.select(*STATISTICS, "label"), "quality")
    learn = learn.coalesce(4)  # a few MB at most
    ones, total = learn.agg(F.sum("label"), F.count("*")).first()
    if not total or ones in (0, total):
        share = 0.5 if not total else min(max(ones / total, 1e-6), 1 - 1e-6)
        return Ensemble([], float(np.log(share / (1 - share))))
    ready = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(learn)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, maxBins=48, minInstancesPerNode=max(2, int(total) // 400), featureSubsetStrategy="onethird", subsamplingRate=0.7, seed=13
    ).fit(ready)
    rules = paths(forest.toDebugString)
    if not rules:
        share = ones / total
        return Ensemble([], float(np.log(share / (1 - share))))
    flags = learn.select("label", array_to_vector(F.array(*[holds(rule).cast("double") for rule in rules])).alias("features"))
    lasso = LogisticRegression(regParam=PENALTY, elasticNetParam=1.0, maxIter=100, standardization=False).fit(flags)
    weights = lasso.coefficients.toArray()
    return Ensemble([(rule, float(w)) for rule, w in zip(rules, weights) if w], float(lasso.intercept))


def score(docs: DataFrame, model: Ensemble) -> DataFrame:
    """Per row of ``docs``: doc_id and score (0 to 1) of its whole text; null texts score as empty ones."""
    prepare(docs.sparkSession)
    return statistics(docs).select("doc_id", model.score().alias("score"))
