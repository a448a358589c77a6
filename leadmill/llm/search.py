"""Ranked lexical search for many queries at once, with what they share evaluated once.

Documents are read into blocks of postings (which of the queries' terms a document has, how often, and how many terms in
all), from which the corpus statistics are summed. On the driver the queries' term sets are mined for sets that several
of them share: in rounds, pairs of terms or of earlier sets that stand together in two queries or more become a set of
their own. That gives a graph whose leaves are terms and whose roots are queries. For every block of documents the
leaves' accumulators are filled, each shared set's accumulator is added up once from its two parts, and the queries are
summed from the sets and terms that are left of them. Every document is scored for every query; tasks keep the best of
each query. Queries come in blocks of bounded size, so what is broadcast and what accumulators take has a bound.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadmill.llm.common import pieces, prepare, texts, written

TOP = 10
# Bytes of the items' texts in a block of queries, about; an item that is longer is a block of its own.
BLOCK = 1 << 18
# Documents of a block of postings, and cells (nodes times documents) of the accumulators.
DOCS, CELLS = 256, 1 << 23
# Pairs are mined among so many neighbours of a query's terms, the most frequent ones first.
NEAR = 64
# Bytes of a text that are split into terms at a time.
SPLIT = 1 << 20
# A query's best documents are found by part of the documents first.
SALT = 32

# Byte by byte: A-Z in lower case; what is no digit, letter or byte from 80 on is a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(text: bytes) -> Counter:
    """How often each term stands in a text."""
    text = text.translate(_FOLD)
    if len(text) <= SPLIT:
        return Counter(text.split())
    out, at = Counter(), 0
    while at < len(text):
        to = text.find(b" ", at + SPLIT)
        to = len(text) if to < 0 else to
        out.update(text[at:to].split())
        at = to
    return out


@dataclass
class Plan:
    """Leaves are (term, times in the query); the nodes behind them are sums of two earlier ones, level by level."""

    terms: list[bytes]
    leaf_term: np.ndarray
    leaf_times: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]
    items: list
    parts: np.ndarray
    starts: np.ndarray

    @property
    def nodes(self) -> int:
        return len(self.leaf_term) + sum(len(left) for left, _ in self.levels)


def shared(queries: list[list[int]], nodes: int) -> tuple[list[list[int]], list[tuple[np.ndarray, np.ndarray]]]:
    """Mine pairs of nodes that several queries have: the queries over the nodes left, and the pairs of each round."""
    levels = []
    while True:
        used = Counter(node for query in queries for node in query)
        groups = []  # (query, neighbours)
        for i, query in enumerate(queries):
            common = sorted((n for n in query if used[n] > 1), key=lambda n: (-used[n], n))
            groups += [(i, common[at : at + NEAR]) for at in range(0, len(common), NEAR)]
        seen = Counter((min(x, y), max(x, y)) for _, group in groups for k, x in enumerate(group) for y in group[k + 1 :])
        taken: dict[tuple[int, int], list[int]] = {}
        for i, group in groups:
            pairs = [(-seen[p], p) for k, x in enumerate(group) for y in group[k + 1 :] if seen[p := (min(x, y), max(x, y))] > 1]
            free = set(group)
            for _, pair in sorted(pairs):
                if pair[0] in free and pair[1] in free:
                    free -= set(pair)
                    taken.setdefault(pair, []).append(i)
        taken = {pair: own for pair, own in sorted(taken.items()) if len(own) > 1}
        if not taken:
            return queries, levels
        sets = [set(query) for query in queries]
        for node, (pair, own) in enumerate(taken.items(), nodes):
            for i in own:
                sets[i] -= set(pair)
                sets[i].add(node)
        queries = [sorted(s) for s in sets]
        nodes += len(taken)
        left, right = np.array(list(taken), np.int64).T
        levels.append((left, right))


def plan(items: list[tuple[object, str]]) -> Plan:
    """The query-sharing graph of (item, text)."""
    counts = [term_counts(text.encode()) for _, text in items]
    terms = sorted(set().union(*counts)) if counts else []
    at = {term: i for i, term in enumerate(terms)}
    leaves: dict[tuple[int, int], int] = {}
    queries = [sorted(leaves.setdefault((at[term], n), len(leaves)) for term, n in c.items()) for c in counts]
    queries, levels = shared(queries, len(leaves))
    some = [(item, query) for (item, _), query in zip(items, queries) if query]
    leaf = np.array(list(leaves), np.int64).reshape(-1, 2)
    starts = np.cumsum([0] + [len(query) for _, query in some])[:-1]
    parts = np.array([n for _, query in some for n in query], np.int64)
    return Plan(terms, leaf[:, 0], leaf[:, 1], levels, [item for item, _ in some], parts, starts)


def postings(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """Blocks of documents: ids, number of all terms, and for the given terms ends, term and frequency, as packed arrays."""
    known = docs.sparkSession.sparkContext.broadcast({term: i for i, term in enumerate(terms)})
    columns = ("ids", "lacks", "sizes", "ends", "terms", "times")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        names = number.keys()
        for rows, data, ends in pieces(batches):
            raw = data.tobytes()
            for lo in range(0, rows.num_rows, DOCS):
                hi = min(lo + DOCS, rows.num_rows)
                sizes, stops, terms, times = [], [], [], []
                for a, b in zip(ends[lo:hi].tolist(), ends[lo + 1 : hi + 1].tolist()):
                    counts = term_counts(raw[a:b])
                    sizes.append(counts.total())
                    own = counts.keys() & names
                    terms += [number[t] for t in own]
                    times += [counts[t] for t in own]
                    stops.append(len(terms))
                ids = rows.column("doc_id").slice(lo, hi - lo)
                packed = (
                    ids.fill_null(0).to_numpy().astype(np.int64), ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
                    np.array(sizes, np.int64), np.array(stops, np.int64), np.array(terms, np.int32), np.array(times, np.int64),
                )
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in packed], list(columns))

    return texts(docs).mapInArrow(run, ", ".join(f"{c} binary" for c in columns))


@dataclass
class Posted:
    """One block of documents."""

    ids: np.ndarray
    lacks: np.ndarray
    sizes: np.ndarray
    doc: np.ndarray
    terms: np.ndarray
    times: np.ndarray


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[Posted]:
    for batch in batches:
        for row in batch.to_pylist():
            ends = np.frombuffer(row["ends"], np.int64)
            doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            yield Posted(
                np.frombuffer(row["ids"], np.int64), np.frombuffer(row["lacks"], np.uint8), np.frombuffer(row["sizes"], np.int64),
                doc, np.frombuffer(row["terms"], np.int32), np.frombuffer(row["times"], np.int64),
            )


def statistics(posted: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms, and the documents that hold each of the given terms."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, size = np.zeros(n_terms, np.int64), 0, 0
        for block in _read(batches):
            held += np.bincount(block.terms, minlength=n_terms)
            docs += int((block.sizes > 0).sum())
            size += int(block.sizes.sum())
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2])), pa.array(np.append(held[at], [docs, size]))], ["term", "n"])

    held, rest = np.zeros(n_terms, np.int64), {-1: 0, -2: 0}
    for row in posted.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():  # of a block of queries
        if row["term"] < 0:
            rest[row["term"]] = row["n"]
        else:
            held[row["term"]] = row["n"]
    return rest[-1], rest[-2], held


def weights(docs: int, held: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)


def scores(block: Posted, graph: Plan, weight: np.ndarray, docs: int, size: int) -> np.ndarray:
    """Scores of every item (rows) for every document of a block: leaves, shared sets level by level, items."""
    m = 25 + (75 * block.sizes * docs) // size
    value = weight[block.terms] * ((1_000_000_000 * block.times) // (1000 * block.times + 8 * m[block.doc]))
    plain = np.zeros((len(graph.terms), len(block.sizes)), np.int64)
    plain[block.terms, block.doc] = value
    made = np.empty((graph.nodes, len(block.sizes)), np.int64)
    at = len(graph.leaf_term)
    np.multiply(plain[graph.leaf_term], graph.leaf_times[:, None], out=made[:at])
    for left, right in graph.levels:
        np.add(made[left], made[right], out=made[at : at + len(left)])
        at += len(left)
    out = np.empty((len(graph.items), len(block.sizes)), np.int64)
    ends = np.append(graph.starts[1:], len(graph.parts))
    for i, (a, b) in enumerate(zip(graph.starts.tolist(), ends.tolist())):
        made[graph.parts[a:b]].sum(axis=0, out=out[i])
    return out


def _cut(block: Posted, step: int) -> Iterator[Posted]:
    for lo in range(0, len(block.sizes), step):
        own = (block.doc >= lo) & (block.doc < lo + step)
        hi = lo + step
        yield Posted(block.ids[lo:hi], block.lacks[lo:hi], block.sizes[lo:hi], block.doc[own] - lo, block.terms[own], block.times[own])


def best(posted: DataFrame, graph: Plan, docs: int, size: int, held: np.ndarray, top: int) -> DataFrame:
    """The best documents of each item (its place in the block) that every task has seen: item, doc_id, score."""
    shared_plan = posted.sparkSession.sparkContext.broadcast((graph, weights(docs, held)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, weight = shared_plan.value
        step = max(1, CELLS // max(1, graph.nodes + len(graph.terms)))
        least = np.ones(len(graph.items), np.int64)  # what a document must score to be among the best
        kept = np.zeros((4, 0), np.int64)
        for whole in _read(batches):
            for block in _cut(whole, step):
                found = scores(block, graph, weight, docs, size)
                item, at = np.nonzero(found >= least[:, None])
                new = np.stack([item, -found[item, at], block.lacks[at], block.ids[at]])
                kept = np.concatenate([kept, new], axis=1)
                kept = kept[:, np.lexsort(kept[::-1])]
                first = np.searchsorted(kept[0], np.arange(len(graph.items) + 1))
                nth = np.arange(kept.shape[1]) - first[kept[0]]
                kept = kept[:, nth < top]
                full = np.flatnonzero(np.bincount(kept[0], minlength=len(graph.items)) == top)
                least[full] = -kept[1][np.searchsorted(kept[0], full, "right") - 1]
        ids = pa.array(kept[3], mask=kept[2] > 0)
        yield pa.RecordBatch.from_arrays([pa.array(kept[0]), ids, pa.array(-kept[1])], ["item", "doc_id", "score"])

    return posted.mapInArrow(run, "item long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` documents of each item by score, of all documents: item_id, rank, doc_id, score.

    Texts that are null, empty or without terms match nothing. Rows of ``items`` with one item_id (or without one) are
    one item, whose terms are those of its different texts together; repeated rows count once. Each row of ``docs`` is
    a document; equal scores come in the order of doc_id, a null one last. Empty tables give no rows; other columns
    are not looked at.
    """
    spark = prepare(docs.sparkSession)
    own = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = own.groupBy("item_id").agg(F.array_join(F.array_sort(F.collect_set("text")), " ").alias("text"))
    own = written(own, "items")
    # items in blocks of about so many bytes
    sized = own.withColumn("size", F.octet_length("text")).agg(F.sum("size").alias("size")).first()["size"] or 0
    blocks = max(1, -(-sized // BLOCK))
    dealt = own.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    found = None
    for number in range(blocks):
        graph = plan([tuple(row) for row in dealt.where(F.col("block") == number).select("item_id", "text").collect()])
        if not graph.items:
            continue
        posted = written(postings(docs, graph.terms), "postings")
        n_docs, size, held = statistics(posted, len(graph.terms))
        if not size:
            continue
        names = spark.createDataFrame([(i, item) for i, item in enumerate(graph.items)], "item long, item_id long")
        part = written(best(posted, graph, n_docs, size, held, top).join(F.broadcast(names), "item").drop("item"), "best")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    by_part = Window.partitionBy("item_id", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALT))).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(by_part)).where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)).cast("int"))
    return found.where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
