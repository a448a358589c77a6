"""Benchmark decontamination: rare n-gram seeds find passages, Smith-Waterman alignments score them.

A test item of L words counts as held by a document if a local alignment of their words (match 2, mismatch -1,
gap -2) scores at least ``least`` of the 2 L points of a whole copy; 0.7 leaves room for every fifth word to be
changed. Such an alignment has at most ``0.3 L`` breaks (each costs two points or more), so of one more disjoint
n-grams than that at least one stands in the document as it is. Of all ways to lay these seeds, the one with the
fewest occurrences in the corpus is taken, whatever their number: no seed is left out for being frequent.

Items are handled in blocks whose text has a fixed size, so what is sent to the executors is bounded; a larger
benchmark means more passes over the documents, not larger tables. Documents are never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.llm.common import grams, pieces, prepare, texts, words

LEAST = 0.7
BLOCK_BYTES = 1 << 20
MATCH, MISMATCH, GAP = 2, -1, -2


class Item:
    """A test item as word hashes."""

    def __init__(self, item_id: int | None, text: str):
        raw = np.frombuffer(text.encode(), np.uint8)
        self.item_id = item_id
        self.code = words(raw, np.array([0, len(raw)]))[3]
        self.unique = np.unique(self.code)
        self.seeds: list[tuple[int, int, int]] = []

    def breaks(self, least: float) -> int:
        """The most breaks that an alignment of ``least`` can have."""
        return int((1 - least) * MATCH * len(self.code) / 2 + 1e-9)

    def candidates(self, least: float) -> list[tuple[int, int, int]]:
        """(offset, words, hash) of every n-gram that may become a seed: as long as fit side by side, or one longer."""
        n, count = len(self.code), self.breaks(least) + 1
        out, doc = [], np.zeros(n, np.int64)
        for size in {max(1, n // count), max(1, n // count) + 1}:
            at, code = grams(doc, self.code, size)
            out += zip(at.tolist(), [size] * len(at), code.tolist())
        return out

    def choose(self, least: float, seen: dict[int, int]) -> None:
        """Lay one more disjoint seeds than there can be breaks, with the fewest occurrences in the corpus.

        Seeds have ``size`` or ``size + 1`` words, so the first k of them end less than ``size * k + spare`` words from
        the start: one row of ``spare`` costs a seed, of which two bits a cell are kept to find the way back.
        """
        n, count = len(self.code), self.breaks(least) + 1
        size = max(1, n // count)
        spare = n - size * count
        cost = np.full((2, n + 1), np.inf)
        code = np.zeros((2, n + 1), np.uint64)
        for at, words_, gram in self.candidates(least):
            cost[words_ - size, at], code[words_ - size, at] = seen.get(gram, 0), gram
        best = np.zeros(spare + 1)
        same, longer = [], []
        for k in range(count):
            short = best + cost[0, size * k : size * k + spare + 1]
            long = np.full(spare + 1, np.inf)
            long[1:] = (best + cost[1, size * k : size * k + spare + 1])[:-1]
            step = np.minimum(short, long)
            best = np.minimum.accumulate(step)
            same.append(np.packbits(np.append(False, best[1:] == best[:-1])))
            longer.append(np.packbits(long < short))
        e = spare
        for k in reversed(range(count)):
            kept = np.unpackbits(same[k])
            while kept[e]:
                e -= 1
            more = int(np.unpackbits(longer[k])[e])
            e -= more
            at = size * k + e
            self.seeds.append((at, size + more, int(code[more, at])))


class Lookup:
    """Hashes that most words are found not to have with one look at a table of bits."""

    def __init__(self, codes: Iterable[int]):
        self.codes = np.unique(np.array(list(codes), np.uint64))
        size = 1 << max(10, int(64 * len(self.codes)).bit_length())
        self.mask = np.uint64(size - 1)
        self.maybe = np.zeros(size, bool)
        self.maybe[self.codes & self.mask] = True

    def find(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``code`` that are known, and their numbers among the known."""
        at = np.flatnonzero(self.maybe[code & self.mask])
        if not len(at):
            return at, at
        nth = np.minimum(np.searchsorted(self.codes, code[at]), len(self.codes) - 1)
        known = self.codes[nth] == code[at]
        return at[known], nth[known]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman score of two sequences of word hashes, and the aligned part [first, last] of the passage.

    Of equal scores, the alignment that ends first in the passage counts.
    Only the row above is held, with the place where the best alignment that ends in a cell begins.
    """
    n = len(passage)
    place = np.arange(n + 1)
    above, began = np.zeros(n + 1, np.int64), place
    best = (0, -1, -1)
    for word in item:
        row = np.zeros(n + 1, np.int64)
        apart = above[:-1] + np.where(passage == word, MATCH, MISMATCH)
        down = above[1:] + GAP
        row[1:] = np.maximum(np.maximum(apart, down), 0)
        row = np.maximum.accumulate(row - GAP * place) + GAP * place  # gaps along the passage
        begins = place.copy()
        some = row[1:] > 0
        by_pair, by_gap = some & (row[1:] == apart), some & (row[1:] == down)
        begins[1:] = np.where(by_pair, began[:-1], np.where(by_gap, began[1:], place[1:]))
        own = np.append(True, ~some | by_pair | by_gap)
        begins = begins[np.maximum.accumulate(np.where(own, place, 0))]
        j = int(row.argmax())
        score = int(row[j])
        if score > best[0] or score == best[0] > 0 and j - 1 < best[2]:
            best = (score, int(begins[j]), j - 1)
        above, began = row, begins
    return best


class Matcher:
    """Finds the items of a block in documents."""

    def __init__(self, items: list[Item], least: float):
        self.items, self.least = items, least
        self.sizes = sorted({size for item in items for _, size, _ in item.seeds})
        self.lookup = Lookup(code for item in items for _, _, code in item.seeds)
        number = {int(c): i for i, c in enumerate(self.lookup.codes)}
        where = sorted((number[code], i, at) for i, item in enumerate(items) for at, _, code in item.seeds)
        self.item, self.at = (np.array([w[k] for w in where], np.int64) for k in (1, 2))
        self.first = np.searchsorted([w[0] for w in where], np.arange(len(self.lookup.codes) + 1))
        self.slack = [item.breaks(least) + 1 for item in items]

    def run(self, data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
        """(document, item, score, first word, last word), the best alignment of each pair."""
        doc, _, _, code = words(data, ends)
        begin = np.searchsorted(doc, np.arange(len(ends)))
        pairs = defaultdict(list)
        for size in self.sizes:
            at, gram = grams(doc, code, size)
            hit, nth = self.lookup.find(gram)
            many = self.first[nth + 1] - self.first[nth]
            place = np.repeat(self.first[nth], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            word = np.repeat(at[hit], many)
            for d, i, diagonal in zip(doc[word].tolist(), self.item[place].tolist(), (word - self.at[place]).tolist()):
                pairs[d, i].append(diagonal)
        for (d, i), diagonals in pairs.items():
            item, slack = self.items[i], self.slack[i]
            best = (0, -1, -1)
            diagonals.sort()
            lo = diagonals[0]
            for x, y in zip(diagonals, [*diagonals[1:], None]):
                if y is not None and y - x <= 2 * slack + len(item.code):
                    continue
                a = max(int(begin[d]), lo - slack)
                passage = code[a : min(int(begin[d + 1]), x + len(item.code) + slack)]
                # matched words alone must reach the score
                if MATCH * np.isin(item.code, passage).sum() >= self.least * MATCH * len(item.code):
                    score, first, last = align(item.code, passage)
                    if score > best[0]:
                        best = (score, a + first - int(begin[d]), a + last - int(begin[d]))
                lo = y
            score = best[0] / (MATCH * len(item.code))
            if score >= self.least - 1e-9:
                yield d, i, score, best[1], best[2]


def matchers(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> Iterator[Matcher]:
    """One matcher for each block of test items, its seeds chosen by their counts in all of ``docs``.

    Items without words (null, empty, signs only) are held by no document.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text")
        block = [item for item in (Item(*r) for r in own.collect()) if len(item.code)]
        if not block:
            continue
        lookup = Lookup(code for item in block for _, _, code in item.candidates(least))
        sizes = sorted({size for item in block for _, size, _ in item.candidates(least)})

        def count(batches: Iterable[pa.RecordBatch], lookup=lookup, sizes=sizes) -> Iterator[pa.RecordBatch]:
            seen = np.zeros(len(lookup.codes), np.int64)
            for _, data, ends in pieces(batches, limit=1 << 20):
                doc, _, _, code = words(data, ends)
                for size in sizes:
                    seen += np.bincount(lookup.find(grams(doc, code, size)[1])[1], minlength=len(seen))
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["gram", "n"])

        counts = texts(docs).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        seen = {int(lookup.codes[r["gram"]]): r["n"] for r in counts.collect()}  # as many rows as the block has n-grams
        for item in block:
            item.choose(least, seen)
        yield Matcher(block, least)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """Pairs of a document and a test item that it holds: doc_id, item_id, score, first_word, last_word.

    One row for each pair of rows, with its best alignment; score is the share of a whole copy's points, and the
    words of the passage count from 0. Null and empty texts hold nothing, items without words are held nowhere,
    a null doc_id or item_id stays null. Repeated documents give repeated pairs; repeated items count once.
    """
    prepare(docs.sparkSession)
    schema = "doc_id long, item_id long, score double, first_word long, last_word long"
    found = None
    for matcher in matchers(docs, benchmark, least):

        def run(batches: Iterable[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for rows, data, ends in pieces(batches, limit=1 << 20):
                if hits := list(matcher.run(data, ends)):
                    ids = rows.column("doc_id").to_pylist()
                    hits = [(ids[d], matcher.items[i].item_id, *rest) for d, i, *rest in hits]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*hits), (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                        ["doc_id", "item_id", "score", "first_word", "last_word"],
                    )

        part = texts(docs).mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def without_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns; nothing is shuffled."""
    prepare(docs.sparkSession)
    kept = docs
    for matcher in matchers(docs, benchmark, least):

        def run(batches: Iterable[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for rows, data, ends in pieces(batches, limit=1 << 20):
                clean = np.ones(rows.num_rows, bool)
                clean[[d for d, *_ in matcher.run(data, ends)]] = False
                yield rows.filter(pa.array(clean))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
