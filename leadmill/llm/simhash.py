"""SimHash near-duplicates: fingerprints dealt to shards by vantage-point trees, exact links, components.

Two fingerprints of 64 bits that differ in at most ``max_bits`` bits differ in at most ``max_bits // 2`` bits in
one half at least. Each half has a vantage-point tree over the Hamming distance within that half. Its top, fitted
on a bounded sample, deals the fingerprints to shards; a fingerprint whose ball crosses a boundary goes to both
sides, so every linked pair meets in a shard. Inside a shard the tree goes on until small leaves are compared
exactly over all 64 bits. A shard returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.llm.common import components, pieces, prepare, texts

SEED = 42
SHINGLE = 3
# Fingerprints that the trees are fitted on, and how many of all a shard should own. The sample bounds the depth.
SAMPLE = 32_768
PER_SHARD = 16_384
LEAF = 768
HALVES = (np.uint64(0xFFFFFFFF00000000), np.uint64(0x00000000FFFFFFFF))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles: a bit is set if it is set in over half of their hashes. No words: zero."""
    words = text.lower().split()  # A-Z only, and exactly the bytes 09-0D and 20 between words
    if not words:
        return 0
    whole = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends[: n - 1]]
    ends = [e - 1 for e in ends[min(shingle, len(words)) - 1 :]]
    digest = xxhash.xxh64_digest
    bits = np.frombuffer(b"".join([digest(whole[a:b], SEED) for a, b in zip(starts, ends)]), np.uint8)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        ones += np.unpackbits(bits[at * 8 : (at + 4096) * 8].reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, the fingerprint of its whole text as a signed long, and a hash of the text, for every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, ends in pieces(batches):
            raw = data.tobytes()
            prints = [fingerprint(raw[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(prints, pa.int64()), rows.column("code")], ["doc_id", "fp", "code"])

    return texts(docs, code_of_text()).mapInArrow(run, "doc_id long, fp long, code long")


def code_of_text() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("code")


def away(points: np.ndarray, vantage: np.uint64, half: int) -> np.ndarray:
    return np.bitwise_count((points ^ vantage) & HALVES[half])


def grow(sample: np.ndarray, half: int, depth: int, least: int = 16) -> list:
    """Top of a vantage-point tree: [vantage, radius, inside, outside], or a shard number."""
    shards = 0
    rng = np.random.default_rng(7)

    def node(points: np.ndarray, level: int):
        nonlocal shards
        if level and len(points) >= 2 * least:
            vantage = points[rng.integers(len(points))]
            far = away(points, vantage, half)
            radius = int(np.median(far))
            inside = far <= radius
            if inside.any() and not inside.all():
                return [int(vantage), radius, node(points[inside], level - 1), node(points[~inside], level - 1)]
        shards += 1
        return shards - 1

    return node(sample, depth)


def deal(tree, points: np.ndarray, half: int, slack: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, positions) of the points whose ball of radius ``slack`` reaches into the shard."""

    def down(node, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        if isinstance(node, int):
            yield node, at
            return
        far = away(points[at], np.uint64(node[0]), half).astype(np.int64)
        yield from down(node[2], at[far <= node[1] + slack])
        yield from down(node[3], at[far > node[1] - slack])

    yield from down(tree, np.arange(len(points)))


def forest(points: np.ndarray, half: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (point, other point) that connect what is connected among the points of a shard.

    The tree goes on: points within the boundary zone stay on the inside as well, so every pair within
    ``max_bits`` whose half differs in ``max_bits // 2`` bits meets in a leaf.
    """
    slack = max_bits // 2
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    todo = [points]
    rng = np.random.default_rng(7)
    while todo:
        own = todo.pop()
        if len(own) > LEAF:
            best = None
            for vantage in own[rng.integers(len(own), size=4)]:
                far = away(own, vantage, half).astype(np.int64)
                radius = int(np.median(far))
                cost = int((far <= radius + slack).sum()) ** 2 + int((far > radius).sum()) ** 2
                if best is None or cost < best[0]:
                    best = (cost, far, radius)
            _, far, radius = best
            inner, outer = own[far <= radius + slack], own[far > radius]
            if max(len(inner), len(outer)) < 0.95 * len(own):
                todo += [inner, outer]
                continue
        _leaf(own, max_bits, a, b)
    none = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _leaf(own: np.ndarray, max_bits: int, a: list, b: list) -> None:
    """Walk the graph; a point that was reached leaves the pool, so a dense group costs no more than its size."""
    if len(own) <= 2048:
        near = np.bitwise_count(own[:, None] ^ own[None, :]) <= max_bits
        linked = near.sum(axis=1) > 1
        own = own[linked]
    pool = own
    while len(pool) > 1:
        root, pool = pool[0], pool[1:]
        front = [root]
        while front and len(pool):
            hit = np.bitwise_count(pool ^ front.pop()) <= max_bits
            if hit.any():
                new, pool = pool[hit], pool[~hit]
                a.append(new)
                b.append(np.full(len(new), root))
                front.extend(new)


def links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Edges (a, b) over distinct fingerprints (column fp) that connect all that lie within ``max_bits`` bits."""
    spark = prepare(prints.sparkSession)
    total = prints.count()
    order = F.xxhash64("fp")
    sample = np.array([r[0] for r in prints.orderBy(order).limit(SAMPLE).select("fp").collect()], np.int64)
    depth = max(0, int(np.ceil(np.log2(max(1, total) / PER_SHARD))))
    trees = [grow(sample.view(np.uint64), half, depth) for half in (0, 1)]
    slack = max_bits // 2

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.asarray(batch.column("fp").to_numpy(zero_copy_only=False), np.int64)
            for half in (0, 1):
                for shard, at in deal(trees[half], fp.view(np.uint64), half, slack):
                    key = np.full(len(at), 2 * shard + half, np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[at])], ["shard", "fp"])

    def link(shard: pa.Table) -> pa.Table:
        half = shard.column("shard")[0].as_py() % 2
        a, b = forest(shard.column("fp").to_numpy().view(np.uint64), half, max_bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    routed = prints.select("fp").mapInArrow(route, "shard int, fp long")
    return routed.groupBy("shard").applyInArrow(link, "a long, b long")


def simhash_groups(docs: DataFrame, max_bits: int = 3) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links).

    Texts that are null, empty or blank have fingerprint zero and link like any other. A null doc_id keeps its
    row and is never a component_id unless its group has no other id (then null). Repeated rows come out as often
    as they go in. An empty table gives no rows; other columns of ``docs`` are not looked at.
    """
    prepare(docs.sparkSession)
    prints = fingerprints(docs).checkpoint()
    roots = linked_prints(prints, max_bits)
    least = roots.groupBy("root").agg(F.min("first").alias("component_id")).checkpoint()
    by_print = roots.join(least, "root").select("fp", "component_id").checkpoint()
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def linked_prints(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Of (doc_id, fp): each fingerprint with its smallest doc_id and the fingerprint that names its component."""
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first")).checkpoint()
    roots = components(links(classes, max_bits).checkpoint())
    roots = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return roots.select("fp", "first", F.coalesce("root", "fp").alias("root")).checkpoint()


def one_per_group(docs: DataFrame, max_bits: int = 3) -> DataFrame:
    """One row of each near-duplicate group: that with the smallest doc_id, then with the smallest hash of its text.

    A row without a doc_id stays only if none of its group has one. Of rows with one doc_id and one text that differ
    in other columns, that with the smallest hash of all columns stays.
    """
    prepare(docs.sparkSession)
    prints = fingerprints(docs).checkpoint()
    # a group's rows are few kinds of (doc_id, text): the first of each fingerprint, then the first of each component
    first = F.min(F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "code")).alias("row")
    by_print = prints.groupBy("fp").agg(first)
    rows = linked_prints(prints, max_bits).select("fp", "root").join(by_print, "fp")
    keep = rows.groupBy("root").agg(F.min("row").alias("row")).select(F.col("row.doc_id").alias("of_id"), F.col("row.code").alias("of_code"))
    own = [F.col(f"`{c}`") for c in docs.columns]
    coded = docs.select(F.struct(*own).alias("row"), F.xxhash64(*own).alias("nth"), "doc_id", code_of_text())
    kept = coded.join(keep, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("code") == F.col("of_code")), "left_semi")
    return kept.groupBy("doc_id", "code").agg(F.min_by("row", "nth").alias("row")).select("row.*")
