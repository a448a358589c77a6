"""Conversation prefix trie by vertical bitmaps.

Conversations are dealt to shards of a bounded number, and their turns to segments of a bounded depth. A shard indexes
every (position, turn) to the bitset of its conversations that have that turn there. Depth first, a node's bitset is
intersected with the postings of its members' next turns: each intersection is a child, its popcount the members, its
lowest bit the smallest one, and the part of it that ends at this depth the end list. Nodes of the same turns in
different shards meet by a key, the XOR of 128-bit hashes of (position, turn), which also lets a segment begin
without its predecessor.

Sums over subtrees run along the paths of the leaves. Every node belongs to the smallest leaf below it, so what a
leaf owns is the lower end of its path, and the sums from there to each ancestor, over all leaves, are the subtree's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadmill.llm.common import prepare, written

# Conversations of a shard, about, and turns of a segment.
SHARD, SEGMENT = 4096, 2048
# Conversations lend their first turns to the others of their group.
GROUP, HEADS = 5, 9
# Ids of an end list that are joined to one string, at most: 2 ** this.
PIECE_BITS = 12
NODE = ["depth", "a", "b"]


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest of role and text, bytes of the text, for every turn with a conv_id.

    Turns are in the order of turn (null first), role and text. They are sorted over the whole table and counted by
    partition, so that no conversation has to fit into one task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    )
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    digest = F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text")))
    rows = written(
        rows.select("conv_id", digest.alias("digest"), F.octet_length("text").cast("long").alias("bytes"), F.monotonically_increasing_id().alias("at")),
        "turns",
    )
    part = F.shiftright("at", 33).alias("part")  # the upper bits are the partition, which sorts by conversation and turn
    starts = rows.groupBy("conv_id", part).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    rows = rows.withColumn("part", part).join(starts, ["conv_id", "part"])
    return rows.select("conv_id", (F.col("at") + F.col("shift") + 1).alias("pos"), "digest", "bytes")


def rebuilt(turns: DataFrame) -> DataFrame:
    """The turns of every conversation, with the first ``h`` taken from its group's first one (crc32(id) % 9 of them).

    Returns conv_id, pos, a and b (hashes of position and turn), bytes, last. Every conversation has a row at
    position 0 that stands for the root; it is the last one if nothing follows.
    """
    rows = written(numbered(turns), "numbered")
    convs = rows.groupBy("conv_id").agg(F.max("pos").alias("own")).checkpoint()
    donors = convs.select(F.col("conv_id").alias("donor"), F.col("own").alias("lent"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % HEADS)
    convs = convs.withColumn("donor", F.col("conv_id") - F.col("conv_id") % GROUP).join(donors, "donor", "left")
    convs = convs.withColumn("kept", F.least("h", F.coalesce("lent", F.lit(0))))
    convs = convs.withColumn("size", F.col("kept") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = convs.select("conv_id", "donor", "h", "kept", "size").checkpoint()

    last = (F.col("pos") == F.col("size")).alias("last")
    own = rows.join(convs, "conv_id").where("pos > h").withColumn("pos", F.col("kept") + F.col("pos") - F.col("h"))
    lent = rows.where(F.col("pos") < HEADS).withColumnRenamed("conv_id", "donor")
    lent = lent.join(convs, "donor").where("pos <= kept")
    root = convs.withColumns({"pos": F.lit(0).cast("long"), "digest": F.lit(b""), "bytes": F.lit(0).cast("long")})
    columns = ["conv_id", "pos", "digest", "bytes", last]
    every = own.select(*columns).unionByName(lent.select(*columns)).unionByName(root.select(*columns))
    first = F.col("pos") == 0
    a = F.when(first, F.lit(0)).otherwise(F.xxhash64("pos", "digest"))
    b = F.when(first, F.lit(0)).otherwise(F.xxhash64("digest", "pos", F.lit(1)))
    return every.select("conv_id", "pos", a.cast("long").alias("a"), b.cast("long").alias("b"), "bytes", "last")


def segment(pos: str = "pos") -> Column:
    return F.floor(F.greatest(F.col(pos) - 1, F.lit(0)) / SEGMENT).cast("int")


def _bits(members: np.ndarray) -> int:
    out = 0
    for i in members.tolist():
        out |= 1 << i
    return out


def _members(bits: int) -> list[int]:
    if bits & (bits - 1) == 0:
        return [bits.bit_length() - 1] if bits else []
    raw = np.frombuffer(bits.to_bytes(-(-bits.bit_length() // 8), "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little")).tolist()


def walker(depth_of_segment: int) -> Callable[[pa.Table], pa.Table]:
    """The nodes of a shard's conversations within one segment, depth first by intersection of bitsets."""

    def walk(rows: pa.Table) -> pa.Table:
        by = {name: rows.column(name).to_numpy() for name in ("conv_id", "pos", "a", "b", "start_a", "start_b", "bytes", "last", "seg")}
        order = np.lexsort((by["pos"], by["conv_id"]))
        by = {name: values[order] for name, values in by.items()}
        ids, head, local = np.unique(by["conv_id"], return_index=True, return_inverse=True)
        pos = by["pos"]
        # postings: (position, turn), which a and b stand for, to conversations
        turn = np.lexsort((by["b"], by["a"], pos))
        new = np.ones(len(turn), bool)
        new[1:] = (pos[turn[1:]] != pos[turn[:-1]]) | (by["a"][turn[1:]] != by["a"][turn[:-1]]) | (by["b"][turn[1:]] != by["b"][turn[:-1]])
        code = np.empty(len(turn), np.int64)
        code[turn] = np.cumsum(new) - 1
        postings = [_bits(local[own]) for own in np.split(turn, np.flatnonzero(new)[1:])]
        there: dict[int, int] = {}  # conversations with a turn at a position
        for p, bits in zip(pos[turn[new]].tolist(), postings):
            there[p] = there.get(p, 0) | bits
        ends: dict[int, int] = {}
        for p, i in zip(pos[by["last"]].tolist(), local[by["last"]].tolist()):
            ends[p] = ends.get(p, 0) | 1 << i
        names, code, shift = ids.tolist(), code.tolist(), (head - pos[head]).tolist()
        a, b, size = by["a"].tolist(), by["b"].tolist(), by["bytes"].tolist()

        out: list[tuple] = []
        base = int(by["seg"][0]) * depth_of_segment
        if base == 0:
            every = (1 << len(ids)) - 1
            out.append((0, 0, 0, None, None, every.bit_count(), names[0], 0, [names[i] for i in _members(ends.get(0, 0))]))
            stack = [(0, 0, 0, every)]
        else:
            heads: dict[tuple[int, int], int] = {}
            for i, key in enumerate(zip(by["start_a"][head].tolist(), by["start_b"][head].tolist())):
                heads[key] = heads.get(key, 0) | 1 << i
            stack = [(base, *key, bits) for key, bits in heads.items()]
        while stack:
            depth, key_a, key_b, members = stack.pop()
            depth += 1
            rest = members & there.get(depth, 0)
            while rest:
                least = (rest & -rest).bit_length() - 1
                row = shift[least] + depth
                child = members & postings[code[row]]
                rest ^= child
                key = key_a ^ a[row], key_b ^ b[row]
                ended = child & ends.get(depth, 0)
                out.append((depth, *key, key_a, key_b, child.bit_count(), names[least], size[row], [names[i] for i in _members(ended)]))
                if child != ended and depth < base + depth_of_segment:
                    stack.append((depth, *key, child))
        kinds = [pa.int64()] * 8 + [pa.list_(pa.int64())]
        columns = ["depth", "a", "b", "up_a", "up_b", "n", "conv_id", "bytes", "ends"]
        return pa.table([pa.array(values, kind) for values, kind in zip(zip(*out), kinds)], columns) if out else pa.table([pa.array([], kind) for kind in kinds], columns)

    return walk


def running(of: list[str], keys: list[str], seg: str, order: str, fold, down: bool = False) -> dict[str, Column]:
    """Windowed folds of ``of`` from a segment's first (or last) row to each row."""
    by = Window.partitionBy(*keys, seg).orderBy(F.desc(order) if down else F.asc(order))
    return {c: fold(c).over(by.rowsBetween(Window.unboundedPreceding, 0)) for c in of}


def end_lists(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's ids in order, joined by commas: strings of neighbouring ids first, then hashed one after another."""
    piece = ends.groupBy(*NODE, F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            keys = zip(*(batch.column(c).to_pylist() for c in NODE))
            for key, ids in zip(keys, batch.column("ids").to_pylist()):
                if key == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = key, hashlib.sha256(ids.encode())
            if done:
                yield shaped(done)
        if now is not None:
            yield shaped([(*now, state.hexdigest())])

    def shaped(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], [*NODE, "ends_sha256"])

    piece = piece.repartition(*NODE).sortWithinPartitions(*NODE, "piece")
    return piece.mapInArrow(run, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without a conv_id belong to no conversation and are left out. A null role or text is empty; turns of one
    number (null: the first) come in the order of role and text, repeated rows are turns of their own. The group's
    first conversation is conv_id - conv_id % 5, with the remainder's sign that of the id. No conversation, no node:
    an empty table gives no rows. Other columns are not looked at.
    """
    prepare(turns.sparkSession)
    steps = written(rebuilt(turns).withColumn("seg", segment()), "steps")
    shards = max(1, -(-steps.where("pos = 0").count() // SHARD))
    xor = [F.bit_xor("a").alias("start_a"), F.bit_xor("b").alias("start_b")]
    before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    starts = steps.groupBy("conv_id", "seg").agg(*xor)
    starts = starts.select("conv_id", "seg", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(c) for c in ("start_a", "start_b")])
    starts = starts.checkpoint()

    dealt = steps.join(starts, ["conv_id", "seg"]).withColumn("shard", F.pmod(F.xxhash64("conv_id"), F.lit(shards)).cast("int"))
    kinds = "depth long, a long, b long, up_a long, up_b long, n long, conv_id long, bytes long, ends array<long>"
    found = written(dealt.groupBy("shard", "seg").applyInArrow(walker(SEGMENT), kinds), "nodes")
    nodes = found.groupBy(*NODE).agg(
        *[F.min(c).alias(c) for c in ("up_a", "up_b", "conv_id", "bytes")], F.sum("n").alias("n_convs")
    )
    nodes = nodes.checkpoint()
    up = [(F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")]
    children = nodes.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).checkpoint()

    leaves = nodes.where("n_children = 0").select("conv_id")
    path = steps.join(leaves, "conv_id", "left_semi").join(starts, ["conv_id", "seg"])
    keys = running(["a", "b"], ["conv_id"], "seg", "pos", F.bit_xor)
    path = path.select(
        "conv_id", "seg", F.col("pos").alias("depth"), *[keys[c].bitwiseXOR(F.col(f"start_{c}")).alias(c) for c in ("a", "b")]
    ).checkpoint()
    owners = path.groupBy(*NODE).agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_leaves")).checkpoint()
    value = ((F.col("n_convs") - 1) * F.col("bytes")).alias("value")
    owned = nodes.join(owners, NODE).select(F.col("owner").alias("conv_id"), "depth", value)
    path = path.join(owned, ["conv_id", "depth"], "left").withColumn("value", F.coalesce("value", F.lit(0))).checkpoint()
    after = Window.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    later = path.groupBy("conv_id", "seg").agg(F.sum("value").alias("later"))
    later = later.select("conv_id", "seg", F.coalesce(F.sum("later").over(after), F.lit(0)).alias("later"))
    below = running(["value"], ["conv_id"], "seg", "depth", F.sum, down=True)["value"]
    path = path.withColumn("below", below).join(later, ["conv_id", "seg"])
    saved = path.groupBy(*NODE).agg(F.sum(F.col("below") + F.col("later")).alias("saved_tokens"))

    hashes = end_lists(found.select(*NODE, F.explode("ends").alias("conv_id")))
    parents = nodes.select(*[F.col(c).alias(f"of_{c}") for c in NODE], F.col("conv_id").alias("parent_conv_id"))
    is_parent = (F.col("depth") - 1 == F.col("of_depth")) & (F.col("up_a") == F.col("of_a")) & (F.col("up_b") == F.col("of_b"))
    out = nodes.join(parents, is_parent, "left").join(owners.drop("owner"), NODE).join(saved, NODE).join(hashes, NODE, "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")
    )
