"""Sharding by a hierarchical weighted hash tree of regions, racks and shards.

A row's key draws a number at every child of a node: the logarithm of a hash from 0 to 1, divided by the child's
weight. The highest draw wins, and the descent goes on below it. A child whose weight rises only wins keys, so a
change moves rows only inside the subtrees whose weights change. All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadmill.llm.common import prepare

SHARDS = 16
# Rows that are numbered in one go, about.
PER_GROUP = 50_000

# A tree: the name of each child, and its weight (a leaf, named by its shard) or its subtree.
Tree = dict[str, "float | Tree"]


def weight(tree: float | Tree) -> float:
    return tree if isinstance(tree, (int, float)) else sum(map(weight, tree.values()))


def plain_tree(shards: int = SHARDS, racks: int = 2, per_rack: int = 2) -> Tree:
    """Regions of ``racks`` racks of ``per_rack`` shards of weight one, filled in order.

    A shard that does not fit into the full regions opens a new one, so it takes rows only into itself; the next
    ones share that region.
    """
    tree: Tree = {}
    for shard in range(shards):
        rack, region = shard // per_rack, shard // per_rack // racks
        tree.setdefault(f"region{region}", {}).setdefault(f"rack{rack}", {})[str(shard)] = 1.0
    return tree


def draw(key: Column, path: str, of: float) -> Column:
    """A key's draw at a node: log of the first 52 bits of an md5, from 0 (left out) to 1, by weight."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(path + "|"), key)), 1, 13), 16, 10).cast("double")
    return F.log((bits + 1) / F.lit(float(1 << 52))) / F.lit(of)


def shard_of(key: Column, tree: Tree, path: str = "") -> Column:
    """The shard that a key (a string) descends to."""
    children = sorted(tree.items())
    best = F.array_max(
        F.array(*[F.struct(draw(key, f"{path}/{name}", weight(child)).alias("draw"), F.lit(name).alias("name")) for name, child in children])
    )["name"]
    if all(isinstance(child, (int, float)) for _, child in children):
        return best.cast("int")
    out = None
    for name, child in children:
        below = F.lit(int(name)) if isinstance(child, (int, float)) else shard_of(key, child, f"{path}/{name}")
        out = F.when(best == name, below) if out is None else out.when(best == name, below)
    return out


def place(docs: DataFrame, tree: Tree | None = None, grown: Tree | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus one (null: one), the checksum of a null text is that of an empty one. Rows
    with one doc_id share a shard, those without an id do too (their key is empty). slot counts a shard's rows from
    0 in the order of a hash of doc_id (without one: of size and checksum), then doc_id, size and checksum; repeated
    rows get a slot each. grown_shard is
    the shard in the tree ``grown``, by default one with one more shard. Other columns are not looked at.
    """
    prepare(docs.sparkSession)
    tree = plain_tree() if tree is None else tree
    grown = plain_tree(SHARDS + 1) if grown is None else grown
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    parts = max(64, -(-docs.count() // (SHARDS * PER_GROUP)))
    size, checksum = (F.octet_length(text) + 1).cast("long"), F.crc32(text)
    # rows without an id have one key; their texts deal them out
    order = F.md5(F.when(F.col("doc_id").isNull(), F.concat_ws("|", F.lit(""), size, checksum)).otherwise(key))
    part = F.floor(F.conv(F.substring(order, 1, 8), 16, 10).cast("long") * parts / (1 << 32)).cast("int")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        size.alias("size"),
        checksum.alias("text_crc32"),
        shard_of(key, tree).alias("shard"),
        shard_of(key, grown).alias("grown_shard"),
        order.alias("order"),
        part.alias("part"),
    )
    counts = docs.select(shard_of(key, tree).alias("shard"), part.alias("part")).groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "part").orderBy("order", "doc_id", "size", "text_crc32")
    numbered = rows.withColumn("nth", F.row_number().over(within) - 1).join(starts, ["shard", "part"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("nth")).alias("slot"), "grown_shard"
    )
