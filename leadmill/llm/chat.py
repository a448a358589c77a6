"""Preference formatting: what chosen and rejected conversations share goes into the prompt, once.

A pair's conversations share the turns before the first one that differs (in role or text, or that only one side
has). Everything is joins and combinable aggregations over single turns: no conversation is gathered in one place,
so a conversation of any length is as good as a short one. ``examples`` puts the parts of a pair into one row for
those who want that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The chat mark-up's tokens.
BEGIN, END = "<|im_start|>", "<|im_end|>"
CHOSEN, REJECTED = 1, 2
LAST_TURN = (1 << 63) - 1


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(BEGIN), role, F.lit("\n"), text, F.lit(END + "\n"))


def preference_turns(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """The parts of each pair, turn by turn, from turns (pair_id, turn, role, text) of both sides.

    Returns pair_id, part (prompt, chosen or rejected), turn, role, rendered, loss. A turn of the prompt comes once;
    loss is 1 for the assistant's turns of a completion, which are learnt, and 0 for everything that is masked. A
    null turn counts as the last one, a null role as user, a null text as empty. Repeated rows count once; different
    rows of one turn belong together. A pair with one side has an empty prompt. Rows without a pair_id belong to no
    pair and are left out.
    """

    def side(turns: DataFrame, mark: int) -> DataFrame:
        return turns.where("pair_id IS NOT NULL").select(
            F.col("pair_id").cast("long").alias("pair_id"),
            F.coalesce(F.col("turn").cast("long"), F.lit(LAST_TURN)).alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
            F.lit(mark).alias("side"),
        )

    both = side(chosen, CHOSEN).unionByName(side(rejected, REJECTED))
    turns = both.groupBy("pair_id", "turn", "role", "text").agg(F.bit_or("side").alias("sides")).checkpoint()
    apart = turns.groupBy("pair_id").agg(F.min(F.when(F.col("sides") < 3, F.col("turn"))).alias("split")).checkpoint()
    parts = turns.join(apart, "pair_id")
    shared = F.col("split").isNull() | (F.col("turn") < F.col("split"))
    names = F.when(shared, F.array(F.lit("prompt"))).otherwise(
        F.filter(
            F.array(F.when(F.col("sides") != REJECTED, F.lit("chosen")), F.when(F.col("sides") != CHOSEN, F.lit("rejected"))),
            lambda x: x.isNotNull(),
        )
    )
    parts = parts.select("pair_id", F.explode(names).alias("part"), "turn", "role", rendered(F.col("role"), F.col("text")).alias("rendered"))
    return parts.withColumn("loss", ((F.col("part") != "prompt") & (F.col("role") == "assistant")).cast("int"))


def examples(parts: DataFrame) -> DataFrame:
    """One row per pair: prompt, chosen, rejected, and the masks of both completions as [first, last) character spans to learn.

    A pair's parts are gathered, so a pair must fit into a row.
    """
    turn = F.struct("turn", "role", "rendered", "loss")
    gathered = parts.groupBy("pair_id").agg(
        *[F.sort_array(F.collect_list(F.when(F.col("part") == part, turn))).alias(part) for part in ("prompt", "chosen", "rejected")]
    )

    def text(part: str) -> Column:
        return F.array_join(F.col(part)["rendered"], "")

    def mask(part: str) -> Column:
        at = F.aggregate(
            F.col(part),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,last:int>>").alias("spans")),
            lambda acc, x: F.struct(
                (acc["at"] + F.length(x["rendered"])).alias("at"),
                F.when(
                    x["loss"] == 1,
                    F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("first"), (acc["at"] + F.length(x["rendered"])).alias("last")))),
                )
                .otherwise(acc["spans"])
                .alias("spans"),
            ),
        )
        return at["spans"]

    return gathered.select(
        "pair_id",
        text("prompt").alias("prompt"),
        text("chosen").alias("chosen"),
        mask("chosen").alias("chosen_spans"),
        text("rejected").alias("rejected"),
        mask("rejected").alias("rejected_spans"),
    )


def neighbours(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations 2k and 2k + 1 as the chosen and the rejected side of pair k."""
    own = conversations.select(F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"), F.pmod("conv_id", F.lit(2)).alias("odd"), "turn", "role", "text")
    return own.where("odd = 0").drop("odd"), own.where("odd = 1").drop("odd")
