"""Scores of a language model: online logistic mixing of hashed-context bit predictors.

A text is its bytes, A-Z in lower case, and one end byte (FF, which no UTF-8 text holds); a byte is eight decisions.
For each of the contexts of 0 to 5 bytes before it, a predictor looks up how often the bit was one, in a table of
slots hashed from the context and the bits of the byte so far. A gate, the longest context that was ever seen and the
bit's place, picks the weights that mix the predictors in the logistic domain, and an adaptive map, by the bits so far
and the mixed probability, corrects the result.

Everything is learnt from counts of strings of six bytes, which Spark gathers from all training documents. The
mixing weights and the map are learnt from one eighth of these documents by predictors that know only the others:
shards of strings run through online gradient steps side by side and their weights are averaged after each round. The
tables that score know all training documents. They have a fixed number of slots, so the model that is broadcast has a
fixed size; while it scores it stands still, so a text's score depends on no other text.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.llm.common import mixed, pieces, prepare, texts, written
from leadmill.llm.toxicity import remainder

# Slots of the predictors' tables, as powers of two, by the bytes of context; the first two are not hashed.
BITS = (8, 16, 20, 21, 22, 22)
ORDERS = len(BITS)
OFFSETS = np.cumsum([0] + [1 << b for b in BITS])
# One of so many training documents teaches the mixer.
FOLD = 8
ROUNDS, RATE, MINIBATCH = 3, 0.05, 2048
# Strings of a shard, about, that the mixer learns from one after another.
SHARD = 1 << 17
# A table's cell: log odds times this in a byte; UNSEEN where a slot was never met.
SCALE, UNSEEN = 16, -128
BUCKETS, PRIOR = 33, 64.0
LEAST = 2.0**-14
START = 0.3
BIAS = 0.3
# Strings that a task counts before it hands them on, and words.
PENDING, WORDS = 1 << 21, 1 << 17
# The most frequent words, which every task knows; the others' counts are joined.
HEAD = 1 << 17
# Longer words stand by a digest.
LONG = 40
END, END_WORD = 0xFF, b" "
BLOCK_BITS = 16
# Bytes of text whose strings are made at a time; they stay near the processor.
NEARBY = 1 << 18
# Places, as a power of two, of what a task remembers of the strings that it has scored.
MEMO = 21

# The log odds of a cell, by its byte; negative ones count from the end.
VALUES = np.concatenate([np.arange(128), [0], np.arange(-127, 0)]).astype(np.float32) / SCALE

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def strings(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of several documents and each end: the document, and the byte with the five before it as one number."""
    sizes = np.diff(ends)
    gap = ORDERS
    doc = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(data)) + gap * doc + ORDERS - 1
    out = np.zeros(len(data) + gap * len(sizes) + 1, np.uint8)
    out[at] = _LOWER[data]
    last = ends[1:] + gap * np.arange(len(sizes)) + ORDERS - 1
    out[last] = END
    at = np.concatenate([at, last])
    doc = np.concatenate([doc, np.arange(len(sizes))])
    one = out.astype(np.uint64)
    two = one.copy()  # strings of two, then four and six bytes
    two[1:] |= one[:-1] << np.uint64(8)
    gram = two.copy()
    gram[2:] |= two[:-2] << np.uint64(16)
    gram[4:] |= two[:-4] << np.uint64(32)
    return doc, gram[at]


def contexts(gram: np.ndarray) -> list[np.ndarray]:
    """A hash of the bytes before the last one, for every predictor."""
    out = []
    for k in range(ORDERS):
        before = (gram >> np.uint64(8)) & np.uint64((1 << 8 * k) - 1)
        out.append(before << np.uint64(8) if k < 2 else mixed(before + np.uint64(k << 56)))
    return out


def slots(context: np.ndarray, k: int, node: np.ndarray) -> np.ndarray:
    """Where the predictor of ``k`` bytes keeps the bit after ``node`` (a one and the bits of the byte so far)."""
    if k < 2:
        return OFFSETS[k] + (context | node).astype(np.int64)
    spread = (context + node * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
    return OFFSETS[k] + (spread >> np.uint64(64 - BITS[k])).astype(np.int64)


def decisions(gram: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Place, bits so far and bit of the eight decisions on the last byte."""
    byte = gram & np.uint64(255)
    for i in range(8):
        yield i, (np.uint64(1 << i) | (byte >> np.uint64(8 - i))), ((byte >> np.uint64(7 - i)) & np.uint64(1)).astype(np.int64)


@dataclass
class Mixer:
    """Predictors' tables, weights by gate (longest context and place), and the adaptive map by bits so far and bucket."""

    table: np.ndarray
    weights: np.ndarray
    map: np.ndarray

    @classmethod
    def new(cls, table: np.ndarray) -> Mixer:
        weights = np.full((ORDERS * 8, ORDERS + 1), START)
        weights[:, -1] = 0
        return cls(table, weights, np.repeat(_edges()[None, :], 256, 0))

    def inputs(self, context: list[np.ndarray], i: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.full((len(node), ORDERS + 1), BIAS, np.float32)
        longest = np.zeros(len(node), np.int64)
        for k in range(ORDERS):
            cell = self.table[slots(context[k], k, node)]
            seen = cell != UNSEEN
            x[:, k] = VALUES[cell]
            longest[seen] = k
        return x, longest * 8 + i

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.clip(np.einsum("ni,ni->n", x, self.weights[gate]), -9.5, 9.5)

    def refined(self, node: np.ndarray, odds: np.ndarray) -> np.ndarray:
        """Probability of a one: the mean, in log odds, of the mixed one and of what the map has learnt of it."""
        bucket, share = _bucket(odds)
        node = node.astype(np.int64)
        learnt = self.map[node, bucket] * (1 - share) + self.map[node, bucket + 1] * share
        return np.clip(1 / (1 + np.exp(-(odds + learnt) / 2)), LEAST, 1 - LEAST)

    def log10(self, gram: np.ndarray) -> np.ndarray:
        """Log of the last byte's probability after the five before it."""
        context, out = contexts(gram), np.zeros(len(gram))
        for i, node, bit in decisions(gram):
            x, gate = self.inputs(context, i, node)
            p = self.refined(node, self.mixed(x, gate))
            out += np.log10(np.where(bit == 1, p, 1 - p))
        return out

    def learn(self, gram: np.ndarray, n: np.ndarray) -> None:
        """One online pass over strings that stand ``n`` times: after each decision of a minibatch the gates take a step."""
        for at in range(0, len(gram), MINIBATCH):
            own, mass = gram[at : at + MINIBATCH], n[at : at + MINIBATCH].astype(float)
            context = contexts(own)
            for i, node, bit in decisions(own):
                x, gate = self.inputs(context, i, node)
                miss = bit - 1 / (1 + np.exp(-self.mixed(x, gate)))
                step, of = np.zeros_like(self.weights), np.bincount(gate, mass, minlength=len(self.weights))
                np.add.at(step, gate, (mass * miss)[:, None] * x)
                self.weights += RATE * step / np.maximum(of, 1)[:, None]


def _edges() -> np.ndarray:
    return np.linspace(-10, 10, BUCKETS)


def _bucket(odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = (odds + 10) * (BUCKETS - 1) / 20
    low = np.minimum(at.astype(np.int64), BUCKETS - 2)
    return low, at - low


def string_counts(train: DataFrame) -> DataFrame:
    """gram, n and m: how often each string of six bytes stands in the documents, and in the mixer's share of them."""

    def flushed(parts: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        names, n = np.concatenate(parts), np.concatenate(counts)
        order = np.argsort(names)
        names, n = names[order], n[order]
        first = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
        return names[first], np.add.reduceat(n, first)

    def shaped(names: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        gram, m = (names >> np.uint64(1)).astype(np.int64), n * (names & np.uint64(1)).astype(np.int64)
        first = np.flatnonzero(np.diff(gram, prepend=-1))
        if len(first):
            gram, n, m = gram[first], np.add.reduceat(n, first), np.add.reduceat(m, first)
        for lo in range(0, len(gram), 1 << 16):
            own = slice(lo, lo + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(gram[own]), pa.array(n[own]), pa.array(m[own])], ["gram", "n", "m"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, counts, size, fresh, waiting = [], [], 0, [], 0
        for rows, data, ends in pieces(batches, limit=NEARBY):
            doc, gram = strings(data, ends)
            fold = rows.column("fold").to_numpy(zero_copy_only=False).astype(np.uint64)
            fresh.append(gram << np.uint64(1) | fold[doc])
            waiting += len(gram)
            if waiting < PENDING:
                continue
            names, n = np.unique(np.concatenate(fresh), return_counts=True)
            parts, counts, size, fresh, waiting = [*parts, names], [*counts, n], size + len(names), [], 0
            if size > PENDING:
                parts, counts = ([x] for x in flushed(parts, counts))
                size = len(parts[0])
                if size > PENDING // 2:
                    yield from shaped(parts[0], counts[0])
                    parts, counts, size = [], [], 0
        if fresh:
            names, n = np.unique(np.concatenate(fresh), return_counts=True)
            parts, counts = [*parts, names], [*counts, n]
        if parts:
            yield from shaped(*flushed(parts, counts))

    fold = (F.pmod(F.xxhash64("doc_id"), F.lit(FOLD)) == 0).cast("int").alias("fold")
    found = train.select("text", fold).mapInArrow(run, "gram long, n long, m long")
    return found.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def tabled(counts: DataFrame) -> np.ndarray:
    """The predictors' tables from (gram, n): counted in tasks, summed and packed on executors; a byte a slot comes here."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = np.zeros((2, int(OFFSETS[-1])), np.int64)
        for batch in batches:
            gram, n = batch.column("gram").to_numpy().astype(np.uint64), batch.column("n").to_numpy()
            context = contexts(gram)
            for _, node, bit in decisions(gram):
                for k in range(ORDERS):
                    np.add.at(made, (bit, slots(context[k], k, node)), n)
        at = np.flatnonzero(made[0] | made[1])
        for lo in range(0, len(at), 1 << 16):
            own = at[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(made[0][own]), pa.array(made[1][own])], ["slot", "zeros", "ones"])

    def pack(rows: pa.Table) -> pa.Table:
        slot = rows.column("slot").to_numpy()
        odds = np.log((rows.column("ones").to_numpy() + 0.4) / (rows.column("zeros").to_numpy() + 0.4))
        out = np.full(1 << BLOCK_BITS, UNSEEN, np.int8)
        out[slot & ((1 << BLOCK_BITS) - 1)] = np.clip(np.round(odds * SCALE), -127, 127)
        return pa.table({"block": pa.array([int(slot[0]) >> BLOCK_BITS]), "cells": pa.array([out.tobytes()], pa.binary())})

    found = counts.mapInArrow(run, "slot long, zeros long, ones long")
    found = found.groupBy("slot").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    packed = found.groupBy(F.shiftright("slot", BLOCK_BITS).alias("block")).applyInArrow(pack, "block long, cells binary")
    table = np.full(-(-int(OFFSETS[-1]) >> BLOCK_BITS << BLOCK_BITS) + (1 << BLOCK_BITS), UNSEEN, np.int8)
    for row in packed.toLocalIterator():
        table[row["block"] << BLOCK_BITS : (row["block"] + 1) << BLOCK_BITS] = np.frombuffer(row["cells"], np.int8)
    return table[: int(OFFSETS[-1])]


def _shard(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    gram, n = rows.column("gram").to_numpy().astype(np.uint64), rows.column("m").to_numpy()
    order = np.argsort(mixed(gram.copy()))
    return gram[order], n[order]


def fit(train: DataFrame) -> Mixer:
    """Learn from all rows of ``train`` (doc_id, text); without any, every bit is as likely as not."""
    spark = prepare(train.sparkSession)
    counts = written(string_counts(train), "strings")
    teach = counts.where("m > 0")
    shards = max(1, -(-teach.count() // SHARD))
    teach = written(teach.select("gram", "m", F.pmod(F.xxhash64("gram"), F.lit(shards)).alias("shard")), "teach")
    mixer = Mixer.new(tabled(counts.where("n > m").select("gram", (F.col("n") - F.col("m")).alias("n"))))
    table = spark.sparkContext.broadcast(mixer.table)

    for _ in range(ROUNDS):
        before = mixer.weights

        def step(rows: pa.Table) -> pa.Table:
            own = Mixer(table.value, before.copy(), mapped)
            gram, n = _shard(rows)
            own.learn(gram, n)
            gate, at = np.indices(own.weights.shape)
            return pa.table({"gate": gate.ravel(), "at": at.ravel(), "w": own.weights.ravel() * n.sum(), "n": np.full(gate.size, n.sum())})

        mapped = mixer.map
        learnt = teach.groupBy("shard").applyInArrow(step, "gate long, at long, w double, n long")
        after = before.copy()
        for row in learnt.groupBy("gate", "at").agg((F.sum("w") / F.sum("n")).alias("w")).collect():  # one row a weight
            after[row["gate"], row["at"]] = row["w"]
        mixer.weights = after

    final = mixer.weights

    def refine(rows: pa.Table) -> pa.Table:
        own = Mixer(table.value, final, mixer_map)
        gram, n = _shard(rows)
        total, ones = np.zeros((256, BUCKETS)), np.zeros((256, BUCKETS))
        for at in range(0, len(gram), 1 << 14):
            some, mass = gram[at : at + (1 << 14)], n[at : at + (1 << 14)].astype(float)
            context = contexts(some)
            for i, node, bit in decisions(some):
                odds = own.mixed(*own.inputs(context, i, node))
                bucket, share = _bucket(odds)
                for to, part in ((bucket, 1 - share), (bucket + 1, share)):
                    np.add.at(total, (node.astype(np.int64), to), mass * part)
                    np.add.at(ones, (node.astype(np.int64), to), mass * part * bit)
        node, bucket = np.nonzero(total)
        return pa.table({"node": node, "bucket": bucket, "total": total[node, bucket], "ones": ones[node, bucket]})

    mixer_map = mixer.map
    sums = teach.groupBy("shard").applyInArrow(refine, "node long, bucket long, total double, ones double")
    plain = 1 / (1 + np.exp(-_edges()))
    learnt = mixer.map.copy()
    for row in sums.groupBy("node", "bucket").agg(F.sum("total").alias("total"), F.sum("ones").alias("ones")).collect():  # one row a cell
        p = (row["ones"] + PRIOR * plain[row["bucket"]]) / (row["total"] + PRIOR)
        learnt[row["node"], row["bucket"]] = math.log(p / (1 - p))
    table.unpersist()
    return Mixer(tabled(counts.select("gram", "n")), final, learnt)


def scorer(mixer: Mixer) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Log probabilities of texts; what a string of six bytes gives is remembered for the next texts."""
    known = np.full(1 << MEMO, (1 << 64) - 1, np.uint64)
    value = np.zeros(1 << MEMO, np.float32)
    shift = np.uint64(64 - MEMO)

    def score(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        doc, gram = strings(data, ends)
        at = (gram * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64)
        hit = known[at] == gram
        out = value[at].astype(np.float64)
        new = np.flatnonzero(~hit)
        names = np.unique(gram[new])
        made = np.concatenate([mixer.log10(names[lo : lo + (1 << 15)]) for lo in range(0, len(names), 1 << 15)] or [np.zeros(0)])
        out[new] = made[np.searchsorted(names, gram[new])]
        spot = (names * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64)
        known[spot] = names
        stays = known[spot] == names  # of strings that share a place the last one
        value[spot[stays]] = made[stays]
        return np.bincount(doc, out, minlength=len(ends) - 1)

    return score


def word(token: bytes) -> bytes:
    """What a word is known by: itself, or a digest with a space before it, which no word has."""
    return token if len(token) <= LONG else b" " + hashlib.sha256(token).digest()


def tokens(text: bytes) -> Counter:
    """How often each word stands in a text, A-Z in lower case."""
    text, out, at = text.lower(), Counter(), 0
    while at < len(text):
        to = at + (1 << 20)
        while to < len(text) and text[to] not in b" \t\n\v\f\r":
            to += 1
        out.update(text[at:to].split())
        at = to
    return out


def word_counts(train: DataFrame) -> DataFrame:
    """word and c: how often each word stands in the documents; an end for each of them."""

    def shaped(counts: Counter) -> pa.RecordBatch:
        words = [word(token) for token in counts]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for rows, data, ends in pieces(batches):
            raw = data.tobytes()
            counts.update(tokens(b" ".join(raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()))))
            counts[END_WORD] += rows.num_rows
            if len(counts) > WORDS:
                yield shaped(counts)
                counts = Counter()
        if counts:
            yield shaped(counts)

    return train.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def held_out(column: Column | str = "doc_id") -> Column:
    return F.coalesce(remainder(7, column) == 2, F.lit(False))


def language_scores(docs: DataFrame, train: Column | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the text's probability).

    Documents where ``train`` (a column over doc_id) is true are learnt from, by default those whose id's checksum
    does not hold them out; a row without an id teaches nothing and is not held out. A null text is empty; it has one
    token, the end. Repeated rows teach as often as they come, and each gets its scores. Without training documents
    base_score is 0 and every bit of a text is as likely as not. Other columns are not looked at.
    """
    spark = prepare(docs.sparkSession)
    own = texts(docs)
    chosen = own.where(F.coalesce(remainder(7) != 2, F.lit(False)) if train is None else train)
    mixer = spark.sparkContext.broadcast(fit(chosen))
    counts = written(word_counts(chosen), "words")
    all_tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    head = counts.orderBy(F.desc("c"), "word").limit(HEAD).toArrow()  # of a fixed length
    known = spark.sparkContext.broadcast(dict(zip(head.column("word").to_pylist(), head.column("c").to_pylist())))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(mixer.value)
        log_of = {w: math.log10(c + 1) for w, c in known.value.items()}
        end = log_of.get(END_WORD, 0.0)
        for rows, data, ends in pieces(batches, limit=NEARBY):
            raw = data.tobytes()
            out = []
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                counts = tokens(raw[a:b])
                found, logs, rest = int(END_WORD in log_of), end, []
                for token, times in counts.items():
                    log = log_of.get(token)
                    if log is None and len(token) > LONG:
                        token = word(token)
                        log = log_of.get(token)
                    if log is None:
                        rest.append({"word": token, "n": times})
                    else:
                        found += times
                        logs += times * log
                out.append((counts.total() + 1, found, logs, rest))
            n, found, logs, rest = zip(*out)
            rest = pa.array(rest, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(n), pa.array(found), pa.array(logs), pa.array(score(data, ends)), rest],
                ["doc_id", "n_tokens", "n_known", "logs", "score", "rest"],
            )

    made = own.mapInArrow(run, "doc_id long, n_tokens long, n_known long, logs double, score double, rest array<struct<word:binary,n:long>>")
    made = written(made.withColumn("row", F.monotonically_increasing_id()), "scored")
    # words that no training document has add nothing
    rare = made.select("row", F.explode("rest").alias("rest")).select("row", "rest.word", "rest.n").join(counts, "word")
    rare = rare.groupBy("row").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_logs"))
    out = made.drop("rest").join(rare, "row", "left")
    floor = math.log10(all_tokens + distinct + 1)
    return out.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        "score",
    )
