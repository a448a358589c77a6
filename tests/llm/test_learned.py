"""Toxicity and quality: held-out accuracy, and what happens at the edges."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadmill.llm import quality, toxicity
from leadmill.llm.common import table, texts

SF = "/root/testdata/sf0.1"
CLEAN = [f"word{i}" for i in range(200)]


def corpus(n=500):
    rng = random.Random(6)
    for i in range(n):
        body, toxic = [rng.choice(CLEAN) for _ in range(rng.randint(5, 80))], int(i % 4 == 0)
        for _ in range(2 * toxic):
            body.insert(rng.randrange(len(body)), rng.choice(["vile", "awful"]))
        yield i, " ".join(body), toxic


def frames(spark, n=500):
    rows = list(corpus(n))
    docs = spark.createDataFrame([(i, t, 1, 0.5) for i, t, _ in rows] + [(None, "vile vile", 1, 0.5), (900, None, 1, 0.5), (901, "", 1, 0.5), (0, rows[0][1], 1, 0.5)], "doc_id long, text string, label int, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3] + [(None, 1), (5, None), (7, 3), (5000, 1)], "doc_id long, label int")
    return docs, labels


def test_ftrl_learns_what_marks_the_labels(spark):
    docs, labels = frames(spark)
    model = toxicity.fit(docs, labels)
    assert 0 < len(model.places) < 2000
    got = [(r["doc_id"], r["score"]) for r in toxicity.score(docs, model).collect()]
    toxic = {i for i, _, y in corpus() if y}
    assert len(got) == docs.count()
    for doc_id, score in got:
        assert 0 <= score <= 1
        if doc_id is not None:
            assert (score >= toxicity.CUT) == (doc_id in toxic)
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {900, 901, *(i for i, _, y in corpus() if not y)}


def test_one_step_is_the_formula():
    z, n = np.zeros(4), np.zeros(4)
    toxicity.learn([(np.array([1]), 1)], z, n)
    assert z.tolist() == [0, -0.5, 0, -0.5] and n.tolist() == [0, 0.25, 0, 0.25]
    assert toxicity.weights(np.array([-toxicity.L1, -toxicity.L1 - 1]), np.array([1.0, 1.0])).tolist() == [0, pytest.approx(1 / ((toxicity.BETA + 1) / toxicity.ALPHA + toxicity.L2))]


@pytest.mark.parametrize("direct", [4, 1])
def test_evidence_is_gathered_over_shards_and_rounds(spark, monkeypatch, direct):
    """Words that mark a few toxic documents of one shard, or two of every shard, weigh what plain averaging gives."""
    monkeypatch.setattr(toxicity, "SHARD", 150)
    monkeypatch.setattr(toxicity, "DIRECT", direct, raising=False)
    ids = spark.range(600).select("id", F.xxhash64("id").alias("order"), F.expr("pmod(xxhash64(id), 4)").alias("shard"))
    ids = sorted((r["order"], r["id"], r["shard"]) for r in ids.collect())
    rng, rows, seen = random.Random(4), [], [0] * 4
    for order, i, shard in ids:
        body = [rng.choice(CLEAN) for _ in range(20)]
        toxic, seen[shard] = int(seen[shard] < 7), seen[shard] + 1
        if toxic:
            body.insert(3, "everywhere" if seen[shard] <= 2 else "oneshard" if shard == 2 else "common")
        rows.append((i, " ".join(body), toxic, shard))
    docs = spark.createDataFrame([(i, t) for i, t, *_ in rows], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, y) for i, _, y, _ in rows], "doc_id long, label int"))

    def places(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        return np.unique(toxicity.features(raw, np.array([0, len(raw)]))[1])

    size = (1 << toxicity.BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    for _ in range(toxicity.ROUNDS):
        states = [(z.copy(), n.copy()) for _ in range(4)]
        for k, state in enumerate(states):
            toxicity.learn([(places(t), y) for _, t, y, shard in rows if shard == k], *state)
        z, n = np.mean([s[0] for s in states], axis=0), np.mean([s[1] for s in states], axis=0)
    want = toxicity.weights(z, n)
    assert model.places.tolist() == np.flatnonzero(want[:-1]).tolist()
    assert model.weights == pytest.approx(want[model.places], rel=1e-5)
    assert model.bias == pytest.approx(want[-1])
    assert want[places("everywhere")[0]] > 0


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_nothing_to_learn_from(spark, operator):
    docs, labels = frames(spark, 8)
    model = operator.fit(docs, labels.limit(0))
    assert {r["score"] for r in operator.score(docs, model).collect()} == {0.5}
    assert operator.score(docs.limit(0), model).collect() == []


def test_quality_of_one_kind_of_label(spark):
    docs, labels = frames(spark, 8)
    model = quality.fit(docs, labels.where("label IN (0, 1)").withColumn("label", F.lit(1)))
    assert all(r["score"] > 0.99 for r in quality.score(docs, model).collect())


def accuracy(docs, labels, operator, modulus, left_out):
    held = toxicity.remainder(modulus) == left_out
    model = operator.fit(docs, labels.where(~held))
    rows = operator.score(docs, model).join(labels.where(held), "doc_id").collect()
    return rows


def test_held_out_toxicity(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels").select("doc_id", F.col("toxic").alias("label"))
    rows = accuracy(docs, labels, toxicity, 3, 1)
    flagged = [r["label"] for r in rows if r["score"] >= toxicity.CUT]
    assert sum(flagged) / len(flagged) > 0.95
    assert sum(flagged) / sum(r["label"] for r in rows) > 0.6


def test_held_out_quality(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels").select("doc_id", F.col("quality").alias("label"))
    rows = accuracy(docs, labels, quality, 4, 2)
    right = [(r["score"] >= quality.CUT) == (r["label"] == 1) for r in rows]
    assert sum(right) / len(right) > 0.97


def test_rules_as_columns_are_the_rules(spark):
    rules = quality.paths("Forest\n  Tree 0 (weight 1.0):\n    If (feature 0 <= 2.5)\n     If (feature 1 <= 1.0)\n      Predict: 0.0\n     Else (feature 1 > 1.0)\n      Predict: 1.0\n    Else (feature 0 > 2.5)\n     Predict: 1.0\n")
    a, b = quality.STATISTICS[:2]
    assert rules == [((a, False, 2.5),), ((a, False, 2.5), (b, False, 1.0)), ((a, False, 2.5), (b, True, 1.0)), ((a, True, 2.5),)]
    frame = spark.createDataFrame([(2.0, 0.5), (2.0, 3.0), (3.0, 0.5)], f"{a} double, {b} double")
    got = frame.select(*[quality.holds(r).alias(str(i)) for i, r in enumerate(rules)]).collect()
    assert [tuple(r) for r in got] == [(True, True, False, False), (True, False, True, False), (False, False, False, True)]


def test_statistics_of_a_piece_are_those_of_each_text(spark):
    values = ["", "One two, two.", "a | b | c\n99 %%%", "é" * 500, "A " * 300]
    docs = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(9, None)], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: list(r)[1:] for r in quality.statistics(docs).collect()}
    for i, v in enumerate(values):
        raw = np.frombuffer(v.encode(), np.uint8)
        assert got[i] == pytest.approx(quality.measure(raw, np.array([0, len(raw)]))[0].tolist())
    assert got[9] == got[0] == [0.0] * len(quality.STATISTICS)
    assert texts(docs).columns == ["doc_id", "text"]
