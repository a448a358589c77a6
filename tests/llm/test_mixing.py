import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadmill.llm import mixing
from leadmill.llm.common import prepare, table

SMALL = "/root/testdata/sf0.001"


def lowered(text):
    return (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))


def plain_words(text):
    return lowered(text).split() + [None]


def base(docs):
    train = [t for i, t in docs if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for t in train for w in plain_words(t))
    n, v = c.total(), len(c)
    return {(i, t): (len(w := plain_words(t)), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)) for i, t in docs}


def byte_log10(mixer, history, byte):
    """One byte's probability, bit by bit in plain Python."""
    out = 0.0
    for i in range(8):
        node = 1 << i | byte >> (8 - i)
        odds, longest, x = [], 0, []
        for k in range(6):
            before = int.from_bytes(history[5 - k :], "big") if k else 0
            gram = np.array([before << 8 | byte], np.uint64)
            cell = int(mixer.table[mixing.slots(mixing.contexts(gram)[k], k, np.array([node], np.uint64))[0]])
            x.append(0 if cell == -128 else cell / 16)
            longest = k if cell != -128 else longest
        odds = sum(a * b for a, b in zip([*x, 0.3], mixer.weights[longest * 8 + i]))
        odds = min(max(odds, -9.5), 9.5)
        at = (odds + 10) * 32 / 20
        low = min(int(at), 31)
        learnt = mixer.map[node, low] * (1 - at + low) + mixer.map[node, low + 1] * (at - low)
        p = 1 / (1 + math.exp(-(odds + learnt) / 2))
        p = min(max(p, 2**-14), 1 - 2**-14)
        out += math.log10(p if byte >> (7 - i) & 1 else 1 - p)
    return out


def test_base_scores_on_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "HEAD", 5)
    docs = [(i, f"Word{i % 7} the THE a\vb\x00 {'y' * (i * 3)} é{i}") for i in range(40)]
    docs += [(3, "a"), (3, "a"), (None, "a the"), (99, None), (100, ""), (101, " \n "), (102, "the " * 300_000 + "z")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score long")
    got = mixing.language_scores(df).collect()
    want = base(docs)
    texts = Counter(i for i, _ in docs)
    assert len(got) == len(docs)
    seen = Counter()
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        ok = [k for k, w in want.items() if k[0] == r["doc_id"] and w[:3] == (r["n_tokens"], r["n_known"], r["train_tokens"]) and math.isclose(w[3], r["base_score"], rel_tol=1e-9)]
        assert ok and r["score"] < 0
        seen[r["doc_id"]] += 1
    assert seen == texts


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(None, "abc")], "doc_id long, text string")
    row = mixing.language_scores(df).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["held_out"]) == (2, 0, 0, 0.0, False)
    assert math.isclose(row["score"], 32 * math.log10(0.5), rel_tol=1e-3)
    assert mixing.language_scores(df.limit(0)).collect() == []


@pytest.fixture(scope="module")
def learnt(spark):
    prepare(spark)
    docs = mixing.texts(table(spark, SMALL, "documents")).where("doc_id < 150")
    return mixing.fit(docs), docs


def test_tables_against_plain_counts(spark, learnt):
    mixer, docs = learnt
    zeros, ones = Counter(), Counter()
    for row in docs.collect():
        data = b"\0" * 5 + lowered(row["text"]) + b"\xff"
        for p in range(5, len(data)):
            for i in range(8):
                (ones if data[p] >> (7 - i) & 1 else zeros)[data[p - 1], 1 << i | data[p] >> (8 - i)] += 1
    for ctx, node in list(zeros)[:500] + list(ones)[:500]:
        odds = round(math.log((ones[ctx, node] + 0.4) / (zeros[ctx, node] + 0.4)) * 16)
        assert int(mixer.table[256 + ctx * 256 + node]) == max(-127, min(127, odds))


def test_score_is_the_sum_over_bytes_and_a_distribution(learnt):
    mixer, _ = learnt
    rng = np.random.default_rng(1)
    raw = ["The cat, Été", "", "zzz"]
    data = [t.encode() for t in raw]
    ends = np.cumsum([0] + [len(d) for d in data])
    got = mixing.scorer(mixer)(np.frombuffer(b"".join(data), np.uint8), ends)
    for text, score in zip(raw, got):
        whole = b"\0" * 5 + lowered(text) + b"\xff"
        assert math.isclose(score, sum(byte_log10(mixer, whole[p - 5 : p], whole[p]) for p in range(5, len(whole))), rel_tol=1e-9)
    history = int.from_bytes(bytes(rng.integers(97, 122, 5).tolist()), "big")
    every = np.array([history << 8 | b for b in range(256)], np.uint64)
    assert math.isclose((10 ** mixer.log10(every)).sum(), 1, rel_tol=1e-9)


def test_mixing_pays_on_held_out_texts(spark, learnt):
    mixer, _ = learnt
    rows = table(spark, SMALL, "documents").where("doc_id >= 150").select("text").collect()
    data = [(r["text"] or "").encode() for r in rows]
    ends = np.cumsum([0] + [len(d) for d in data])
    flat = np.frombuffer(b"".join(data), np.uint8)
    bits = -mixing.scorer(mixer)(flat, ends).sum() / math.log10(2) / len(flat)
    single = mixing.Mixer.new(mixer.table)
    single.weights[:] = 0
    single.weights[:, 3] = 1
    alone = -mixing.scorer(single)(flat, ends).sum() / math.log10(2) / len(flat)
    print(bits, alone)
    assert bits < 4 and bits < alone
