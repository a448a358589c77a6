import hashlib
import random

import numpy as np
import pytest

from leadmill.llm import suffixes as S


def by_definition(rows, length=100):
    """rows: (doc_id, text) with different ids."""
    first, out = {}, {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            if first.setdefault(raw[p : p + length], (doc_id, p)) != (doc_id, p):
                gone[p : p + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out[doc_id] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def sample():
    random.seed(5)
    rows = [(None, "tail " * 40), (900, None), (901, ""), (902, "short"), (903, "x" * 99), (904, "x" * 100), (905, "x" * 101)]
    for i in range(60):
        kind = i % 4
        if kind == 0:
            text = random.choice("ab") * random.randint(50, 900)
        elif kind == 1:
            text = "".join(random.choice("ab") for _ in range(random.randint(2, 60))) * random.randint(2, 20)
        else:
            text = "".join(random.choice("abcdefgh é") for _ in range(random.randint(0, 600)))
        if i > 8 and random.random() < 0.7:
            other = rows[random.randrange(7, len(rows))][1]
            cut = random.randint(0, len(other))
            text = text[:80] + other[cut : cut + 350] + text[80:]
        rows.append((i * 37 % 61, text))
    return rows


@pytest.mark.parametrize("bucket,pack", [(32 << 20, 8 << 20), (4096, 3000)])
def test_removed_bytes_match_brute_force(spark, monkeypatch, bucket, pack):
    monkeypatch.setattr(S, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(S, "PACK_BYTES", pack)
    rows = sample()
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, id int, runs string").repartition(4)
    got = {r["doc_id"]: tuple(r)[1:5] for r in S.repeated_bytes(docs).collect()}
    assert got == by_definition(rows)


def test_repeated_rows_are_one_document(spark):
    text = "".join(random.Random(1).choices("abcdef", k=300))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string").repartition(3)
    got = sorted((r["doc_id"], r["n_removed"]) for r in S.repeated_bytes(docs).collect())
    assert got == [(1, 0), (1, 0), (2, 300)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.repeated_bytes(docs).collect() == []
    assert S.without_repeats(docs).collect() == []


def test_texts_lose_whole_characters(spark):
    lead = "".join(random.Random(2).choices("abcdef", k=150))
    docs = spark.createDataFrame([(1, "é" + lead, "en", 151), (2, "ê" + lead + "!", "de", 152), (3, None, None, None)], "doc_id long, text string, lang string, n_chars long")
    out = {r["doc_id"]: r for r in S.without_repeats(docs).collect()}
    assert S.without_repeats(docs).columns == docs.columns
    assert out[1]["text"] == "é" + lead
    # é and ê differ in their second byte, so the first repeated string begins after it
    assert (out[2]["text"], out[2]["n_chars"]) == ("ê!", 2)
    assert out[3]["text"] is None


def test_previous_smaller():
    values = np.random.default_rng(1).integers(0, 50, 400)
    got = S.previous_smaller(values)
    for i, v in enumerate(values):
        want = [j for j in range(i) if values[j] < v]
        assert got[i] == (want[-1] if want else -1)


def test_earlier_is_the_longest_previous_factor():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 900).astype(np.uint8)
    length, raw = 12, data.tobytes()
    ends = np.array([0, 500, 900])
    many = np.array([489, 389])
    hit = S.earlier(data, ends, many, np.array([0, 1 << 32]), length)
    starts = [*range(489), *range(500, 889)]
    seen = set()
    for got, p in zip(hit, starts):
        assert got == (raw[p : p + length] in seen)
        seen.add(raw[p : p + length])
