import random

import numpy as np
import pytest

from leadmill.llm import contamination as S
from leadmill.llm.common import words


def hashes(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return words(raw, np.array([0, len(raw)]))[3]


def by_definition(item, passage):
    """Best local alignment score of two word lists."""
    best, above = 0, [0] * (len(passage) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(passage, 1):
            row.append(max(0, above[j - 1] + (2 if a == b else -1), above[j] - 2, row[-1] - 2))
            best = max(best, row[-1])
        above = row
    return best


def edited(rng, item, vocabulary, edits):
    out = list(item)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.5:
            out[at] = rng.choice(vocabulary)
        elif kind < 0.75:
            out.insert(at, rng.choice(vocabulary))
        elif len(out) > 1:
            del out[at]
    return out


def test_alignment_score_and_place():
    rng = random.Random(1)
    for _ in range(60):
        item = [rng.choice("abcdef") for _ in range(rng.randint(1, 20))]
        passage = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 40))]
        score, first, last = S.align(hashes(" ".join(item)), hashes(" ".join(passage)))
        assert score == by_definition(item, passage)
        if score:
            assert by_definition(item, passage[first : last + 1]) == score


def test_pairs_match_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of"] * 60
    items = [(i, [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 9, 20, 38, 59]))]) for i in range(24)]
    docs = []
    for i in range(160):
        body = [rng.choice(vocabulary) for _ in range(rng.randint(0, 150))]
        if i % 2:
            own = rng.choice(items)[1]
            at = rng.randint(0, len(body))
            body[at:at] = edited(rng, own, vocabulary, rng.randint(0, 1 + len(own) // 4))
        docs.append((i, body))
    frame = spark.createDataFrame([(d, ", ".join(b).upper(), "x", 1) for d, b in docs], "doc_id long, text string, item_id string, score int")
    bench = spark.createDataFrame([(i, " ".join(w) + ".") for i, w in items] + [(99, None), (98, "?! "), (97, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in S.contaminated(frame.repartition(3), bench).collect()}
    want = {}
    for d, body in docs:
        for i, item in items:
            score = by_definition(item, body) / (2 * len(item))
            if score >= S.LEAST - 1e-9:
                want[d, i] = score
    assert got.keys() == want.keys()
    for key, r in got.items():
        assert r["score"] == pytest.approx(want[key])
    held = {d for d, _ in want}
    kept = S.without_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - held


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"one{i} two{i} three{i} four{i} five{i}") for i in range(30)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"x one{i} two{i} three{i} four{i} five{i} y") for i in range(0, 40, 3)] + [(None, None), (50, ""), (0, "x")], "doc_id long, text string")
    whole = sorted(map(tuple, S.contaminated(docs, items).collect()))
    monkeypatch.setattr(S, "BLOCK_BYTES", 200)
    assert sorted(map(tuple, S.contaminated(docs, items).collect())) == whole
    assert len(whole) == 10


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert S.contaminated(docs, none).collect() == []
    assert S.without_contaminated(docs, none).count() == 1
    bench = spark.createDataFrame([(1, "a b c"), (1, "a b c")], "item_id long, text string")
    assert S.contaminated(docs.limit(0), bench).collect() == []
    assert S.contaminated(docs, bench).count() == 1


def test_seeds_are_disjoint_and_the_rarest():
    rng = random.Random(8)
    for _ in range(200):
        item = S.Item(1, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 14))))
        least = rng.choice([0.5, 0.7, 0.9])
        options = sorted(item.candidates(least))
        seen = {gram: rng.randrange(5) for *_, gram in options}
        item.choose(least, seen)
        count = item.breaks(least) + 1
        ways = {0: {0: 0}}  # seeds laid -> where the last one ends -> occurrences
        for k in range(count):
            ways[k + 1] = {}
            for end, cost in ways[k].items():
                for at, size, gram in options:
                    if at >= end:
                        now = cost + seen[gram]
                        ways[k + 1][at + size] = min(ways[k + 1].get(at + size, now), now)
        assert sum(seen[gram] for *_, gram in item.seeds) == min(ways[count].values())
        assert len(item.seeds) == count and set(item.seeds) <= set(options)
        taken = [w for at, size, _ in item.seeds for w in range(at, at + size)]
        assert len(taken) == len(set(taken))


def test_an_item_as_long_as_a_long_document(spark):
    rng = random.Random(9)
    item = [f"w{rng.randrange(5000)}" for _ in range(20_000)]
    copy = edited(rng, item, [f"w{i}" for i in range(5000)], 2_000)
    other = [f"w{rng.randrange(5000)}" for _ in range(20_000)]
    docs = spark.createDataFrame([(1, " ".join(["x"] * 50 + copy)), (2, " ".join(other))], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = S.contaminated(docs, bench).collect()
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(1, 7)] and got[0]["score"] > 0.8 and got[0]["first_word"] >= 50
