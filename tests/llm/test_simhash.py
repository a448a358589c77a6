import random

import numpy as np
import pytest
import xxhash

from leadmill.llm import simhash as S


def by_definition(text):
    words, word = [], b""
    for b in (text or "").encode():
        if b in b" \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = b""
        else:
            word += bytes([b + 32 if 65 <= b <= 90 else b])
    words += [word] if word else []
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups(prints, ids, most=3):
    own = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= most and own[i] != own[j]:
                one, other = sorted((own[i], own[j]))
                own = [one if o == other else o for o in own]
    return [min((d for d, o in zip(ids, own) if o == own[i] and d is not None), default=None) for i in range(len(ids))]


def test_fingerprint_is_its_definition():
    random.seed(1)
    texts = ["", " \t\n", "One", "one TWO", "ß É\x0bÉ a b", "a " * 5000] + [" ".join(random.choices("ab cd É x\n yy".split(" "), k=k)) for k in range(2, 60)]
    for text in texts:
        assert S.fingerprint(text.encode()) % (1 << 64) == by_definition(text)


def test_groups_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "PER_SHARD", 64)
    monkeypatch.setattr(S, "LEAF", 16)
    random.seed(2)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(None, "lonely text without an id"), (7, None), (8, ""), (9, " \n "), (9, " \n ")]
    for i in range(20, 200):
        rows.append((i, " ".join(random.choices(vocabulary, k=random.randint(1, 200)))))
    for i in range(200, 380):
        words = random.choice(rows[5:185])[1].split()
        words[random.randrange(len(words))] = "edited"
        rows.append((i, " ".join(words)))
    rows += [(500 + i, rows[30][1]) for i in range(60)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, fp string, component_id string").repartition(5)
    got = sorted(map(tuple, S.simhash_groups(docs).collect()), key=repr)
    prints = [by_definition(t) for _, t in rows]
    want = [(d, f"{p:016x}", g) for (d, _), p, g in zip(rows, prints, groups(prints, [d for d, _ in rows]))]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("n", [0, 1])
def test_tiny_tables(spark, n):
    docs = spark.createDataFrame([(4, "a b c")][:n], "doc_id long, text string")
    assert [r["component_id"] for r in S.simhash_groups(docs).collect()] == [4][:n]
    assert S.one_per_group(docs).count() == n


def test_one_per_group_keeps_columns_and_smallest_ids(spark):
    rows = [(3, "same words here", "en"), (1, "same words here", "de"), (1, "same words here", "de"), (2, "all other words", None), (None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = S.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([rows[1], rows[3], rows[4]], key=repr)


def test_one_per_group_with_repeated_and_missing_ids(spark):
    """One row a group: not another text of the same id, and no row without an id beside one with an id."""
    same, other, third = "one two three four five", "six seven eight nine ten", "ten more words of another kind"
    rows = [(1, same, "a", 1), (None, same, "b", 1), (None, third, "c", 1), (None, third, "d", 2), (4, other, "e", 1), (4, same, "f", 1), (4, other, "g", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id string, fp long")
    want = None
    for part in (1, 4):
        kept = sorted(map(tuple, S.one_per_group(docs.repartition(part)).collect()), key=repr)
        assert sorted((r[0], r[1]) for r in kept if r[0]) == [(1, same), (4, other)]
        assert [r[1] for r in kept if r[0] is None] == [third]
        want = want or kept
        assert kept == want


def test_dense_groups_cost_a_spanning_forest():
    rng = np.random.default_rng(3)
    centre = np.uint64(0x0123456789ABCDEF)
    near = np.unique(np.array([centre ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for a, b in rng.integers(0, 64, (4000, 2))], np.uint64))
    a, _ = S.forest(near, 0, 3)
    assert len(a) < 4 * len(near)
