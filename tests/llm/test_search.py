import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from leadmill.llm import search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    counts = [(i, Counter(terms(text))) for i, text in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, size = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    texts = {}
    for item, text in items:
        texts.setdefault(item, set()).add(text or "")
    out = []
    for item, own in texts.items():
        query = Counter(t for text in own for t in terms(text))
        found = []
        for i, c in counts:
            m = 25 + 75 * c.total() * n_docs // size
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, k in query.items() if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def result(spark, docs, items):
    docs = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, item_id string, score long")
    items = spark.createDataFrame([(*i, 5) for i in items], "item_id long, text string, doc_id long")
    return sorted(map(tuple, search.ranked(docs, items).collect()), key=repr)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 300)
    rng = np.random.default_rng(3)
    word = lambda: rng.choice(["the", "The", "aß", "Ünd", "x9", "k" * 30, *(f"w{i}" for i in range(40))])
    text = lambda n: "; ".join(word() for _ in range(n))
    docs = [(i % 90, text(int(rng.integers(1, 60)))) for i in range(120)]
    docs += [(200, None), (201, ""), (202, "...,"), (None, "the w1 w2"), (None, "the w1 w2"), (203, "the " * 30_000), (204, "w1"), (205, "w1")]
    items = [(i, text(int(rng.integers(2, 25)))) for i in range(12)]
    items += [(0, "w1 w1 w1"), (0, "w1 w1 w1"), (20, None), (21, ""), (22, "nowhere"), (None, "w1 the"), (23, " ".join(f"w{i}" for i in range(40)) * 50)]
    assert result(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert result(spark, [(1, "a")][:0], [(1, "a")]) == []
    assert result(spark, [(1, "a")], [(1, "a")][:0]) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), min_size=0, max_size=12, unique=True), min_size=0, max_size=12))
def test_shared_sets_add_up_to_each_query(queries):
    left, levels = search.shared([sorted(q) for q in queries], 13)
    content = {n: Counter([n]) for n in range(13)}
    for a, b in levels:
        for x, y in zip(a.tolist(), b.tolist()):
            content[len(content)] = content[x] + content[y]
    for query, parts in zip(queries, left):
        assert sum((content[n] for n in parts), Counter()) == Counter(query)


def test_sets_that_queries_share_are_made_once():
    one = list(range(30))
    left, levels = search.shared([one, one, [*one, 31]], 32)
    assert sum(len(a) for a, _ in levels) <= 30 and all(len(q) <= 2 for q in left)


def test_long_text_is_split_at_words(monkeypatch):
    monkeypatch.setattr(search, "SPLIT", 7)
    text = "ab cdefghijklmno p  ab, " * 9
    assert search.term_counts(text.encode()) == Counter(t.encode() for t in terms(text))
