import hashlib
import zlib

import pytest

from leadmill.llm import trie


def brute(rows):
    """Node by node over dictionaries of rebuilt conversations."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(donor, [])[:h] + own[c][h:])
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        kids = {p for p in nodes if len(p) == len(path) + 1 and p[: len(path)] == path}
        under = [p for p in nodes if p[: len(path)] == path]
        leaf = [p for p in under if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in under if p)
        ends = ",".join(str(c) for c in sorted(m for m in members if len(built[m]) == len(path)))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(kids), len(leaf), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(spark, rows, extra=False):
    schema = "conv_id long, turn long, role string, text string" + (", a long, depth string" if extra else "")
    df = spark.createDataFrame([(*r, 1, "x") if extra else r for r in rows], schema)
    return sorted(map(tuple, trie.prefix_trie(df).collect()), key=repr)


@pytest.mark.parametrize("shard, segment", [(4096, 2048), (3, 2)])
def test_against_brute_force(spark, monkeypatch, shard, segment):
    monkeypatch.setattr(trie, "SHARD", shard)
    monkeypatch.setattr(trie, "SEGMENT", segment)
    monkeypatch.setattr(trie, "PIECE_BITS", 2)
    rows = [
        *[(c, t, "user" if t % 2 == 0 else "bot", f"t{t}{'ü' * (c % 3 if t > 2 else 0)}") for c in range(-7, 40) for t in range(c % 7 + 1)],
        (50, None, None, None), (50, None, None, None), (50, 3, "user", "x"), (52, 1, "a", "b:c"), (53, 1, "a:b", "c"), (61, 0, "user", ""),
        (None, 1, "user", "lost"), (2000, 0, "user", "t0"), (2001, 0, "user", "t0"), (2002, 0, "user", "t0"),
    ]
    assert result(spark, rows, extra=True) == brute(rows)


def test_long_and_common_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "SEGMENT", 16)
    rows = [(c, t, "user", f"same {t}") for c in range(40) for t in range(20)] + [(7, t, "user", f"long {t}") for t in range(20, 90)]
    assert result(spark, rows) == brute(rows)


def test_no_conversations(spark):
    assert result(spark, [(None, 1, "user", "x")][:0] or []) == []
    assert result(spark, [(None, 1, "user", "x")]) == []
