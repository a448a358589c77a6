import random

import numpy as np
import pyarrow as pa

from leadmill.llm import common as S


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2000 + i) for i in range(90)] + [(5, 5), (None, 7), (8, None)]
    own = {x: x for e in edges for x in e if x is not None}

    def root(x):
        while own[x] != x:
            x = own[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and root(a) != root(b):
            low, high = sorted((root(a), root(b)))
            own[high] = low
    linked = {x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}
    got = S.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in linked)
    assert S.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_of_joined_texts():
    texts = ["One, two", "three3", "", "é!É", "--", "ab", "cd one"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    doc, start, stop, code = S.words(data, ends)
    spelled = [data[a:b].tobytes().decode() for a, b in zip(start, stop)]
    assert list(zip(doc.tolist(), spelled)) == [(0, "One"), (0, "two"), (1, "three3"), (3, "é"), (3, "É"), (5, "ab"), (6, "cd"), (6, "one")]
    assert code[0] == code[-1] and len(set(code.tolist())) == 7


def test_pieces_cut_by_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array(["a" * 10, None, "b" * 50, "é"])], ["doc_id", "text"])
    cut = list(S.pieces([batch, batch.slice(2)], limit=20))
    assert [rows.num_rows for rows, *_ in cut] == [2, 1, 1, 1, 1]
    assert [data.tobytes() for _, data, _ in cut] == [b"a" * 10, b"b" * 50, "é".encode(), b"b" * 50, "é".encode()]
