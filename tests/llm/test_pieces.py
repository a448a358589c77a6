import random

import numpy as np
import pytest

from leadmill.llm import pieces as S

sentencepiece = pytest.importorskip("sentencepiece")
PARTS = ["a", "b", "e", "the", "ing", " ", "  ", "     ", "\n", "\t", "é", "日", "本", "x", "Q", "10", "http", ".", "😀", "\x00", "tion", "<s>", "==", "aaaaaaaa"]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=S.MODEL)


@pytest.fixture(scope="module")
def known():
    return S.Vocabulary()


def random_texts(n, seed=3):
    rng = random.Random(seed)
    out = ["", " ", "a", "▁", "a ▁ b"]
    for i in range(n):
        pool = "abetion" if i % 3 == 0 else PARTS
        out.append("".join(rng.choice(pool) for _ in range(rng.randint(1, 70))))
    return out


def test_ids_are_the_librarys(model, known):
    texts = random_texts(600)
    ids, ends = known.encoder().encode([S.prefixed(t) for t in texts])
    for text, a, b in zip(texts, ends, ends[1:]):
        assert ids[a:b].tolist() == model.encode(text)
        if chr(S.SPACE) not in text:
            assert known.decoder().decode(ids[a:b].astype(np.int64)).decode() == text


def test_characters_without_a_piece(model, known):
    encoder = known.encoder()
    inside = {c for piece in known.id for c in piece}
    strange = [c for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x30000)]) if c not in inside]
    points = np.array([ord(c) for c in strange], np.uint64)
    space = np.full(len(points), S.SPACE, np.uint64)
    # those whose pair with the space before them, or with themselves, shares its place in the table with a piece's
    colliding = [c for pair in ((space, points), (points, points)) for c in np.array(strange)[encoder.spanned[encoder._pair(*pair)]].tolist()]
    assert colliding
    rng = random.Random(5)
    hangul = [c for c in strange if "\uac00" <= c <= "\ud7a3"]
    texts = [t for c in colliding for t in (c, c + c, f"the {c}{c}{c}, a{c}b {c}")]
    texts += ["".join(rng.choices(hangul, k=1000)) for _ in range(20)]
    ids, ends = known.encoder().encode([S.prefixed(t) for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [model.encode(t) for t in texts]


def test_units_with_a_character_that_is_only_a_part_of_pieces(known):
    encoder = S.Encoder(known)
    encoder.alone[ord("q")] = False  # as if it had no piece: such units are traced by hand, among others of their size
    values = [S.prefixed(t) for t in ("quick queen of all", "a quiet unit", "plain words only", "q")]
    got, want = encoder.encode(values), known.encoder().encode(values)
    assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def chunks(encoder, text, size):
    cuts = [*range(0, len(text), size), len(text)]
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    free = [True, *(bool(encoder.cuts(points[c - 1 : c + 1])[0]) for c in cuts[1:-1]), True]
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        a, b = max(0, lo - encoder.longest), min(len(text), hi + encoder.longest)
        yield text[a:b], a, lo - a, hi - a, free[i], free[i + 1]


def test_chunks_of_any_size_give_the_same_ids(model, known):
    encoder = known.encoder()
    for text in random_texts(120, 8):
        whole = S.prefixed(text)
        if not whole:
            continue
        for size in (1, 2, 5, 17, 40):
            own = list(chunks(encoder, whole, size))
            matrices = [encoder.transfer(*c) for c in own]
            ids = [i for c, (a, b) in zip(own, S.route(matrices, len(whole))) for i in encoder.path(*c[:4], a, b)]
            assert ids == model.encode(text)


def test_matrices_combine_in_any_order(known):
    encoder = known.encoder()
    for text in random_texts(60, 9):
        own = [encoder.transfer(*c) for c in chunks(encoder, S.prefixed(text), 3)] if text else []
        if len(own) < 3:
            continue
        plain = lambda m: {k: set(v) for k, v in m.items() if v}
        assert plain(S.then(S.then(own[0], own[1]), own[2])) == plain(S.then(own[0], S.then(own[1], own[2])))


def test_operator(spark, model):
    texts = [*random_texts(60, 4), None, "no blank " * 400, "z" * 5000, "é日" * 900]
    rows = [(i, t, 1, "k") for i, t in enumerate(texts)] + [(None, "an id is missing", 1, "k"), (1, " ", 1, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, key string").repartition(3)
    broadcast = S.vocabulary(spark)
    got = sorted(((r["doc_id"], r["ids"]) for r in S.encode(docs, broadcast, chunk=300).collect()), key=repr)
    assert got == sorted(((d, model.encode(t or "")) for d, t, *_ in rows), key=repr)
    checked = S.encode_with_check(docs, broadcast, chunk=300).collect()
    assert all(r["exact"] or "▁" in (texts[r["doc_id"]] or "") for r in checked)
    decoded = {r["doc_id"]: r["text"] for r in S.decode(S.encode(docs, broadcast), broadcast).collect()}
    assert all(decoded[i] == (t or "") for i, t in enumerate(texts) if "▁" not in (t or "") and i != 1)
    plain, cut = (sorted(map(tuple, S.digests(docs, broadcast, c).collect()), key=repr) for c in (10_000, 64))
    assert plain == cut
    assert S.encode(docs.limit(0), broadcast).collect() == []


def test_texts_with_equal_codes_are_told_apart(model):
    """Polynomial hashes modulo a power of two give a Thue-Morse string and its complement the same code."""
    encoder = S.Vocabulary().encoder()
    for size in (1024, 2048):
        one = "".join("ab"[bin(i).count("1") % 2] for i in range(size))
        texts = [one, one.translate(str.maketrans("ab", "ba")), one, "x" + one]
        for _ in range(2):  # new, then known
            ids, ends = encoder.encode([S.prefixed(t) for t in texts])
            for text, a, b in zip(texts, ends, ends[1:]):
                assert ids[a:b].tolist() == model.encode(text)


def test_units_whose_pieces_have_foreign_codes(model, monkeypatch):
    encoder = S.Vocabulary().encoder()
    right = encoder._paths
    twin = {int(n): i for i, n in enumerate(encoder.number_size)}
    twin = np.array([twin[int(n)] for n in encoder.number_size])  # another piece of the same length

    def other(sums, start, size):
        piece, counts = right(sums, start, size)
        return np.where(np.arange(len(piece)) % 3 == 0, twin[piece], piece), counts

    monkeypatch.setattr(encoder, "_paths", other)
    for text in random_texts(50, 8):
        ids, _ = encoder.encode([S.prefixed(text)])
        assert ids.tolist() == model.encode(text)


def test_workers_hold_few_texts_at_once():
    """A batch of many chunks is cut by its characters, before its texts and ids become Python objects."""
    text = "word " * 3000
    batch = S.pa.RecordBatch.from_pydict({"text": [text] * 200})
    cut = list(S._some([batch]))
    assert sum(rows.num_rows for rows, _ in cut) == 200 and [v for _, some in cut for v in some] == [text] * 200
    assert max(sum(map(len, some)) for _, some in cut) <= 1 << 18
