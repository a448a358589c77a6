"""Removal of byte strings that already stand earlier in the corpus, by longest previous factors.

A byte goes if it lies in a string of ``length`` bytes (a window) that starts earlier as well: the longest previous
factor at the window's start is ``length`` or more. Only suffixes that agree on their first ``length`` bytes matter
to each other, so they are dealt by a key that such suffixes share: the smallest hash of the ``GRAM``-byte strings
inside the window. Neighbouring windows mostly share that string, so a run of windows travels as one entry.

1. Every document's runs go to buckets as (key, hash of the run's bytes, place). Copies of a run within a task are
   settled there: all but the first are repeats. So a run that half the corpus holds costs one entry per task.
2. A bucket settles equal runs the same way. Where runs of one key differ, their bytes decide: one of each kind is
   asked for.
3. Its bytes are cut from the documents and meet in the bucket again. There the suffixes are sorted by their first
   ``length`` bytes, and the previous and next smaller place in that order tells which of them stand earlier.
4. Each document gets its repeated windows and loses the bytes they cover.

Places are ordered by doc_id (null last), then by a hash of the text, then by offset. Repeated rows of one document
(same id and text) are the same place and get the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.llm.common import pieces, prepare, written

LENGTH = 100
GRAM = 32
BUCKET_BYTES = 32 << 20
# A bucket's bytes are compared in so many parts.
PARTS = 16
# Bytes of text whose runs a task settles and packs together.
PACK_BYTES = 8 << 20
NULL_ID = (1 << 63) - 1

_U = np.uint64
_MUL, _STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_INV = pow(_STEP, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(32))
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(29)
    x *= _U(0xC2B2AE3D27D4EB4F)
    x ^= x >> _U(32)
    return x


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * _U(_MUL))
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < n:
        grown = np.full(max(n, 1 << 16), base, np.uint64)
        grown[0] = 1
        _POWERS[base] = np.cumprod(grown, dtype=np.uint64)
    return _POWERS[base][:n]


def smallest_grams(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``length`` bytes, the smallest hash of the ``gram``-byte strings inside it.

    Also whether the window's last string has that hash. Windows that share a smallest string (the last one, of
    equals) all differ; where it changes, one of these two changes or the second holds.
    """
    size, mul, value = 1, _MUL, _BYTES[data]
    while size < gram:  # gram is a power of two
        value = value[:-size] * _U(mul) + value[size:]
        mul = mul * mul % (1 << 64)
        size *= 2
    value = _mix(value)
    span, want = 1, length - gram + 1
    last = value[want - 1 :]
    while span * 2 <= want:
        value = np.minimum(value[:-span], value[span:])
        span *= 2
    if want > span:
        value = np.minimum(value[: len(value) - (want - span)], value[want - span :])
    return value, value == last


def runs(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(document, offset, windows, key, hash of bytes) of each run of windows that share their smallest string."""
    starts, stops = ends[:-1], ends[1:]
    if len(data) < length or not (stops - starts >= length).any():
        return tuple(np.zeros(0, t) for t in (np.int64, np.int32, np.uint8, np.uint64, np.uint64))
    key, first = smallest_grams(data, length)
    first[0] = True
    first[1:] |= key[1:] != key[:-1]
    whole = stops - starts >= length
    first[starts[whole]] = True
    past = stops - length + 1  # where a document's windows are over
    first[past[whole & (past < len(key))]] = True
    at = np.flatnonzero(first)
    many = np.diff(at, append=len(key))
    doc = np.searchsorted(ends, at, "right") - 1
    inside = at + length <= stops[doc]
    at, many, doc = at[inside], many[inside], doc[inside]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _powers(_STEP, len(data)), out=sums[1:])
    body = (sums[at + many + length - 1] - sums[at]) * _powers(_INV, len(data))[at]
    body = _mix(body + many.astype(np.uint64))
    return doc, (at - starts[doc]).astype(np.int32), many.astype(np.uint8), key[at], body


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _documents(order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and how often each stands."""
    new = np.ones(len(order), bool)
    new[1:] = order[1:] != order[:-1]
    at = np.flatnonzero(new)
    return order[at], np.diff(at, append=len(order)).astype(np.int32)


class _Pack:
    """Runs of several documents on their way to the buckets."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.ids, self.ties, self.parts, self.bytes, self.docs = [], [], [], 0, 0

    def add(self, ids: np.ndarray, ties: np.ndarray, found: tuple[np.ndarray, ...], size: int) -> None:
        self.ids.append(ids)
        self.ties.append(ties)
        self.parts.append((found[0] + self.docs, *found[1:]))
        self.docs += len(ids)
        self.bytes += size

    def rows(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, payload): runs still open go by their key, settled ones wherever."""
        if not self.docs:
            return
        ids, ties = np.concatenate(self.ids), np.concatenate(self.ties)
        doc, at, many, key, body = (np.concatenate(x) for x in zip(*self.parts))
        self.clear()
        if not len(doc):
            return
        place = np.empty(len(ids), np.int64)
        place[np.lexsort((ties, ids))] = np.arange(len(ids))
        by = np.lexsort((at, place[doc], body, key))
        again = np.zeros(len(by), bool)
        again[1:] = (key[by][1:] == key[by][:-1]) & (body[by][1:] == body[by][:-1])
        # a repeated row of the same document is the same place, not a later one
        lead = np.maximum.accumulate(np.where(again, 0, np.arange(len(by))))
        a, b = by, by[lead]
        same = (ids[doc[a]] == ids[doc[b]]) & (ties[doc[a]] == ties[doc[b]]) & (at[a] == at[b])
        settled = np.zeros(len(by), bool)
        settled[by] = again & ~same
        bucket = (key % _U(self.buckets)).astype(np.int64)
        bucket[settled] = int(key[0]) % self.buckets
        order = np.lexsort((settled, bucket))
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
            own = order[lo:hi]
            live, done = own[~settled[own]], own[settled[own]]
            live = live[np.argsort(doc[live], kind="stable")]
            done = done[np.argsort(doc[done], kind="stable")]
            out = []
            for x in (live, done):
                d, counts = _documents(doc[x])
                out += [np.array([len(d), len(x)], np.int64), ids[d], ties[d], counts, at[x], many[x]]
            key40 = key[live] // _U(self.buckets)
            out += [body[live], (key40 & _U(0xFFFFFFFF)).astype(np.uint32), (key40 >> _U(32)).astype(np.uint8)]
            yield int(bucket[own[0]]), _pack(*out)


def _unpack(payload: bytes):
    at = 0

    def take(kind, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(payload, kind, n, at)
        at += out.nbytes
        return out

    halves = []
    for _ in range(2):
        docs, n = take(np.int64, 2)
        halves.append((take(np.int64, docs), take(np.int64, docs), take(np.int32, docs), take(np.int32, n), take(np.uint8, n)))
    n = len(halves[0][3])
    body = take(np.uint64, n)
    key = take(np.uint32, n).astype(np.uint64) | take(np.uint8, n).astype(np.uint64) << _U(32)
    return halves, body, key


def _by_document(ids, ties, at, many, extra: dict) -> dict:
    """One row for each document: its (offset, windows) pairs as bytes."""
    order = np.lexsort((at, ties, ids))
    ids, ties, at, many = ids[order], ties[order], at[order], many[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1])
    cuts = np.flatnonzero(new)
    pair = np.empty(len(ids), [("at", "<i4"), ("many", "<u1")])
    pair["at"], pair["many"] = at, many
    raw = pair.tobytes()
    stops = [*(cuts[1:] * 5), len(raw)]
    return {
        "id": pa.array(ids[cuts]),
        "tie": pa.array(ties[cuts]),
        "runs": pa.array([raw[a * 5 : b] for a, b in zip(cuts, stops)], pa.binary()),
        **{k: pa.array(np.full(len(cuts), v)) for k, v in extra.items()},
    }


def _settle(payloads: Iterable[bytes], bucket: int) -> pa.Table:
    """Step 2: repeated runs of a bucket, and which runs' bytes are asked for."""
    ids, ties, at, many, body, key, out = [], [], [], [], [], [], []
    for payload in payloads:
        (live, done), b, k = _unpack(payload)
        ids.append(np.repeat(live[0], live[2]))
        ties.append(np.repeat(live[1], live[2]))
        at.append(live[3])
        many.append(live[4])
        body.append(b)
        key.append(k)
        out.append((np.repeat(done[0], done[2]), np.repeat(done[1], done[2]), done[3], done[4]))
    key = np.concatenate(key)
    order = np.argsort(key)
    twin = np.zeros(len(key), bool)
    equal = key[order][1:] == key[order][:-1]
    twin[order[1:][equal]] = True
    twin[order[:-1][equal]] = True
    ids, ties, at, many, body = (np.concatenate(x)[twin] for x in (ids, ties, at, many, body))
    key = key[twin]
    by = np.lexsort((at, ties, ids, body, key))
    ids, ties, at, many, body, key = (x[by] for x in (ids, ties, at, many, body, key))
    n = len(key)
    head = np.ones(n, bool)
    head[1:] = (key[1:] != key[:-1]) | (body[1:] != body[:-1])
    lead = np.maximum.accumulate(np.where(head, np.arange(n), 0)) if n else np.zeros(0, np.int64)
    same = (ids == ids[lead]) & (ties == ties[lead]) & (at == at[lead])
    top = np.ones(n, bool)
    top[1:] = key[1:] != key[:-1]
    group = np.cumsum(top) - 1
    kinds = np.bincount(group, head, minlength=0) if n else np.zeros(0)
    ask = head & (kinds[group] > 1) if n else head
    out.append((ids[~same], ties[~same], at[~same], many[~same]))
    settled = _by_document(*(np.concatenate(x) for x in zip(*out)), {"bucket": np.int32(-1)})
    tables = [pa.table(settled)]
    for part in range(PARTS):
        own = ask & (key % _U(PARTS) == part)
        tables.append(pa.table(_by_document(ids[own], ties[own], at[own], many[own], {"bucket": np.int32(bucket * PARTS + part)})))
    return pa.concat_tables(tables)


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it with a smaller value, or -1."""
    before = np.arange(len(values)) - 1
    todo = np.flatnonzero(before >= 0)
    while len(todo):
        todo = todo[values[before[todo]] >= values[todo]]
        before[todo] = before[before[todo]]
        todo = todo[before[todo] >= 0]
    return before


def window_ranks(data: np.ndarray, windows: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Ranks of the given offsets in the order of the suffixes' first ``length`` bytes; equal strings share a rank."""
    n = len(data)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = data
    rank = np.zeros(n, np.uint64)
    for i in range(8):
        rank = rank << _U(8) | padded[i : i + n]

    def dense(values: np.ndarray) -> np.ndarray:
        order = np.argsort(values, kind="stable")
        step = np.zeros(len(values), np.uint64)
        step[1:] = values[order][1:] != values[order][:-1]
        out = np.empty(len(values), np.uint64)
        out[order] = np.cumsum(step, dtype=np.uint64)
        return out

    rank, have = dense(rank), 8
    while have < length:
        step = min(have, length - have)
        nxt = np.zeros(n, np.uint64)
        nxt[: n - step] = rank[step:]
        both = rank << _U(32) | nxt
        have += step
        if have >= length:
            both = both[windows]
        rank = dense(both)
    return rank


def earlier(data: np.ndarray, ends: np.ndarray, many: np.ndarray, place: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Of the windows of several runs (their bytes joined), which have a previous factor of ``length`` or more.

    ``place`` orders the first windows of the runs. Suffixes stand in the order of their first ``length`` bytes;
    a match starts earlier exactly if it does so at the previous or the next smaller place in that order.
    """
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at = np.repeat(ends[:-1], many) + nth
    where = np.repeat(place, many) + nth
    rank = window_ranks(data, at, length)
    order = np.argsort(rank, kind="stable")
    rank, where = rank[order], where[order]
    before = previous_smaller(where)
    after = len(where) - 1 - previous_smaller(where[::-1])[::-1]
    hit = (before >= 0) & (rank[before] == rank)
    after_in = after < len(where)
    hit[after_in] |= rank[after[after_in]] == rank[after_in]
    out = np.zeros(len(order), bool)
    out[order] = hit
    return out


def _decide(rows: pa.Table, length: int) -> pa.Table:
    """Step 3: repeated windows among the runs of a bucket whose bytes were asked for."""
    ids, ties, at, many = (rows.column(c).to_numpy() for c in ("id", "tie", "at", "many"))
    many = many.astype(np.int64)
    body = rows.column("body").combine_chunks().cast(pa.large_binary())
    offsets = np.frombuffer(body.buffers()[1], np.int64)[body.offset : body.offset + len(body) + 1]
    data = np.frombuffer(body.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    order = np.lexsort((ties, ids))
    new = np.ones(len(order), np.int64)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (ties[order][1:] != ties[order][:-1])
    place = np.empty(len(order), np.int64)
    place[order] = (np.cumsum(new) - 1) << 32
    hit = earlier(data, offsets - offsets[0], many, place + at, length)
    run = np.repeat(np.arange(len(many)), many)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
    cut = np.ones(len(run), bool)
    cut[1:] = (run[1:] != run[:-1]) | (hit[1:] != hit[:-1])
    first = np.flatnonzero(cut)
    count = np.diff(first, append=len(run))
    own, count, off = run[first][hit[first]], count[hit[first]], nth[first][hit[first]]
    got = _by_document(ids[own], ties[own], at[own] + off, count.astype(np.uint8), {})
    return pa.table(got)


def repeated_runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, tie, runs) of the windows that start earlier as well; several rows for a document."""
    spark = prepare(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = _Pack(buckets)

        def flush() -> Iterator[pa.RecordBatch]:
            for bucket, payload in pack.rows():
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([payload], pa.binary())], ["bucket", "payload"])

        for rows, data, ends in pieces(batches, limit=1 << 20):
            ids, ties = (rows.column(c).to_numpy() for c in ("id", "tie"))
            pack.add(ids, ties, runs(data, ends, length), len(data))
            if pack.bytes >= PACK_BYTES:
                yield from flush()
        yield from flush()

    def settle(rows: pa.Table) -> pa.Table:
        return _settle(rows.column("payload").to_pylist(), rows.column("bucket")[0].as_py())

    sent = docs.mapInArrow(send, "bucket int, payload binary")
    settled = written(sent.groupBy("bucket").applyInArrow(settle, "id long, tie long, runs binary, bucket int"), "runs")
    asked = settled.where("bucket >= 0").groupBy("id", "tie").agg(F.collect_list(F.struct("bucket", "runs")).alias("asked"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("bucket", pa.int32()), ("id", pa.int64()), ("tie", pa.int64()), ("at", pa.int32()), ("many", pa.uint8()), ("body", pa.binary())]
        for rows, data, ends in pieces(batches):
            raw, out = data.tobytes(), []
            ids, ties = (rows.column(c).to_pylist() for c in ("id", "tie"))
            for i, asks in enumerate(rows.column("asked").to_pylist()):
                start = int(ends[i])
                for ask in asks:
                    pairs = np.frombuffer(ask["runs"], [("at", "<i4"), ("many", "<u1")])
                    for at, many in zip(pairs["at"].tolist(), pairs["many"].tolist()):
                        lo = start + at
                        out.append((ask["bucket"], ids[i], ties[i], at, many, raw[lo : lo + many + length - 1]))
            if out:
                batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), kinds)], [n for n, _ in kinds])
                yield batch.set_column(4, "many", batch.column("many").cast(pa.int32()))

    def decide(rows: pa.Table) -> pa.Table:
        return _decide(rows, length)

    bodies = docs.join(asked, ["id", "tie"]).mapInArrow(cut, "bucket int, id long, tie long, at int, many int, body binary")
    decided = bodies.groupBy("bucket").applyInArrow(decide, "id long, tie long, runs binary")
    return settled.where("bucket < 0").select("id", "tie", "runs").unionByName(written(decided, "decided"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, whole text (null: empty), and the order of documents: id and tie."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return own.select("doc_id", "text", F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), F.xxhash64("text").alias("tie"))


def covered(found: list[bytes], size: int, length: int = LENGTH) -> np.ndarray:
    """Which of ``size`` bytes lie in one of the repeated windows."""
    steps = np.zeros(size + 1, np.int32)
    for raw in found:
        pairs = np.frombuffer(raw, [("at", "<i4"), ("many", "<u1")])
        np.add.at(steps, pairs["at"], 1)
        np.add.at(steps, pairs["at"] + pairs["many"].astype(np.int32) + (length - 1), -1)
    return np.cumsum(steps[:-1]) > 0


def _with_runs(docs: DataFrame, length: int) -> DataFrame:
    found = repeated_runs(docs, length).groupBy("id", "tie").agg(F.collect_list("runs").alias("found"))
    return docs.join(found, ["id", "tie"], "left")


def repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept (the remaining bytes).

    A null text is empty. Texts shorter than ``length`` lose nothing. Rows without a doc_id come after all others.
    An empty table gives no rows; other columns are not looked at.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, ends in pieces(batches):
            sizes, gone, spans, sums, kept = np.diff(ends), [], [], [], []
            raw = data.tobytes()
            for i, found in enumerate(rows.column("found").to_pylist()):
                own = raw[ends[i] : ends[i + 1]]
                if found:
                    mask = covered(found, len(own), length)
                    gone.append(int(mask.sum()))
                    spans.append(int((np.diff(mask.astype(np.int8), prepend=0) == 1).sum()))
                    own = data[ends[i] : ends[i + 1]][~mask].tobytes()
                else:
                    gone.append(0)
                    spans.append(0)
                sums.append(hashlib.sha256(own).hexdigest())
                kept.append(own)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(sums), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return _with_runs(keyed(docs), length).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with their remaining text; n_chars, where there is such a column, follows it.

    A character that lost some of its bytes goes as a whole. A text without repeats stays as it is, null included.
    """
    own = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))).withColumn(
        "__tie", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    )
    found = repeated_runs(keyed(docs), length).groupBy("id", "tie").agg(F.collect_list("runs").alias("__found"))
    joined = own.join(found, (own["__id"] == found["id"]) & (own["__tie"] == found["tie"]), "left")

    @F.pandas_udf("string")
    def rest(text, runs_of):
        out = []
        for value, found in zip(text, runs_of):
            if value is not None and found is not None and len(found):
                raw = np.frombuffer(value.encode(), np.uint8)
                value = raw[~covered(list(found), len(raw), length)].tobytes().decode("utf-8", "ignore")
            out.append(value)
        return type(text)(out, dtype=object)

    kept = joined.withColumn("text", rest("text", "__found"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(dict(docs.dtypes)["n_chars"]))
    return kept.select(*docs.columns)
