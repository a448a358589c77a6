"""SentencePiece encoding and decoding of a byte-pair model, as a best path that can be cut anywhere.

Merging pairs by score looks sequential, but its result has a local form: pieces that cover a text are its encoding
exactly if merging leaves every two neighbours, taken by themselves, as they are. So the encoding is the best path
through the pieces that match the text, where a step to a neighbour that merging keeps scores 0 and any other minus
infinity; there is one such path.

A place that no piece can span (two characters that stand side by side in no piece) splits the path, so texts fall
into short units, and equal units share their path. Documents longer than a chunk are cut wherever the chunk ends.
What can reach over a cut is a piece: a chunk's transfer matrix says for each piece that comes in over its left cut
which pieces can go out over its right cut (max-plus, with 0 and minus infinity as scores). The matrices of a
document are combined associatively; then every chunk knows its way in and out and traces its pieces by itself.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.llm.common import _powers, mixed, prepare, texts, written

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 16_384
# Units whose ids a worker remembers, and neighbours that it remembers as kept or not.
CACHE, PAIRS = 1_500_000, 300_000
# Characters of the texts, and documents of joined ids, that a worker looks at together (one text at least).
SOME, SOME_ROWS = 1 << 18, 32
# Longer units are traced one by one.
SHORT_UNIT = 32
SPACE = 0x2581
_STEP = 0xD6E8FEB86659FD93
_BACK = pow(_STEP, -1, 1 << 64)

# A piece that comes in over a cut, as (begin, end) in the document; (cut, cut) where none can.
State = tuple[int, int]
Matrix = dict[State, list[State]]


class Vocabulary:
    """Pieces and scores of a model file, read once on the driver."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.id = {model.id_to_piece(i): i for i in plain}
        self.byte = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        self.longest = max(map(len, self.id))
        self.bytes = [b""] * len(ids)
        for piece, i in self.id.items():
            self.bytes[i] = piece.replace(chr(SPACE), " ").encode()
        for value, i in self.byte.items():
            self.bytes[i] = bytes([value])
        self._encoder: Encoder | None = None
        self._decoder: Decoder | None = None

    def decoder(self) -> Decoder:
        if self._decoder is None:
            self._decoder = Decoder(self)
        return self._decoder

    def encoder(self) -> Encoder:
        """One encoder for each Python worker, so that units stay known from task to task."""
        if self._encoder is None:
            self._encoder = Encoder(self)
        return self._encoder


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1 ... of several runs, one run after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


class Encoder:
    """Paths of texts in which a space is the character of SPACE."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.longest = vocabulary.longest
        pairs = np.array([[ord(a), ord(b)] for p in vocabulary.id for a, b in zip(p, p[1:])], np.uint64).reshape(-1, 2)
        self.spanned = np.zeros(1 << 22, bool)
        self.spanned[self._pair(pairs[:, 0], pairs[:, 1])] = True
        # characters that stand in a piece, and those among them that are one
        self.within, self.alone = np.zeros(0x110000, bool), np.zeros(0x110000, bool)
        self.within[np.unique([ord(c) for p in vocabulary.id for c in p]).astype(np.int64)] = True
        self.alone[[ord(p) for p in vocabulary.id if len(p) == 1]] = True
        # pieces (True) and their beginnings
        self.match = {p[:k]: False for p in vocabulary.id for k in range(1, len(p))} | dict.fromkeys(vocabulary.id, True)
        self.kept: dict[tuple[str | None, str], bool] = {}
        # pieces by number: text, id, characters, code; and a table of bits that most codes are not in
        self.names = sorted(vocabulary.id)
        self.number_id = np.array([vocabulary.id[p] for p in self.names], np.int32)
        self.number_size = np.array([len(p) for p in self.names], np.int64)
        self.number_chars = np.frombuffer("".join(self.names).encode("utf-32-le", "surrogatepass"), "<u4")
        self.number_at = np.cumsum(self.number_size) - self.number_size
        codes = np.array([int(self._sums(p)[1][0]) for p in self.names], np.uint64)
        self.order = np.argsort(codes)
        self.codes = codes[self.order]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.codes & np.uint64((1 << 22) - 1)] = True
        self.pair_key, self.pair_good = np.zeros(1 << 22, np.uint64), np.zeros(1 << 22, bool)
        self.clear()

    def clear(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.flat, self.begin = np.zeros(0, np.int32), np.zeros(1, np.int64)
        # the characters of the units, since codes alone do not tell them apart for sure
        self.spelled, self.spelled_at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    @staticmethod
    def _sums(text: str) -> tuple[np.ndarray, np.ndarray]:
        """Running sums that give the code of any part of a text, and the code of all of it."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(mixed(points + np.uint64(1)) * _powers(_STEP, len(points)), out=sums[1:])
        return sums, mixed(sums[-1:] + np.uint64(len(points)))

    @staticmethod
    def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (mixed(a << np.uint64(32) | b) >> np.uint64(42)).astype(np.int64)

    def cuts(self, points: np.ndarray) -> np.ndarray:
        """For each place between two characters, whether no piece can span it.

        Pairs are looked up by hash, so places beside pieces' characters may be missed; a place beside a character that
        stands in no piece never is.
        """
        wide, strange = points.astype(np.uint64), ~self.within[points]
        return ~self.spanned[self._pair(wide[:-1], wide[1:])] | strange[:-1] | strange[1:]

    def merged(self, text: str) -> list[str]:
        """The definition: merge the neighbours whose join has the best score, the first of equals, while there are any."""
        parts, score = list(text), self.v.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                own = score.get(parts[i] + parts[i + 1])
                if own is not None and (best is None or own > best):
                    best, at = own, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def keeps(self, left: str | None, right: str) -> bool:
        """Whether merging leaves these neighbours as they are; without a left one, whether it makes ``right`` one piece."""
        pair = (left, right)
        if pair not in self.kept:
            if len(self.kept) > PAIRS:
                self.kept.clear()
            self.kept[pair] = self._left_alone(left or "", right)
        return self.kept[pair]

    def _left_alone(self, left: str, right: str) -> bool:
        """merged() of both, given up as soon as it joins a part of ``left`` with one of ``right``."""
        parts, score, edge = list(left + right), self.v.score.get, len(left)
        joins = [score(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, own in enumerate(joins):
                if own is not None and (best is None or own > best):
                    best, at = own, i
            if best is None:
                return len(parts) == 1 + (edge > 0)
            if at == edge - 1:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            edge -= at < edge
            del joins[at]
            if at:
                joins[at - 1] = score(parts[at - 1] + parts[at])
            if at < len(joins):
                joins[at] = score(parts[at] + parts[at + 1])

    def reach(self, text: str, start: int, before: str | None) -> list[str | None]:
        """For each end, the last piece of the path from ``start`` after the piece ``before``; None if there is none.

        ``before`` None: the text begins at a place that no piece spans.
        """
        n = len(text)
        last: list[str | None] = [None] * (n + 1)
        last[start] = before
        kept, match, keeps = self.kept.get, self.match.get, self.keeps
        for begin in range(start, n):
            left = last[begin]
            if left is None and begin > start:
                continue
            for end in range(begin + 1, n + 1):
                piece = text[begin:end]
                whole = match(piece)
                if whole is None:
                    if end - begin > 1:
                        break
                    whole = True  # a character without a piece
                if whole and last[end] is None:
                    good = kept((left, piece))
                    if keeps(left, piece) if good is None else good:
                        last[end] = piece
        return last

    def trace(self, last: list[str | None], start: int, end: int) -> list[str]:
        """The path's pieces from ``start`` to ``end``."""
        out = []
        while end > start:
            out.append(last[end])
            end -= len(out[-1])
        return out[::-1]

    def ids(self, parts: Iterable[str]) -> list[int]:
        """Ids of pieces; characters that have none are spelled as bytes."""
        out = []
        for part in parts:
            one = self.v.id.get(part)
            out += [one] if one is not None else [self.v.byte[b] for b in part.encode()]
        return out

    def unit(self, text: str) -> list[int]:
        return self.ids(self.trace(self.reach(text, 0, None), 0, len(text)))

    def _kept(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """keeps() for pairs of numbers of pieces; left -1: none."""
        key = (left + 2).astype(np.uint64) << np.uint64(20) | right.astype(np.uint64)
        slot = (mixed(key) & np.uint64(len(self.pair_key) - 1)).astype(np.int64)
        good = self.pair_good[slot]
        new = np.flatnonzero(self.pair_key[slot] != key)
        if len(new):
            _, first, inverse = np.unique(key[new], return_index=True, return_inverse=True)
            own = new[first]
            found = np.array(
                [self._left_alone(self.names[a] if a >= 0 else "", self.names[b]) for a, b in zip(left[own].tolist(), right[own].tolist())]
            )
            good[new] = found[inverse]
            self.pair_key[slot[own]], self.pair_good[slot[own]] = key[own], found
        return good

    def _paths(self, sums: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """reach() and trace() for many short units at once: pieces by number, and how many each has. Longest units first."""
        most = int(size[0])
        last = np.full((len(start), most + 1), -9, np.int32)
        last[:, 0] = -1
        back = _powers(_BACK, len(sums))
        for end in range(1, most + 1):
            todo = np.arange(int(np.searchsorted(-size, -end, "right")))
            stop = sums[start[todo] + end]
            for long in range(1, min(self.longest, end) + 1):
                begin = end - long
                at = start[todo] + begin
                code = mixed((stop - sums[at]) * back[at] + np.uint64(long))
                hit = np.flatnonzero(self.maybe[code & np.uint64((1 << 22) - 1)])
                nth = np.minimum(np.searchsorted(self.codes, code[hit]), len(self.codes) - 1)
                same = (self.codes[nth] == code[hit]) & (self.number_size[self.order[nth]] == long)
                hit, piece = hit[same], self.order[nth[same]]
                if not len(hit):
                    continue
                left = last[todo[hit], begin]
                able = left > -9
                hit, piece, left = hit[able], piece[able], left[able]
                good = self._kept(left, piece)
                last[todo[hit[good]], end] = piece[good]
                rest = np.ones(len(todo), bool)
                rest[hit[good]] = False
                todo, stop = todo[rest], stop[rest]
                if not len(todo):
                    break
        rows, at, steps = np.arange(len(start)), size.copy(), []
        while len(rows):
            piece = last[rows, at]
            steps.append((rows, piece))
            at = at - self.number_size[piece]
            rows, at = rows[at > 0], at[at > 0]
        unit = np.concatenate([r for r, _ in steps])
        piece = np.concatenate([p for _, p in steps])
        nth = np.concatenate([np.full(len(r), -i) for i, (r, _) in enumerate(steps)])
        order = np.lexsort((nth, unit))
        return piece[order], np.bincount(unit, minlength=len(start))

    def _learn(self, joined: str, points: np.ndarray, sums: np.ndarray, code: np.ndarray, start: np.ndarray, stop: np.ndarray) -> None:
        """Remember the paths of units with new codes."""
        size = stop - start
        order = np.argsort(-size, kind="stable")
        code, start, stop, size = code[order], start[order], stop[order], size[order]
        long = int(np.searchsorted(-size, -SHORT_UNIT, "left"))
        # _paths() knows pieces only, so units that hold a character without one are traced one by one, as long ones are
        missing = np.concatenate([[0], np.cumsum(~self.alone[points])])
        many = missing[stop] == missing[start]
        many[:long] = False
        counts = np.zeros(len(start), np.int64)
        slow = np.flatnonzero(~many)
        by_hand = [self.unit(joined[a:b]) for a, b in zip(start[slow].tolist(), stop[slow].tolist())]
        counts[slow] = [len(x) for x in by_hand]
        if many.any():
            found, counts[many] = self._paths(sums, start[many], size[many])
            # pieces are looked up by code: units that theirs do not spell are traced by their characters
            lengths = self.number_size[found]
            chars = self.number_chars[_ranges(self.number_at[found], lengths)]
            wrong = chars != points[_ranges(start[many], size[many])]
            if wrong.any():
                bad = np.zeros(len(start), bool)
                bad[np.flatnonzero(many)[np.unique(np.repeat(np.arange(many.sum()), size[many])[wrong])]] = True
                found = found[~np.repeat(bad[many], counts[many])]
                for k in np.flatnonzero(bad).tolist():
                    by_hand.append(self.unit(joined[start[k] : stop[k]]))
                    counts[k] = len(by_hand[-1])
                slow, many = np.concatenate([slow, np.flatnonzero(bad)]), many & ~bad
                by_hand = [by_hand[k] for k in np.argsort(slow).tolist()]
            found = self.number_id[found]
        else:
            found = np.zeros(0, np.int32)
        ids, batched = np.zeros(counts.sum(), np.int32), np.repeat(many, counts)
        ids[batched], ids[~batched] = found, [i for x in by_hand for i in x]
        place = np.arange(len(start)) + len(self.begin) - 1
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(counts)])
        self.flat = np.concatenate([self.flat, ids])
        self.spelled = np.concatenate([self.spelled, points[_ranges(start, size)].astype(np.uint32)])
        self.spelled_at = np.concatenate([self.spelled_at, self.spelled_at[-1] + np.cumsum(size)])
        known, where = np.concatenate([self.known, code]), np.concatenate([self.place, place.astype(np.int32)])
        order = np.argsort(known, kind="stable")
        self.known, self.place = known[order], where[order]

    def encode(self, values: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of several texts that begin and end at places that no piece spans, and where each text's begin."""
        sizes = np.array([len(v) for v in values], np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        joined = "".join(values)
        if not joined:
            return np.zeros(0, np.int32), np.zeros(len(values) + 1, np.int64)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        first = np.ones(len(points) + 1, bool)
        first[1:-1] = self.cuts(points)
        first[ends] = True
        at = np.flatnonzero(first)
        sums, _ = self._sums(joined)
        code = mixed((sums[at[1:]] - sums[at[:-1]]) * _powers(_BACK, len(points))[at[:-1]] + (at[1:] - at[:-1]).astype(np.uint64))
        unique, where, inverse = np.unique(code, return_index=True, return_inverse=True)
        if len(self.known) > CACHE:
            self.clear()
        nth = np.searchsorted(self.known, unique)
        new = np.ones(len(unique), bool)
        inside = nth < len(self.known)
        new[inside] = self.known[nth[inside]] != unique[inside]
        if new.any():
            self._learn(joined, points, sums, unique[new], at[where[new]], at[where[new] + 1])
            nth = np.searchsorted(self.known, unique)
        unit = self.place[nth][inverse]
        lengths = (self.begin[1:] - self.begin[:-1])[unit]
        out = self.flat[_ranges(self.begin[unit], lengths)]
        # a unit is the one that its code says if it has the same characters; others are traced by their own
        size = at[1:] - at[:-1]
        strange = np.flatnonzero(self.spelled_at[unit + 1] - self.spelled_at[unit] != size)
        spelled = np.minimum(_ranges(self.spelled_at[unit], size), len(self.spelled) - 1)
        wrong = np.flatnonzero(self.spelled[spelled] != points)
        if len(strange) or len(wrong):
            bad = np.union1d(strange, np.searchsorted(at, wrong, "right") - 1)
            parts, own = np.split(out, np.cumsum(lengths)[:-1]), lengths.copy()
            for k in bad.tolist():
                parts[k] = np.array(self.unit(joined[at[k] : at[k + 1]]), np.int32)
                own[k] = len(parts[k])
            out, lengths = np.concatenate(parts), own
        out_ends = np.concatenate([[0], np.cumsum(lengths)])
        return out, out_ends[np.searchsorted(at, ends)]

    # Chunks: ``text`` is the chunk with the characters around it that a piece could hold; ``origin`` is its first
    # character's place in the document, ``lo`` and ``hi`` are the chunk's cuts within ``text``.

    def _edges(self, text: str, lo: int, hi: int) -> tuple[int | None, int | None]:
        """The first and the last place from ``lo`` to ``hi`` that no piece spans, or None."""
        free = np.ones(len(text) + 1, bool)
        if len(text) > 1:
            free[1:-1] = self.cuts(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"))
        at = np.flatnonzero(free[lo : hi + 1])
        return (int(at[0]) + lo, int(at[-1]) + lo) if len(at) else (None, None)

    def _over(self, text: str, cut: int) -> Iterator[tuple[int, int]]:
        """Every piece that begins before ``cut`` and ends there or later."""
        for begin in range(max(0, cut - self.longest), cut):
            for end in range(cut, min(len(text), begin + self.longest) + 1):
                piece = text[begin:end]
                if len(piece) == 1 or piece in self.v.score:
                    yield begin, end

    def _out(self, text: str, last: list[str | None], start: int, before: str | None, hi: int) -> Iterator[tuple[int, int]]:
        """Pieces over ``hi`` that go on from the path from ``start``."""
        for begin, end in self._over(text, hi):
            if begin < start or begin > start and last[begin] is None:
                continue
            left, piece = before if begin == start else last[begin], text[begin:end]
            if self.keeps(left, piece):
                yield begin, end

    def transfer(self, text: str, origin: int, lo: int, hi: int, free_lo: bool, free_hi: bool) -> Matrix:
        """The chunk's matrix. free_lo, free_hi: no piece spans that cut."""
        first, final = self._edges(text, lo, hi)
        ways_in: list[tuple[int, int]] = [(lo, lo)] if free_lo else list(self._over(text, lo))
        out: Matrix = {}
        if first is None:  # one unit over the whole chunk
            for begin, end in ways_in:
                before = text[begin:end] or None
                if end >= hi:  # it goes over the whole chunk
                    out[begin + origin, end + origin] = [(begin + origin, end + origin)]
                    continue
                last = self.reach(text, end, before)
                out[begin + origin, end + origin] = [(a + origin, b + origin) for a, b in self._out(text, last, end, before, hi)]
            return out
        if free_hi:
            ways_out = [(hi + origin, hi + origin)]
        else:
            tail = text[final:]
            last = self.reach(tail, 0, None)
            ways_out = [(a + final + origin, b + final + origin) for a, b in self._out(tail, last, 0, None, hi - final)]
        for begin, end in ways_in:
            before = text[begin:end] or None
            if end == first or end < first and self.reach(text[:first], end, before)[first] is not None:
                out[begin + origin, end + origin] = ways_out
        return out

    def path(self, text: str, origin: int, lo: int, hi: int, way_in: State, way_out: State) -> list[int]:
        """Ids of the pieces that begin in the chunk, between the piece that comes in and the end of the one that goes out."""
        start, stop = way_in[1] - origin, way_out[1] - origin
        before = text[way_in[0] - origin : start] or None
        first, final = self._edges(text, lo, hi)
        if way_in == way_out and way_in[0] < way_in[1]:
            return []
        if first is None:
            last = self.reach(text, start, before)
            until = way_out[0] - origin
            return self.ids([*self.trace(last, start, until), text[until:stop]])
        out = self.ids(self.trace(self.reach(text[:first], start, before), start, first)) if start < first else []
        out += self.encode([text[first:final]])[0].tolist()
        if way_out[0] < way_out[1]:
            until = way_out[0] - origin - final
            tail = text[final:]
            out += self.ids([*self.trace(self.reach(tail, 0, None), 0, until), tail[until : stop - final]])
        return out


def then(a: Matrix, b: Matrix) -> Matrix:
    """Max-plus product of two chunks' matrices."""
    return {way: list(dict.fromkeys(o for x in outs for o in b.get(x, ()))) for way, outs in a.items()}


def route(matrices: list[Matrix], end: int) -> list[tuple[State, State]]:
    """Each chunk's way in and out on the path from the document's start to its end."""
    tails: list[set[State]] = [{(end, end)}]
    for matrix in reversed(matrices):  # which ways in lead to the end
        tails.append({way for way, outs in matrix.items() if any(o in tails[-1] for o in outs)})
    tails.reverse()
    way, out = (0, 0), []
    for matrix, good in zip(matrices, tails[1:]):
        (nxt,) = [o for o in matrix[way] if o in good]
        out.append((way, nxt))
        way = nxt
    return out


def prefixed(text: str) -> str:
    """A text as the model sees it: a space in front, and spaces as pieces have them. Empty stays empty."""
    return (" " + text).replace(" ", chr(SPACE)) if text else ""


def _some(batches: Iterable[pa.RecordBatch], limit: int = SOME) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        sizes, at = pc.utf8_length(batch.column("text")).to_pylist(), 0
        while at < len(sizes):
            to, size = at, 0
            while to < len(sizes) and (to == at or size + sizes[to] <= limit):
                size += sizes[to]
                to += 1
            rows = batch.slice(at, to - at)
            yield rows, rows.column("text").to_pylist()
            at = to


def _lists(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))


def vocabulary(spark: SparkSession, path: str = MODEL) -> Broadcast:
    """The model's pieces, sent to the executors; their number is the model's."""
    return spark.sparkContext.broadcast(Vocabulary(path))


# What becomes of encoded rows: doc_id, text_sha256, ids, and where each row's begin -> columns.
Finish = Callable[[pa.Array, pa.Array, np.ndarray, np.ndarray], list]


def _finished(batch: pa.RecordBatch, finish: Finish, names: list[str]) -> pa.RecordBatch:
    ids = batch.column("ids")
    ends = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())]).astype(np.int64)
    return pa.RecordBatch.from_arrays(finish(batch.column("doc_id"), batch.column("text_sha256"), ids.flatten().to_numpy(), ends), names)


def _encoded(docs: DataFrame, known: Broadcast, chunk: int, schema: str, finish: Finish) -> DataFrame:
    """Per row of ``docs``: doc_id, text_sha256, and the ids of its whole text (null and empty: none).

    Other columns are not looked at; repeated rows are encoded each, an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    longest, names = known.value.longest, [c.split()[0] for c in schema.split(", ")]
    own = texts(docs).withColumn("text_sha256", F.sha2("text", 256))

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = known.value.encoder()
        for rows, values in _some(batches):
            ids, ends = encoder.encode([prefixed(v) for v in values])
            yield pa.RecordBatch.from_arrays(finish(rows.column("doc_id"), rows.column("text_sha256"), ids, ends), names)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = known.value.encoder()
        for rows, values in _some(batches):
            for doc_id, sha, value in zip(rows.column("doc_id").to_pylist(), rows.column("text_sha256").to_pylist(), values):
                text, key, out = prefixed(value), uuid.uuid4().hex, []
                cuts = [*range(0, len(text), chunk), len(text)]
                points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
                free = [True, *(bool(encoder.cuts(points[c - 1 : c + 1])[0]) for c in cuts[1:-1]), True]
                for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    a, b = max(0, lo - longest), min(len(text), hi + longest)
                    out.append((key, doc_id, sha, i, text[a:b], a, lo - a, hi - a, free[i], free[i + 1]))
                names = ["key", "doc_id", "text_sha256", "part", "text", "origin", "lo", "hi", "free_lo", "free_hi"]
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
                for k in range(0, len(out), 64):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[k : k + 64]), kinds)], names)

    def transfer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = known.value.encoder()
        for batch, _ in _some(batches):
            keys, parts, ends, found = [], [], [], []
            for r in batch.to_pylist():
                matrix = encoder.transfer(r["text"], r["origin"], r["lo"], r["hi"], r["free_lo"], r["free_hi"])
                keys.append(r["key"])
                parts.append(r["part"])
                ends.append(r["origin"] + r["hi"])
                found.append([[*way, *o] for way, outs in matrix.items() for o in outs])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(parts, pa.int32()), pa.array(ends, pa.int64()), pa.array(found, pa.list_(pa.list_(pa.int64())))],
                ["key", "part", "stop", "matrix"],
            )

    def combine(rows: pa.Table) -> pa.Table:
        order = sorted(rows.to_pylist(), key=lambda r: r["part"])
        matrices: list[Matrix] = []
        for r in order:
            matrix: Matrix = {}
            for a, b, c, d in r["matrix"]:
                matrix.setdefault((a, b), []).append((c, d))
            matrices.append(matrix)
        ways = route(matrices, order[-1]["stop"])
        return pa.table(
            {
                "key": pa.array([r["key"] for r in order]),
                "part": pa.array([r["part"] for r in order], pa.int32()),
                "way": pa.array([[*a, *b] for a, b in ways], pa.list_(pa.int64())),
            }
        )

    def back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = known.value.encoder()
        for batch, _ in _some(batches):
            ids = []
            for r in batch.to_pylist():
                way_in, way_out = tuple(r["way"][:2]), tuple(r["way"][2:])
                ids.append(np.array(encoder.path(r["text"], r["origin"], r["lo"], r["hi"], way_in, way_out), np.int32))
            ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "doc_id", "text_sha256", "part")), _lists(np.concatenate(ids), ends)],
                ["key", "doc_id", "text_sha256", "part", "ids"],
            )

    size = F.char_length("text")
    short = own.where(size < chunk).mapInArrow(whole, schema)
    chunks = own.where(size >= chunk).mapInArrow(
        cut,
        "key string, doc_id long, text_sha256 string, part int, text string, "
        "origin long, lo long, hi long, free_lo boolean, free_hi boolean",
    )
    chunks = written(chunks, "chunks")
    matrices = chunks.mapInArrow(transfer, "key string, part int, stop long, matrix array<array<long>>")
    ways = matrices.groupBy("key").applyInArrow(combine, "key string, part int, way array<long>")
    parts = chunks.join(ways, ["key", "part"]).select("key", "doc_id", "text_sha256", "part", "text", "origin", "lo", "hi", "way")
    traced = parts.mapInArrow(back, "key string, doc_id long, text_sha256 string, part int, ids array<int>")
    joined = traced.groupBy("key").agg(  # the chunks of one document make one row again
        F.first("doc_id").alias("doc_id"),
        F.first("text_sha256").alias("text_sha256"),
        F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("parts"),
    )
    joined = joined.select("doc_id", "text_sha256", F.flatten("parts.ids").alias("ids"))

    def whole_again(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SOME_ROWS):
                yield _finished(batch.slice(at, SOME_ROWS), finish, names)

    return short.unionByName(joined.mapInArrow(whole_again, schema))


def encode(docs: DataFrame, known: Broadcast, chunk: int = CHUNK) -> DataFrame:
    """Per row of ``docs``: doc_id and the ids of its whole text (null and empty: none).

    Other columns are not looked at; repeated rows are encoded each, an empty table gives no rows.
    """
    return _encoded(docs, known, chunk, "doc_id long, ids array<int>", lambda doc_id, sha, ids, ends: [doc_id, _lists(ids, ends)])


class Decoder:
    """Bytes of ids, without the space in front."""

    def __init__(self, v: Vocabulary):
        self.begin = np.concatenate([[0], np.cumsum([len(b) for b in v.bytes])])
        self.flat = np.frombuffer(b"".join(v.bytes), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        begin = self.begin[ids]
        sizes = self.begin[ids + 1] - begin
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(begin, sizes)
        raw = self.flat[place].tobytes()
        return raw[1:] if raw[:1] == b" " else raw


def decode(encoded: DataFrame, known: Broadcast) -> DataFrame:
    """``encoded`` with the text of its ids (null ids: null). Bytes that are no UTF-8 become U+FFFD."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(known.value)
        for batch in batches:
            ids = batch.column("ids")
            values = [None if v is None else decoder.decode(np.array(v, np.int64)).decode("utf-8", "replace") for v in ids.to_pylist()]
            yield batch.append_column("text", pa.array(values, pa.string()))

    prepare(encoded.sparkSession)
    return encoded.mapInArrow(run, encoded.drop("text").schema.add("text", "string"))


def _decoded(known: Broadcast, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Checksums of the decoded texts."""
    decoder = known.value.decoder()
    return pa.array(
        [hashlib.sha256(decoder.decode(ids[a:b].astype(np.int64))).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())],
        pa.string(),
    )


def encode_with_check(docs: DataFrame, known: Broadcast, chunk: int = CHUNK) -> DataFrame:
    """encode(), with n_tokens and exact: whether the ids decode to the text.

    A text that holds the character of SPACE itself decodes to a space there.
    """

    def finish(doc_id, sha, ids, ends):
        return [doc_id, _lists(ids, ends), pa.array(np.diff(ends)), pc.equal(_decoded(known, ids, ends), sha)]

    return _encoded(docs, known, chunk, "doc_id long, ids array<int>, n_tokens long, exact boolean", finish)


def digests(docs: DataFrame, known: Broadcast, chunk: int = CHUNK) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256 (of the ids as 4 little-endian bytes each), decoded_sha256, exact."""

    def finish(doc_id, sha, ids, ends):
        plain = np.ascontiguousarray(ids, "<i4")
        of_ids = [hashlib.sha256(plain[a:b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        decoded = _decoded(known, ids, ends)
        return [doc_id, pa.array(np.diff(ends)), pa.array(of_ids, pa.string()), decoded, pc.equal(decoded, sha)]

    return _encoded(
        docs, known, chunk, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean", finish
    )
