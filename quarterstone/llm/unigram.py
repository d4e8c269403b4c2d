"""SentencePiece encoding by Unigram Viterbi search over a double-array trie, and decoding.

A text is written with a leading blank and every blank as the marker U+2581; the best sequence of
pieces has the largest sum of scores, ties to the longer last piece. A character that no piece
covers alone is passed at the lowest score less ten and encoded as byte pieces (or the unknown id).
Decoding joins pieces, turns byte pieces into bytes and markers into blanks, and drops the leading
blank. Piece files are read, never trained.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.llm.common import tidied

MARK = "▁"
RUNS = re.compile(f"{MARK}+[^{MARK}]*")
UNKNOWN_PENALTY = 10.0
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6  # kinds of pieces, fixed by the file format


@dataclass
class Trie:
    """Double array: the child of state s for byte c is t = base[s] + c if check[t] == s; value[t]
    is the piece that ends there, or -1. State 0 is the root."""
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @staticmethod
    def build(words: list[tuple[bytes, int]]) -> "Trie":
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for word, number in words:
            node = 0
            for c in word:
                following = children[node].get(c)
                if following is None:
                    following = len(children)
                    children[node][c] = following
                    children.append({})
                    ends.append(-1)
                node = following
            ends[node] = number
        room = 2 * len(children) + 1024
        base, check, value = np.zeros(room, np.int32), np.full(room, -1, np.int32), np.full(room, -1, np.int32)
        taken = bytearray(room)
        taken[0] = 1
        value[0] = ends[0]
        lowest, todo = 1, [(0, 0)]  # (trie node, its state)
        while todo:
            node, state = todo.pop()
            codes = sorted(children[node])
            if not codes:
                continue
            at = taken.find(0, lowest)
            if len(codes) == 1:
                lowest = at
            while True:  # the first free cell where all children fit
                start = at - codes[0]
                if start >= 0 and start + 256 < room and not any(taken[start + c] for c in codes):
                    break
                at = taken.find(0, at + 1)
                if at < 0 or at + 512 >= room:
                    grow = room
                    taken.extend(bytes(grow))
                    base, check, value = (np.append(x, np.full(grow, fill, np.int32)) for x, fill in ((base, 0), (check, -1), (value, -1)))
                    room += grow
                    at = at if at >= 0 else room - grow
            base[state] = start
            for c in codes:
                taken[start + c] = 1
                check[start + c] = state
                value[start + c] = ends[children[node][c]]
                todo.append((children[node][c], start + c))
        return Trie(base, check, value)


@dataclass
class Model:
    pieces: list[str]
    scores: np.ndarray
    kinds: list[int]
    trie: Trie = field(repr=False)

    @staticmethod
    def load(path: str) -> "Model":
        """Pieces, scores and kinds of a SentencePiece file, whatever it was trained as."""
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        return Model.of([(p.piece, p.score, p.type) for p in proto.pieces])

    @staticmethod
    def of(rows: list[tuple[str, float, int]]) -> "Model":
        pieces, scores, kinds = (list(x) for x in zip(*rows))
        for piece, _, kind in rows:  # a marker after another character must begin a word of its own
            if kind in (NORMAL, USER) and MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} crosses a blank; such models are not supported")
        words = [(p.encode(), i) for i, (p, _, k) in enumerate(rows) if k in (NORMAL, USER) and p]
        return Model(pieces, np.array(scores, np.float64), kinds, Trie.build(words))

    @cached_property
    def byte_ids(self) -> dict[int, int]:
        return {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}

    @cached_property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)

    @cached_property
    def unknown_score(self) -> float:
        return min(s for s, k in zip(self.scores, self.kinds) if k in (NORMAL, USER)) - UNKNOWN_PENALTY

    @cached_property
    def raw(self) -> np.ndarray:
        """Bytes each id decodes to; control pieces to nothing."""
        out = np.empty(len(self.pieces), object)
        for i, (piece, kind) in enumerate(zip(self.pieces, self.kinds)):
            out[i] = (bytes([int(piece[3:5], 16)]) if kind == BYTE else b" \xe2\x81\x87 " if kind == UNKNOWN
                      else piece.replace(MARK, " ").encode() if kind in (NORMAL, USER) else b"")
        return out

    def ids_of_character(self, raw: bytes) -> list[int]:
        return [self.byte_ids[b] for b in raw] if len(self.byte_ids) == 256 else [self.unknown]

    def words(self, words: list[bytes]) -> list[list[int]]:
        """Best ids of words (each with its markers). Words of like length are searched together:
        one step moves all of them along the trie."""
        out: list[list[int]] = [[]] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        start = 0
        while start < len(order):
            longest = int(sizes[order[start]]) * 2 + 8
            stop = min(int(np.searchsorted(sizes[order], longest, side="right")), start + max(1, (1 << 19) // longest))
            rows = order[start:stop]
            for row, ids in zip(rows.tolist(), self._together([words[i] for i in rows])):
                out[row] = ids
            start = stop
        return out

    def _together(self, words: list[bytes]) -> list[list[int]]:
        n, width = len(words), max(map(len, words))
        sizes = np.fromiter(map(len, words), np.int64, n)
        codes = np.zeros((n, width + 4), np.uint8)
        flat = np.frombuffer(b"".join(words), np.uint8)
        codes[np.repeat(np.arange(n), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        lead = codes[:, :width]
        char = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4))).astype(np.int64)
        best = np.full((n, width + 5), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, width + 5), np.int32)
        chosen = np.full((n, width + 5), -1, np.int32)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        for p in range(width):
            rows = np.flatnonzero((sizes > p) & (best[:, p] > -np.inf))
            if not len(rows):
                continue
            first = best[rows, p]
            end_of_one = p + char[rows, p]
            alone = np.zeros(n, bool)
            live, state, q = rows, np.zeros(len(rows), np.int64), p
            so_far = first
            while len(live):
                there = base[state] + codes[live, q].astype(np.int64)
                good = (check[there] == state) & (sizes[live] > q)
                live, state, so_far = live[good], there[good], so_far[good]
                q += 1
                piece = value[state]
                hit = piece >= 0
                if hit.any():
                    r, ids = live[hit], piece[hit]
                    total = so_far[hit] + self.scores[ids]
                    alone[r[q == p + char[r, p]]] = True
                    better = total > best[r, q]
                    r = r[better]
                    best[r, q], back[r, q], chosen[r, q] = total[better], p, ids[better]
            lost = ~alone[rows]
            if lost.any():
                r, end = rows[lost], np.minimum(end_of_one[lost], sizes[rows[lost]])
                total = first[lost] + self.unknown_score
                better = total > best[r, end]
                r, end = r[better], end[better]
                best[r, end], back[r, end], chosen[r, end] = total[better], p, -1
        out = []
        back_, chosen_ = back.tolist(), chosen.tolist()
        for word, at, b, c in zip(words, sizes.tolist(), back_, chosen_):
            ids: list[int] = []
            while at > 0:
                before = b[at]
                ids += [c[at]] if c[at] >= 0 else reversed(self.ids_of_character(word[before:at]))
                at = before
            out.append(ids[::-1])
        return out

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(self.raw[ids])
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


class Encoder:
    """Ids of whole texts; each distinct word is searched once. ``keep`` bounds the words remembered."""

    def __init__(self, model: Model, keep: int = 300_000):
        self.model, self.keep, self.known = model, keep, {}

    def lookup(self, words: list[str]) -> list[np.ndarray]:
        found = list(map(self.known.get, words))
        new = [w for w, ids in zip(words, found) if ids is None]
        if new:
            if len(self.known) + len(new) > self.keep:  # keep what this slice has met again
                self.known = {w: ids for w, ids in zip(words, found) if ids is not None}
            ids = self.model.words([w.encode("utf-8", "surrogatepass") for w in new])
            self.known.update((w, np.array(i, "<i4").tobytes()) for w, i in zip(new, ids))
            found = list(map(self.known.__getitem__, words))
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text; an empty text has none. Words begin at single
        blanks; a text with other blanks is cut at its blank runs instead."""
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), MARK, " ")
        runs = pc.match_substring_regex(texts, "(^ |  | $|^$)").to_numpy(zero_copy_only=False).astype(bool)
        out: list[bytes] = [b""] * len(texts)
        for row in np.flatnonzero(runs).tolist():
            if text := texts[row].as_py():
                out[row] = b"".join(self.lookup(RUNS.findall(MARK + text.replace(" ", MARK))))
        rows = np.flatnonzero(~runs)
        lists = pc.split_pattern(texts.take(pa.array(rows)), " ")
        coded = lists.flatten().dictionary_encode()
        table = np.empty(len(coded.dictionary) + 1, object)
        table[:] = [*self.lookup([MARK + w for w in coded.dictionary.to_pylist()]), None]
        joined = table[coded.indices.to_numpy()]
        ends = (np.asarray(lists.offsets) - int(lists.offsets[0].as_py())).tolist()
        for row, a, b in zip(rows.tolist(), ends, ends[1:]):
            out[row] = b"".join(joined[a:b])
        return out


def _encode_batches(shared, text: int, most: int = 1 << 22):
    from quarterstone.llm.terms import slices

    def run(batches):
        encoder = Encoder(shared.value)
        for batch in batches:
            for part in slices(batch, text, most):
                rows = encoder.encode(part.column(text))
                ends = np.cumsum([0, *(len(r) // 4 for r in rows)])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(rows), "<i4")))
                crcs = pa.array([zlib.crc32(r) for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, ids, crcs], [*part.schema.names, "ids", "ids_crc32"])
    return run


def _decode_batches(shared, ids: int):
    def run(batches):
        model = shared.value
        for batch in batches:
            lists = batch.column(ids)
            values, ends = lists.flatten().to_numpy(), np.asarray(lists.offsets)
            ends = (ends - ends[0]).tolist()
            texts = [model.decode(values[a:b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])
    return run


def _kinds(frame: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Every row with ``ids`` (array<int>) and ``ids_crc32`` of its whole text (unsigned, over the ids
    as little-endian 32-bit integers). A null text counts as empty and has no ids. The model, as
    large as its vocabulary, is broadcast; columns named ids, ids_crc32 or decoded are replaced."""
    rows = docs.drop("ids", "ids_crc32", "decoded")
    shared = docs.sparkSession.sparkContext.broadcast(Model.load(path))
    return rows.mapInArrow(tidied(_encode_batches(shared, rows.columns.index("text"))), _kinds(rows) + "ids array<int>, ids_crc32 long")


def _round_trip_batches(shared, text: int):
    encode_, decode_ = _encode_batches(shared, text), _decode_batches(shared, -2)

    def run(batches):
        return decode_(encode_(batches))
    return run


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``encode`` and ``decode`` in one pass, so that a task needs one Python process."""
    rows = docs.drop("ids", "ids_crc32", "decoded")
    shared = docs.sparkSession.sparkContext.broadcast(Model.load(path))
    return rows.mapInArrow(tidied(_round_trip_batches(shared, rows.columns.index("text"))),
                           _kinds(rows) + "ids array<int>, ids_crc32 long, decoded string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Every row with ``decoded``, the text that its ``ids`` stand for; no ids: the empty text."""
    rows = encoded.drop("decoded").withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))
    shared = encoded.sparkSession.sparkContext.broadcast(Model.load(path))
    return rows.mapInArrow(tidied(_decode_batches(shared, rows.columns.index("ids"))), _kinds(rows) + "decoded string")
