"""Token-id files: length-delimited, checksummed binary records with a separate offset index.

A data folder holds files whose names, and the records within them, follow ascending doc_id.
One record is, all integers little-endian:

    u64  payload length          u32  masked CRC-32 of those eight bytes
    payload                      u32  masked CRC-32 of the payload
    one byte 0x0A

and a payload is ``u8 has_id, u8 width, i64 doc_id`` and the ids in ``width`` (2 or 4) bytes each,
2 where the whole vocabulary and the end id fit. The mask rotates the checksum right by
15 bits and adds a constant, so that a checksum stored inside checksummed data stays harmless.
Files are written through Spark's own committed text writer (a record's bytes are the line), so
a lost executor or a repeated task leaves neither gaps nor repeated records, on any file system
Spark can reach. The index folder holds one Parquet row per record with file, offset and length.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterstone.llm.common import tidied

MASK = 0xA282EAD8
HEAD, TAIL, ID = struct.Struct("<QI"), struct.Struct("<I"), struct.Struct("<BBq")
END = b"\n"
ROWS_AT_ONCE = 2000  # texts handed to a task's encoder together


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """One record without its end byte."""
    payload = ID.pack(doc_id is not None, width, doc_id or 0) + ids
    size = struct.pack("<Q", len(payload))
    return size + TAIL.pack(masked(size)) + payload + TAIL.pack(masked(payload))


def frames(content: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, length, doc_id, ids) of each record; raises on any damage."""
    at, view = 0, memoryview(content)
    while at < len(view):
        size, check = HEAD.unpack_from(view, at)
        if check != masked(bytes(view[at:at + 8])):
            raise ValueError(f"record at {at}: length checksum differs")
        start, end = at + HEAD.size, at + HEAD.size + size
        payload = view[start:end]
        if len(payload) != size or TAIL.unpack_from(view, end)[0] != masked(payload):
            raise ValueError(f"record at {at}: payload checksum differs")
        has_id, width, doc_id = ID.unpack_from(payload)
        end += TAIL.size + len(END)
        yield at, end - at, doc_id if has_id else None, np.frombuffer(payload[ID.size:], f"<u{width}").astype("<u4")
        at = end


class Encoder:
    """Ids of whole texts, equal to the library's, with each distinct word encoded once.

    The tokenizer's pattern never joins a non-blank and a following space, so a text whose
    spaces all stand after a non-blank falls into independent pieces before each space. Pieces
    are encoded together in one call and cut apart by the byte length of each id; a text with
    other blank runs is encoded whole. The ids of all remembered words lie in one array; a word
    has a place there, a text is one gathering of places. ``keep`` bounds the words remembered from one slice to the next.
    """

    RUN = r"(^|[\s\p{Z}\x{85}\x1c-\x1f\x0b]) "

    def __init__(self, path: str, end_id: int = 0, keep: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism; a pool costs memory
        from tokenizers import Tokenizer

        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # byte-level: one character of a token is one byte
            self.sizes[i] = len(added[i].encode()) if i in added else len(token)
        self.width = 2 if max(len(self.sizes) - 1, end_id) < 1 << 16 else 4
        self.end = end_id.to_bytes(self.width, "little")
        self.marks = {mark: int(self.whole([mark])[0][0]) for mark in ".,"}
        self.known: dict[str, int] = {}  # word -> place
        self.ids, self.starts = np.zeros(0, f"<u{self.width}"), np.zeros(1, np.int64)  # of each place, and the end
        self.used = np.zeros(0, np.int64)  # how often each place was met

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, f"<u{self.width}") for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def gathered(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some places in a row, and how many each has."""
        counts = self.starts[places + 1] - self.starts[places]
        at = np.repeat(self.starts[places] - np.cumsum(counts) + counts, counts)
        at += np.arange(len(at))
        return self.ids[at], counts

    def _remember(self, words: list[str], ids: list[np.ndarray], counts: list[np.ndarray]) -> None:
        first = len(self.starts) - 1
        self.known.update(zip(words, range(first, first + len(words))))
        self.ids = np.concatenate([self.ids, *ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(counts))])

    def learn(self, words: list[str]) -> None:
        """Remember the ids of each word with a space before it. A mark after Latin letters is a
        piece of its own by the tokenizer's pattern, so such words share their letters' ids."""
        marks = [w[-1] if w.endswith((".", ",")) and w[:-1].isalpha() and (w.isascii() or max(w) < "\u0250") else "" for w in words]
        bases = [w[:-1] if m else w for w, m in zip(words, marks)]
        new = [b for b in dict.fromkeys(bases) if b not in self.known]
        found, counts = [], []
        for start in range(0, len(new), 4096):
            part = new[start:start + 4096]
            ids = self.whole([" " + " ".join(part)])[0]
            ends = np.cumsum(self.sizes[ids])
            stops = np.cumsum(np.fromiter(map(len, part) if "".join(part).isascii() else (len(w.encode()) for w in part), np.int64, len(part)) + 1)
            cut = np.searchsorted(ends, stops) + 1
            if cut[-1] != len(ids) or not np.array_equal(ends[cut - 1], stops):
                pieces = self.whole([" " + w for w in part])
                ids, cut = np.concatenate(pieces), np.cumsum([len(p) for p in pieces])
            found.append(ids)
            counts.append(np.diff(cut, prepend=0))
        if new:
            self._remember(new, found, counts)
        marked = [(w, b, m) for w, b, m in zip(words, bases, marks) if m]
        if marked:
            ids, sizes = self.gathered(np.fromiter((self.known[b] for _, b, _ in marked), np.int64, len(marked)))
            after = np.array([self.marks[m] for _, _, m in marked], ids.dtype)
            self._remember([w for w, _, _ in marked], [np.insert(ids, np.cumsum(sizes), after)], [sizes + 1])

    def places(self, words: list[str], times: np.ndarray) -> np.ndarray:
        """The place of each word, learned where it is not known; ``times`` is how often each occurs."""
        if len(self.known) > self.keep:
            self._forget()
        found = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [words[i] for i in missing]
            self.learn(new)
            found[missing] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
            self.used = np.concatenate([self.used, np.zeros(len(self.starts) - 1 - len(self.used), np.int64)])
        self.used[found] += times
        return found

    def _forget(self) -> None:
        """Keep the words met most often, two thirds of as many as may be remembered; what was met long ago counts less."""
        kept = np.sort(np.argsort(-self.used, kind="stable")[:self.keep * 2 // 3])
        words = list(self.known)  # in the order of their places
        ids, counts = self.gathered(kept)
        self.known, self.ids, self.starts = {}, ids[:0], np.zeros(1, np.int64)
        self.used = self.used[kept] // 2
        if len(kept):
            self._remember([words[i] for i in kept.tolist()], [ids], [counts])

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian integers of ``width`` bytes."""
        texts = texts.cast(pa.string())
        odd = pc.match_substring_regex(texts, self.RUN).to_numpy(zero_copy_only=False).astype(bool)
        out: list[bytes] = [b""] * len(texts)
        rows = np.flatnonzero(odd)
        for row, ids in zip(rows, self.whole([texts[int(i)].as_py() for i in rows]) if len(rows) else []):
            out[row] = ids.tobytes()
        rows = np.flatnonzero(~odd)
        if not len(rows):
            return out
        lists = pc.split_pattern(texts.take(pa.array(rows)), " ")
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        starts = bounds[:-1]
        words = coded.dictionary
        others = np.ones(len(codes), bool)
        others[starts] = False
        times = np.bincount(codes[others], minlength=len(words))
        used = np.flatnonzero(times)
        table = np.zeros(len(words), np.int64)
        table[used] = self.places(words.take(pa.array(used)).to_numpy(zero_copy_only=False).tolist(), times[used])
        # the first word of a text has no space before it; such words are not remembered
        firsts, which = np.unique(codes[starts], return_inverse=True)
        heads = self.whole(words.take(pa.array(firsts)).to_pylist())
        ids, counts = self.gathered(table[codes[others]])
        ends = np.concatenate([[0], np.cumsum(counts)])
        for k, row in enumerate(rows.tolist()):  # a text's other words lie behind those of the texts before
            a, b = ends[bounds[k] - k], ends[bounds[k + 1] - k - 1]
            out[row] = heads[which[k]].tobytes() + ids[a:b].tobytes()
        return out


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder_of(path: str, end_id: int) -> Encoder:
    """One encoder for a worker process: a later task goes on with the words that earlier ones met."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, end_id] = Encoder(path, end_id)
    return _ENCODERS[path, end_id]


def encode_batches(path: str, end_id: int, records_per_file: int, file_bytes: int, most: int = 6 << 20):
    """Records with the file of the task each goes to and its place there."""
    def run(batches):
        encoder, file, held, size = encoder_of(path, end_id), 0, 0, 0
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy())
            start = 0
            while start < batch.num_rows:  # a slice of about ``most`` bytes of text
                stop = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + most)) + 1
                part = batch.slice(start, stop - start)
                frames_ = [frame(d, x + encoder.end, encoder.width)
                           for d, x in zip(part.column(0).to_pylist(), encoder.encode(part.column(1)))]
                files, places = [], []
                for record in frames_:
                    if held and (held >= records_per_file or size + len(record) + len(END) > file_bytes):
                        file, held, size = file + 1, 0, 0
                    files.append(file)
                    places.append(held)
                    held, size = held + 1, size + len(record) + len(END)
                yield pa.RecordBatch.from_arrays([pa.array(files, pa.int32()), pa.array(places, pa.int64()), pa.array(frames_, pa.binary())],
                                                 ["slice", "place", "frame"])
                start = stop
    return run


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2,
                  records_per_file: int = 8192, file_bytes: int = 64 << 20) -> None:
    """Encode every whole text and write data files in ascending doc_id order under ``path``/data.

    A null text counts as empty, a null doc_id sorts first; rows that share a doc_id follow each
    other by a hash of their text, by which they may also lie in several tasks. Each document ends with ``end_id``.
    Memory per task is bounded by a slice of rows and the remembered words; a file holds at most ``records_per_file`` records
    and ``file_bytes`` bytes, or one longer record. An empty table gives a folder without records.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    frames_ = (rows.repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key", "text").select("doc_id", "text")
               .mapInArrow(tidied(encode_batches(tokenizer, end_id, records_per_file, file_bytes)), "slice int, place long, frame binary")
               .sortWithinPartitions("slice", "place").select("slice", F.col("frame").cast("string").alias("value")))
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, min(int(before), ROWS_AT_ONCE) if int(before) > 0 else ROWS_AT_ONCE)
    try:
        frames_.write.option("lineSep", END.decode()).partitionBy("slice").text(f"{path}/data")
    finally:
        conf.set(key, before)


def _index_batches(batches):
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["file", "doc_id", "offset", "length", "n_tokens", "before", "ids_crc32"]
    for batch in batches:
        for row in range(batch.num_rows):
            file, before, out = batch.column(0)[row].as_py(), 0, []
            for at, size, doc_id, ids in frames(batch.column(1)[row].as_py()):
                n = len(ids)
                out.append((file, doc_id, at, size, n, before, zlib.crc32(ids.tobytes())))
                before += n
            columns = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _file_name() -> Column:
    """A file's name, the number of its task first, and which of the task's files it is: names sort as records do."""
    parts = F.split("path", "/")
    return F.concat(F.element_at(parts, -1), F.lit("-"), F.lpad(F.element_at(F.split(F.element_at(parts, -2), "="), -1), 9, "0"))


def read_contents(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/data")
            .filter(F.col("length") > 0)
            .select(_file_name().alias("file"), "content"))


def write_index(spark: SparkSession, path: str) -> DataFrame:
    """Read all data files back, check every checksum, and write and return the offset index:
    file, doc_id, offset, length, n_tokens, before (ids in earlier records of the file), ids_crc32."""
    (read_contents(spark, path).mapInArrow(
        tidied(_index_batches), "file string, doc_id long, offset long, length long, n_tokens long, before long, ids_crc32 long")
     .write.parquet(f"{path}/index"))
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``: all ids before a record. Only one total per file is ordered in
    one place; everything else stays where it is."""
    ends = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = (index.groupBy("file").agg(F.sum("n_tokens").alias("ids"))
              .select("file", F.coalesce(F.sum("ids").over(ends), F.lit(0)).alias("earlier")))
    return index.join(totals, "file").withColumn("start", F.col("earlier") + F.col("before")).drop("earlier")


def shuffled(index: DataFrame, seed: int = 0) -> DataFrame:
    """The index in a seeded order for shuffled reads: where each record is, nothing of its content."""
    return index.orderBy(F.xxhash64(F.lit(seed), "file", "offset"), "file", "offset")


def _pick_batches(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            content = batch.column(1)[row].as_py()
            rows = []
            for wanted in batch.column(2)[row].as_py():
                start = wanted["offset"]
                _, _, doc_id, ids = next(frames(content[start:start + wanted["length"]]))
                rows.append((wanted["place"], doc_id, ids.astype(np.int64)))
            columns = list(zip(*rows)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.list_(pa.int64()))], ["place", "doc_id", "ids"])


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records at the index rows ``wanted`` (place, file, offset, length): place, doc_id, ids.
    A file is read once for all of its wanted records; a record is cut out by its offset."""
    lists = wanted.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("place", "offset", "length"))).alias("at"))
    return (read_contents(spark, path).join(lists, "file").select("file", "content", "at")
            .mapInArrow(tidied(_pick_batches), "place long, doc_id long, ids array<bigint>"))
