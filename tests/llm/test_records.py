import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarterstone.llm import queries, records
from quarterstone.session import shared_dir
from tests.llm.helpers import FOLDER, clashing, documents, tables

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def written(spark, docs):
    path = shared_dir(spark, "test-records")
    records.write_records(docs, path, PATH, records_per_file=3)
    index = records.with_starts(records.write_index(spark, path))
    return path, index


def test_query_equals_the_library_on_whole_texts(spark):
    table = tables("documents").select(["doc_id", "text"]).to_pylist()
    want = expected(sorted((r["doc_id"], r["text"]) for r in table))
    got = [tuple(r)[:4] for r in queries.op1_token_records(spark, FOLDER).orderBy("doc_id").collect()]
    assert got == want


def test_odd_texts(spark):
    texts = ["", None, " ", "  a  b ", "a\n\n b\tc \n", "x<|endoftext|>y", "don't stop, re.\nNext", "é" * 3000,
             "word " * 5000, "  nb  sp", "a b", "a b", "tail,", "1,000. 2'll!", "…, ", "ﬁ, ǅ. ß,"]
    rows = [(None, "null id comes first"), *enumerate(texts)]
    _, index = written(spark, clashing(documents(spark, rows), "frame", "file", "start"))
    got = [tuple(r) for r in index.orderBy(index.doc_id.asc_nulls_first()).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert got == expected(rows)


def test_repeated_rows_and_empty_table(spark):
    _, index = written(spark, documents(spark, [(1, "a b"), (1, "a b"), (1, "c")]))
    got = [(r.start, r.n_tokens) for r in index.orderBy("start").collect()]  # rows of one doc_id go by a hash
    assert got in ([(0, 3), (3, 3), (6, 2)], [(0, 2), (2, 3), (5, 3)])
    _, index = written(spark, documents(spark, []))
    assert index.count() == 0


def test_shuffled_reads(spark):
    path, index = written(spark, documents(spark, [(i, f"text number {i}") for i in range(10)]))
    order = records.shuffled(index, seed=3).collect()
    assert sorted(r.doc_id for r in order) == list(range(10)) and [r.doc_id for r in order] != list(range(10))
    wanted = spark.createDataFrame([(k, r.file, r.offset, r.length) for k, r in enumerate(order[:4])],
                                   "place bigint, file string, offset bigint, length bigint")
    got = records.fetch(spark, path, wanted).orderBy("place").collect()
    tokenizer = Tokenizer.from_file(PATH)
    assert [tokenizer.decode(r.ids[:-1]) for r in got] == [f"text number {r.doc_id}" for r in order[:4]]


def test_damage_is_found():
    good = records.frame(5, np.array([1, 2], "<u2").tobytes(), 2) + b"\n"
    assert [(a, n, d, x.tolist()) for a, n, d, x in records.frames(good + good)] == [
        (0, len(good), 5, [1, 2]), (len(good), len(good), 5, [1, 2])]
    for at in (0, 14, 25):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(records.frames(bytes(bad)))


def test_files_are_bounded_by_bytes_and_records(spark):
    rows = [(i, "long text " * (400 if i % 7 == 0 else 3)) for i in range(60)] + [(None, "x")] * 9
    path = shared_dir(spark, "test-records")
    records.write_records(documents(spark, rows), path, PATH, records_per_file=10, file_bytes=1500)
    files = records.write_index(spark, path).groupBy("file").agg(F.count("*").alias("n"), F.sum("length").alias("size"))
    sizes = {r.file: (r.n, r["size"]) for r in files.collect()}
    assert len(sizes) > 10 and all(n <= 10 and (size <= 1500 or n == 1) for n, size in sizes.values())
    index = records.with_starts(records.read_index(spark, path))
    got = [tuple(r) for r in index.orderBy("start").select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert got == expected(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))


def test_one_doc_id_on_all_rows_lies_in_several_tasks(spark):
    texts = [f"words {i} of many" for i in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path, index = written(spark, documents(spark, [(5, t) for t in texts]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r.file.split("-")[1] for r in index.select("file").distinct().collect()}) > 1
    tokenizer = Tokenizer.from_file(PATH)
    sizes = sorted(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in texts)
    assert sorted(r.n_tokens for r in index.collect()) == sizes
    assert [r.start for r in index.orderBy("start").collect()][0] == 0 and index.select("start").distinct().count() == 400


def test_words_are_remembered_within_a_bound():
    import pyarrow as pa

    encoder = records.Encoder(PATH, 2, keep=40)
    tokenizer = Tokenizer.from_file(PATH)
    draw = np.random.default_rng(1)
    for _ in range(20):
        words = np.array([*"abcdefgh", "Haus", "straße.", "été,", "don't", "x1.", "日本", "$$$", "a,b.", "...", "end.", "<|endoftext|>"])
        texts = [" ".join(f"{w}{draw.integers(0, 30) if draw.random() < 0.7 else ''}" for w in draw.choice(words, draw.integers(0, 30))) for _ in range(5)]
        got = [np.frombuffer(x, f"<u{encoder.width}").tolist() for x in encoder.encode(pa.array(texts))]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encoder.starts) - 1 <= 400 and len(encoder.ids) == encoder.starts[-1]
