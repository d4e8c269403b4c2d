import hashlib
import re

import numpy as np
import pytest

from quarterstone.llm import infill, queries
from tests.llm.helpers import FOLDER, clashing, documents, tables


def plain(text, doc_id, seed=7, rate=100, spm=50):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return "plain", len(units), None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm:
        return "spm", len(units), len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return "psm", len(units), len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in tables("documents").to_pylist()}
    got = queries.op12_infill_pieces(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        form, n, prefix, middle, output = plain(texts[r.doc_id], r.doc_id)
        assert (r.form, r.n, r.prefix_chars, r.middle_chars) == (form, n, prefix, middle)
        assert (r.output_sha256, r.restored_sha256) == (sha(output), sha(texts[r.doc_id]))
    assert {r.form for r in got} >= {"psm", "spm"}


TEXTS = [None, "", "\n", "\n\n\n", "a", "a\n", "\na", "a\r\nb\rc d\n", "é\n\U0001F600\nñ", "<P>", "x <S> y\nz", "a<M>", "<", "<P\n>S>\n<M", "P>\n<S",
         "<\n<\n<", "x\n" * 30_000, "y" * 300_000]


@pytest.mark.parametrize("rate,spm,size", [(100, 50, 1 << 22), (100, 0, 1), (60, 100, 64)])
def test_odd_texts_and_round_trip(spark, rate, spm, size):
    rows = [(100 * k + i, t) for k in range(6) for i, t in enumerate(TEXTS)] + [(None, "a\nb\nc"), (7, "a\nb"), (7, "a\nb")]
    docs = clashing(documents(spark, rows), "output", "form", "n")
    arranged = infill.transform(docs, rate=rate, spm=spm, size=size)
    got = sorted((tuple(r) for r in arranged.collect()), key=str)
    want = sorted(((i, *plain(t, i, 7, rate, spm), sha(plain(t, i, 7, rate, spm)[4])) for i, t in rows), key=str)
    assert got == want
    back = infill.restore(arranged, size=size).collect()
    assert sorted(((r.doc_id, r.text, r.restored_sha256) for r in back), key=str) == sorted(((i, t or "", sha(t)) for i, t in rows), key=str)
    assert infill.restore(infill.transform(documents(spark, []))).count() == 0


def test_columns_are_carried(spark):
    docs = documents(spark, [(1, "a\nb", "s1")])
    row = infill.transform(docs, columns=("source", "lang")).first()
    assert (row.source, row.lang, row.doc_id) == ("s1", "en", 1)


def test_piece_table_shares_its_buffers():
    draw = np.random.default_rng(1)
    text = bytes(draw.integers(97, 123, 1000).astype(np.uint8))
    table = infill.PieceTable.of(text)
    for _ in range(200):
        places = sorted(draw.integers(0, len(text) + 1, 4).tolist())
        cut = table.cut(*places)
        assert [p.end - p.start for p in cut.pieces] == np.diff([0, *places, len(text)]).tolist()
        order = tuple(int(i) for i in draw.permutation(5))
        mixed = cut.permuted(order)
        assert mixed.written() == b"".join(text[a:b] for a, b in [(cut.pieces[i].start, cut.pieces[i].end) for i in order])
        assert mixed.restored(order).written() == text and mixed.restored(order).sha256() == hashlib.sha256(text).hexdigest()
        # cutting again goes by places of the permuted text, across pieces
        again = mixed.cut(*sorted(draw.integers(0, len(text) + 1, 2).tolist()))
        assert again.written() == mixed.written() and all(p.buffer.obj is text for p in again.pieces)


def test_output_without_its_sentinels_is_an_error():
    with pytest.raises(ValueError):
        infill.rebuild(b"<P>a<S>b", "psm")
