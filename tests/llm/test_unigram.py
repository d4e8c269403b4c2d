import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from quarterstone.llm import queries, unigram
from tests.llm.helpers import FOLDER, clashing, documents, tables

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = unigram.Model.load(PATH)
ENCODER = unigram.Encoder(MODEL)


def plain(model, text):
    """Viterbi over all pieces of the whole text, in one go."""
    if not text:
        return []
    text = "▁" + text.replace(" ", "▁")
    known = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k in (unigram.NORMAL, unigram.USER)}
    longest = max(map(len, known))
    best = [(0.0, 0, None)] + [None] * len(text)
    for start in range(len(text)):
        if best[start] is None:
            continue
        for end in range(start + 1, min(len(text), start + longest) + 1):
            piece = text[start:end]
            if piece in known:
                total, ids = best[start][0] + model.scores[known[piece]], [known[piece]]
            elif end == start + 1:
                total, ids = best[start][0] + model.unknown_score, model.ids_of_character(piece.encode())
            else:
                continue
            if best[end] is None or total > best[end][0]:
                best[end] = total, start, ids
    out, at = [], len(text)
    while at:
        out, at = best[at][2] + out, best[at][1]
    return out


def ids(text):
    return np.frombuffer(ENCODER.encode(pa.array([text]))[0], "<i4").tolist()


def score(model, found):
    return sum(model.scores[i] for i in found)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab the n▁\n\té日🙂　", max_size=40))
def test_best_sequence_and_round_trip(text):
    found = ids(text)
    assert found == plain(MODEL, text)
    assert MODEL.decode(np.array(found, int)) == text.replace("▁", " ")


def test_whole_texts_of_the_table(spark):
    texts = [t for t in tables("documents")["text"].to_pylist()[:25]]
    for text in texts:
        assert ids(text) == plain(MODEL, text)
    for r, text in zip(queries.op10_unigram_pieces(spark, FOLDER).orderBy("doc_id").limit(25).collect(), texts):
        found = plain(MODEL, text)
        assert (r.n_ids, r.ids_crc32, r.decoded_chars, r.lossless) == (
            len(found), zlib.crc32(np.array(found, "<i4").tobytes()), len(text), True)


def test_equals_the_library_on_a_unigram_file():
    """The same pieces read as a Unigram model by the library; its sums are single precision, so
    only texts without fallback characters compare."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    for text in tables("documents")["text"].to_pylist()[:80]:
        for line in text.split("\n"):
            words = " ".join(line.split()[:12])
            found, theirs = ids(words), library.encode(words)
            assert found == theirs or score(MODEL, found) >= score(MODEL, theirs)


def test_small_model_without_bytes():
    rows = [("<unk>", 0.0, unigram.UNKNOWN), ("▁", -2.0, 1), ("a", -1.0, 1), ("ab", -1.5, 1), ("b", -1.0, 1), ("▁a", -2.5, 1), ("bb", -2.0, 1)]
    model = unigram.Model.of(rows)
    encoder = unigram.Encoder(model)
    for text in ["ab", "abb", "aab b", "", "q", "b  a", "é a"]:
        assert np.frombuffer(encoder.encode(pa.array([text]))[0], "<i4").tolist() == plain(model, text)


def test_trie():
    trie = unigram.Trie.build([(w.encode(), i) for i, w in enumerate(["a", "ab", "b", "日本", "日"])])
    for word, number in (("a", 0), ("ab", 1), ("b", 2), ("日本", 3), ("日", 4)):
        state = 0
        for c in word.encode():
            there = trie.base[state] + c
            assert trie.check[there] == state
            state = there
        assert trie.value[state] == number


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "text"), (3, "  two  blanks "), (4, "x" * 50_000), (5, "wörter " * 20_000)]
    coded = unigram.decode(unigram.encode(clashing(documents(spark, rows), "ids", "decoded"), PATH), PATH).collect()
    assert len(coded) == len(rows)
    assert sorted((str(r.doc_id), r.decoded) for r in coded) == sorted((str(d), t or "") for d, t in rows)
    assert unigram.encode(documents(spark, []), PATH).count() == 0
