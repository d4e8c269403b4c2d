from collections import Counter

import corpus_pipeline
from quarterstone.llm import lines, simhash, toxicity
from quarterstone.llm.common import load, stored
from tests.llm.helpers import FOLDER, documents, tables
from tests.llm.test_lines import brute
from tests.llm.test_simhash import classes, plain


def test_stages_in_order_on_the_table(spark):
    docs, kept = load(spark, FOLDER, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), "stage")
        kept[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
    table = {r["doc_id"]: r for r in tables("documents").to_pylist()}
    labels = {r["doc_id"]: r["toxic"] for r in tables("labels").to_pylist()}
    left = {r.doc_id for r in kept["toxicity"]}
    wrong = [d for d, toxic in labels.items() if (d in left) == bool(toxic)]
    assert len(wrong) <= 0.03 * len(labels)
    order = sorted(left)
    cut = dict(zip(order, brute([table[d]["text"] for d in order], lines.LEAST_WORDS)))
    assert {r.doc_id: r.text for r in kept["line dedup"]} == cut
    prints = [plain(cut[d]) for d in order]
    assert sorted(r.doc_id for r in kept["SimHash near-dedup"]) == sorted(set(classes(order, prints)))
    texts = {r.doc_id: r.text for r in kept["SimHash near-dedup"]}
    whole = Counter(r.doc_id for r in kept["mixing"] if r.text == texts[r.doc_id])
    assert all(r.doc_id in texts and (r.text == texts[r.doc_id] or " ".join(texts[r.doc_id].split()).startswith(r.text)) for r in kept["mixing"])
    assert max(whole.values()) <= 3
    assert Counter((r.doc_id, r.text) for r in kept["SentencePiece"]) == Counter((r.doc_id, r.text) for r in kept["mixing"])


def test_empty_and_odd_documents(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "same text here"), (3, "same text here"), (None, "no id at all")]
    for given in (rows, []):
        docs = documents(spark, given)
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, FOLDER), "stage")
        assert docs.count() <= 3 * len(given)
