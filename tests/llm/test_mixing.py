import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterstone.llm import mixing, queries
from tests.llm.helpers import FOLDER, clashing, documents, tables


def level_targets(sizes: dict):
    """Targets by resharing what is above a cap, round by round."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    cap = {s: 3.0 * sizes[s] for s in names}
    target, free, pool = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while pool > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += pool * weight[s] / total
        pool = 0.0
        for s in list(free):
            if target[s] >= cap[s]:
                pool += target[s] - cap[s]
                target[s] = cap[s]
                free.discard(s)
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def checked(rows, docs):
    """Holds for every mix; returns the taken words by source."""
    size = {(d, t): words(t) for d, t, _ in docs}
    sizes = Counter()
    for d, t, s in docs:
        sizes[s] += words(t)
    want, taken, per_round = level_targets(sizes), Counter(), Counter()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert r.taken == sum(d.words for d in r.draws) <= 3 * r["size"]
        spans = sorted((d.round, d.first_word, d.words) for d in r.draws)
        for (a, first, n), (b, second, _) in zip(spans, spans[1:]):
            assert a < b or second == first + n
        assert all(0 <= first and first + n <= r["size"] for _, first, n in spans)
        taken[r.source] += r.taken
        for d in r.draws:
            per_round[(r.source, d.block, d.shard)] += d.words
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6 * want[s]
    assert len({(s, b) for s, b, _ in per_round}) == len(per_round)  # a block is in one shard
    return taken


def test_query(spark):
    table = [(r["doc_id"], r["text"], r["source"]) for r in tables("documents").to_pylist()]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    mixed = queries.op4_mixture(spark, FOLDER).join(docs.select("doc_id", "source"), "doc_id")
    first = mixed.collect()
    checked(first, table)
    assert sorted(map(str, first)) == sorted(map(str, mixed.collect()))
    for name in queries.op4_mixture(spark, FOLDER)._jdf.queryExecution().executedPlan().toString().split():
        assert "Python" not in name and "Pandas" not in name and "Arrow" not in name


def mixed(docs, **more):
    return mixing.mix(mixing.sized(docs), **more)


@pytest.mark.parametrize("parts", [1, 7])
def test_hot_and_odd_sources(spark, parts):
    docs = [(k, "w " * (k % 13), "a") for k in range(900)] + [(1000 + k, "one two", None) for k in range(30)] + [
        (2000, "long " * 20_000, "b"), (2001, None, "b"), (2002, "", "c"), (None, "x y z", "Z"), (7, "again", "ü"), (7, "again", "ü")]
    names = ("number", "words", "quota", "weight", "chunks", "_row", "_order", "_chunk", "_start", "block_words", "shard_of", "n", "taken", "draws", "row")
    frame = clashing(documents(spark, docs), *names).repartition(parts)
    result = mixed(frame, shards=8, blocks=64)
    rows = result.collect()
    assert set(result.columns) == {*frame.columns, *mixing.OWN, *mixing.RESULT}
    assert all(r[name] == "clash" for r in rows for name in names if name not in mixing.RESULT)
    checked(rows, docs)
    again = mixed(documents(spark, docs).repartition(5), shards=8, blocks=64).collect()
    assert sorted(str((r.doc_id, r.size, r.draws)) for r in rows) == sorted(str((r.doc_id, r.size, r.draws)) for r in again)


def test_empty(spark):
    assert mixed(documents(spark, [])).count() == 0
    assert [r.taken for r in mixed(documents(spark, [(1, ""), (2, None)])).collect()] == [0, 0]


def test_tree_is_hypergeometric(spark):
    """Quotas are kept exactly, and the first shard's counts have the distribution's mean and variance."""
    quotas = [40, 20, 4, 0]
    counts = []
    for seed in range(60):
        rows = mixing.split_quotas(spark.createDataFrame([(quotas,)], "quotas array<bigint>"), 4, seed).orderBy("shard").collect()
        assert np.sum([r.quotas for r in rows], axis=0).tolist() == quotas and {sum(r.quotas) for r in rows} == {16}
        counts.append(rows[0].quotas)
    mean, variance = np.mean(counts, axis=0), np.var(counts, axis=0)
    n, total, k = 16, 64, np.array(quotas)
    exact = n * k / total
    spread = n * k / total * (1 - k / total) * (total - n) / (total - 1)
    assert np.all(np.abs(mean - exact) <= 4 * np.sqrt(spread / 60) + 1e-9) and np.all(variance <= 1.8 * spread + 1e-9)


def test_drawn_documents_and_shards(spark):
    docs = documents(spark, [(k, f"word{k} and more words here", "a" if k < 20 else "b") for k in range(60)])
    rows = mixed(docs, shards=4, blocks=16)
    taken = {r.doc_id: r for r in rows.collect()}
    drawn = mixing.drawn_documents(rows, docs.columns).collect()
    got = Counter()
    for r in drawn:
        got[r.doc_id] += words(r.text)
        assert r.n_chars == len(r.text)
    assert got == Counter({k: r.taken for k, r in taken.items() if r.taken})
    numbered = rows.withColumn("place", F.col("doc_id"))
    dealt = {r.doc_id: r.taken for r in mixing.taken_by_shards(numbered.withColumn("taken", F.lit(-1)), "place").collect()}
    assert dealt == {k: r.taken for k, r in taken.items()}
    pieces = mixing.shard_rows(rows)
    assert pieces.agg(F.sum("words")).first()[0] == sum(got.values())
    keys = {}
    for r in pieces.withColumn("task", F.spark_partition_id()).collect():
        keys.setdefault((r.shard, r.order_key >> 60), []).append((r.task, r.order_key))
    assert all(k == sorted(k) and len({task for task, _ in k}) == 1 for k in keys.values()) and len({shard for shard, _ in keys}) == 4
