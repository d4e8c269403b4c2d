import numpy as np
import pytest

from quarterstone.llm import negatives, queries
from tests.llm.helpers import FOLDER, tables, unit

KIND = "vec_id bigint, embedding array<double>, label int, size string, uid string, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "clash", "clash", "clash") for i, v, label in rows], KIND)


def brute(rows, every=50, k=5, m=3, scale=256, low=50, high=95):
    usable = [(n, i, label, [int(x) for x in np.floor(scale * np.array(v, float)).tolist()]) for n, (i, v, label) in enumerate(rows)
              if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, i, label, q in usable:
        if i is None or i % every:
            continue
        scores = [(sum(a * b for a, b in zip(q, v)), other, j) for o, j, other, v in usable if o != n and len(v) == len(q)]

        def order(s):
            return -s[0], s[2] is None, s[2] or 0
        for p, _, j in sorted((s for s in scores if s[1] == label), key=order)[:k]:
            fit = [s for s in scores if s[1] != label and low * p <= 100 * s[0] <= high * p]
            out += [(i, j, r, s[2], p, s[0]) for r, s in enumerate(sorted(fit, key=order)[:m], 1)]
    return sorted(out, key=str)


def got(rows):
    return sorted((tuple(r) for r in rows.collect()), key=str)


def shifted(rows):
    return [(i, v, label if label is None or i is None or i % 7 else (label + 1) % 10) for i, v, label in rows]


def test_whole_table(spark):
    t = tables("embeddings").to_pydict()
    rows = [(i, v and np.float32(v).astype(float).tolist(), label) for i, v, label in zip(t["vec_id"], t["embedding"], t["label"])]
    want = brute(shifted(rows))
    assert got(queries.op13_hard_negatives(spark, FOLDER)) == want and want


@pytest.mark.parametrize("shard_bytes", [1 << 16, 64 << 20])
def test_clusters_with_a_hot_label(spark, shard_bytes):
    draw = np.random.default_rng(5)
    centers = unit(draw.normal(size=(12, 24)))
    place = np.concatenate([np.zeros(700, int), draw.integers(0, 12, 1300)])
    vectors = (centers[place] + draw.normal(size=(2000, 24)) * 0.12) * draw.uniform(0.5, 3, (2000, 1))
    rows = [(int(i), v.tolist(), int(p) // 2) for i, v, p in zip(draw.permutation(2000), vectors, place)]
    want = brute(rows)
    assert got(negatives.mine(frame(spark, rows), shard_bytes=shard_bytes)) == want and len(want) > 100


@pytest.mark.parametrize("spread", [0.01, 1.0])
def test_ties(spark, spread):
    draw = np.random.default_rng(3)
    rows = [(i, (draw.integers(-2, 4, 4) * spread).tolist(), int(draw.integers(0, 3))) for i in range(600)]
    assert got(negatives.mine(frame(spark, rows), every=20)) == brute(rows, every=20)


def test_many_labels_share_shards(spark):
    draw = np.random.default_rng(6)
    rows = [(i, draw.normal(size=6).tolist(), i // 4) for i in range(900)]
    assert got(negatives.mine(frame(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    v, w = [1.0, 2.0], [0.7, 1.3]
    rows = [(0, v, 1), (0, v, 1), (1, v, 1), (2, w, 2), (2, w, 2), (None, w, 3), (None, v, 1), (50, None, 1), (3, None, 1), (4, v, None), (100, [0.0, 0.0], 1),
            (5, [float("nan"), 1.0], 2), (6, [None, 1.0], 2), (7, [float("inf"), 1.0], 1), (8, [1.0], 2), (150, [3.0], 2), (9, [2.0], 1), (10, [2.9], 2),
            (200, [], 4), (11, [], 4), (12, [], 5), (250, [1e6, -1e6], 6), (13, [1e6, -2e6], 6), (14, [9e5, -1e6], 7), (15, w, -3)]
    assert got(negatives.mine(frame(spark, rows))) == brute(rows)
    assert negatives.mine(frame(spark, [])).count() == 0
    huge = negatives.mine(frame(spark, [(0, [1e12], 1), (1, [2e12], 1), (2, [1.5e12], 2), (3, [1.4e12], 2), (4, [-1e12], 2)])).orderBy("rank").collect()
    assert [(r.positive_id, r.negative_id, r.negative_score) for r in huge] == [(1, 2, (1 << 63) - 1), (1, 3, (1 << 63) - 1)]


def shard_of(vectors, labels, directions):
    values = negatives.whole(vectors, 256)
    n = len(values)
    return negatives.Shard(np.arange(n), np.arange(n), np.ones(n, bool), labels, values, negatives.angles_to(values, directions).astype(np.float32).T)


def test_bounds_hold_every_score_and_leave_rows_out():
    """On clusters, as trained embeddings form, few rows need their integer score; no bound is ever passed."""
    draw = np.random.default_rng(8)
    centers = unit(draw.normal(size=(16, 32)))
    place = draw.integers(0, 16, 4000)
    vectors = (centers[place] + draw.normal(size=(4000, 32)) * 0.04) * draw.uniform(0.5, 2, (4000, 1))
    directions = negatives.reference_directions(negatives.whole(vectors[:500], 256))
    shard = shard_of(vectors, place // 2, directions)
    asked = 0
    for i in range(0, 4000, 80):
        query = negatives.Query(int(shard.uids[i]), int(shard.labels[i]), shard.values[i], shard.angles[:, i])
        rows, low, high = shard.bounds(query, np.ones(4000, bool), -np.inf, np.inf)
        scores = shard.values[rows] @ query.values
        assert len(rows) == 4000 and (low <= scores).all() and (scores <= high).all()
        shard.scored = 0
        found = negatives.best_of_label(shard, query, 5)
        negatives.best_in_windows(shard, query, found[1].tolist(), 3, 50, 95)
        asked += shard.scored
    assert asked < 0.4 * 50 * 4000
