import numpy as np
import pytest

from quarterstone.llm import pivots, queries, topk
from tests.llm import helpers
from tests.llm.helpers import FOLDER, tables, unit

KIND = "vec_id bigint, embedding array<float>, label int, pivot string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "clash", "clash") for i, v, label in rows], KIND)


def links(ids, vectors, labels, least=0.93):
    ok = [v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    out = []
    for i in range(len(ids)):
        for j in range(i):
            if ok[i] and ok[j] and labels[i] is not None and labels[i] == labels[j] and len(vectors[i]) == len(vectors[j]):
                a, b = (np.array(v, np.float32).astype(float) for v in (vectors[i], vectors[j]))
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                    out.append((i, j))
    return out


def want(ids, vectors, labels):
    found = links(ids, vectors, labels)
    n = np.bincount(np.array(found, int).reshape(-1), minlength=len(ids))
    root = helpers.components(len(ids), found)
    least = {}
    for i, r in zip(ids, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return sorted(((i, int(k), least.get(r)) for i, k, r in zip(ids, n, root)), key=str)


def test_near_duplicates_on_the_table(spark):
    table = tables("embeddings").to_pydict()
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in queries.op2_pivot_near_duplicates(spark, FOLDER).collect()), key=str)
    assert got == want(table["vec_id"], table["embedding"], table["label"])


def test_near_duplicates_of_clusters(spark):
    draw = np.random.default_rng(2)
    centers = unit(draw.normal(size=(30, 16)))
    place = np.concatenate([np.zeros(350, int), draw.integers(0, 30, 450)])
    vectors = (centers[place] + draw.normal(size=(800, 16)) * 0.055).astype(np.float32)
    labels = [int(p) % 3 for p in place]
    ids = draw.permutation(800).tolist()
    got = {r.vec_id: r for r in pivots.near_duplicates(frame(spark, zip(ids, vectors.tolist(), labels))).collect()}
    expected = want(ids, vectors.tolist(), labels)
    assert sum(r.n_links for r in got.values()) >= 0.98 * sum(n for _, n, _ in expected) > 0
    assert np.mean([got[i].component_id == c for i, _, c in expected]) >= 0.98
    assert all(got[i].n_links <= n for i, n, _ in expected)


def test_dense_noisy_group_keeps_its_links(spark, monkeypatch):
    """A third of the rows about one point, links decided by their noise; as many pivots as 65,000 rows have."""
    monkeypatch.setattr(pivots, "PIVOTS", (256, 2048))
    draw = np.random.default_rng(4)
    vectors = unit(draw.normal(size=(1200, 64)))
    vectors[:400] = unit(vectors[0] + 0.24 * unit(draw.normal(size=(400, 64))) * draw.uniform(0.8, 1.3, (400, 1)))
    ids = draw.permutation(1200).tolist()
    got = {r.vec_id: (r.n_links, r.component_id) for r in pivots.near_duplicates(frame(spark, zip(ids, vectors.tolist(), [0] * 1200))).collect()}
    expected = want(ids, vectors.tolist(), [0] * 1200)
    assert {i: c for i, (_, c) in got.items()} == {i: c for i, _, c in expected}
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for _, n, _ in expected) > 50_000
    assert all(got[i][0] <= n for i, n, _ in expected)


@pytest.mark.parametrize("total", [10_000, 10_000_000])
@pytest.mark.parametrize("mean,number", [(0.0, 256), (0.5, 256), (0.7, 512), (0.9, 256)])
def test_index_finds_links_about_a_common_mean(mean, number, total):
    """Links at cosine 0.93 to 0.965 among vectors whose mean cosine is ``mean``, by the chosen shared-pivot count."""
    draw = np.random.default_rng(7)
    middle = np.zeros(64)
    middle[0] = np.sqrt(mean)
    noise = draw.normal(size=(6000, 64)) * np.where(middle > 0, 0, 1)
    rows = unit(middle + np.sqrt(1 - mean) * unit(noise))
    index = pivots.fitted(rows[:4 * number], np.zeros(4 * number, int), number, 0.93, total)
    near = pivots.partners(rows[4000:], 0.93, seed=9)
    a, b = index.names(rows[4000:]), index.names(near)
    recall = (a[:, :, None] == b[:, None, :]).any(axis=(1, 2)).mean()
    other = (a[:200, None, :, None] == b[None, :, None, :]).any(axis=(2, 3)).mean()
    print(mean, total, len(index.points), index.order, index.shared, "recall", recall, "candidates", other)
    assert len(index.points) >= 32 and recall >= 0.98
    assert mean > 0.5 or index.shared == (2 if total > 10_000 else 1)


def test_names_are_pairs_of_near_pivots():
    index = pivots.Index(np.zeros(2), np.array([[1.0, 0], [0, 1], [-1, 0], [0, -1]]), 3, 2)
    assert index.names(unit(np.array([[2.0, 1.0], [-1.0, 0.5]]))).tolist() == [[1, 3, 7], [6, 7, 11]]
    assert pivots.Index(index.middle, index.points, 3, 1).names(unit(np.array([[2.0, 1.0]]))).tolist() == [[0, 1, 3]]


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (3, v, 1), (4, v, None), (5, None, 0), (6, [0.0, 0.0, 0.0], 0), (7, [1.0, None, 3.0], 0),
            (8, [1.0, float("nan"), 3.0], 0), (9, [float("inf"), 2.0, 3.0], 0), (10, [1.0, 2.0], 0), (11, [2.0, 4.0], 0), (12, [], 0),
            (None, v, 1), (13, [1e30, 2e30, 3e30], 0), (14, [1e-30, 2e-30, 3e-30], 0)]
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in pivots.near_duplicates(frame(spark, rows)).collect()), key=str)
    assert got == want(*(list(c) for c in zip(*rows)))
    assert pivots.near_duplicates(frame(spark, [])).count() == 0


def brute(rows, every, k):
    usable = [(i, np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int).tolist(), n) for n, (i, v, _) in enumerate(rows)
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q, n in usable:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v, m in usable if m != n and len(v) == len(q))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_top_k_on_the_table(spark):
    table = tables("embeddings").to_pydict()
    got = sorted(tuple(r) for r in queries.op8_impact_ordered_top_k(spark, FOLDER).collect())
    assert got == brute(list(zip(table["vec_id"], table["embedding"], table["label"])), 100, 10)


@pytest.mark.parametrize("spread", [0.002, 1.0, 300.0])
def test_top_k_with_ties(spark, spread):
    draw = np.random.default_rng(3)
    rows = [(i, (draw.integers(-3, 4, 6) * spread).tolist(), 0) for i in range(900)]
    got = sorted(tuple(r) for r in topk.nearest(frame(spark, rows), every=50, k=7).collect())
    assert got == brute(rows, 50, 7)


def test_top_k_odd_vectors(spark):
    rows = [(0, [1.0, -2.0], 0), (0, [1.0, -2.0], 0), (100, [0.5, 0.5], 0), (7, None, 0), (200, None, 0), (8, [float("nan"), 1.0], 0), (9, [None, 1.0], 0),
            (None, [1.0, 1.0], 0), (11, [3.0], 0), (300, [], 0), (13, [], 0), (14, [-4.0, 1e7], 0)]
    got = sorted(tuple(r) for r in topk.nearest(frame(spark, rows)).collect())
    assert got == brute(rows, 100, 10)
    assert topk.nearest(frame(spark, [])).count() == 0
    huge = topk.nearest(frame(spark, [(0, [1e20], 0), (1, [1e20], 0), (2, [-1e20], 0)])).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in huge] == [(1, (1 << 63) - 1), (2, -(1 << 63))]
