import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from quarterstone.llm import blocks, components as components_module, fingerprints, queries, simhash
from quarterstone.llm.components import components
from tests.llm import helpers
from tests.llm.helpers import FOLDER, clashing, documents, tables


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    ones = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum((2 * o > len(shingles)) << b for b, o in enumerate(ones))


def classes(ids, prints, bits=3):
    links = [(i, j) for i in range(len(ids)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= bits]
    root = helpers.components(len(ids), links)
    least = {}
    for i, r in zip(ids, root):
        least[r] = min(i, least.get(r, i))
    return [least[r] for r in root]


def test_query_equals_brute_force(spark):
    table = tables("documents").select(["doc_id", "text"]).to_pylist()
    ids, prints = [r["doc_id"] for r in table], [plain(r["text"]) for r in table]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op7_simhash_near_duplicates(spark, FOLDER).collect()}
    assert got == {i: (f"{p:016x}", c) for i, p, c in zip(ids, prints, classes(ids, prints))}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="aB é\t\n İ", max_size=120), max_size=8))
def test_fingerprints(texts):
    assert fingerprints.simhashes(texts).tolist() == [plain(t) for t in texts]


def test_long_words_and_long_text():
    text = " ".join(["x" * k for k in range(1, 70)] * 40)
    assert fingerprints.simhashes([text, None]).tolist() == [plain(text), 0]


def test_odd_rows(spark):
    rows = [(5, None), (3, ""), (9, " \n"), (7, "one two three four"), (7, "one two three four"), (None, "one two three four"), (None, "alone here"),
            (None, "another text without id")]
    got = sorted(map(str, simhash.near_duplicates(clashing(documents(spark, rows), "fp", "bucket", "component")).collect()))
    want = {5: 3, 3: 3, 9: 3, 7: 7}
    assert len(got) == 8
    for row in simhash.near_duplicates(documents(spark, rows)).collect():
        assert row.component_id == (want[row.doc_id] if row.doc_id is not None else 7 if row.fingerprint == f"{plain(rows[3][1]):016x}" else None)
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    left = simhash.distinct(documents(spark, rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in left) == [(False, 3), (False, 7), (True, 0), (True, 0)]


@pytest.mark.parametrize("number,spread,clusters", [(600, 64, 600), (2500, 12, 40), (900, 5, 1)])
def test_search_finds_every_link(spark, number, spread, clusters):
    """Random prints, many near groups, and one dense group."""
    draw = np.random.default_rng(number)
    base = draw.integers(0, 1 << 63, clusters, dtype=np.uint64)[draw.integers(0, clusters, number)]
    for _ in range(3):
        base ^= np.where(draw.random(number) < 0.6, np.uint64(1) << draw.integers(0, spread, number, dtype=np.uint64), np.uint64(0))
    prints = np.unique(base)
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp bigint")
    found = {r.node: r.component for r in components(simhash.linked(frame)).collect()}
    values = prints.tolist()
    root = helpers.components(len(values), [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 3])
    got = [found.get(int(p), int(p)) for p in prints.view(np.int64)]
    assert {tuple(np.flatnonzero(np.array(got) == g)) for g in set(got)} == {tuple(np.flatnonzero(np.array(root) == r)) for r in set(root)}


def test_thresholds_are_a_pigeonhole():
    draw = np.random.default_rng(1)
    for total in (10, 10_000, 10_000_000, 10 ** 10):
        plan = simhash.search_plan(draw.integers(0, 1 << 63, 500, dtype=np.uint64), total, 3)
        assert sum(t + 1 for _, t in plan) == 4
        used = [b for group, _ in plan for b in group]
        assert len(used) == len(set(used))
    assert simhash.choose(3, [[5.0, 1.0], [1.0, 9.0], [1.0, 9.0]]) == (3.0, [1, 0, 0])
    assert simhash.search_plan(np.zeros(0, np.uint64), 0, 3)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 199)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)}, 199: 199, 200: 199}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("shape", ["up", "down", "shuffled", "comb"])
def test_long_chains_settle_in_logarithmic_rounds(spark, monkeypatch, shape):
    n, rounds = 10_000, []
    parents = components_module._parents
    monkeypatch.setattr(components_module, "_parents", lambda live, draw: rounds.append(draw) or parents(live, draw))
    order = {"up": np.arange(n), "down": np.arange(n)[::-1], "shuffled": np.random.default_rng(1).permutation(n), "comb": np.arange(n)}[shape]
    pairs = list(zip(order[:-1].tolist(), order[1:].tolist()))
    if shape == "comb":
        pairs = [(i, i + 1) for i in range(n // 2 - 1)] + [(i, i + n // 2) for i in range(n // 2)]
    got = components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in got} == dict.fromkeys(range(n), 0) and len(rounds) <= 18


def test_chained_fingerprints_are_one_component(spark):
    """Each print is one bit from the next, the ends far apart."""
    rows = spark.createDataFrame([((1 << k) - 1,) for k in range(63)], "fp bigint")
    got = {r.node: r.component for r in components(simhash.linked(rows, 1)).collect()}
    assert got == {(1 << k) - 1: 0 for k in range(63)}


def test_blocks_pair_every_two_members_once(spark):
    rows = spark.createDataFrame([(b, i) for b, n in ((1, 1), (2, 2), (3, 700)) for i in range(n)], "bucket bigint, m bigint")
    seen = {}
    groups = {}
    for r in blocks.block_pairs(rows, ["bucket"], "m", size=50, spread=4, largest=100).collect():
        groups.setdefault((r.bucket, r.block_low, r.block_high), []).append((r.m, r.block_second))
    for (bucket, low, high), members in groups.items():
        for i, (a, second_a) in enumerate(members):
            for b, second_b in members[:i]:
                if low == high or second_a != second_b:
                    key = (bucket, min(a, b), max(a, b))
                    seen[key] = seen.get(key, 0) + 1
    assert set(seen.values()) == {1} and len(seen) == 1 + 700 * 699 // 2
