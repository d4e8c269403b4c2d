"""Near-duplicates by SimHash with a generalised pigeonhole search.

Two fingerprints that differ in at most ``bits`` of 64 bits differ, for disjoint groups of bits
with thresholds t_i and sum(t_i + 1) = bits + 1, in at most t_i bits of some group i: otherwise
they would differ in at least bits + 1. Groups hold correlated bits together, so that the other
groups are more selective, and thresholds are allotted by dynamic programming on estimated
candidate counts; a group may get -1 and is then not searched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.llm.blocks import SIDE, block_pairs, candidate_pairs, roots, whole_groups
from quarterstone.llm.common import stored, tidied
from quarterstone.llm.components import components
from quarterstone.llm.fingerprints import fingerprints

BITS = 64
SAMPLE = 4096  # fingerprints the cost estimate is fitted on; results do not depend on it
PROBE_COST = 40.0  # cost of one index row, in compared pairs
WIDEST = 2  # largest threshold of one group


def bit_groups(sample: np.ndarray, number: int) -> list[list[int]]:
    """``number`` groups of bits of about equal width; each takes the bit most correlated with it."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    bits -= bits.mean(axis=0) if len(sample) else 0
    scale = np.sqrt((bits ** 2).sum(axis=0))
    scale[scale == 0] = 1
    related = np.abs((bits / scale).T @ (bits / scale))
    left, groups = list(range(BITS)), []
    for k in range(number):
        group = [max(left, key=lambda b: (related[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < -(-(BITS - sum(map(len, groups))) // (number - k)):
            best = max(left, key=lambda b: (related[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def project(prints: np.ndarray, group: list[int]) -> np.ndarray:
    out = np.zeros(len(prints), np.uint64)
    for k, bit in enumerate(group):
        out |= ((prints >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
    return out


def choose(bits: int, costs: list[list[float]]) -> tuple[float, list[int]]:
    """Cheapest thresholds t_i in -1.. with sum(t_i + 1) = bits + 1; costs[i][t] for t >= 0."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        reached: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for t in range(-1, len(cost)):
                now = used + t + 1
                price = total + (cost[t] if t >= 0 else 0.0)
                if now <= bits + 1 and (now not in reached or price < reached[now][0]):
                    reached[now] = price, [*chosen, t]
        best = reached
    return best.get(bits + 1, (float("inf"), []))


def search_plan(sample: np.ndarray, total: int, bits: int) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds, the cheapest over several numbers of groups. Candidate
    counts are those of the sample's pairs, plus those of evenly spread bits, for ``total`` prints."""
    found: tuple[float, list] = (float("inf"), [])
    pairs, known = total * (total - 1) / 2, len(sample) * (len(sample) - 1) / 2
    for number in range(2, 2 * bits + 3):
        groups, costs = bit_groups(sample, number), []
        for group in groups:
            values = project(sample, group)
            near = np.zeros(WIDEST + 1)
            for start in range(0, len(values), 512):
                apart = np.bitwise_count(values[start:start + 512, None] ^ values[None, :])
                near += [(apart <= t).sum() for t in range(WIDEST + 1)]
            near = (near - len(values)) / 2
            ball = np.cumsum([1, len(group), len(group) * (len(group) - 1) / 2])
            rows = [1, 1 + len(group) / 2, 1 + len(group)]
            costs.append([pairs * (near[t] / max(known, 1) + ball[t] / 2.0 ** len(group)) * (1 if t < 2 else 3)
                          + PROBE_COST * total * rows[t] for t in range(WIDEST + 1)])
        price, thresholds = choose(bits, costs)
        if price < found[0]:
            found = price, [(g, t) for g, t in zip(groups, thresholds) if t >= 0]
    return found[1]


def _probe_batches(plan):
    """Index rows: bucket and fingerprint. Threshold 0: the group's value. 1: also each value with
    one set bit cleared (of two values one bit apart, one clears into the other). 2: also each
    value with any bit turned (two values two bits apart meet halfway)."""
    def run(batches):
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            for place, (group, threshold) in enumerate(plan):
                values, base = project(prints, group), np.uint64(place) << np.uint64(56)
                parts = [(values, prints)]
                for k in range(len(group) if threshold else 0):
                    bit = np.uint64(1) << np.uint64(k)
                    take = slice(None) if threshold == 2 else (values & bit) > 0
                    parts.append((values[take] ^ bit, prints[take]))
                for v, p in parts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((v | base).view(np.int64)), pa.array(p.view(np.int64))], ["bucket", "fp"])
    return run


def _link_batches(bits):
    def run(batches):
        for table, starts in whole_groups(batches, ["bucket", *SIDE[:2]]):
            prints = table.column("fp").to_numpy().view(np.uint64)
            low, high, second = (table.column(c).to_numpy() for c in SIDE)
            links = [(np.zeros(0, int), np.zeros(0, int))]
            for a, b in candidate_pairs(starts, len(table), low, high, second):
                close = np.bitwise_count(prints[a] ^ prints[b]) <= bits
                if close.any():
                    links.append((a[close], b[close]))
            a, b = (np.concatenate(x) for x in zip(*links))
            if not len(a):
                continue
            # of all links found here, a spanning set: each print with the smallest it reaches
            values, index = np.unique(prints.view(np.int64), return_inverse=True)
            root = roots(index[a], index[b], len(values))
            far = np.flatnonzero(root != np.arange(len(values)))
            yield pa.RecordBatch.from_arrays([pa.array(values[far]), pa.array(values[root[far]])], ["a", "b"])
    return run


def linked(prints: DataFrame, bits: int = 3) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fp`` exactly as all pairs at most
    ``bits`` apart do. Only a spanning set of the links found in a task is returned."""
    total = prints.count()
    sample = prints.orderBy(F.xxhash64(F.lit(3), "fp"), "fp").limit(SAMPLE).toPandas()["fp"].to_numpy()
    plan = search_plan(sample.astype(np.int64).view(np.uint64), total, bits)
    rows = prints.select("fp").mapInArrow(tidied(_probe_batches(plan)), "bucket long, fp long")
    return block_pairs(rows, ["bucket"], "fp").mapInArrow(tidied(_link_batches(bits)), "a long, b long")


def _placed(marked: DataFrame, bits: int) -> DataFrame:
    """(fp, component, component_id) for the fingerprints of ``marked`` (doc_id, fp): the smallest print
    and the smallest doc_id of each print's component."""
    prints = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    found = components(linked(prints, bits))
    placed = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    return stored(placed.join(smallest, "component").select("fp", "component", "component_id"), "placed")


def near_duplicates(docs: DataFrame, bits: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id
    that links reach), kept.

    Equal fingerprints are one node, so copies cost one row each and no pair. A null or blank text
    has fingerprint zero and is linked like any other; rows with a null doc_id take part, but name
    a component only if all its members are null. Repeated rows come back as often as given, ``kept``
    holds for each of them; an empty table gives an empty result.
    """
    marked = stored(fingerprints(docs), "fingerprints")
    return (marked.join(_placed(marked, bits), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
                    F.equal_null("doc_id", "component_id").alias("kept")))


def distinct(docs: DataFrame, bits: int = 3) -> DataFrame:
    """The rows of ``docs``, one of each group of near-duplicates: that with the smallest doc_id, and
    of rows that share it one with the smallest fingerprint, whichever of these repeats. Texts stay
    where they are until the kept ids are known, then meet them in one join."""
    marked = stored(fingerprints(docs), "fingerprints")
    kept = stored(marked.join(_placed(marked, bits), "fp").filter(F.equal_null("doc_id", "component_id"))
                  .groupBy("component", "component_id").agg(F.min("fp").alias("fp"))
                  .select(F.col("component_id").alias("_kept"), F.col("fp").alias("_fp")), "kept")
    columns = docs.columns
    rows = fingerprints(docs, columns).join(kept, F.equal_null("doc_id", "_kept") & (F.col("fp") == F.col("_fp")))
    # repeated rows of one id: each task hands on one of them
    return rows.dropDuplicates(["_kept", "_fp"]).select(*columns)
