"""Near-duplicate vectors by a pivot-permutation index.

Each vector is described by its nearest reference points (pivots), in order of nearness. Pivots are taken from a sample
with its middle moved to zero, since vectors about a common mean have no order of their own; no two pivots are
close, so that a dense group has few, its members share them, and noise within the group decides little. Inverted
lists hold the vectors that name a pivot, or two pivots together: vectors in one list have a shared-pivot count of
one, or two, or more. How many a candidate must share, and how long the described order is, is chosen on the sample: the
least work at which nearly all partners of sampled vectors are found. Candidates are compared by cosine
in double precision, in the first list they share.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.llm.blocks import SIDE, block_pairs, roots, whole_groups
from quarterstone.llm.common import stored, tidied
from quarterstone.llm.components import components
from quarterstone.llm.vectors import finite

PIVOTS = 32, 2048  # least and most reference points
ORDERS = (8, 2), (8, 1), (16, 1), (32, 1)  # described pivots and least shared-pivot count
LISTING = 500.0  # cost of naming a vector in a list, in compared pairs
RECALL = 0.99  # share of partners that a choice must find on the sample
APART = 0.5  # cosine that two pivots stay under, seen from the middle
POOL = 4  # sampled vectors for each pivot
TILE = 1024  # rows and columns of vectors compared at once


def units(vectors: list | np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision; scaled by the largest component first, so
    that neither very large nor very small vectors overflow."""
    rows = np.asarray(vectors, np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The rows of a list column whose lists are all of one length."""
    return pc.list_flatten(vectors).to_numpy().astype(np.float64).reshape(len(vectors), -1)


@dataclass
class Index:
    """Reference points for vectors of one length, and how vectors are listed by them."""

    middle: np.ndarray
    points: np.ndarray
    order: int
    shared: int

    def names(self, rows: np.ndarray) -> np.ndarray:
        """The lists of each unit row, ascending: its nearest pivots, or pairs of them of which one is in the nearer half."""
        nearest = np.argsort(-(centered(rows, self.middle) @ self.points.T), axis=1, kind="stable")[:, :self.order]
        if self.shared == 1:
            return np.sort(nearest, axis=1)
        first, second = np.triu_indices(nearest.shape[1], 1)
        near = first < (nearest.shape[1] + 1) // 2
        a, b = nearest[:, first[near]], nearest[:, second[near]]
        return np.sort(np.minimum(a, b) * len(self.points) + np.maximum(a, b), axis=1)


def centered(rows: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """Directions seen from the middle; a row in the middle itself has none."""
    rows = rows - middle
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-12)


def thinned(rows: np.ndarray, number: int) -> np.ndarray:
    """The first ``number`` unit rows, leaving out each that is close to one taken before; if that leaves
    fewer than the least number of pivots, the next ones join them."""
    taken, points, n = np.zeros(len(rows), bool), np.empty((min(number, len(rows)), rows.shape[1])), 0
    for i, row in enumerate(rows):
        if n == len(points):
            break
        if not n or (points[:n] @ row).max() < APART:
            points[n], taken[i], n = row, True, n + 1
    more = np.flatnonzero(~taken)[:max(0, min(PIVOTS[0], len(points)) - n)]
    return np.concatenate([points[:n], rows[more]])


def partners(rows: np.ndarray, least: float, seed: int = 2) -> np.ndarray:
    """For each unit row another at a cosine of ``least`` to half-way up to one, off in the direction of a difference
    between two others, so that they differ as the rows themselves do."""
    draw = np.random.default_rng(seed)
    n = len(rows)
    off = rows[draw.permutation(n)] - rows[draw.permutation(n)] + 1e-6 * draw.normal(size=rows.shape)
    off -= (off * rows).sum(axis=1, keepdims=True) * rows
    off /= np.maximum(np.sqrt((off * off).sum(axis=1, keepdims=True)), 1e-12)
    cosine = draw.uniform(least, (1 + least) / 2, (n, 1))
    return cosine * rows + np.sqrt(1 - cosine ** 2) * off


def fitted(rows: np.ndarray, labels: np.ndarray, number: int, least: float, total: int) -> Index:
    """The index of the least work for ``total`` vectors that finds enough partners of the sample's rows, and of those about
    the commonest nearest pivot, where a dense group lies; or else the one that finds most."""
    middle = rows.mean(axis=0)
    points = thinned(centered(rows, middle), number)
    asked, of = rows[:1500], labels[:1500]
    near, cell = partners(asked, least), (centered(asked, middle) @ points.T).argmax(axis=1)
    dense = cell == np.bincount(cell).argmax()
    choices = []
    for order, shared in ORDERS:
        index = Index(middle, points, min(order, len(points)), shared)
        a, b = index.names(asked), index.names(near)
        found = (a[:, :, None] == b[:, None, :]).any(axis=(1, 2))
        recall = min(found.mean(), found[dense].mean())
        # vectors of one label in one list are compared, once for each list they share
        lists, sizes = np.unique(np.stack([np.repeat(of, a.shape[1]), a.ravel()]), axis=1, return_counts=True)
        compared = total * (sizes / len(asked)).dot(sizes / len(asked))
        choices.append((recall < RECALL, 0.0 if recall >= RECALL else -recall, a.shape[1] * LISTING + compared, len(choices), index))
    return min(choices)[-1]


def pivot_rows(vectors: DataFrame, total: int, least: float = 0.93) -> dict[int, Index]:
    """The index of each vector length, fitted on a bounded sample, the vectors with the smallest hash. The
    number of pivots grows with the root of the table, from 32 to 2048."""
    number = min(PIVOTS[1], max(PIVOTS[0], 1 << math.ceil(math.log2(math.sqrt(max(total, 1))))))
    rows = vectors.orderBy(F.xxhash64(F.lit(11), "uid"), "uid").limit(POOL * number).select("embedding", "label").toArrow()
    sizes, labels = pc.list_value_length(rows.column(0)).to_numpy(), rows.column(1).to_numpy()
    return {int(size): fitted(units(matrix(rows.column(0).filter(pa.array(sizes == size)))), labels[sizes == size], number, least, total)
            for size in np.unique(sizes)}


def _name_batches(indexes: dict[int, Index]):
    """The lists of each vector, ascending. A length without pivots has one list of its own."""
    def run(batches):
        for batch in batches:
            named: list = [None] * batch.num_rows
            vectors = batch.column("embedding")
            sizes = pc.list_value_length(vectors).to_numpy()
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                index = indexes.get(int(size))
                found = np.zeros((len(rows), 1), np.int64) if index is None else index.names(units(matrix(vectors.take(pa.array(rows)))))
                for i, f in zip(rows, found):
                    named[i] = f
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(named, pa.list_(pa.int64()))],
                                             [*batch.schema.names, "size", "lists"])
    return run


def first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of rows of ascending list numbers that share one or more, the smallest shared."""
    both = (a[:, :, None] == b[:, None, :]).any(axis=2)
    return a[np.arange(len(a)), both.argmax(axis=1)]


def _linked_tiles(rows: np.ndarray, names: np.ndarray, pivot: int, second: np.ndarray | None, least: float):
    """Index pairs of one group, a tile at a time: cosine ``least`` or more, ``pivot`` the first shared."""
    for top in range(0, len(rows), TILE):
        for left in range(top, len(rows), TILE):
            near = rows[top:top + TILE] @ rows[left:left + TILE].T >= least - 1e-9
            a, b = np.nonzero(np.triu(near, 1) if top == left else near)
            a, b = a + top, b + left
            if second is not None:
                other = second[a] != second[b]
                a, b = a[other], b[other]
            for k in range(0, len(a), 65536):
                i, j = a[k:k + 65536], b[k:k + 65536]
                keep = np.einsum("ij,ij->i", rows[i], rows[j]) >= least
                i, j = i[keep], j[keep]
                keep = first_shared(names[i], names[j]) == pivot
                if keep.any():
                    yield i[keep], j[keep]


def _verify_batches(least: float):
    def run(batches):
        for table, starts in whole_groups(batches, ["label", "size", "pivot", *SIDE[:2]], 4096):
            uid = table.column("uid").to_numpy()
            columns = {k: table.column(k).to_numpy() for k in ("pivot", *SIDE)}
            counts = np.zeros(len(table), np.int64)
            links_a, links_b = [], []
            for start, end in zip(starts, np.append(starts[1:], len(table))):
                part = table.slice(start, end - start)
                cross = columns[SIDE[0]][start] != columns[SIDE[1]][start]
                for a, b in _linked_tiles(units(matrix(part.column("embedding"))), matrix(part.column("lists")).astype(np.int64),
                                          columns["pivot"][start], columns[SIDE[2]][start:end] if cross else None, least):
                    counts[start:end] += np.bincount(a, minlength=len(part)) + np.bincount(b, minlength=len(part))
                    # of the links, a spanning set
                    root = roots(a, b, len(part))
                    far = np.flatnonzero(root != np.arange(len(part)))
                    links_a.append(far + start)
                    links_b.append(root[far] + start)
            if not links_a:
                continue
            a, b = np.concatenate(links_a), np.concatenate(links_b)
            values, index = np.unique(uid, return_inverse=True)
            root = roots(index[a], index[b], len(values))
            n_links = np.bincount(index, weights=counts, minlength=len(values)).astype(np.int64)
            linked = np.flatnonzero(n_links)
            yield pa.RecordBatch.from_arrays([pa.array(values[linked]), pa.array(n_links[linked]), pa.array(values[root[linked]])],
                                             ["uid", "n", "root"])
    return run


def near_duplicates(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly), component_id (the
    smallest vec_id that links reach), kept.

    Only vectors of equal, non-null label and equal length are compared. A null or zero vector, or
    one with null or non-finite components, links with nothing. Rows with a null vec_id take part;
    repeated rows are vectors of their own that link with each other. Empty tables give empty results.
    """
    rows = stored(vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label"), "embedding")
                  .withColumn("uid", F.monotonically_increasing_id()), "vectors")
    usable = rows.filter(finite("embedding") & F.col("label").isNotNull() & F.exists("embedding", lambda x: x != 0))
    keyed = usable.select("uid", F.xxhash64(F.col("label").cast("string")).alias("label"), "embedding")
    indexes = pivot_rows(keyed, usable.count(), least)
    kind = dict(keyed.dtypes)["embedding"]
    lists = (keyed.mapInArrow(tidied(_name_batches(indexes)), f"uid long, label long, embedding {kind}, size long, lists array<bigint>")
             .withColumn("pivot", F.explode("lists")))
    found = stored(block_pairs(lists, ["label", "size", "pivot"], "uid")
                   .mapInArrow(tidied(_verify_batches(least)), "uid long, n long, root long"), "links")
    joined = components(found.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    placed = (rows.select("vec_id", "uid")
              .join(joined.withColumnRenamed("node", "uid"), "uid", "left")
              .join(found.groupBy("uid").agg(F.sum("n").alias("n_links")), "uid", "left")
              .select("vec_id", F.coalesce("component", "uid").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    least_id = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return placed.join(least_id, "component").select(
        "vec_id", "n_links", "component_id", F.equal_null("vec_id", "component_id").alias("kept"))


SQL = """
WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS uid, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
usable AS (
  SELECT *, sqrt(list_inner_product(v, v)) AS length FROM given
  WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.uid AS a, b.uid AS b
  FROM usable a JOIN usable b ON a.label = b.label AND a.uid <> b.uid AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / (a.length * b.length) >= 0.93),
reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_id AS (
  SELECT r.a, min(g.vec_id) AS least FROM reach r JOIN given g ON g.uid = r.b GROUP BY r.a),
found AS (
  SELECT g.vec_id, coalesce(n.n, 0) AS n_links, least(g.vec_id, m.least) AS component_id
  FROM given g LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = g.uid LEFT JOIN least_id m ON m.a = g.uid)
SELECT vec_id, n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM found
"""
