"""Exact top-k inner products by an impact-ordered index, a score at a time.

Components are turned into integers and quantised into impact levels. Each shard of the candidates
keeps, for every dimension and level, the segment of its rows at that level. A query visits the
segments by descending contribution (a negative query component reads its dimension from the low
levels up), adding each segment's least contribution to the accumulators. It stops only when the
k-th best lower bound proves that no other row can enter; rows that may are rescored exactly.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterstone.llm.common import stored, tidied
from quarterstone.llm.vectors import finite

LEVELS = 16
SAFE = 2.0 ** 22  # larger integers are multiplied exactly as Python integers


class Index:
    """Segments of one shard: ``ids`` by descending component, dimension by dimension."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, levels: int = LEVELS):
        self.ids, self.values = ids, values
        n, d = values.shape
        self.rows, owner, lows, highs, bounds = [], [], [], [], [0]
        for dim in range(d):
            order = np.argsort(-values[:, dim], kind="stable").astype(np.int32)
            column = values[order, dim]
            width = max(1, -(-(int(column[0]) - int(column[-1]) + 1) // levels))
            level = (int(column[0]) - column) // width
            cut = [0, *(np.flatnonzero(np.diff(level)) + 1).tolist(), n]
            self.rows.append(order)
            for a, b in zip(cut, cut[1:]):
                owner.append(dim)
                highs.append(column[a])
                lows.append(column[b - 1])
                bounds.append(dim * n + b)
        self.rows = np.concatenate(self.rows) if d else np.zeros(0, np.int32)
        self.owner, self.lows, self.highs = np.array(owner, np.int64), np.array(lows), np.array(highs)
        self.bounds = np.array(bounds, np.int64)
        self.largest = int(np.abs(values).max(initial=0))

    def exact(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.values[rows] @ query

    def top(self, query: np.ndarray, k: int, but: np.ndarray, step: int = 128) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best, ties to the smaller id, leaving out the row(s) ``but``."""
        n = len(self.ids)
        weight = query[self.owner]
        most = np.where(weight >= 0, weight * self.highs, weight * self.lows)
        least = np.where(weight >= 0, weight * self.lows, weight * self.highs)
        # relative to what the dimension gives at least, contributions are not negative
        floor = np.full(len(query), np.iinfo(np.int64).max)
        np.minimum.at(floor, self.owner, least)
        gain, sure = most - floor[self.owner], least - floor[self.owner]
        order = np.argsort(-gain, kind="stable")
        order = order[gain[order] > 0]
        slack = np.zeros(len(query), np.int64)  # widest unknown part of a visited segment, by dimension
        ahead = np.zeros(len(query), np.int64)  # largest gain not visited yet, by dimension
        np.maximum.at(ahead, self.owner, gain)
        lower = np.zeros(n, np.int64)
        hidden = np.zeros(n, bool)
        hidden[but] = True
        open_rows = np.flatnonzero(~hidden)
        if len(open_rows) > k:
            for at in range(0, len(order), step):
                part = order[at:at + step]
                rows = np.concatenate([self.rows[self.bounds[s]:self.bounds[s + 1]] for s in part])
                sizes = self.bounds[part + 1] - self.bounds[part]
                lower += np.bincount(rows, weights=np.repeat(sure[part], sizes), minlength=n).astype(np.int64)
                np.maximum.at(slack, self.owner[part], gain[part] - sure[part])
                rest = order[at + step:]
                ahead[:] = 0
                np.maximum.at(ahead, self.owner[rest], gain[rest])
                # a row is either past a dimension (its sure part counted, at most ``slack`` more)
                # or still to come there (at most ``ahead``)
                room = int(np.maximum(slack, ahead).sum())
                best = np.partition(lower[open_rows], len(open_rows) - k)[len(open_rows) - k]
                may = open_rows[lower[open_rows] + room >= best]
                if len(may) <= max(4 * k, 64):
                    open_rows = may
                    break
            else:
                room = int(slack.sum())
                best = np.partition(lower[open_rows], len(open_rows) - k)[len(open_rows) - k]
                open_rows = open_rows[lower[open_rows] + room >= best]
        scores = self.exact(query, open_rows)
        first = np.lexsort((self.ids[open_rows], -scores))[:k]
        return open_rows[first], scores[first]


def _search_batches(k: int, scale: int):
    def whole(vectors: list) -> np.ndarray:
        rows = np.floor(np.asarray(vectors, np.float64) * scale)
        if len(rows) and np.abs(rows).max(initial=0) > SAFE:
            return np.array([[int(x) for x in row] for row in rows], object)
        return rows.astype(np.int64)

    def run(batches):
        key, shard, index = None, [], None

        def build():
            ids = np.array([-1 if i is None else i for i, _, _ in shard], np.int64)
            values = whole([v for _, v, _ in shard])
            made = Index(ids, values) if values.dtype != object else SimpleNamespace(ids=ids, values=values)
            return made, np.array([u for _, _, u in shard], np.int64)

        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("shard", "size", "is_query", "vec_id", "uid", "embedding")]
            for s, size, is_query, vec_id, uid, vector in zip(*columns):
                if (s, size) != key:
                    key, shard, index = (s, size), [], None
                if not is_query:
                    shard.append((vec_id, vector, uid))
                    continue
                if not shard:
                    continue
                if index is None:
                    index, uids = build()
                    shard = [None]
                query = whole([vector])[0]
                but = np.flatnonzero(uids == uid)
                if query.dtype == object or index.values.dtype == object:
                    scores = index.values.astype(object) @ query.astype(object) if size else np.zeros(len(uids), object)
                    rows = sorted((i for i in range(len(uids)) if uids[i] != uid), key=lambda i: (-scores[i], index.ids[i]))[:k]
                    found = [(i, max(-(1 << 63), min((1 << 63) - 1, int(scores[i])))) for i in rows]
                else:
                    found = list(zip(*index.top(query, k, but))) if size else [(i, 0) for i in np.argsort(index.ids, kind="stable") if uids[i] != uid][:k]
                out += [(vec_id, uid, int(index.ids[i]), int(score)) for i, score in found]
            if out:
                a, u, b, c = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, u, b, c)], ["query_id", "query_uid", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, scale: int = 1024, shard_rows: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by ``every``, the k
    largest integer inner products with the other rows, ties to the smaller vec_id.

    Components become floor(scale * x). A vector that is null or holds null or non-finite components
    takes no part, nor does a row without vec_id; only vectors of equal length are scored; an empty
    vector scores 0. Repeated rows are candidates of their own (a row only leaves out itself), and a
    repeated query is answered once for each. Scores outside 64 bits are ranked exactly and clipped.
    Candidates are cut into shards by a hash, queries visit every shard in a stream, and the k best of
    each shard are merged.
    """
    rows = stored(vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
                  .filter(finite("embedding") & F.col("vec_id").isNotNull())
                  .withColumn("uid", F.monotonically_increasing_id()).withColumn("size", F.size("embedding")), "vectors")
    total = rows.count()
    shards = max(-(-total // shard_rows), min(32, -(-total // 512)), 1)
    candidates = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(5), "uid"), F.lit(shards))).withColumn("is_query", F.lit(False))
    asked = (rows.filter(F.col("vec_id") % every == 0)
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>")))
             .withColumn("is_query", F.lit(True)))
    order = ["shard", "size", "is_query", "uid"]
    found = (candidates.select(*order, "vec_id", "embedding").unionByName(asked.select(*order, "vec_id", "embedding"))
             .repartition("shard", "size").sortWithinPartitions(*order)
             .mapInArrow(tidied(_search_batches(k, scale)), "query_id long, query_uid long, vec_id long, score long"))
    best = Window.partitionBy("query_id", "query_uid").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


SQL = """
WITH given AS (
  SELECT row_number() OVER () AS uid, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.uid, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM given q JOIN given c ON q.vec_id % 100 = 0 AND q.uid <> c.uid AND len(q.v) = len(c.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""
