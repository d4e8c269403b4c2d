"""Hard negatives by angular triangle filtering.

Every vector stores its angles to a few reference directions. For an anchor and a vector, each
reference bounds the angle between them by the triangle inequality on the sphere: at least the
difference of their angles, at most the sum (or what a full turn leaves). The tightest interval of all
references gives an interval of the cosine, and times both norms one of the score, widened for
rounding. Only vectors whose interval overlaps the wanted window get their integer score.

Rows are dealt to shards, a hot label over many. In a shard they lie in cells of near angles, whose
ranges are tried first. Anchors visit the shards of their label for their positives, then all shards
with the windows that these set.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterstone.llm.common import stored, tidied
from quarterstone.llm.vectors import finite

REFERENCES = 16
SAMPLE = 2048  # vectors the references are fitted on; results do not depend on it
ANGLE_SLACK = 2e-6  # radians; single-precision angles and their sums are off by less than half of it
SAFE = 2.0 ** 22  # a component above goes without bounds and is multiplied as a Python integer
SHARD_BYTES = 64 << 20
CELL = 256


def reference_directions(sample: np.ndarray, number: int = REFERENCES, rounds: int = 8) -> np.ndarray:
    """Unit vectors among the sample's directions: far from each other at first, then each the middle of its nearest."""
    norms = np.linalg.norm(sample, axis=1)
    units = sample[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.zeros((0, sample.shape[1]))
    chosen, nearest = [units[0]], units @ units[0]
    while len(chosen) < min(number, len(units)):
        chosen.append(units[np.argmin(nearest)])
        nearest = np.maximum(nearest, units @ chosen[-1])
    directions = np.array(chosen)
    for _ in range(rounds):
        owner = np.argmax(units @ directions.T, axis=1)
        middles = np.array([units[owner == k].sum(axis=0) if (owner == k).any() else directions[k] for k in range(len(directions))])
        length = np.linalg.norm(middles, axis=1)
        directions = np.where(length[:, None] > 1e-9, middles / np.maximum(length, 1e-9)[:, None], directions)
    return directions


def whole(vectors: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(vectors.astype(np.float64) * scale)


def angles_to(values: np.ndarray, directions: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        norms = np.linalg.norm(values, axis=1)
        cosine = np.clip((values @ directions.T) / np.maximum(norms, 1e-300)[:, None], -1.0, 1.0)
    return np.arccos(np.nan_to_num(cosine))


def cosine_range(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosines of an interval of angles, widened."""
    return (np.cos(np.minimum(high + ANGLE_SLACK, np.pi), dtype=np.float64) - 1e-9,
            np.cos(np.maximum(low - ANGLE_SLACK, 0.0), dtype=np.float64) + 1e-9)


def angle_range(anchor: np.ndarray, least: np.ndarray, most: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Interval of the angle between the anchor and vectors whose angles to each reference (by row) are ``least``, or
    lie in least..most."""
    if not len(anchor):
        return np.zeros(least.shape[1]), np.full(least.shape[1], np.pi)
    at, turned = anchor[:, None], (np.pi - anchor)[:, None]
    if most is None:
        apart = np.abs(least - at).max(axis=0)
        # the sum of both angles, or what it leaves of a full turn: as far from pi either way
        return apart, np.pi - np.abs(least - turned).max(axis=0)
    apart = np.maximum(np.maximum(least - at, at - most).max(axis=0), 0.0)
    return apart, np.pi - np.maximum(np.maximum(least - turned, turned - most).max(axis=0), 0.0)


@dataclass
class Shard:
    """Rows of one shard, ordered by nearest reference and the angle to it, with the ranges of their cells."""

    uids: np.ndarray
    ids: np.ndarray
    known: np.ndarray  # whether a row has an id
    labels: np.ndarray
    values: np.ndarray
    angles: np.ndarray  # a row for each reference

    def __post_init__(self):
        n = len(self.uids)
        near = self.angles.argmin(axis=0) if len(self.angles) else np.zeros(n, int)
        order = np.lexsort((self.angles[near, np.arange(n)] if len(self.angles) else near, near))
        for name in ("uids", "ids", "known", "labels", "values"):
            setattr(self, name, getattr(self, name)[order])
        self.angles = np.ascontiguousarray(self.angles[:, order])
        self.largest = np.abs(self.values).max(initial=0.0)
        with np.errstate(over="ignore"):
            self.norms = np.linalg.norm(self.values, axis=1)
        self.starts = np.arange(0, n, CELL)
        if n:
            self.least, self.most = (f.reduceat(self.angles, self.starts, axis=1) for f in (np.minimum, np.maximum))
            self.smallest_norm, self.largest_norm = (f.reduceat(self.norms, self.starts) for f in (np.minimum, np.maximum))
        self.scored = 0

    def bounds(self, query: Query, within: np.ndarray, low: float, high: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows among ``within`` whose score may lie in low..high, with the least and largest score of each."""
        if max(self.largest, query.largest) > SAFE:
            rows = np.flatnonzero(within)
            return rows, np.full(len(rows), -np.inf), np.full(len(rows), np.inf)
        a, b = scores_between(*cosine_range(*angle_range(query.angles, self.least, self.most)),
                              query.norm * self.smallest_norm, query.norm * self.largest_norm)
        cells = (b >= low) & (a <= high)
        rows = np.flatnonzero(within if cells.all() else within & np.repeat(cells, CELL)[:len(within)])
        every = len(rows) > 0.8 * len(within)  # then taking rows out costs more than their bounds
        angles, norms = (self.angles, self.norms) if every else (self.angles[:, rows], self.norms[rows])
        a, b = scores_between(*cosine_range(*angle_range(query.angles, angles)), query.norm * norms, query.norm * norms)
        if every:
            a, b = a[rows], b[rows]
        keep = (b >= low) & (a <= high)
        return rows[keep], a[keep], b[keep]

    def scores(self, query: Query, rows: np.ndarray) -> np.ndarray:
        """Integer inner products: in doubles where these are exact, else as integers of any size."""
        self.scored += len(rows)
        if self.largest * query.largest * max(len(query.values), 1) < 2.0 ** 53:
            if len(rows) > 0.5 * len(self.uids):  # copying most rows out costs more than their products
                return (self.values @ query.values)[rows].astype(np.int64)
            return (self.values[rows] @ query.values).astype(np.int64)
        exact = np.array([sum(int(x) * int(y) for x, y in zip(v, query.values)) for v in self.values[rows]], object)
        return exact if len(exact) else np.zeros(0, np.int64)

    def first(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places of the k best: by score, then by id, rows without id last."""
        if scores.dtype == object:
            return np.array(sorted(range(len(rows)), key=lambda i: (-scores[i], not self.known[rows[i]], self.ids[rows[i]]))[:k], int)
        best = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) > k else np.arange(len(scores))
        return best[np.lexsort((self.ids[rows[best]], ~self.known[rows[best]], -scores[best]))[:k]]


def scores_between(low: np.ndarray, high: np.ndarray, least_norm: np.ndarray, most_norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of cosines low..high and products of norms least..most, with room for rounding."""
    a = low * np.where(low < 0, most_norm, least_norm)
    b = high * np.where(high < 0, least_norm, most_norm)
    return a - 0.5 - 1e-9 * np.abs(a), b + 0.5 + 1e-9 * np.abs(b)


@dataclass
class Query:
    uid: int
    label: int
    values: np.ndarray
    angles: np.ndarray

    def __post_init__(self):
        self.largest = np.abs(self.values).max(initial=0.0)
        with np.errstate(over="ignore"):
            self.norm = float(np.linalg.norm(self.values))


def best_of_label(shard: Shard, query: Query, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the k best other rows of the query's label."""
    others = (shard.labels == query.label) & (shard.uids != query.uid)
    rows, low, high = shard.bounds(query, others, -np.inf, np.inf)
    if len(rows) > k:
        rows = rows[high >= np.partition(low, len(low) - k)[len(low) - k]]
    scores = shard.scores(query, rows)
    first = shard.first(rows, scores, k)
    return rows[first], scores[first]


def best_in_windows(shard: Shard, query: Query, scores: list[int], k: int, low: int, high: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each positive's score, the k best rows of other labels with low % to high % of it: rows and scores.

    Bounds are found once, for the span of all windows; each window then takes the rows whose interval overlaps its own, less those that
    k others surely beat. Only rows that some window takes are scored.
    """
    asked = sorted(s for s in scores if s >= 0)
    none = np.zeros(0, int), np.zeros(0, np.int64)
    others = shard.labels != query.label
    if not asked or not others.any():
        return [none] * len(scores)
    rows, least, most = shard.bounds(query, others, asked[0] * (low / 100) - 1, asked[-1] * (high / 100) + 1)
    taken = np.zeros(len(rows), bool)
    for score in set(asked):
        start, end = score * (low / 100), score * (high / 100)
        overlap = (most >= start - 1) & (least <= end + 1)
        sure = least[(least >= start + 1) & (most <= end - 1)]
        if len(sure) >= k:
            overlap &= most >= np.partition(sure, len(sure) - k)[len(sure) - k]
        taken |= overlap
    rows = rows[taken]
    found = shard.scores(query, rows)
    out = []
    for score in scores:
        fits = np.flatnonzero(np.asarray((100 * found >= low * score) & (100 * found <= high * score), bool)) if score >= 0 else none[0]
        first = fits[shard.first(rows[fits], found[fits], k)]
        out.append((rows[first], found[first]))
    return out


# ---- batches -------------------------------------------------------------------------

def _matrix(column: pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def _angle_batches(directions: dict[int, np.ndarray], scale: float):
    """Rows with ``angles`` beside the vector; none for a length without references."""
    def run(batches):
        for batch in batches:
            size = batch.column("size").to_numpy()
            angles: list = [np.zeros(0, np.float32)] * len(size)
            for width in np.intersect1d(size, list(directions)):
                at = np.flatnonzero(size == width)
                values = whole(_matrix(batch.column("embedding").take(pa.array(at)), int(width)), scale)
                for i, row in zip(at, angles_to(values, directions[width]).astype(np.float32)):
                    angles[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(angles, pa.list_(pa.float32()))], [*batch.schema.names, "angles"])
    return run


def _clip(score) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, int(score)))


def _visit_batches(scale: float, answer):
    """Sorted rows of shards, members before queries; ``answer(shard, query, row)`` gives each query's output rows."""
    def run(batches):
        key, members, shard = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("shard", "size", "is_query")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            out = []
            for a, b in zip(cuts, cuts[1:]):
                s, size, is_query = (int(x) for x in keys[:, a])
                if (s, size) != key:
                    key, members, shard = (s, size), [], None
                part = batch.slice(a, b - a)
                if not is_query:
                    members.append(part)
                    continue
                if not members:
                    continue
                if shard is None:
                    shard = _shard(members, size, scale)
                values = whole(_matrix(part.column("embedding"), size), scale)
                angles = _angles(part)
                for i, row in enumerate(part.select(["uid", "vec_id", "label", "positives"]).to_pylist()):
                    out += answer(shard, Query(row["uid"], row["label"], values[i], angles[i]), row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(column, kind.type) for column, kind in zip(zip(*out), FOUND_ARROW)], schema=FOUND_ARROW)
    return run


def _angles(part: pa.RecordBatch) -> np.ndarray:
    angles = part.column("angles")
    return _matrix(angles, len(angles[0]), np.float32)


def _shard(parts: list[pa.RecordBatch], size: int, scale: float) -> Shard:
    columns = {c: pa.concat_arrays([part.column(c) for part in parts]) for c in ("uid", "vec_id", "label", "embedding", "angles")}
    ids = columns["vec_id"]
    return Shard(columns["uid"].to_numpy(), ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), columns["label"].to_numpy(),
                 whole(_matrix(columns["embedding"], size), scale), _matrix(columns["angles"], len(columns["angles"][0]), np.float32).T)


FOUND = ("anchor_uid long, anchor_id long, place int, positive_id long, positive_score long, positive_exact string, "
         "vec_id long, score long, exact string")
FOUND_ARROW = pa.schema([("anchor_uid", pa.int64()), ("anchor_id", pa.int64()), ("place", pa.int32()), ("positive_id", pa.int64()),
                         ("positive_score", pa.int64()), ("positive_exact", pa.string()), ("vec_id", pa.int64()), ("score", pa.int64()), ("exact", pa.string())])


def _found(query: Query, row: dict, shard: Shard, rows, scores, place=None, positive=None) -> list[tuple]:
    about = (positive["vec_id"], positive["score"], positive["exact"]) if positive else (None, None, None)
    return [(query.uid, row["vec_id"], place, *about, int(shard.ids[r]) if shard.known[r] else None, _clip(s), str(s) if s != _clip(s) else None)
            for r, s in zip(rows.tolist(), scores.tolist())]


def _positives(k: int):
    return lambda shard, query, row: _found(query, row, shard, *best_of_label(shard, query, k))


def _negatives(k: int, low: int, high: int):
    def answer(shard, query, row):
        scores = [int(p["exact"] or p["score"]) for p in row["positives"]]
        found = best_in_windows(shard, query, scores, k, low, high)
        return [out for place, (positive, best) in enumerate(zip(row["positives"], found))
                for out in _found(query, row, shard, *best, place, positive)]
    return answer


# ---- jobs ----------------------------------------------------------------------------

def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of each key: by score (beyond 64 bits by its digits), then by id, null ids last."""
    beyond = F.coalesce(F.col("exact").cast("decimal(38,0)"), F.col("score").cast("decimal(38,0)"))
    best = Window.partitionBy(*keys).orderBy(beyond.desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def with_angles(vectors: DataFrame, scale: int) -> DataFrame:
    """Usable rows with a number, their length and their angles to the references of that length, written once."""
    rows = (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding")
            .filter(F.col("label").isNotNull() & finite("embedding"))
            .withColumn("size", F.size("embedding")).withColumn("uid", F.monotonically_increasing_id()))
    rows = stored(rows, "vectors")
    sample = rows.orderBy(F.xxhash64(F.lit(11), "uid")).limit(SAMPLE).select("embedding").toPandas()["embedding"]
    by_size: dict[int, list] = {}
    for v in sample:
        by_size.setdefault(len(v), []).append(v)
    fitted = {}
    for size, held in by_size.items():
        values = whole(np.asarray(held, np.float64).reshape(len(held), size), scale)
        values = values[np.abs(values).max(axis=1, initial=0.0) <= SAFE]
        if size and len(values):
            fitted[size] = reference_directions(values)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return stored(rows.mapInArrow(tidied(_angle_batches(fitted, scale)), fields + ", angles array<float>"), "angles")


def mine(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, scale: int = 256, low: int = 50, high: int = 95,
         shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by ``every``; their positives the first ``positives`` other rows of their label, by
    integer inner product of floor(scale * x), ties to the smaller vec_id. For each, the first ``negatives`` rows of other
    labels whose score is ``low`` to ``high`` percent of the positive's. A null label or vector, or one with null or non-finite
    components, takes no part; only vectors of equal length meet; an empty vector scores 0, as does a
    zero one. A row without vec_id is no anchor, but may be found, after others of its score. Repeated rows
    are rows of their own: a row leaves out only itself, and a repeated anchor is answered once for each. Scores
    outside 64 bits are ranked exactly (up to 38 digits) and clipped. Other columns are not read; an empty table gives no rows.
    """
    rows = with_angles(vectors, scale)
    total, widest = rows.agg(F.count(F.lit(1)), F.max("size")).first()
    held = max(shard_bytes // (8 * max(widest or 1, 1)), CELL)
    shards = max(-(-total // held), min(32, -(-total // 512)), 1)
    # a label of n rows is dealt in parts of about a quarter of a shard; parts go to shards by a hash
    groups = stored(rows.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n"))
                    .select("label", "size", F.ceil(F.col("n") / max(total / shards / 4, 1)).cast("bigint").alias("parts")), "groups")

    def shard(part: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(13), "label", "size", part), F.lit(shards)).cast("int")

    grouped = rows.join(groups, ["label", "size"])
    none = F.lit(None).cast("array<struct<vec_id: bigint, score: bigint, exact: string>>")
    columns = ["shard", "size", "is_query", "uid", "vec_id", "label", "embedding", "angles", "positives"]
    members = (grouped.withColumn("part", F.pmod(F.xxhash64(F.lit(17), "uid"), "parts")).withColumn("shard", shard(F.col("part")))
               .withColumn("is_query", F.lit(False)).withColumn("positives", none).select(*columns))
    anchors = grouped.filter(F.col("vec_id") % every == 0).withColumn("is_query", F.lit(True))
    own = (anchors.withColumn("positives", none).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
           .withColumn("shard", shard(F.col("part"))).select(*columns).dropDuplicates(["uid", "shard"]))

    def visit(queries: DataFrame, answer) -> DataFrame:
        return (members.unionByName(queries).repartition("shard", "size").sortWithinPartitions("shard", "size", "is_query")
                .mapInArrow(tidied(_visit_batches(scale, answer)), FOUND))

    best = _ranked(visit(own, _positives(positives)), ["anchor_uid"], positives)
    lists = best.groupBy("anchor_uid").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score", "exact"))).alias("p"))
    windows = lists.select(F.col("anchor_uid").alias("uid"), F.expr("transform(p, x -> struct(x.vec_id, x.score, x.exact))").alias("positives"))
    windows = stored(anchors.drop("parts").join(windows, "uid"), "anchors")
    everywhere = windows.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select(*columns)
    return (_ranked(visit(everywhere, _negatives(negatives, low, high)), ["anchor_uid", "place"], negatives)
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def shifted_labels(vectors: DataFrame) -> DataFrame:
    """The rows with label (label + 1) % 10 where vec_id is divisible by 7."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


SQL = """
WITH given AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.uid AS anchor_uid, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM given a JOIN given b ON a.vec_id % 50 = 0 AND a.uid <> b.uid AND len(a.v) = len(b.v)),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_uid ORDER BY score DESC, vec_id NULLS LAST) AS place
  FROM scored WHERE same QUALIFY place <= 5),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_uid, p.place ORDER BY n.score DESC, n.vec_id NULLS LAST) AS rank
  FROM positives p JOIN scored n ON p.anchor_uid = n.anchor_uid AND NOT n.same
   AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 3
"""
