"""Document quality by Bradley-Terry pairwise ranking.

A document's utility is a weighted sum of features of its whole text. Weights are learned from
preference pairs (a good and a bad labelled document) by logistic loss on feature
differences: P(i preferred to j) = 1 / (1 + exp(-(u_i - u_j))). All labelled documents that are not held out
are learned from: they are dealt to groups of a bounded size, each group's weights are trained in its
task, and the model has their mean. The decision threshold is the exact quantile of all their
utilities at the share of bad ones, and a monotone map puts it at the wanted score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.llm.common import stored, tidied
from quarterstone.llm.terms import Words, held_out, labelled, slices, split
from quarterstone.llm.toxicity import logistic
from quarterstone.operators.percentiles import exact_percentiles

GROUP = 12_000  # labelled documents trained on together; all of them are, in groups of about so many
PARTNERS = 24  # good documents each bad one is paired with, and the other way round
THRESHOLD = 0.3
FEATURES = ["symbols", "digits", "shouted", "marked_ends", "distinct", "distinct_for_length", "top_share", "echoed",
            "no_letters", "word_length", "length_spread", "log_words", "short_text", "log_longest"]


def features(words: Words) -> np.ndarray:
    """One row per document; an empty document has zeros everywhere but in ``short_text``."""
    n = np.maximum(words.counts, 1)
    kinds = np.array([(len(w), sum(not c.isalnum() for c in w), sum(c.isdigit() for c in w), w.isupper() and len(w) > 1,
                       not w[-1].isalnum() and w[-1] not in ".,;:", not any(map(str.isalpha, w)))
                      for w in words.distinct], float).reshape(-1, 6)
    of_word = kinds[words.codes]
    length, odd, digits, upper, marked, bare = (words.per_document(of_word[:, k]) for k in range(6))
    squares = words.per_document(of_word[:, 0] ** 2)
    document, _, times = words.pairs(np.arange(len(words.distinct)))
    distinct = np.bincount(document, minlength=len(n))
    top, longest = np.zeros(len(n)), np.zeros(len(n))
    np.maximum.at(top, document, times)
    np.maximum.at(longest, words.owner, of_word[:, 0])
    same = np.zeros(len(words.codes))
    same[1:] = words.codes[1:] == words.codes[:-1]
    inner = words.starts[words.counts > 0]
    same[inner] = 0
    size = np.maximum(length, 1)
    return np.stack([
        odd / size, digits / size, upper / n, marked / n, distinct / n, np.log1p(distinct) / np.log1p(n), top / n,
        words.per_document(same) / n, bare / n, length / n, np.sqrt(np.maximum(squares / n - (length / n) ** 2, 0)),
        np.log1p(words.counts), words.counts < 20, np.log1p(longest)], axis=1)


@dataclass
class Ranker:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float  # utility that gets the threshold's score
    steepness: float = 1.0
    threshold: float = THRESHOLD

    def utility(self, rows: np.ndarray) -> np.ndarray:
        return expanded((rows - self.center) / self.scale) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        level = np.log(self.threshold / (1 - self.threshold))
        return logistic(self.steepness * (self.utility(rows) - self.cut) + level)


def expanded(rows: np.ndarray) -> np.ndarray:
    """Features and their squares, so that both too little and too much can count against a text."""
    rows = np.clip(rows, -6, 6)
    return np.concatenate([rows, rows * rows], axis=1)


def train(rows: np.ndarray, labels: np.ndarray, threshold: float = THRESHOLD, partners: int = PARTNERS, rounds: int = 300,
          rate: float = 0.05, decay: float = 1e-4, seed: int = 6, shape: tuple[np.ndarray, np.ndarray] | None = None) -> Ranker:
    """Adam on the mean pair loss. Without documents of both kinds all documents score alike. ``shape`` gives the
    features' means and deviations, if the rows are only some of those learned from."""
    width = len(FEATURES)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        one_kind = Ranker(np.zeros(width), np.ones(width), np.zeros(2 * width), 0.0, threshold=threshold)
        one_kind.cut = -2.0 if len(good) else 0.0 if not len(bad) else 2.0
        return one_kind
    center, scale = shape or (rows.mean(axis=0), rows.std(axis=0))
    scale = np.where(scale < 1e-9, 1, scale)
    x = expanded((rows - center) / scale)
    draw = np.random.default_rng(seed)
    better = np.concatenate([draw.choice(good, len(bad) * partners), np.repeat(good, partners)])
    worse = np.concatenate([np.repeat(bad, partners), draw.choice(bad, len(good) * partners)])
    weights, first, second = np.zeros(x.shape[1]), 0.0, 0.0
    for step in range(1, rounds + 1):
        u = x @ weights
        wrong = logistic(u[worse] - u[better]) / len(better)
        push = np.bincount(better, wrong, len(x)) - np.bincount(worse, wrong, len(x))
        g = -(x.T @ push) + decay * weights
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        weights = weights - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    u = x @ weights
    return Ranker(center, scale, weights, float(np.quantile(u, len(bad) / len(labels))), threshold=threshold)


def _feature_batches(batches):
    for batch in batches:
        for part in slices(batch, 1):
            rows = features(split(part.column(1)))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "features"])


def featured(docs: DataFrame) -> DataFrame:
    """doc_id, features of every document, written once: a row is as short as its features, so texts are never shuffled."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return stored(rows.mapInArrow(tidied(_feature_batches), "doc_id long, features array<double>"), "features")


def _matrix(lists) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _trained(shape: tuple[np.ndarray, np.ndarray]):
    """The weights of a group and the number of its documents; none without documents of both kinds, as it has no pair."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("label", "ascending")])
        labels = table.column("label").to_numpy()
        both = 0 < labels.sum() < len(labels)
        weights = [train(_matrix(table.column("features")), labels, shape=shape).weights] if both else []
        return pa.table({"n": pa.array([len(labels)] * len(weights), pa.int64()), "weights": pa.array(weights, pa.list_(pa.float64()))})
    return run


def _value_batches(values, name: str):
    """doc_id and a value of each row's features."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values(_matrix(batch.column(1))))], ["doc_id", name])
    return run


def learn(found: DataFrame, labels: DataFrame, group: int = GROUP, threshold: float = THRESHOLD) -> Ranker:
    """A ranker from the features (``featured``) of all labelled documents that are not held out. Of several
    texts of a doc_id that whose features have the smallest hash counts. A row of 28 weights for each
    group reaches the driver, and sums over all documents."""
    each = found.filter(~held_out()).groupBy("doc_id").agg(F.min_by("features", F.xxhash64("features")).alias("features"))
    rows = stored(each.join(labelled(labels, "quality"), "doc_id").select("doc_id", "label", "features"), "learned")
    parts = [F.col("features")[i] for i in range(len(FEATURES))]
    n, good, *sums = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0)), *map(F.avg, parts), *map(F.stddev_pop, parts)).first()
    if good in (0, n):
        return train(np.zeros((min(n, 1), len(FEATURES))), np.full(min(n, 1), int(good > 0)), threshold)
    shape = np.array(sums[:len(FEATURES)]), np.array(sums[len(FEATURES):])
    dealt = rows.groupBy(F.pmod(F.xxhash64(F.lit(17), "doc_id", "label"), F.lit(-(-n // group))))
    trained = dealt.applyInArrow(_trained(shape), "n long, weights array<double>").toArrow()
    width = 2 * len(FEATURES)
    weights = np.zeros(width)
    if trained.num_rows:
        ordered = sorted(zip(trained.column("n").to_pylist(), trained.column("weights").to_pylist()))
        weights = np.average([w for _, w in ordered], axis=0, weights=[k for k, _ in ordered])
    model = Ranker(shape[0], np.where(shape[1] < 1e-9, 1, shape[1]), weights, 0.0, threshold=threshold)
    utilities = rows.select("doc_id", "features").mapInArrow(_value_batches(model.utility, "u"), "doc_id long, u double")
    cut = exact_percentiles(utilities.withColumn("all", F.lit(0)), "all", {"cut": (F.col("u"), (n - good) / n)}, stage=stored)
    model.cut = cut.first()["cut"]
    return model


def classify(docs: DataFrame, labels: DataFrame, group: int = GROUP, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    A null text counts as empty and is scored like any other; a null doc_id counts as held out;
    labels with null values, or other than 0 and 1, are not learned from; a repeated label counts once, and of
    several texts of a labelled doc_id one is learned from. Repeated documents are scored alike. An empty table gives an empty result.
    """
    found = featured(docs)
    model = learn(found, labels, group, threshold)
    return (found.mapInArrow(_value_batches(model.score, "score"), "doc_id long, score double")
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")))
