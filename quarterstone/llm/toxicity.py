"""Toxicity by a factorization machine over hashed terms.

    y(x) = b + sum_j w_j x_j + sum_{j<l} <v_j, v_l> x_j x_l,    score = 1 / (1 + exp(-y))

x_j is 1 where a term of bucket j, or a term's first letters, occurs in the document. The factors v learn pairs of terms, such
as an insult beside a group's name, that additive weights miss; the pairwise sum is taken as half
of (sum v x)^2 - sum (v x)^2, in time linear in the terms. The model is trained on a bounded sample
of labelled rows; every whole text is scored by tasks that carry only the buckets seen in training.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.llm.common import tidied
from quarterstone.llm.terms import Words, hashed, held_out, learning_rows, one_each, slices, split

SAMPLE = 12_000  # most labelled documents learned from
LEAST_DOCUMENTS = 5  # a bucket must occur in so many of them
MOST_BUCKETS = 2048  # buckets kept, those whose presence tells most about the label (chi-square)
FACTORS = 4
STEM = 4  # letters of a term that make a feature of their own


@dataclass
class Machine:
    buckets: np.ndarray  # ascending
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, document: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """y for n documents from their (document, feature) pairs, ascending by document."""
        y = np.full(n, self.bias) + np.bincount(document, self.weights[feature], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[feature, f]
            y += 0.5 * (np.bincount(document, v, n) ** 2 - np.bincount(document, v * v, n))
        return y

    def place(self, numbers: np.ndarray) -> np.ndarray:
        """Feature of each bucket number, -1 where training has not seen it."""
        if not len(self.buckets):
            return np.full(len(numbers), -1)
        at = np.minimum(np.searchsorted(self.buckets, numbers), len(self.buckets) - 1)
        return np.where(self.buckets[at] == numbers, at, -1)


def logistic(y: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * y))


def train(document: np.ndarray, bucket: np.ndarray, labels: np.ndarray, factors: int = FACTORS, rounds: int = 80,
          rate: float = 0.05, decay: float = 2e-4, seed: int = 5) -> Machine:
    """Full-batch Adam on the mean logistic loss. Without labels of both kinds: the smoothed base rate."""
    n = len(labels)
    base = (labels.sum() + 0.5) / (n + 1.0)
    bias = float(np.log(base / (1 - base)))
    kept, seen = np.unique(bucket, return_counts=True)
    place = np.searchsorted(kept, bucket)
    toxic = np.bincount(place, labels[document], len(kept)) if len(kept) else np.zeros(0)
    share = labels.mean() if n else 0.0
    tells = (toxic - seen * share) ** 2 / np.maximum(seen * max(share * (1 - share), 1e-9) * (1 - seen / (n + 1)), 1e-9)
    kept, tells = kept[seen >= LEAST_DOCUMENTS], tells[seen >= LEAST_DOCUMENTS]
    kept = np.sort(kept[np.lexsort((kept, -tells))[:MOST_BUCKETS]])
    model = Machine(kept, bias, np.zeros(len(kept)), np.random.default_rng(seed).normal(0, 0.01, (len(kept), factors)))
    if n == 0 or labels.min() == labels.max() or not len(kept):
        model.factors[:] = 0
        return model
    feature = model.place(bucket)
    document, feature = document[feature >= 0], feature[feature >= 0]
    size = len(kept)
    values = [model.weights, *model.factors.T.copy()]
    first, second = [np.zeros(size) for _ in values], [np.zeros(size) for _ in values]
    b1 = b2 = 0.0
    for step in range(1, rounds + 1):
        model.weights, model.factors = values[0], np.stack(values[1:], axis=1)
        error = (logistic(model.raw(document, feature, n)) - labels) / n
        of_pair = error[document]
        gradients = [np.bincount(feature, of_pair, size)]
        for f in range(factors):
            v = values[1 + f][feature]
            rest = np.bincount(document, v, n)[document] - v
            gradients.append(np.bincount(feature, of_pair * rest, size))
        g = error.sum()
        b1, b2 = 0.9 * b1 + 0.1 * g, 0.99 * b2 + 0.01 * g * g
        fix1, fix2 = 1 - 0.9 ** step, 1 - 0.99 ** step
        model.bias -= rate * (b1 / fix1) / (np.sqrt(b2 / fix2) + 1e-8)
        for k, g in enumerate(gradients):
            g = g + decay / 100 * values[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            values[k] = values[k] - rate * ((first[k] / fix1) / (np.sqrt(second[k] / fix2) + 1e-6))
    model.weights, model.factors = values[0], np.stack(values[1:], axis=1)
    return model


def _present(words: Words, place=lambda numbers: numbers) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) for each feature present, ascending by document."""
    terms, stems = (words.pairs(place(hashed(words.distinct, length))) for length in (None, STEM))
    document, feature = (np.concatenate([a, b]) for a, b in zip(terms[:2], stems[:2]))
    order = np.argsort(document, kind="stable")
    return document[order], feature[order]


def _term_batches(batches):
    for batch in batches:
        for part in slices(batch, 1):
            words = split(part.column(1))
            document, bucket = _present(words)
            ends = np.searchsorted(document, np.arange(part.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bucket.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), lists], ["doc_id", "label", "buckets"])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    rows = one_each(learning_rows(docs, labels, "toxic", sample)
                    .mapInArrow(tidied(_term_batches), "doc_id long, label int, buckets array<int>"), "buckets").toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    lists = rows.column("buckets").combine_chunks()
    label = rows.column("label").to_numpy().astype(float)
    if not len(label):
        return train(np.zeros(0, np.int64), np.zeros(0, np.int64), label)
    document = np.repeat(np.arange(len(label)), np.diff(np.asarray(lists.offsets)))
    return train(document, lists.flatten().to_numpy().astype(np.int64), label)


def _score_batches(model: Machine):
    def run(batches):
        for batch in batches:
            for part in slices(batch, 0):
                words = split(part.column(0))
                document, feature = _present(words, model.place)
                y = model.raw(document, feature, part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(logistic(y))], [*part.schema.names[1:], "score"])
    return run


def score(docs: DataFrame, model: Machine, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row with ``score`` (0 to 1); only the text is an input."""
    rows = docs.select(F.coalesce("text", F.lit("")).alias("_scored_text"), *keep)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(tidied(_score_batches(model)), f"{kinds}{', ' if kinds else ''}score double")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    A null or empty text is scored by the bias alone; a null doc_id counts as held out; labels with
    null values, or other than 0 and 1, are not learned from; a repeated label counts once, and of several texts
    of a labelled doc_id one is learned from. Repeated documents are scored alike. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return (score(rows, learn(docs, labels, sample), ["doc_id"])
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")))
