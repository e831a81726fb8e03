"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples and unlabelled text train a linear classifier over hashed
words and word beginnings. With the class prior ``p``, the risk is
``p R+(toxic) + max(0, R-(unlabelled) - p R-(toxic))``: the second part estimates the
risk on clean text, cannot be negative for a real classifier, and is corrected back
when a step drives it below zero. Features are drawn where the texts are, from whole
texts; the fit runs in numpy on a bounded sample; scoring is one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelboard.llm.tables import column, in_fold
from duelboard.llm.wordkeys import buffer_keys, in_blocks, joined, mix, word_spans

FEATURES = 1 << 20
#: Bounds of the training sample: confirmed toxic texts and unlabelled texts.
MAX_POSITIVE, MAX_UNLABELLED = 4_000, 12_000


def features(texts: list[str | None], used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, offsets): the distinct words and four-byte word beginnings of each text.

    An empty or null text has no features. ``used`` flags the features to keep.
    """
    buffer, ends = joined(texts)
    words, offsets = buffer_keys(buffer, ends)
    starts, stops = word_spans(buffer)
    padded = np.concatenate((buffer, np.zeros(4, np.uint8)))
    head = np.zeros(len(starts), np.uint64)
    for k in range(4):
        head = head << np.uint64(8) | np.where(starts + k < stops, padded[starts + k], 0).astype(np.uint64)
    n = np.diff(offsets)
    doc = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    number = np.concatenate((words, mix(head + np.uint64(1) << np.uint64(7)))) % np.uint64(FEATURES)
    pairs = np.concatenate((doc, doc)) * np.uint64(FEATURES) + number
    pairs = np.unique(pairs if used is None else pairs[used[number]])
    counts = np.bincount((pairs // np.uint64(FEATURES)).astype(np.int64), minlength=len(n))
    return (pairs % np.uint64(FEATURES)).astype(np.int32), np.concatenate(([0], np.cumsum(counts)))


@dataclass
class Classifier:
    """Linear classifier over the features it was fitted on; all others weigh nothing."""

    weights: np.ndarray
    bias: float

    def logits(self, texts: list[str | None]) -> np.ndarray:
        numbers, offsets = features(texts, self.weights != 0)
        return row_sums(self.weights[numbers], offsets) + self.bias


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def telling(positive: list[np.ndarray], unlabelled: list[np.ndarray], least: float = 4.0) -> np.ndarray:
    """Which features the fit may use: those much more frequent in toxic than in unlabelled texts.

    The difference of the two rates must be ``least`` standard errors and the rate among
    toxic texts at least twice that among unlabelled ones.
    """
    n, m = len(positive), len(unlabelled)
    p = np.bincount(np.concatenate(positive), minlength=FEATURES) / n
    u = np.bincount(np.concatenate(unlabelled), minlength=FEATURES) / m
    pooled = (p * n + u * m + 1) / (n + m + 2)
    error = np.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))
    return (p - u >= least * error) & (p >= 2 * u) & (p * n >= 3)


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, epochs: int = 300, decay: float = 1e-4) -> Classifier:
    """Fit by Adam on the non-negative risk with logistic loss over the telling features.

    Each list holds the feature numbers of one text. Where the clean risk would turn
    negative, the step goes against its gradient instead. Without positive examples, or
    without a prior between 0 and 1, everything scores the prior.
    """
    p = min(max(prior, 1e-6), 1 - 1e-6)
    start = Classifier(np.zeros(FEATURES, np.float32), float(np.log(p / (1 - p))))
    if not positive or not unlabelled or not 0 < prior < 1:
        return start
    used = np.flatnonzero(telling(positive, unlabelled))
    if not len(used):
        return start
    place = np.full(FEATURES, -1)
    place[used] = np.arange(len(used))
    rows = [place[r][place[r] >= 0] for r in (*positive, *unlabelled)]
    lengths = np.array([len(r) for r in rows])
    numbers, offsets = np.concatenate(rows), np.concatenate(([0], np.cumsum(lengths)))
    n_p, n_u = len(positive), len(unlabelled)
    weights, bias = np.zeros(len(used)), start.bias
    first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, epochs + 1):
        z = row_sums(weights[numbers], offsets) + bias
        up = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        loss_minus = np.logaddexp(0, z)
        slope = np.empty(len(z))
        if loss_minus[n_p:].mean() >= prior * loss_minus[:n_p].mean():
            slope[:n_p] = prior * ((up[:n_p] - 1) - up[:n_p]) / n_p
            slope[n_p:] = up[n_p:] / n_u
        else:  # the corrected clean risk is negative: step back
            slope[:n_p] = prior * up[:n_p] / n_p
            slope[n_p:] = -up[n_p:] / n_u
        grad = np.append(np.bincount(numbers, np.repeat(slope, lengths), len(used)) + decay * weights, slope.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        weights, bias = weights - move[:-1], bias - move[-1]
    out = start.weights
    out[used] = weights
    return Classifier(out, float(bias))


def training_sample(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> tuple[list[np.ndarray], list[np.ndarray], float]:
    """(features of confirmed toxic texts, features of unlabelled texts, class prior).

    Only rows whose ``crc32(doc_id)`` is not 0 modulo 5 are used. The unlabelled texts
    are drawn from all of these, the prior is the share of toxic ones among the labelled
    rows. Equal texts count once. Texts are picked by the smallest hash of their id, up
    to the two bounds, so the pick is the same on every run and no order of the input
    matters. An id that stands for several texts brings each of them, whatever their
    number; ids without a text, null ids and null labels take no part.
    """
    known = labels.select("doc_id", "toxic").na.drop().groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~in_fold(F.col("doc_id"), 0))
    share = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    texts = docs.select("doc_id", "text").na.drop().where(~in_fold(F.col("doc_id"), 0)).withColumn("content", F.xxhash64("text"))
    narrow = texts.select("doc_id", "content")

    def picked(rows: DataFrame, n: int) -> DataFrame:
        one_each = rows.groupBy("content").agg(F.min("doc_id").alias("doc_id"))
        return one_each.select("doc_id", "content", F.xxhash64("doc_id").alias("o")).orderBy("o", "doc_id", "content").limit(n).select("doc_id", "content")

    toxic = picked(narrow.join(known.where("toxic = 1"), "doc_id", "left_semi"), max_positive)
    free = picked(narrow, max_unlabelled)
    chosen = toxic.withColumn("kind", F.lit(1)).unionByName(free.withColumn("kind", F.lit(0)))

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in in_blocks(batch["text"].tolist()):
                part = batch.iloc[a:b]
                numbers, offsets = features(part["text"].tolist())
                own = [numbers[offsets[i] : offsets[i + 1]].tobytes() for i in range(len(part))]
                yield part[["doc_id", "content", "kind"]].assign(own=own)

    # at most max_positive + max_unlabelled pairs of id and text, so the hint is bounded; repeated rows meet before features are taken
    rows = texts.join(F.broadcast(chosen), ["doc_id", "content"]).groupBy("doc_id", "content", "kind").agg(F.min("text").alias("text"))
    rows = rows.mapInPandas(drawn, "doc_id long, content long, kind int, own binary").toPandas()
    if len(rows) > max_positive + max_unlabelled:
        raise AssertionError("more training texts than the two bounds allow")
    rows = rows.sort_values(["kind", "doc_id", "content"])
    arrays = {k: [np.frombuffer(b, np.int32) for b in rows.loc[rows["kind"] == k, "own"]] for k in (0, 1)}
    return arrays[1], arrays[0], float(share or 0.0)


def toxicity_score(text: Column, classifier: Classifier) -> Column:
    """Probability (0 to 1) that each whole text is toxic; empty and null texts score by the bias alone."""
    used = np.flatnonzero(classifier.weights)
    values, bias = classifier.weights[used], classifier.bias  # a few thousand numbers at most

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = np.zeros(FEATURES, np.float32)
        weights[used] = values
        model = Classifier(weights, bias)
        for texts in batches:
            texts = texts.tolist()
            logits = [model.logits(texts[a:b]) for a, b in in_blocks(texts)]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.concatenate(logits or [np.zeros(0)]), -50, 50))))

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, repeated rows included.

    A null id is text '' for the fold. An empty or null text gets the score of a text
    without telling words. Without labels every document scores 0.
    """
    classifier = fit(*training_sample(docs, labels))
    return docs.select(
        column(docs, "doc_id").alias("doc_id"), in_fold(column(docs, "doc_id"), 0).alias("held_out"), toxicity_score(column(docs, "text"), classifier).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs``, unchanged, whose text scores below ``threshold``."""
    classifier = fit(*training_sample(docs, labels))
    return docs.where(toxicity_score(column(docs, "text"), classifier) < threshold)
