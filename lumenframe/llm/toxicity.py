"""Operator 8: toxicity from two class-conditional Kneser-Ney models.

A toxic and an ordinary model are learned from a bounded sample of labelled documents. A word's count in a
class is its continuation count there, the number of different words it follows, so a passage that is copied
many times counts once. Absolute discounting takes a share of every count; the share goes to a backoff that
both classes share, in which a word counts by the number of classes it continues in. So a rare expression, of
which neither class has much evidence, weighs alike in both. What is compared are length-normalised
log-likelihoods: their difference per word over the whole text, and over the text's windows of a few words,
the highest of which shows a short toxic passage in a long text. A logistic curve, fitted on other labelled
documents, turns the differences into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.llm.common import append_struct, crc_of, fresh, letter_words, texts_of, whole

#: Labelled documents of either class that the models, and as many others that the curve, are fitted on.
SAMPLE = 3000
THRESHOLD = 0.7
FOLDS, HELD_OUT_FOLD, CURVE_FOLD = 3, 1, 2
WINDOWS = (1, 4, 12)
_START = np.uint64(0)
_MIX = np.uint64(0x9E3779B97F4A7C15)

WORDS = "pair long, word long, toxic int"


def word_hashes(text: bytes) -> np.ndarray:
    words = letter_words(text)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def _pairs(words: np.ndarray) -> np.ndarray:
    """The hash of every word with the word before it; the first one follows the start mark."""
    previous = np.concatenate([[_START], words[:-1]]).astype(np.uint64)
    return (previous ^ (words >> np.uint64(29))) * _MIX + words


class Models(NamedTuple):
    """The known words and their probabilities (rows: toxic, ordinary); the last column is a new word."""

    words: np.ndarray
    prob: np.ndarray


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return min(0.95, max(0.1, once / (once + 2 * twice) if once else 0.5))


def fit_models(words: np.ndarray, follows: np.ndarray) -> Models:
    """Models from the continuation counts (2, n) of n distinct words; no words give two equal models."""
    order = np.argsort(words)
    words, follows = words[order], np.append(follows[:, order], [[0.0], [0.0]], axis=1)
    classes = (follows > 0).sum(axis=0)
    d = _discount(classes[classes > 0])
    kept = np.maximum(classes - d, 0) / max(classes.sum(), 1)
    shared = kept + (1 - kept.sum()) / (len(words) + 1)
    d = _discount(follows[follows > 0])
    rest = d * (follows > 0).sum() / follows.sum() if follows.any() else 1.0
    prob = np.empty_like(follows)
    for c in range(2):
        kept = np.maximum(follows[c] - d, 0)
        prob[c] = (1 - rest) * kept / kept.sum() + rest * shared if kept.any() else shared
    return Models(words, prob)


def log_ratios(hashes: np.ndarray, models: Models) -> np.ndarray:
    """log P(word | toxic) - log P(word | ordinary) of every word of a text."""
    n = len(models.words)
    if not len(hashes) or not n:
        return np.zeros(len(hashes))
    at = np.minimum(np.searchsorted(models.words, hashes), n - 1)
    toxic, ordinary = models.prob[:, np.where(models.words[at] == hashes, at, n)]
    return np.log(toxic) - np.log(ordinary)


def features(ratios: np.ndarray, windows: tuple[int, ...] = WINDOWS) -> list[float]:
    """The mean difference per word: over the text, and the highest over windows of each length."""
    if not len(ratios):
        return [0.0] * (1 + len(windows))
    sums = np.concatenate([[0.0], np.cumsum(ratios)])
    best = []
    for w in windows:
        size = min(w, len(ratios))
        best.append(float((sums[size:] - sums[:-size]).max()) / w)
    return [float(ratios.mean()), *best]


class Curve(NamedTuple):
    """A logistic curve over standardised features."""

    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(((rows - self.mean) / self.scale) @ self.weights + self.bias, -40, 40)))


def fit_curve(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, width: int) -> Curve:
    """Penalised logistic regression by Newton's method; with one class or none the share of toxic labels."""
    share = ((labels * weights).sum() + 0.5) / (weights.sum() + 1) if len(labels) else 0.0
    if len(np.unique(labels)) < 2:
        share = min(max(share if labels.any() else 0.0, 1e-9), 1 - 1e-9)
        return Curve(np.zeros(width), float(np.log(share / (1 - share))), np.zeros(width), np.ones(width))
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    x = np.hstack([(rows - mean) / scale, np.ones((len(rows), 1))])
    b, penalty = np.zeros(width + 1), np.diag([*[1e-2] * width, 1e-6]) * weights.sum() / len(rows)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        gradient = x.T @ (weights * (p - labels)) + penalty @ b
        step = np.linalg.solve((x.T * (weights * p * (1 - p) + 1e-9)) @ x + penalty, gradient)
        b -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return Curve(b[:-1], float(b[-1]), mean, scale)


def _chosen(labels: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` ids of each class, those with the lowest hash."""
    by_class = [
        labels.where(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(sample) for c in (0, 1)
    ]
    return by_class[0].unionByName(by_class[1])


def _sampled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(toxic, text) of the chosen documents; the ids are at most 2 x ``sample``. Equal texts count once."""
    rows = docs.join(F.broadcast(_chosen(labels, sample)), "id").select("toxic", "text")
    return rows.dropDuplicates(["toxic", "text"])


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, toxic in zip(texts_of(batch, "text"), batch.column("toxic").to_pylist(), strict=True):
            words = word_hashes(text)
            pairs, first = np.unique(_pairs(words), return_index=True)
            columns = [pa.array(x.view(np.int64)) for x in (pairs, words[first])]
            marks = pa.array(np.full(len(pairs), toxic, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*columns, marks], names=["pair", "word", "toxic"])


def _fitted(sampled: DataFrame) -> Models:
    """The words of at most 2 x ``sample`` texts with their continuation counts come to the driver."""
    pairs = sampled.mapInArrow(_paired, WORDS).groupBy("pair", "toxic").agg(F.min("word").alias("word"))
    counts = pairs.groupBy("word").agg(
        *[F.count(F.when(F.col("toxic") == c, 1)).alias(name) for c, name in ((1, "toxic"), (0, "ordinary"))]
    )
    word, toxic, ordinary = (c.to_numpy() for c in counts.toArrow().columns)
    return fit_models(word.view(np.uint64), np.stack([toxic, ordinary]).astype(np.float64))


_SCORED = T.StructType([T.StructField("features", T.ArrayType(T.DoubleType())), T.StructField("score", T.DoubleType())])


def _with_scores(docs: DataFrame, text: str, name: str, models, curve: Curve | None) -> DataFrame:
    def scored(batch: pa.RecordBatch) -> list[dict]:
        found = [word_hashes(t) for t in texts_of(batch, text)]
        rows = np.array([features(log_ratios(h, models.value)) for h in found]).reshape(len(found), -1)
        scores = curve(rows).tolist() if curve and len(rows) else [None] * len(rows)
        return [{"features": f, "score": s} for f, s in zip(rows.tolist(), scores, strict=True)]

    return append_struct(docs, scored, name, _SCORED)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    name: str = "toxicity",
) -> tuple[DataFrame, str]:
    """Adds a struct with the ``score`` (0 to 1); returns the frame and the struct's name.

    Labels are taken from documents whose crc32(id as text) mod 3 is 0 (models) or 2 (curve); those of fold 1
    are never read. At most ``sample`` documents a class and fold are learned from, the only bounded part: all
    documents are scored from their whole text. A null label or id is no label; a document labelled both ways
    counts for both. Null and empty texts get the curve's value for no difference. Without toxic labels in
    either fold every score is near 0. Repeated rows get repeated scores; an empty table gives no rows.
    """
    name = fresh(name, docs.columns)
    spark = docs.sparkSession
    fold = F.pmod(crc_of("id"), F.lit(FOLDS))
    marked = (
        labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .where("id is not null and toxic in (0, 1)")
        .distinct()
    )
    texts = docs.select(F.col(doc_id).alias("id"), whole(text).alias("text"))
    learned = _fitted(_sampled(texts, marked.where(~fold.isin(HELD_OUT_FOLD, CURVE_FOLD)), sample))
    models = spark.sparkContext.broadcast(learned)
    curve_labels = marked.where(fold == CURVE_FOLD)
    measured = fresh("_measured", ["toxic", "text"])
    examples = _with_scores(_sampled(texts, curve_labels, sample), "text", measured, models, None)
    found = examples.select("toxic", F.col(measured)["features"].alias("f")).collect()  # at most 2 x sample
    sizes = {r["toxic"]: r["count"] for r in curve_labels.groupBy("toxic").count().collect()}
    y = np.array([r["toxic"] for r in found], dtype=np.float64)
    weights = np.array([sizes[r["toxic"]] / max(1, (y == r["toxic"]).sum()) for r in found])
    rows = np.array([r["f"] for r in found]).reshape(len(found), 1 + len(WINDOWS))
    curve = fit_curve(rows, y, weights / max(weights.mean(), 1e-9) if len(found) else weights, 1 + len(WINDOWS))
    return _with_scores(docs, text, name, models, curve), name


def held_out(doc_id: str) -> Column:
    return F.pmod(crc_of(doc_id), F.lit(FOLDS)) == HELD_OUT_FOLD


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **kwargs) -> DataFrame:
    """The documents that score below the threshold, with their own columns."""
    scored, name = score_toxicity(docs, labels, **kwargs)
    return scored.where(F.col(name)["score"] < threshold).select(*docs.columns)
