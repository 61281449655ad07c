"""Operator 6: quality classifier on supervised subword embeddings.

A document is the average of the vectors of its features: hashed words, hashed character
n-grams of the words, and a mark for a word that repeats the one before it. A softmax over
the average gives the score. Vectors and output weights are learned together by stochastic
gradient descent in numpy, on a bounded sample of labelled documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fieldcast.llm.common import give_back, slices, texts_of

BUCKETS = 1 << 16
GRAMS = (3, 4)         # lengths of the character n-grams of <word>
DIM = 8
STEPS = 2400           # updates, whatever the size of the sample
RATE = 8.0
BATCH = 16
SAMPLE = 1500          # labelled documents of each class at most, the smallest by a hash of the id
FOLDS = 5              # rows of fold 0 are held out
THRESHOLD = 0.3
SLICE_CHARS = 2_000_000
KNOWN = 120_000        # a worker forgets all words once it knows twice as many
REPEAT = 0             # bucket of the mark for a repeated word


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS))


def held_out(doc_id: Column) -> Column:
    """True for fold 0; a row without an id is never learned from."""
    return F.coalesce(fold(doc_id) == 0, F.lit(True))


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each feature, index of its word) for a list of words."""
    whole = np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words)) % (BUCKETS - 1) + 1
    points = np.frombuffer(("<" + ">\n<".join(words) + ">").encode("utf-32-le"), "<u4").astype(np.uint64)
    breaks = points == 10
    owner = np.cumsum(breaks)
    buckets, owners = [whole], [np.arange(len(words))]
    for n in GRAMS:
        size = points.size - n + 1
        if size <= 0:
            continue
        code, inside = np.full(size, n, np.uint64), np.ones(size, bool)
        for k in range(n):
            code = code * np.uint64(0x100000001B3) + points[k:k + size]
            inside &= ~breaks[k:k + size]
        code = (code ^ code >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
        buckets.append((code[inside] >> np.uint64(33)).astype(np.int64) % (BUCKETS - 1) + 1)
        owners.append(owner[:size][inside])
    return np.concatenate(buckets), np.concatenate(owners)


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct buckets, how often) of a whole text."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    names, index = np.unique(np.array(words, object), return_inverse=True)
    buckets, owner = word_features(names.tolist())
    counts = np.bincount(buckets, weights=np.bincount(index)[owner], minlength=BUCKETS)
    counts[REPEAT] += int((index[1:] == index[:-1]).sum())
    at = np.flatnonzero(counts)
    return at, counts[at].astype(np.int64)


@dataclass
class Model:
    """What scoring needs: per bucket the difference of the two softmax inputs."""

    lean: np.ndarray
    bias: float


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """``rows``: (buckets, counts, label) of the sample, in a fixed order.

    With one class only, or no row, the score is that class everywhere, or 0.5.
    """
    labels = np.array([r[2] for r in rows], np.int64)
    if len(set(labels.tolist())) < 2:
        bias = {(): 0.0, (0,): -10.0, (1,): 10.0}[tuple(set(labels.tolist()))]
        return Model(np.zeros(BUCKETS, np.float32), bias)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    weights, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    balance = len(labels) / (2 * np.bincount(labels, minlength=2))
    done = 0
    while done < STEPS:
        order = rng.permutation(len(rows))
        for a in range(0, len(rows), BATCH):
            some = order[a:a + BATCH]
            rate = RATE * max(1 - done / STEPS, 0)
            done += 1
            parts = [(rows[i][0], rows[i][1] / max(rows[i][1].sum(), 1)) for i in some]
            mean = np.stack([share @ vectors[at] for at, share in parts]).astype(np.float32)
            logits = mean @ weights + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(some)), labels[some]] -= 1
            error = (p * balance[labels[some]][:, None] / len(some)).astype(np.float32)
            back = error @ weights.T
            weights -= rate / 8 * mean.T @ error
            bias -= rate / 8 * error.sum(0)
            for (at, share), gradient in zip(parts, back):
                vectors[at] -= rate * np.outer(share, gradient).astype(np.float32)
    return Model((vectors @ (weights[:, 1] - weights[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """doc_id, text, label: ``most`` documents of each class outside fold 0, those with the
    smallest hash of the id. Ids labelled both ways, null labels and null texts stay out."""
    clear = (
        labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
        .where("label = other").join(docs.where("text is not null").select("doc_id"), "doc_id", "left_semi")
    )
    chosen = None
    for label in (0, 1):
        part = clear.where(F.col("label") == label).select("doc_id", "label").orderBy(
            F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    # 2 * most rows of two integers: a proven bound for the broadcast
    return docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    """Train on the sample. Features are counted in tasks; the driver gets at most ``BUCKETS``
    pairs of numbers for each of 2 * ``most`` documents, usually one or two thousand."""

    def count(batches):
        for batch in batches:
            found = [text_features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2).cast(pa.int32()),
                 pa.array([f[0].astype("<u2").tobytes() for f in found], pa.binary()),
                 pa.array([f[1].astype("<u4").tobytes() for f in found], pa.binary())],
                names=["doc_id", "label", "at", "n"])

    rows = (
        labelled_sample(docs, labels, most)
        .mapInArrow(count, "doc_id long, label int, at binary, n binary")
        .toArrow().to_pylist()
    )
    unique = {r["doc_id"]: r for r in sorted(rows, key=lambda r: (r["doc_id"], r["at"], r["n"]))}
    return train([
        (np.frombuffer(r["at"], "<u2").astype(np.int64), np.frombuffer(r["n"], "<u4").astype(np.float32), r["label"])
        for r in unique.values()])


class Scorer:
    """Scores with a memory of words: a word adds its features' leanings and their number."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self):
        self.index: dict[str, int] = {}
        self.lean, self.count = np.zeros(0), np.zeros(0)

    def _learn(self, words: list[str]):
        if len(self.index) > 2 * KNOWN:
            self._forget()
        new = [w for w in words if w not in self.index]
        if new:
            buckets, owner = word_features(new)
            lean = np.bincount(owner, weights=self.model.lean[buckets], minlength=len(new))
            count = np.bincount(owner, minlength=len(new))
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.lean, self.count = np.append(self.lean, lean), np.append(self.count, count)

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts))
        for a, b in slices(map(len, texts), SLICE_CHARS):
            split = [t.split() for t in texts[a:b]]
            self._learn(sorted(set().union(*split)))
            for k, words in enumerate(split, a):
                at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
                again = int((at[1:] == at[:-1]).sum())
                total = self.lean[at].sum() + again * float(self.model.lean[REPEAT])
                out[k] = total / max(self.count[at].sum() + again, 1) + self.model.bias
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def score_column(text: Column, model: Model) -> Column:
    """The probability of label 1 for each whole text; null counts as empty, and the score of
    an empty text is that of the bias alone."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for column in batches:
            yield pa.array(np.concatenate(
                [np.zeros(0), *[scorer.scores(texts) for _, texts in texts_of(column, SLICE_CHARS)]]))
        give_back()

    return run(text)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``.

    Only the text enters a score. Repeated rows are scored each; rows without an id count as
    held out; other columns play no part.
    """
    model = fit(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         score_column(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` predicted good, with their columns unchanged, whatever their names."""
    model = fit(docs, labels)
    rows = docs.select(F.struct("*").alias("row"), score_column(F.col("text"), model).alias("score"))
    return rows.where(F.col("score") >= THRESHOLD).select("row.*")
