"""Hashed word n-gram logistic regression, trained by follow-the-regularised-leader.

Words are runs of letters and digits, or of ASCII punctuation. Features are the
hashed one and two word runs of a text, weighted by ``sqrt(count)`` and scaled to
unit length, so a text's length has no part in its score. A word that follows
itself gives one feature of its own kind, whatever the word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.texts import U64, chain, present, row_groups, row_key, slices, split_words, string_buffer


@dataclass(frozen=True)
class Settings:
    """``bits``: size of the weight vector. ``alpha, beta, l1, l2``: as the update rule names them.

    ``most_labelled`` bounds the labelled rows that training reads: those with the
    least key hash, so the choice does not depend on partitions.
    """

    bits: int = 20
    sizes: tuple[int, ...] = (1, 2)
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.01
    l2: float = 0.05
    passes: int = 4
    most_labelled: int = 12_000


def _runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """The n-gram hashes, all runs of one and the same word as one."""
    out = chain(hashes, n)
    if n > 1 and len(out):
        steps = np.concatenate([[0], np.cumsum(hashes[1:] == hashes[:-1])])
        out[steps[n - 1 :] - steps[: len(out)] == n - 1] = U64(n)
    return out


def features(raw: np.ndarray, bounds: np.ndarray, settings: Settings):
    """Per row its feature numbers and weights."""
    for low, high in row_groups(bounds):
        own = bounds[low : high + 1] - bounds[low]
        words = split_words(raw[bounds[low] : bounds[high]], own, symbols="apart")
        runs = [(n, _runs(words.hash, n) >> U64(64 - settings.bits)) for n in settings.sizes]
        for a, b in zip(words.first[:-1], words.first[1:]):
            found = np.concatenate([r[a : max(a, b - n + 1)] for n, r in runs])
            numbers, counts = np.unique(found.astype(np.int64), return_counts=True)
            weights = np.sqrt(counts)
            yield numbers, weights / max(1e-12, np.linalg.norm(weights))


class Leader:
    """Weights kept as follow-the-regularised-leader's running sums; index ``2 ** bits`` is the bias."""

    def __init__(self, settings: Settings):
        self.settings = settings
        self.sums = np.zeros((1 << settings.bits) + 1)
        self.squares = np.zeros((1 << settings.bits) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        s, z = self.settings, self.sums[at]
        l1 = np.full(z.shape, s.l1)
        l1[-1] = 0.0  # the bias comes last and is not drawn to zero
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((s.beta + np.sqrt(self.squares[at])) / s.alpha + s.l2)

    def learn(self, numbers: np.ndarray, values: np.ndarray, label: float) -> None:
        at, x = np.append(numbers, len(self.sums) - 1), np.append(values, 1.0)
        w = self.weights(at)
        g = (sigmoid(float(w @ x)) - label) * x
        squares = self.squares[at]
        step = (np.sqrt(squares + g * g) - np.sqrt(squares)) / self.settings.alpha
        self.sums[at] += g - step * w
        self.squares[at] = squares + g * g


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def train(texts: pa.Array, labels: np.ndarray, settings: Settings) -> np.ndarray:
    """The weight vector, bias last. The order of rows is shuffled by a fixed seed in each pass."""
    rows = list(features(*string_buffer(texts), settings))
    model, rng = Leader(settings), np.random.default_rng(1)
    for _ in range(settings.passes):
        for i in rng.permutation(len(rows)):
            model.learn(*rows[i], float(labels[i]))
    return model.weights().astype(np.float32)


def _scores(weights_value, settings: Settings):
    def run(batches):
        weights = weights_value.value
        for batch in slices(batches):
            found = [weights[n].astype(np.float64) @ v + weights[-1] for n, v in features(*string_buffer(batch.column("text")), settings)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sigmoid(np.array(found, float)))], ["doc_id", "score"])

    return run


def held_out(modulus: int, remainder: int) -> Column:
    """Whether a row is kept from training, by the CRC of its id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def labelled_rows(docs: DataFrame, labels: DataFrame, target: str, out: Column, most: int):
    """Texts and labels to learn from: the ``most`` rows with the least hash, held-out rows left out."""
    known = labels.select("doc_id", F.col(target).cast("int").alias("label")).where(F.col("label").isin(0, 1) & ~out).distinct()
    rank = F.xxhash64("doc_id", F.lit(17))
    few = known.orderBy(rank, "doc_id", "label").limit(most)
    rows = present(docs, "doc_id").select("doc_id", row_key(), "text").join(F.broadcast(few), "doc_id")
    table = rows.orderBy("row_key", "label").select("text", "label").limit(most).toArrow()
    return table.column("text").combine_chunks(), table.column("label").to_numpy().astype(float)


def scored(docs: DataFrame, labels: DataFrame, target: str = "quality", out: Column | None = None, settings: Settings | None = None) -> DataFrame:
    """``doc_id, score`` per row of ``docs``: how likely the label is 1, from the text alone.

    Labels other than 0 and 1, null labels and rows for which ``out`` holds are
    not learnt from. Without any label all scores are 0.5. Null texts count as
    empty: their score is that of a text without features. Repeated rows get
    equal scores.
    """
    settings = settings or Settings()
    out = F.lit(False) if out is None else out
    texts, known = labelled_rows(docs, labels, target, out, settings.most_labelled)
    weights = docs.sparkSession.sparkContext.broadcast(train(texts, known, settings))
    return present(docs, "doc_id").mapInArrow(_scores(weights, settings), "doc_id bigint, score double")
