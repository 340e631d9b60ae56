"""Toxicity by compression: which of two dictionaries a text's windows compress better with.

A zstandard dictionary is trained on ordinary texts and another on the stretches
of toxic texts that ordinary texts lack. Each window of a few words is compressed
twice, with the ordinary dictionary and with both; the bytes saved by the toxic
one are the evidence. A logistic curve, fitted on labelled rows that trained
neither dictionary, turns a text's savings into a score.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.linear import labelled_rows, sigmoid
from shelfcast.llm.texts import present, slices

# Both dictionaries end with these bytes and each window begins with them: a block that matches nothing
# else is then still compressed, not stored, and lengths can be compared to the byte.
LEAD = bytes(range(128, 192))
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """``sizes``: words in a window, at two scales.

    ``most_labelled`` bounds the labelled rows that training reads, ``fit_share`` of which calibrate the score.
    ``most_windows`` bounds the windows, drawn at random, that the ordinary dictionary is trained on.

    A ``gram`` of characters is toxic if at least ``least_docs`` toxic texts hold it
    and its shares among toxic and ordinary texts differ by ``least_z`` deviations.
    """

    sizes: tuple[int, ...] = (4, 8)
    ordinary_bytes: int = 1024
    toxic_bytes: int = 8192
    least_match: int = 5
    gram: int = 5
    least_docs: int = 5
    least_z: float = 6.0
    fit_share: float = 0.34
    most_labelled: int = 12_000
    most_windows: int = 60_000


def windows(words: list[str], size: int) -> list[bytes]:
    """Windows of ``size`` words, one after the other to the end."""
    return [f" {' '.join(words[i : i + size])} ".encode() for i in range(0, len(words), size)]


def _grams(word: str, n: int) -> list[str]:
    return [word[i : i + n] for i in range(len(word) - n + 1)]


def toxic_stretches(toxic: list[str], ordinary: list[str], s: Settings) -> list[bytes]:
    """Training samples for the toxic dictionary: the stretches of toxic grams in words, the commonest last."""

    def words(text: str) -> set[str]:
        return {f" {w} " for w in LETTERS.findall(text.lower())}

    def held(texts: list[str]) -> Counter:
        return Counter(g for t in texts for g in {g for w in words(t) for g in _grams(w, s.gram)})

    a, b = held(toxic), held(ordinary)
    n, m = len(toxic), len(ordinary)

    def z(g: str) -> float:
        p = (a[g] + b[g]) / (n + m)
        return (a[g] / n - b[g] / m) / np.sqrt(max(p * (1 - p), 1e-9) * (1 / n + 1 / m))

    marked = {g for g, k in a.items() if k >= s.least_docs and z(g) >= s.least_z}
    found: Counter = Counter()
    for text in toxic:
        own = set()
        for word in words(text):
            hits = [i for i, g in enumerate(_grams(word, s.gram)) if g in marked]
            if hits:
                own.add(word[hits[0] : hits[-1] + s.gram])
        found.update(own)
    return [x.encode() for x, _ in sorted(found.items(), key=lambda f: (f[1], f[0])) if found[x] >= 3]


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; of too few samples for the trainer, their own bytes."""
    try:
        return zstandard.train_dictionary(size, samples, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


class Savings:
    """What the toxic dictionary saves in a text's windows."""

    def __init__(self, ordinary: bytes, toxic: bytes, s: Settings):
        self.sizes = s.sizes
        self.plain, self.both = (self._compressor(d + LEAD, s.least_match) for d in (ordinary, ordinary + toxic))

    @staticmethod
    def _compressor(content: bytes, least_match: int) -> zstandard.ZstdCompressor:
        """Thorough search in a small dictionary, no frame fields."""
        options = zstandard.ZstdCompressionParameters(
            window_log=14,
            chain_log=14,
            hash_log=14,
            search_log=6,
            min_match=least_match,
            target_length=64,
            strategy=zstandard.STRATEGY_BTLAZY2,
            write_content_size=0,
            write_checksum=0,
            write_dict_id=0,
        )
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(dict_data=data, compression_params=options)

    @staticmethod
    def lengths(compressor: zstandard.ZstdCompressor, parts: list[bytes]) -> np.ndarray:
        found = compressor.multi_compress_to_buffer([LEAD + p for p in parts], threads=0)
        return np.array([len(found[i]) for i in range(len(found))])

    def features(self, text: str) -> list[float]:
        """Per scale: largest saving, mean saving beyond a byte, all savings beyond two, share of windows that save three or more."""
        words = LETTERS.findall(text.lower())
        return [x for size in self.sizes for x in self._scale(windows(words, size))]

    def _scale(self, parts: list[bytes]) -> list[float]:
        if not parts:
            return [0.0] * 4
        saved = self.lengths(self.plain, parts) - self.lengths(self.both, parts)
        over = np.maximum(saved - 2, 0).sum()
        return [float(max(saved.max(), 0)), float(np.maximum(saved - 1, 0).mean()), float(np.log1p(over)), float((saved >= 3).mean())]


@dataclass
class Model:
    """Both dictionaries and the logistic curve over the scaled features, bias last."""

    ordinary: bytes
    toxic: bytes
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    settings: Settings

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        savings = Savings(self.ordinary, self.toxic, self.settings)
        x = (np.array([savings.features(t) for t in texts]) - self.centre) / self.scale
        return sigmoid(x @ self.weights[:-1] + self.weights[-1])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's steps for a logistic curve with a small ridge; the bias, last, is free."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([*[ridge] * (x.shape[1] - 1), 1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) + penalty @ w
        w -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, slope)
    return w


def train(texts: list[str], labels: np.ndarray, s: Settings) -> Model:
    """Dictionaries from most of the rows, the curve from the rest. With one label only, its share is the score of all."""
    fit = np.random.default_rng(3).random(len(texts)) < s.fit_share
    toxic, ordinary = ([t for t, y, f in zip(texts, labels, fit) if y == k and not f] for k in (1, 0))
    n = 4 * len(s.sizes)
    blank = np.zeros(n), np.ones(n)
    if not toxic or not ordinary or len(set(labels[fit])) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        odds = np.log((share + 1e-6) / (1 - share + 1e-6))
        return Model(b"", b"", *blank, np.append(np.zeros(n), odds), s)
    parts = [w for t in ordinary for w in windows(LETTERS.findall(t.lower()), 12)]
    some = np.random.default_rng(5).permutation(len(parts))[: s.most_windows]
    base = train_dictionary([parts[i] for i in some], s.ordinary_bytes)
    stretches = toxic_stretches(toxic, ordinary, s)
    # The trainer leaves rare samples out; they follow, where matches are cheapest.
    extra = (train_dictionary(stretches * 20, s.toxic_bytes // 2) + b"".join(stretches))[-s.toxic_bytes :]
    savings = Savings(base, extra, s)
    x = np.array([savings.features(t) for t, f in zip(texts, fit) if f])
    centre, scale = x.mean(0), x.std(0) + 1e-6
    return Model(base, extra, centre, scale, _logistic((x - centre) / scale, labels[fit]), s)


def _scores(model_value):
    def run(batches):
        for batch in slices(batches):
            found = model_value.value.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    return run


def scored(docs: DataFrame, labels: DataFrame, target: str = "toxic", out: Column | None = None, settings: Settings | None = None) -> DataFrame:
    """``doc_id, score`` per row of ``docs``: how likely the label is 1, from the whole text alone.

    Labels other than 0 and 1, null labels and rows for which ``out`` holds are
    not learnt from. Null texts count as empty; a text without letters gets the
    score of one without savings. Repeated rows get equal scores.
    """
    settings = settings or Settings()
    out = F.lit(False) if out is None else out
    texts, known = labelled_rows(docs, labels, target, out, settings.most_labelled)
    model = docs.sparkSession.sparkContext.broadcast(train(texts.to_pylist(), known, settings))
    return present(docs, "doc_id").mapInArrow(_scores(model), "doc_id bigint, score double")
