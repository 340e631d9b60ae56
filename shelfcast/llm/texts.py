"""Word hashes of whole Arrow batches in numpy, and the plumbing the operators share.

A batch of texts is one byte buffer with offsets, so words, shingles and rolling
hashes come out of array operations, without a Python object per word. The work
is done in pieces of about a megabyte that end at a word's end: memory follows
the piece and the number of words, not the bytes of a very long text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import materialise

U64 = np.uint64
BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
BYTES_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
BASE = 0x9E3779B97F4A7C15 | 1
PIECE = 1 << 20
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers one to one."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i up to ``n``."""
    if "up" not in _POWERS or len(_POWERS["up"]) <= n:
        size = max(n + 1, PIECE + 65536)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and each row's bounds in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        width = np.int32
    else:
        column, width = column.cast(pa.large_string()), np.int64
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


@dataclass
class Words:
    """Words of many rows: a hash and byte bounds each; row r owns ``first[r]:first[r + 1]``."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _classes(raw: np.ndarray, symbols: bool) -> np.ndarray:
    """0 for ASCII white space, 1 for a word's bytes, 2 for ASCII punctuation if asked for."""
    kind = np.ones(len(raw), np.uint8)
    if symbols:
        letter = ((raw | 32) - 97 < 26) | (raw - 48 < 10) | (raw >= 128)
        kind[~letter] = 2
    kind[(raw == 32) | (raw - 9 < 5)] = 0
    return kind


def split_words(raw: np.ndarray, bounds: np.ndarray, fold: bool = False, symbols: str = "inside") -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each row; ``fold`` lowers A-Z.

    ``symbols``: ASCII punctuation stays "inside" words, stands "apart" as words
    of its own, or is left "out".
    """
    hashes, starts, ends = [], [], []
    at, total = 0, len(raw)
    while at < total:
        stop = min(at + PIECE, total)
        while stop < total:  # move on to the next white space
            tail = raw[stop : stop + 4096]
            gaps = np.flatnonzero((tail == 32) | (tail - 9 < 5))
            if len(gaps):
                stop += int(gaps[0])
                break
            stop = min(stop + 4096, total)
        piece = raw[at:stop]
        if fold:
            piece = np.where(piece - 65 < 26, piece + 32, piece).astype(np.uint8)
        kind = _classes(piece, symbols != "inside")
        edge = np.ones(len(piece) + 1, bool)
        edge[1:-1] = kind[1:] != kind[:-1]
        cuts = bounds[np.searchsorted(bounds, at, "right") : np.searchsorted(bounds, stop, "left")] - at
        edge[cuts] = True
        cut = np.flatnonzero(edge)
        begin, finish = cut[:-1], cut[1:]
        real = (kind[begin] > 0) if symbols != "out" else (kind[begin] == 1)
        begin, finish = begin[real], finish[real]
        up, down = powers(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, U64)
        np.cumsum((piece.astype(U64) + U64(1)) * up[: len(piece)], out=sums[1:])
        hashes.append(mix((sums[finish] - sums[begin]) * down[begin]))
        starts.append(begin + at)
        ends.append(finish + at)
        at = stop
    none = np.zeros(0, np.int64)
    start = np.concatenate(starts) if starts else none
    return Words(
        np.concatenate(hashes) if hashes else none.astype(U64),
        start,
        np.concatenate(ends) if ends else none,
        np.searchsorted(start, bounds, "left"),
    )


def chain(hashes: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """A hash of each run of ``n`` neighbours; the last ``n - 1`` runs are left out."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    out = mix(hashes[: len(hashes) - n + 1] + U64((n * 0x632BE59BD9B4E019 + salt) % (1 << 64)))
    for j in range(1, n):
        out = mix(out * U64(0xD6E8FEB86659FD93) + hashes[j : len(hashes) - n + 1 + j])
    return out


def row_groups(bounds: np.ndarray, most: int = 4 * PIECE):
    """Row ranges of about ``most`` bytes, at least one row each."""
    row, rows = 0, len(bounds) - 1
    while row < rows:
        stop = int(np.searchsorted(bounds, bounds[row] + most, "right")) - 1
        stop = min(max(stop, row + 1), rows)
        yield row, stop
        row = stop


def slices(batches, rows: int = 1000):
    """The batches in parts of a few rows, so that what a task holds beside them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def bounded_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches to a thousand rows and eight megabytes.

    Texts are long: ten thousand whole ones beside what is made of them may fill a task's memory.
    """
    if not 0 < int(spark.conf.get(BATCH_CONF)) <= BATCH_ROWS:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    spark.conf.set(BYTES_CONF, str(BATCH_BYTES))


def present(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns, the text's null as empty, in bounded Arrow batches."""
    bounded_batches(docs.sparkSession)
    return docs.select(*columns, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def map_keeping(df: DataFrame, keep: list[str], inputs: list[Column], run, made: str) -> DataFrame:
    """The columns ``keep``, whatever their names, and those of the schema ``made``, out of ``run(names)`` over Arrow batches.

    The function gets the kept columns by their names in the batches, and ``inputs`` beside them.
    """
    names = [f"kept_{i}" for i in range(len(keep))]
    own = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], *inputs)
    kinds = [f"{n} {own.schema[n].dataType.simpleString()}" for n in names]
    out = own.mapInArrow(run(names), ", ".join([*kinds, made]))
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], *out.columns[len(names) :])


def row_key() -> Column:
    """A key of a row's id and text; identical rows share it."""
    return F.xxhash64("doc_id", "text").alias("row_key")


def checkpointed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder, so that it outlives lost executors."""
    return materialise(df, name)
