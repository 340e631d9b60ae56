"""Packing of tokenised documents into sequences by their length histogram.

Documents are tokenised and cut into pieces of at most one sequence. Lengths are
then placed longest first, a whole bin of the histogram at a time: into the shortest open packing patterns, that is
those with the most room left, as long as they fit, else into new ones. The work depends on the
number of lengths, at most the sequence size, and not on the number of pieces.
Last, each piece looks its sequence up by its length and its rank among the
pieces of that length.
"""

from __future__ import annotations

import zlib
from bisect import insort
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm.texts import Words, checkpointed, present, row_groups, slices, split_words, string_buffer

KEPT_UNITS = 400_000  # of a generation; a Python worker remembers two, about 30 MB
LEARNT = 5_000  # units that the library encodes at a time; it takes about a kilobyte for each
GROUP = 1 << 20  # bytes of text that are encoded at a time
RANKED = 20_000  # pieces of one length that are ranked together, about


class Units:
    """Ids of units by key, in one pool; keys lie sorted in an array, which takes a fifth of a dict's memory."""

    def __init__(self):
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.begin, self.end = np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.int32)
        self.used = 0

    def add(self, keys: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        """Units whose keys are sorted and not yet here."""
        first, ends = len(self.keys), self.used + np.cumsum(sizes)
        self.pool = _grown(self.pool, self.used + len(flat))
        self.pool[self.used : self.used + len(flat)] = flat
        self.begin, self.end = (_grown(x, first + len(keys)) for x in (self.begin, self.end))
        self.begin[first : first + len(keys)], self.end[first : first + len(keys)] = ends - sizes, ends
        self.used += len(flat)
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.place = np.insert(self.place, at, np.arange(first, first + len(keys), dtype=np.int32))

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys

    def places(self, keys: np.ndarray) -> np.ndarray:
        return self.place[np.searchsorted(self.keys, keys)]

    def ids_at(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the units at these places behind each other, and how many each has."""
        begin = self.begin[place]
        sizes = self.end[place] - begin
        stops = np.cumsum(sizes)
        steps = np.arange(stops[-1] if len(stops) else 0, dtype=np.int32)
        return self.pool[np.repeat(begin - (stops - sizes).astype(np.int32), sizes) + steps], sizes


class Encoder:
    """Ids of whole batches for a vocabulary that lowers case, drops white space and never joins what it parts.

    The library encodes each distinct unit once while it is remembered: when a
    generation of units is full, the one before it goes, but for the units that were
    met again. A unit is a stretch between white space.
    If it is a run of ASCII or Latin-1 letters and digits with ASCII marks
    behind it, the run (A-Z lowered) and the marks are units of their own, since
    the vocabulary's pattern always parts them there.
    """

    def __init__(self, path: str):
        self.vocabulary = Tokenizer.from_file(path)
        self.old, self.young = Units(), Units()

    def _remember(self, keys: np.ndarray, text_of) -> None:
        """See to it that the young generation has these sorted units; ``text_of`` gives a unit by its place in ``keys``."""
        if len(self.young.keys) + len(keys) > KEPT_UNITS:
            self.old, self.young = self.young, Units()
        lacking = np.flatnonzero(~self.young.has(keys))
        met = self.old.has(keys[lacking])
        again = keys[lacking[met]]
        self.young.add(again, *self.old.ids_at(self.old.places(again)))
        new = lacking[~met]
        for at in range(0, len(new), LEARNT):
            some = new[at : at + LEARNT]
            codes = self.vocabulary.encode_batch_fast([text_of(i) for i in some.tolist()], add_special_tokens=False)
            ids = [c.ids for c in codes]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self.young.add(keys[some], np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes)

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        raw, bounds = string_buffer(column)
        out: list[np.ndarray] = []
        for low, high in row_groups(bounds, GROUP):
            out += self._group(raw[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
        return out

    def _group(self, raw: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        words = split_words(raw, bounds, fold=True, symbols="apart")
        keys, lone = words.hash, _odd_runs(raw, words)
        data = raw.tobytes()
        keep = np.ones(len(keys), bool)
        odd: dict[int, str] = {}
        for a, b in lone:  # a stretch of several parts that may belong together is a unit as it stands
            unit = data[words.start[a] : words.end[b - 1]].decode()
            keys[a] = key = xxhash.xxh64_intdigest(unit, seed=1)
            keep[a + 1 : b] = False
            odd[key] = unit
        first = np.concatenate([[0], np.cumsum(keep)])[words.first]
        keys, starts, ends = keys[keep], words.start[keep], words.end[keep]
        distinct, at, which = np.unique(keys, return_index=True, return_inverse=True)
        self._remember(distinct, lambda i: odd.get(int(distinct[i])) or data[starts[at[i]] : ends[at[i]]].decode())
        ids, sizes = self.young.ids_at(self.young.places(distinct)[which])
        cuts = np.concatenate([[0], np.cumsum(sizes)])[first]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _grown(values: np.ndarray, size: int) -> np.ndarray:
    return values if size <= len(values) else np.concatenate([values, np.zeros(max(size, 2 * len(values)) - len(values), values.dtype)])


def _odd_runs(raw: np.ndarray, words: Words) -> list[tuple[int, int]]:
    """Runs ``a:b`` that stand together without being a plain word with marks behind it."""
    n = len(words.start)
    if not n:
        return []
    behind_c3 = np.concatenate([[False], raw[:-1] == 0xC3])
    strange = (raw >= 128) & ~((raw == 0xC3) | (behind_c3 & (raw != 0x97) & (raw != 0xB7)))
    count = np.concatenate([[0], np.cumsum(strange)])
    opens = np.ones(n, bool)
    row = words.row
    opens[1:] = (words.start[1:] != words.end[:-1]) | (row[1:] != row[:-1])
    a = np.flatnonzero(opens)
    b = np.append(a[1:], n)
    head = raw[words.start[a]]
    word_first = ((head | 32) - 97 < 26) | (head - 48 < 10) | (head >= 128)
    plain = word_first & (count[words.end[a]] == count[words.start[a]]) & (b - a == 2)
    odd = (b - a > 1) & ~plain
    return list(zip(a[odd].tolist(), b[odd].tolist()))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _pieces(path: str, size: int, end_id: int):
    def run(batches):
        for batch in slices(batches):
            rows = []
            for i, ids in enumerate(encoder(path).encode(batch.column("text"))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), size):
                    own = ids[start : start + size]
                    rows.append((i, start, len(own), zlib.crc32(own), len(ids)))
            place = pa.array([r[0] for r in rows], pa.int64())
            cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(1, 5)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(place), *cols], NAMES)

    return run


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


@dataclass(frozen=True)
class Slot:
    """``copies`` places per sequence for one length, in the ``sequences`` sequences of a pattern."""

    length: int
    pattern: int
    sequences: int
    copies: int
    offset: int


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[Slot]:
    """Patterns for a histogram of lengths, longest first.

    Open patterns are kept by the room left. A bin's pieces go one by one to the
    sequences of the shortest pattern; once none fits, the rest of the bin opens
    new sequences that hold as many copies as fit. A pattern that gets pieces in a part of
    its sequences only is split in two.
    """
    patterns: list[tuple[int, list[tuple[int, int]]]] = []  # sequences, [(length, copies)]
    open_: list[tuple[int, int]] = []  # room left, pattern
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if open_ and open_[-1][0] >= length:
                room, p = open_.pop()
                sequences, held = patterns[p]
                copies = 1
            else:
                room, held, p = size, [], len(patterns)
                copies = min(size // length, left)
                sequences = left // copies
                patterns.append((sequences, held))
            used = min(sequences, left // copies)
            if used < sequences:
                insort(open_, (room, len(patterns)))
                patterns.append((sequences - used, list(held)))
            patterns[p] = used, [*held, (length, copies)]
            left -= used * copies
            if room - copies * length:
                insort(open_, (room - copies * length, p))
    slots = []
    for p, (sequences, held) in enumerate(patterns):
        offset = 0
        for length, copies in held:
            slots.append(Slot(length, p, sequences, copies, offset))
            offset += length * copies
    return slots


def _slot_table(spark: SparkSession, slots: list[Slot]) -> DataFrame:
    """The slots with the ranks they take and their pattern's first sequence."""
    first, at, rows, taken = {}, 0, [], {}
    for s in slots:
        if s.pattern not in first:
            first[s.pattern], at = at, at + s.sequences
        low = taken.get(s.length, 0)
        taken[s.length] = low + s.sequences * s.copies
        rows.append((s.length, low, taken[s.length], first[s.pattern], s.copies, s.offset))
    return spark.createDataFrame(rows, "length long, low long, high long, first_sequence long, copies long, slot_offset long")


def ranked(pieces: DataFrame, parts: int) -> DataFrame:
    """``rank``: a number from 0 within each length. A length is ranked in ``parts`` parts, so that a common one is no single group."""
    spread = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(parts)))
    counts = spread.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")) - 1
    counts = counts.select("length", "part", before.alias("before"))
    rows = spread.withColumn("inside", inside).join(counts, ["length", "part"])
    return rows.withColumn("rank", F.col("before") + F.col("inside")).drop("before", "inside", "part")


def packed_pieces(
    docs: DataFrame, size: int = 4096, path: str | None = None, end_id: int = 2, parts: int | None = None
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: where each piece of each document stands.

    A null or empty text is one piece that holds ``end_id`` alone. Repeated rows
    and rows with a null id are packed like all others. Only ``doc_id`` and
    ``text`` are read. The driver gets the histogram, at most ``size`` rows; the
    number of ``parts`` in which a length is ranked follows from its commonest one.
    """
    spark = docs.sparkSession
    path = path or public_tokenizers.path("word_bpe_49k.json")
    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    pieces = checkpointed(present(docs, "doc_id").mapInArrow(_pieces(path, size, end_id), schema), "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = parts or max(1, -(-max(histogram.values(), default=0) // RANKED))
    slots = _slot_table(spark, shortest_pack_first(histogram, size))
    where = (F.col("p.length") == F.col("s.length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    # A pattern holds distinct lengths and splits once per bin at most: a few rows per length.
    placed = ranked(pieces, parts).alias("p").join(F.broadcast(slots).alias("s"), where)
    place = F.col("rank") - F.col("low")
    return placed.select(
        *[F.col(f"p.{c}").alias(c) for c in NAMES],
        (F.col("first_sequence") + F.floor(place / F.col("copies")).cast("long")).alias("sequence_id"),
        (F.col("slot_offset") + place % F.col("copies") * F.col("p.length")).alias("offset"),
    )
