"""Benchmark passages in documents, found under edits.

An item with ``k`` allowed edits is cut into ``k + 1`` pieces. An edit changes one
piece at most, so a stretch within ``k`` edits holds one of them as it is,
wherever the edits stand. Pieces are put together in groups of two or three; in
some group of ``c`` pieces there are less than ``c`` edits, hence a piece that
was found counts only if all but ``c - 1`` of its group's words stand around it.
What remains is compared by exact edit distance in words. Nothing that matches is
left out.

Words are runs of letters and digits (any byte from 128 on counts as a letter)
with A-Z lowered. An item matches where the edit distance between its words and
some stretch of the document is at most ``max_edits`` times its words, rounded
down.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.suffixes import rolling
from shelfcast.llm.texts import U64, present, row_groups, row_key, slices, split_words, string_buffer

TABLE_BITS = 18
AT_ONCE = 1 << 14  # places whose surroundings are compared in one go


@dataclass(frozen=True)
class Sampling:
    """Which words of an item are looked up: at most ``key`` of a piece, then at most ``around`` of its group.

    Both only bound the work; items are found whatever they are.
    """

    key: int = 8
    around: int = 24


@dataclass
class Items:
    """Items with their words and, per key length, the pieces that have a key."""

    ids: list
    words: list
    sampling: Sampling
    max_edits: float
    keys: dict = field(init=False)
    item: np.ndarray = field(init=False)
    offset: np.ndarray = field(init=False)
    group: np.ndarray = field(init=False)

    def __post_init__(self):
        if not 0 <= self.max_edits < 1:
            raise ValueError("max_edits must be at least 0 and less than 1")
        pieces, groups, by_length = [], [], {}
        for i, words in enumerate(self.words):
            n = len(words)
            if not n:
                continue
            count = self.edits(i) + 1
            cuts = [n * c // count for c in range(count + 1)]
            firsts = list(range(0, max(count - 1, 1), 2))  # the last group has three if the number is odd
            for first, last in zip(firsts, [*firsts[1:], count]):
                for c in range(first, last):
                    size = min(cuts[c + 1] - cuts[c], self.sampling.key)
                    by_length.setdefault(size, []).append((len(pieces), words[cuts[c] : cuts[c] + size]))
                    pieces.append((i, cuts[c], len(groups)))
                groups.append((cuts[first], words[cuts[first] : cuts[last]][: self.sampling.around], last - first - 1))
        self.item, self.offset, self.group = (np.array([p[k] for p in pieces], np.int64) for k in range(3))
        self.group_at = np.array([g[0] for g in groups], np.int64)
        self.group_size = np.array([len(g[1]) for g in groups], np.int64)
        self.group_edits = np.array([g[2] for g in groups], np.int64)
        self.group_words = np.zeros((len(groups), self.group_size.max(initial=0)), U64)
        for g, (_, words, _) in enumerate(groups):
            self.group_words[g, : len(words)] = words
        self.keys = {}
        for size, found in by_length.items():
            own = rolling(np.concatenate([w for _, w in found]), size)[::size]
            order = np.argsort(own, kind="stable")
            known, first = np.unique(own[order], return_index=True)
            maybe = np.zeros(1 << TABLE_BITS, bool)
            maybe[known >> U64(64 - TABLE_BITS)] = True
            self.keys[size] = (known, np.append(first, len(own)), np.array([p for p, _ in found], np.int64)[order], maybe)

    def hits(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Row, start word in the row and item of each place that may match; row r owns ``hashes[first[r]:first[r + 1]]``.

        The start is where the item would begin if nothing before the piece was inserted or deleted.
        """
        out = [np.zeros((0, 3), np.int64)]
        for size, (known, bounds, pieces, maybe) in self.keys.items():
            own = rolling(hashes, size)
            at = np.flatnonzero(maybe.take(own >> U64(64 - TABLE_BITS)))
            key = np.searchsorted(known, own[at])
            real = known[np.minimum(key, len(known) - 1)] == own[at]
            row = np.searchsorted(first, at, "right") - 1
            real &= at + size <= first[row + 1]
            at, key, row = at[real], key[real], row[real]
            ends = np.cumsum(bounds[key + 1] - bounds[key])
            total = int(ends[-1]) if len(ends) else 0
            for low in range(0, total, AT_ONCE):
                n = np.arange(low, min(low + AT_ONCE, total))
                hit = np.searchsorted(ends, n, "right")
                piece = pieces[bounds[key[hit] + 1] - (ends[hit] - n)]
                begin = at[hit] - self.offset[piece]
                fine = self._grouped(hashes, first[row[hit]], first[row[hit] + 1], begin, self.group[piece])
                out.append(np.stack([row[hit], begin - first[row[hit]], self.item[piece]], 1)[fine])
        return np.unique(np.concatenate(out), axis=0)

    def _grouped(self, hashes, low, high, begin, group) -> np.ndarray:
        """Whether enough words of the piece's group stand where they may."""
        size, edits, words = self.group_size[group], self.group_edits[group], self.group_words[group]
        seen = np.zeros(words.shape, bool)
        start = begin + self.group_at[group] - edits
        for step in range(int((size + 2 * edits).max(initial=0))):
            place = start + step
            inside = (place >= low) & (place < high) & (step < size + 2 * edits)
            word = hashes.take(np.where(inside, place, 0))
            seen |= (words == word[:, None]) & inside[:, None]
        return (seen & (np.arange(words.shape[1]) < size[:, None])).sum(1) >= size - edits

    def candidates(self, hashes: np.ndarray) -> set[tuple[int, int]]:
        """(start word, item) of each place of one text that may match."""
        return {(at, i) for _, at, i in self.hits(hashes, np.array([0, len(hashes)])).tolist()}

    def edits(self, item: int) -> int:
        return int(self.max_edits * len(self.words[item]))


def edit_distance_within(item: list, words: list, most: int) -> tuple[int, int, int] | None:
    """Least edits between the item and any stretch of ``words``, with the stretch; None above ``most``.

    Of equal distances the stretch that ends first is given, and of those the shortest.
    """
    n = len(item)
    above = [(i, 0) for i in range(n + 1)]  # edits for item[:i], start of the stretch
    best = (n, 0, 0) if n <= most else None
    for end, word in enumerate(words, 1):
        row = [(0, end)]
        for i in range(1, n + 1):
            cost, start = above[i - 1]
            step = (cost + (item[i - 1] != word), start)
            for other in ((above[i][0] + 1, above[i][1]), (row[i - 1][0] + 1, row[i - 1][1])):
                if other[0] < step[0] or (other[0] == step[0] and other[1] > step[1]):
                    step = other
            row.append(step)
        above = row
        if row[n][0] <= most and (best is None or row[n][0] < best[0]):
            best = (row[n][0], row[n][1], end)
    return best


def matches(hashes: np.ndarray, candidates: list[tuple[int, int]], items: Items) -> dict[int, tuple[int, int, int]]:
    """Per item its best stretch ``(distance, start, end)`` among the candidates of one document.

    Candidates of an item that stand as near as its edits are compared together.
    """
    starts: dict[int, list[int]] = {}
    for at, i in sorted(candidates):
        starts.setdefault(i, []).append(at)
    best: dict[int, tuple[int, int, int]] = {}
    for i, places in starts.items():
        item, most = items.words[i], items.edits(i)
        n = len(item)
        same = next((at for at in places if at >= 0 and np.array_equal(hashes[at : at + n], item)), None)
        if same is not None:
            best[i] = (0, same, same + n)
            continue
        own = item.tolist()
        distinct = set(own)
        cuts = [0, *(k for k in range(1, len(places)) if places[k] - places[k - 1] > most), len(places)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            low = max(0, places[a] - most)
            around = hashes[low : places[b - 1] + n + most].tolist()
            if len(distinct - set(around)) > most:  # each missing word costs an edit at least
                continue
            near = edit_distance_within(own, around, most)
            if near is None:
                continue
            found = (near[0], low + near[1], low + near[2])
            if i not in best or found < best[i]:
                best[i] = found
    return best


def _search(items_value):
    def run(batches):
        items = items_value.value
        for batch in slices(batches):
            raw, bounds = string_buffer(batch.column("text"))
            rows: list[tuple] = []
            for low, high in row_groups(bounds):
                own = bounds[low : high + 1] - bounds[low]
                words = split_words(raw[bounds[low] : bounds[high]], own, fold=True, symbols="out")
                by_row: dict[int, list] = {}
                for r, at, i in items.hits(words.hash, words.first).tolist():
                    by_row.setdefault(r, []).append((at, i))
                for r, found in by_row.items():
                    hashes = words.hash[words.first[r] : words.first[r + 1]]
                    rows += [(low + r, items.ids[i], *m) for i, m in matches(hashes, found, items).items()]
            place = pa.array([r[0] for r in rows], pa.int64())
            cols = [batch.column(c).take(place) for c in ("doc_id", "row_key")]
            cols += [pa.array([r[k] for r in rows], pa.int64()) for k in range(1, 5)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "row_key", "item_id", "distance", "start_word", "end_word"])

    return run


def _item_blocks(benchmark: DataFrame, most_mb: int):
    """The benchmark in blocks of at most about ``most_mb`` of text, each small enough to send to all tasks."""
    rows = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = math.ceil(total / (most_mb << 20))
    for block in range(blocks):
        yield rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, max_edits: float = 0.2, sampling: Sampling | None = None, block_mb: int = 16
) -> DataFrame:
    """``doc_id, row_key, item_id, distance, start_word, end_word``: the best place of each benchmark item in each document.

    All items are held against all whole texts, in blocks of items. Null and
    empty texts and items without words match nothing; repeated rows and items
    each get their rows; a place is the closest one found, of equals the first.
    Only ``doc_id`` and ``text``, ``item_id`` and ``text`` are read.
    """
    sampling = sampling or Sampling()
    docs = present(docs, "doc_id").select("doc_id", row_key(), "text")
    schema = "doc_id bigint, row_key bigint, item_id bigint, distance bigint, start_word bigint, end_word bigint"
    parts = []
    for block in _item_blocks(benchmark, block_mb):
        table = block.toArrow()
        raw, bounds = string_buffer(table.column("text"))
        words = split_words(raw, bounds, fold=True, symbols="out")
        texts = [words.hash[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        items = Items(table.column("item_id").to_pylist(), texts, sampling, max_edits)
        parts.append(docs.mapInArrow(_search(docs.sparkSession.sparkContext.broadcast(items)), schema))
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, max_edits: float = 0.2) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found; all columns stay."""
    hits = contaminated(docs, benchmark, max_edits).select("row_key").distinct()
    rows = docs.select(F.struct("*").alias("whole"), F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("row_key"))
    return rows.join(hits, "row_key", "left_anti").select("whole.*")
