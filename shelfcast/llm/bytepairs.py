"""Byte-level BPE: texts to ids with offsets by the tokenizers library, and ids back to bytes and texts.

A rank file lists byte strings by rank. The library wants characters, so each
byte is written as one character by the published byte table, and each token
becomes a merge for every way to make it of two lower tokens, in rank order. A
match of the pattern that is a token as a whole is that token.

The pattern never joins what stands before white space to it. A text is
therefore cut there, each distinct piece is encoded once per worker, and ids are
put together from those of the pieces. Decoding looks up each id's bytes. A
token may hold a part of a character: its offsets then cover the whole
character, and an id list that is cut inside one leaves the loose bytes apart.
"""

from __future__ import annotations

import base64
import re
from itertools import chain
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import models

from shelfcast.llm.texts import map_keeping, present, row_groups, slices, string_buffer

SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # White_Space
UNIT = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
MARKED = re.compile("(?<=[!,.:;?。，、！？：；])(?=[^\\W_])")  # a mark that is no apostrophe, then a letter or digit
LONG = 1 << 12  # code points, from which a unit is cut behind marks too
KEPT_UNITS, KEPT_IDS = 400_000, 3_000_000  # that a Python worker remembers, about 120 MB
GROUP = 1 << 20  # bytes of text that are put together at a time


def byte_characters() -> list[str]:
    """One printable character for each byte value, as the published byte-level vocabularies write them."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings by rank: a line holds the bytes in base64 and the rank."""
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def library(ranks: dict[bytes, int]) -> models.BPE:
    """The library's model of the ranks; it takes one match of the pattern, bytes written as characters."""
    shown = byte_characters()
    written = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.__getitem__):
        halves = ((token[:i], token[i:]) for i in range(1, len(token)))
        both = [(a, b) for a, b in halves if a in ranks and b in ranks]
        merges += [(written[a], written[b]) for a, b in sorted(both, key=lambda h: (ranks[h[0]], ranks[h[1]]))]
    # Units are remembered here, so the library need not remember matches.
    return models.BPE(vocab={written[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True, cache_capacity=0)


def units(text: str) -> list[str]:
    """Pieces of a text that the pattern always parts: white space and what follows up to the next."""
    found = UNIT.findall(text)
    if len(text) <= LONG or max(map(len, found)) <= LONG:
        return found
    return [part for unit in found for part in (MARKED.split(unit) if len(unit) > LONG else (unit,))]


def _grown(values: np.ndarray, size: int) -> np.ndarray:
    return values if size <= len(values) else np.concatenate([values, np.zeros(max(size, 2 * len(values)) - len(values), values.dtype)])


class _Places(dict):
    """Numbers of units in order of their first look-up; new ones are listed."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = place = len(self)
        self.new.append(unit)
        return place


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.model, self.pattern, self.shown = library(ranks), regex.compile(pattern), dict(enumerate(byte_characters()))
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.widths = np.array([len(t) for t in tokens], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.widths)])[:-1].astype(np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.places, self.known, self.used = _Places(), 0, 0
        self.pool, self.starts, self.ends = (np.zeros(1 << 16, np.int32) for _ in range(3))
        self.begin, self.size, self.chars = (np.zeros(1 << 14, np.int64) for _ in range(3))

    def _learn(self) -> None:
        """Encode the units that were looked up for the first time, match by match."""
        new, self.places.new = self.places.new, []
        found = [self.pattern.findall(u) for u in new]
        # No text holds the byte 255, so it may part the matches while bytes are written as characters.
        written = b"\xff".join(map(str.encode, chain.from_iterable(found))).decode("latin-1").translate(self.shown)
        ids: list[int] = []
        stops = [0]
        for match in written.split(self.shown[255]):
            ids += [t.id for t in self.model.tokenize(match)]
            stops.append(len(ids))
        upto = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))])
        self._keep(new, np.array(ids, np.int32), np.diff(np.array(stops)[upto]))

    def _keep(self, new: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Append the ids of new units to the pool, with the places inside their unit."""
        stops = self.used + np.concatenate([[0], np.cumsum(sizes)])
        first = self.known
        self.known, self.used = first + len(new), int(stops[-1])
        self.pool, self.starts, self.ends = (_grown(x, self.used) for x in (self.pool, self.starts, self.ends))
        self.begin, self.size, self.chars = (_grown(x, self.known) for x in (self.begin, self.size, self.chars))
        self.begin[first : self.known], self.size[first : self.known] = stops[:-1], sizes
        raw, at = self.decode(ids)
        upto = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)]).astype(np.int32)  # characters that begin before a byte
        unit = np.repeat(upto[at[stops[:-1] - stops[0]]], sizes)
        here = slice(int(stops[0]), self.used)
        self.pool[here], self.starts[here], self.ends[here] = ids, upto[np.minimum(at[:-1] + 1, len(raw))] - 1 - unit, upto[at[1:]] - unit
        self.chars[first : self.known] = np.fromiter(map(len, new), np.int64, len(new))

    def encode(self, texts: list[str], offsets: bool = True) -> tuple[np.ndarray, ...]:
        """The ids of all texts behind each other, each text's bounds in them, and the code points each id covers.

        Those are the first and one past the last, counted from the text's start; an id that holds a part of a
        character covers all of it.
        """
        if self.known > KEPT_UNITS or self.used > KEPT_IDS:
            self.forget()
        parts = [units(t) for t in texts]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        place = np.fromiter(map(self.places.__getitem__, chain.from_iterable(parts)), np.int64, int(counts.sum()))
        if self.places.new:
            self._learn()
        sizes = self.size[place]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.begin[place] - stops[:-1], sizes) + np.arange(stops[-1])
        first = np.concatenate([[0], np.cumsum(counts)])
        if not offsets:
            return self.pool[at], stops[first]
        chars = np.concatenate([[0], np.cumsum(self.chars[place])])
        before = np.repeat((chars[:-1] - np.repeat(chars[first[:-1]], counts)).astype(np.int32), sizes)
        return self.pool[at], stops[first], self.starts[at] + before, self.ends[at] + before

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids behind each other, and each id's bounds in them. Unknown ids have none."""
        known = (ids >= 0) & (ids < len(self.widths))
        safe = np.where(known, ids, 0)
        sizes = np.where(known, self.widths[safe], 0)
        stops = np.concatenate([[0], np.cumsum(sizes)])
        return self.bytes[np.repeat(self.first[safe] - stops[:-1], sizes) + np.arange(stops[-1])], stops


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One for each vocabulary and Python worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, pa.int32()))


def _encoded(path: str, pattern: str, offsets: bool):
    names = ["doc_id", "ids", *(["starts", "ends"] if offsets else [])]

    def run(batches):
        own = codec(path, pattern)
        for batch in slices(batches):
            _, bounds = string_buffer(batch.column("text"))
            for low, high in row_groups(bounds, GROUP):
                rows = batch.slice(low, high - low)
                ids, cuts, *places = own.encode(rows.column("text").to_pylist(), offsets)
                cols = [rows.column("doc_id"), *(_lists(x, cuts) for x in (ids, *places))]
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def encoded(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, offsets: bool = True) -> DataFrame:
    """``doc_id, ids, starts, ends`` per row of ``docs(doc_id, text)``: the whole text's ids and the code points each covers.

    Ids are those of the rank file at ``path``, each match of the pattern by itself, without special tokens: their
    strings in a text are ordinary text. A null or empty text has empty lists. Repeated rows and rows with a null id
    each get their result. Other columns are not read. ``offsets=False`` leaves out the places. The pattern must part
    a text before white space and between a mark and a letter, as the published one does. A stretch of one text
    without either is encoded at once, however long.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    schema = "doc_id bigint, ids array<int>" + (", starts array<int>, ends array<int>" if offsets else "")
    return present(docs, "doc_id").mapInArrow(_encoded(path, pattern, offsets), schema)


def whole_characters(data: bytes) -> tuple[bytes, str, bytes]:
    """Loose bytes of a character begun before, the text between, and loose bytes of one that goes on behind.

    Bytes inside that are no UTF-8 become U+FFFD.
    """
    head = 0
    while head < min(3, len(data)) and data[head] & 0xC0 == 0x80:
        head += 1
    tail = len(data)
    for back in range(1, min(3, tail - head) + 1):
        lead = data[tail - back]
        if lead & 0xC0 != 0x80:
            need = 2 if lead >> 5 == 6 else 3 if lead >> 4 == 14 else 4 if lead >> 3 == 30 else 1
            tail -= back if need > back else 0
            break
    return data[:head], data[head:tail].decode("utf-8", "replace"), data[tail:]


def _decoded(path: str, pattern: str, keep: list[str], texts: bool):
    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            column = batch.column("ids")
            bounds = np.concatenate([[0], np.cumsum(np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)))])
            for low, high in row_groups(bounds.astype(np.int64), GROUP):
                rows = batch.slice(low, high - low)
                lists = rows.column("ids")
                flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                raw, stops = own.decode(flat)
                cuts = stops[(bounds[low : high + 1] - bounds[low]).astype(np.int64)].astype(np.int32)
                data = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(cuts), pa.py_buffer(raw)])
                cols = [*(rows.column(c) for c in keep), data]
                if texts:
                    split = [whole_characters(d) for d in data.to_pylist()]
                    cols += [pa.array(x, t) for x, t in zip(zip(*split), (pa.binary(), pa.string(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(cols, [*keep, "data", *(["head", "text", "tail"] if texts else [])])

    return run


def decoded(
    tokens: DataFrame, keep: list[str], path: str | None = None, pattern: str = public_tokenizers.PATTERN, texts: bool = True
) -> DataFrame:
    """The columns ``keep``, then ``data, head, text, tail``, per row of ``tokens(ids)``.

    ``data`` is the exact bytes. Where a list is cut inside a character, its loose bytes stand in ``head`` and
    ``tail``, so that the rows of one text put behind each other give it back; ``text`` is what stands between. A null
    or empty list gives nothing, as do ids that the vocabulary does not have and null ids. ``keep`` may not name
    these columns. ``texts=False`` gives ``data`` alone.
    """
    made = ["data", "head", "text", "tail"] if texts else ["data"]
    if {c.lower() for c in keep} & set(made):
        raise ValueError(f"{made} are made here and cannot be kept")
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    schema = "data binary" + (", head binary, text string, tail binary" if texts else "")
    ids = F.col("ids").cast("array<int>").alias("ids")
    return map_keeping(tokens, keep, [ids], lambda names: _decoded(path, pattern, names, texts), schema)


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, n_chars``: digests of the ids and of the bytes they give back.

    ``n_chars``: code points that the ids cover, from the last one's offsets.
    """
    ids = encoded(docs)
    chars = F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long")
    counted = ids.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), chars.alias("n_chars"), "ids"
    )
    rows = decoded(counted, ["doc_id", "n_tokens", "ids_sha256", "n_chars"], texts=False)
    return rows.select("doc_id", "n_tokens", "ids_sha256", F.sha2("data", 256).alias("decoded_sha256"), "n_chars")
