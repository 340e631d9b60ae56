"""Passages that repeat across documents, found by the hashes of all their stretches of ``min_words`` words.

Each stretch belongs to the first of its grams (runs of half as many words) whose
hash is the least, a choice that depends on the stretch alone, so equal stretches
belong to equal grams in all documents. Stretches whose gram occurs in one
document only are dropped. Neighbouring stretches of one gram make a block; where
a gram has the same block everywhere, the block is compared as a whole, elsewhere
each stretch by itself, with all others: a Spark group-by, without a limit on
candidates.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.masks import in_mask, mask_of
from shelfcast.llm.texts import (
    BASE,
    U64,
    checkpointed,
    mix,
    powers,
    present,
    row_groups,
    row_key,
    signed,
    slices,
    split_words,
    string_buffer,
)

GRAM_BITS = 24


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` words."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    up, down = powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, U64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[: len(hashes) - n + 1])


def _first_least(grams: np.ndarray, n: int) -> np.ndarray:
    """The place of the least gram, of equals the first, in each run of ``n``."""

    def pick(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(grams[b] < grams[a], b, a)

    width, out = 1, np.arange(len(grams))
    while 2 * width <= n:
        out = pick(out[:-width], out[width:])
        width *= 2
    rest = n - width
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def blocks(hashes: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The stretches of ``min_words`` words in blocks of one least gram.

    Gives the hash of each stretch, and of each block its gram, its first stretch
    and a key made of the hashes of its stretches.
    """
    gram = min_words // 2
    window = min_words - gram + 1
    if len(hashes) < min_words:
        none = np.zeros(0, U64)
        return none, none, np.zeros(0, np.int64), none
    grams = rolling(hashes, gram)
    owner = _first_least(grams, window)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    keys = rolling(hashes, min_words)
    place = np.arange(len(keys)) - np.repeat(first, np.diff(np.append(first, len(keys))))
    return keys, grams[owner[first]], first, mix(np.add.reduceat(mix(keys + place.astype(U64) * U64(BASE)), first))


def _per_document(batch: pa.RecordBatch):
    """Row and word hashes of each text."""
    raw, bounds = string_buffer(batch.column("text"))
    for low, high in row_groups(bounds):
        own = bounds[low : high + 1] - bounds[low]
        words = split_words(raw[bounds[low] : bounds[high]], own)
        for r in range(high - low):
            yield low + r, words.hash[words.first[r] : words.first[r + 1]]


def _grams(min_words: int):
    """The grams of each document with their blocks."""

    def run(batches):
        for batch in slices(batches):
            rows = batch.column("row_key").to_numpy(zero_copy_only=False)
            for r, hashes in _per_document(batch):
                _, grams, _, block = blocks(hashes, min_words)
                if len(grams):
                    cols = [pa.array(signed(grams)), pa.array(np.full(len(grams), rows[r])), pa.array(signed(block))]
                    yield pa.RecordBatch.from_arrays(cols, ["gram", "row_key", "block"])

    return run


def _candidates(min_words: int, shared_value, mixed_value, kept_value=None):
    """Blocks, and single stretches of the grams with several blocks, that may occur in two documents.

    A candidate has a key, its first word and its number of stretches.
    """

    def run(batches):
        shared, mixed = shared_value.value, mixed_value.value
        kept = kept_value.value if kept_value else None
        for batch in slices(batches):
            rows = batch.column("row_key").to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for r, hashes in _per_document(batch):
                keys, grams, first, block = blocks(hashes, min_words)
                count = np.diff(np.append(first, len(keys)))
                several = in_mask(grams, mixed)
                whole = in_mask(grams, shared) & ~several
                single = np.flatnonzero(np.repeat(several, count))
                key = np.concatenate([block[whole], keys[single]])
                at = np.concatenate([first[whole], single])
                many = np.concatenate([count[whole], np.ones(len(single), np.int64)])
                if kept is not None:
                    some = in_mask(key, kept)
                    key, at, many = key[some], at[some], many[some]
                for low in range(0, len(key), 20000):
                    part = slice(low, low + 20000)
                    n = len(key[part])
                    cols = [pa.array(signed(key[part])), pa.array(np.full(n, rows[r])), pa.array(np.full(n, ids[r]))]
                    cols += [pa.array(at[part].astype(np.int32)), pa.array(many[part].astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(cols, ["key", "row_key", "doc_id", "at", "stretches"])

    return run


LAST = (1 << 63) - 1  # stands for a null id: after all others


def repeated_spans(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """``row_key, doc_id, start_word, end_word, later`` of passages that two documents share.

    A passage has ``min_words`` words ``[^\\x20\\x09-\\x0D]+`` or more, equal in
    case and punctuation. Its words are ``start_word`` up to but without
    ``end_word``. ``later`` spans also occur in a document with a smaller id, and
    may be removed; the others hold the first occurrence (both kinds may overlap
    in a document, each is merged by itself). The first occurrence is the least id
    of all documents that hold the same ``min_words`` words, so one copy stays
    however many there are. Stretches are known by 64-bit hashes. A document is a pair of id and
    text: identical rows are one document, repeats inside a document do not
    count, a null id comes after all others and documents of one id keep their
    passages. Null and empty texts have no spans. Only ``doc_id`` and ``text``
    are read.
    """
    send = docs.sparkSession.sparkContext.broadcast
    docs = present(docs, "doc_id").select("doc_id", row_key(), "text").select(F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"), "row_key", "text")
    grams = docs.select("row_key", "text").mapInArrow(_grams(min_words), "gram bigint, row_key bigint, block bigint")
    ends = [f(c).alias(f"{n}_{c}") for c in ("row_key", "block") for n, f in (("low", F.min), ("high", F.max))]
    common = grams.groupBy("gram").agg(*ends).where("low_row_key <> high_row_key")
    common = checkpointed(common.select("gram", F.expr("low_block <> high_block").alias("several")), "grams")
    shared = send(mask_of(common, "gram", GRAM_BITS))
    mixed = send(mask_of(common.where("several"), "gram", GRAM_BITS))
    schema = "key bigint, row_key bigint, doc_id bigint, at int, stretches int"
    found = docs.mapInArrow(_candidates(min_words, shared, mixed), schema)
    holders = found.groupBy("key").agg(F.min("row_key").alias("low"), F.max("row_key").alias("high"), F.min("doc_id").alias("first"))
    repeats = checkpointed(holders.where("low <> high").select("key", "first"), "repeats")
    places = docs.mapInArrow(_candidates(min_words, shared, mixed, send(mask_of(repeats, "key", GRAM_BITS))), schema)
    spans = places.join(repeats, "key").select(
        "row_key",
        "doc_id",
        F.col("at").alias("start_word"),
        (F.col("at") + F.col("stretches") + F.lit(min_words - 1)).alias("end_word"),
        (F.col("first") < F.col("doc_id")).alias("later"),
    )
    return merged_spans(spans).withColumn("doc_id", F.expr(f"nullif(doc_id, {LAST})"))


def merged_spans(spans: DataFrame) -> DataFrame:
    """Overlapping and touching spans of a document joined, both kinds by themselves."""
    by = Window.partitionBy("row_key", "later").orderBy("start_word", "end_word")
    before = F.max("end_word").over(by.rowsBetween(Window.unboundedPreceding, -1))
    opens = spans.withColumn("opens", (F.coalesce(before, F.lit(-1)) < F.col("start_word")).cast("int"))
    island = opens.withColumn("island", F.sum("opens").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    merged = island.groupBy("row_key", "later", "island").agg(
        F.min("doc_id").alias("doc_id"), F.min("start_word").alias("start_word"), F.max("end_word").alias("end_word")
    )
    return merged.select("row_key", "doc_id", "start_word", "end_word", "later")


def _cut(text: str, spans) -> str:
    """The text without the words of the spans and the white space after them."""
    raw = text.encode()
    words = split_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    begins = np.append(words.start, len(raw))
    out, at = [], 0
    for start, end in sorted((s["start_word"], s["end_word"]) for s in spans):
        out.append(raw[at : begins[start]])
        at = begins[end]
    return b"".join([*out, raw[at:]]).decode()


@F.pandas_udf(T.StringType())
def without_spans(text: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([t if s is None or not len(s) else _cut(t, s) for t, s in zip(text, spans)], dtype=object)


def _rewritten(name: str) -> Column:
    new = F.col("new_text")
    return {"text": new, "n_chars": F.length(new).cast("long")}[name].alias(name)


def drop_repeats(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """``docs`` without the later occurrences of repeated passages; all columns stay.

    ``n_chars``, where there is one, is counted anew for a text that was cut. A
    document is dropped if cutting leaves no word. All other rows, those with a
    null or empty text too, stay as they are.
    """
    spans = repeated_spans(docs, min_words).where("later")
    cuts = spans.groupBy("row_key").agg(F.collect_list(F.struct("start_word", "end_word")).alias("cuts"))
    rows = docs.select(F.struct("*").alias("whole"), F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("row_key"))
    # Not deterministic to Spark, which would else cut each text again for the filter, by another Python worker.
    once = without_spans.asNondeterministic()
    done = rows.join(cuts, "row_key", "left").withColumn("new_text", once(F.col("whole.text"), F.col("cuts")))
    done = done.where("cuts IS NULL OR new_text RLIKE '[^ \\\\t-\\\\r]'")
    columns = [
        F.when(F.col("cuts").isNull(), F.col(f"whole.`{c}`")).otherwise(_rewritten(c)).alias(c) if c in ("text", "n_chars") else F.col(f"whole.`{c}`")
        for c in docs.columns
    ]
    return done.select(*columns)
