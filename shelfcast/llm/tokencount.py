"""Token counts of whole texts; huge ones by overlapping chunks that are spliced where they must agree.

The vocabulary's pattern must part the text, whatever stands around, before a lone
blank between two characters that are not white space. Texts are cut there, and the
library encodes each distinct piece once while its count is remembered.

A text longer than a chunk is cut into chunks that overlap, which any tasks can
encode. Two neighbours are spliced at a place inside their overlap where both
have a token boundary, before such a lone blank. What lies left of it is counted in the left chunk, what lies right
of it in the right chunk, so the counts add up to those of the whole text. Where
an overlap holds no such place, the text goes round again with overlaps and
chunks four times as wide, until one chunk holds it all.
"""

from __future__ import annotations

import os
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm.texts import checkpointed, present, slices

CHUNK = 1 << 16  # code points
OVERLAP = 1 << 9
KEPT_PIECES, KEPT_CHARS = 400_000, 4_000_000  # whose counts a task remembers, about 50 MB
_TOKENIZERS: dict[str, Tokenizer] = {}
STABLE = re.compile(r"(?<=\S) (?=\S)")
CUT = re.compile(r"(?<=\S)(?= \S)")


def tokenizer(path: str) -> Tokenizer:
    """One for each file and Python worker, on the task's own thread."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


def _counts(path: str):
    """Tokens of each text as the sum over its pieces."""

    def run(batches):
        known, chars = {}, 0
        for batch in slices(batches):
            pieces = [CUT.split(text) for text in batch.column("text").to_pylist()]
            new = list(set().union(*pieces) - known.keys())
            known.update(zip(new, map(len, tokenizer(path).encode_batch_fast(new, add_special_tokens=False))))
            counts = [sum(map(known.__getitem__, p)) for p in pieces]
            chars += sum(map(len, new))
            if len(known) > KEPT_PIECES or chars > KEPT_CHARS:
                known, chars = {}, 0
            cols = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "n_tokens"])

    return run


def _chunks(path: str):
    """Tokens of each chunk, and the stable places near its ends with the tokens before each.

    Places count from the text's start. The places at a chunk's rim, where the
    cut itself could have made the boundary, have a character on both sides.
    """

    def run(batches):
        for batch in slices(batches, 16):
            rows = batch.to_pylist()
            for row, code in zip(rows, tokenizer(path).encode_batch([r["chunk"] for r in rows], add_special_tokens=False)):
                text, at, overlap = row["chunk"], row["at"], row["overlap"]
                starts = np.array([o[0] for o in code.offsets], np.int64)
                bounds = set(starts.tolist())
                places = [m.start() for m in STABLE.finditer(text) if m.start() in bounds]
                before = np.searchsorted(starts, places, "left")
                marked = [{"at": at + p, "before": int(b)} for p, b in zip(places, before)]
                head = [m for m in marked if m["at"] < at + overlap]
                tail = [m for m in marked if m["at"] >= at + len(text) - overlap]
                yield pa.RecordBatch.from_pylist(
                    [{"key": row["key"], "number": row["number"], "tokens": len(starts), "head": head, "tail": tail}], schema=SCHEMA
                )

    return run


MARKS = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))
SCHEMA = pa.schema([("key", pa.int64()), ("number", pa.int64()), ("tokens", pa.int64()), ("head", MARKS), ("tail", MARKS)])
SQL_MARKS = "array<struct<at: bigint, before: bigint>>"


def _cut(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``key, number, at, overlap, chunk`` of texts longer than a chunk; neighbours share ``overlap`` code points."""
    step = chunk - overlap
    last = F.greatest(F.lit(0), F.ceil((F.length("text") - chunk) / F.lit(float(step))).cast("int"))
    rows = texts.select("key", "text", F.explode(F.sequence(F.lit(0), last)).alias("number"))
    at = F.col("number").cast("long") * step
    return rows.select(
        "key", F.col("number").cast("long").alias("number"), at.alias("at"), F.lit(overlap).alias("overlap"), F.substring("text", at + 1, F.lit(chunk)).alias("chunk")
    )


def _spliced(parts: DataFrame) -> DataFrame:
    """``key, n_tokens`` per text, null where two neighbours share no stable place."""
    order = Window.partitionBy("key").orderBy("number")
    left = F.lag("tail").over(order)
    shared = F.filter(F.col("head"), lambda h: F.exists(left, lambda t: t["at"] == h["at"]))
    place = F.get(shared, F.lit(0))["at"]
    rows = parts.withColumn("left", left).withColumn("place", F.when(F.col("number") > 0, place))
    skipped = F.get(F.filter("head", lambda h: h["at"] == F.col("place")), F.lit(0))["before"]
    rows = rows.withColumn("skipped", F.when(F.col("number") == 0, F.lit(0)).otherwise(skipped))
    follow = F.lead("place").over(order)
    upto = F.get(F.filter("tail", lambda t: t["at"] == follow), F.lit(0))["before"]
    is_last = F.lead("number").over(order).isNull()
    own = F.when(is_last, F.col("tokens")).otherwise(upto) - F.col("skipped")
    summed = rows.withColumn("own", own).groupBy("key").agg(F.sum("own").alias("n"), F.count("own").alias("fine"), F.count(F.lit(1)).alias("all"))
    return summed.select("key", F.when(F.col("fine") == F.col("all"), F.col("n")).alias("n_tokens"))


def token_counts(docs: DataFrame, path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` per row of ``docs(doc_id, text)``, as the library gives them for the whole text.

    Special strings inside texts are handled as the library does by default; none
    may hold white space. A null or empty text has no bytes and no tokens. Repeated
    rows each get their result; other columns are not read. The vocabulary must
    part text before a lone blank between other characters and must not normalise.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    rows = present(docs, "doc_id").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint"
    counted = rows.where(F.length("text") <= chunk).mapInArrow(_counts(path), schema)
    large = rows.where(F.length("text") > chunk).withColumn("key", F.monotonically_increasing_id())
    large = checkpointed(large, "large-texts")  # the key names a row from here on
    found, left = [], large.select("key", "text")
    while True:
        parts = _cut(left, chunk, overlap)
        spread = parts.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "number")
        kept = f"key bigint, number bigint, tokens bigint, head {SQL_MARKS}, tail {SQL_MARKS}"
        sums = checkpointed(_spliced(spread.mapInArrow(_chunks(path), kept)), "spliced")
        found.append(sums.where("n_tokens IS NOT NULL"))
        failed = sums.where("n_tokens IS NULL").select("key")
        if failed.isEmpty():
            break
        chunk, overlap = 4 * chunk, 4 * overlap
        left = large.select("key", "text").join(failed, "key", "left_semi")
    for sums in found:
        counted = counted.unionAll(large.select("doc_id", "n_bytes", "key").join(sums, "key").select("doc_id", "n_bytes", "n_tokens"))
    return counted
