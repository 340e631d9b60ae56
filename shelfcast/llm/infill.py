"""Fill-in-the-middle: a text's bytes rearranged in place, and put back exactly.

Spark draws the cuts and the form from a digest of the row's id. A task scans a
text's bytes for the cuts, which count code points, and puts the sentinels into
one bytearray: prefix mark, prefix, middle mark, middle, suffix mark, suffix. The
wanted order is a rotation of two neighbouring blocks, each block reversed and
then both together. Restoring turns the same rotation back and takes the marks
out; it needs the output and its form only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.texts import bounded_batches, map_keeping, row_groups, string_buffer

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
GROUP = 1 << 20  # bytes of text in a returned batch, one row at least
SWAP = 1 << 16  # bytes that a reversal holds beside the array


def reverse(data: bytearray, begin: int, end: int) -> None:
    """Turn ``data[begin:end]`` round in place, from both ends to the middle."""
    while end - begin > 1:
        step = min(SWAP, (end - begin) // 2)
        left = data[begin : begin + step]
        left.reverse()
        right = data[end - step : end]
        right.reverse()
        data[begin : begin + step], data[end - step : end] = right, left
        begin, end = begin + step, end - step


def rotate(data: bytearray, begin: int, cut: int, end: int) -> None:
    """Exchange the neighbouring blocks ``begin:cut`` and ``cut:end`` in place."""
    reverse(data, begin, cut)
    reverse(data, cut, end)
    reverse(data, begin, end)


def byte_place(data: bytes, chars: int) -> int:
    """The byte at which code point number ``chars`` begins, or the end."""
    at = 0
    for low in range(0, len(data), SWAP):
        leads = np.flatnonzero((np.frombuffer(data, np.uint8, min(SWAP, len(data) - low), low) & 0xC0) != 0x80)
        if chars - at < len(leads):
            return low + int(leads[chars - at])
        at += len(leads)
    return len(data)


def transform(text: bytes, form: str, prefix: int, middle: int) -> bytearray:
    """The output of one text; ``prefix`` and ``middle`` count code points."""
    data = bytearray(text)
    if form == PLAIN:
        return data
    second = byte_place(text, prefix + middle)
    first = byte_place(text, prefix)
    data[second:second] = SUFFIX
    data[first:first] = MIDDLE
    data[0:0] = PREFIX
    first, second = first + 3, second + 6  # where the middle's and the suffix's marks stand now
    rotate(data, first if form == PSM else 0, second, len(data))
    return data


def restore(output: bytes, form: str) -> bytearray:
    """The text that ``output`` was made of. Marks stand once each, as a text that holds one stays plain."""
    data = bytearray(output)
    if form == PLAIN:
        return data
    begin = data.index(SUFFIX) if form == PSM else 0
    cut = data.index(MIDDLE if form == PSM else PREFIX, begin)
    size = len(data) - cut
    rotate(data, begin, cut, len(data))
    suffix = begin + size
    middle = begin if form == PSM else data.index(MIDDLE)
    for mark in (suffix, middle, 0):
        del data[mark : mark + 3]
    return data


def _applied(make, name: str, keep: list[str]):
    """The columns ``keep`` and what ``make`` gives for each row, in batches of bounded bytes."""

    def run(batches):
        for batch in batches:
            _, bounds = string_buffer(batch.column("data"))
            for low, high in row_groups(bounds, GROUP):
                rows = batch.slice(low, high - low)
                made = pa.array([bytes(x) for x in make(rows)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), made], [*keep, name])

    return run


def _outputs(rows: pa.RecordBatch):
    cols = [rows.column(c).to_pylist() for c in ("data", "form", "prefix_chars", "middle_chars")]
    return (transform(*row) for row in zip(*cols))


def _texts(rows: pa.RecordBatch):
    return (restore(*row) for row in zip(rows.column("data").to_pylist(), rows.column("form").to_pylist()))


def drawn(hashed: Column, group: int) -> Column:
    """Group ``group`` of eight hexadecimal digits of a digest, from 0, as a number."""
    return F.conv(F.substring(hashed, 8 * group + 1, 8), 16, 10).cast("long")


def cuts(docs: DataFrame, seed: int = 1, keep_plain: int = 10, suffix_first: int = 20) -> DataFrame:
    """``doc_id, text, n, form, prefix_chars, middle_chars`` per row of ``docs(doc_id, text)``.

    Two cuts between the ``n`` code points, the form, and whether the suffix comes first are drawn from the digest of
    seed and id: ``keep_plain`` of a hundred texts stay as they are, ``suffix_first`` of a hundred others begin with
    the suffix. A text that is empty or holds a mark, or whose row has no id, stays plain.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    rows = rows.select("doc_id", "text", F.length("text").cast("long").alias("n"), hashed.alias("h"))
    a, b = (drawn(F.col("h"), g) % (F.col("n") + 1) for g in (0, 1))
    marks = [F.col("text").contains(mark.decode()) for mark in (PREFIX, SUFFIX, MIDDLE)]
    plain = (F.col("n") == 0) | marks[0] | marks[1] | marks[2] | (drawn(F.col("h"), 2) % 100 >= 100 - keep_plain) | F.col("h").isNull()
    form = F.when(plain, PLAIN).when(drawn(F.col("h"), 3) % 100 < suffix_first, SPM).otherwise(PSM)
    rows = rows.select("doc_id", "text", "n", form.alias("form"), F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    moved = F.col("form") != PLAIN
    return rows.select(
        "doc_id", "text", "n", "form", F.when(moved, F.col("a")).alias("prefix_chars"), F.when(moved, F.col("b") - F.col("a")).alias("middle_chars")
    )


KEPT = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint"


def transformed(docs: DataFrame, **how) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` per row of ``docs(doc_id, text)``; ``how`` as in ``cuts``.

    Forms: ``plain``, the text; ``psm``, prefix, suffix, middle; ``spm``, suffix, prefix, middle, each behind its
    mark. A null text counts as empty. Repeated rows, and rows that share an id, each get their result; those of one
    id and text get the same. Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    rows = cuts(docs, **how).withColumn("data", F.col("text").cast("binary")).drop("text")
    made = rows.select(*KEPT, "data").mapInArrow(_applied(_outputs, "data", KEPT), f"{SCHEMA}, data binary")
    return made.select(*KEPT, F.col("data").cast("string").alias("output"))


def restored(outputs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep``, then ``text``: the exact text per row of ``outputs(output, form)``.

    A null output counts as empty; a null form as plain. ``keep`` may not name ``text``.
    """
    if "text" in {c.lower() for c in keep}:
        raise ValueError("text is made here and cannot be kept")
    bounded_batches(outputs.sparkSession)
    data = F.coalesce(F.col("output"), F.lit("")).cast("binary").alias("data")
    form = F.coalesce(F.col("form"), F.lit(PLAIN)).alias("form")
    texts = map_keeping(outputs, keep, [form, data], lambda names: _applied(_texts, "text", names), "text binary")
    return texts.withColumn("text", F.col("text").cast("string"))


def digests(docs: DataFrame) -> DataFrame:
    """Per document its cuts and form, and digests of the output and of the text restored from it."""
    digest = F.sha2("output", 256).alias("output_sha256")
    back = restored(transformed(docs).select(*KEPT, digest, "output"), [*KEPT, "output_sha256"])
    return back.select(*KEPT, "output_sha256", F.sha2("text", 256).alias("restored_sha256"))


ORACLE = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h
    FROM documents
), numbers AS (
    SELECT doc_id, text, n, h,
        CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a,
        CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
        CASE WHEN h IS NULL OR n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
            WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT doc_id, text, n, form, least(a, b) AS p, greatest(a, b) - least(a, b) AS m,
        substr(text, 1, least(a, b)) AS prefix,
        substr(text, least(a, b) + 1, greatest(a, b) - least(a, b)) AS middle,
        substr(text, greatest(a, b) + 1) AS suffix
    FROM numbers
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(p AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(m AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""
