"""Shards of bounded size by extendible hashing, in DataFrame expressions only.

A directory is indexed by the leading bits of a row's hash. A bucket over the
byte limit splits on the next bit, and only such a bucket, until each fits. The
bits come from the document's id first, then from its text, so that even rows
of one id part; identical rows, whose bits are all equal, are counted off within
their bucket in the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.texts import checkpointed

LEVEL = 16  # bits that are looked at in one pass
ID_BITS = 48
TEXT_BITS = 48


def _bits(digest: Column) -> Column:
    """The first 48 bits of a hexadecimal digest as text of 0 and 1."""
    return F.lpad(F.conv(F.substring(digest, 1, 12), 16, 2), 48, "0")


def hash_bits() -> Column:
    """96 bits of a row: 48 of its id, 48 of its text."""
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.concat(_bits(F.md5(id_text.cast("binary"))), _bits(F.md5(F.col("text").cast("binary"))))


def _fitting(cells: DataFrame, done: int, limit: int) -> DataFrame:
    """Of cells ``prefix, bytes`` whose first ``done`` bits are an oversized bucket: per cell the shortest fitting prefix, or null."""
    tried = cells.withColumn("depth", F.explode(F.sequence(F.lit(done), F.lit(done + LEVEL))))
    tried = tried.withColumn("bucket", F.expr("substring(prefix, 1, depth)"))
    sums = tried.groupBy("bucket").agg(F.sum("bytes").alias("bucket_bytes"))
    fits = tried.join(sums.where(F.col("bucket_bytes") <= limit), "bucket")
    best = fits.groupBy("prefix").agg(F.min(F.struct("depth", "bucket", "bucket_bytes")).alias("best"))
    return cells.join(best, "prefix", "left").select("prefix", F.col("best.bucket").alias("shard"))


def directory(rows: DataFrame, limit: int) -> list[DataFrame]:
    """Per pass ``prefix, shard``: the bucket of the rows whose bits begin with ``prefix``.

    ``rows(bits, bytes)``. Each pass sums bytes by the next ``LEVEL`` bits, only of
    the rows in buckets that are still too large. A bucket that is too large with
    all bits used stays as it is.
    """
    found, done = [], 0
    while True:
        upto = done + LEVEL
        prefix = F.substring("bits", 1, upto).alias("prefix")
        cells = rows.groupBy(prefix).agg(F.sum("bytes").alias("bytes"))
        placed = checkpointed(_fitting(cells, done, limit), "directory")
        if upto == ID_BITS + TEXT_BITS:
            return [*found, placed.select("prefix", F.coalesce("shard", "prefix").alias("shard"))]
        large = placed.where("shard IS NULL").select("prefix")
        found.append(placed.where("shard IS NOT NULL"))
        if large.isEmpty():
            return found
        rows = rows.select("bits", "bytes", prefix).join(large, "prefix", "left_semi").drop("prefix")
        done = upto


def _parts(large: DataFrame, limit: int) -> DataFrame:
    """Identical rows of a shard over the limit, counted off into parts that fit.

    The rows are numbered within the shard: within the partitions they were
    written in first, then by the partitions' counts, so no shard is one group.
    """
    rows = checkpointed(large.withColumn("piece", F.spark_partition_id()).withColumn("turn", F.monotonically_increasing_id()), "copies")
    inside = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("turn")) - 1
    pieces = rows.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
    sums = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("shard", "piece", F.coalesce(F.sum("n").over(sums), F.lit(0)).alias("before"))
    numbered = rows.withColumn("inside", inside).join(pieces, ["shard", "piece"])
    room = F.greatest(F.lit(1.0), F.floor(F.lit(float(limit)) / F.col("bytes")))
    part = F.floor((F.col("before") + F.col("inside")) / room).cast("long")
    return numbered.select("doc_id", "bytes", "shard", part.alias("part"))


def sharded(docs: DataFrame, limit: int = 1 << 20) -> DataFrame:
    """``doc_id, n_bytes, shard, depth, part, shard_bytes`` per row of ``docs(doc_id, text)``.

    ``shard`` is the bucket's bits and ``depth`` their number; ``shard_bytes``, the
    bytes of the row's shard and part, is at most ``limit``, unless a single row
    is larger. ``part`` is 0, or counts on where identical rows fill more than one
    shard. Null text has no bytes; null ids share their first bits; other columns
    are not read. An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).select("doc_id", F.octet_length("text").cast("long").alias("bytes"), hash_bits().alias("bits"))
    placed = rows.withColumn("shard", F.lit(None).cast("string"))
    for i, level in enumerate(directory(rows.select("bits", "bytes"), limit)):
        own = level.select("prefix", F.col("shard").alias("found"))
        placed = placed.withColumn("prefix", F.substring("bits", 1, (i + 1) * LEVEL)).join(own, "prefix", "left")
        placed = placed.withColumn("shard", F.coalesce("shard", "found")).drop("prefix", "found")
    placed = placed.select("doc_id", "bytes", "shard")
    sizes = placed.groupBy("shard").agg(F.sum("bytes").alias("size"), F.count(F.lit(1)).alias("n"))
    large = sizes.where((F.col("size") > limit) & (F.col("n") > 1)).select("shard")
    fits = placed.join(large, "shard", "left_anti").select("doc_id", "bytes", "shard", F.lit(0).cast("long").alias("part"))
    parted = fits.unionAll(_parts(placed.join(large, "shard", "left_semi"), limit))
    totals = parted.groupBy("shard", "part").agg(F.sum("bytes").alias("shard_bytes"))
    return parted.join(totals, ["shard", "part"]).select(
        "doc_id", F.col("bytes").alias("n_bytes"), "shard", F.length("shard").cast("long").alias("depth"), "part", "shard_bytes"
    )


ORACLE = """
WITH r AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n,
                  lpad(bin(('0x' || substr(md5(doc_id::VARCHAR), 1, 12))::BIGINT), 48, '0') AS bits FROM documents),
d AS (SELECT doc_id, n, depth, substr(bits, 1, depth) AS bucket FROM r, generate_series(0, 48) AS g(depth)),
b AS (SELECT bucket, sum(n) AS size FROM d GROUP BY bucket),
f AS (SELECT doc_id, any_value(n) AS n, arg_min(bucket, depth) AS shard, min(depth) AS depth, arg_min(size, depth) AS size
      FROM d JOIN b USING (bucket) WHERE size <= 1048576 GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, shard, depth::BIGINT AS depth, 0::BIGINT AS part, size::BIGINT AS shard_bytes FROM f
"""
