"""Only files that were not taken in before, remembered by the stream's checkpoint."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.rejects import REASON
from shelfcast.schemas import SERIES_FILE
from shelfcast.sources import files


def new_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    fmt: str = "csv",
    glob: str = "*",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream of the rows of files in ``folder``."""
    reader = spark.readStream.schema(schema).format(fmt).option("pathGlobFilter", glob)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


@dataclass(frozen=True)
class SeriesStream:
    """Lines of new product files; each batch is read by the headers of its own files."""

    lines: DataFrame
    rejects: bool = False

    def of(self, batch: DataFrame) -> DataFrame:
        """The series in a batch of lines, or with ``rejects`` the rows left out."""
        tagged = tagged_batch(batch)
        return files.bad_rows(tagged) if self.rejects else files.good_rows(tagged)


def tagged_batch(batch: DataFrame) -> DataFrame:
    """The rows of a batch by their files' headers. A file is never split over batches, so its header is here."""
    return files.parsed(batch, files.headers(batch))


def new_series(
    spark: SparkSession, folder: str, files_per_batch: int | None = None, rejects: bool = False
) -> SeriesStream:
    """The product series in files that were not taken in before, the barcode taken from the file name.

    Columns are found by each file's header, which comes with the file: files that
    arrive while the stream runs are read like all others, and old files are not
    read again. Rows that do not parse are left out; with ``rejects`` the stream has
    them instead, as ``barcode, file, reject_reason, _corrupt_record``.
    """
    reader = spark.readStream.schema("value string").format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return SeriesStream(files.with_path(reader.load(f"{folder.rstrip('/')}/produto_*.csv")), rejects)


def _per_batch(lines: DataFrame, checkpoint: str, keep: Callable[[DataFrame, int], None]) -> None:
    query = lines.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _replace(rows: DataFrame, path: str, *keys: str) -> None:
    """Write the partitions at hand anew; a batch that runs again replaces what it wrote before."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def append_available(stream: DataFrame | SeriesStream, path: str, checkpoint: str) -> None:
    """Add everything that is there now to a parquet table and stop.

    A second call with the same checkpoint adds only files that came since. Product
    series are kept under their batch number.
    """
    if isinstance(stream, SeriesStream):
        return process_available(stream, path, checkpoint, lambda rows: rows)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


def process_available(
    stream: DataFrame | SeriesStream, path: str, checkpoint: str, step: Callable[[DataFrame], DataFrame]
) -> None:
    """Run ``step`` over each batch of new files and keep its result under the batch number.

    A batch that is run again after a failure replaces its own folder, so results
    are neither lost nor doubled. A file is never split over batches, so a product
    series reaches ``step`` whole.
    """
    of = stream.of if isinstance(stream, SeriesStream) else (lambda batch: batch)

    def keep(batch: DataFrame, batch_id: int) -> None:
        _replace(step(of(batch)).withColumn("batch", F.lit(batch_id)), path, "batch")

    _per_batch(stream.lines if isinstance(stream, SeriesStream) else stream, checkpoint, keep)


SERIES, REJECTED = "series", "rejected"


def take_in_series(
    spark: SparkSession, folder: str, path: str, checkpoint: str, files_per_batch: int | None = None
) -> None:
    """Good and rejected rows of the files that came since the last call, each to a folder of its own, from one pass.

    One write deals the rows of a batch to ``part=series`` and ``part=rejected``, under the
    batch number; running a batch again replaces both.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        part = F.when(F.col(REASON).isNull(), SERIES).otherwise(REJECTED)
        _replace(tagged_batch(batch).withColumns({"part": part, "batch": F.lit(batch_id)}), path, "part", "batch")

    _per_batch(new_series(spark, folder, files_per_batch).lines, checkpoint, keep)


def taken_in(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """What ``take_in_series`` has written: the series, and the rejected rows with their reasons."""
    text = [T.StructField(n, T.StringType()) for n in ("_file", files.CORRUPT)]
    tail = [T.StructField(REASON, T.StringType()), T.StructField("part", T.StringType()), T.StructField("batch", T.IntegerType())]
    rows = spark.read.schema(T.StructType([*text, *SERIES_FILE.fields, *tail])).parquet(path)
    return files.good_rows(rows.where(F.col("part") == SERIES)), files.bad_rows(rows.where(F.col("part") == REJECTED))
