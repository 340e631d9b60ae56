"""Session defaults and the shared folder used for checkpoints and hand-over tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "shelfcast", cpus: str | int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the submitter's session is used as it is."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a temporary folder: there the driver
    and the executors are one process on one machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    named = tempfile.mkdtemp(prefix="shelfcast-")
    sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; nothing is ever overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _remove_at_end(spark: SparkSession, path: str) -> None:
    """Ask the file system to delete the path when the driver's process ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several jobs read the same intermediate result (model fits). The
    files outlive lost executors, so nothing upstream is computed again. They go
    when the application ends.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    _remove_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_up_to(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only when the side is proven to hold at most ``max_rows`` rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Hash partitions by key in the session's full number of shuffle partitions.

    Series grow many times after this shuffle (filled days, windows, model fits).
    Without a count, adaptive execution packs the few bytes it sees now into too
    few tasks. A later shuffle on the same key is left out by Spark.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
