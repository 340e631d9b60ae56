"""Several outputs that change together: a folder per version, and a list of the versions that are complete.

Outputs are written below a new folder first. A small file with that folder's
name then joins the list, under the next number; this one rename is the switch.
Readers take the last entry, so they see all outputs of one version or all of
another, and a run that fails leaves the last version as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

LIST, DATA = "versions", "data"


def _files(spark: SparkSession, path: str):
    """The file system that holds ``path``, and the maker of its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def stage(path: str) -> str:
    """A new folder for one version's outputs; nobody reads it before ``publish``."""
    return f"{path.rstrip('/')}/{DATA}/{uuid.uuid4().hex}"


def entries(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the published versions, in order; one small file each."""
    fs, make = _files(spark, path)
    folder = make(f"{path.rstrip('/')}/{LIST}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def publish(spark: SparkSession, path: str, folder: str) -> int:
    """Make the staged folder the current version; returns its number. Two writers get numbers of their own."""
    fs, make = _files(spark, path)
    root = f"{path.rstrip('/')}/{LIST}"
    fs.mkdirs(make(root))
    draft = make(f"{root}/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(folder.rpartition("/")[2].encode())
    out.close()
    number = max(entries(spark, path), default=0) + 1
    while fs.exists(make(f"{root}/{number:010d}")) or not fs.rename(draft, make(f"{root}/{number:010d}")):
        number += 1
    return number


def folder_of(spark: SparkSession, path: str, number: int | None = None) -> str | None:
    """The folder of a published version, by default the last one; None where there is none."""
    numbers = entries(spark, path)
    if number is None and numbers:
        number = numbers[-1]
    if number not in numbers:
        return None
    name = spark.read.text(f"{path.rstrip('/')}/{LIST}/{number:010d}").first().value
    return f"{path.rstrip('/')}/{DATA}/{name}"


def read_version(spark: SparkSession, path: str, table: str, number: int | None = None) -> DataFrame:
    """One table of a published version, by default the last one."""
    folder = folder_of(spark, path, number)
    if folder is None:
        raise ValueError(f"no published version in {path}")
    return spark.read.parquet(f"{folder}/{table}")


def prune(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all published versions but the last ``keep``, entries first. Staged folders stay."""
    fs, make = _files(spark, path)
    for number in entries(spark, path)[: -max(1, keep)]:
        folder = folder_of(spark, path, number)
        fs.delete(make(f"{path.rstrip('/')}/{LIST}/{number:010d}"), False)
        fs.delete(make(folder), True)
