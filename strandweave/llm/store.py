"""Versioned folders with atomic commits, on any file system that Spark reads.

A version is a folder ``v00000001``, ``v00000002``, ...; it is staged elsewhere and renamed into place by Hadoop's
``FileContext``, which fails if the name is taken. A writer passes the version that it started from and commits exactly
the next one, so that of two writers who started from the same version one fails and nothing is lost. Old versions may be
removed, but never the newest: a late writer whose name was free again sees a later version after its rename, takes its
own back and fails too. Readers take the newest version, so that they never see such a one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another writer committed the version first; start again from the newest one."""


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def newest(spark: SparkSession, folder: str) -> int:
    """The number of the newest version; 0 if there is none."""
    return max((int(v[1:]) for v in children(spark, folder) if v[:1] == "v" and v[1:].isdigit()), default=0)


def version_path(folder: str, version: int) -> str:
    return f"{folder}/v{version:08d}"


def commit(spark: SparkSession, staged: str, folder: str, base: int) -> int:
    """Rename ``staged`` to the version after ``base``; raises ``Conflict`` (and removes the staged folder) if it is taken."""
    jvm = spark.sparkContext._jvm
    fs, source = _path(spark, staged)
    _, parent = _path(spark, folder)
    fs.mkdirs(parent)
    _, target = _path(spark, version_path(folder, base + 1))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(source), fs.makeQualified(target), none)
    except Exception as error:
        fs.delete(source, True)
        if fs.exists(target):
            raise Conflict(f"{target} was committed by another writer") from error
        raise
    if newest(spark, folder) > base + 1:
        fs.delete(target, True)
        raise Conflict(f"{target} was committed by another writer, and later ones after it")
    return base + 1


def stage(rows: DataFrame, path: str, files: int = 1) -> str:
    """Write a table as a few files."""
    (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.parquet(path)
    return path
