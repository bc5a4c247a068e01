"""Paths that every executor can reach."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def _shared_root(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def has_shared_root(spark: SparkSession) -> bool:
    return _shared_root(spark) is not None


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for files that outlive one job, in the folder that all executors share.

    That is ``spark.checkpoint.dir``, or what ``SparkContext.setCheckpointDir`` was given.
    """
    root = _shared_root(spark)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{root.rstrip('/')}/lakemill/{purpose}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    hadoop_path = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(sc._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isDirectory()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly inside a folder, none when it is missing."""
    fs, folder = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; one that somebody else has renamed meanwhile is left alone."""
    fs, target_path = _file_system(spark, target)
    source_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    fs.mkdirs(target_path.getParent())
    if not fs.rename(source_path, target_path) and not (fs.exists(target_path) and not fs.exists(source_path)):
        raise OSError(f"cannot rename {source} to {target}")


def copy_folder(spark: SparkSession, source: str, target: str) -> None:
    """Copy a folder, if it is there."""
    fs, source_path = _file_system(spark, source)
    if fs.exists(source_path):
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        hadoop.FileUtil.copy(fs, source_path, fs, hadoop.Path(target), False, True, conf)


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, hadoop_path = _file_system(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def swap_folders(spark: SparkSession, current: str, fresh: str, retired: str) -> None:
    """Put the fresh folder in the place of the current one, which is kept aside until that is done."""
    fs, _ = _file_system(spark, current)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for source, target in ((current, retired), (fresh, current)):
        if not fs.rename(path(source), path(target)):
            raise OSError(f"cannot rename {source} to {target}")
    fs.delete(path(retired), True)


def move_single_files(spark: SparkSession, source: str, prefix: str, target: str, suffix: str) -> None:
    """Give the one file of each folder ``<prefix><name>`` the path ``<target>/<name><suffix>``."""
    fs, folder = _file_system(spark, source)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(target))
    for sub in fs.listStatus(folder):
        name = sub.getPath().getName()
        if name.startswith(prefix):
            (part,) = (f for f in fs.listStatus(sub.getPath()) if not f.getPath().getName().startswith((".", "_")))
            fs.rename(part.getPath(), path(f"{target}/{name.removeprefix(prefix)}{suffix}"))


def escape_glob(path: str, specials: str = "*?[]{}") -> str:
    """Make the given wildcard characters literal for Hadoop path globbing."""
    return re.sub(f"([{re.escape(specials)}])", r"\\\1", path)


def file_selection(
    spark: SparkSession, path: str, suffix: str, wildcards: str
) -> tuple[str, dict[str, str]]:
    """Reader path and options for a file, a directory or a wildcard path.

    A directory selects the files ending in ``suffix`` directly inside it.  Otherwise
    the path is a pattern when it holds one of ``wildcards``, and a plain file when not.
    """
    if is_directory(spark, path):
        return escape_glob(path), {"pathGlobFilter": f"*{suffix}"}
    if any(mark in path for mark in wildcards):
        return escape_glob(path, "{}"), {}
    return escape_glob(path), {}
