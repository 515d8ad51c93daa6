"""Folders of any filesystem the session can reach: listing, sizes, staged replacement.

These are metadata calls of the Hadoop filesystem API; no table data passes
through them.  Errors (rights, network, a missing folder) are raised.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_entries(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """Names of the entries (files or table folders) directly under ``folder``, sorted.

    One level is listed, so part files of tables are not; a folder that does
    not exist is an error.
    """
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        raise FileNotFoundError(f"no such folder: {folder}")
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in names if n.endswith(suffix) and not n.startswith(("_", ".")))


def find_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, bytes): data files at any depth below a folder, ``path`` relative to it, whose name fits a pattern.

    A scan that reads no content; large listings are made by tasks.
    """
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        raise FileNotFoundError(f"no such folder: {root}")
    base = fs.makeQualified(p).toString().rstrip("/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    # local paths are written with one slash or three
    relative = F.regexp_replace(F.regexp_replace("path", "^([a-z]+:)/+", "$1/"), "^" + re.escape(re.sub("^([a-z]+:)/+", r"\1/", base)) + "/", "")
    return found.select(relative.alias("path"), F.col("length").alias("bytes"))


def find_tables(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """(table, files, bytes) of the tables at any depth below a folder, by the paths of their files.

    With a suffix a table is the path up to the first name that ends with it (a
    file or a folder of part files); else it is the folder that holds files,
    without the folders of its partitions.
    """
    name = F.regexp_extract("path", f"^(.*?{re.escape(suffix)})(?:/|$)", 1) if suffix else (
        F.regexp_replace(F.regexp_extract("path", "^(.*)/[^/]*$", 1), "(?:/|^)[^/=]+=.*$", ""))
    return (find_files(spark, root).select(name.alias("table"), "bytes").where("table <> ''")
            .groupBy("table").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")))


def folder_bytes(spark: SparkSession, path: str) -> tuple[int, int]:
    """(files, bytes) of a file or of the data files below a folder, from the listing alone."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(f"no such path: {path}")
    files = total = 0
    found = fs.listFiles(p, True)
    while found.hasNext():
        status = found.next()
        if not status.getPath().getName().startswith(("_", ".")):
            files, total = files + 1, total + status.getLen()
    return files, total


def file_lengths(spark: SparkSession, path: str, but: tuple[str, ...] = ()) -> list[int]:
    """Bytes of each data file at a path, below a folder or matching a pattern; empty if there is none.

    Files whose names end with one of ``but`` are left out.
    """
    fs, p = _fs(spark, path)
    out = []
    for status in fs.globStatus(p) or []:
        if status.isFile():
            if not status.getPath().getName().endswith(but):
                out.append(status.getLen())
            continue
        found = fs.listFiles(status.getPath(), True)
        while found.hasNext():
            inner = found.next()
            if not inner.getPath().getName().startswith(("_", ".")) and not inner.getPath().getName().endswith(but):
                out.append(inner.getLen())
    return out


def staging_path(target: str) -> str:
    """A new folder beside ``target``, hidden from listings until it replaces it."""
    root, _, name = target.rstrip("/").rpartition("/")
    return f"{root}/_staging-{name}-{uuid.uuid4().hex[:12]}"


def discard(spark: SparkSession, staging: str) -> None:
    fs, p = _fs(spark, staging)
    fs.delete(p, True)


def replace(spark: SparkSession, staging: str, target: str) -> None:
    """Put a completely written folder in the place of ``target``.

    What was there stands aside until the new folder has its name, and comes
    back if that fails.
    """
    fs, new = _fs(spark, staging)
    _, old = _fs(spark, target)
    _, aside = _fs(spark, staging_path(target))
    fs.mkdirs(old.getParent())
    had = fs.exists(old)
    if had and not fs.rename(old, aside):
        raise OSError(f"cannot move {target}")
    if not fs.rename(new, old):
        if had:
            fs.rename(aside, old)
        raise OSError(f"cannot move {staging} to {target}")
    if had:
        fs.delete(aside, True)
