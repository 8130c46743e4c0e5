"""Sinks on any file system that Spark writes: JSON Lines, texts by name, and single files.

Tables are written by Spark's commit protocol, one part per task. A single small file (a request, a
page, a book) is written beside its place and renamed, so a reader never sees half of it.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def json_lines(rows: DataFrame) -> DataFrame:
    """value: each row as one line; null fields are left out, text stays as it is."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def write_jsonl(rows: DataFrame, path: str, *order: Column | str, single: bool = False, overwrite: bool = False) -> None:
    """Lines in order: parts follow each other by range, or one part holds all. An existing path is an error without overwrite."""
    x = rows
    if order:
        x = x.coalesce(1).sortWithinPartitions(*order) if single else x.orderBy(*order)
    json_lines(x).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def append_jsonl(rows: DataFrame, path: str) -> None:
    """New parts beside the old ones, which are not read."""
    json_lines(rows).write.mode("append").text(path)


def write_texts(rows: DataFrame, path: str, name: str, text: str, overwrite: bool = False) -> None:
    """One folder per name, with its text, written where the rows are."""
    rows.select(F.col(name), F.col(text).alias("value")).write.partitionBy(name).mode("overwrite" if overwrite else "errorifexists").option("lineSep", "\n").text(path)


def _context(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, p, fs = _context(spark, path)
    return fs.exists(p)


def size_and_time(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """Bytes and modification time (ms) of a file, or None."""
    _, p, fs = _context(spark, path)
    if not fs.exists(p):
        return None
    s = fs.getFileStatus(p)
    return s.getLen(), s.getModificationTime()


def signature(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files at a path: equal as long as nobody writes there."""
    _, p, fs = _context(spark, path)
    if not fs.exists(p):
        return ()
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)))


def put(spark: SparkSession, path: str, data: str | bytes, overwrite: bool = True) -> None:
    """One file, whole or not at all."""
    jvm, p, fs = _context(spark, path)
    if not overwrite and fs.exists(p):
        raise FileExistsError(path)
    beside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f"._{p.getName()}.new")
    fs.mkdirs(p.getParent())
    out = fs.create(beside, True)
    out.write(bytearray(data.encode() if isinstance(data, str) else data))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    how = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(beside), fs.makeQualified(p), how)


def get(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def put_each(rows: DataFrame, path: str, name: str, data: str, suffix: str, overwrite: bool = False) -> list[str]:
    """One file per row, under its name; rows come to the driver one at a time."""
    out = []
    for r in rows.select(name, data).where(F.col(data).isNotNull()).toLocalIterator():
        target = f"{path}/{r[0]}{suffix}"
        put(rows.sparkSession, target, r[1], overwrite)
        out.append(target)
    return out


def report_line(report: dict) -> str:
    """A report as one compact line."""
    return json.dumps(report, ensure_ascii=False, separators=(",", ":"))


def now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
