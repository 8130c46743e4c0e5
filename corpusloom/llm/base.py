"""What the operators of this package share: tables, parked results, code for the executors."""

from __future__ import annotations

import atexit
import shutil
import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_FALLBACK = f"/tmp/checkpoints/corpusloom-{uuid.uuid4().hex[:12]}"


def by_value(module: str) -> None:
    """Executors get this module's functions inside the task, so they need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def trim() -> None:
    """Gives freed memory back to the system: Python workers live on from task to task, and so would what their allocators keep."""
    import ctypes
    import gc

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def tidy(run):
    """run, a function of an Arrow batch iterator, with trim() at its task's end."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return whole


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only in local mode, where the cluster names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.conf.get("spark.master", "local").startswith("local") or spark.conf.get("spark.master", "local").startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        atexit.register(shutil.rmtree, _FALLBACK, ignore_errors=True)
        named = f"file://{_FALLBACK}"
    return named


#: With it, Spark deletes the shuffle files of an execution at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside the block leaves no shuffle files. These are of its own plan, so nothing reads them again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def park(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with freed(df.sparkSession):
        df.write.options(**options).parquet(path)
    jvm = df.sparkSession._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    # the folder goes with the session
    folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).deleteOnExit(folder)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.parked_at = path
    for held in _SCOPES:
        held.append(out)
    return out


_SCOPES: list[list[DataFrame]] = []


@contextmanager
def noted() -> Iterator[list[DataFrame]]:
    """A list of all that park() writes inside the block, so that it can go once its own result is parked."""
    held: list[DataFrame] = []
    _SCOPES.append(held)
    try:
        yield held
    finally:
        _SCOPES[:] = [x for x in _SCOPES if x is not held]


def unpark(*parked: DataFrame) -> None:
    """Deletes the folders of results of park() that nothing reads any more."""
    for df in parked:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.parked_at)
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def sweep(spark: SparkSession) -> None:
    """Shuffle files that nothing refers to any more go now, and not when the driver happens to collect its garbage: for steps that shuffle much."""
    spark.sparkContext._jvm.System.gc()


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: Groups of rows whose counts are added up together, before the sums are.
SPAN = 1024


def numbered(rows: DataFrame, key: str, order: list[str], name: str, group: int) -> DataFrame:
    """rows with `name`: 0, 1, 2, ... among the rows of one value of key (not null, a bounded number of values).

    Rows of a value are dealt by hash of `order` to groups of about `group` rows, which are numbered on
    their own; what comes before a group is summed up in two levels. So a value that all rows have is many
    tasks, and no sum is over more than a SPAN-th of the groups. rows is read twice and has to give the same
    rows each time; `order` should tell rows apart.
    """
    sizes = rows.groupBy(key).agg(F.ceil(F.count("*") / group).cast("long").alias("_groups"))
    x = rows.join(F.broadcast(sizes), key).withColumn("_g", F.pmod(F.xxhash64(*order), F.col("_groups")))
    counts = x.groupBy(key, "_g").agg(F.count("*").alias("_n")).withColumn("_span", F.expr(f"_g div {SPAN}"))
    spans = counts.groupBy(key, "_span").agg(F.sum("_n").alias("_n")).withColumn("_first", F.sum("_n").over(Window.partitionBy(key).orderBy("_span")) - F.col("_n"))
    inner = counts.withColumn("_in", F.sum("_n").over(Window.partitionBy(key, "_span").orderBy("_g")) - F.col("_n"))
    before = inner.join(spans.select(key, "_span", "_first"), [key, "_span"]).select(key, "_g", (F.col("_first") + F.col("_in")).alias("_before"))
    x = x.withColumn("_k", F.row_number().over(Window.partitionBy(key, "_g").orderBy(*order)).cast("long") - 1).join(before, [key, "_g"])
    return x.select(*rows.columns, (F.col("_k") + F.col("_before")).alias(name))


#: Bits of the sketch in likely(); its size is fixed (4 MB), whatever the tables hold.
SKETCH_BITS = 1 << 25


def _sketched(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """df with `_likely`, whether column may be in ids (same column): true for all that are, and for some others.

    A bitmap of hashed ids, at most 1024 rows of 4 KB, is broadcast.
    """
    place = F.pmod(F.xxhash64(column), F.lit(SKETCH_BITS))
    maps = ids.select(place.alias("at")).groupBy(F.expr("at div 32768").alias("_map_no")).agg(F.bitmap_construct_agg(F.expr("at % 32768")).alias("_map"))
    x = df.withColumn("_map_at", place).withColumn("_map_no", F.expr("_map_at div 32768")).join(F.broadcast(maps), "_map_no", "left")
    byte = F.conv(F.hex(F.substring("_map", F.expr("cast((_map_at % 32768) div 8 as int) + 1"), F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("getbit", byte, F.expr("cast(_map_at % 8 as int)"))
    # the row number keeps the optimizer from moving a later semi or anti join below the filter
    x = x.select(*df.columns, F.coalesce(bit == 1, F.lit(False)).alias("_likely"), F.monotonically_increasing_id().alias("_row"))
    return x.where("_row >= 0")


def likely(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows of df whose column may be in ids: wide rows without partner need not be shuffled. An exact join has to follow."""
    return _sketched(df, ids, column).where("_likely").drop("_likely", "_row")


def without(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows of df whose column is not in ids; of the others, and a few more, alone are shuffled."""
    x = _sketched(df, ids, column)
    sure, unsure = x.where("not _likely").drop("_likely", "_row"), x.where("_likely").drop("_likely", "_row")
    return sure.union(unsure.join(ids, column, "left_anti").select(*df.columns))
