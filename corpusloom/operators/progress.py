"""What is done and what is pending: always derived from the ledger, never stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T


def completed(ledger: DataFrame) -> DataFrame:
    """id of every segment with a translation that is not blank."""
    return ledger.where((F.col("segment_id") != "") & (T.strip(F.col("translation")) != "")).select(F.col("segment_id").alias("id")).distinct()


def pending_items(items: DataFrame, done: DataFrame) -> DataFrame:
    return items.join(done.select("id"), "id", "left_anti")


def pending_batches(items: DataFrame, done: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """Per batch with missing segments: their number, the first and last of them, and the batch's size."""
    x = items.join(done.select("id", F.lit(True).alias("_done")), "id", "left")
    missing = F.col("_done").isNull()
    return (
        x.groupBy(*keys)
        .agg(
            F.count_if(missing).alias("missing_count"),
            F.min_by("id", F.when(missing, F.col(pos))).alias("first_missing_segment_id"),
            F.max_by("id", F.when(missing, F.col(pos))).alias("last_missing_segment_id"),
            F.count("*").alias("segment_count"),
            F.min(pos).alias("first_pos"),
        )
        .where("missing_count > 0")
    )


def first_pending(pending: DataFrame, *order: Column | str, n: int = 1) -> DataFrame:
    """The first n pending batches in order; none for n of 0 or less."""
    return pending.orderBy(*order).limit(max(n, 0))


def totals(segments: DataFrame, ledger: DataFrame, *by: str) -> DataFrame:
    """Segments, done and pending, from one left join."""
    x = segments.join(completed(ledger).withColumn("_done", F.lit(1)), "id", "left")
    return x.groupBy(*by).agg(F.count("*").alias("segments"), F.count("_done").alias("completed"), F.count_if(F.col("_done").isNull()).alias("pending"))


def percent(done: Column, total: Column) -> Column:
    return F.when(total > 0, done / total * 100).otherwise(F.lit(0.0))


def percent_text(done: Column, total: Column) -> Column:
    return F.format_string("%.1f%%", percent(done, total))


def batch_range(batch_rows: DataFrame, start: str | None, count: int, *order: str) -> DataFrame:
    """`count` batches in order from batch `start` (the first if none): a top-k, so no global numbering."""
    if count <= 0:
        raise ValueError("count must be positive")
    x = batch_rows
    if start is not None:
        at = x.where(F.col("batch_id") == start).select(*order).orderBy(*order).first()
        if at is None:
            return x.limit(0)
        x = x.where(F.struct(*order) >= F.struct(*(F.lit(v).alias(c) for c, v in zip(order, at))))
    return x.orderBy(*order).limit(count)


def checkpoint(expected: DataFrame, done: DataFrame) -> DataFrame:
    """Per expected batch, its missing segment ids in order. expected: batch_id, idx, id."""
    x = pending_items(expected, done)
    rows = x.groupBy("batch_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "id"))), lambda r: r["id"]).alias("missing"))
    return expected.select("batch_id").distinct().join(rows, "batch_id", "left").withColumn("missing", F.coalesce("missing", F.array().cast("array<string>")))


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def later_occurrences(rows: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """Every row after the first of its key."""
    return rows.withColumn("occurrence", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("occurrence > 1")


def last_of(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key: a maximum that is combined before the shuffle, not a sort."""
    rest = [c for c in rows.columns if c != key]
    x = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
    return x.select(key, *(F.col(f"_r.{c}").alias(c) for c in rest)).select(*rows.columns)
