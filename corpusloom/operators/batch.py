"""Batches of segments, and the checks of how they cover them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..schemas import MAX_BATCH_BYTES, MAX_BATCH_SEGMENTS
from .pack import capped, numbered
from .segment import source_line


def chapter_runs(segments: DataFrame) -> DataFrame:
    """segments with `run`: a chapter's rows that follow each other; the same chapter later is another run."""
    by_pos = Window.partitionBy("book_id").orderBy("pos")
    changed = F.coalesce((F.col("chapter_id") != F.lag("chapter_id").over(by_pos)).cast("int"), F.lit(1))
    return segments.withColumn("_new", changed).withColumn("run", F.sum("_new").over(by_pos.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def batch_items(segments: DataFrame, max_bytes: int = MAX_BATCH_BYTES, max_segments: int = MAX_BATCH_SEGMENTS, max_chars: int | None = None, run: str = "chapter_id") -> DataFrame:
    """The flat form: segments with `pack`, the number of their batch in the chapter (or run)."""
    for name, value in (("max_bytes", max_bytes), ("max_segments", max_segments), ("max_chars", max_chars)):
        if value is not None and value <= 0:
            raise ValueError(f"{name} must be positive")
    x = segments.withColumn("_size", T.byte_count(F.col("source"))).withColumn("_chars", T.char_count(F.col("source")))
    return numbered(x, ["book_id", run], ["pos"], ["_size", "_chars"], capped(max_bytes, max_segments, max_chars))


def batches(items: DataFrame, run: str = "chapter_id") -> DataFrame:
    """BATCH rows of batch_items, with book_id: totals, ordered ids and segments, and the joined source text."""
    by_pos = F.array_sort(F.collect_list(F.struct("pos", F.col("id").cast("string").alias("id"), F.col("kind").cast("string").alias("kind"), F.col("source").cast("string").alias("source"))))
    keys = ["book_id", "chapter_id", *([run] if run != "chapter_id" else []), "pack"]
    x = items.groupBy(*keys).agg(F.min("pos").alias("first"), by_pos.alias("rows"), F.sum("_chars").cast("int").alias("char_count"), F.sum("_size").cast("int").alias("source_byte_count"))
    # numbering runs over batches, not segments
    x = x.withColumn("order", F.row_number().over(Window.partitionBy("book_id").orderBy("first"))).withColumn("chapter_order", F.row_number().over(Window.partitionBy("book_id", "chapter_id").orderBy("first")))
    text = F.array_join(F.transform("rows", lambda r: source_line(r["kind"], r["id"], r["source"])), "\n\n")
    return x.select(
        "book_id",
        T.batch_id(F.col("chapter_id"), F.col("chapter_order")).alias("batch_id"),
        "chapter_id",
        "order",
        "chapter_order",
        F.transform("rows", lambda r: r["id"]).alias("segment_ids"),
        F.transform("rows", lambda r: F.struct(r["id"].alias("id"), r["kind"].alias("kind"), r["source"].alias("source"))).alias("segments"),
        text.alias("source_text"),
        "char_count",
        "source_byte_count",
        F.lit("pending").alias("status"),
    )


def flat(batch_rows: DataFrame) -> DataFrame:
    """book_id, chapter_id, batch_id, batch_order, idx and the segment's fields, of nested batches."""
    return batch_rows.select("book_id", "chapter_id", "batch_id", F.col("order").alias("batch_order"), F.posexplode("segments").alias("idx", "s")).select("book_id", "chapter_id", "batch_id", "batch_order", "idx", "s.*")


def batch_stats(batch_rows: DataFrame, *by: str) -> DataFrame:
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return batch_rows.groupBy(*by).agg(
        F.count("*").alias("batches"),
        zero(F.max("source_byte_count")).alias("largest_bytes"),
        zero(F.max("char_count")).alias("largest_chars"),
        zero(F.max(F.size("segment_ids"))).alias("most_segments"),
    )


def coverage(segments: DataFrame, items: DataFrame) -> DataFrame:
    """entity_id, side: ids that only one side has, in one pass over both."""
    a, b = segments.select(F.col("id").cast("string").alias("entity_id")).distinct(), items.select(F.col("id").cast("string").alias("entity_id")).distinct()
    x = a.withColumn("l", F.lit(1)).join(b.withColumn("r", F.lit(1)), "entity_id", "full_outer")
    return x.where("l is null or r is null").select("entity_id", F.when(F.col("r").isNull(), "segment without batch").otherwise("batch item without segment").alias("side"))
