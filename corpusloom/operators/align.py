"""Positional alignment of two ordered tables, and link closure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def blocks(segments: DataFrame) -> DataFrame:
    """One row per block: paragraphs fall apart at blank lines, titles stay whole."""
    parts = F.when(F.col("kind") == "paragraph", F.split("source", "\n\n", -1)).otherwise(F.array("source"))
    return segments.select("*", F.posexplode(parts).alias("part_no", "block"))


def zipped(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """key, problem of pairs by position: count, then kind, then text (white space at the edges aside). Both: key, kind, text."""
    a, b = left.select(*key, F.col("kind").alias("kind_a"), F.col("text").alias("text_a")), right.select(*key, F.col("kind").alias("kind_b"), F.col("text").alias("text_b"))
    x = a.withColumn("_a", F.lit(1)).join(b.withColumn("_b", F.lit(1)), key, "full_outer")
    problem = F.when(F.col("_b").isNull(), "only left").when(F.col("_a").isNull(), "only right").when(~F.col("kind_a").eqNullSafe(F.col("kind_b")), "kind differs").when(~T.edge_equal(F.col("text_a"), F.col("text_b")), "text differs").otherwise("equal")
    return x.select(*key, problem.alias("problem"))


def dangling(references: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """References that no target answers."""
    return references.join(targets.select(key).distinct(), key, "left_anti")


def blank_lines_agree(source, translation):
    return F.coalesce(T.blank_line_positions(source) == T.blank_line_positions(translation), F.lit(False))
