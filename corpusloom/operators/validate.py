"""Checks as tables of violations. enforce() is the only action: it raises the first rule that is broken."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import VIOLATION
from .progress import duplicates


def violation(rows: DataFrame, rule: str, priority: int, entity: Column, detail: Column | None = None) -> DataFrame:
    have = lambda c, kind: F.col(c).cast(kind) if c in rows.columns else F.lit(None).cast(kind)
    return rows.select(F.lit(rule).alias("rule"), F.lit(priority).alias("priority"), have("book_id", "string").alias("book_id"), entity.cast("string").alias("entity_id"), have("pos", "bigint").alias("pos"), (detail if detail is not None else F.lit(None)).cast("string").alias("detail"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def enforce(violations: DataFrame, shown: int = 20) -> None:
    """Raises ValueError with the lowest-priority rule and up to `shown` of its ids."""
    first = violations.orderBy("priority").limit(1).collect()
    if first:
        rows = violations.where(F.col("priority") == first[0]["priority"]).orderBy("entity_id").limit(shown).collect()
        raise ValueError(f"{first[0]['rule']}: " + ", ".join(str(r["detail"] or r["entity_id"]) for r in rows))


def missing_keys(rows: DataFrame, required: list[str], name: str) -> DataFrame:
    """Required keys that a row has not. With a column `keys` (those of the JSON object) a null under its key is there; without it, null counts as missing."""
    absent = (lambda c: ~F.array_contains("keys", c)) if "keys" in rows.columns else (lambda c: F.col(c).isNull())
    gone = F.filter(F.array(*(F.when(absent(c), F.lit(c)) for c in required)), lambda c: c.isNotNull())
    x = rows.withColumn("_gone", gone).where(F.size("_gone") > 0)
    return violation(x, f"{name}: missing keys", 1, F.col(required[0]), F.array_join("_gone", ", "))


def segments(rows: DataFrame) -> DataFrame:
    return union([
        missing_keys(rows, ["id", "chapter_id", "order", "kind", "source", "status"], "segments"),
        violation(rows.where("id = ''"), "segments: empty id", 2, F.col("id")),
        violation(duplicates(rows.where("id <> ''"), "id"), "segments: duplicate id", 3, F.col("id")),
    ])


def no_lists(rows: DataFrame) -> DataFrame:
    """Batches whose segment_ids is no list, or whose segments is no list of objects, by the column `line` of their JSON (none without it)."""
    if "line" not in rows.columns:
        return violation(rows.limit(0), "batches: not a list", 4, F.col("batch_id"))
    kind = lambda key: F.schema_of_variant(F.try_variant_get(F.try_parse_json("line"), f"$.{key}", "variant"))
    bad = F.array_compact(F.array(F.when(~kind("segment_ids").startswith("ARRAY<"), F.lit("segment_ids")), F.when(~kind("segments").rlike("^ARRAY<(OBJECT<|VOID>)"), F.lit("segments"))))
    x = rows.withColumn("_bad", bad).where(F.size("_bad") > 0)
    return violation(x, "batches: not a list", 4, F.col("batch_id"), F.array_join("_bad", ", "))


def batches(rows: DataFrame) -> DataFrame:
    inner = F.transform("segments", lambda s: s["id"])
    ids = rows.select("batch_id", F.explode("segment_ids").alias("id"))
    return union([
        missing_keys(rows, ["batch_id", "chapter_id", "order", "segment_ids", "segments", "source_text", "status"], "batches"),
        no_lists(rows),
        violation(rows.where("batch_id = ''"), "batches: empty id", 2, F.col("batch_id")),
        violation(duplicates(rows.where("batch_id <> ''"), "batch_id"), "batches: duplicate id", 3, F.col("batch_id")),
        violation(rows.where(F.col("segment_ids") != inner), "batches: segment_ids differ from segments", 5, F.col("batch_id")),
        violation(duplicates(ids, "id"), "batches: segment in two batches", 6, F.col("id")),
    ])


def translations(ledger: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """known: id. Without it, ids are not looked up."""
    parts = [
        missing_keys(ledger, ["segment_id", "translation", "status"], "translations"),
        violation(ledger.where("segment_id = ''"), "translations: empty segment_id", 2, F.col("segment_id")),
        violation(duplicates(ledger.where("segment_id <> ''"), "segment_id"), "translations: duplicate segment_id", 3, F.col("segment_id")),
        violation(ledger.where(T.strip(F.col("translation")) == ""), "translations: empty translation", 5, F.col("segment_id")),
    ]
    if known is not None:
        unknown = ledger.where("segment_id <> ''").select(F.col("segment_id").alias("id")).distinct().join(known.select("id"), "id", "left_anti")
        parts.append(violation(unknown, "translations: unknown segment_id", 4, F.col("id")))
    return union(parts)


def ordered_cover(segments_: DataFrame, items: DataFrame) -> DataFrame:
    """Batches must hold all segments in order. segments_: n, id; items: n, id (n counts both from 1)."""
    x = segments_.select("n", F.col("id").alias("a")).join(items.select("n", F.col("id").alias("b")), "n", "full_outer").where("not (a <=> b)")
    return violation(x.withColumnRenamed("n", "pos"), "batches: segments missing, extra or out of order", 1, F.coalesce("a", "b"))


def report(segments_: DataFrame, items: DataFrame, ledger: DataFrame, batch_rows: DataFrame | None = None) -> DataFrame:
    """issue, entity_id of the tolerant validation: everything that is wrong, nothing raised. batch_rows: batch_id, a row for each batch."""
    none, no = F.lit(0), F.lit(False)
    blank = T.strip(F.coalesce("translation", F.lit(""))) == ""
    row = lambda df, c, **own: df.select(F.col(c).cast("string").alias("id"), *(own.get(k, v).alias(k) for k, v in {"s": none, "b": none, "t": none, "blank": no, "good": no}.items()))
    each = row(segments_, "id", s=F.lit(1)).union(row(items, "id", b=F.lit(1))).union(row(ledger, "segment_id", t=F.lit(1), blank=blank, good=~blank))
    # one row for each id: how often it is a segment, in a batch and in the ledger, and what its translations are
    x = each.groupBy("id").agg(*(F.sum(c).alias(c) for c in "sbt"), *(F.max(c).alias(c) for c in ("blank", "good")))
    s, b, t, named = F.col("s"), F.col("b"), F.col("t"), F.col("id").isNotNull() & (F.col("id") != "")
    issues = {
        "duplicate_segment_ids": s > 1,
        "duplicate_batch_segment_ids": b > 1,
        "duplicate_translation_ids": named & (t > 1),
        "empty_translation_ids": named & F.col("blank"),
        "unmatched_translation_ids": named & F.col("good") & (s == 0),
        "segments_without_batch": (s > 0) & ((b == 0) | F.col("id").isNull()),
        "batch_items_without_segment": (b > 0) & ((s == 0) | F.col("id").isNull()),
    }
    found = F.array_compact(F.array(*(F.when(cond, F.lit(issue)) for issue, cond in issues.items())))
    missing = F.when(~named, F.array_repeat(F.lit("missing_translation_ids"), t.cast("int"))).otherwise(F.array().cast("array<string>"))
    out = x.select(F.explode(F.concat(found, missing)).alias("issue"), F.col("id").alias("entity_id"))
    if batch_rows is None:
        return out
    return out.union(duplicates(batch_rows, "batch_id").select(F.lit("duplicate_batch_ids"), F.col("batch_id").cast("string")))


def issue_names(report_rows: DataFrame) -> DataFrame:
    return report_rows.select("issue").distinct()


def empty(spark) -> DataFrame:
    return spark.createDataFrame([], VIOLATION)
