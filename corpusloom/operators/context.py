"""Context and requests for what is to be translated next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..schemas import CONTEXT_SEGMENTS


def previous(items: DataFrame, targets: DataFrame, done: DataFrame, n: int = CONTEXT_SEGMENTS) -> DataFrame:
    """Per target batch, the last n done segments before its first target, in the same chapter, ascending.

    items: book_id, chapter_id, pos, id, kind, source. targets: batch_id, book_id, chapter_id, first_pos.
    done: id, translation. For all batches at once: done rows of a chapter are numbered, a batch knows
    how many lie before it, and takes a range of numbers by equi-join on chapter and block of n.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    key = ["book_id", "chapter_id"]
    own = items.select(*key, "pos", "id", "kind", "source").join(done.select("id", "translation"), "id").withColumn("k", F.row_number().over(Window.partitionBy(*key).orderBy("pos")).cast("long"))
    if n == 0:
        return targets.select("batch_id", *key).join(own, key).select("batch_id", *key, "k", "id", "kind", "source", "translation").limit(0)
    # the count of done rows before each target: one sorted pass over both
    marks = own.select(*key, "pos", F.lit(1).alias("d"), F.lit(None).cast("string").alias("batch_id")).union(targets.select(*key, F.col("first_pos").alias("pos"), F.lit(0), F.col("batch_id").cast("string")))
    before = Window.partitionBy(*key).orderBy("pos", "d").rowsBetween(Window.unboundedPreceding, 0)
    # a done row at the target's own place is no context: targets sort first
    known = marks.withColumn("upto", F.sum("d").over(before)).where("batch_id is not null").select("batch_id", *key, "upto")
    wanted = known.where("upto > 0").withColumn("k", F.explode(F.sequence(F.greatest(F.lit(1).cast("long"), F.col("upto") - n + 1), F.col("upto"))))
    return wanted.join(own, [*key, "k"]).select("batch_id", *key, "k", "id", "kind", "source", "translation")


def last_done(rows: DataFrame, key: list[str], pos: str, done: str, value: str, n: int) -> DataFrame:
    """The window form, per row: the last n values of done rows before it.

    Done rows gather themselves and the n - 1 done rows before (a bounded frame); every row then takes
    the last such list before it. So the work is linear in the rows, whatever a key holds.
    """
    if n <= 0:
        return rows.withColumn("context", F.array().cast(f"array<{rows.schema[value].dataType.simpleString()}>"))
    of_done = Window.partitionBy(*key, "_d").orderBy(pos).rowsBetween(1 - n, 0)
    before = Window.partitionBy(*key).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    x = rows.withColumn("_d", F.coalesce(F.col(done), F.lit(False))).withColumn("_c", F.when(F.col("_d"), F.collect_list(F.struct(F.col(value).alias("v"))).over(of_done)))
    empty = F.array().cast(f"array<{rows.schema[value].dataType.simpleString()}>")
    found = F.transform(F.last("_c", ignorenulls=True).over(before), lambda r: r["v"])
    return x.withColumn("context", F.coalesce(found, empty)).drop("_c", "_d")


DEFAULT_STYLE = "Keep names and terms consistent. Keep the register of the original. Prefer natural phrasing over literal order."


def requests(batch_rows: DataFrame, targets: DataFrame, context: DataFrame, style: str = DEFAULT_STYLE, style_source: str = "built-in", output: str = "{batch}_output.jsonl", next_command: str | None = None) -> DataFrame:
    """batch_id, request (Markdown): one row per batch with targets.

    targets: batch_id, idx, id, kind, source. context: as of previous().
    """
    part = lambda head, body: F.concat(F.lit("### "), head, F.lit("\n\n"), body, F.lit("\n"))
    head = lambda r: F.concat(r["id"], F.lit(" | "), r["kind"])
    t = targets.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("idx", "id", "kind", "source"))).alias("t"))
    c = context.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("k", "id", "kind", "source", "translation"))).alias("c"))
    x = batch_rows.select("batch_id", "chapter_id").join(t, "batch_id").join(c, "batch_id", "left")
    out = F.replace(F.lit(output), F.lit("{batch}"), F.col("batch_id"))
    n = F.size("t").cast("string")
    before = F.transform(F.coalesce("c", F.array()), lambda r: part(head(r), F.concat(F.lit("Source:\n\n"), T.indent(r["source"]), F.lit("\n\nTranslation:\n\n"), T.indent(r["translation"]))))
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("# Request "), F.col("batch_id")),
        F.lit(""),
        F.concat(F.lit("- Chapter: "), F.col("chapter_id")),
        F.concat(F.lit("- Targets: "), n),
        F.concat(F.lit("- Output: "), out),
        F.lit("\n## Rules\n"),
        F.lit("- Every target comes back once, under its id and in this order; nothing else does."),
        F.lit("- A translation has as many line breaks as its source, and the same image tokens in the same order."),
        F.lit("- One JSON object per line: segment_id, translation, status (translated, or needs_review with a review_note)."),
        F.concat(F.lit("\n## Style\n\nFrom: "), F.lit(style_source), F.lit("\n\n"), F.lit(style)),
        F.lit("\n## Context, not to be translated\n"),
        F.when(F.size(F.coalesce("c", F.array())) > 0, F.array_join(before, "\n")).otherwise(F.lit("Nothing of this chapter is done before these targets.\n")),
        F.lit("## Targets\n"),
        F.array_join(F.transform("t", lambda r: part(head(r), T.indent(r["source"]))), "\n"),
        F.concat(F.lit("## Order of the "), n, F.lit(" rows\n")),
        F.array_join(F.transform("t", lambda r, i: F.concat((i + 1).cast("string"), F.lit(". "), r["id"])), "\n"),
        F.lit(f"\nThen: {next_command}" if next_command else ""),
    )
    return x.select("batch_id", text.alias("request"))
