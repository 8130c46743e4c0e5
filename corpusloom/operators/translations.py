"""Rows that come back: normalisation, exact cover, and what may be appended to the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import placeholders as P
from ..functions import text as T
from ..schemas import STATUSES


def row_error(source: Column, translation: Column, status: Column, note: Column, clean: Column | None = None) -> Column:
    """The first rule that a row breaks, or null. Translations are compared after normalisation; clean is the normalised one, if it is there."""
    clean = T.strip(T.normalize_newlines(translation)) if clean is None else clean
    state = F.coalesce(status, F.lit("translated"))
    return (
        F.when(translation.isNull() | (T.strip(translation) == ""), "empty translation")
        .when(T.line_breaks(T.normalize_newlines(source)) != T.line_breaks(clean), "line break count differs")
        .when(P.extract(source) != P.extract(clean), "image placeholders differ")
        .when(~state.isin(*STATUSES), "unsupported status")
        .when((state == "needs_review") & (T.strip(F.coalesce(note, F.lit(""))) == ""), "needs_review without review_note")
    )


def normalized(rows: DataFrame, source: str = "source") -> DataFrame:
    """rows with error; and translation, status and review_note as they go into the ledger, where there is none."""
    status = F.coalesce("status", F.lit("translated"))
    x = rows.withColumn("_clean", T.strip(T.normalize_newlines(F.col("translation"))))
    x = x.withColumn("error", row_error(F.col(source), F.col("translation"), F.col("status"), F.col("review_note"), F.col("_clean")))
    fine = F.col("error").isNull()
    return x.withColumns(
        {
            "translation": F.when(fine, F.col("_clean")).otherwise(F.col("translation")),
            "review_note": F.when(fine & (status == "needs_review"), T.strip(F.col("review_note"))),
            "status": F.when(fine, status).otherwise(F.col("status")),
        }
    ).drop("_clean")


def exact_cover(expected: DataFrame, output: DataFrame, key: list[str]) -> DataFrame:
    """Per key (such as a batch): missing, extra and duplicated ids, and whether ids that fit came in another order.

    expected: key, idx, id. output: key, pos, id. One full join; lists stay within their key.
    """
    own = output.groupBy(*key, "id").agg(F.min("pos").alias("pos"), F.count("*").alias("n"))
    x = expected.select(*key, "id", "idx").join(own, [*key, "id"], "full_outer")
    ids = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.col("id"))))
    out = x.groupBy(*key).agg(
        ids(F.col("pos").isNull()).alias("missing"),
        ids(F.col("idx").isNull()).alias("extra"),
        ids(F.col("n") > 1).alias("duplicate"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "idx"))), lambda r: r["idx"]).alias("_in_order"),
    )
    fits = (F.size("missing") == 0) & (F.size("extra") == 0) & (F.size("duplicate") == 0)
    return out.withColumn("ok", fits).withColumn("reordered", fits & (F.col("_in_order") != F.array_sort("_in_order"))).drop("_in_order")


def merged(expected: DataFrame, output: DataFrame) -> DataFrame:
    """The output's rows, normalised, in the expected order. expected: id, idx, source; output: id and the model's fields."""
    return normalized(expected.join(output, "id")).orderBy("idx")


#: The order of a draft is cut into so many stretches.
STRETCHES = 200


def late_ids(rows: DataFrame) -> DataFrame:
    """segment_id, _n (its rows), _late: whether a row before it has a larger source position. rows: append_pos, segment_id, _pos.

    The order is one, but no task sees all of it: it is cut into stretches of about as many rows, each takes the
    largest position of the stretches before it (a row for each stretch), and goes on from there. Rows at the same
    place count as in source order.
    """
    at = F.col("append_pos")
    cuts = rows.agg(F.percentile_approx(at, F.array(*(F.lit(i / STRETCHES) for i in range(1, STRETCHES))), F.lit(10_000)).alias("_cuts"))
    stretch = F.coalesce(F.size(F.filter("_cuts", lambda c: c < at)), F.lit(0)).alias("_stretch")
    cut = rows.crossJoin(F.broadcast(cuts)).select("append_pos", "segment_id", "_pos", stretch)
    so_far = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    tops = cut.groupBy("_stretch").agg(F.max("_pos").alias("_top")).select("_stretch", F.max("_top").over(so_far).alias("_below"))
    inside = Window.partitionBy("_stretch").orderBy("append_pos", "_pos").rowsBetween(Window.unboundedPreceding, -1)
    x = cut.withColumn("_inside", F.max("_pos").over(inside)).join(F.broadcast(tops), "_stretch", "left")
    late = F.coalesce(F.col("_pos") < F.greatest("_inside", "_below"), F.lit(False))
    return x.groupBy("segment_id").agg(F.count("*").alias("_n"), F.max(late).alias("_late"))


def append_plan(draft: DataFrame, segments: DataFrame, ledger: DataFrame, allow_existing: bool = False) -> DataFrame:
    """draft (append_pos, segment_id, translation, status, review_note) with action: append, skip, or an error's name.

    Rules in order: id there, not repeated, known, not in the ledger (unless allowed), in source order, normal.
    Only ids and positions are looked at in order; whether a row is late matters where its id is there once, so
    the answer comes back by the id.
    """
    id_ = F.col("segment_id")
    known = segments.select(F.col("id").alias("segment_id"), F.col("pos").alias("_pos"), F.col("source"))
    places = known.groupBy("segment_id").agg(F.max("_pos").alias("_pos"))
    order = late_ids(draft.select("append_pos", "segment_id").join(places, "segment_id", "left"))
    done = ledger.select("segment_id").distinct().withColumn("_done", F.lit(True))
    x = draft.join(order, "segment_id", "left").join(known, "segment_id", "left").join(done, "segment_id", "left")
    x = normalized(x)
    error = (
        F.when(id_.isNull() | (id_ == ""), "missing segment_id")
        .when(F.col("_n") > 1, "duplicate segment_id")
        .when(F.col("_pos").isNull(), "unknown segment_id")
        .when(F.col("_done") & F.lit(not allow_existing), "already in the ledger")
        .when(F.col("_late"), "out of source order")
        .otherwise(F.col("error"))
    )
    x = x.withColumn("action", F.coalesce(error, F.when(F.col("_done"), "skip").otherwise("append")))
    return x.select("append_pos", "segment_id", "translation", "status", "review_note", "action")


def appended(ledger: DataFrame, draft: DataFrame) -> DataFrame:
    """The ledger with the draft's rows that it has not."""
    return ledger.unionByName(appendable(draft, ledger))


def appendable(draft: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows whose id the ledger has not: appending them twice changes nothing."""
    return draft.join(ledger.select("segment_id").distinct(), "segment_id", "left_anti")
