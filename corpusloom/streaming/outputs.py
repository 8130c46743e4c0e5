"""Model outputs as a stream: every new file in a folder is parsed, checked and appended to the ledger.

A file is named after its batch (<batch>_output.jsonl or .json). All batches of a micro-batch are
checked together: exact cover per batch, then each row. Only whole batches are appended; the others
go to a table of rejects, with the reason, and can be sent again as a new file. The append leaves
out ids that the ledger has, so a micro-batch that is run again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import progress, translations
from ..plans.workspace import Workspace
from ..sinks import files
from ..sources import text as S

NAME = r"([^/]+)_output\.jsonl?$"


def judged(rows: DataFrame, items: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to append, rejects: batch_id, reason) of parsed outputs. rows: batch_id, error, pos and the fields of a row."""
    broken = rows.where("error is not null").groupBy("batch_id").agg(F.min("error").alias("reason"))
    given = rows.where("error is null").select("batch_id", "pos", F.col("segment_id").alias("id"), "translation", "status", "review_note")
    touched = rows.select("batch_id").distinct()
    expected = progress.pending_items(items.join(touched, "batch_id", "left_semi"), progress.completed(ledger)).select("batch_id", "id", "idx", "source")
    cover = translations.exact_cover(expected, given, ["batch_id"])
    reason = F.when(F.size("missing") > 0, "missing ids").when(F.size("extra") > 0, "ids that are not expected").when(F.size("duplicate") > 0, "repeated ids")
    uncovered = cover.where("not ok").select("batch_id", reason.alias("reason"))
    checked = translations.normalized(expected.join(given, ["batch_id", "id"]))
    wrong = checked.where("error is not null").groupBy("batch_id").agg(F.min("error").alias("reason"))
    rejects = broken.unionByName(uncovered).unionByName(wrong).groupBy("batch_id").agg(F.min("reason").alias("reason"))
    good = checked.join(rejects.select("batch_id"), "batch_id", "left_anti").select("batch_id", "idx", F.col("id").alias("segment_id"), "translation", "status", "review_note")
    return translations.appendable(good, ledger), rejects


def submit(workspace: Workspace, outputs: DataFrame) -> None:
    """outputs: file, value (whole texts)."""
    named = outputs.withColumn("batch_id", F.regexp_extract("file", NAME, 1)).where("batch_id <> ''")
    rows = S.parse_model_output(named, "value").persist()
    try:
        items, ledger = workspace.items(), workspace.ledger()
        good, rejects = judged(rows, items, ledger)
        last = ledger.agg(F.coalesce(F.max("append_pos"), F.lit(0))).first()[0]
        order = items.select("batch_id", F.col("id").alias("segment_id"), "pos")
        # places in the ledger are ordered and unique, not gapless: no global numbering is needed
        placed = good.join(order, ["batch_id", "segment_id"]).orderBy("batch_id", "idx").withColumn("append_pos", F.monotonically_increasing_id() + last + 1)
        placed = placed.select("append_pos", "segment_id", "translation", "status", "review_note").persist()
        if placed.limit(1).count():
            files.append_jsonl(placed, workspace.ledger_path)
        if rejects.limit(1).count():
            files.append_jsonl(rejects, f"{workspace.root}/work/rejects.jsonl")
        placed.unpersist()
    finally:
        rows.unpersist()


def watch(workspace: Workspace, checkpoint: str, folder: str | None = None, once: bool = False, every: str = "10 seconds", files_at_once: int = 1000) -> StreamingQuery:
    """Follows the folder of outputs; once: what is there now, then ends."""
    stream = workspace.spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_at_once).option("pathGlobFilter", "*_output.json*")
    rows = stream.load(folder or workspace.checkpoints).select(F.col("_metadata.file_path").alias("file"), "value")
    writer = rows.writeStream.foreachBatch(lambda df, _: submit(workspace, df)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()
