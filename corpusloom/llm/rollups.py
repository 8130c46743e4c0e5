"""Token counts by source, language and tokenizer version, kept up to date by deltas.

Documents come in batches of inserts, deletes and revisions. A batch becomes signed rows: a new
count with +1, the count it takes the place of with -1. They are summed per (source, lang,
tokenizer), first within each task, and the sums, a few rows, are all that a batch adds to the
rollup. Totals are the sum of what is committed.

A batch has an id and is committed once: its rows are written to a folder of their own, which is
then renamed to the id's; the rename fails if that is there. So a batch that is sent again, by a
retry or by two writers at once, changes nothing. compact() folds committed batches into a snapshot;
their ids stay known.

A null text has no tokens. Null sources and languages are groups like others. Repeated rows count as
often as they are there. Extra columns do not matter. Groups whose sums are all zero are not in the
totals; empty tables give empty totals.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import by_value, park, shared_dir, table, tidy
from .tokens import PATTERN, cached, default_path, encoder, unbroken

by_value(__name__)

KEYS = ["source", "lang", "tokenizer"]
ROWS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def rank_file(path: str):
    """ids(text) by a rank file of tiktoken."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return unbroken(tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}))


def token_counts(docs: DataFrame, tokenizer: str, path: str) -> DataFrame:
    """docs: doc_id, source, lang, text. Returns doc_id, source, lang, tokenizer (the version's name), n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(path).ids if path.endswith(".json") else cached(("ranks", path), lambda: rank_file(path))
        for batch in batches:
            n = [len(ids(x.as_py())) if x.is_valid else 0 for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([tokenizer] * len(n), pa.string()), pa.array(n, pa.int64())], ["doc_id", *KEYS, "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long"), *(F.col(c).cast("string") for c in ("source", "lang", "text")))
    return rows.mapInArrow(tidy(run), "doc_id long, source string, lang string, tokenizer string, n_tokens long")


def signed(new: DataFrame | None, old: DataFrame | None) -> DataFrame:
    """Rows with their sign: +1 for what is new, -1 for the counts that go. A revision is both."""
    both = [x.select(*KEYS, "n_tokens", F.lit(s).alias("sign")) for x, s in ((new, 1), (old, -1)) if x is not None]
    return both[0] if len(both) == 1 else both[0].union(both[1])


def delta(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).cast("long").alias("n_tokens"))
    return sums.where("n_docs <> 0 or n_tokens <> 0")


class Rollup:
    """The rollup under a folder of any file system that Spark reads and writes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._fs = jvm.org.apache.hadoop.fs.FileContext.getFileContext(jvm.java.net.URI(self.path), spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _publish(self, temporary: str, name: str) -> bool:
        """Renames, unless the name is there already."""
        none = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._fs.rename(self._at(temporary), self._at(name), none)
            return True
        except Exception:
            if not self._fs.util().exists(self._at(name)):
                raise
            self._fs.delete(self._at(temporary), True)
            return False

    def _names(self, kind: str) -> list[str]:
        if not self._fs.util().exists(self._at("")):
            return []
        names = (s.getPath().getName() for s in self._fs.util().listStatus(self._at("")))
        return sorted(n for n in names if n.startswith(kind))

    @staticmethod
    def _folder(batch_id: str) -> str:
        return f"batch-{batch_id.encode().hex()}"

    def committed(self, batch_id: str) -> bool:
        return self._fs.util().exists(self._at(self._folder(batch_id)))

    def commit(self, batch_id: str, rows: DataFrame) -> bool:
        """Adds the signed rows once; false if the batch was there before."""
        if self.committed(batch_id):
            return False
        temporary = f"_new-{uuid.uuid4().hex}"
        delta(rows).write.parquet(f"{self.path}/{temporary}")
        return self._publish(temporary, self._folder(batch_id))

    def _read(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(ROWS).parquet(*(f"{self.path}/{n}" for n in names)) if names else self.spark.createDataFrame([], ROWS)

    def _parts(self) -> tuple[list[str], list[str]]:
        """Folders to sum: the last snapshot's and those of batches that it does not cover; and all batches, by name (one for each commit)."""
        batches = self._names("batch-")
        snapshots = self._names("snapshot-")
        if not snapshots:
            return batches, batches
        covered = {r["name"] for r in self.spark.read.schema("name string").parquet(f"{self.path}/{snapshots[-1]}/covers").collect()}
        return [f"{snapshots[-1]}/rows", *(b for b in batches if b not in covered)], batches

    def totals(self) -> DataFrame:
        sums = self._read(self._parts()[0]).groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> bool:
        """One snapshot instead of many small folders. False if another writer made the same one."""
        names, batches = self._parts()
        temporary, number = f"_new-{uuid.uuid4().hex}", len(self._names("snapshot-"))
        self._read(names).groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).write.parquet(f"{self.path}/{temporary}/rows")
        self.spark.createDataFrame([(b,) for b in batches], "name string").coalesce(1).write.parquet(f"{self.path}/{temporary}/covers")
        return self._publish(temporary, f"snapshot-{number:012d}")


def share(k: int):
    """A tenth of the documents, by hash of the id."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == k


def op10_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted; a tenth is revised (a text grows by its first 200 characters), a tenth
    deleted, a tenth moved to another tokenizer version; and two batches are sent again.
    """
    first, second = "byte_bpe_50k", "byte_bpe_multi_50k"
    docs = table(spark, sf_dir, "documents")
    path = default_path()
    counts = park(token_counts(docs, first, path), "counts")
    rollup = Rollup(spark, f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}")
    rollup.commit("load", signed(counts, None))
    grown = docs.where(share(0)).withColumn("text", F.concat("text", F.lit(" "), F.substring("text", 1, 200)))
    revised = park(token_counts(grown, first, path), "revised")
    rollup.commit("revise", signed(revised, counts.where(share(0))))
    rollup.commit("delete", signed(None, counts.where(share(1))))
    rollup.compact()
    other = token_counts(docs.where(share(2)), second, path.replace(f"{first}.json", f"{second}.tiktoken"))
    rollup.commit("retokenize", signed(other, counts.where(share(2))))
    rollup.commit("delete", signed(None, counts.where(share(1))))
    rollup.commit("revise", signed(revised, counts.where(share(0))))
    return rollup.totals()
