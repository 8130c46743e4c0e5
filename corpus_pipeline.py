"""A training-data pipeline over documents: toxicity, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents, and nothing else. A stage's result is written as Parquet and read again as the next
one's docs.

In every stage: nulls may be in any column; a null text is empty, and a null id is an id of its own
kind. Texts of any length are whole. Rows may be repeated: the stages decide row by row, by a row key
of their own where rows meet, so nothing goes because another row with its id goes. Extra columns are
left out. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import minhash, packing, suffix
from corpusloom.llm import toxicity as toxic
from corpusloom.llm.base import noted, park, sweep, table, unpark, without

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.7 or more go.

    Each row has the score of its own text; equal texts have equal scores, and empty ones the model's
    bias. Where no row is labelled, all scores are 0.5, and all documents stay.
    """
    model = toxic.learned(spark, docs, table(spark, sf_dir, "labels"))
    return toxic.clean(docs.select(*COLUMNS), model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays, that with the smallest id (a null id comes last; of equal ids, the first row).

    So of repeated rows one stays. Texts without words are linked with nothing, and all stay.
    """
    rows = park(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows", compression="zstd")
    with noted() as written:
        part = minhash.near_duplicates(rows, id_col="row").select(F.col("doc_id").alias("row"), "component_id")
        part = park(part.join(rows.select("row", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row").alias("place")), "row"), "parts")
    # what the search for duplicates wrote is not read any more
    unpark(*(x for x in written if x is not part))
    sweep(spark)
    # a minimum for each group, made in part before the shuffle; with both sides written, Spark splits a large group in the join
    first = park(part.groupBy("component_id").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1"), "firsts")
    gone = part.join(first.select("component_id", F.col("first.row").alias("first")), "component_id").where("row <> first").select("row")
    return without(rows, park(gone, "gone"), "row").select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that are elsewhere too go, but for their first copy, and documents of which nothing else stays.

    The first copy is the one in the document with the smallest id (a null id comes last; of equal ids,
    the first row), and there the one furthest to the front. So a repeated row goes, and one of it stays.
    """
    x = suffix.without_repeats(docs.select(*COLUMNS), carry=["lang", "source"], rule=suffix.PASSAGES, keep="first")
    x = x.where("not (n_removed > 0 and text rlike '^\\\\s*$')")
    return x.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of sequences; each row is packed, an empty text as its end alone."""
    return packing.packed(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("repeats", repeats), ("packing", pack)]

#: Hashed terms, MinHash and a tokenizer have no SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = park(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
