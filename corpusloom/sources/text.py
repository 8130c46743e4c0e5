"""Scans of text, JSON Lines and model output. Missing optional files are empty tables."""

from __future__ import annotations

import json
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_
from pyspark.sql.window import Window

from ..functions import text as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _decode_py(data: bytes | None) -> str | None:
    if data is None:
        return None
    for encoding in ("utf-8-sig", "utf-8", "cp932"):
        try:
            return data.decode(encoding)
        except UnicodeDecodeError:
            pass
    return data.decode("utf-8", errors="replace")


def _decode_series(s: pd.Series) -> pd.Series:
    return s.map(_decode_py)


def read_books(spark: SparkSession, path: str) -> DataFrame:
    """book_id (file name without its last extension), text of each file. UTF-8 stays in the JVM; the rest is decoded in Python."""
    files = spark.read.format("binaryFile").load(path)
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(?<=.)\.[^.]*$", "")
    return decoded(files.select(name.alias("book_id"), "content"))


def decoded(rows: DataFrame) -> DataFrame:
    """book_id, text of (book_id, content: bytes), in the first of four encodings that fits, with line ends as \\n."""
    decode = F.pandas_udf(_decode_series, "string")
    x = rows.withColumn("valid", F.is_valid_utf8(F.col("content").cast("string")))
    good = x.where("valid").select("book_id", F.regexp_replace(F.col("content").cast("string"), "^﻿", "").alias("text"))
    other = x.where("not valid").select("book_id", decode("content").alias("text"))
    return good.union(other).withColumn("text", T.normalize_newlines(F.col("text")))


def lines_of(books: DataFrame) -> DataFrame:
    """book_id, line_no (from 0), line."""
    return books.select("book_id", F.posexplode(T.lines(F.col("text"))).alias("line_no", "line"))


def parse_jsonl(rows: DataFrame, text: str, schema: str, required: list[str] = ()) -> DataFrame:
    """Of a column of lines: line, its fields, keys of its object, and error (null if fine). Blank lines are left out, a byte order mark is ignored."""
    line = F.regexp_replace(F.col(text), "^﻿", "")
    x = rows.where(T.strip(line) != "").withColumn(text, line)
    keys = F.json_object_keys(F.col(text))
    missing = F.array_except(F.array(*(F.lit(k) for k in required)).cast("array<string>"), F.coalesce(keys, F.array().cast("array<string>")))
    parsed = F.from_json(F.col(text), schema, {"mode": "PERMISSIVE"})
    error = F.when(F.try_parse_json(F.col(text)).isNull(), "invalid JSON").when(~T.strip(F.col(text)).startswith("{"), "not an object").when(F.size(missing) > 0, F.concat(F.lit("missing keys: "), F.array_join(missing, ", ")))
    return x.withColumn("fields", F.when(error.isNull(), parsed)).withColumn("keys", F.when(error.isNull(), keys)).withColumn("error", error)


def read_jsonl(spark: SparkSession, path: str, schema: str, required: list[str] = (), optional: bool = False) -> DataFrame:
    """file, line_number (from 1), fields, error, keys and line (the object's keys, and its JSON) of every line that is not blank.

    Files are read in splits, however large. A line's number is its place in its split, as rows of a split have
    numbers in a row, after the lines of the file's splits before it: one row for each split is joined.
    """
    try:
        rows = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_from"), "value", F.monotonically_increasing_id().alias("_n"))
    except Exception as e:
        if optional and "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], f"file string, line_number long, fields struct<{schema}>, error string, keys array<string>, line string")
        raise
    splits = rows.groupBy("file", "_from").agg(F.min("_n").alias("_first"), F.count("*").alias("_lines"))
    before = F.coalesce(F.sum("_lines").over(Window.partitionBy("file").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = rows.join(splits.select("file", "_from", (before - F.col("_first") + 1).alias("_shift")), ["file", "_from"]).withColumn("line_number", F.col("_n") + F.col("_shift"))
    return parse_jsonl(each, "value", schema, required).select("file", "line_number", "fields", "error", "keys", F.col("value").alias("line"))


def strip_fence(text: Column) -> Column:
    """The inside of a Markdown fence around the whole text; null if it is not closed. Other texts as they are, stripped."""
    s = T.strip(text)
    parts = T.splitlines(s)
    closed = (F.size(parts) > 1) & (T.strip(F.element_at(parts, -1)) == "```")
    inside = T.strip(F.array_join(F.slice(parts, F.lit(2), F.size(parts) - 2), "\n"))
    return F.when(~s.startswith("```"), s).when(closed, inside)


def model_rows(text: str | None) -> tuple[str, str | None, list[dict]]:
    """(shape, error, rows) of one output. JSON is read strictly: anything after a value is an error."""
    body = (text or "").strip()
    if body.startswith("```"):
        parts = body.splitlines()
        if len(parts) < 2 or parts[-1].strip() != "```":
            return "fenced", "unclosed fence", []
        body = "\n".join(parts[1:-1]).strip()
    if not body:
        return "empty", "empty", []
    try:
        value = json.loads(body)
    except ValueError:
        rows = []
        for n, line in enumerate(body.splitlines(), 1):
            if line.strip():
                try:
                    rows.append(json.loads(line))
                except ValueError:
                    return "jsonl", f"line {n} is no JSON", []
        shape = "jsonl"
    else:
        if isinstance(value, list):
            shape, rows = "array", value
        elif isinstance(value, dict) and isinstance(value.get("translations"), list):
            shape, rows = "wrapped", value["translations"]
        elif isinstance(value, dict) and "segment_id" in value:
            shape, rows = "object", [value]
        else:
            return "other", "neither rows nor an object with segment_id", []
    if not all(isinstance(r, dict) for r in rows):
        return shape, "an item is no object", []
    return shape, None, rows


MODEL_FIELDS = ("segment_id", "translation", "status", "review_note")


def parse_model_output(rows: DataFrame, text: str) -> DataFrame:
    """Rows of each text (an array, {"translations": [...]}, one object with segment_id, or JSON Lines; fenced or not).

    The given columns, shape, error, pos (from 0) and the fields of MODEL_ROW; a text with an error is one row.
    """
    kind = T_.ArrayType(T_.StructType([T_.StructField(f, T_.StringType()) for f in MODEL_FIELDS]))
    out = T_.StructType([T_.StructField("shape", T_.StringType()), T_.StructField("error", T_.StringType()), T_.StructField("rows", kind)])
    x = rows.withColumn("_p", F.pandas_udf(_model_series, out)(F.col(text)))
    each = x.select(*rows.columns, "_p.shape", "_p.error", F.posexplode_outer("_p.rows").alias("pos", "_f"))
    return each.select(*rows.columns, "shape", "error", "pos", "_f.*")


def _model_series(s: pd.Series) -> pd.DataFrame:
    parsed = [model_rows(x) for x in s]
    as_text = lambda v: v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)
    # ids as str() has them: True, 1.0; a missing one stays null
    as_id = lambda v: v if v is None else str(v)
    fields = lambda r: {f: (as_id if f == "segment_id" else as_text)(r.get(f)) for f in MODEL_FIELDS}
    return pd.DataFrame({"shape": [p[0] for p in parsed], "error": [p[1] for p in parsed], "rows": [list(map(fields, p[2])) for p in parsed]})


def freshness(outputs: DataFrame, requests: DataFrame) -> DataFrame:
    """Of (name, modified) on both sides, the outputs that are older than their request."""
    r = requests.select("name", F.col("modified").alias("requested"))
    return outputs.join(r, "name").where("modified < requested")


def files_with_times(spark: SparkSession, path: str) -> DataFrame:
    x = spark.read.format("binaryFile").load(path)
    return x.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("modificationTime").alias("modified"), "length")


def style_guide(spark: SparkSession, path: str | None, default: str) -> tuple[str, str]:
    """(text, where it is from). A file that is there but blank is an error."""
    if path is None:
        return default.strip(), "built-in"
    try:
        found = spark.read.text(path, wholetext=True).first()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return default.strip(), "built-in"
    text = (found[0] if found else "").lstrip("﻿").strip()
    if not text:
        raise ValueError(f"style guide is empty: {path}")
    return text, path
