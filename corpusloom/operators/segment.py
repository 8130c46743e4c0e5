"""Cleaning and cutting of books into ordered segments."""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import MAX_SEGMENT_BYTES
from .pack import paragraphs

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def clean_pages(books: DataFrame) -> DataFrame:
    """book_id, text without page marker lines and trailing space, removed (number of markers). One row in, one out: no shuffle."""
    parts = T.lines(T.normalize_newlines(F.col("text")))
    marker = lambda s: T.is_page_marker(s)
    kept = F.array_join(F.transform(F.filter(parts, lambda s: ~marker(s)), T.rstrip), "\n")
    return books.select("book_id", F.concat(T.rstrip(kept), F.lit("\n")).alias("text"), F.size(F.filter(parts, marker)).alias("removed"))


HEAD = re.compile(r"(#{1,6})\s+(.+)", re.S)
MARKER = re.compile(r"\s*\[page\s+\d+\]\s*", re.I)


def segments_of(text: str, opens_of, strip_page_markers: bool) -> Iterator[tuple[int, int, str, str]]:
    """(chapter number, first line, kind, source) of a book's segments in order. opens_of: as of pack.paragraphs."""
    chapter, first, held, opens = 0, 0, [], opens_of()

    def paragraph() -> Iterator[tuple[int, int, str, str]]:
        if source := "\n".join(held).strip():
            yield chapter, first, "paragraph", source

    lines = (line.rstrip() for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n"))
    for n, line in enumerate(x for x in lines if not (strip_page_markers and MARKER.fullmatch(x))):
        head = HEAD.match(line)
        if head or opens(len(line.encode()), not line):
            yield from paragraph()
            held = []
        if head:
            level = len(head[1])
            chapter += level == 2
            yield chapter, n, "book_title" if level == 1 and not chapter else "heading", line.strip()
            opens = opens_of()
            continue
        if not held:
            first = n
        held.append(line)
    yield from paragraph()


def segment(books: DataFrame, max_segment_bytes: int = MAX_SEGMENT_BYTES, strip_page_markers: bool = True) -> DataFrame:
    """SEGMENT rows: every heading is one; body lines between headings are packed, whole, up to the cap.

    The size counts indentation and inner line ends; blank lines at a segment's edges do not count and go.
    A book is a row, so its segments and their numbers (from 1 in each chapter) are one pass over its text, where
    that lies: nothing is shuffled. Books without text have no segments.
    """
    if max_segment_bytes <= 0:
        raise ValueError("max_segment_bytes must be positive")
    opens_of = paragraphs(max_segment_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for book_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                orders, rows = Counter(), []
                for chapter, first, kind, source in segments_of(text.as_py(), opens_of, strip_page_markers) if text.is_valid else ():
                    orders[chapter] += 1
                    rows.append((book_id, first, chapter, orders[chapter], kind, source))
                kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string())
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["book_id", "pos", "chapter_no", "order", "kind", "source"])

    x = books.select(F.col("book_id").cast("string"), F.col("text").cast("string")).mapInArrow(run, "book_id string, pos long, chapter_no int, order int, kind string, source string")
    chapter = T.chapter_id(F.col("chapter_no"))
    return x.select("book_id", "pos", T.segment_id(chapter, F.col("order")).alias("id"), chapter.alias("chapter_id"), "order", "kind", "source", F.lit("imported").alias("status"))


def segment_stats(segments: DataFrame, *by: str) -> DataFrame:
    own = lambda kinds: F.count_if(F.col("kind").isin(*kinds))
    return segments.groupBy(*by).agg(
        F.count("*").alias("segments"),
        F.count_distinct(F.when(F.col("chapter_id") != "front", F.struct("book_id", "chapter_id"))).alias("chapters"),
        own(["book_title", "heading"]).alias("headings"),
        own(["paragraph"]).alias("paragraphs"),
    )


def source_line(kind: Column, segment_id: Column, source: Column) -> Column:
    return F.concat(F.lit("["), segment_id, F.lit(" | "), kind, F.lit("]\n"), source)
