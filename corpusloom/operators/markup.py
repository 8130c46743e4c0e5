"""Blocks of HTML that need not be well formed. EPUB documents, which must be, are read in sources.epub."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCKS = frozenset("p li dt dd pre h1 h2 h3 h4 h5 h6".split())
SKIPPED = frozenset("script style head".split())


class _Blocks(HTMLParser):
    """Text of each block element; a block ends where the next one begins."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[str, str]] = []
        self.tag, self.parts, self.skip = None, [], 0

    def done(self):
        text = "".join(self.parts).strip(" \t\r\n")
        if self.tag and text:
            self.rows.append((self.tag, text))
        self.tag, self.parts = None, []

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self.skip += 1
        elif tag in BLOCKS:
            self.done()
            self.tag = tag
        elif tag == "br":
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if tag in SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif tag in BLOCKS:
            self.done()

    def handle_data(self, data):
        if not self.skip and self.tag:
            self.parts.append(data.replace("\r", "").replace("\n", ""))


def html_blocks(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """id, block_no (from 0), tag, text; a heading that repeats the block before it is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, html in zip(batch.column(0).to_pylist(), batch.column(1)):
                p = _Blocks()
                p.feed(html.as_py() or "")
                p.close()
                p.done()
                rows = [r for i, r in enumerate(p.rows) if not (i and r[0].startswith("h") and r[1] == p.rows[i - 1][1])]
                out += [(key, i, *r) for i, r in enumerate(rows)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (batch.schema.field(0).type, pa.int32(), pa.string(), pa.string()))], [id_col, "block_no", "tag", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, F.col(html_col).cast("string")).mapInArrow(run, f"{id_col} {kind}, block_no int, tag string, text string")
