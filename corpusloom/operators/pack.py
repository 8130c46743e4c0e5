"""Greedy packing in order: the one kind of work whose next step depends on all before it in its group.

Rows are dealt by group and sorted within partitions; a partition is read once, in batches, with a
few numbers of state. So groups need not fit in memory, and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

import sys

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def numbered(rows: DataFrame, group: list[str], order: list[str], columns: list[str], make, partitions: int | None = None) -> DataFrame:
    """rows with `pack` (from 1 in each group). make() gives a function of the columns' values that says whether a new pack opens before the row."""
    spark = rows.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    k = len(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, opens, number = None, None, 0
        for batch in batches:
            out = []
            keys = zip(*(batch.column(c).to_pylist() for c in group))
            values = zip(*(batch.column(c).to_pylist() for c in columns))
            for own, row in zip(keys, values):
                if own != key:
                    key, opens, number = own, make(), 1
                    opens(*row)
                else:
                    number += bool(opens(*row))
                out.append(number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], [*batch.schema.names, "pack"])

    assert k, "a group is needed"
    dealt = rows.repartition(n, *group).sortWithinPartitions(*group, *order)
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return dealt.mapInArrow(run, f"{kind}, pack int")


def capped(max_bytes: int, max_count: int | None = None, max_chars: int | None = None):
    """A pack opens when the next row would take one of the sums over its cap; a row over the cap is a pack of its own."""

    def make():
        state = [0, 0, 0]

        def opens(size: int, chars: int = 0) -> bool:
            full = state[2] > 0 and (state[0] + size > max_bytes or (max_chars is not None and state[1] + chars > max_chars) or (max_count is not None and state[2] >= max_count))
            if full:
                state[:] = [0, 0, 0]
            state[0] += size
            state[1] += chars
            state[2] += 1
            return full

        return opens

    return make


def paragraphs(max_bytes: int):
    """Lines: (bytes, blank). Blank lines open nothing and count, with their line ends, only between lines of the same pack."""

    def make():
        state = [None, 0]  # bytes so far (None: no text yet), blank lines since

        def opens(size: int, blank: bool) -> bool:
            if blank:
                state[1] += state[0] is not None
                return False
            if state[0] is None:
                state[:] = [size, 0]
                return False
            # inner blank lines are empty once their trailing space is gone: a line end each
            longer = state[0] + state[1] + 1 + size
            if longer > max_bytes:
                state[:] = [size, 0]
                return True
            state[:] = [longer, 0]
            return False

        return opens

    return make
