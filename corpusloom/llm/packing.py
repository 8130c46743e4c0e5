"""Best-fit packing of tokenized documents into sequences, improved by local search.

Only documents longer than a sequence are cut: into full pieces after a shorter first one. What is
packed is a histogram of piece lengths (one count per length, however many documents there are).
A bin is a pattern of lengths, and equal bins are one pattern with a number. Patterns are built by
best fit, largest length first. Local search then takes the emptiest bins and exchanges one for
one, two for one or one for two, or moves a piece, between underfull bins, always increasing the
sum of squared fills, until bins empty. Equal bins take the same step together, so the work follows
the number of lengths, not of documents. Pieces are then numbered within their length, in groups of
bounded size, and take the places of the patterns by number.

A null text is empty: its document is the end mark alone. Rows get a key of their own, so ids may be
null or repeated; extra columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import by_value, numbered, park, table, tidy
from .tokens import default_path, encoder

by_value(__name__)

SIZE, END = 1024, 2
#: Pieces of one length that are numbered together.
GROUP = 2000
#: Steps of local search; each moves all equal bins at once.
STEPS = 4000

PIECES = "array<struct<start: long, length: long, crc: long>>"


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones after a first that may be shorter."""
    if n <= size:
        return [(0, n)]
    first = n % size
    return ([(0, first)] if first else []) + [(s, size) for s in range(first, n, size)]


def tokenized(docs: DataFrame, id_col: str, text_col: str, path: str, size: int, end: int) -> DataFrame:
    """rid, doc_id, pieces of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, rid = encoder(path), TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, out = batch.slice(at, 512), []
                for text in part.column(1):
                    ids = np.array([*enc.ids(text.as_py() or ""), end], "<u4")
                    out.append([{"start": s, "length": n, "crc": zlib.crc32(ids[s : s + n].tobytes())} for s, n in cut(len(ids), size)])
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64())]))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(rid, rid + len(out))), part.column(0), pa.array(out, kind)], ["rid", "doc_id", "pieces"])
                rid += len(out)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), f"rid long, doc_id long, pieces {PIECES}")


def best_fit(counts: dict[int, int], size: int) -> Counter:
    """Patterns (descending lengths) and their numbers. Each step uses up a length or nearly so."""
    left = np.zeros(size + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    bins: Counter = Counter()
    top = size
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return bins
        pattern, room = [top], size - top
        left[top] -= 1
        while room:
            fits = np.flatnonzero(left[: room + 1])
            if not len(fits):
                break
            if left[room]:
                pick = [room]
            else:
                # two that fill the room exactly, the more unequal the better; else the largest that fits
                pair = fits[left[room - fits] > 0]
                pair = pair[(2 * pair != room) | (left[pair] > 1)]
                pick = [int(pair[-1]), room - int(pair[-1])] if len(pair) else [int(fits[-1])]
            for n in pick:
                left[n] -= 1
                room -= n
            pattern += pick
        uses = Counter(pattern)
        more = min(int(left[n]) // u for n, u in uses.items())
        for n, u in uses.items():
            left[n] -= u * more
        bins[tuple(sorted(pattern, reverse=True))] += 1 + more


def pairs(bin_: tuple) -> list[tuple[int, int]]:
    """Different pairs of lengths. A bin of `size` tokens has under sqrt(2 * size) different lengths, so they are some `size` at most."""
    times = Counter(bin_)
    ones = sorted(times)
    return sorted([(x, y) for i, x in enumerate(ones) for y in ones[i + 1 :]] + [(x, x) for x in ones if times[x] > 1], key=sum)


def steps(a: tuple, b: tuple, size: int) -> tuple[int, tuple, tuple] | None:
    """The step between bins a and b (a no emptier than b) that raises squared fill most: gain, new a, new b."""
    fa, fb, best = sum(a), sum(b), None
    room = size - fa
    # what leaves a and what comes from b: a piece, one for one, two for one, one for two
    ones_a, ones_b = sorted(set(a)), sorted(set(b))
    two_a, two_b = pairs(a), pairs(b)
    for outs, ins in (([()], [(y,) for y in ones_b]), ([(x,) for x in ones_a], [(y,) for y in ones_b]), ([(x,) for x in ones_a], two_b), (two_a, [(y,) for y in ones_b])):
        for o in outs:
            for i in ins:
                more = sum(i) - sum(o)
                if 0 < more <= room and (best is None or more > best[0]):
                    best = (more, o, i)
    if best is None:
        return None
    more, o, i = best
    new_a, new_b = Counter(a) - Counter(o) + Counter(i), Counter(b) - Counter(i) + Counter(o)
    return 2 * more * (fa - fb) + 2 * more * more, tuple(sorted(new_a.elements(), reverse=True)), tuple(sorted(new_b.elements(), reverse=True))


def improved(bins: Counter, size: int, limit: int) -> Counter:
    """Local search over underfull bins, emptiest first, until none can give or the least number is reached."""
    bins = Counter(bins)
    total = sum(sum(p) * m for p, m in bins.items())
    least, stuck, used = -(-total // size), set(), 0
    while used < limit and sum(bins.values()) > least:
        under = sorted((p for p in bins if sum(p) < size), key=lambda p: (sum(p), p))
        donor = next((p for p in under if p not in stuck), None)
        if donor is None:
            break
        best = None
        for p in under:
            if (p != donor or bins[p] > 1) and sum(p) >= sum(donor) and (found := steps(p, donor, size)) and (best is None or found[0] > best[0]):
                best = (*found, p)
        if best is None:
            stuck.add(donor)
            continue
        _, new_a, new_b, a = best
        m = bins[a] // 2 if a == donor else min(bins[a], bins[donor])
        bins.subtract({a: m})
        bins.subtract({donor: m})
        bins[new_a] += m
        if new_b:
            bins[new_b] += m
        bins = +bins
        stuck &= set(bins)
        used += 1
    return bins


def places(bins: Counter) -> list[tuple[int, int, int, int, int]]:
    """(length, first number, last number, sequence of the first, offset): where pieces go by their number within the length."""
    out, seq, numbered = [], 0, Counter()
    for pattern, m in sorted(bins.items()):
        at = 0
        for n in pattern:
            out.append((n, numbered[n], numbered[n] + m - 1, seq, at))
            numbered[n] += m
            at += n
        seq += m
    return out


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, size: int = SIZE, end: int = END, limit: int = STEPS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    held = park(tokenized(docs, id_col, text_col, path or default_path(), size, end), "tokenized")
    pieces = held.select("rid", "doc_id", F.posexplode("pieces").alias("piece", "x")).select("rid", "doc_id", "piece", "x.*")
    # at most `size` rows, whatever the input
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    bins = improved(best_fit(counts, size), size, limit)
    table_ = sorted(places(bins))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a row for each length of each pattern, whatever the input; numbers of a length are gapless, so the row before or at (length, k) is the one
        length, lo, _, seq, offset = (np.array(c, np.int64) for c in zip(*table_)) if table_ else (np.zeros(0, np.int64),) * 5
        starts = np.searchsorted(length, np.arange(size + 2))
        for batch in batches:
            n, k = batch.column("length").to_numpy(), batch.column("k").to_numpy()
            at = np.zeros(len(n), np.int64)
            for one in np.unique(n).tolist():
                own = n == one
                at[own] = starts[one] + np.searchsorted(lo[starts[one] : starts[one + 1]], k[own], side="right") - 1
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(seq[at] + k - lo[at]), pa.array(offset[at])], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    x = numbered(pieces, "length", ["rid", "piece"], "k", GROUP)
    x = x.select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", F.col("crc").alias("ids_crc32"), "k")
    return x.mapInArrow(tidy(placed), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
