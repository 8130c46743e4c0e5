"""Resharding that moves the fewest bytes, by minimum-cost flow.

Old shards are cut into FINE blocks of rows each, by a hash of their id. From the old shards' sizes and the new capacities, a flow
network (old shard -> new shard, at no cost where both are the same and a unit a byte where not) gives
how many bytes go from where to where. Blocks fill the transfers, larger ones first; a block that fits
none as a whole is cut once more by a second hash, so transfers are met to the size of a few rows.
Only files of shards that give or take are rewritten.

The driver holds sizes of shards and blocks (at most FINE rows for each old shard, and FINE for each block that is cut), never rows. A null text
has no bytes; size is its bytes plus 1. Null ids are rows of their own, with equal hashes; repeated
ids too. Extra columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import numbered, park, shared_dir, table

SHARDS, FINE = 16, 256
#: Rows of one shard that are numbered together, by hash.
SLOT_GROUP = 20000


def capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def min_cost_flow(supply: list[int], demand: list[int], cost) -> dict[tuple[int, int], int]:
    """Flows from old to new shards: all supply leaves, all demand is met (equal totals), at the least cost.

    Successive shortest paths with potentials. cost(i, j) >= 0 is the price of one unit.
    """
    n, m = len(supply), len(demand)
    s, t = n + m, n + m + 1
    graph: list[list[list]] = [[] for _ in range(n + m + 2)]

    def edge(a, b, cap, price):
        graph[a].append([b, cap, price, len(graph[b])])
        graph[b].append([a, 0, -price, len(graph[a]) - 1])

    for i, x in enumerate(supply):
        edge(s, i, x, 0)
    for j, x in enumerate(demand):
        edge(n + j, t, x, 0)
    for i in range(n):
        for j in range(m):
            edge(i, n + j, min(supply[i], demand[j]), cost(i, j))
    potential = [0] * len(graph)
    left = sum(supply)
    while left:
        far, via = [float("inf")] * len(graph), [None] * len(graph)
        far[s], heap = 0, [(0, s)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for e in graph[a]:
                if e[1] and (x := d + e[2] + potential[a] - potential[e[0]]) < far[e[0]]:
                    far[e[0]], via[e[0]] = x, (a, e)
                    heapq.heappush(heap, (x, e[0]))
        potential = [p + (f if f < float("inf") else 0) for p, f in zip(potential, far)]
        push, at = left, t
        while at != s:
            a, e = via[at]
            push, at = min(push, e[1]), a
        at = t
        while at != s:
            a, e = via[at]
            e[1] -= push
            graph[at][e[3]][1] += push
            at = a
        left -= push
    return {(i, e[0] - n): graph[e[0]][e[3]][1] for i in range(n) for e in graph[i] if n <= e[0] < n + m and graph[e[0]][e[3]][1]}


def assign(blocks: dict[int, list[tuple[tuple, int]]], flow: dict[tuple[int, int], int], split: bool) -> tuple[list[tuple[int, tuple, int | None]], dict[tuple[int, int], int]]:
    """(old shard, block, new shard) along the flow, and what is left of the flow.

    Larger blocks go first, each to where most is still to be moved; so the small ones even out. With
    split, a block that fits nowhere as a whole gets None, and is to be cut.
    """
    out, left, carried = [], dict(flow), {}
    for old, own in sorted(blocks.items()):
        goals = sorted(j for i, j in flow if i == old) or [old]
        if not split:  # what earlier old shards left unmet, or gave too much
            for j in goals:
                left[old, j] = left.get((old, j), 0) + carried.pop(j, 0)
        for key, size in sorted(own, key=lambda b: (-b[1], b[0])):
            best = max(goals, key=lambda j: (left.get((old, j), 0), j == old))
            if split and size > left.get((old, best), 0):
                out.append((old, key, None))
                continue
            out.append((old, key, best))
            left[old, best] = left.get((old, best), 0) - size
        if not split:
            for j in goals:
                carried[j] = carried.get(j, 0) + left.get((old, j), 0)
    return out, left


def plan(sized: DataFrame, old: str, id_col: str, size_col: str, shards: int, fine: int = FINE) -> DataFrame:
    """sized with `shard`: near equal sums of size_col in each, moving the fewest bytes from `old` (0 .. shards - 1, else a shard that ends)."""
    spark = sized.sparkSession
    b1, b2 = F.pmod(F.xxhash64(id_col), F.lit(fine)).cast("int"), F.pmod(F.xxhash64(F.lit(1), id_col), F.lit(fine)).cast("int")
    x = sized.withColumn("b1", b1).withColumn("b2", b2)
    first = x.groupBy(old, "b1").agg(F.sum(size_col).alias("n")).collect()
    olds = sorted({r[old] for r in first} | set(range(shards)))
    blocks = {o: sorted(((r["b1"],), r["n"]) for r in first if r[old] == o) for o in olds}
    supply = [sum(n for _, n in blocks[o]) for o in olds]
    flow = {(olds[i], j): v for (i, j), v in min_cost_flow(supply, capacities(sum(supply), shards), lambda i, j: int(olds[i] != j)).items()}
    whole, left = assign(blocks, flow, True)
    cut = [(o, key[0]) for o, key, new in whole if new is None]
    cut_df = spark.createDataFrame(cut, f"{old} int, b1 int")
    second = x.join(F.broadcast(cut_df), [old, "b1"]).groupBy(old, "b1", "b2").agg(F.sum(size_col).alias("n")).collect() if cut else []
    finer: dict[int, list] = {}
    for r in second:
        finer.setdefault(r[old], []).append(((r["b1"], r["b2"]), r["n"]))
    rest, _ = assign(finer, left, False)
    coarse = spark.createDataFrame([(o, key[0], new) for o, key, new in whole if new is not None], f"{old} int, b1 int, coarse int")
    small = spark.createDataFrame([(o, *key, new) for o, key, new in rest], f"{old} int, b1 int, b2 int, small int")
    # at most (old shards) * fine rows, and fine rows for each border of the flow
    x = x.join(F.broadcast(coarse), [old, "b1"], "left").join(F.broadcast(small), [old, "b1", "b2"], "left")
    return x.withColumn("shard", F.coalesce("coarse", "small")).drop("b1", "b2", "coarse", "small")


def rewrite(rows: DataFrame, old: str, source: str, target: str) -> list[int]:
    """Writes the rows of shards that give or take, as target/shard=N; returns the shards whose files stay as they are in source."""
    moved = rows.where(F.col(old) != F.col("shard"))
    touched = sorted({x for r in moved.select(old, "shard").distinct().collect() for x in r})
    rows.where(F.col("shard").isin(touched)).write.partitionBy("shard").mode("overwrite").parquet(target)
    return [r["shard"] for r in rows.select("shard").distinct().collect() if r["shard"] not in touched]


def op7_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old layout: one shard for each source, by hash of its name; so a hot source is a hot shard.

    Whole documents of shards that give or take are rewritten into the shared folder; size and text_crc32 are
    taken from the new files there, and from the old rows only where a shard stays as it is.
    """
    docs = table(spark, sf_dir, "documents")
    old = F.pmod(F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")), F.lit(SHARDS)).cast("int")
    size = F.coalesce(F.octet_length("text").cast("long"), F.lit(0)) + 1
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    columns = [c for c in docs.columns if c.lower() not in ("size", "shard", "old_shard", "b1", "b2", "coarse", "small")]
    whole = plan(docs.select(*columns, size.alias("size"), old.alias("old_shard")), "old_shard", "doc_id", "size", SHARDS).select(*columns, "old_shard", "shard")
    target = f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    same = rewrite(whole, "old_shard", sf_dir, target)
    written = spark.read.schema(whole.schema).parquet(target)
    files = written.unionByName(whole.where(F.col("shard").isin(same))) if same else written
    rows = park(files.select("doc_id", size.alias("size"), crc.alias("text_crc32"), "old_shard", "shard", F.monotonically_increasing_id().alias("rid")), "sizes")
    placed = numbered(rows, "shard", ["doc_id", "text_crc32", "size", "rid"], "slot", SLOT_GROUP)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")
