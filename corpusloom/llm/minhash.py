"""MinHash near-duplicate detection with sequential Bayesian verification.

Documents become sets of five-word shingles. Equal word sequences are one set from the start.
Bands of MinHash values give candidates; a candidate's signature is compared batch by batch, and it
is dropped as soon as the posterior probability that its similarity reaches the threshold falls
under the chosen miss probability. Survivors are confirmed on their full sets, in whole numbers.

Candidates never become all pairs of a bucket. First each bucket's smallest member is compared with
the others (as many pairs as members). Buckets whose members are then still in different components
are compared once more, inside tasks, with their full sets at hand; only confirmed links that join two
components leave the task, so the links stay fewer than the members. Where such a bucket is large, its
members meet by prefixes instead: two sets that are similar enough share one of the rarest few of their
shingles (those that are left when the least overlap, less one, is taken off). So a member goes to as many
groups as its prefix has shingles, however large the bucket is, and groups within one component are left
out. Only a group that is still large meets in blocks.

Null or blank texts have no shingle and no link. Repeated rows, ties and extra columns are allowed;
equal texts are linked. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import by_value, likely, park, parts, table, tidy
from .components import components
from .words import buffers, hashes, mixed, words

by_value(__name__)

SHINGLE, THRESHOLD = 5, (80, 100)
BANDS, ROWS = 24, 4
MISS, BATCH = 1e-5, 16
#: Members of a bucket, and their shingles, that meet in one task; those of larger ones meet by prefixes, and larger groups of these block by block.
BLOCK, WEIGHT = 2048, 1 << 20

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def shingled(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text: values, offsets (n + 1), and a 128-bit digest of each word sequence (n x 2)."""
    data, offsets = buffers(column)
    n = len(offsets) - 1
    low = np.concatenate([LOWER[data], np.zeros(8, np.uint8)])
    start, length, doc = words(low[: len(data)], offsets, IS_WORD)
    h = hashes(low, start, length)
    count = np.bincount(doc, minlength=n)
    ends = np.cumsum(count)
    place = np.arange(len(h)) - (ends - count)[doc]
    digest = np.zeros((n, 2), np.uint64)
    some = count > 0
    if some.any():
        firsts = (ends - count)[some]
        for k, salt in enumerate((0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)):
            digest[some, k] = np.add.reduceat(mixed(h ^ mixed(place.astype(np.uint64) + np.uint64(salt))), firsts)
    # a shingle starts at a word with size - 1 more after it, or at the first word of a shorter text
    opens = (place + size <= count[doc]) | (place == 0)
    at, have = np.flatnonzero(opens), np.minimum(count[doc], size)[opens]
    s = np.full(len(at), 0x51ED270B, np.uint64)
    padded = np.concatenate([h, np.zeros(size, np.uint64)])
    for k in range(size):
        s = np.where(k < have, mixed((s ^ padded[at + k]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1)), s)
    of = doc[opens]
    if len(s):
        order = np.lexsort((s, of))
        s, of = s[order], of[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (of[1:] != of[:-1])
        s, of = s[new], of[new]
    return s, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]), digest


def signatures(values: np.ndarray, offsets: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """bands * rows MinHash values (32 bits) of each set; sets without members stay zero."""
    k, n = bands * rows, len(offsets) - 1
    out = np.zeros((n, k), np.uint32)
    some = np.diff(offsets) > 0
    if not some.any():
        return out
    r = np.random.default_rng(20240229)
    a = (r.integers(1, 1 << 62, k, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
    firsts = offsets[:-1][some]
    for i in range(k):
        out[some, i] = np.minimum.reduceat(((values ^ (values >> np.uint64(29))) * a[i]) >> np.uint64(32), firsts).astype(np.uint32)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature; the band is part of the key."""
    out = np.zeros((len(sig), bands), np.uint64)
    for b in range(bands):
        x = np.full(len(sig), b + 1, np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        for c in range(b * rows, (b + 1) * rows):
            x = mixed((x ^ sig[:, c].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15))
        out[:, b] = x
    return out


def least_matches(k: int, batch: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """For each number m of compared values, the fewest matches with which a pair stays.

    With a flat prior the posterior of the similarity after x matches of m is Beta(x + 1, m - x + 1);
    P(similarity >= t) = P(Binomial(m + 1, t) <= x). A pair goes when that is under miss.
    """
    out = []
    for m in range(batch, k + 1, batch):
        total, x = 0.0, -1
        for i in range(m + 2):
            total += math.comb(m + 1, i) * threshold**i * (1 - threshold) ** (m + 1 - i)
            if total >= miss:
                x = i
                break
        out.append((m, x))
    return out


def survivors(a: np.ndarray, b: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Rows of the paired signatures a, b that pass every bound; each batch looks at those left only."""
    live, hits, done = np.arange(len(a)), np.zeros(len(a), np.int32), 0
    for m, least in bounds:
        hits[live] += (a[live, done:m] == b[live, done:m]).sum(1, dtype=np.int32)
        live, done = live[hits[live] >= least], m
    return live


def matrix(column: pa.Array, k: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, k)


def sketch(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """Per document: id, digest of its words, n_shingles, signature, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                values, offsets, digest = shingled(part.column(1), size)
                sig = signatures(values, offsets, bands, rows)
                keys = band_keys(sig, bands, rows).view(np.int64)
                n = np.diff(offsets)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x.tobytes() for x in digest], pa.binary()), pa.array(n, pa.int64()), pa.array([x.tobytes() for x in sig], pa.binary()), pa.array(list(keys), pa.list_(pa.int64()))],
                    ["doc_id", "digest", "n_shingles", "sig", "bands"],
                )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(tidy(run), "doc_id long, digest binary, n_shingles long, sig binary, bands array<long>")


def pruned(pairs: DataFrame, k: int, bounds: list[tuple[int, int]]) -> DataFrame:
    """Of (a, b, sig_a, sig_b), the (a, b) that the posterior keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if x.num_rows:
                keep = survivors(matrix(x.column("sig_a"), k), matrix(x.column("sig_b"), k), bounds)
                yield x.select(["a", "b"]).take(pa.array(keep))

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(tidy(run), "a long, b long")


def shingle_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """doc_id, shingles (sorted, 8 bytes each) of the documents in ids. docs: doc_id, text."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                values, offsets, _ = shingled(part.column(1), size)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([values[i:j].tobytes() for i, j in zip(offsets, offsets[1:])], pa.binary())], ["doc_id", "shingles"])

    found = likely(docs.select("doc_id", "text"), ids, "doc_id").join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return park(found.mapInArrow(tidy(sets), "doc_id long, shingles binary"), "shingles")


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """The (a, b) of pairs whose full shingle sets have den * |a and b| >= num * |a or b|. docs: doc_id, text."""
    held = shingle_sets(docs, pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), size)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            keep = []
            for i, (p, q) in enumerate(zip(x.column("shingles_a"), x.column("shingles_b"))):
                mine, other = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                if den * min(len(mine), len(other)) < num * max(len(mine), len(other)):
                    continue
                both = len(np.intersect1d(mine, other, assume_unique=True))
                if both and den * both >= num * (len(mine) + len(other) - both):
                    keep.append(i)
            if keep:
                yield x.select(["a", "b"]).take(pa.array(keep))

    x = pairs.join(held.select(F.col("doc_id").alias("a"), F.col("shingles").alias("shingles_a")), "a").join(held.select(F.col("doc_id").alias("b"), F.col("shingles").alias("shingles_b")), "b")
    return x.select("a", "b", "shingles_a", "shingles_b").mapInArrow(tidy(check), "a long, b long")


def joining_pairs(ids: np.ndarray, part: np.ndarray, own: np.ndarray, sig: np.ndarray, sets: list[np.ndarray], band: int, pivot: int | None, two: bool, keys: np.ndarray, bounds: list[tuple[int, int]], num: int, den: int) -> list[tuple[int, int]]:
    """Confirmed links that join two components among one task's members; at most one fewer than members.

    Looked at are pairs of members whose components differ at that moment, who share no earlier
    band, of which neither is the pivot (its pairs are known), and that the posterior keeps.
    """
    _, index = np.unique(np.concatenate(sets), return_inverse=True)
    size = np.array([len(x) for x in sets])
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    flags, part, links = np.zeros(len(index), np.int32), part.copy(), []
    for i in range(len(ids)):
        j = np.arange(i + 1, len(ids))
        j = j[(part[j] != part[i]) & ((pivot is None) | (ids[j] != pivot) & (ids[i] != pivot)) & (den * np.minimum(size[j], size[i]) >= num * np.maximum(size[j], size[i]))]
        j = j[own[j] != own[i]] if two else j
        j = j[~(keys[j, :band] == keys[i, :band]).any(1)] if len(j) and band else j
        j = j[survivors(np.broadcast_to(sig[i], (len(j), sig.shape[1])), sig[j], bounds)] if len(j) else j
        if not len(j):
            continue
        mine = index[first[i] : first[i] + size[i]]
        flags[mine] = 1
        at = np.repeat(first[j] - np.concatenate([[0], np.cumsum(size[j])[:-1]]), size[j]) + np.arange(size[j].sum())
        both = np.add.reduceat(flags[index[at]], np.concatenate([[0], np.cumsum(size[j])[:-1]]))
        flags[mine] = 0
        for x in j[den * both >= num * (size[i] + size[j] - both)].tolist():
            if part[x] != part[i]:
                links.append((int(ids[i]), int(ids[x])))
                part[part == part[x]] = part[i]
    return links


def blocks_of(block: int, weight: int) -> Column:
    """Of n, w: how many blocks a bucket is cut into."""
    return F.greatest(F.lit(1), F.ceil(F.col("n") / block), F.ceil(F.col("w") / weight)).cast("int")


def by_prefix(sets: DataFrame, num: int, den: int) -> DataFrame:
    """key (a shingle), n, w, pivot (null), doc_id, part: groups in which every two sets meet that are similar enough and in different components.

    sets: doc_id, part, shingles. Of |a| shingles, a similar set has ceil(t |a|) at least; so two similar sets share one
    of the first |a| - ceil(t |a|) + 1 and |b| - ceil(t |b|) + 1 in any common order. Here the rarest come first.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                own = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column("shingles")]
                size = np.array([len(x) for x in own])
                row = np.repeat(np.arange(len(own)), size)
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(pa.array(row)) for c in ("doc_id", "part")), pa.array(size[row]), pa.array(np.concatenate(own))], ["doc_id", "part", "size", "key"])

    x = sets.select("doc_id", "part", "shingles").mapInArrow(tidy(each), "doc_id long, part long, size long, key long")
    times = x.groupBy("key").agg(F.count("*").alias("times"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("times", "key"))
    x = x.join(times, "key").withColumn("rank", rank).where(F.col("rank") <= F.col("size") - F.ceil(F.col("size") * num / den) + 1)
    x = park(x.select("key", "doc_id", "part", "size"), "prefixes")
    groups = x.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("w"), F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").drop("lo", "hi")
    return x.drop("size").join(groups, "key").withColumn("pivot", F.lit(None).cast("long"))


def mixed_buckets(members: DataFrame, k: int, rows: int, bounds: list[tuple[int, int]], block: int, weight: int, num: int, den: int) -> DataFrame:
    """Confirmed links between different components that share a bucket.

    members: key (a band's, or without pivot a shingle), n (members of the bucket), w (their shingles), pivot, doc_id,
    part (component), sig, shingles. A bucket of more than block members or weight shingles is cut, and each two of
    its blocks meet in a task of their own.
    """
    own = F.when(F.col("cut") == 1, 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("cut")).cast("int"))
    x = members.withColumn("cut", blocks_of(block, weight)).withColumn("own", own)
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    x = x.select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "pivot", "doc_id", "part", "sig", "shingles")
    bands = k // rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups():  # rows come sorted by (key, p, q)
            group, held = None, []
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in ("key", "p", "q", "own", "pivot", "doc_id", "part", "sig", "shingles"))):
                    if row[:3] != group:
                        if len(held) > 1:
                            yield held
                        group, held = row[:3], []
                    held.append(row)
            if len(held) > 1:
                yield held

        for g in groups():
            key, p, q, _, pivot = g[0][:5]
            own, ids, part = (np.array([r[c] for r in g]) for c in (3, 5, 6))
            if part.min() == part.max():
                continue
            sig = np.frombuffer(b"".join(r[7] for r in g), np.uint32).reshape(len(g), k)
            keys = band_keys(sig, bands, rows)
            band = 0 if pivot is None else int(np.flatnonzero(keys[0] == np.uint64(key & 0xFFFFFFFFFFFFFFFF))[0])
            links = joining_pairs(ids, part, own, sig, [np.frombuffer(r[8], np.uint64) for r in g], band, pivot, p != q, keys, bounds, num, den)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["a", "b"])

    n = parts(members.sparkSession)
    return x.repartition(n, "key", "p", "q").sortWithinPartitions("key", "p", "q").mapInArrow(tidy(run), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD, bands: int = BANDS, rows: int = ROWS, miss: float = MISS, batch: int = BATCH, block: int = BLOCK, weight: int = WEIGHT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable over links), kept (doc_id = component_id).

    A link: den * |a and b| >= num * |a or b| of two shingle sets, threshold = (num, den). With 24
    bands of 4, a pair of similarity 0.8 is no candidate with probability 3e-6, one of 0.85 with 2e-8.
    """
    num, den = threshold
    k = bands * rows
    bounds = least_matches(k, batch, num / den, miss)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    full = park(sketch(texts, "doc_id", "text", size, bands, rows), "sketch")
    equal = full.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    equal = park(equal, "equal")
    firsts = full.join(equal.select(F.col("first").alias("doc_id")).distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    firsts = park(firsts.select("doc_id", "n_shingles", "sig", "bands"), "firsts")
    member = firsts.select("doc_id", "n_shingles", F.explode("bands").alias("key"))
    buckets = member.groupBy("key").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"), F.min("doc_id").alias("pivot")).where("n > 1")
    member = park(member.join(buckets, "key"), "buckets")
    sig = firsts.select("doc_id", "sig")

    star = member.where("doc_id <> pivot").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct()
    star = star.join(sig.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a")), "a").join(sig.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b")), "b")
    links = park(confirmed(park(pruned(star, k, bounds), "star"), texts, size, num, den), "links")
    first = components(links)

    # buckets that still hold two components: the other pairs in them
    label = member.join(first.select("doc_id", "component_id"), "doc_id", "left").withColumn("part", F.coalesce("component_id", "doc_id")).drop("component_id")
    label = park(label, "labels")
    split = label.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi")
    rest = park(label.where("n > 2").join(split.select("key"), "key", "left_semi"), "mixed")
    sets = shingle_sets(texts, rest.select("doc_id").distinct(), size)
    large = blocks_of(block, weight) > 1
    own = park(rest.where(large).select("doc_id", "part").distinct().join(sets, "doc_id"), "large")
    rest = rest.select("key", "n", "w", "pivot", "doc_id", "part")
    rest = rest.where(~large).unionByName(by_prefix(own, num, den)) if not own.isEmpty() else rest
    rest = rest.join(sig.join(sets, "doc_id"), "doc_id")
    more = mixed_buckets(rest, k, rows, bounds, block, weight, num, den)
    last = components(park(links.union(more), "all_links"))

    # copies: every document takes its first's component; that is the smallest id, as firsts are
    by_digest = equal.select("digest", "first").join(last.select(F.col("doc_id").alias("first"), "component_id"), "first", "left")
    by_digest = by_digest.select("digest", F.coalesce("component_id", "first").alias("component_id"))
    out = full.select("doc_id", "digest", "n_shingles").join(by_digest, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), threshold=(85, 100))
