"""Exact removal of long repeated strings by suffix arrays.

A rule says what a string is made of, bytes or words (runs without ASCII white space), and how many.
Such a string is repeated if it also starts anywhere else, in the same document or another one; strings
never cross documents. Covered units go: of every copy, or, with keep="first", of all but the first
copy, in the order of ids (null ids last), rows of one id, and places.

1. Every window of `length` units has an anchor, the smallest hash among its strings of `gram` units
   (the rightmost of equals). The anchor depends on the window's units only, so equal windows have
   equal anchors. Windows whose anchor occurs once in the corpus cannot repeat; the others are cut
   out as segments, one for each run of windows with the same anchor. Words go as 64-bit hashes.
2. Segments are dealt to shards by anchor; the segments of a frequent anchor are spread over several
   shards. Equal segments are sorted once and carry their number. A shard builds a suffix array by
   Larsson-Sadakane refinement (prefix doubling that touches unsettled groups only), and Kasai's
   rule gives the common prefixes of neighbours: a window repeats in its shard if a neighbour shares
   `length` units with it.
3. Shards of a split anchor are merged: each ships its distinct windows as sorted runs of 128-bit
   digests, cut into ranges, and every range finds by binary search the windows of more than one run.

Equal documents are handled once. A null text is empty; texts are whole, however long. Ids may be null
or repeated, as rows get a key of their own; so of two equal rows the first copy stays with keep="first".
Extra columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import by_value, park, parts, sweep, table, tidy, unpark, without
from .words import SPACE_ENDS, buffers, hashes, loads, mixed, words

by_value(__name__)


class Rule(NamedTuple):
    """Strings of `length` units ("bytes" or "words") that count as repeated; `gram` units make an anchor."""

    unit: str
    length: int
    gram: int


BYTES, PASSAGES = Rule("bytes", 400, 64), Rule("words", 50, 16)
#: Bytes that are worked on at once; windows of larger documents are taken in overlapping pieces.
CHUNK = 1 << 21
#: Segments of one anchor that go to one shard; more are spread over more shards.
SPLIT = 2000
#: Segments that a task remembers, not to ship their units again.
SEEN = 1 << 16
LAST = (1 << 63) - 1

SPANS = "array<struct<start: long, end: long>>"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for each i, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def units(data: np.ndarray, offsets: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """Of the joined bytes of texts: units (bytes, or 64-bit hashes of words), and offsets in units."""
    if unit == "bytes":
        return data, offsets
    start, length, doc = words(data, offsets, SPACE_ENDS)
    codes = hashes(np.concatenate([data, np.zeros(8, np.uint8)]), start, length)
    return codes, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(offsets) - 1))])


def keys(data: np.ndarray, spare: int = 0) -> tuple[np.ndarray, int]:
    """A 64-bit word for each place, with `spare` more places, and the number of units that it holds."""
    if data.dtype == np.uint8:
        return loads(np.concatenate([data, np.zeros(spare + 8, np.uint8)])), 8
    return np.concatenate([data, np.zeros(spare + 1, np.uint64)]), 1


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: document, first start, last start (in the document), anchor hash. Under 2**24 units."""
    none = np.zeros(0, np.int64)
    n = len(data)
    if n < length:
        return none, none, none, none.astype(np.uint64)
    at, step = keys(data, gram)
    h = np.full(n, 0xA0761D6478BD642F, np.uint64)
    for k in range(0, gram, step):
        h = (h ^ at[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    h = mixed(h)
    where = np.uint64(0xFFFFFF) - np.arange(n, dtype=np.uint64)
    least = sliding_min(((h >> np.uint64(24)) << np.uint64(24)) | where, length - gram + 1)[: n - length + 1]
    pos = (np.uint64(0xFFFFFF) - (least & np.uint64(0xFFFFFF))).astype(np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(pos)]
    valid = np.arange(len(pos)) + length <= offsets[1:][doc]
    first = valid.copy()
    first[1:] &= (pos[1:] != pos[:-1]) | ~valid[:-1] | (doc[1:] != doc[:-1])
    last = valid.copy()
    last[:-1] &= first[1:] | ~valid[1:]
    s, e = np.flatnonzero(first), np.flatnonzero(last)
    return doc[s], s - offsets[:-1][doc[s]], e - offsets[:-1][doc[s]], h[pos[s]]


def pieces(data: np.ndarray, offsets: np.ndarray, length: int, chunk: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(document, start in it, units, offsets) of groups of at most about chunk units; long documents come in overlapping pieces."""
    doc, begin, end = [], [], []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        while True:
            doc.append(i)
            begin.append(a)
            if b - a <= chunk + length:
                end.append(b)
                break
            end.append(a + chunk + length - 1)
            a += chunk
    doc, begin, end = np.array(doc), np.array(begin), np.array(end)
    group = (np.cumsum(end - begin) - 1) // chunk if len(doc) else doc
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(doc)]
    for i, j in zip(cuts, cuts[1:]):
        if i < j:
            size = end[i:j] - begin[i:j]
            joined = data[begin[i] : end[j - 1]] if j - i == 1 or (begin[i + 1 : j] == end[i : j - 1]).all() else np.concatenate([data[a:b] for a, b in zip(begin[i:j], end[i:j])])
            yield doc[i:j], begin[i:j] - offsets[doc[i:j]], joined, np.concatenate([[0], np.cumsum(size)])


def suffix_order(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Window starts of the concatenated segments in the order of their first `length` units (words: of their hashes), and their ranks.

    Larsson-Sadakane: a rank is the place of the first member of a group; groups of one are settled.
    Positions closer to their segment's end than the current depth take no further part.
    """
    n = len(data)
    room = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)
    word, step = keys(data)
    live = np.flatnonzero(room >= step)
    word = word[live].byteswap() if step == 8 else word[live]
    order = np.argsort(word)
    place = live[order]
    same = np.zeros(len(place), bool)
    same[1:] = word[order][1:] == word[order][:-1]
    rank = np.zeros(n + 1, np.int64)
    rank[place] = np.maximum.accumulate(np.where(same, 0, np.arange(len(place))))
    loose = same.copy()
    loose[:-1] |= same[1:]
    live, depth = np.sort(place[loose]), step
    bits = max(1, int(n).bit_length())
    while depth < length and len(live):
        more = min(depth, length - depth)
        live = live[room[live] >= depth + more]
        a, b = rank[live], rank[live + more]
        if 3 * bits <= 63:
            key = np.sort((a << (2 * bits)) | (b << bits) | live)
            place, pair = key & ((1 << bits) - 1), key >> bits
        else:
            order = np.lexsort((b, a))
            place = live[order]
            pair = (a[order] << bits) | b[order]
        head = pair >> bits
        same = np.zeros(len(place), bool)
        same[1:] = pair[1:] == pair[:-1]
        new_group = np.ones(len(place), bool)
        new_group[1:] = head[1:] != head[:-1]
        index = np.arange(len(place))
        opened = np.maximum.accumulate(np.where(new_group, index, 0))
        starts = np.maximum.accumulate(np.where(same, 0, index))
        rank[place] = head + starts - opened
        loose = same.copy()
        loose[:-1] |= same[1:]
        live, depth = np.sort(place[loose]), depth + more
    at = np.flatnonzero(room >= length)
    return at[np.argsort(rank[at], kind="stable")], rank


def common_prefixes(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place in order, the common prefix with the place before it, `length` at most (Kasai).

    In text order, where the predecessor moves on by one as the position does, the prefix is one
    unit shorter than the one before; the others are compared, 8 bytes or one word at a time.
    """
    if not len(order):
        return np.zeros(0, np.int64)
    size = len(data)
    before = np.full(size, -2, np.int64)
    before[order[1:]] = order[:-1]
    here = np.sort(order)
    p = before[here]
    # a capped prefix says nothing of the next one, so a run carries its uncapped prefix
    follows = np.zeros(len(here), bool)
    follows[1:] = (here[1:] == here[:-1] + 1) & (p[1:] == p[:-1] + 1) & (p[:-1] >= 0)
    begin = np.flatnonzero(~follows)
    run = np.diff(np.append(begin, len(here)))
    word, step = keys(data)
    value, live = np.zeros(len(begin), np.int64), np.flatnonzero(p[begin] >= 0)
    most = run + length - 1
    while len(live):
        i, j = here[begin[live]] + value[live], p[begin[live]] + value[live]
        inside = (i < size) & (j < size)
        live, i, j = live[inside], i[inside], j[inside]
        differ = word[i] ^ word[j]
        zero = differ == 0
        low = differ & (~differ + np.uint64(1))
        value[live] += np.where(zero, step, (np.log2(np.where(zero, 1, low).astype(np.float64)).astype(np.int64)) // 8 if step == 8 else 0)
        live = live[zero & (value[live] < most[live])]
    lcp = np.repeat(value, run) - (np.arange(len(here)) - np.repeat(begin, run))
    out = np.zeros(size, np.int64)
    out[here] = np.clip(lcp, 0, length)
    return out[order]


def repeated_windows(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts in order, which of them share `length` units with a neighbour, and which open a class of equals."""
    order, _ = suffix_order(data, ends, length)
    lcp = common_prefixes(data, order, length)
    same = lcp >= length
    twice = same.copy()
    twice[:-1] |= same[1:]
    return order, twice, ~same


def window_digests(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """128-bit digests (n x 2) of data[s : s + length]."""
    out = np.zeros((len(starts), 2), np.uint64)
    word, step = keys(data)
    for k, seed in enumerate((0x8BB84B93962EACC9, 0x4B33A62ED433D4A3)):
        h = np.full(len(starts), seed, np.uint64)
        for at in range(0, length, step):
            x = word[starts + at]
            if length - at < step:
                x = x & (np.uint64(0xFFFFFFFFFFFFFFFF) >> np.uint64(8 * (8 - (length - at))))
            h = (h ^ x) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        out[:, k] = mixed(h)
    return out


def intervals(flags: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true flags as (first, last)."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()))


def ingest(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """rid (own row key), doc_id, sha, n_bytes, packed text, what is carried, and for rule i: size<i> (units), runs<i> of windows by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z, rid = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                data, offsets = buffers(part.column(1))
                n, more = len(offsets) - 1, []
                for unit, length, gram in rules:
                    own, places = units(data, offsets, unit)
                    found = []
                    for doc, begin, joined, cuts in pieces(own, places, length, CHUNK):
                        d, s, e, h = anchors(joined, cuts, length, gram)
                        found.append((doc[d], s + begin[d], e + begin[d], h))
                    d, s, e, h = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4
                    ends = np.concatenate([[0], np.cumsum(np.bincount(d.astype(np.int64), minlength=n))])
                    more += [pa.array(np.diff(places), pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(h.astype(np.uint64).view(np.int64)), pa.array(s, pa.int64()), pa.array(e, pa.int64())], ["h", "s", "e"]))]
                texts = [data[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(rid, rid + n)), part.column(0), pa.array([hashlib.sha256(x).digest() for x in texts], pa.binary()), pa.array(np.diff(offsets), pa.int64()), pa.array([z.compress(x) for x in texts], pa.binary()), part.column(2), *more],
                    ["rid", "doc_id", "sha", "n_bytes", "packed", "carried", *(f"{c}{i}" for i in range(len(rules)) for c in ("size", "runs"))],
                )
                rid += n

    kind = docs.schema["carried"].dataType.simpleString()
    each = "".join(f", size{i} long, runs{i} array<struct<h: long, s: long, e: long>>" for i in range(len(rules)))
    return docs.mapInArrow(tidy(run), f"rid long, doc_id long, sha binary, n_bytes long, packed binary, carried {kind}{each}")


def unpacked(packed: list[bytes]) -> tuple[bytes, np.ndarray]:
    """Joined texts and their offsets."""
    import zstandard

    z = zstandard.ZstdDecompressor()
    texts = [z.decompress(x) for x in packed]
    return b"".join(texts), np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)


def cut_segments(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Of (rid, d, packed, runs with m, the shards of their anchor, and k, their rule): one row for each run; the segment's units once per task, mostly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, bytes]] = set()
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part, out = batch.slice(start, 64), []
                joined, offsets = unpacked(part.column("packed").to_pylist())
                each = []
                for rule in rules:
                    data, places = units(np.frombuffer(joined, np.uint8), offsets, rule.unit)
                    each.append((data, places.tolist(), rule.length))
                for n, (rid, d, runs) in enumerate(zip(*(part.column(c).to_pylist() for c in ("rid", "d", "runs")))):
                    for x in runs:
                        data, places, length = each[x["k"]]
                        at = places[n]
                        seg = data[at + x["s"] : at + x["e"] + length].tobytes()
                        digest = hashlib.blake2b(seg, digest_size=16).digest()
                        salt = int.from_bytes(digest[:4], "little") % x["m"]
                        new = (x["h"], digest) not in seen
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add((x["h"], digest))
                        out.append((rid, d, x["k"], x["s"], x["e"] - x["s"] + 1, x["h"], x["m"], salt, digest, seg if new else None))
                for at in range(0, len(out), 4096):
                    c = list(zip(*out[at : at + 4096]))
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(c, kinds)], ["rid", "d", "k", "s", "w", "h", "m", "salt", "digest", "seg"])

    return rows.mapInArrow(tidy(run), "rid long, d long, k int, s long, w long, h long, m int, salt int, digest binary, seg binary")


def shard_sort(segments: DataFrame, rules: list[Rule], first: bool) -> DataFrame:
    """Per segment with repeats: h, digest, hits. Per shard of a split anchor and range also h, range, and its windows in seg.

    segments: k, h, m, salt, digest, seg (null in some rows), place (d, rid, s: of its first copy; only with first), sorted by (k, h, salt);
    a shard is never cut in two. hits: windows that are elsewhere too; with first, of the segment's first copy those that are earlier too.
    """

    def solve(rows: list, rule: Rule) -> Iterator[tuple]:
        length, width = rule.length, 1 if rule.unit == "bytes" else 8
        data = np.frombuffer(b"".join(r[4] for r in rows), np.uint8 if width == 1 else np.uint64)
        ends = np.cumsum([len(r[4]) // width for r in rows])
        begins = np.concatenate([[0], ends[:-1]])
        order, twice, opens = repeated_windows(data, ends, length)
        which = np.searchsorted(ends, order, side="right")
        hit, heads = twice, opens
        if first and len(order):
            d, r, s = (np.array([x[5][c] for x in rows], np.int64) for c in range(3))
            row = np.zeros(len(rows), np.int64)
            by = np.lexsort((r, d))
            row[by] = np.cumsum(np.concatenate([[0], (np.diff(d[by]) != 0) | (np.diff(r[by]) != 0)]))
            at = (row[which] << 32) + order - begins[which] + s[which]
            group = np.cumsum(opens) - 1
            heads = at == np.minimum.reduceat(at, np.flatnonzero(opens))[group]
            hit = ~heads
        flag = np.zeros(len(data), bool)
        flag[order[hit]] = True
        for r, a, b in zip(rows, begins.tolist(), ends.tolist()):
            if (hits := intervals(flag[a : b - length + 1])) :
                yield r[0], r[3], [{"a": x, "b": y} for x, y in hits], None, None
        split = [i for i, r in enumerate(rows) if r[1] > 1]
        if split:
            heads = heads & np.isin(which, split)
            starts, which, known = order[heads], which[heads], twice[heads]
            digests = window_digests(data, starts, length)
            hs, ms = np.array([r[0] for r in rows])[which], np.array([r[1] for r in rows], np.uint64)[which]
            ranges = ((digests[:, 0] >> np.uint64(32)) * ms >> np.uint64(32)).astype(np.int64)
            packed = np.zeros(len(starts), FIRST_RUN if first else RUN)
            packed["hi"], packed["lo"], packed["known"] = digests[:, 0], digests[:, 1], known
            packed["at"] = starts - begins[which]
            packed["seg"] = np.array([r[3] for r in rows], "V16")[which]
            if first:
                packed["d"], packed["r"], packed["s"] = d[which], r_of(rows)[which], s[which] + packed["at"]
            key = np.lexsort((digests[:, 1], digests[:, 0], ranges, hs))
            cut = np.flatnonzero((np.diff(hs[key]) != 0) | (np.diff(ranges[key]) != 0)) + 1
            for part in np.split(key, cut):
                if len(part):
                    yield int(hs[part[0]]), None, None, int(ranges[part[0]]), packed[part].tobytes()

    def r_of(rows: list) -> np.ndarray:
        return np.array([x[5][1] for x in rows], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results():
            rows, size, key, have = [], 0, None, {}
            for batch in batches:
                for k, h, m, salt, digest, seg, place in zip(*(batch.column(c).to_pylist() for c in ("k", "h", "m", "salt", "digest", "seg", "place"))):
                    if (k, h, salt) != key:
                        rows += have.values()
                        if rows and (size >= CHUNK // 2 or k != key[0]):
                            yield from solve(rows, rules[key[0]])
                            rows, size = [], 0
                        key, have = (k, h, salt), {}
                    if (row := have.get(digest)) is None:
                        have[digest] = row = [h, m, salt, digest, None, None]
                    if seg is not None and row[4] is None:
                        row[4] = seg
                        size += len(seg)
                    if place is not None:
                        row[5] = (place["d"], place["rid"], place["s"])
            rows += have.values()
            if rows:
                yield from solve(rows, rules[key[0]])

        yield from batched(results())

    return segments.select("k", "h", "m", "salt", "digest", "seg", "place").mapInArrow(tidy(run), HITS)


HITS = "h long, digest binary, hits array<struct<a: long, b: long>>, range long, seg binary"
HIT = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
RUN = np.dtype([("hi", "<u8"), ("lo", "<u8"), ("known", "?"), ("at", "<i4"), ("seg", "V16")])
#: With the place of the window's first copy in the shard.
FIRST_RUN = np.dtype([*RUN.descr, ("d", "<i8"), ("r", "<i8"), ("s", "<i8")])


def batched(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    def batch(rows: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.binary(), HIT, pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], ["h", "digest", "hits", "range", "seg"])

    out = []
    for r in rows:
        out.append(r)
        if len(out) >= 2000:
            yield batch(out)
            out = []
    if out:
        yield batch(out)


def merged_shards(runs: DataFrame, first: bool) -> DataFrame:
    """Of (h, range, seg: a sorted run of a shard's distinct windows), as hits the windows of more than one run; with first, those that another run has earlier."""

    def merge(key: list[bytes]) -> Iterator[tuple]:
        each = [np.frombuffer(x, FIRST_RUN if first else RUN) for x in key]
        whole = np.concatenate(each)
        order = np.lexsort((*(whole[c] for c in ("s", "r", "d") if first), whole["lo"], whole["hi"]))
        hi, lo = whole["hi"][order], whole["lo"][order]
        new = np.ones(len(hi), bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        number = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        earliest = whole[order][heads]
        found: dict[bytes, list[int]] = {}
        for x in each:
            # binary search of the run's windows among the distinct ones of all runs
            left = np.searchsorted(hi[heads], x["hi"], side="left")
            while (off := (hi[heads][left] == x["hi"]) & (lo[heads][left] < x["lo"])).any():
                left[off] += 1
            if first:
                goes = np.any([x[c] != earliest[c][left] for c in ("d", "r", "s")], axis=0)
            else:
                goes = (np.searchsorted(number, left, side="right") - np.searchsorted(number, left, side="left") > 1) & ~x["known"]
            for at, seg in zip(x["at"][goes].tolist(), x["seg"][goes]):
                found.setdefault(bytes(seg), []).append(at)
        for seg, at in found.items():
            flags = np.zeros(max(at) + 1, bool)
            flags[at] = True
            yield seg, intervals(flags)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results():
            key, held = None, []
            for batch in batches:
                for h, r, seg in zip(*(batch.column(c).to_pylist() for c in ("h", "range", "seg"))):
                    if (h, r) != key:
                        if len(held) > 1:
                            yield from ((key[0], *x) for x in merge(held))
                        key, held = (h, r), []
                    held.append(seg)
            if len(held) > 1:
                yield from ((key[0], *x) for x in merge(held))

        yield from batched((h, seg, [{"a": a, "b": b} for a, b in hits], None, None) for h, seg, hits in results())

    n = parts(runs.sparkSession)
    return runs.repartition(n, "h", "range").sortWithinPartitions("h", "range").mapInArrow(tidy(run), HITS)


def united(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Of (rid, k, hits), the maximal covered spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, hits in zip(*(batch.column(c).to_pylist() for c in ("k", "hits"))):
                spans: list[dict] = []
                for a, b in sorted((x["a"], x["b"] + rules[k].length) for x in hits):
                    if spans and a <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], b)
                    else:
                        spans.append({"start": a, "end": b})
                out.append(spans)
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("k"), pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["rid", "k", "spans"])

    return rows.select("rid", "k", "hits").mapInArrow(tidy(run), f"rid long, k int, spans {SPANS}")


def texts_of(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text", carry: list[str] = ()) -> DataFrame:
    """rid, doc_id, sha, n_bytes, packed (zstd), carried of every row, and what repeated_spans() needs for each rule."""
    carried = F.struct(*(F.col(c) for c in carry)) if carry else F.lit(0)
    return park(ingest(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), carried.alias("carried")), rules), "texts", compression="zstd")


def copies_of(texts: DataFrame) -> DataFrame:
    """sha, rid of the first of equal texts (in the order of ids, then rows), n: how many there are."""
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("d"), "rid"))
    return park(texts.groupBy("sha").agg(first.alias("first"), F.count("*").alias("n")).select("sha", "first.rid", "n"), "copies")


def repeated_spans(texts: DataFrame, copies: DataFrame, rules: list[Rule], keep: str = "none", split: int = SPLIT) -> DataFrame:
    """rid, k (the rule's place in rules, as given to texts_of), spans (in the rule's units) of the rows with something to remove.

    What the steps write goes as soon as no later one reads it.
    """
    first, numbers = keep == "first", range(len(rules))
    of_rule = lambda i: F.transform(f"runs{i}", lambda x: F.struct(F.lit(i).alias("k"), x["h"].alias("h"), x["s"].alias("s"), x["e"].alias("e")))
    runs = F.concat(*map(of_rule, numbers))
    # only later copies of equal texts are shuffled here; anchors are read from the texts each time they are needed
    later = park(texts.select("rid", "sha").join(copies.where("n > 1").select("sha", F.col("rid").alias("first")), "sha").where("rid <> first").select("rid"), "later")
    one = without(texts.select("rid", *(f"runs{i}" for i in numbers)), later, "rid").select("rid", F.explode(runs).alias("x")).select("rid", "x.*")
    # both sides of the join are plain shuffles, so Spark splits a frequent anchor
    often = park(one.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h", F.ceil(F.col("n") / split).cast("int").alias("m")), "often")
    lists = one.join(often, "h").groupBy("rid").agg(F.collect_list(F.struct("k", "s", "e", "h", "m")).alias("runs"))
    segments = park(cut_segments(texts.select("rid", F.coalesce("doc_id", F.lit(LAST)).alias("d"), "packed").join(lists, "rid").select("rid", "d", "packed", "runs"), rules), "segments", compression="zstd")
    sweep(texts.sparkSession)
    # counts and smallest places are made before the shuffle too, so a passage that is everywhere is one row a task
    counts = segments.groupBy("h", "digest").agg(F.count("*").alias("n"), *([F.max(c).alias(c) for c in ("k", "m", "salt")] + [F.min(F.struct("d", "rid", "s")).alias("place")] if first else []))
    counts = park(counts, "counts") if first else counts
    columns = ["k", "h", "m", "salt", "digest"]
    place = F.lit(None).cast("struct<d: bigint, rid: bigint, s: bigint>").alias("place")
    dealt = segments.where("seg is not null").select(*columns, "seg", place)
    dealt = dealt.union(counts.select(*columns, F.lit(None).cast("binary").alias("seg"), "place")) if first else dealt
    dealt = dealt.repartition(parts(texts.sparkSession), "h", "salt").sortWithinPartitions("k", "h", "salt")
    sorted_ = park(shard_sort(dealt, rules, first), "shards", compression="zstd")
    sweep(texts.sparkSession)
    hits = sorted_.where("digest is not null").select("h", "digest", "hits").union(merged_shards(sorted_.where("digest is null"), first).select("h", "digest", "hits"))
    known = counts.join(hits.groupBy("h", "digest").agg(F.flatten(F.collect_list("hits")).alias("hits")), ["h", "digest"], "left").where("n > 1 or hits is not null")
    known = known.select("h", "digest", "n", "hits", *([F.col("place.rid").alias("first_rid"), F.col("place.s").alias("first_s")] if first else []))
    # Spark splits the rows of a frequent segment here, as both sides are plain shuffles
    known = park(known, "known")
    sweep(texts.sparkSession)
    each = segments.select("rid", "k", "s", "w", "h", "digest").join(known, ["h", "digest"])
    whole = F.array(F.struct(F.col("s").alias("a"), (F.col("s") + F.col("w") - 1).alias("b")))
    some = F.transform("hits", lambda x: F.struct((x["a"] + F.col("s")).alias("a"), (x["b"] + F.col("s")).alias("b")))
    all_of = (F.col("rid") != F.col("first_rid")) | (F.col("s") != F.col("first_s")) if first else F.col("n") > 1
    each = each.select("rid", "k", F.when(all_of, whole).otherwise(some).alias("hits")).where("hits is not null")
    spans = united(each.groupBy("rid", "k").agg(F.flatten(F.collect_list("hits")).alias("hits")), rules)
    # copies: a document that is there twice repeats from end to end, if it is long enough
    twin = texts.select("rid", "sha", *(f"size{i}" for i in numbers)).join(copies.where("n > 1").select("sha", F.col("rid").alias("first")), "sha")
    twin = twin.where("rid <> first") if first else twin
    sizes = F.filter(F.array(*(F.struct(F.lit(i).alias("k"), F.col(f"size{i}").alias("size"), F.lit(r.length).alias("least")) for i, r in enumerate(rules))), lambda x: x["size"] >= x["least"])
    twin = twin.select("rid", F.explode(sizes).alias("x"))
    whole = twin.select("rid", "x.k", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("x.size").alias("end"))).alias("spans"))
    spans = park(spans.join(whole.select("rid", "k"), ["rid", "k"], "left_anti").union(whole), "spans")
    unpark(later, often, segments, sorted_, known, *([counts] if first else []))
    sweep(texts.sparkSession)
    return spans


def kept_text(texts: DataFrame, spans: DataFrame, rule: Rule, whole_chars: bool, how: str = "inner") -> DataFrame:
    """Per row of texts (rid, packed, ...) with spans, or all rows (left): n_removed, n_units, n_spans, kept (bytes), kept_sha256, and the rest.

    With whole_chars, a character goes only if all its bytes do. Of words go the bytes from the first one to the last one.
    """
    rest = [c for c in texts.columns if c != "packed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                z = zstandard.ZstdDecompressor()
                for packed, own in zip(part.column("packed"), part.column("spans").to_pylist()):
                    kept, end, text, n = [], 0, z.decompress(packed.as_py()), 0
                    if own and rule.unit == "words":
                        starts, size, _ = words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), SPACE_ENDS)
                    for x in own or []:
                        first, last = x["start"], x["end"]
                        n += last - first
                        if rule.unit == "words":
                            first, last = int(starts[first]), int(starts[last - 1] + size[last - 1])
                        elif whole_chars:
                            while first < last and text[first] & 0xC0 == 0x80:
                                first += 1
                            while last > first and last < len(text) and text[last] & 0xC0 == 0x80:
                                last -= 1
                        kept.append(text[end:first])
                        end = last
                    kept = b"".join([*kept, text[end:]])
                    out.append((len(text) - len(kept), n, len(own or []), kept, hashlib.sha256(kept).hexdigest()))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
                yield pa.RecordBatch.from_arrays([*(pa.array(x, t) for x, t in zip(zip(*out), kinds)), *(part.column(c) for c in rest)], ["n_removed", "n_units", "n_spans", "kept", "kept_sha256", *rest])

    types = "".join(f", {c} {texts.schema[c].dataType.simpleString()}" for c in rest)
    return texts.join(spans.select("rid", "spans"), "rid", how).select("packed", "spans", *rest).mapInArrow(tidy(run), f"n_removed long, n_units long, n_spans long, kept binary, kept_sha256 string{types}")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] = (), rule: Rule = PASSAGES, keep: str = "first", split: int = SPLIT) -> DataFrame:
    """Per row: doc_id, text without what the rule removes (whole characters), n_removed (bytes), and the columns to carry."""
    texts = texts_of(docs, [rule], id_col, text_col, carry)
    spans = repeated_spans(texts, copies_of(texts), [rule], keep, split)
    cut = kept_text(texts.select("rid", "packed", "carried", "doc_id"), spans, rule, True, "left")
    return cut.select("doc_id", F.col("kept").cast("string").alias("text"), "n_removed", *(["carried.*"] if carry else []))


def op5_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns by the rule BYTES. Beside them n_passages and n_passage_words: runs of 50 words or more that are elsewhere too, by the rule PASSAGES."""
    texts = texts_of(table(spark, sf_dir, "documents"), [BYTES, PASSAGES])
    spans = repeated_spans(texts, copies_of(texts), [BYTES, PASSAGES])
    cut = kept_text(texts.select("rid", "packed"), spans.where("k = 0").select("rid", "spans"), BYTES, False).drop("kept", "n_units")
    passages = spans.where("k = 1")
    words_in = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    x = texts.select("rid", "doc_id", "sha", "n_bytes").join(cut, "rid", "left").join(passages.select("rid", F.size("spans").cast("long").alias("n_passages"), words_in.alias("n_passage_words")), "rid", "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_removed", "n_spans", "n_passages", "n_passage_words")]
    return x.select("doc_id", "n_bytes", *counts[:2], F.coalesce("kept_sha256", F.lower(F.hex("sha"))).alias("kept_sha256"), *counts[2:])
