"""SentencePiece encoding and decoding as a relational lattice.

A text, with the mark U+2581 for spaces and one in front, falls into words: a run of marks with the
characters after it, or a run of newlines. A word falls into units, between neighbouring characters
that no piece holds side by side; so no piece crosses a unit's border. Each different unit is encoded
once: its substrings of at most the longest piece's length are joined to the piece table, the edges
found are grouped by unit, and a higher-order aggregate folds them to the unit's pieces; texts then
take their units' ids back in order.

The fold follows the model. The file at hand is a byte-pair model, whose encoding is not the path of
the best sum of scores, so Viterbi gives other ids than the library on it. With model="bpe" the fold
merges the neighbours whose joint piece has the best score (the leftmost of equals), on a bit mask of
cuts: in one pass over the unit's edges, best first, which is the order of merges unless a merge enables
a better one; where it does, step by step. With model="unigram" it is Viterbi. Units of more than LONG characters, which
have no place in the mask (runs such as rows of letters; text without spaces mostly falls into
shorter units), leave the lattice: they are encoded in Python, by the same merges with a heap, or by
the same best sum.

Texts are read once. A chunk of documents keeps its words as numbers, and asks, once for each of its
units, the bucket that holds it; so no frequent word is shuffled more than once a chunk. Units travel
joined by spaces, which they never hold, and so take a few bytes each.

Characters without a piece become their bytes' pieces. A null or empty text has no ids. Ids may be
null or repeated, and texts too, as chunks keep their rows in order; texts of any length are whole;
extra columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import by_value, parts, table, tidy

by_value(__name__)

MARK, LONG = "▁", 61
#: Rows and characters after which a chunk is full.
CHUNK_ROWS, CHUNK_CHARS = 8192, 1 << 23
#: Characters of pieces up to which their pairs are looked up in a table.
TABLE = 8192
WORD = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n+")
#: An edge as a long: the place of its score among all (best last), 63 less its start, its size, its id.
SCORE, START, SIZE = 34, 28, 22


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def piece_rows(path: str) -> list[tuple[str, int, float, int]]:
    """(piece, id, score, byte or -1) of a model file; control and unknown pieces are left out. Bounded by the vocabulary."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = []
    for i in range(sp.get_piece_size()):
        if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i)):
            rows.append((sp.id_to_piece(i), i, float(sp.get_score(i)), int(sp.id_to_piece(i)[3:5], 16) if sp.is_byte(i) else -1))
    if any(len(WORD.findall(p)) > 1 for p, _, _, b in rows if b < 0):
        raise ValueError("a piece holds a mark or a newline behind other characters; its model does not encode word by word")
    return rows


class Numbers(dict):
    """Keys get numbers from a counter, in the order in which they are first asked for."""

    def __init__(self, counter: Iterator[int]):
        self.counter = counter

    def __missing__(self, key: str) -> int:
        self[key] = n = next(self.counter)
        return n


class Words:
    """Numbers of the words of texts. A word is a run of marks with the characters after it, a run of newlines, or the characters behind one.

    Where each space and each newline stands alone, splitting at spaces gives the words without their mark,
    which is much faster. What begins with a newline then has no mark, and may hold further characters.
    """

    def __init__(self):
        counter = itertools.count()
        self.plain, self.other = Numbers(counter), Numbers(counter)

    def of(self, text: str) -> Iterator[int]:
        if text.startswith(" ") or "  " in text or "\n\n" in text or MARK in text:
            return map(self.other.__getitem__, WORD.findall(MARK + text.replace(" ", MARK)))
        return map(self.plain.__getitem__, text.replace("\n", " \n").split(" ")) if text else iter(())

    def listed(self) -> list[str]:
        out = [""] * (len(self.plain) + len(self.other))
        for w, i in self.other.items():
            out[i] = w
        for w, i in self.plain.items():
            out[i] = w if w.startswith("\n") else MARK + w
        return out


def neighbours(pieces: list[str]) -> np.ndarray:
    """Sorted codes of the pairs of characters that stand side by side in a piece."""
    return np.array(sorted({ord(a) << 32 | ord(b) for p in pieces for a, b in zip(p, p[1:])}), np.uint64)


def units(of: list[str], joined: np.ndarray) -> tuple[list[int], list[str]]:
    """The number of units of each word, and all units. Words hold no space."""
    if not of:
        return [], []
    text = " ".join(of)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    left, right = (joined >> np.uint64(32)).astype(np.int64), (joined & np.uint64(0xFFFFFFFF)).astype(np.int64)
    chars = np.unique(np.concatenate([left, right]))
    if len(chars) <= TABLE:
        # numbers for the characters of the pairs, and a table of which stand side by side
        number = np.zeros(0x110000, np.int16)
        number[chars] = np.arange(1, len(chars) + 1)
        side = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        side[number[left], number[right]] = True
        own = number[code]
        cut = ~side[own[:-1], own[1:]]
    else:
        pair = code[:-1].astype(np.uint64) << np.uint64(32) | code[1:]
        cut = joined[np.minimum(np.searchsorted(joined, pair), len(joined) - 1)] != pair
    space = code == 32
    begins = np.concatenate([[True], cut]) & ~space
    begin, end = np.flatnonzero(begins), np.flatnonzero(np.concatenate([cut, [True]]) & ~space) + 1
    word = np.cumsum(space)[begin]
    return np.bincount(word, minlength=len(of)).tolist(), [text[a:b] for a, b in zip(begin.tolist(), end.tolist())]


def bucket_of(unit: str, buckets: int) -> int:
    return zlib.crc32(unit.encode("utf-8", "surrogatepass")) % buckets


def mask(first: Column, last: Column) -> Column:
    """Bits first .. last of a long; none if last < first."""
    one = F.lit(1).cast("long")
    return F.call_function("shiftleft", F.call_function("shiftleft", one, last - first + 1) - 1, first)


def edges(of: DataFrame, pieces: DataFrame, longest: int, least: int) -> DataFrame:
    """of with start, size, id and score of each edge of at least `least` characters; of one character, those without a piece too (id -1).

    of: unit, n (its length), and others. The join is on a hash of the substring, which makes it several times
    as fast as one on strings; that both are equal is then checked.
    """
    x = of.withColumn("start", F.explode(F.sequence(F.lit(0), F.col("n") - least)))
    x = x.withColumn("size", F.explode(F.sequence(F.lit(least), F.least(F.lit(longest), F.col("n") - F.col("start")))))
    part = F.substring("unit", F.col("start") + 1, F.col("size"))
    held = pieces.where("byte < 0").select(F.xxhash64("piece").alias("h"), F.col("piece").alias("_piece"), F.length("piece").alias("_size"), "id", "score", "place")
    # the piece table is a file's vocabulary: its size does not depend on the texts
    same = (F.col("key") == F.col("h")) & part.startswith(F.col("_piece")) & (F.col("_size") >= F.col("size"))
    x = x.withColumn("key", F.xxhash64(part)).join(F.broadcast(held), same, "left" if least == 1 else "inner")
    x = x.where("id is not null or size = 1") if least == 1 else x
    return x.select(*of.columns, "start", "size", F.coalesce("id", F.lit(-1)).alias("id"), F.coalesce("score", F.lit(0.0)).alias("score"), "place")


def merged(of: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """bucket, unit, cuts (a bit for each border of a token), tokens (those of several characters: start and id in a long), by merges in order of score."""
    packed = F.call_function("shiftleft", F.col("place"), F.lit(SCORE)) + F.call_function("shiftleft", (63 - F.col("start")).cast("long"), F.lit(START)) + F.call_function("shiftleft", F.col("size").cast("long"), F.lit(SIZE)) + F.col("id")
    # u comes first, as a sort by its bits is the fastest
    x = edges(of, pieces, longest, 2).withColumn("edge", packed).groupBy("u", "bucket").agg(F.first("unit").alias("unit"), F.first("n").alias("n"), F.collect_list("edge").alias("edges"))

    def move(e: Column) -> Column:
        start, size = (63 - F.shiftright(e, START).bitwiseAND(F.lit(63))).cast("int"), F.shiftright(e, SIZE).bitwiseAND(F.lit(63)).cast("int")
        end = start + size
        token = F.call_function("shiftleft", start.cast("long"), F.lit(SIZE)) + e.bitwiseAND(F.lit((1 << SIZE) - 1))
        return F.struct(mask(start + 1, end - 1).alias("inner"), mask(start, start).bitwiseOR(mask(end, end)).alias("ends"), token.alias("token"), e.alias("key"))

    # the best first
    x = x.withColumn("moves", F.transform(F.sort_array("edges", asc=False), move))
    fits = lambda m, cuts: (m["ends"].bitwiseAND(cuts) == m["ends"]) & (F.bit_count(m["inner"].bitwiseAND(cuts)) == 1)
    without = lambda cuts, m: cuts.bitwiseAND(F.bitwise_not(m["inner"]))

    def in_turn(cuts: Column, m: Column) -> Column:
        """Makes the moves in their order. That one enables a better one, which had its turn, makes all bits of the mask ones: then this is not the order of merges."""
        better = F.exists("moves", lambda o: (o["key"] > m["key"]) & (o["inner"].bitwiseAND(m["inner"]) != 0) & fits(o, without(cuts, m)))
        return F.when((cuts != -1) & fits(m, cuts), F.when(better, F.lit(-1).cast("long")).otherwise(without(cuts, m))).otherwise(cuts)

    def step(cuts: Column, _: Column) -> Column:
        """Makes the best move that fits, whatever was made before."""
        best = F.get(F.filter("moves", lambda m: fits(m, cuts)), F.lit(0))
        return F.coalesce(without(cuts, best), cuts)

    whole = mask(F.lit(0), F.col("n"))
    all_steps = lambda: F.aggregate(F.sequence(F.lit(2), F.col("n")), whole, step)
    # an array of one, so that the first fold is made once
    x = x.withColumn("cuts", F.get(F.transform(F.array(F.aggregate("moves", whole, in_turn)), lambda c: F.when(c == -1, all_steps()).otherwise(c)), F.lit(0)))
    kept = F.filter("moves", lambda m: (m["ends"].bitwiseAND(F.col("cuts")) == m["ends"]) & (m["inner"].bitwiseAND(F.col("cuts")) == 0))
    return x.select("bucket", "unit", "cuts", F.transform(kept, lambda m: m["token"]).alias("tokens"))


def viterbi(of: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """bucket, unit, cuts, tokens (as in merged), by the best sum of scores (characters without a piece cost 1e6), of equals the greater ids."""
    edge = F.struct("score", "start", "size", "id")
    x = edges(of, pieces, longest, 1).groupBy("u", "bucket").agg(F.first("unit").alias("unit"), F.first("n").alias("n"), F.collect_list(edge).alias("edges"))
    state = "array<struct<score: double, ids: array<int>, cuts: bigint, tokens: array<bigint>>>"
    begin = F.array(F.struct(F.lit(0.0), F.array().cast("array<int>"), F.lit(1).cast("long"), F.array().cast("array<bigint>"))).cast(state)

    def step(done: Column, end: Column) -> Column:
        into = F.filter("edges", lambda e: e["start"] + e["size"] == end)

        def via(e: Column) -> Column:
            before = F.element_at(done, e["start"] + 1)
            own = F.when(e["size"] > 1, F.array(F.call_function("shiftleft", e["start"].cast("long"), F.lit(SIZE)) + e["id"])).otherwise(F.array().cast("array<bigint>"))
            code = F.when(e["id"] >= 0, e["id"]).otherwise(F.ascii(F.substring(F.col("unit"), e["start"] + 1, F.lit(1))))
            sum_ = before["score"] + F.when(e["id"] >= 0, e["score"]).otherwise(F.lit(-1e6))
            return F.struct(sum_.alias("score"), F.concat(before["ids"], F.array(code)).alias("ids"), before["cuts"].bitwiseOR(mask(end, end)).alias("cuts"), F.concat(before["tokens"], own).alias("tokens"))

        return F.concat(done, F.array(F.array_max(F.transform(into, via))).cast(state))

    x = x.withColumn("best", F.element_at(F.aggregate(F.sequence(F.lit(1), F.col("n")), begin, step), -1))
    return x.select("bucket", "unit", "best.cuts", "best.tokens")


class Known:
    """The piece table where units are put together from their tokens, and units beyond the mask are encoded."""

    def __init__(self, rows: list[tuple[str, int, float, int]], model: str):
        self.ids, self.scores = {p: i for p, i, _, b in rows if b < 0}, {p: s for p, _, s, b in rows if b < 0}
        self.first_byte = min((i for _, i, _, b in rows if b >= 0), default=0)
        self.longest = max((len(p) for p in self.ids), default=1)
        self.model = model

    def own(self, piece: str) -> list[int]:
        """The piece's id, or those of its bytes."""
        i = self.ids.get(piece)
        return [i] if i is not None else [self.first_byte + b for b in piece.encode("utf-8", "surrogatepass")]

    def from_tokens(self, unit: str, cuts: int, tokens: list[int]) -> list[int]:
        """tokens: start and id of those of several characters; between other cuts stand single characters."""
        at, out = {t >> SIZE: t & (1 << SIZE) - 1 for t in tokens}, []
        for start, char in enumerate(unit):
            if cuts >> start & 1:
                if (i := at[start] if start in at else self.ids.get(char)) is not None:
                    out.append(i)
                else:
                    out += self.own(char)
        return out

    def alone(self, unit: str) -> list[int]:
        """A unit that the lattice gave no edge of several characters, or that is too long for it."""
        if len(unit) <= LONG:
            return [i for c in unit for i in self.own(c)]
        return self.merge_long(unit) if self.model == "bpe" else self.viterbi_long(unit)

    def merge_long(self, unit: str) -> list[int]:
        """The same merges as in merged(), with a heap, in time n log n."""
        parts, after, before = list(unit), list(range(1, len(unit) + 1)), list(range(-1, len(unit) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (both := parts[i] + parts[j]) in self.scores:
                heapq.heappush(heap, (-self.scores[both], i, both))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            if not parts[i] or after[i] >= len(parts) or parts[i] + parts[after[i]] != both:
                continue
            j = after[i]
            parts[i], parts[j], after[i] = both, "", after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for p in parts if p for x in self.own(p)]

    def viterbi_long(self, unit: str) -> list[int]:
        """The same best sum as in viterbi(), of equals the greater ids, in time n * longest."""
        best: list[tuple[float, int]] = [(0.0, 0)]  # sum, and start of the last piece

        def path(start: int, end: int) -> list[str]:
            out = [unit[start:end]]
            while start:
                start, end = best[start][1], start
                out.append(unit[start:end])
            return out[::-1]

        for end in range(1, len(unit) + 1):
            into = [(best[start][0] + self.scores.get(unit[start:end], -1e6), start) for start in range(max(0, end - self.longest), end) if end - start == 1 or unit[start:end] in self.ids]
            most = max(into)[0]
            equal = [x for x in into if x[0] == most]
            best.append(equal[0] if len(equal) == 1 else max(equal, key=lambda x: [self.ids.get(p, ord(p[0])) for p in path(x[1], end)]))
        return [x for p in path(best[-1][1], len(unit)) for x in self.own(p)]


def squeezed(x: np.ndarray) -> bytes:
    """Whole numbers under 2**31, byte by byte of each: the upper ones are mostly equal."""
    import zstandard

    return zstandard.compress(np.ascontiguousarray(np.asarray(x, "<i4").reshape(-1, 1).view(np.uint8).T).tobytes(), 3)


def loosened(x: bytes) -> np.ndarray:
    import zstandard

    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(x), np.uint8).reshape(4, -1).T).view("<i4").ravel().astype(np.int64)


def spliced(lens: np.ndarray, flat: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and joined contents of the lists number index[0], index[1], ...; list i holds lens[i] of flat."""
    size = lens[index]
    shift = (np.cumsum(lens) - lens)[index] - (np.cumsum(size) - size)
    return size, flat[np.arange(size.sum()) + np.repeat(shift, size)]


#: What a chunk of rows keeps: 16 bytes of each row's text, count (words of each row), word (their numbers), parts (units
#: of each different word), unit (their numbers).
HELD = pa.schema([("doc_ids", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("digests", "count", "word", "parts", "unit"))])
#: Keys under it are buckets, the others chunks.
FIRST_CHUNK = 1 << 32


def chunks(texts: DataFrame, joined: np.ndarray, buckets: int) -> DataFrame:
    """key, data: of each chunk of rows what it keeps, and for each bucket its number and the units that it asks for, in the order of their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() + 1 << 32

        def row(doc_ids, digests, count, word, seen) -> pa.RecordBatch:
            # frequent words first, so that most numbers are small
            word = np.array(word, np.int64)
            order = np.argsort(-np.bincount(word), kind="stable")
            rank = np.zeros(len(order), np.int64)
            rank[order] = np.arange(len(order))
            names = seen.listed()
            parts, found = units([names[i] for i in order.tolist()], joined)
            by: dict[int, list[str]] = {}
            for u in dict.fromkeys(found):
                by.setdefault(bucket_of(u, buckets), []).append(u)
            by = dict(sorted(by.items()))
            number = {u: i for i, u in enumerate(u for x in by.values() for u in x)}
            data = [squeezed(np.array(x)) for x in (count, rank[word], parts, [number[u] for u in found])]
            own = pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((doc_ids, bytes(digests), *data), HELD)], schema=HELD)
            asked = [" ".join([str(chunk), *x]).encode() for x in by.values()]
            return pa.RecordBatch.from_arrays([pa.array([chunk, *by], pa.int64()), pa.array([own.serialize().to_pybytes(), *asked], pa.binary())], ["key", "data"])

        state: tuple = ([], bytearray(), [], array("i"), Words())
        chars = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids, digests, count, word, seen = state
                text = text.as_py() or ""
                before = len(word)
                word.extend(seen.of(text))
                doc_ids.append(doc_id)
                digests += hashlib.md5(text.replace(MARK, " ").encode()).digest()
                count.append(len(word) - before)
                chars += len(text)
                if len(doc_ids) >= CHUNK_ROWS or chars >= CHUNK_CHARS:
                    del text
                    yield row(*state)
                    state, chars, chunk = ([], bytearray(), [], array("i"), Words()), 0, chunk + 1
        if state[0]:
            yield row(*state)

    return texts.mapInArrow(tidy(run), "key long, data binary")


ANSWER = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("lens", pa.binary()), ("ids", pa.binary())])


def answerer(known: Known):
    def answer(coded: pa.Table, asked: pa.Table) -> pa.Table:
        """Of one bucket: to each chunk the ids of the units it asks for, in its order."""
        held: dict[str, list[int]] = {}
        for unit, cuts, tokens in zip(*(coded.column(c).to_pylist() for c in ("unit", "cuts", "tokens"))):
            held[unit] = known.from_tokens(unit, cuts, tokens)
        out = []
        for bucket, names in zip(*(asked.column(c).to_pylist() for c in ("key", "data"))):
            (chunk, *names), found = names.decode().split(" "), []
            for u in names:
                if (ids := held.get(u)) is None:
                    held[u] = ids = known.alone(u)
                found.append(ids)
            out.append((int(chunk), bucket, squeezed(np.array([len(x) for x in found])), squeezed(np.array([i for x in found for i in x]))))
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out), ANSWER)], schema=ANSWER) if out else ANSWER.empty_table()

    return answer


CODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("digest", pa.binary())])


def filled(chunk: pa.Table, answers: pa.Table) -> pa.Table:
    """The chunk's rows: units' ids put together to words, and these to texts."""
    if not chunk.num_rows:
        return CODED.empty_table()
    (row,) = pa.ipc.read_record_batch(pa.py_buffer(chunk.column("data")[0].as_py()), HELD).to_pylist()
    got = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
    none = np.zeros(0, np.int64)
    lens, ids = (np.concatenate([loosened(r[c]) for r in got] or [none]) for c in ("lens", "ids"))
    count, word, parts, unit = (loosened(row[c]) for c in ("count", "word", "parts", "unit"))
    size, ids = spliced(lens, ids.astype(np.int32), unit)
    ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(parts)])]
    size, ids = spliced(np.diff(ends), ids, word)
    ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(count)])]
    digests = [row["digests"][i : i + 16] for i in range(0, len(row["digests"]), 16)]
    return pa.table([pa.array(row["doc_ids"], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)), pa.array(digests, pa.binary())], schema=CODED)


def encode(docs: DataFrame, path: str | None = None, model: str = "bpe", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids, round_trip: whether the text decoded from all ids is the row's text, by MD5. A mark in a text counts as a space, as for the model."""
    spark = docs.sparkSession
    rows = piece_rows(path or default_model())
    known = Known(rows, model)
    place = {s: i + 1 for i, s in enumerate(sorted({s for _, _, s, b in rows if b < 0}))}
    pieces = spark.createDataFrame([(*r, place.get(r[2], 0)) for r in rows], "piece string, id int, score double, byte int, place long").coalesce(1)
    buckets = 4 * parts(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # one shuffle serves the lattice, the answers and the chunks: the three of them read it as it is, and so Spark makes it once
    dealt = chunks(texts, neighbours(list(known.ids)), buckets).repartition(buckets, "key").withColumn("_row", F.monotonically_increasing_id())
    of_kind = lambda kind: dealt.where(f"_row >= 0 and {kind}").drop("_row")
    asked, held = of_kind(f"key < {FIRST_CHUNK}"), of_kind(f"key >= {FIRST_CHUNK}")
    names = F.split(F.col("data").cast("string"), " ")
    different = asked.select(F.col("key").alias("bucket"), F.explode(F.slice(names, F.lit(2), F.size(names))).alias("unit")).distinct().withColumn("n", F.length("unit"))
    of = different.where(F.col("n").between(2, LONG)).withColumn("u", F.monotonically_increasing_id())
    coded = (merged if model == "bpe" else viterbi)(of, pieces, known.longest)
    answers = coded.select(F.col("bucket").alias("home"), "unit", "cuts", "tokens").groupBy("home").cogroup(asked.groupBy("key")).applyInArrow(answerer(known), "chunk long, bucket int, lens binary, ids binary")
    x = held.groupBy("key").cogroup(answers.groupBy("chunk")).applyInArrow(filled, "doc_id long, ids array<int>, digest binary")
    return decoded(x, rows, "doc_id long, ids array<int>, round_trip boolean", lambda batch, texts: [batch.column("doc_id"), batch.column("ids"), pa.array([t is not None and hashlib.md5(t).digest() == d for t, d in zip(texts, batch.column("digest").to_pylist())], pa.bool_())])


def decoded(x: DataFrame, rows: list[tuple[str, int, float, int]], schema: str, result) -> DataFrame:
    """x (with ids) by way of result(batch, texts): texts are the bytes of each row's ids, in order; None if they are no UTF-8."""
    codes = [b""] * (max((i for _, i, _, _ in rows), default=0) + 1)
    for p, i, _, b in rows:
        codes[i] = bytes([b]) if b >= 0 else p.encode()
    lens, flat, mark = np.array([len(c) for c in codes]), np.frombuffer(b"".join(codes), np.uint8), MARK.encode()
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def text(data: bytes) -> bytes | None:
        data = data.replace(mark, b" ")
        try:
            data.decode()
        except UnicodeDecodeError:
            return None
        return data[1:] if data.startswith(b" ") else data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                column = part.column("ids")
                ids = column.flatten().to_numpy(zero_copy_only=False)
                n = np.nan_to_num(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)).astype(np.int64)
                size, data = spliced(lens, flat, ids.astype(np.int64))
                ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n)])]
                yield pa.RecordBatch.from_arrays(result(part, [text(data[a:b].tobytes()) for a, b in zip(ends, ends[1:])]), names)

    return x.mapInArrow(tidy(run), schema)


def decode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: doc_id, text of its ids (control ids have none; null if their bytes are no UTF-8, empty for null ids)."""
    x = docs.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return decoded(x, piece_rows(path or default_model()), f"doc_id {x.schema['doc_id'].dataType.simpleString()}, text string", lambda batch, texts: [batch.column("doc_id"), pa.array([None if t is None else t.decode() for t in texts], pa.string())])


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
