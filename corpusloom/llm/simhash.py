"""SimHash fingerprints, in DataFrame functions only.

Terms of a text are its pairs of neighbouring lower-case words, and its last word. Each term's 128-bit hash votes on every bit with the term's weight, the number of times it is there: for
one where the hash has a one, against it elsewhere. The sign of the sum is the fingerprint's bit.

The votes of 4 bits at a time are summed in one long, 16 bits each, over at most 30000 terms; longer
texts have several such sums, which are then taken apart and added up. So whole texts count, and
nothing but additions of longs runs per term.

Null texts are empty; an empty text's only term is the empty word. Ids may be null (they come last)
or repeated (then they are in the order of their texts' hashes); extra columns do not matter. An empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import park, parts, table

BITS, LANES, CHUNK = 128, 4, 30000
#: Different bits that still count as near: near copies of some hundred words differ in 10 to 24 bits, unrelated texts in about 64.
RADIUS = 23
#: Blocks (each 128 / BLOCKS bits), rows that are looked at together; every EVERY-th id is a query.
BLOCKS, LIST, EVERY = 8, 256, 20
STEP = 64 // LANES
MASK = 0x0001000100010001
#: Cells that a range of ids is cut into (at most, in each of STEPS steps); neighbouring cells make a bucket, and rows are ordered within buckets.
SHIFT = 15
CELLS, STEPS = 1 << SHIFT, 4


def terms(text: Column) -> Column:
    return F.split(F.trim(F.lower(text)), r"\s+")


def pairs(words: Column) -> Column:
    """64-bit hashes of neighbouring pairs of words, the last of which stands alone."""
    return F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.xxhash64(a, b))


def voted(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, hi, lo: the fingerprint of each row's text. keys must tell rows apart; no shuffle if rows are dealt by some of them."""
    x = rows.select(*keys, terms(F.col(text)).alias("words")).select(*keys, F.posexplode(pairs(F.col("words"))).alias("pos", "h1"))
    x = x.select(*keys, F.expr(f"pos div {CHUNK}").alias("chunk"), "h1", F.xxhash64("h1").alias("h2"))
    sums = [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(MASK))).alias(f"{h}_{j}") for h in ("h1", "h2") for j in range(STEP)]
    x = x.groupBy(*keys, "chunk").agg(F.count("*").alias("n"), *sums)
    lanes = [F.shiftrightunsigned(f"{h}_{j}", lane * STEP).bitwiseAND(F.lit(0xFFFF)) for h in ("h1", "h2") for lane in range(LANES) for j in range(STEP)]
    x = x.select(*keys, "chunk", "n", F.array(*lanes).alias("ones"))
    # one chunk, as nearly all texts have, needs no addition
    one = F.collect_list(F.struct("n", "ones"))
    x = x.groupBy(*keys).agg(one.alias("chunks"))
    x = x.withColumn("n", F.aggregate("chunks", F.lit(0).cast("long"), lambda a, c: a + c["n"]))
    x = x.withColumn("ones", F.aggregate(F.slice("chunks", F.lit(2), F.size("chunks")), F.col("chunks")[0]["ones"], lambda a, c: F.zip_with(a, c["ones"], lambda p, q: p + q)))
    return x.select(*keys, word(0).alias("hi"), word(64).alias("lo"))


def word(first: int) -> Column:
    """Bits first .. first + 63 of the signs as a long."""
    flags = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.when(F.element_at("ones", i + 1 + first) * 2 > F.col("n"), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(flags, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def as_hex(hi: str, lo: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def likeness(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """The share of equal bits."""
    differ = F.bit_count(F.col(a[0]).bitwiseXOR(F.col(b[0]))) + F.bit_count(F.col(a[1]).bitwiseXOR(F.col(b[1])))
    return 1 - differ / F.lit(float(BITS))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, hi, lo per row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("row", F.monotonically_increasing_id())
    return voted(rows, ["row", "doc_id"], "text").drop("row")


def cell(hi: Column, lo: Column, i: int, blocks: int) -> Column:
    """Block i of the bits, from the left, as a number; blocks do not cross from hi to lo."""
    width = BITS // blocks
    return F.shiftrightunsigned(hi if i * width < 64 else lo, 64 - width - i * width % 64).bitwiseAND(F.lit((1 << width) - 1))


def matches(queries: DataFrame, corpus: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, most: int = LIST) -> DataFrame:
    """hi, lo of each different fingerprint of the queries, near: (doc_id, distance) of each row of the corpus with at most `radius` different bits.

    Two fingerprints within the radius differ in at most radius // blocks bits of one block. So there is
    a table for each block, keyed by it (the block in front); the corpus is in it under its own block, a
    query asks for its block and for all that differ so little from it. The rows of a key come in lists
    of about `most`, and a query is held against such a list at once, so what fails the test is never a
    row, and what is found stays an array. A pair that several tables hold counts in the first of them.
    """
    width, off = BITS // blocks, radius // blocks
    near = [sum(1 << i for i in c) for k in range(off + 1) for c in combinations(range(width), k)]
    key = lambda i: cell(F.col("hi"), F.col("lo"), i, blocks).bitwiseOR(F.lit(i << width))
    flips = F.array(*(F.lit(x).cast("long") for x in near))
    asks = F.flatten(F.transform(F.array(*map(key, range(blocks))), lambda k: F.transform(flips, lambda m: k.bitwiseXOR(m))))
    asked = queries.select("hi", "lo").distinct().select(F.col("hi").alias("qhi"), F.col("lo").alias("qlo"), F.explode(asks).alias("key"))
    rows = corpus.select("doc_id", "hi", "lo", F.explode(F.array(*(key(i) for i in range(blocks)))).alias("key"))
    # at most blocks << width keys, whatever the corpus
    size = rows.groupBy("key").agg(F.count("*").alias("size"))
    part = F.pmod(F.xxhash64("doc_id", "hi", "lo"), F.ceil(F.col("size") / most))
    lists = rows.join(size, "key").groupBy("key", part.alias("part")).agg(F.collect_list(F.struct("doc_id", "hi", "lo")).alias("rows"))
    # merged, not broadcast: on small tables one side would go through the driver, with every list in it
    x = asked.join(lists.hint("merge"), "key").withColumn("t", F.shiftright("key", width))
    distance = lambda r: F.bit_count(F.col("qhi").bitwiseXOR(r["hi"])) + F.bit_count(F.col("qlo").bitwiseXOR(r["lo"]))

    def found(r):
        hi, lo = F.col("qhi").bitwiseXOR(r["hi"]), F.col("qlo").bitwiseXOR(r["lo"])
        first = [(F.col("t") <= i) | (F.bit_count(cell(hi, lo, i, blocks)) > off) for i in range(blocks - 1)]
        return reduce(lambda p, q: p & q, first, distance(r) <= radius)

    x = x.select("qhi", "qlo", F.transform(F.filter("rows", found), lambda r: F.struct(r["doc_id"].alias("doc_id"), distance(r).alias("distance"))).alias("near"))
    return x.where(F.size("near") > 0).groupBy(F.col("qhi").alias("hi"), F.col("qlo").alias("lo")).agg(F.flatten(F.collect_list("near")).alias("near"))


def within(queries: DataFrame, corpus: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All (query_id, doc_id, distance) with at most `radius` different bits. Both sides: doc_id, hi, lo."""
    asked = queries.select(F.col("doc_id").alias("query_id"), "hi", "lo")
    return asked.join(matches(queries, corpus, radius, blocks), ["hi", "lo"]).select("query_id", F.explode("near").alias("n")).select("query_id", "n.doc_id", "n.distance")


def celled(rows: DataFrame, steps: list[list[tuple]]) -> DataFrame:
    """rows (doc_id, hash, ...) with `cell`: a higher one comes earlier in the order of descending ids, then ascending hashes.

    A step: (cell, lo, width, parts) of the cells that it cuts, by id in ranges of that width from lo, or, where
    parts is not 0, by hash in so many ranges. Null ids are below all others.
    """
    (_, lo, width, _), *_ = steps[0]
    by_hash = F.col("parts") - 1 - F.shiftright((F.shiftright("hash", 33) + (1 << 30)) * F.col("parts"), 31)
    by_id = lambda lo, width: F.coalesce(F.floor((F.col("doc_id").cast("double") - lo) / width) + 1, F.lit(0)).cast("long")
    # the first step cuts all ids, as one cell
    x = rows.withColumn("cell", by_id(F.lit(lo), F.lit(width)))
    for step in steps[1:]:
        # a row for each cell that is cut
        x = x.join(F.broadcast(rows.sparkSession.createDataFrame(step, "cell long, lo double, width double, parts long")), "cell", "left")
        place = F.coalesce(F.when(F.col("parts") > 0, by_hash).otherwise(by_id(F.col("lo"), F.col("width"))), F.lit(0)).cast("long")
        x = x.select(*rows.columns, (F.call_function("shiftleft", "cell", F.lit(SHIFT)) + place).alias("cell"))
    return x


def cut(rows: DataFrame) -> tuple[list[list[tuple]], list[tuple[int, int, tuple]], int]:
    """Of rows (doc_id, hash): the steps of celled(), (cell, number of rows, place of its first row) of all cells, lowest first, and the most rows that a bucket should have.

    Cells of the first step have equal widths of ids. Those with too many rows are cut again by the range of ids
    that they really hold, or, where they hold one id (or none), by the range of hashes; so neither a few ids far
    from the others nor an id that many rows have puts them all into one cell. The driver holds one row for each
    cell that has rows: for each step CELLS at most, and some for each task of the cluster.
    """
    lo, hi = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    lo, hi = (0, 0) if lo is None else (lo, hi)
    steps, most = [[(0, float(lo), max(1.0, (float(hi) - float(lo)) / (CELLS - 2)), 0)]], 0
    while True:
        # the first row of a cell: the highest id, and of its rows that with the smallest hash
        top = F.max(F.struct("doc_id", F.bitwise_not("hash").alias("hash"))).alias("top")
        found = celled(rows, steps).groupBy("cell").agg(F.count("*").alias("n"), top, F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).collect()
        most = most or max(64, sum(r["n"] for r in found) // (16 * parts(rows.sparkSession)))
        step, large = [], [r for r in found if r["n"] > most]
        for r in large:
            into = min(max(-(-4 * r["n"] // most), CELLS // len(large)), CELLS - 2)
            same = r["lo"] == r["hi"]
            step.append((r["cell"], 0.0, 1.0, into) if same else (r["cell"], float(r["lo"]), (float(r["hi"]) - float(r["lo"])) / into or 1.0, 0))
        if not step or len(steps) == STEPS:
            return steps, sorted((r["cell"], r["n"], (r["top"]["doc_id"], ~r["top"]["hash"])) for r in found), most
        steps.append(step)


def chained(docs: DataFrame) -> DataFrame:
    """doc_id, text and its hash of every row, with `bucket` and `ghost`: within a bucket, a row is followed by the next one in order.

    The first row of the next lower bucket is there again, as the ghost at the bucket's end; the lowest bucket
    ends with the first row of all. A bucket is some neighbouring cells.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    steps, cells, most = cut(texts.select("doc_id", "hash"))
    buckets, have, tops = [], 0, []
    for c, n, top in cells:
        if not tops or have + n > most:
            tops.append(top)
            have = 0
        have += n
        tops[-1] = top
        buckets.append((c, len(tops) - 1))
    of_cell = spark.createDataFrame(buckets, "cell long, bucket int")
    ghosts = spark.createDataFrame([(*tops[b - 1], b) for b in range(len(tops))], "top long, top_hash long, bucket int")
    own = celled(texts, steps).join(F.broadcast(of_cell), "cell").select("doc_id", "text", "hash", "bucket", F.lit(0).alias("ghost"))
    other = texts.join(F.broadcast(ghosts), texts["doc_id"].eqNullSafe(ghosts["top"]) & (F.col("hash") == F.col("top_hash")))
    # one row for each bucket, of however many equal ones
    other = other.groupBy("bucket").agg(F.first("doc_id").alias("doc_id"), F.min("text").alias("text"), F.first("hash").alias("hash"))
    return own.union(other.select("doc_id", "text", "hash", "bucket", F.lit(1))).repartition(parts(spark), "bucket")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the contract's columns near: for ids divisible by 20, (doc_id, distance) of the other rows within RADIUS bits of the fingerprint, and near_docs, their number."""
    rows = chained(table(spark, sf_dir, "documents").select("doc_id", "text"))
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc_nulls_last("doc_id"), "hash", "text")
    n = F.length("text")
    x = rows.withColumn("following", F.lead("text").over(order)).withColumn("row", F.row_number().over(order))
    k = F.floor(n / 3).cast("int")
    edited = F.when(F.col("ghost") == 0, F.concat(F.substring("text", F.lit(1), n - k), F.substring("following", F.lit(1), k)))
    x = x.select("bucket", "row", "ghost", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    sha = F.sha2(F.col("edited").cast("binary"), 256)
    sha_longs = [F.conv(F.substring(sha, 1 + 16 * i, 16), 16, -10).cast("long").alias(f"sha{i}") for i in range(4)]
    keys = ["bucket", "row", "ghost", "doc_id", "n_chars", *(f"sha{i}" for i in range(4)), "side"]
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("t"))))
    x = x.select("*", *sha_longs).select(*keys[:-1], sides.alias("s")).select(*keys[:-1], "s.*").where("t is not null")
    votes = voted(x, keys, "t")
    both = votes.groupBy(*keys[:-1]).agg(*(F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{c}{s}") for s in (0, 1) for c in ("hi", "lo")))
    by_row = Window.partitionBy("bucket").orderBy("row")
    both = both.withColumn("hi2", F.lead("hi0").over(by_row)).withColumn("lo2", F.lead("lo0").over(by_row)).where("ghost = 0")
    both = park(both.drop("bucket", "row", "ghost"), "prints")
    # every 20th id is a query against all fingerprints
    asked = F.coalesce(F.col("doc_id") % EVERY == 0, F.lit(False))
    prints = both.select("doc_id", F.col("hi0").alias("hi"), F.col("lo0").alias("lo"))
    near = matches(prints.where(asked), prints).select(F.col("hi").alias("hi0"), F.col("lo").alias("lo0"), F.array_sort("near").alias("near"))
    # without the row itself
    own = F.array_position("near", F.struct("doc_id", F.lit(0).alias("distance"))).cast("int")
    others = F.concat(F.slice("near", F.lit(1), own - 1), F.slice("near", own + 1, F.size("near")))
    found = both.where(asked).join(near, ["hi0", "lo0"], "left").select(*both.columns, others.alias("near"))
    both = found.union(both.where(~asked).withColumn("near", F.lit(None).cast(found.schema["near"].dataType)))
    hex_sha = F.lower(F.concat(*(F.lpad(F.hex(f"sha{i}"), 16, "0") for i in range(4))))
    return both.select("doc_id", "n_chars", hex_sha.alias("edited_sha256"), as_hex("hi0", "lo0").alias("fingerprint"), as_hex("hi1", "lo1").alias("edited_fingerprint"), likeness(("hi0", "lo0"), ("hi1", "lo1")).alias("near_edited"), likeness(("hi0", "lo0"), ("hi2", "lo2")).alias("near_next"), F.when(F.col("near").isNotNull(), F.size("near").cast("long")).alias("near_docs"), "near")
