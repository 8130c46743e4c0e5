import hashlib
import random

import xxhash
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm import simhash


def texts(n=60):
    r = random.Random(9)
    vocab = [f"w{i}" for i in range(50)] + ["É", "日本", "😀"]
    return [" ".join(r.choice(vocab) for _ in range(r.choice([0, 1, 3, 40, 200]))) for _ in range(n)] + [None, "", "  \n", "x" * 3000]


def likeness(a, b):
    return 1 - bin(int(a, 16) ^ int(b, 16)).count("1") / 128


def run(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string, bucket int, side int").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return simhash.op9_simhash(spark, str(tmp_path)).collect()


def test_query_equals_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 64)
    rows = [(i * 7 - 100, t, 1, 1) for i, t in enumerate(texts())]
    twin = max(rows[:60], key=lambda x: len(x[1]))
    rows += [twin, (None, "last of all", 1, 1)]
    got = sorted(run(spark, rows, tmp_path), key=lambda x: (x["doc_id"] is None, -(x["doc_id"] or 0), x["edited_sha256"]))
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0)))
    assert len(got) == len(order)
    prints = {}
    for i, (doc_id, text, *_) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 3
        sha = hashlib.sha256((text[: len(text) - k] + following[:k]).encode()).hexdigest()
        x = next(x for x in got if x["doc_id"] == doc_id and x["edited_sha256"] == sha)
        assert x["n_chars"] == len(text) and prints.setdefault(text, x["fingerprint"]) == x["fingerprint"]
        assert abs(x["near_edited"] - likeness(x["fingerprint"], x["edited_fingerprint"])) < 1e-9
        if doc_id is not None and order[(i + 1) % len(order)][0] is not None:
            after = next(y for y in got if y["doc_id"] == order[(i + 1) % len(order)][0])
            assert abs(x["near_next"] - likeness(x["fingerprint"], after["fingerprint"])) < 1e-9


    for x in got:
        near = sum(likeness(x["fingerprint"], y["fingerprint"]) >= 1 - 3 / 128 for y in got) - 1
        assert x["near_docs"] == (near if x["doc_id"] is not None and x["doc_id"] % 20 == 0 else None)


def test_chunks_do_not_change_votes(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    whole = {tuple(x) for x in simhash.fingerprints(df).collect()}
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert {tuple(x) for x in simhash.fingerprints(df).collect()} == whole


def test_one_document_and_none(spark, tmp_path):
    (x,) = run(spark, [(40, "a b c d e f", 0, 0)], tmp_path)
    assert x["near_next"] == 1.0 and x["n_chars"] == 11 and x["near_docs"] == 0
    assert run(spark, [], tmp_path) == []


def test_block_tables_find_all_within_the_radius(spark):
    r = random.Random(1)
    base = [r.getrandbits(128) for _ in range(20)]
    prints = base + [b ^ sum(1 << i for i in r.sample(range(128), r.randrange(6))) for b in base for _ in range(5)] + base[:3]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(i, signed(p >> 64), signed(p & ((1 << 64) - 1))) for i, p in enumerate(prints)]
    df = spark.createDataFrame(rows, "doc_id long, hi long, lo long")
    found = [tuple(x) for x in simhash.within(df.where("doc_id % 2 = 0"), df, 3).collect()]
    got = set(found)
    assert len(got) == len(found)
    want = {(i, j, d) for i, p in enumerate(prints) for j, q in enumerate(prints) if i % 2 == 0 and (d := bin(p ^ q).count("1")) <= 3}
    assert got == want


def test_query_keeps_the_near_copies_of_ordinary_texts(spark, tmp_path):
    r = random.Random(4)
    rows = []
    for i in range(12):
        words = [f"v{r.randrange(3000)}" for _ in range(100 + 20 * i)]
        copy = [*words]
        copy[50] = "edited"
        rows += [(40 * i, " ".join(words), 0, 0), (40 * i + 1, " ".join(copy), 0, 0)]
    rows.append((40, rows[2][1], 0, 0))
    got = run(spark, rows, tmp_path)
    prints = [(x["doc_id"], x["fingerprint"]) for x in got]
    for x in got:
        want = [(i, round(128 * (1 - likeness(x["fingerprint"], p)))) for i, p in prints]
        want = sorted(w for w in want if w[1] <= simhash.RADIUS)
        if x["doc_id"] % 20:
            assert x["near"] is None
            continue
        want.remove((x["doc_id"], 0))
        assert [tuple(n) for n in x["near"]] == want and x["near_docs"] == len(want)
        assert x["doc_id"] + 1 in [i for i, _ in want]


def test_probed_blocks_find_all_within_a_wide_radius(spark):
    r = random.Random(2)
    base = [r.getrandbits(128) for _ in range(6)]
    prints = base + [b ^ sum(1 << i for i in r.sample(range(128), r.randrange(18, 28))) for b in base for _ in range(8)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(i, signed(p >> 64), signed(p & ((1 << 64) - 1))) for i, p in enumerate(prints)], "doc_id long, hi long, lo long")
    found = sorted(tuple(x) for x in simhash.within(df.where("doc_id < 6"), df).collect())
    assert found == sorted((i, j, d) for i, p in enumerate(base) for j, q in enumerate(prints) if (d := bin(p ^ q).count("1")) <= simhash.RADIUS)


def follows(spark, rows):
    """(id, text, next text) by the chained buckets."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc_nulls_last("doc_id"), "hash", "text")
    x = simhash.chained(df).withColumn("following", F.lead("text").over(order))
    return x.where("ghost = 0").select("doc_id", "text", "following").collect(), x.groupBy("bucket").count().collect()


def test_buckets_stay_small_whatever_the_ids(spark):
    many = [(i, f"t{i}") for i in range(4000)]
    for rows in (
        [*many, (10**15, "far")],
        [(2**k, f"t{k}") for k in range(62)] + [(-(2**62), "low")] + many,
        many + [(7, f"same id {i}") for i in range(3000)],
        many + [(None, f"no id {i}") for i in range(3000)],
        [(5, f"all {i}") for i in range(3000)],
    ):
        got, sizes = follows(spark, rows)
        signed = lambda t: (h := xxhash.xxh64(t.encode(), seed=42).intdigest()) - (h >> 63 << 64)
        order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), signed(r[1]), r[1]))
        want = [(*r, order[(i + 1) % len(order)][1]) for i, r in enumerate(order)]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
        assert max(r["count"] for r in sizes) <= 4 * max(64, len(rows) // (16 * 4)), sizes


def test_fingerprint_of_a_very_long_text(spark):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    got = {x["doc_id"]: (x["hi"], x["lo"]) for x in simhash.fingerprints(spark.createDataFrame([(0, long), (1, long + " end"), (2, long)], "doc_id long, text string")).collect()}
    assert got[0] == got[2] and sum(bin((a ^ b) & (2**64 - 1)).count("1") for a, b in zip(got[0], got[1])) < 8
