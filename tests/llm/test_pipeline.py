import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import toxicity as tox
from corpusloom.llm.packing import cut
from corpusloom.llm.tokens import default_path, encoder

from .test_minhash import brute as components
from .test_suffix import later_words


def tables(spark, path):
    r = random.Random(11)
    vocab = [f"w{i}" for i in range(800)]
    passage = " ".join(r.choice(vocab) for _ in range(150))
    rows = []
    for i in range(240):
        words = [r.choice(vocab) for _ in range(r.choice([0, 1, 30, 150]))]
        if i % 5 == 1 and words:
            words.insert(len(words) // 2, "clod")
        text = " ".join(words)
        if i % 9 == 0:
            text += " é " + passage + " ü"
        if i % 6 == 2 and i > 20:
            old = rows[i - 20][1].split()
            if old:
                old[r.randrange(len(old))] = "x"
            text = " ".join(old)
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    rows += [(300, None, None, None, None), (301, "", "en", "s", 0)]
    labels = [(i, 1, int("clod" in (t or ""))) for i, t, *_ in rows if i % 4]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.mode("overwrite").parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{path}/labels.parquet")
    return rows


def test_equals_brute_force(spark, tmp_path):
    rows = tables(spark, tmp_path)
    docs, labels = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    score = {x["doc_id"]: x["score"] for x in tox.scored(docs, tox.learned(spark, docs, labels)).collect()}
    left = [(i, t) for i, t, *_ in rows if score[i] < 0.7]
    assert 10 < len(rows) - len(left) < 80
    kept = {i for i, _, _, keep in components(left, 80) if keep}
    left = {i: t or "" for i, t in left if i in kept}
    clean = {int(i): t for i, t in later_words(list(left.items()), 50)}
    clean = {i: t for i, t in clean.items() if t.strip() or t == left[i]}
    assert sum(len(t) < len(left[i]) for i, t in clean.items()) > 3
    got, enc, want = corpus_pipeline.run(spark, str(tmp_path)).collect(), encoder(default_path()), set()
    for i, t in clean.items():
        ids = [*enc.ids(t), 2]
        want |= {(i, p, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for p, (s, n) in enumerate(cut(len(ids), 1024))}
    assert {tuple(x)[:5] for x in got} == want and len(got) == len(want)
    fill = Counter()
    for x in got:
        fill[x["sequence_id"]] += x["length"]
    assert max(fill.values()) <= 1024


def test_stages_keep_the_columns(spark, tmp_path):
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        more = docs.withColumn("row", F.lit("x")).withColumn("rid", F.lit(1)).withColumn("score", F.lit(2)).withColumn("n", F.lit(None).cast("int"))
        assert stage(spark, more, str(tmp_path)).columns == docs.columns


def test_stages_with_empty_tables(spark, tmp_path):
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0


def test_repeated_rows_lose_nothing(spark, tmp_path):
    tables(spark, tmp_path)
    r = random.Random(5)
    said = lambda n: " ".join(f"v{r.randrange(10**6)}" for _ in range(n))
    a, b, c, long = said(120), said(90), said(20), said(60_000)
    rows = [(1, a), (1, a), (1, b), (2, c), (2, None), (None, said(80)), (None, None), (None, None), (3, ""), (3, ""), (4, long), (None, long)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = lambda df: Counter((x["doc_id"], x["text"] or "") for x in df.collect())
    all_rows = Counter((i, t or "") for i, t in rows)
    once = all_rows - Counter([(1, a), (None, long)])
    near, repeats = (dict(corpus_pipeline.STAGES)[x] for x in ("near_duplicates", "repeats"))
    assert left(near(spark, docs, str(tmp_path))) == once
    assert left(repeats(spark, docs, str(tmp_path))) == once
    own = spark.read.parquet(f"{tmp_path}/documents.parquet")
    twice = left(corpus_pipeline.toxicity(spark, own.union(own), str(tmp_path)))
    assert 150 < len(twice) < 242 and all(n % 2 == 0 for n in twice.values())
    packed = corpus_pipeline.pack(spark, docs, str(tmp_path)).collect()
    assert sum(x["start"] == 0 for x in packed) == len(rows)


def test_passages_go_but_for_the_first_copy(spark, tmp_path):
    r = random.Random(6)
    said = lambda n: " ".join(f"v{r.randrange(1000)}" for _ in range(n))
    passage, start = said(51), [said(40) for _ in range(4)]
    assert len(passage) < 400
    docs = spark.createDataFrame([(9 - i, f"{x} {passage} end", "en", "s", 1) for i, x in enumerate(start)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {x["doc_id"]: x["text"] for x in corpus_pipeline.repeats(spark, docs, "").collect()}
    assert got == {9 - i: f"{x} {passage} end" if i == 3 else f"{x} " for i, x in enumerate(start)}
