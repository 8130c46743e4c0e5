import random
import zlib

import numpy as np
import pyarrow as pa

from corpusloom.llm import toxicity as tox


def rows(n, seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    out = []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randrange(5, 40))]
        insult, group = r.random() < 0.4, r.random() < 0.4
        text += ["clod"] * insult + ["martians"] * group
        r.shuffle(text)
        out.append((" ".join(text), int(insult and group)))
    return out


def test_learns_pairs_that_single_weights_miss():
    data = rows(3000, 1)
    own = lambda d: [b[i:j].astype(np.int64) for b, o in [tox.terms(pa.array([t for t, _ in d]))] for i, j in zip(o, o[1:])]
    model = tox.fitted(own(data), np.array([y for _, y in data], float))
    new = rows(1000, 2)
    s = tox.scores(model, *tox.terms(pa.array([t for t, _ in new])))
    assert np.mean((s >= 0.5) == np.array([y for _, y in new])) > 0.97


def test_terms_of_null_empty_and_case():
    b, o = tox.terms(pa.array(["Foo foo", None, "", "..,", "foo"]))
    assert list(np.diff(o)) == [1, 0, 0, 0, 1] and b[0] == b[1]
    b, o = tox.terms(pa.array([], pa.string()))
    assert len(b) == 0 and list(o) == [0]


def test_query_on_a_small_table(spark):
    data = [(i, t, "x", 1.0) for i, (t, _) in enumerate(rows(1500, 3))] + [(2000, None, "x", 1.0), (2001, "", "x", 1.0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, toxic string, score double")
    labels = spark.createDataFrame([(i, int("clod" in t), 0) for i, (t, _) in enumerate(rows(1500, 3))] + [(None, 1, 0), (5, None, 0), (99999, 1, 1)], "doc_id long, toxic int, quality int")
    model = tox.learned(spark, docs, labels)
    got = {r["doc_id"]: r["score"] for r in tox.scored(docs, model).collect()}
    assert len(got) == 1502 and all(0 <= s <= 1 for s in got.values()) and got[2000] == got[2001]
    held = [i for i in range(1500) if zlib.crc32(str(i).encode()) % 3 == 1]
    truth = ["clod" in t for t, _ in rows(1500, 3)]
    right = [(got[i] >= 0.5) == truth[i] for i in held]
    assert right.count(True) > 0.93 * len(right)


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in tox.scored(docs, tox.learned(spark, docs, labels)).collect()] == [0.5]
    assert tox.scored(docs.limit(0), tox.learned(spark, docs, labels)).collect() == []


def test_the_cut_has_the_best_f1():
    r = np.random.default_rng(3)
    for _ in range(50):
        n = int(r.integers(3, 40))
        y = (r.random(n) < 0.4).astype(float)
        y[0] = 1
        z = np.round(r.normal(y, 1.0), int(r.integers(0, 3)))
        f1 = lambda c: 2 * ((z >= c) & (y == 1)).sum() / ((z >= c).sum() + y.sum())  # noqa: B023, E731
        assert f1(tox.best_cut(z, y)) == max(f1(c) for c in z)


def test_repeated_rows_and_very_long_texts(spark):
    long = " ".join(f"w{i % 300}" for i in range(300_000))
    data = [(i, t) for i, (t, _) in enumerate(rows(600, 4))] + [(700, long), (700, long), (None, long), (701, long + " clod martians")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows(600, 4))] * 2, "doc_id long, toxic int")
    got = [tuple(x) for x in tox.scored(docs, tox.learned(spark, docs, labels)).collect()]
    s = [v for i, v in got if i in (700, None)]
    assert len(got) == 604 and len(s) == 3 and len(set(s)) == 1 and dict(got)[701] > s[0]


def test_the_query(spark, tmp_path):
    data = rows(1200, 5)
    spark.createDataFrame([(i, t) for i, (t, _) in enumerate(data)] + [(None, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, y) for i, (_, y) in enumerate(data)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {x["doc_id"]: x for x in tox.op1_toxicity(spark, str(tmp_path)).collect()}
    held = [i for i in range(1200) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(got) == 1201 and {i for i, x in got.items() if x["held_out"]} == set(held)
    assert all(x["predicted"] == int(x["score"] >= 0.7) for x in got.values())
    found = [got[i]["predicted"] for i in held if data[i][1]]
    clean = [got[i]["predicted"] for i in held if not data[i][1]]
    assert np.mean(found) > 0.9 and np.mean(clean) < 0.05
