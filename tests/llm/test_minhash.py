import itertools
import random
import re

import numpy as np

from corpusloom.llm.components import components
from corpusloom.llm.minhash import by_prefix, least_matches, near_duplicates, op8_minhash


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, num=85):
    sets = {i: shingles(t) for i, t in rows}
    part = {i: i for i in sets}

    def find(i):
        while part[i] != i:
            i = part[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            part[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), find(i), find(i) == i) for i in sets}


def corpus(n=160):
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        if i % 4 == 0 or not rows:
            words = [r.choice(vocab) for _ in range(r.choice([1, 4, 5, 30, 120, 400]))]
        else:
            words = (rows[r.randrange(len(rows))][1] or "x").split()
            for _ in range(r.choice([0, 0, 1, 2, 6])):
                words[r.randrange(len(words))] = r.choice(vocab)
        rows.append((i, r.choice([" ", "\n", "\t "]).join(w.upper() if r.random() < 0.2 else w for w in words)))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "é É"), (n + 4, "A"), (n + 5, "a")]


def result(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'x' as sig", "1 as component_id", "2 as n")
    return {tuple(x) for x in near_duplicates(df, **{"threshold": (85, 100)} | more).collect()}


def test_equals_brute_force(spark):
    rows = corpus()
    assert result(spark, rows) == brute(rows)


def test_blocks_of_large_buckets(spark):
    rows = corpus()
    assert result(spark, rows, block=3) == brute(rows)


def test_repeated_rows_and_empty_table(spark):
    assert result(spark, [(2, "a b"), (2, "a b"), (1, "A b")]) == {(1, 1, 1, True), (2, 1, 1, False)}
    assert result(spark, []) == set()


def test_bounds_rise_and_keep_certain_pairs():
    bounds = least_matches(96, 16, 0.85, 1e-5)
    assert [m for m, _ in bounds] == [16, 32, 48, 64, 80, 96]
    assert all(x < m for m, x in bounds) and all(a[1] < b[1] for a, b in zip(bounds, bounds[1:]))


def test_similar_sets_meet_by_prefix(spark):
    r = np.random.default_rng(4)
    common = r.integers(0, 2**62, 40)
    sets = {}
    for i in range(120):
        base = sets[int(r.integers(i))] if i and r.random() < 0.6 else np.concatenate([common, r.integers(0, 2**62, int(r.integers(5, 80)))])
        gone = r.random(len(base)) < r.choice([0, 0.05, 0.1])
        sets[i] = np.unique(np.concatenate([base[~gone], r.integers(0, 2**62, int(r.integers(0, 4)))]))
    part = {i: int(r.integers(0, 3)) for i in sets}
    df = spark.createDataFrame([(i, part[i], bytearray(x.astype(np.uint64).tobytes())) for i, x in sets.items()], "doc_id long, part long, shingles binary")
    groups = {}
    rows = by_prefix(df, 80, 100).collect()
    for x in rows:
        groups.setdefault(x["key"], set()).add(x["doc_id"])
    met = {frozenset(p) for g in groups.values() for p in itertools.combinations(sorted(g), 2)}
    similar = {frozenset((a, b)) for a, b in itertools.combinations(sets, 2) if part[a] != part[b] and 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    assert len(similar) > 20 and similar <= met
    # what many sets share is not among their rarest
    assert max(map(len, groups.values())) < 30


def test_blocks_of_large_prefix_groups(spark):
    rows = corpus()
    assert result(spark, rows, block=2) == brute(rows)
    assert result(spark, rows, weight=60) == brute(rows)


def test_components_of_a_large_star(spark):
    r = random.Random(1)
    links = [(0, i) for i in range(1, 400)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, 39), (5000, 1003)] + [(r.randrange(400), 7000) for _ in range(50)]
    part = {i: i for e in links for i in e}
    for _ in range(60):
        for a, b in links:
            part[a] = part[b] = min(part[a], part[b])
    for few in (1, 10**6):
        assert {tuple(x) for x in components(spark.createDataFrame(links, "a long, b long"), few=few).collect()} == set(part.items())


def test_the_query_and_very_long_texts(spark, tmp_path):
    r = random.Random(6)
    long = " ".join(f"w{r.randrange(10**5)}" for _ in range(100_000))
    rows = [*corpus(80), (900, long), (901, long + " end"), (902, long)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {tuple(x) for x in op8_minhash(spark, str(tmp_path)).collect()} == brute(rows)
