import random
import zlib
from collections import Counter

import numpy as np

from corpusloom.llm.packing import best_fit, cut, improved, op3_packing, packed, places, steps
from corpusloom.llm.tokens import default_path, encoder


def test_cut():
    assert cut(1, 8) == [(0, 1)] and cut(8, 8) == [(0, 8)]
    assert cut(9, 8) == [(0, 1), (1, 8)] and cut(16, 8) == [(0, 8), (8, 8)]


def pieces(bins):
    return sum((Counter({n: m}) for p, m in bins.items() for n in p), Counter())


def test_search_keeps_pieces_and_never_needs_more_bins():
    r = random.Random(1)
    for _ in range(60):
        counts = {r.randrange(1, 65): r.randrange(1, 9) for _ in range(r.randrange(1, 25))}
        start = best_fit(counts, 64)
        end = improved(start, 64, 500)
        assert pieces(start) == pieces(end) == Counter(counts)
        assert all(sum(p) <= 64 for p in end) and sum(end.values()) <= sum(start.values())
        square = lambda b: sum(sum(p) ** 2 * m for p, m in b.items())
        assert square(end) >= square(start)


def test_search_empties_bins():
    bins = improved(Counter({(6,): 1, (3, 3): 1, (4, 2): 1, (2, 2): 1}), 10, 100)
    assert sum(bins.values()) == 3
    assert steps((7,), (3, 3), 10) == (2 * 3 * 1 + 2 * 9, (7, 3), (3,))


def test_places_are_gapless():
    bins = Counter({(5, 3): 4, (3, 3): 2, (8,): 3})
    numbers = {}
    for n, lo, hi, _, _ in places(bins):
        numbers.setdefault(n, []).extend(range(lo, hi + 1))
    assert {n: sorted(x) for n, x in numbers.items()} == {n: list(range(c)) for n, c in pieces(bins).items()}


def least_bins(lengths, size):
    """The fewest bins, by trying all partitions (few lengths)."""
    best = [len(lengths)]

    def put(i, fills):
        if len(fills) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(fills)
            return
        for k in range(len(fills)):
            if fills[k] + lengths[i] <= size and fills[k] not in fills[:k]:
                put(i + 1, [*fills[:k], fills[k] + lengths[i], *fills[k + 1 :]])
        put(i + 1, [*fills, lengths[i]])

    put(0, [])
    return best[0]


def test_near_the_optimum_of_small_cases():
    r, more = random.Random(12), 0
    for _ in range(60):
        lengths = sorted((r.randrange(1, 25) for _ in range(r.randrange(1, 11))), reverse=True)
        least, got = least_bins(lengths, 24), sum(improved(best_fit(Counter(lengths), 24), 24, 500).values())
        assert least <= got <= least + 1
        more += got > least
    assert more <= 3


def test_bins_of_many_short_pieces_take_steps():
    start = Counter({(1,) * 90: 3, (2,) * 33 + (1,): 2, (95,): 1, (96,): 1})
    end = improved(start, 100, 100)
    assert pieces(end) == pieces(start) and sum(end.values()) == -(-sum(sum(p) * m for p, m in start.items()) // 100)


def test_a_length_that_all_pieces_have(spark, monkeypatch):
    from corpusloom.llm import base, packing

    monkeypatch.setattr(packing, "GROUP", 7)
    monkeypatch.setattr(base, "SPAN", 3)
    df = spark.createDataFrame([(i, "the the the" if i % 9 else "the " * 40) for i in range(500)], "doc_id long, text string")
    rows = packed(df, size=16).collect()
    seqs = {}
    for x in rows:
        seqs.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for own in seqs.values():
        assert all(a[0] + a[1] == b[0] for a, b in zip(sorted(own), sorted(own)[1:])) and sorted(own)[0][0] == 0 and sum(n for _, n in own) <= 16
    assert len(rows) == sum(len(cut(len(encoder(default_path()).ids("the " * 40)) + 1, 16)) if i % 9 == 0 else 1 for i in range(500))


def test_the_query(spark, tmp_path):
    texts = ["", None, "word " * 3000, "word " * 150_000, "日本語" * 400, *(f"short {i}" for i in range(50))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows, enc = op3_packing(spark, str(tmp_path)).collect(), encoder(default_path())
    want = {(i, p, a, n) for i, t in enumerate(texts) for p, (a, n) in enumerate(cut(len(enc.ids(t or "")) + 1, 1024))}
    assert {(x["doc_id"], x["piece"], x["start"], x["length"]) for x in rows} == want and len(rows) == len(want)
    assert len({x["sequence_id"] for x in rows}) == -(-sum(x["length"] for x in rows) // 1024)


def test_packs_every_token(spark):
    r = random.Random(4)
    texts = [" ".join(r.choice(["the", "of", "naïve", "日本", "42"]) for _ in range(r.choice([0, 1, 20, 300]))) for _ in range(120)] + [None, "", "a <|endoftext|> b", "the " * 500]
    texts += texts[:10]
    df = spark.createDataFrame([(i if i != 7 else None, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, piece int, start int")
    rows = packed(df, size=64).collect()
    enc, seqs, by = encoder(default_path()), {}, {}
    for x in rows:
        seqs.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
        by.setdefault(x["doc_id"], []).append(x)
    for places_ in seqs.values():
        at = 0
        for offset, length in sorted(places_):
            assert offset == at
            at += length
        assert at <= 64
    for i, t in enumerate(texts):
        ids = enc.slow.encode(t or "", add_special_tokens=False).ids + [2]
        assert enc.ids(t or "") == ids[:-1]
        mine = sorted(by[i if i != 7 else None], key=lambda x: x["piece"])
        assert [x["piece"] for x in mine] == list(range(len(mine))) and [(x["start"], x["length"]) for x in mine] == cut(len(ids), 64)
        assert all(x["ids_crc32"] == zlib.crc32(np.array(ids[x["start"] : x["start"] + x["length"]], "<u4").tobytes()) for x in mine)
    total = sum(x["length"] for x in rows)
    assert len(seqs) <= 1.1 * -(-total // 64) + 1


def test_empty_table(spark):
    assert packed(spark.createDataFrame([], "doc_id long, text string")).collect() == []
