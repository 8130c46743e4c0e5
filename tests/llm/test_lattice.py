import random

import pytest
import sentencepiece

from corpusloom.llm import lattice


def texts():
    r = random.Random(6)
    words = ["hello", "ﬁ", "①x", "naïve", "日本語", "unbelievable", "\n", "\t", "a b", "  ", "   ", "<s>", "▁x", "foo_bar", "12345", "ÄÖ", "　"]
    out = [r.choice([" ", "", "  "]).join(r.choice(words) for _ in range(r.randrange(1, 30))) for _ in range(150)]
    return out + [None, "", " ", "\n", "x" * 500, " " * 70, "abcdefghij" * 20, "é" * 33]


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=lattice.default_model())


def test_ids_are_the_librarys(spark, sp):
    rows = [(i if i else None, t, 1, "x") for i, t in enumerate(texts())] + [(3, texts()[3], 1, "x")]
    got = lattice.encode(spark.createDataFrame(rows, "doc_id long, text string, ids int, unit string")).collect()
    want = sorted((i or -1, sp.encode(t or "")) for i, t, *_ in rows)
    assert sorted((x["doc_id"] or -1, list(x["ids"])) for x in got) == want
    assert all(x["round_trip"] for x in got)


@pytest.mark.parametrize("size", [300_000])
def test_very_long_texts(spark, sp, size):
    r = random.Random(8)
    rows = [(0, " ".join(r.choice(["hello", "wörld", "日本語", "a-b/c?d=1", "xyz" * 40]) for _ in range(size // 8))), (1, "ab" * size), (2, " " * size)]
    got = lattice.encode(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x["doc_id"]: list(x["ids"]) for x in got} == {i: sp.encode(t) for i, t in rows} and all(x["round_trip"] for x in got)


def test_the_query(spark, sp, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts())]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = lattice.op2_sentencepiece(spark, str(tmp_path)).collect()
    assert sorted((x["doc_id"], list(x["ids"]), x["round_trip"]) for x in got) == [(i, sp.encode(t or ""), True) for i, t in rows]


def test_decode_is_a_round_trip(spark):
    rows = [(i, (t or "").replace("▁", "")) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert dict(map(tuple, lattice.decode(lattice.encode(df)).collect())) == dict(rows)


def test_long_units_take_the_same_merges(sp):
    known = lattice.Known(lattice.piece_rows(lattice.default_model()), "bpe")
    for t in texts():
        for u in (t or "").split():
            assert known.merge_long("▁" + u.replace("▁", "")) == sp.encode(u.replace("▁", "")) or not u.replace("▁", "")


def test_words_by_splitting_are_those_of_the_pattern():
    for t in texts():
        w = lattice.Words()
        numbers, names = list(w.of(t or "")), w.listed()
        assert "".join(names[i] for i in numbers) == (lattice.MARK + t.replace(" ", lattice.MARK) if t else "")
        assert all(len(lattice.WORD.findall(x)) <= 2 for x in names)


def test_no_piece_crosses_units(monkeypatch):
    pieces = [p for p, _, _, b in lattice.piece_rows(lattice.default_model()) if b < 0]
    joined = lattice.neighbours(pieces)
    assert all(lattice.units([p], joined) == ([1], [p]) for p in pieces)
    count, found = lattice.units(["▁foo_bar12", "日本語", "\n\n"], joined)
    assert "".join(found) == "▁foo_bar12日本語\n\n" and sum(count) == len(found) > 5
    assert lattice.units([], joined) == ([], [])
    some = [*words_of(texts()), "a😀b", "é"]
    quick = lattice.units(some, joined)
    monkeypatch.setattr(lattice, "TABLE", 0)
    assert lattice.units(some, joined) == quick


def words_of(texts):
    return [w for t in texts for w in lattice.WORD.findall(lattice.MARK + (t or "").replace(" ", lattice.MARK))]


def test_viterbi_has_the_best_sum(spark):
    scores = {"a": -1.0, "b": -1.0, "ab": -2.5, "abc": -2.2, "c": -1.5, "bc": -0.9}
    rows = [(p, i, s, -1) for i, (p, s) in enumerate(scores.items())] + [(f"<0x{b:02X}>", 10 + b, 0.0, b) for b in range(256)]
    pieces = spark.createDataFrame([(*r, 0) for r in rows], "piece string, id int, score double, byte int, place long")
    of = spark.createDataFrame([(w, len(w), 0, i) for i, w in enumerate(["abc", "abab", "cab", "abz"])], "unit string, n int, bucket int, u long")
    known = lattice.Known(rows, "unigram")
    got = {x["unit"]: known.from_tokens(x["unit"], x["cuts"], x["tokens"]) for x in lattice.viterbi(of, pieces, 3).collect()}
    assert got == {"abc": [0, 5], "abab": [0, 1, 0, 1], "cab": [4, 0, 1], "abz": [0, 1, 10 + ord("z")]}
    assert got == {u: known.viterbi_long(u) for u in got}


def test_small_chunks(spark, sp, monkeypatch):
    monkeypatch.setattr(lattice, "CHUNK_ROWS", 7)
    rows = [(i, t) for i, t in enumerate(texts())]
    got = lattice.encode(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x["doc_id"], list(x["ids"])) for x in got) == [(i, sp.encode(t or "")) for i, t in rows]


def test_empty_table(spark):
    assert lattice.encode(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_units_follow_the_model(spark, monkeypatch):
    rows = [(0, "unbelievablyconsequential"), (1, "x" * 29), (2, "日本語ﬁnaïve"), (3, "abcabcabcfoo_bar12345")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ids = lambda model: {x["doc_id"]: list(x["ids"]) for x in lattice.encode(df, model=model).collect()}
    folded = ids("unigram")
    monkeypatch.setattr(lattice, "LONG", 0)
    assert ids("unigram") == folded


def test_round_trip_sees_ids_in_wrong_places(spark, monkeypatch):
    rows = [(0, "one two three"), (1, "same same"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(x["round_trip"] for x in lattice.encode(df).collect())
    whole = lattice.filled

    def turned(chunk, answers):
        x = whole(chunk, answers)
        ids = [i[::-1] for i in x.column("ids").to_pylist()]
        return x.set_column(1, "ids", lattice.pa.array(ids, x.schema.field("ids").type))

    monkeypatch.setattr(lattice, "filled", turned)
    assert {x["doc_id"]: x["round_trip"] for x in lattice.encode(df).collect()} == {0: False, 1: True, 2: True, 3: True}
