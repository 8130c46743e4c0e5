import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import suffix


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        covered = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                covered[i : i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~covered])
        spans = int((np.diff(np.concatenate([[0], covered.astype(np.int8)])) == 1).sum())
        out.append((len(b), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(n=60):
    r = random.Random(5)
    vocab = ["é", "ab", "a", "bc ", "ño", "x", "\n"]
    texts = []
    for i in range(n):
        t = "".join(r.choice(vocab) for _ in range(r.randrange(10, 400)))
        for _ in range(r.randrange(3)):
            o = r.choice(texts) if texts else ""
            a = r.randrange(len(o) + 1)
            t += o[a : a + r.randrange(10, 200)]
        texts.append(r.choice(texts) if texts and r.random() < 0.15 else t)
    return texts + [None, "", "a" * 500, "ab" * 300, "b" * 63]


def result(spark, texts, length, gram, **more):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, rid int, sha string")
    rule = suffix.Rule("bytes", length, gram)
    t = suffix.texts_of(df, [rule])
    spans = suffix.repeated_spans(t, suffix.copies_of(t), [rule], **more)
    cut = {x["rid"]: x for x in suffix.kept_text(t.select("rid", "packed"), spans, rule, False).collect()}
    return sorted((x["n_bytes"], *((c["n_removed"], c["n_spans"], c["kept_sha256"]) if (c := cut.get(x["rid"])) else (0, 0, x["sha"].hex()))) for x in t.collect())


@pytest.mark.parametrize("split", [2000, 3])
def test_equals_brute_force(spark, split):
    texts = corpus()
    assert result(spark, texts, 64, 16, split=split) == brute(texts, 64)


def test_long_documents_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix, "CHUNK", 150)
    monkeypatch.setattr(suffix, "SEEN", 3)
    texts = corpus(20)
    assert result(spark, texts, 40, 8) == brute(texts, 40)


def later_words(rows, length, first=True):
    """Per row the text without the words of strings of `length` words that are elsewhere too; with first, that are earlier too, by id and row."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    words = [list(re.finditer(r"[^\x20\x09-\x0D]+", t or "")) for _, t in rows]
    strings = lambda i: [tuple(w[0] for w in words[i][k : k + length]) for k in range(len(words[i]) - length + 1)]
    times, seen, out = Counter(s for i in order for s in strings(i)), set(), {}
    for i in order:
        gone = [False] * len(words[i])
        for k, s in enumerate(strings(i)):
            if s in seen if first else times[s] > 1:
                gone[k : k + length] = [True] * length
            seen.add(s)
        text, at = rows[i][1] or "", 0
        kept = ""
        for k, w in enumerate(words[i]):
            if gone[k]:
                kept += text[at : w.start()] if not k or not gone[k - 1] else ""
                at = w.end()
        out[i] = kept + text[at:]
    return sorted((repr(rows[i][0]), t) for i, t in out.items())


def word_corpus(seed=4):
    r = random.Random(seed)
    vocab = ["é", "ab", "a", "bc", "ño", "x"]
    rows = []
    for i in range(70):
        t = r.choice([" ", "\n", "\t "]).join(r.choice(vocab) for _ in range(r.randrange(0, 60)))
        for _ in range(r.randrange(3)):
            o = (r.choice(rows)[1] if rows else "").split()
            a = r.randrange(len(o) + 1)
            t += " " + " ".join(o[a : a + r.randrange(5, 40)])
        rows.append((r.choice([i, i, 100 - i, None]), r.choice(rows)[1] if rows and r.random() < 0.15 else t))
    return rows + [(7, "a " * 100), (7, "a " * 100), (None, "a " * 50), (1, ""), (1, " \n")]


@pytest.mark.parametrize(("split", "keep"), [(2000, "first"), (2, "first"), (2, "none")])
def test_words_equal_brute_force(spark, split, keep):
    rows = word_corpus()
    # one partition, so that rows of one id are in this order
    df = spark.createDataFrame([(*x, 1, "x", 2) for x in rows], "doc_id long, text string, rid int, sha string, d int").coalesce(1)
    got = suffix.without_repeats(df, rule=suffix.Rule("words", 8, 3), split=split, keep=keep).collect()
    assert sorted((repr(x["doc_id"]), x["text"]) for x in got) == later_words(rows, 8, keep == "first")


def test_words_of_long_documents_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix, "CHUNK", 40)
    rows = word_corpus(5)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = suffix.without_repeats(df, rule=suffix.Rule("words", 8, 3)).collect()
    assert sorted((repr(x["doc_id"]), x["text"]) for x in got) == later_words(rows, 8)


def test_passages_of_51_words_under_400_bytes(spark):
    passage = " ".join(f"w{i % 9}x{i}" for i in range(51))
    assert len(passage) < 400
    rows = [(1, "one " + passage + " end"), (2, passage), (3, "three " + passage), (4, passage[:200] + " other")]
    got = {x["doc_id"]: x["text"] for x in suffix.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "", 3: "three ", 4: rows[3][1]}


def test_the_query(spark, tmp_path):
    r = random.Random(9)
    said = lambda n: " ".join(f"{r.randrange(10**6)}" for _ in range(n))
    passage, long = said(52), said(90)
    texts = [said(100) + " " + passage, passage + " " + said(5), long, said(9) + long, long, None, "", said(60), "é" * 500 + passage[:-1]]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = suffix.op5_suffix(spark, str(tmp_path)).collect()
    assert sorted((x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got) == brute(texts, 400)
    assert {x["doc_id"]: (x["n_passages"], x["n_passage_words"]) for x in got} == {0: (1, 52), 1: (1, 52), 2: (1, 90), 3: (1, 89), 4: (1, 90), 5: (0, 0), 6: (0, 0), 7: (0, 0), 8: (1, 50)}


def test_empty_table(spark):
    assert result(spark, [], 64, 16) == []


def test_whole_characters_stay(spark):
    texts = ["é" * 40 + "x", "y" + "é" * 40 + "è"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["text"] for x in suffix.without_repeats(df, rule=suffix.Rule("bytes", 33, 8), keep="none").collect()}
    assert got[0] == "x" and got[1][0] == "y" and got[1][-1] == "è"


def test_order_is_the_suffix_order():
    r = random.Random(2)
    for _ in range(50):
        length = r.choice([9, 24, 40])
        segs = [bytes(r.choice(b"ab") for _ in range(r.randrange(length, length + 60))) for _ in range(5)]
        segs += [segs[0][3:] + segs[1], segs[2] * 2]
        segs = [s for s in segs if len(s) >= length]
        data, ends = np.frombuffer(b"".join(segs), np.uint8), np.cumsum([len(s) for s in segs])
        order, twice, _ = suffix.repeated_windows(data, ends, length)
        windows = [data[i : i + length].tobytes() for i in order]
        count = Counter(windows)
        assert windows == sorted(windows) and [count[w] > 1 for w in windows] == twice.tolist()
