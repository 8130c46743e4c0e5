import random
import zlib
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

from corpusloom.llm import rollups as rl


def test_query_equals_recount(spark, tmp_path):
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(["the", "naïve", "日本", "x1"]) for _ in range(r.randrange(80))), r.choice(["en", None, "fr"]), r.choice(["a", "b", None]), 1, 1) for i in range(200)]
    rows += [(None, "null id", "en", "a", 1, 1), (5, None, "en", "a", 1, 1), rows[10]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, sign int, tokenizer int").write.parquet(f"{tmp_path}/documents.parquet")
    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ranks = rl.rank_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    want = {}
    for i, t, lang, source, *_ in rows:
        k = zlib.crc32(str(i).encode() if i is not None else b"") % 10
        if k == 1:
            continue
        if k == 0 and t is not None:
            t = f"{t} {t[:200]}"
        n = 0 if t is None else len(ranks(t)) if k == 2 else len(hf.encode(t, add_special_tokens=False).ids)
        c = want.setdefault((source, lang, "byte_bpe_multi_50k" if k == 2 else "byte_bpe_50k"), Counter())
        c["docs"] += 1
        c["tokens"] += n
    got = {tuple(x)[:3]: (x["n_docs"], x["n_tokens"]) for x in rl.op10_rollups(spark, str(tmp_path)).collect()}
    assert got == {k: (c["docs"], c["tokens"]) for k, c in want.items()}


def counts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, tokenizer string, n_tokens long")


def test_batches_count_once(spark, tmp_path):
    rollup = rl.Rollup(spark, f"file://{tmp_path}/rollup")
    assert rollup.totals().collect() == []
    a, b = counts(spark, [(1, "s", "en", "v1", 5), (2, "s", "en", "v1", 7)]), counts(spark, [(2, "s", "en", "v1", 9)])
    assert rollup.commit("one/α", rl.signed(a, None)) and not rollup.commit("one/α", rl.signed(a, None))
    assert rollup.commit("two", rl.signed(b, a.where("doc_id = 2")))
    assert [tuple(x) for x in rollup.totals().collect()] == [("s", "en", "v1", 2, 14)]
    assert rollup.compact() and not rollup.commit("two", rl.signed(b, None))
    assert rollup.commit("three", rl.signed(None, counts(spark, [(1, "s", "en", "v1", 5)]))) and rollup.compact()
    assert [tuple(x) for x in rollup.totals().collect()] == [("s", "en", "v1", 1, 9)]
    assert rollup.commit("four", rl.signed(None, b)) and rollup.totals().collect() == []


def test_a_second_writer_loses(spark, tmp_path):
    rollup = rl.Rollup(spark, f"file://{tmp_path}/rollup")
    rows = rl.signed(counts(spark, [(1, "s", "en", "v1", 5)]), None)
    rl.delta(rows).write.parquet(f"{tmp_path}/rollup/_new-other")
    assert rollup.commit("one", rows) and not rollup._publish("_new-other", rollup._folder("one"))
    assert [tuple(x) for x in rollup.totals().collect()] == [("s", "en", "v1", 1, 5)]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert rl.op10_rollups(spark, str(tmp_path)).collect() == []


def test_very_long_texts_and_runs_of_white_space(spark, tmp_path):
    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["word " * 200_000, "x" + " " * 1_000_000 + "a", "\n" * 1_000_000 + "b c", "end" + "\t" * 1_000_000]
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {x["doc_id"]: x["n_tokens"] for x in rl.token_counts(df, "v", public_tokenizers.path("byte_bpe_50k.json")).collect()}
    assert got == {i: len(hf.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    # the same vocabulary as ranks: what takes the place of the library's own there
    ranks = rl.rank_file(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert [ranks(t) for t in texts] == [hf.encode(t, add_special_tokens=False).ids for t in texts]
