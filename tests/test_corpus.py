import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import align, batch, context, markup, pack, progress, render, segment, translations, validate
from corpusloom.schemas import SEGMENT

BOOK = "# 書名\n\n前書き。\n## 第一章\n　一行目。\n二行目。\n\n三行目。\n# 後\n末\n"


def book(spark, *texts):
    return spark.createDataFrame([(f"b{i}", t) for i, t in enumerate(texts)], "book_id string, text string")


def segmented(spark, text, cap=30, **more):
    return [(r["id"], r["kind"], r["source"]) for r in segment.segment(book(spark, text), cap, **more).orderBy("pos").collect()]


def test_page_markers(spark):
    rows = segment.clean_pages(book(spark, "a  \r\n[Page 1]\r\n b\n [PAGE 22] \n\n", "[Page １２]", "x [Page 1]", "")).orderBy("book_id").collect()
    assert [(r["text"], r["removed"]) for r in rows] == [("a\n b\n", 2), ("\n", 1), ("x [Page 1]\n", 0), ("\n", 0)]


def test_segments(spark):
    assert segmented(spark, BOOK) == [
        ("front-p0001", "book_title", "# 書名"),
        ("front-p0002", "paragraph", "前書き。"),
        ("ch001-p0001", "heading", "## 第一章"),
        ("ch001-p0002", "paragraph", "一行目。\n二行目。"),
        ("ch001-p0003", "paragraph", "三行目。"),
        ("ch001-p0004", "heading", "# 後"),
        ("ch001-p0005", "paragraph", "末"),
    ]
    assert [k for _, k, _ in segmented(spark, "# a\n# b\n#題\n####### x\n#　z\n")] == ["book_title", "book_title", "paragraph", "book_title"]
    assert segmented(spark, "x" * 90)[0][2] == "x" * 90
    assert segmented(spark, "") == [] and segmented(spark, "[Page 1]") == []
    assert segmented(spark, "[Page 1]", strip_page_markers=False) == [("front-p0001", "paragraph", "[Page 1]")]
    with pytest.raises(ValueError, match="positive"):
        segmented(spark, "", 0)


def reference_pack(lines, cap):
    """The rule as it reads: the trimmed buffer with the next line must not be over the cap."""
    trim = lambda b: b[next((i for i, x in enumerate(b) if x), len(b)) : max((i for i, x in enumerate(b) if x), default=-1) + 1]
    out, buffer = [], []
    for x in lines:
        if buffer and len("\n".join(trim([*buffer, x])).encode()) > cap and trim(buffer):
            out.append(buffer)
            buffer = []
        buffer.append(x)
    return [s for b in [*out, buffer] if (s := "\n".join(b).strip())]


def test_packing_of_lines_follows_the_rule(spark):
    r = random.Random(2)
    for _ in range(4):
        lines = [r.choice(["", "", "a", "漢字", "x" * 12, "　in"]) for _ in range(60)]
        assert [s for _, _, s in segmented(spark, "\n".join(lines), 25)] == reference_pack(lines, 25)


def segs(spark, sizes, chapters=None):
    rows = [("b", i, f"s{i}", (chapters or ["c"] * len(sizes))[i], i, "paragraph", "x" * n, "imported") for i, n in enumerate(sizes)]
    return spark.createDataFrame(rows, SEGMENT)


def test_batches(spark):
    x = batch.batch_items(segs(spark, [3, 4, 5, 1, 9, 2]), 8, 3)
    assert [r["pack"] for r in x.orderBy("pos").collect()] == [1, 1, 2, 2, 3, 4]
    rows = batch.batches(batch.batch_items(batch.chapter_runs(segs(spark, [3, 4, 5, 1], ["a", "a", "b", "a"])), 20, 3, run="run"), run="run").orderBy("order").collect()
    assert [(r["batch_id"], r["order"], r["chapter_order"], r["segment_ids"]) for r in rows] == [("a-b001", 1, 1, ["s0", "s1"]), ("b-b001", 2, 1, ["s2"]), ("a-b002", 3, 2, ["s3"])]
    assert rows[0]["source_text"] == "[s0 | paragraph]\nxxx\n\n[s1 | paragraph]\nxxxx" and rows[0]["char_count"] == 7
    assert [r["pack"] for r in batch.batch_items(segs(spark, [3, 3, 3]), 100, 10, 6).orderBy("pos").collect()] == [1, 1, 2]
    assert tuple(batch.batch_stats(batch.batches(batch.batch_items(segs(spark, [])))).first()) == (0, 0, 0, 0)
    for bad in ({"max_bytes": 0}, {"max_segments": -1}, {"max_chars": 0}):
        with pytest.raises(ValueError, match="positive"):
            batch.batch_items(segs(spark, [1]), **bad)


def test_packing_state_is_per_group(spark):
    rows = spark.createDataFrame([(g, i, 5) for g in range(50) for i in range(g % 7)], "g int, i int, n int")
    got = pack.numbered(rows, ["g"], ["i"], ["n"], pack.capped(10)).collect()
    assert all(r["pack"] == r["i"] // 2 + 1 for r in got) and len(got) == rows.count()


LEDGER = "append_pos int, segment_id string, translation string, status string, review_note string"


def ledger(spark, *rows):
    return spark.createDataFrame([(i, *r, *[None] * (4 - len(r))) for i, r in enumerate(rows)], LEDGER)


def items(spark):
    return spark.createDataFrame([("b1", 1, "s1"), ("b1", 2, "s2"), ("b2", 3, "s3"), ("b2", 4, "s4"), ("b2", 5, "s5")], "batch_id string, pos int, id string").withColumn("source", F.lit("a")).withColumn("kind", F.lit("paragraph"))


def test_progress(spark):
    led = ledger(spark, ("s1", "x"), ("s2", "x"), ("s4", "x"), ("s5", " 　"))
    done = progress.completed(led)
    assert {r[0] for r in done.collect()} == {"s1", "s2", "s4"}
    (p,) = progress.pending_batches(items(spark), done, ["batch_id"]).collect()
    assert (p["batch_id"], p["missing_count"], p["first_missing_segment_id"], p["last_missing_segment_id"], p["segment_count"]) == ("b2", 2, "s3", "s5", 3)
    assert progress.first_pending(progress.pending_batches(items(spark), done, ["batch_id"]), "first_pos", n=0).collect() == []
    assert tuple(progress.totals(items(spark), led).first()) == (5, 3, 2)
    empty = progress.totals(items(spark).limit(0), led).select(progress.percent_text(F.col("completed"), F.col("segments"))).first()
    assert empty is None or empty[0] == "0.0%"
    order = spark.createDataFrame([(f"b{i}", i) for i in range(9)], "batch_id string, n int")
    assert [r["n"] for r in progress.batch_range(order, "b3", 2, "n").collect()] == [3, 4]
    assert progress.batch_range(order, "zz", 2, "n").collect() == [] and progress.batch_range(order, None, 1, "n").count() == 1


def test_context(spark):
    rows = [("bk", "A", i, f"p{i}", "paragraph", f"s{i}") for i in range(1, 7)] + [("bk", "B", 7, "q1", "paragraph", "s")]
    it = spark.createDataFrame(rows, "book_id string, chapter_id string, pos int, id string, kind string, source string")
    done = spark.createDataFrame([("p1", "t1"), ("p3", "t3"), ("p4", "t4")], "id string, translation string")
    got = lambda first, chapter, n=2: [r["id"] for r in context.previous(it, spark.createDataFrame([("x", "bk", chapter, first)], "batch_id string, book_id string, chapter_id string, first_pos int"), done, n).orderBy("k").collect()]
    assert got(5, "A") == ["p3", "p4"] and got(2, "A") == ["p1"] and got(7, "B") == [] and got(5, "A", 0) == []
    with pytest.raises(ValueError):
        got(5, "A", -1)


def test_last_done_frames(spark):
    r = random.Random(4)
    rows = [(k, i, r.random() < 0.4 if r.random() < 0.9 else None, None if r.random() < 0.1 else f"v{i}") for k in range(3) for i in range(40)]
    x = spark.createDataFrame(rows, "k int, i int, d boolean, v string")
    for n in (0, 1, 3):
        for row in context.last_done(x, ["k"], "i", "d", "v", n).collect():
            want = [v for k, i, d, v in rows if k == row["k"] and i < row["i"] and d][-n:] if n else []
            assert row["context"] == want


IMG = "⟦EPUB_IMG:i|alt=⟧"


def test_normalisation(spark):
    rows = [
        ("a\nb", " x\r\ny ", None, None, None, "x\ny", "translated", None),
        ("a", " ", None, None, "empty translation", " ", None, None),
        ("a", None, None, None, "empty translation", None, None, None),
        ("a\nb", "xy", None, None, "line break count differs", "xy", None, None),
        ("a" + IMG, "x", None, None, "image placeholders differ", "x", None, None),
        ("a", "x", "draft", None, "unsupported status", "x", "draft", None),
        ("a", "x", "needs_review", " ", "needs_review without review_note", "x", "needs_review", None),
        ("a", "x", "needs_review", " n ", None, "x", "needs_review", "n"),
    ]
    df = spark.createDataFrame([(i, *r[:4]) for i, r in enumerate(rows)], "i int, source string, translation string, status string, review_note string")
    got = translations.normalized(df).orderBy("i").collect()
    assert [(g["error"], g["translation"], g["status"]) for g in got] == [r[4:7] for r in rows] and got[-1]["review_note"] == "n"


def test_exact_cover(spark):
    exp = spark.createDataFrame([("b", 0, "s1"), ("b", 1, "s2")], "k string, idx int, id string")
    out = lambda *ids: translations.exact_cover(exp, spark.createDataFrame([("b", i, s) for i, s in enumerate(ids)], "k string, pos int, id string"), ["k"]).first()
    assert out("s2", "s1")["ok"] and out("s2", "s1")["reordered"] and not out("s1", "s2")["reordered"]
    assert out("s1")["missing"] == ["s2"] and out("s1", "s2", "s3")["extra"] == ["s3"] and out("s1", "s1", "s2")["duplicate"] == ["s1"]


def test_append_plan(spark):
    s = spark.createDataFrame([(f"s{i}", i, "a") for i in (1, 2, 3)], "id string, pos int, source string")
    led = ledger(spark, ("s1", "x"))
    plan = lambda *ids, **kw: [r["action"] for r in translations.append_plan(ledger(spark, *((i, "t") for i in ids)), s, led, **kw).orderBy("append_pos").collect()]
    assert plan("s2", "s3") == ["append", "append"]
    assert plan("s3", "s2") == ["append", "out of source order"]
    assert plan("s1", "s2") == ["already in the ledger", "append"] and plan("s1", "s2", allow_existing=True) == ["skip", "append"]
    assert plan("s9") == ["unknown segment_id"] and plan("s2", "s2") == ["duplicate segment_id"] * 2 and plan(None) == ["missing segment_id"]


def test_append_plan_in_stretches(spark):
    r = random.Random(3)
    pos = [r.randrange(n, n + 9) for n in range(3000)]
    s = spark.createDataFrame([(f"s{i}", i, "a") for i in range(3009)], "id string, pos int, source string")
    draft = spark.createDataFrame([(n * n, f"s{p}", "t", None, None) for n, p in enumerate(pos)], "append_pos long, segment_id string, translation string, status string, review_note string")
    plan = translations.append_plan(draft.repartition(4), s, ledger(spark, ("s1", "x")).limit(0))
    got = {row["append_pos"]: row["action"] for row in plan.collect()}
    want = ["duplicate segment_id" if pos.count(p) > 1 else "out of source order" if n and p < max(pos[:n]) else "append" for n, p in enumerate(pos)]
    assert [got[n * n] for n in range(3000)] == want and len(set(want)) == 3
    # no task may see the whole draft
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in text.splitlines() if "SinglePartition" in line and "translation" in line]
    assert "windowspecdefinition(append_pos" not in text


def test_validation(spark):
    s = segs(spark, [1, 1])
    validate.enforce(validate.segments(s))
    with pytest.raises(ValueError, match="duplicate id: s0"):
        validate.enforce(validate.segments(s.union(s.where("id = 's0'"))))
    with pytest.raises(ValueError, match="missing keys"):
        validate.enforce(validate.segments(s.withColumn("kind", F.lit(None).cast("string"))))
    rows = batch.batches(batch.batch_items(s))
    validate.enforce(validate.batches(rows))
    with pytest.raises(ValueError, match="differ from segments"):
        validate.enforce(validate.batches(rows.withColumn("segment_ids", F.array(F.lit("z")))))
    with pytest.raises(ValueError, match="segment in two batches"):
        validate.enforce(validate.batches(rows.union(rows.withColumn("batch_id", F.lit("other")))))
    led = ledger(spark, ("s0", "x", "translated"), ("s9", "x", "translated"))
    with pytest.raises(ValueError, match="unknown segment_id: s9"):
        validate.enforce(validate.translations(led, s))
    x = validate.report(s, s.where("id = 's0'"), ledger(spark, ("s0", "x"), ("s0", ""), (None, "x"), ("s9", "x")))
    got = {}
    for r in x.collect():
        got.setdefault(r["issue"], []).append(r["entity_id"])
    assert got == {"duplicate_translation_ids": ["s0"], "empty_translation_ids": ["s0"], "missing_translation_ids": [None], "unmatched_translation_ids": ["s9"], "segments_without_batch": ["s1"]}
    pos = lambda *ids: spark.createDataFrame(list(enumerate(ids, 1)), "n int, id string")
    assert validate.ordered_cover(pos("a", "b"), pos("b", "a")).count() == 2 and validate.ordered_cover(pos("a"), pos("a")).count() == 0


def test_rendering(spark):
    s = spark.createDataFrame([("b", 1, "t", "front", 1, "book_title", "# ## x", ""), ("b", 2, "p1", "front", 2, "paragraph", "a<b>&\"c'\nd", ""), ("b", 3, "p2", "front", 3, "paragraph", "n", ""), ("b", 4, "p3", "front", 4, "paragraph", "z", "")], SEGMENT)
    led = ledger(spark, ("p1", "old"), ("t", "# y"), ("p1", "new", "needs_review", "n"), ("p2", " "))
    rows = render.aligned(s, led)
    assert [(r["id"], r["status"]) for r in rows.orderBy("pos").collect()] == [("t", "translated"), ("p1", "needs_review"), ("p2", "empty"), ("p3", "pending")]
    html = {r["id"]: r["html"] for r in render.rendered(rows, show_metadata=True).collect()}
    assert "<p>a&lt;b&gt;&amp;&quot;c&#x27;<br>\nd</p><p>new</p>" in html["p1"] and "<p>x</p><p>y</p>" in html["t"] and "no batch" in html["p1"]
    assert {r["id"] for r in render.rendered(rows, only_translated=True).collect()} == {"t", "p1", "p2"}
    assert [r["label"] for r in render.contents(rows).collect()] == ["y"]
    assert tuple(render.stats(rows).first()) == (4, 1, 1, 1, 1)
    (page,) = render.documents(rows, "<T>").collect()
    assert page["html"].count("<article") == 4 and "&lt;T&gt;" in page["html"] and page["html"].index('id="t"') < page["html"].index('id="p1"')


def test_alignment(spark):
    a = spark.createDataFrame([(1, "p", "x"), (2, "p", " y　"), (3, "h", "z"), (4, "p", "w")], "k int, kind string, text string")
    b = spark.createDataFrame([(1, "p", "x"), (2, "p", "y"), (3, "p", "z"), (5, "p", "w")], "k int, kind string, text string")
    assert {tuple(r) for r in align.zipped(a, b, ["k"]).collect()} == {(1, "equal"), (2, "equal"), (3, "kind differs"), (4, "only left"), (5, "only right")}
    parts = align.blocks(spark.createDataFrame([("paragraph", "a\n\nb"), ("heading", "c\n\nd")], "kind string, source string"))
    assert [r["block"] for r in parts.orderBy("kind", "part_no").collect()] == ["c\n\nd", "a", "b"]
    same = lambda s, t: spark.range(1).select(align.blank_lines_agree(F.lit(s), F.lit(t))).first()[0]
    assert same("a\n\nb", "x\n\ny") and not same("a\n\nb", "x\ny\n")


def test_tolerant_blocks(spark):
    pages = spark.createDataFrame([(1, "<h1>T</h1><p>a<br>b<p>c &amp; d<script>no</script><li>x"), (2, None), (3, "")], "id int, html string")
    assert [(r["id"], r["tag"], r["text"]) for r in markup.html_blocks(pages, "id", "html").orderBy("id", "block_no").collect()] == [(1, "h1", "T"), (1, "p", "a\nb"), (1, "p", "c & d"), (1, "li", "x")]


def test_batches_as_they_were_written(spark, tmp_path):
    from corpusloom.schemas import BATCH
    from corpusloom.sources import text as S

    good = '{"batch_id": "%s", "chapter_id": "c", "order": 1, "segment_ids": ["a"], "segments": [{"id": "a"}], "source_text": null, "status": null}'
    lines = [good % "b1", (good % "b2").replace('["a"]', '"a"'), (good % "b3").replace('[{"id": "a"}]', '["a"]'), (good % "b4").replace('"status": null', '"other": 1'), (good % "b5").replace('["a"]', "[]").replace('[{"id": "a"}]', "[]")]
    (tmp_path / "b.jsonl").write_text("\n".join(lines))
    rows = S.read_jsonl(spark, str(tmp_path / "b.jsonl"), BATCH).select("fields.*", "keys", "line")
    got = {(r["rule"], r["entity_id"], r["detail"]) for r in validate.batches(rows).collect() if r["rule"].split(": ")[1] in ("not a list", "missing keys")}
    assert got == {("batches: not a list", "b2", "segment_ids"), ("batches: not a list", "b3", "segments"), ("batches: missing keys", "b4", "status")}
    # without the JSON, null fields count as missing
    plain = {(r["entity_id"], r["detail"]) for r in validate.batches(rows.drop("keys", "line")).collect() if r["rule"] == "batches: missing keys"}
    assert ("b1", "source_text, status") in plain


def test_duplicate_batch_ids_are_reported(spark):
    segments = spark.createDataFrame([("s1",), ("s2",)], "id string")
    rows = spark.createDataFrame([("s1", "t")], "segment_id string, translation string")
    batches = spark.createDataFrame([("b1",), ("b1",), ("b2",)], "batch_id string")
    got = {tuple(r) for r in validate.report(segments, segments, rows, batches).collect()}
    assert got == {("duplicate_batch_ids", "b1")}
