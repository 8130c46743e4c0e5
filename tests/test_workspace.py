import json
import os

import pytest

from corpusloom.__main__ import parser, run
from corpusloom.plans.workspace import Workspace
from corpusloom.sinks import files
from corpusloom.streaming import outputs

from .test_epub import epub3, replaced

BOOK = "# T\n\nfirst line\nsecond\n\n## One\n[Page 3]\n" + "\n".join(f"line {i} of one" for i in range(12)) + "\n\n## Two\n\nlast <b>\n"


@pytest.fixture
def w(spark, tmp_path):
    os.makedirs(tmp_path / "input")
    (tmp_path / "input" / "book.md").write_text(BOOK)
    return Workspace(spark, str(tmp_path))


def answer(w, batch_id, order=1, change=lambda s: f"T {s}"):
    rows = [r for r in w.items().orderBy("idx").collect() if r["batch_id"] == batch_id]
    lines = [json.dumps({"segment_id": r["id"], "translation": change(r["source"])}) for r in rows][::order]
    path = w.request_paths(batch_id)[1]
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("```\n" + "\n".join(lines) + "\n```")
    return path


def test_whole_life(w, tmp_path):
    made = w.prepare()
    assert (made["chapters"], made["headings"], made["segments"], made["batches"]) == (2, 3, 6, 3)
    first = w.step()
    assert first["action"] == "translate" and first["batch_id"] == "front-b001" and "first line" in open(first["request_path"]).read()
    answer(w, "front-b001", order=-1)
    second = w.step()
    assert second["submitted_batch_id"] == "front-b001" and second["batch_id"] == "ch001-b001" and "merge_output:front-b001" in second["performed"]
    with pytest.raises(ValueError, match="complete"):
        w.merge(w.request_paths("front-b001")[1], "front-b001")
    with pytest.raises(ValueError, match="line break"):
        w.merge(answer(w, "ch001-b001", change=lambda s: s + "\nx"), "ch001-b001", append=True)
    state = w.report(["ch001-b001"], list_pending=1)
    assert not state["ok"] and state["issues"] == {"expected_missing_by_batch": {"ch001-b001": ["ch001-p0001", "ch001-p0002"]}}
    assert "Progress: 2/6 translated (33.3%), pending 4" in w.shown(state)
    draft = tmp_path / "draft.jsonl"
    rows = [r for r in w.segments().orderBy("pos").collect() if r["chapter_id"] != "front"]
    draft.write_text("\n".join(json.dumps({"segment_id": r["id"], "translation": f"T {r['source']}", "status": "translated"}) for r in rows))
    assert w.append(str(draft))["appended_rows"] == 4
    with pytest.raises(ValueError, match="already in the ledger"):
        w.append(str(draft))
    assert w.append(str(draft), allow_existing=True)["skipped_existing_rows"] == 4
    assert w.checkpoint(from_batch="front-b001", count=3, skip_assemble=True)["ok"]
    done = w.step(assemble=True)
    page = open(w.html_path).read()
    assert done["assembly"]["translated"] == 6 and page.count("<article") == 6 and "T last &lt;b&gt;" in page and done["next_pending_batch"] is None


def test_stale_output_is_refused(w):
    w.prepare()
    path = answer(w, "front-b001")
    w.request("front-b001")
    os.utime(path, (1, 1))
    with pytest.raises(ValueError, match="older than its request"):
        w.step()


def test_stream_of_outputs(w, tmp_path):
    w.prepare()
    answer(w, "front-b001")
    answer(w, "ch002-b001", change=lambda s: "")
    outputs.watch(w, str(tmp_path / "c1"), once=True).awaitTermination()
    assert w.report()["translated_source_segments"] == 2
    rejects = [json.loads(r[0]) for r in w.spark.read.text(f"{w.root}/work/rejects.jsonl").collect()]
    assert rejects == [{"batch_id": "ch002-b001", "reason": "empty translation"}]
    answer(w, "ch001-b001")
    outputs.watch(w, str(tmp_path / "c2"), once=True).awaitTermination()  # all files, some once more: nothing is appended twice
    state = w.report()
    assert state["translated_source_segments"] == 4 and not state["issues"]


def test_several_books_have_their_own_ids(spark, tmp_path):
    w = Workspace(spark, str(tmp_path))
    books = spark.createDataFrame([("a", "x\n## c\ny"), ("b", "x\n## c\ny")], "book_id string, text string")
    w.prepare(books)
    assert {r["id"] for r in w.segments().collect()} == {f"{b}:{s}" for b in "ab" for s in ("front-p0001", "ch001-p0001", "ch001-p0002")}
    assert w.report()["batches"] == 4 and w.first_pending()[0]["batch_id"] == "a:front-b001"
    assert w.assemble()["pending"] == 6 and sorted(x for x in os.listdir(tmp_path / "output") if not x.startswith(".")) == ["a.html", "b.html"]


def test_epub_round_trip(spark, tmp_path):
    os.makedirs(tmp_path / "input")
    (tmp_path / "input" / "three.epub").write_bytes(epub3())
    w = Workspace(spark, str(tmp_path))
    assert w.read_epubs()["books"] == 1
    w.prepare(max_segment_bytes=100_000, max_segments=100, max_bytes=1 << 20)
    segs = w.segments().orderBy("pos").collect()
    w.spark.createDataFrame([(i, r["id"], replaced(r["source"]), "translated") for i, r in enumerate(segs)], "append_pos long, segment_id string, translation string, status string").transform(lambda x: files.append_jsonl(x, w.ledger_path) or x)
    (built,) = w.build_epubs()
    assert built["error"] is None and built["report"]["restored_images"] == 1 and (tmp_path / "output" / "three.translated.epub").exists()


def test_command_line(spark, tmp_path, capsys):
    os.makedirs(tmp_path / "input")
    (tmp_path / "input" / "book.md").write_text(BOOK)
    call = lambda *a: (run(parser().parse_args(["--root", str(tmp_path), *a]), spark), capsys.readouterr().out)
    assert call("prepare")[0] == 0
    code, out = call("validate", "--expect-batches", "front-b001")
    assert code == 1 and json.loads(out)["issues"]["expected_missing_by_batch"]
    assert "Progress: 0/6" in call("progress")[1] and "## Targets" in call("step")[1]
    assert json.loads(call("assemble", "--only-translated")[1])["pending"] == 6
    assert json.loads(call("strip-page-markers")[1])["removed_page_markers"] == 1
    assert "[Page" not in (tmp_path / "work" / "clean" / "book.no_pages.md").read_text()
    assert json.loads(call("prepare", "--keep-page-markers", "--force")[1])["segments"] == 6


def test_a_draft_in_parts_is_one_draft(w, tmp_path):
    w.prepare()
    rows = [json.dumps({"segment_id": r["id"], "translation": r["source"], "status": "translated"}) for r in w.segments().orderBy("pos").collect()]
    draft = tmp_path / "draft.jsonl"
    draft.mkdir()
    for n, part in enumerate((rows[:1], rows[1:4], rows[4:])):
        (draft / f"part-{n}.txt").write_text("\n".join(part) + "\n")
    assert w.append(str(draft))["appended_rows"] == 6
    assert [r["append_pos"] for r in w.ledger().orderBy("append_pos").collect()] == [1, 2, 3, 4, 5, 6]
    assert w.report()["ok"] and w.report()["pending_source_segments"] == 0
