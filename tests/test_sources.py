import json
import os
import time

import pytest
from pyspark.sql import functions as F

from corpusloom.sinks import files
from corpusloom.sources import text as S


def test_decoding(spark, tmp_path):
    for name, data in (("bom.md", b"\xef\xbb\xbfa\r\nb"), ("jp.txt", "漢字".encode("cp932")), ("bad.txt", b"\x81\xff\xfe"), ("a.b.md", "x\ry z".encode())):
        (tmp_path / name).write_bytes(data)
    got = {r["book_id"]: r["text"] for r in S.read_books(spark, str(tmp_path)).collect()}
    assert got == {"bom": "a\nb", "jp": "漢字", "bad": b"\x81\xff\xfe".decode("utf-8", "replace"), "a.b": "x\ny z"}
    assert [(r["line_no"], r["line"]) for r in S.lines_of(spark.createDataFrame([("b", "a\n\n")], "book_id string, text string")).collect()] == [(0, "a"), (1, ""), (2, "")]


def test_jsonl(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('﻿{"id": 7, "k": "漢"}\n\n[1]\n{"k": 1}\n{bad\n')
    rows = S.read_jsonl(spark, str(tmp_path / "x.jsonl"), "id string, k string", ["id"]).orderBy("line_number").collect()
    assert [(r["line_number"], r["error"]) for r in rows] == [(1, None), (3, "not an object"), (4, "missing keys: id"), (5, "invalid JSON")]
    assert tuple(rows[0]["fields"]) == ("7", "漢")
    assert S.read_jsonl(spark, str(tmp_path / "none.jsonl"), "id string", optional=True).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        S.read_jsonl(spark, str(tmp_path / "none.jsonl"), "id string")


def test_jsonl_in_splits_keeps_line_numbers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, n in (("a.jsonl", 400), ("b.jsonl", 3), ("c.jsonl", 900)):
        (tmp_path / "in" / name).write_text("".join("\n" if i % 7 == 5 else json.dumps({"id": f"{name}-{i + 1}", "k": "x" * (i % 50)}) + "\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = S.read_jsonl(spark, str(tmp_path / "in"), "id string, k string").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = sorted((os.path.basename(r["file"]), r["line_number"], r["fields"]["id"]) for r in rows)
    assert got == sorted((n, i + 1, f"{n}-{i + 1}") for n, c in (("a.jsonl", 400), ("b.jsonl", 3), ("c.jsonl", 900)) for i in range(c) if i % 7 != 5)


def test_keys_and_ids_of_other_types(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": null, "k": "a"}\n{"k": "b"}\n')
    rows = S.read_jsonl(spark, str(tmp_path / "x.jsonl"), "id string, k string").orderBy("line_number").collect()
    assert [sorted(r["keys"]) for r in rows] == [["id", "k"], ["k"]]
    out = S.parse_model_output(spark.createDataFrame([('[{"segment_id": true}, {"segment_id": 7}, {"segment_id": 1.5}, {"segment_id": null}, {}]',)], "t string"), "t").orderBy("pos")
    assert [r["segment_id"] for r in out.collect()] == ["True", "7", "1.5", None, None]


ROWS = [{"segment_id": "s1", "translation": "a"}, {"segment_id": "s2", "translation": "b", "status": "needs_review", "review_note": "n"}]


@pytest.mark.parametrize(
    ("text", "shape", "n"),
    [
        (json.dumps(ROWS), "array", 2),
        (json.dumps({"translations": ROWS}), "wrapped", 2),
        (json.dumps(ROWS[0]), "object", 1),
        ("\n".join(map(json.dumps, ROWS)), "jsonl", 2),
        ("```json\n" + json.dumps(ROWS) + "\n```", "array", 2),
        ("  ```\n" + "\n".join(map(json.dumps, ROWS)) + "\n```  ", "jsonl", 2),
    ],
)
def test_model_output(spark, text, shape, n):
    rows = S.parse_model_output(spark.createDataFrame([(text,)], "v string"), "v").orderBy("pos").collect()
    assert [r["shape"] for r in rows] == [shape] * n and [r["segment_id"] for r in rows] == ["s1", "s2"][:n] and rows[0]["error"] is None
    if n == 2:
        assert rows[1]["review_note"] == "n"


@pytest.mark.parametrize("text", ["", "  ", "```json\n[]", '{"a": 1}', "[1]", '{"segment_id": "s1"}\nx', '[{"a": 1}] x', None])
def test_model_output_errors(spark, text):
    (row,) = S.parse_model_output(spark.createDataFrame([(text,)], "v string"), "v").collect()
    assert row["error"] and row["pos"] is None


def test_fence(spark):
    rows = ["```json\na\nb\n```", "```\na", " x ", "```"]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, s string")
    assert [r[0] for r in df.orderBy("i").select(S.strip_fence(F.col("s"))).collect()] == ["a\nb", None, "x", None]


def test_style_guide(spark, tmp_path):
    (tmp_path / "s.md").write_text("﻿ be kind \n")
    (tmp_path / "empty.md").write_text(" \n")
    assert S.style_guide(spark, str(tmp_path / "s.md"), "d") == ("be kind", str(tmp_path / "s.md"))
    assert S.style_guide(spark, str(tmp_path / "none.md"), " d ") == ("d", "built-in") and S.style_guide(spark, None, "d")[0] == "d"
    with pytest.raises(ValueError, match="empty"):
        S.style_guide(spark, str(tmp_path / "empty.md"), "d")


def test_freshness(spark, tmp_path):
    for folder, age in (("a", 100), ("b", 0)):
        os.makedirs(tmp_path / folder)
        (tmp_path / folder / "x").write_text("x")
        os.utime(tmp_path / folder / "x", (time.time() - age,) * 2)
    old, new = (S.files_with_times(spark, str(tmp_path / f)) for f in "ab")
    assert S.freshness(old, new).count() == 1 and S.freshness(new, old).count() == 0


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"漢/<{i}>\n", None if i % 2 else "x") for i in range(20)], "i int, s string, o string")
    for single in (False, True):
        path = str(tmp_path / f"out{single}")
        files.write_jsonl(rows, path, "i", single=single)
        lines = [x for part in sorted(os.listdir(path)) if part.startswith("part") for x in open(f"{path}/{part}", encoding="utf-8").read().splitlines()]
        assert [json.loads(x)["i"] for x in lines] == list(range(20)) and lines[1] == '{"i":1,"s":"漢/<1>\\n"}'
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_jsonl(rows, path)
    files.append_jsonl(rows, path)
    assert spark.read.text(path).count() == 40
    files.write_texts(rows, str(tmp_path / "texts"), "i", "s")
    assert spark.read.text(str(tmp_path / "texts")).where("i = 3").first()["value"] == "漢/<3>"
    one = str(tmp_path / "new" / "f.txt")
    files.put(spark, one, "ä")
    files.put(spark, one, b"\x00b")
    assert open(one, "rb").read() == b"\x00b" and files.exists(spark, one) and files.size_and_time(spark, one)[0] == 2
    with pytest.raises(FileExistsError):
        files.put(spark, one, "", overwrite=False)
    assert files.size_and_time(spark, one + "x") is None and files.report_line({"a": "漢", "b": [1]}) == '{"a":"漢","b":[1]}'
