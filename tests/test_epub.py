import hashlib
import io
import xml.etree.ElementTree as ET
import zipfile

import pytest

from corpusloom.operators import epub, segment
from corpusloom.sources import epub as E

X = "http://www.w3.org/1999/xhtml"
BOX = '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="%s"/></rootfiles></container>'
IMG = "⟦EPUB_IMG:pic/i.png|alt=%E7%AC%A6⟧"


def archive(files: dict[str, str | bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.comment = b"note"
        for name, data in files.items():
            z.writestr(name, data, compress_type=zipfile.ZIP_STORED if name == "mimetype" else zipfile.ZIP_DEFLATED)
    return out.getvalue()


def epub3(**more) -> bytes:
    return archive({
        "mimetype": "application/epub+zip",
        E.CONTAINER: BOX % "B/b.opf",
        "B/b.opf": f"""<package xmlns="{E.OPF}" version="3.0" unique-identifier="u"><metadata xmlns:dc="{E.DC}"><dc:title>本</dc:title><dc:language>ja</dc:language>
<dc:identifier id="u">x</dc:identifier><meta name="primary-writing-mode" content="vertical-rl"/></metadata><manifest>
<item id="n" href="nav.xhtml" media-type="application/xhtml+xml" properties="nav"/><item id="b" href="c%20two.xhtml" media-type="application/xhtml+xml"/>
<item id="a" href="c1.xhtml" media-type="application/xhtml+xml"/><item id="s" href="s.css" media-type="text/css"/><item id="i" href="pic/i.png" media-type="image/png"/></manifest>
<spine page-progression-direction="rtl"><itemref idref="a"/><itemref idref="n" linear="no"/><itemref idref="b"/></spine></package>""",
        "B/nav.xhtml": f'<html xmlns="{X}" xmlns:epub="{E.OPS}"><body><nav epub:type="toc"><ol><li><a href="c1.xhtml#s">一</a></li><li><a href="c%20two.xhtml">二</a></li></ol></nav></body></html>',
        "B/c1.xhtml": f"""<html xmlns="{X}" class="vrtl"><head><title>t</title></head><body><p id="s"><img src="pic/i.png" alt="一"/></p>
<p>前<ruby>漢<rt>かん</rt></ruby>字<br/>後<img src="pic/i.png" alt="符" class="g"/>末</p><div><p><a href="#s">戻る</a></p></div>
<p><span class="k">　下げ</span></p><p><a href="https://e.example">https://e.example</a>（日）</p></body></html>""",
        "B/c two.xhtml": f'<html xmlns="{X}"><body><h2>二</h2><p>文\n章</p><h4>小</h4><p/></body></html>',
        "B/s.css": "\ufeffhtml { writing-mode: vertical-rl }",
        "B/pic/i.png": b"png",
        **more,
    })


TEXT = f"# 本\n\n## 一\n\n前漢字\n後{IMG}末\n\n戻る\n\n　下げ\n\nhttps://e.example（日）\n\n## 二\n\n### 二\n\n文章\n\n##### 小\n"


def epub2() -> bytes:
    return archive({
        "mimetype": "application/epub+zip",
        E.CONTAINER: BOX % "c.opf",
        "c.opf": f'<package xmlns="{E.OPF}"><metadata xmlns:dc="{E.DC}"><dc:title>旧</dc:title></metadata><manifest><item id="x" href="t.ncx" media-type="{E.NCX}"/><item id="a" href="a.xhtml" media-type="application/xhtml+xml"/></manifest><spine toc="x"><itemref idref="a"/></spine></package>',
        "t.ncx": '<ncx xmlns="http://www.daisy.org/z3986/2005/ncx/"><navMap><navPoint><navLabel><text>旧章</text></navLabel><content src="a.xhtml#s"/></navPoint></navMap></ncx>',
        "a.xhtml": f'<html xmlns="{X}"><body><p id="s">旧章</p><p>本文。</p></body></html>',
    })


def frame(spark, **books):
    return spark.createDataFrame([(k, bytearray(v)) for k, v in books.items()], "book_id string, content binary")


def test_reading(spark):
    rows = E.book_blocks(frame(spark, three=epub3(), two=epub2(), bad=b"no zip", torn=epub3(**{"B/c1.xhtml": "<html><body><p>"})))
    books = {r["book_id"]: r for r in E.as_books(rows).collect()}
    assert books["three"]["text"] == TEXT and books["two"]["text"] == "# 旧\n\n## 旧章\n\n本文。\n"
    assert (books["three"]["documents"], books["three"]["headings"], books["three"]["paragraphs"]) == (2, 5, 5)
    errors = {r["book_id"]: r["error"]["stage"] for r in rows.where("error is not null").collect()}
    assert errors == {"bad": "input", "torn": "input"}


def translated(spark, name, data, translate):
    blocks = E.book_blocks(frame(spark, **{name: data}))
    segments = segment.segment(E.as_books(blocks).select("book_id", "text"), 100_000)
    rows = [(r["book_id"], i, r["id"], translate(r["source"]), "translated", None) for i, r in enumerate(segments.orderBy("pos").collect())]
    ledger = spark.createDataFrame(rows, "book_id string, append_pos long, segment_id string, translation string, status string, review_note string")
    return segments, ledger


def replaced(s):
    for a, b in (("本文", "正"), ("本", "书"), ("一", "甲"), ("二", "乙"), ("前漢字", "前"), ("後", "后"), ("戻る", "回"), ("下げ", "缩"), ("（日）", "（译）"), ("文章", "句"), ("小", "细"), ("旧章", "新章"), ("旧", "新")):
        s = s.replace(a, b)
    return s


def test_build_and_read_back(spark):
    data = epub3()
    segments, ledger = translated(spark, "three", data, replaced)
    (x,) = epub.build_epubs(frame(spark, three=data), segments, ledger, modified="2020-01-01T00:00:00Z", identifier="id").collect()
    assert x["error"] is None and x["report"]["restored_images"] == 1 and x["report"]["style_sheets"] == 1
    z = zipfile.ZipFile(io.BytesIO(x["content"]))
    assert z.comment == b"note" and z.namelist()[0] == "mimetype" and z.read("B/pic/i.png") == b"png"
    page = ET.fromstring(z.read("B/c1.xhtml"))
    assert page.get("class") == "hltr" and page.get("dir") == "ltr"
    images = list(page.iter(f"{{{X}}}img"))
    assert images[0].get("alt") == "甲" and images[1].get("class") == "g" and images[1].tail == "末"
    assert [a.text for a in page.iter(f"{{{X}}}a")] == ["回", "https://e.example"]
    package = ET.fromstring(z.read("B/b.opf"))
    assert package.get("unique-identifier") == "translated-uuid" and package.find(f".//{{{E.DC}}}title").text == "书"
    (again,) = E.as_books(E.book_blocks(frame(spark, three=x["content"]))).collect()
    assert again["text"] == replaced(TEXT)
    (dry,) = epub.build_epubs(frame(spark, three=data), segments, ledger, dry_run=True).collect()
    assert dry["content"] is None and dry["report"]["blocks"] == x["report"]["blocks"]
    own, sha = x["report"], lambda b: hashlib.sha256(b).hexdigest()
    assert own["status"] == "built" and own["input_sha256"] == sha(data) and own["output_sha256"] == sha(x["content"]) and own["identifier"] == "id"
    assert own["image_hashes"]["B/pic/i.png"] == sha(b"png") and "B/c1.xhtml" in own["modified_members"] and "B/pic/i.png" not in own["modified_members"]
    assert own["epubcheck"] == "not_available" and dry["report"]["status"] == "dry_run" and dry["report"]["output_sha256"] is None


def test_external_checker(spark, tmp_path):
    segments, ledger = translated(spark, "three", epub3(), replaced)
    for code, says in ((0, "passed"), (1, "epubcheck")):
        tool = tmp_path / f"checker{code}"
        tool.write_text(f"#!/bin/sh\necho found something\nexit {code}\n")
        tool.chmod(0o755)
        (x,) = epub.build_epubs(frame(spark, three=epub3()), segments, ledger, checker=str(tool)).collect()
        assert (x["report"]["epubcheck"] if code == 0 else x["error"]["stage"]) == says and (code == 0 or "found something" in x["error"]["actual"])
    slow = tmp_path / "slow"
    slow.write_text("#!/bin/sh\nexec sleep 9\n")
    slow.chmod(0o755)
    with pytest.raises(E.EpubError, match="too long"):
        epub.checked(b"x", str(slow), 1)


def test_canonical_source_and_changed_archives(spark):
    segments, ledger = translated(spark, "three", epub3(), replaced)
    books = frame(spark, three=epub3())
    (read,) = E.as_books(E.book_blocks(books)).collect()
    other = read["text"][:7] + "¤" + read["text"][8:]
    source = lambda t: spark.createDataFrame([("three", t)], "book_id string, text string")
    (x,) = epub.build_epubs(books, segments, ledger, canonical=source(other)).collect()
    assert x["content"] is None and x["error"]["stage"] == "source" and x["error"]["block_index"] == "7" and x["error"]["expected"].startswith("¤")
    built = epub.build_epubs(books, segments, ledger, canonical=source(read["text"]))
    (same,) = epub.unchanged(built, books).collect()
    assert same["error"] is None and same["content"] and same["report"]["status"] == "built"
    (changed,) = epub.unchanged(built, frame(spark, three=epub3() + b"x")).collect()
    assert changed["content"] is None and changed["report"] is None and changed["error"]["stage"] == "source"


def test_build_epub2(spark):
    segments, ledger = translated(spark, "two", epub2(), replaced)
    (x,) = epub.build_epubs(frame(spark, two=epub2()), segments, ledger).collect()
    assert x["error"] is None
    (again,) = E.as_books(E.book_blocks(frame(spark, two=x["content"]))).collect()
    assert again["text"] == "# 新\n\n## 新章\n\n正。\n"


@pytest.mark.parametrize(
    ("change", "stage"),
    [(lambda s: s.replace(IMG, ""), "translations"), (lambda s: s.replace("https://e.example", "x"), "mapping"), (lambda s: s.replace("文章", " "), "translations")],
)
def test_fails_closed(spark, change, stage):
    segments, ledger = translated(spark, "three", epub3(), change)
    (x,) = epub.build_epubs(frame(spark, three=epub3()), segments, ledger).collect()
    assert x["content"] is None and x["error"]["stage"] == stage


def test_source_must_match(spark):
    segments, ledger = translated(spark, "three", epub3(), replaced)
    other = epub3(**{"B/c two.xhtml": f'<html xmlns="{X}"><body><h2>二</h2><p>他</p><h4>小</h4></body></html>'})
    (x,) = epub.build_epubs(frame(spark, three=other), segments, ledger).collect()
    assert x["error"]["stage"] == "mapping" and x["error"]["message"] == "texts differ"


def test_unsafe_archives():
    for files, message in (({"mimetype": "application/epub+zip", "../x": ""}, "unsafe"), ({"x": ""}, "mimetype")):
        with pytest.raises(E.EpubError, match=message):
            E.Book(archive(files), strict=True)
    with pytest.raises(E.EpubError, match="leaves"):
        E.resolved("B/b.opf", "../../x")


def test_rows_are_taken_and_made_in_bounded_batches():
    batch = E.pa.record_batch({"book_id": [str(i) for i in range(1000)], "content": [b"x" * 100_000] * 1000})
    taken = E.taken(iter([batch]))
    sizes = [(b.num_rows, b.nbytes) for b in E.gathered(taken, batch.schema)]
    assert sum(n for n, _ in sizes) == 1000 and 1 < len(sizes) < 100 and max(size for _, size in sizes) < 2 * E.HELD_SIZE
    many = E.gathered(((str(i), b"") for i in range(10_000)), batch.schema)
    assert [b.num_rows for b in many] == [4096, 4096, 1808]


def test_a_build_unpacks_each_member_once(monkeypatch):
    data, seen = epub.new_archive("Book 1", "Part 1", ["a", "b", "c", "d"]), []
    rows = [{"kind": b.kind, "segment_id": str(n), "source": b.text, "translation": b.text} for n, b in enumerate(E.Book(data).blocks(""))]
    own = zipfile.ZipFile.read
    monkeypatch.setattr(zipfile.ZipFile, "read", lambda z, name, *a: (seen.append((id(z), name)), own(z, name, *a))[1])
    out, report = epub.build(data, "", rows, modified="2020-01-01T00:00:00Z", identifier="id", checker=None)
    assert report["status"] == "built" and len(seen) == 2 * report["members"] == len(set(seen))


def test_a_wrong_checksum_is_an_error():
    broken = archive({"mimetype": "application/epub+zip", "x": b"some bytes"}).replace(b"mimetypeapplication/epub+zip", b"mimetypeapplication/epub+zap")
    with pytest.raises(E.EpubError, match="checksum"):
        E.Book(broken, strict=True)
