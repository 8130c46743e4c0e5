import random
import re
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import placeholders as P
from corpusloom.functions import text as T

SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def texts(n=400):
    r = random.Random(5)
    pool = [*SPACES, "\u200b", "a", "é", "漢", "#", "##", "[Page 1]", "\r\n", "\n\n", "<&\"'>", "😀"]
    return ["", " ", "\n", "\r", *("".join(r.choice(pool) for _ in range(r.randrange(12))) for _ in range(n))]


def values(spark, f, rows):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(rows)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("s"))).collect()]


def norm(s):
    return s.replace("\r\n", "\n").replace("\r", "\n")


@pytest.mark.parametrize(
    ("ours", "python"),
    [
        (T.strip, str.strip),
        (T.rstrip, str.rstrip),
        (T.trim_ascii, lambda s: s.strip(" \t\r\n")),
        (T.byte_count, lambda s: len(s.encode())),
        (T.char_count, len),
        (T.normalize_newlines, norm),
        (T.line_breaks, lambda s: s.count("\n")),
        (T.line_count, lambda s: len(s.splitlines())),
        (T.drop_line_ends, lambda s: s.replace("\r", "").replace("\n", "")),
        (T.indent, lambda s: "\n".join("    " + x for x in s.splitlines())),
        (T.blank_line_positions, lambda s: [i for i, x in enumerate(s.split("\n")) if not x.strip()]),
        (T.summarize, lambda s: (lambda t: t if len(t) <= 120 else t[:119] + "…")(s.replace("\r", "\\r").replace("\n", "\\n"))),
        (lambda c: T.percent_encode(c, T.SAFE_SRC), lambda s: quote(s, safe=T.SAFE_SRC)),
        (lambda c: T.percent_encode(c, T.SAFE_ALT), lambda s: quote(s, safe=T.SAFE_ALT)),
        (T.html_escape, lambda s: s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;").replace("'", "&#x27;")),
        (T.is_page_marker, lambda s: bool(re.fullmatch(r"\s*\[page\s+\d+\]\s*", s, re.I))),
        (T.heading_level, lambda s: len(m[1]) if (m := re.match(r"(#{1,6})\s+(.+?)\s*\Z", s, re.S)) else 0),
        (T.splitlines, lambda s: s.splitlines() if s else []),
    ],
)
def test_like_python(spark, ours, python):
    rows = texts() + ["x" * 130, "[Page １２]", "# 書名", "#　z", "#題", "####### x", "a/b *~"]
    got = values(spark, ours, rows)
    assert [g for g, s in zip(got, rows) if g != python(s)] == []


def test_trim_blank_lines(spark):
    rows = ["\n\n　a\n\nb\n \n", "a", " \n\t\n", "  a"]
    assert values(spark, T.trim_blank_lines, rows) == ["　a\n\nb", "a", "", "  a"]


def test_heading_marks(spark):
    rows = ["# ## x", "#x", "## y", "z", " # a"]
    assert values(spark, T.strip_heading_marks, rows) == ["x", "x", "y", "z", "a"]
    assert values(spark, T.strip_heading_prefix, rows) == ["## x", "#x", "y", "z", " # a"]


def test_edges(spark):
    df = spark.createDataFrame([(" x ", "　a\n"), ("x", " \n")], "s string, m string")
    assert [r[0] for r in df.select(T.with_edges_of(F.col("s"), F.col("m"))).collect()] == ["　x\n", "x"]


def test_ids_are_never_cut(spark):
    df = spark.range(1)
    got = df.select(T.segment_id(F.lit("ch001"), F.lit(12345)), T.chapter_id(F.lit(1000)), T.chapter_id(F.lit(0)), T.batch_id(F.lit("front"), F.lit(7))).first()
    assert tuple(got) == ("ch001-p12345", "ch1000", "front", "front-b007")


def test_null_in_null_out(spark):
    for f in (T.strip, T.byte_count, T.line_count, T.html_escape, P.display):
        assert values(spark, f, [None]) == [None]


TOKENS = [("../图片/a b|c.png?x=1", "异体字 | 20%"), ("../images/same.png", ""), ("a", "*~+&")]


def test_placeholders_round_trip(spark):
    for src, alt in TOKENS:
        token = P.encode_py(src, alt)
        assert P.parse_py(token) == (src, alt)
        got = spark.range(1).select(P.encode(F.lit(src), F.lit(alt)), P.parse(F.lit(token)), P.extract(F.lit(f"x{token}|y{token}")), P.display(F.lit(f"x{token}y"))).first()
        assert got[0] == token and tuple(got[1]) == (src, alt) and got[2] == [token, token] and got[3] == f"x{alt}y"
    assert P.encode_py(*TOKENS[0]) == "⟦EPUB_IMG:../%E5%9B%BE%E7%89%87/a%20b%7Cc.png%3Fx%3D1|alt=%E5%BC%82%E4%BD%93%E5%AD%97%20%7C%2020%25⟧"


def test_tokenize(spark):
    token = P.encode_py("../images/same.png", "")
    rows = [f"前{token}中{token}后", "前⟦EPUB_IMG:image.png|alt=broken", "⟦EPUB_IMG:image%2fpart.png|alt=⟧", "⟦EPUB_IMG:%ff|alt=⟧", "plain", "", None]
    got = values(spark, P.tokenize, rows)
    assert [t["kind"] for t in got[0]["tokens"]] == ["text", "image", "text", "image", "text"]
    assert "malformed" in got[1]["error"] and "non-canonical" in got[2]["error"] and "UTF-8" in got[3]["error"]
    assert len(got[4]["tokens"]) == 1 and got[5]["tokens"] == [] and got[6]["tokens"] is None
    assert values(spark, P.is_malformed, rows[:5]) == [False, True, True, True, False]
