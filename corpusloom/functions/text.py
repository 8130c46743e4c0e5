"""Text functions as column expressions, with Python's notion of white space where that matters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Exactly the 29 characters that str.strip removes, for Java's regular expressions.
WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: The same as a set, to trim by: edges are looked at from outside, where a pattern is tried at every white space of a text.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: WS without the line feed.
INNER = r"[\t\x0b-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Line ends of str.splitlines.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
PAGE_MARKER = rf"(?iU)^{WS}*\[page{WS}+\d+\]{WS}*\z"
HEADING = rf"(?s)^(#{{1,6}}){WS}+(.+?){WS}*\z"
#: Percent encoding leaves these characters of an image's address or text alone.
SAFE_SRC, SAFE_ALT = "/._-", "._-"


def byte_count(s: Column) -> Column:
    return F.octet_length(s)


def char_count(s: Column) -> Column:
    """Code points."""
    return F.char_length(s)


def normalize_newlines(s: Column) -> Column:
    return F.replace(F.replace(s, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def strip(s: Column) -> Column:
    return F.btrim(s, F.lit(SPACES))


def rstrip(s: Column) -> Column:
    return F.rtrim(s, F.lit(SPACES))


def trim_ascii(s: Column) -> Column:
    """Spaces, tabs and line ends at the edges; wide spaces stay."""
    return F.regexp_replace(s, r"^[ \t\r\n]+|[ \t\r\n]+\z", "")


def drop_line_ends(s: Column) -> Column:
    return F.translate(s, "\r\n", "")


def line_breaks(s: Column) -> Column:
    return F.char_length(s) - F.char_length(F.replace(s, F.lit("\n"), F.lit("")))


def lines(s: Column) -> Column:
    """By \\n alone; a trailing line end gives an empty last line."""
    return F.split(s, "\n", -1)


def splitlines(s: Column) -> Column:
    """By every line end that str.splitlines knows; none after the last."""
    parts = F.split(s, LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def line_count(s: Column) -> Column:
    return F.when(s == "", 0).otherwise(F.size(splitlines(s)))


def feed_count(s: Column) -> Column:
    """Lines as lines() has them, without the empty one behind a trailing line feed; a text without anything is a line."""
    return F.size(lines(s)) - F.when(s.endswith("\n"), 1).otherwise(0)


def blank_line_positions(s: Column) -> Column:
    """Indices, from 0, of the lines that are blank."""
    return F.filter(F.transform(lines(s), lambda x, i: F.when(strip(x) == "", i)), lambda i: i.isNotNull())


def trim_blank_lines(s: Column) -> Column:
    """Without blank lines at either end; inner ones and indentation stay."""
    blank = rf"(?:{INNER}*\n)"
    return F.regexp_replace(F.regexp_replace(s, rf"\A{blank}+", ""), rf"(?:\n{WS}*)+\z", "")


def is_page_marker(line: Column) -> Column:
    return line.rlike(PAGE_MARKER)


def heading_level(line: Column) -> Column:
    """1 to 6, or 0 for a line that is no heading."""
    return F.char_length(F.regexp_extract(line, HEADING, 1))


def heading_text(line: Column) -> Column:
    return F.regexp_extract(line, HEADING, 2)


def strip_heading_prefix(s: Column) -> Column:
    """Without one run of heading marks."""
    return F.regexp_replace(s, rf"^#{{1,6}}{WS}+", "")


def strip_heading_marks(s: Column) -> Column:
    """Without all heading marks in front, however many runs."""
    return F.regexp_replace(strip(s), rf"^#(?:#|{WS})*", "")


def html_escape(s: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def line_html(s: Column) -> Column:
    return F.replace(html_escape(s), F.lit("\n"), F.lit("<br>\n"))


def indent(s: Column, by: int = 4) -> Column:
    return F.array_join(F.transform(splitlines(s), lambda x: F.concat(F.lit(" " * by), x)), "\n")


def feed_indent(s: Column, by: int = 4) -> Column:
    """Indented after every line feed but one at the end; a text without anything is a line."""
    pad = " " * by
    return F.concat(F.lit(pad), F.replace(F.regexp_replace(s, r"\n\z", ""), F.lit("\n"), F.lit(f"\n{pad}")))


def summarize(s: Column, most: int = 120) -> Column:
    """One line of at most `most` characters."""
    one = F.replace(F.replace(s, F.lit("\r"), F.lit("\\r")), F.lit("\n"), F.lit("\\n"))
    return F.when(F.char_length(one) <= most, one).otherwise(F.concat(F.left(one, F.lit(most - 1)), F.lit("…")))


def edge_equal(a: Column, b: Column) -> Column:
    """Equal but for white space at the edges."""
    return strip(a) == strip(b)


def with_edges_of(s: Column, model: Column) -> Column:
    """s, stripped, between the model's leading and trailing white space."""
    blank = strip(model) == ""
    return F.when(blank, strip(s)).otherwise(F.concat(F.regexp_extract(model, rf"^{WS}*", 0), strip(s), F.regexp_extract(model, rf"{WS}*\z", 0)))


def percent_encode(s: Column, safe: str = SAFE_SRC) -> Column:
    """urllib.parse.quote by the built-in form encoding and the four characters in which they differ."""
    out = F.url_encode(s)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.replace(out, F.lit("%2F"), F.lit("/")) if "/" in safe else out


def percent_decode(s: Column) -> Column:
    """Null where the escapes are no UTF-8 or malformed."""
    out = F.try_url_decode(F.replace(s, F.lit("+"), F.lit("%2B")))
    return F.when(out.contains("�") & ~F.upper(s).contains("%EF%BF%BD"), F.lit(None)).otherwise(out)


def segment_id(chapter: Column, order: Column) -> Column:
    return F.format_string("%s-p%04d", chapter, order)


def chapter_id(number: Column) -> Column:
    return F.when(number == 0, "front").otherwise(F.format_string("ch%03d", number))


def batch_id(chapter: Column, order: Column) -> Column:
    return F.format_string("%s-b%03d", chapter, order)


def sha256(data: Column) -> Column:
    return F.sha2(data, 256)


def local_name(tag: Column) -> Column:
    """Of an expanded XML name, {namespace}name."""
    return F.regexp_replace(tag, r"^.*\}", "")
