"""Main text of web pages by consensus of paths within a host.

Pages are read by a tolerant tag scanner. Every container (article, main, section, div, td, body) is
scored by its own text: the characters of its blocks, less those in links, with a penalty for list
items and a bonus for article and main. Each page votes, with its size, for the generalised path of
its best container (tags and classes from the root, digits and ids removed); votes are summed per
host in Spark, and pages are read again with their host's winning path. A page keeps its own best
container where the path has no more than half of that container's text, unless the container is one
that mostly loses on the host's pages. A page without any text gives an empty string.

Not text: scripts, styles, templates, markup, head, menus, drawings, headers and footers outside an article,
asides, forms, buttons; formulas are text. And containers with a class or id that as a whole names adverts, notices, cookie
banners, share bars or reader comments, unless they hold most of the page's text outside links.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed
and joined by two newlines in page order. Null html is empty. Null urls are one host of their own.
Repeated rows vote as often as they are there; of equal votes wins the path with more pages, then the
first by name; of a page's containers with equal scores the deepest, then the last by name. Pages of any
length are whole, and take time in proportion to it. Extra columns do not matter. An empty table gives an
empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import by_value, park, table, tidy

by_value(__name__)

#: A quote opens a value behind an equals sign only. Nothing is tried twice (possessive), so a page takes time in proportion to its size.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|["'=])*+)>""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|aria-label)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Up to their own end tag, or the page's end, nothing is markup.
RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in ("script", "style", "iframe", "noembed", "noframes", "textarea", "title")}
DROP = frozenset("head nav aside form button dialog menu fieldset noscript template object svg select canvas audio video annotation annotation-xml".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Tags at which a block ends: those that stand in a line of text do not break it, dropped or not.
BREAKS = BLOCK | frozenset("head dialog menu fieldset".split())
CONTAINER = frozenset("article main section div td body".split())
CLOSES = {"li": ("li", ("ul", "ol")), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "tr": ("tr", ("table",)), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "option": ("option", ("select",))}
WORD = r"(?:ads?|adverts?|advertisements?|adsense|banner|sponsor(?:ed)?|promo(?:tion)?|cookies?|consent|gdpr|notices?|alert|newsletter|subscribe|signup|popup|modal|overlay|share|sharing|social|sidebar|side|related|recommend(?:ed|ations)?|more-stories|comments?|commentlist|disqus|respond|replies|reply|nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|toolbar|topbar|masthead|site-header|site-footer|footer|login|search|widget|tags?|skip|hidden|print-only|paywall)"
#: Words that say where or in what form such a thing is, but not that it is something else.
FORM = r"(?:area|bar|block|bottom|box|buttons?|container|content|form|global|icons?|inner|left|links?|list|main|mobile|outer|page|panel|posts?|primary|right|secondary|section|site|slot|sticky|stories|top|unit|wrap|wrapper|\d+)"
#: A whole class or id of nothing but these words.
NOISE = re.compile(rf"(?:^|\s)(?:{FORM}[_-]+)*{WORD}\d*(?:[_-]+(?:{WORD}\d*|{FORM}))*(?=$|\s)", re.I)
#: Tags that are judged by class and id; an article only as a comment.
JUDGED = frozenset("div section article ul ol dl table td header footer figure details".split())
#: Share of the page's unlinked text from which a container is kept in spite of its name; that of reader comments.
PROSE, COMMENTS = 0.5, 0.9
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
SPACE = re.compile(r"\s+")
COMMENT = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|respond|reply|replies)(?=$|[\s_-]|\d)", re.I)
#: Prose of a container's second part, as a share of its first's, from which both are one text; in the body.
SECOND, SECOND_OF_BODY = 0.1, 0.5
GENERAL = re.compile(r"\d+")
#: Containers within containers that a path tells apart, as in browsers; what is deeper belongs to the last of them.
DEPTH = 512


class Block:
    __slots__ = ("chars", "item", "linked", "noise", "path", "text")

    def __init__(self, text: str, path: tuple, linked: int, item: bool, noise: tuple):
        self.text, self.path, self.linked, self.item, self.noise, self.chars = text, path, linked, item, noise, len(text)

    @property
    def prose(self) -> int:
        return self.chars - min(self.linked, self.chars)


def attributes(source: str) -> tuple[str, bool, str]:
    """Generalised classes; whether other attributes mark what is no article text; the classes and ids that do by their name, if any."""
    if "=" not in source and "hidden" not in source:
        return "", False, ""
    found = {}
    for name, value in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), value.strip("\"'"))
    names = f"{found.get('class', '')} {found.get('id', '')}"
    unseen = found.get("role", "").lower() in ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
    return ".".join(sorted({GENERAL.sub("", c) for c in found.get("class", "").lower().split()} - {""})), unseen, names if NOISE.search(names) else ""


def blocks(html: str) -> list[Block]:
    """The page's text blocks outside what is dropped, with the generalised path of open containers."""
    out: list[Block] = []
    stack: list[tuple[str, tuple, bool, tuple]] = []  # tag, container path, dropped from here on, noisy containers
    opened: Counter = Counter()  # tags on the stack
    needed: list[float] = []  # by noisy container, the share of the page's prose that keeps it
    parts: list[str] = []
    linked, links, path, dropped = 0, 0, (), 0
    item, noise = False, ()

    def flush():
        nonlocal linked, parts
        if parts:
            text = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                out.append(Block(text, path, linked, item, noise))
            parts, linked = [], 0

    def close(depth: int):
        nonlocal path, dropped, links, item, noise
        while len(stack) > depth:
            tag, before, drops, outer = stack.pop()
            opened[tag] -= 1
            if tag in BREAKS:
                flush()
            dropped -= drops
            path, noise = before, outer
            links -= tag == "a"
            item = item and tag != "li"

    at, size, last = 0, len(html), html.rfind(">") + 1
    while at < size:
        m = TOKEN.search(html, at, last)
        end = m.start() if m else size
        if end > at and not dropped:
            piece = html[at:end]
            parts.append(piece)
            if links:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA[") and not dropped:
                parts.append(entities.escape(m[0][9:-3]))
            continue
        tag = m[2].lower()
        if m[1]:
            if opened[tag]:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
            elif tag in BLOCK:
                flush()
            continue
        if tag in BLOCK:
            # a paragraph ends where a block begins, a cell or item where its like begins
            for i in range(len(stack) - 1, -1, -1) if opened["p"] else ():
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in CONTAINER or stack[i][0] in ("li", "blockquote", "table"):
                    break
            flush()
            if tag in CLOSES and any(opened[t] for t in CLOSES[tag][0].split()):
                like, stop = CLOSES[tag][0].split(), CLOSES[tag][1]
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in stop:
                        break
                    if stack[i][0] in like:
                        close(i)
                        break
        if tag == "br" or tag == "wbr":
            if not dropped and tag == "br":
                parts.append(" ")
            continue
        if tag in VOID or m[3].endswith("/"):
            continue
        if tag in RAW:
            e = RAW[tag].search(html, at)
            at = e.end() if e else size
            continue
        classes, unseen, names = attributes(m[3])
        outside = tag == "footer" or (tag == "header" and not any(x[0] in ("article", "main") for x in stack))
        drops = tag in DROP or outside or (unseen and tag not in ("html", "body", "main", "article"))
        if drops and tag in BREAKS:
            flush()
        stack.append((tag, path, drops, noise))
        opened[tag] += 1
        comment = bool(COMMENT.search(names))
        if names and tag in JUDGED and (comment or tag != "article"):
            noise = (*noise, len(needed))
            needed.append(COMMENTS if comment else PROSE)
        dropped += drops
        links += tag == "a"
        item = item or tag == "li"
        if tag in CONTAINER and len(path) < DEPTH:
            path = (*path, f"{tag}.{classes}" if classes else tag)
    close(0)
    flush()
    return without_noise(out, needed) if needed else out


def without_noise(found: list[Block], needed: list[float]) -> list[Block]:
    """Without the blocks in noisy containers, unless these hold more than the needed share of the page's prose."""
    total, held = sum(b.prose for b in found), [0] * len(needed)
    for b in found:
        for i in b.noise:
            held[i] += b.prose
    return [b for b in found if all(held[i] > needed[i] * total for i in b.noise)]


def best_path(found: list[Block]) -> tuple[str, int] | None:
    """The path of the container with the best score, and its text's size.

    A parent gets half of its parts' scores. It gets them whole, and so wins over its parts, where a second
    part has the share SECOND of the largest one's prose; for the body, where all meets, SECOND_OF_BODY.
    """
    own: dict[tuple, float] = {}
    size: dict[tuple, int] = {}
    prose: dict[tuple, float] = {}
    for b in found:
        share = b.prose * (0.3 if b.item else 1.0)
        if b.path:
            own[b.path] = own.get(b.path, 0.0) + share
        for depth in range(len(b.path), 0, -1):
            p = b.path[:depth]
            own.setdefault(p, 0.0)
            prose[p] = prose.get(p, 0.0) + share
            size[p] = size.get(p, 0) + b.chars
    if not own:
        return None
    inside: dict[tuple, list[tuple]] = {}
    for p in own:
        inside.setdefault(p[:-1], []).append(p)
    for p in sorted(inside, key=len, reverse=True):
        if p:
            most = sorted((prose[c] for c in inside[p]), reverse=True)
            several = len(most) > 1 and most[1] > 0 and most[1] >= most[0] * (SECOND_OF_BODY if p[-1].split(".")[0] == "body" else SECOND)
            own[p] += sum(own[c] for c in inside[p]) * (1.0 if several else 0.5)
    bonus = lambda p: 2.0 if p[-1].split(".")[0] in ("article", "main") else 1.0
    best = max(own, key=lambda p: (own[p] * bonus(p), len(p), p))
    return ">".join(best), size[best]


def extracted(html: str, path: str | None, losers: frozenset[str] | set[str] = frozenset()) -> str:
    """Text of the blocks in containers with this path, if it has most of the text of the page's own best container; else of that container; of all blocks if there is no container.

    An own best container that mostly is not best where the host's pages have it, one of the losers, does not count against the path.
    """
    found = blocks(html)
    best = best_path(found)
    own = tuple(best[0].split(">")) if best else ()
    if path is not None:
        want = tuple(path.split(">"))
        some = [b for b in found if b.path[: len(want)] == want]
        common = sum(b.chars for b in some if b.path[: len(own)] == own)
        if some and (best[0] in losers or 2 * common > best[1]):
            return "\n\n".join(b.text for b in some)
    return "\n\n".join(b.text for b in found if b.path[: len(own)] == own)


def votes(pages: DataFrame) -> DataFrame:
    """host, path, size (0 if the path is not the page's best), won: the best path of every page with text, and the others that have text of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for h, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = blocks(page.as_py() or "")
                if best := best_path(found):
                    rows.append((h, *best, 1))
                    rows += [(h, p, 0, 0) for p in {">".join(b.path) for b in found if b.path and b.prose} - {best[0]}]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["host", "path", "size", "won"])

    return pages.select("host", "html").mapInArrow(tidy(run), "host string, path string, size long, won long")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text per row. Votes are one row for each host and path, summed before they are shuffled."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"))
    tally = votes(rows).groupBy("host", "path").agg(F.sum("size").alias("size"), F.sum("won").alias("n"), F.count("*").alias("seen")).where("n > 0")
    # of paths that won, the first by votes, and those that are best on less than half of the pages that have them
    lost = F.collect_list(F.when(F.col("n") * 2 < F.col("seen"), F.col("path")))
    first = F.min_by("path", F.struct((-F.col("size")).alias("size"), (-F.col("n")).alias("n"), "path"))
    winner = park(tally.groupBy("host").agg(first.alias("path"), lost.alias("losers")), "winners")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [extracted(h.as_py() or "", p, set(x or ())) for h, p, x in zip(part.column(2), part.column(3).to_pylist(), part.column(4).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kinds = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string"
    return rows.join(winner, "host", "left").select("page_id", "url", "html", "path", "losers").mapInArrow(tidy(run), kinds)


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
