"""EPUB books as ordered blocks. One archive is the work of one row; the XML never leaves its task.

A block remembers where it came from (its element, or the navigation labels and image texts that
named it), so that the writer in operators.epub can put a translation back there.
"""

from __future__ import annotations

import io
import posixpath
import re
import sys
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.placeholders import encode_py

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CONTAINER = "META-INF/container.xml"
DC, OPF, OPS, XLINK, XML = "http://purl.org/dc/elements/1.1/", "http://www.idpf.org/2007/opf", "http://www.idpf.org/2007/ops", "http://www.w3.org/1999/xlink", "http://www.w3.org/XML/1998/namespace"
NCX, XHTML = "application/x-dtbncx+xml", ("application/xhtml+xml", "text/html")
BLOCKS = frozenset(["p", "li", "dt", "dd", "pre", *(f"h{i}" for i in range(1, 7))])
SILENT = frozenset(["rt", "rp", "script", "style", "image", "svg"])
EDGE = " \t\r\n"


class EpubError(ValueError):
    """stage and message, and where: member, block, segment, and what was expected and found."""

    def __init__(self, stage: str, message: str, **where):
        super().__init__(message)
        self.stage, self.message, self.where = stage, message, where

    def row(self) -> dict:
        return {"stage": self.stage, "message": self.message} | {k: None if self.where.get(k) is None else str(self.where[k]) for k in ("member", "block_index", "segment_id", "expected", "actual")}


def local(element: ET.Element) -> str:
    return element.tag.rsplit("}", 1)[-1] if isinstance(element.tag, str) else ""


def descendants(root: ET.Element, *names: str) -> Iterator[ET.Element]:
    return (e for e in root.iter() if local(e) in names)


def first(root: ET.Element, name: str) -> ET.Element | None:
    return next(descendants(root, name), None)


def resolved(base: str, href: str) -> str:
    """The member that href names, seen from base; a path that leaves the archive is an error."""
    path = posixpath.normpath(posixpath.join(posixpath.dirname(base), unquote(urlsplit(href).path)))
    if path.startswith("/") or path.split("/")[0] == "..":
        raise EpubError("input", "reference leaves the archive", actual=href)
    return path


def inline(element: ET.Element, images: bool = False) -> str:
    """Visible text: line ends of the source vanish, br is one, ruby readings are silent, images are tokens if asked for."""
    flat = lambda s: s.replace("\n", "").replace("\r", "") if s else ""
    if not len(element):
        return flat(element.text).strip(EDGE)
    parts: list[str] = []

    def walk(e: ET.Element) -> None:
        parts.append(flat(e.text))
        for child in e:
            name = local(child)
            if name == "br":
                parts.append("\n")
            elif name == "img":
                if images:
                    parts.append(encode_py(child.get("src", ""), child.get("alt", "")))
            elif name and name not in SILENT:
                walk(child)
            parts.append(flat(child.tail))

    walk(element)
    return "".join(parts).strip(EDGE)


def alt_texts(element: ET.Element) -> dict[str, list[ET.Element]]:
    """Image texts in order, each with its images."""
    out: dict[str, list[ET.Element]] = {}
    for image in descendants(element, "img"):
        if alt := image.get("alt", "").strip(EDGE):
            out.setdefault(alt, []).append(image)
    return out


def outermost_blocks(body: ET.Element) -> list[ET.Element]:
    found, stack = [], [body]
    while stack:
        for child in reversed(list(e := stack.pop())):
            stack.append(child)
        if e is not body and local(e) in BLOCKS:
            found.append(e)
            # what lies inside belongs to it
            del stack[len(stack) - len(e) :]
    return found


@dataclass
class Target:
    """A place that shows a heading: a navigation label, a heading's element or an image's text."""

    kind: str
    member: str
    element: ET.Element


@dataclass
class Label:
    path: str
    fragment: str
    text: str
    target: Target


@dataclass
class Block:
    kind: str  # book_title, heading or body
    text: str  # Markdown
    member: str
    element: ET.Element | None = None
    targets: list[Target] = field(default_factory=list)


class Book:
    """An archive, opened and checked."""

    def __init__(self, data: bytes, strict: bool = False):
        try:
            self.zip = zipfile.ZipFile(io.BytesIO(data))
        except zipfile.BadZipFile as e:
            raise EpubError("input", f"no ZIP archive: {e}") from None
        self.roots: dict[str, ET.Element] = {}
        self.members: dict[str, bytes] = {}
        if strict:
            self._check()
        self.opf = self._rootfile()
        self.package = self.parse(self.opf)
        self.manifest = {e.get("id").strip(): e for e in descendants(self.package, "item") if (e.get("id") or "").strip() and (e.get("href") or "").strip()}
        spine = first(self.package, "spine")
        if spine is None:
            raise EpubError("input", "the package has no spine")
        self.spine = [e.get("idref") for e in spine if local(e) == "itemref" and e.get("idref") and e.get("linear", "yes").lower() != "no"]
        if not self.spine:
            raise EpubError("input", "the spine has nothing to read")

    def _check(self) -> None:
        names = self.zip.namelist()
        if twice := sorted(n for n in set(names) if names.count(n) > 1):
            raise EpubError("input", "member names repeat", actual=", ".join(twice[:10]))
        for n in names:
            path = posixpath.normpath(n.replace("\\", "/"))
            if path.startswith("/") or path.split("/")[0] == "..":
                raise EpubError("input", "a member's path is unsafe", member=n)
        if "mimetype" not in names or self.read("mimetype") != b"application/epub+zip":
            raise EpubError("input", "the mimetype member is missing or wrong")
        for n in names:
            self.read(n)

    def read(self, member: str) -> bytes:
        """A member's bytes, unpacked and summed once."""
        if member not in self.members:
            try:
                self.members[member] = self.zip.read(member)
            except KeyError:
                raise EpubError("input", "the member is missing", member=member) from None
            except zipfile.BadZipFile:
                raise EpubError("input", "a checksum is wrong", member=member) from None
        return self.members[member]

    def parse(self, member: str) -> ET.Element:
        if member not in self.roots:
            try:
                self.roots[member] = ET.fromstring(self.read(member))
            except ET.ParseError as e:
                raise EpubError("input", f"XML is not well formed: {e}", member=member) from None
        return self.roots[member]

    def _rootfile(self) -> str:
        for e in descendants(self.parse(CONTAINER), "rootfile"):
            if path := e.get("full-path", "").strip():
                return path
        raise EpubError("input", "the container names no package")

    def media_type(self, item: ET.Element) -> str:
        return item.get("media-type", "").strip()

    def member_of(self, item: ET.Element) -> str:
        return resolved(self.opf, item.get("href").strip())

    def title(self, fallback: str) -> str:
        return next((t for e in self.package.iter(f"{{{DC}}}title") if (t := "".join(e.itertext()).strip(EDGE))), fallback)

    def documents(self) -> list[str]:
        out = []
        for key in self.spine:
            if key not in self.manifest:
                raise EpubError("input", "the spine names an unknown item", actual=key)
            if self.media_type(self.manifest[key]) in XHTML:
                out.append(self.member_of(self.manifest[key]))
        return out

    def _label(self, base: str, href: str, text: str, element: ET.Element) -> Label | None:
        if not href or not text:
            return None
        return Label(resolved(base, href), unquote(urlsplit(href).fragment), text, Target("navigation", base, element))

    def labels(self) -> list[Label]:
        """Of the EPUB 3 contents, or else of the NCX."""
        found: list[Label | None] = []
        nav = next((i for i in self.manifest.values() if "nav" in i.get("properties", "").split()), None)
        if nav is not None:
            base = self.member_of(nav)
            toc = next((e for e in descendants(self.parse(base), "nav") if "toc" in e.get(f"{{{OPS}}}type", "").split()), None)
            found = [self._label(base, a.get("href", ""), inline(a), a) for a in descendants(toc, "a")] if toc is not None else []
        if not any(found):
            spine = first(self.package, "spine")
            ncx = self.manifest.get(spine.get("toc", ""))
            if ncx is None:
                ncx = next((i for i in self.manifest.values() if self.media_type(i) == NCX), None)
            if ncx is not None:
                base = self.member_of(ncx)
                for point in descendants(self.parse(base), "navPoint"):
                    content, label = first(point, "content"), next((e for e in point if local(e) == "navLabel"), None)
                    if content is not None and label is not None:
                        shown = first(label, "text")
                        found.append(self._label(base, content.get("src", ""), inline(label), label if shown is None else shown))
        return [x for x in found if x]

    def blocks(self, fallback_title: str) -> list[Block]:
        out = [Block("book_title", f"# {self.title(fallback_title)}", self.opf)]
        labels: dict[str, list[Label]] = {}
        for x in self.labels():
            labels.setdefault(x.path, []).append(x)
        for member in self.documents():
            # a heading is merged with an equal one right before it in the same document
            out += self._document(member, labels.get(member, []))
        return out

    def _document(self, member: str, labels: list[Label]) -> list[Block]:
        body = first(self.parse(member), "body")
        if body is None:
            return []
        elements = outermost_blocks(body)
        if not elements:
            text = inline(body)
            return [Block("body", text, member, body)] if text else []
        out: list[Block] = []

        def heading(text: str, level: int, targets: list[Target]) -> None:
            line = f"{'#' * level} {text}"
            if not out or out[-1].text != line:
                out.append(Block("heading", line, member))
            known = {(t.kind, id(t.element)) for t in out[-1].targets}
            out[-1].targets += [t for t in targets if (t.kind, id(t.element)) not in known]

        whole: dict[str, list[Target]] = {}
        for x in labels:
            if not x.fragment:
                whole.setdefault(x.text, []).append(x.target)
        if any(inline(e) or alt_texts(e) for e in elements):
            for text, targets in whole.items():
                heading(text, 2, targets)
        for e in elements:
            ids = {x.get("id") for x in e.iter() if x.get("id")}
            named: dict[str, tuple[int, list[Target]]] = {}
            for x in labels:
                if x.fragment and x.fragment in ids:
                    named.setdefault(x.text, (2, []))[1].append(x.target)
            plain = inline(e)
            if not plain:
                for text, images in alt_texts(e).items():
                    named.setdefault(text, (2, []))[1].extend(Target("image_alt", member, i) for i in images)
            text = (inline(e, images=True) if len(e) else plain) if plain else ""
            level = int(local(e)[1]) if re.fullmatch("h[1-6]", local(e)) else 0
            if level and text:
                named.setdefault(text, (min(level + 1, 6), []))
            if text and text in named:
                named[text][1].append(Target("element", member, e))
            elif text and text in whole and out and out[0].text == f"## {text}":
                out[0].targets.append(Target("element", member, e))
            for t, (depth, targets) in named.items():
                heading(t, depth, targets)
            if text and not level and text not in named and text not in whole:
                out.append(Block("body", text, member, e))
        return out


def markdown(blocks: list[Block]) -> str:
    return "\n\n".join(b.text for b in blocks) + "\n"


KINDS = "book_id string, block_index int, kind string, text string, member string, error struct<stage: string, message: string, member: string, block_index: string, segment_id: string, expected: string, actual: string>"
ERROR = pa.struct([(k, pa.string()) for k in ("stage", "message", "member", "block_index", "segment_id", "expected", "actual")])


#: What a task holds at once of what it reads (rows) and of what it makes (rows, characters or bytes).
TAKEN, HELD, HELD_SIZE = 64, 4096, 1 << 22


def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of batches as Python values, a few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, TAKEN):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, TAKEN).columns))


def gathered(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """rows as batches of a bounded size: a batch for each row costs more than most rows."""
    held, size = [], 0
    made = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, (str, bytes)))
        if len(held) >= HELD or size >= HELD_SIZE:
            yield made()
            held, size = [], 0
    if held:
        yield made()


def archives(spark: SparkSession, path: str) -> DataFrame:
    """book_id, content of every EPUB file."""
    x = spark.read.format("binaryFile").load(path)
    return x.select(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(?<=.)\.[^.]*$", "").alias("book_id"), "content")


def book_blocks(books: DataFrame) -> DataFrame:
    """One row per block (block_index from 1), or one with the error, of (book_id, content)."""

    schema = pa.schema(list(zip(["book_id", "block_index", "kind", "text", "member", "error"], (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), ERROR))))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for book_id, data in taken(batches):
            try:
                for i, b in enumerate(Book(data).blocks(book_id or ""), 1):
                    yield book_id, i, b.kind, b.text, b.member, None
            except EpubError as e:
                yield book_id, None, None, None, None, e.row()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return gathered(rows(batches), schema)

    return books.select("book_id", "content").where("content is not null").mapInArrow(run, KINDS)


def as_books(blocks: DataFrame) -> DataFrame:
    """book_id, text (Markdown), documents, headings, paragraphs of books without error."""
    good = blocks.where("error is null")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_index", "text"))), lambda b: b["text"]), "\n\n")
    return good.groupBy("book_id").agg(
        F.concat(text, F.lit("\n")).alias("text"),
        F.count_distinct(F.when(F.col("kind") != "book_title", F.col("member"))).alias("documents"),
        F.count_if(F.col("kind") != "body").alias("headings"),
        F.count_if(F.col("kind") == "body").alias("paragraphs"),
    )
