"""Page counts of raw files, whatever a parser found in them: slides of presentations, pages of PDF and of text documents.

Only directories of a file are read: a ZIP's list of parts, a PDF's trailer, cross-references and page tree.
"""

from __future__ import annotations

import contextlib
import io
import re
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship

_SLIDE = re.compile(r"ppt/slides/slide\d+\.xml")
_PAGES = re.compile(rb"<(?:\w+:)?Pages>\s*(\d+)\s*<")
_SLIDE_ID = re.compile(rb"<(?:\w+:)?sldId\s")
_OBJECT = re.compile(rb"(\d+)\s+(\d+)\s+obj\b")
_REFERENCE = re.compile(rb"\s*(\d+)\s+(\d+)\s+R\b")
#: Deepest chain of references and of earlier cross-reference sections that is followed.
DEPTH = 1000


def zip_pages(content: bytes) -> int | None:
    """Slides that a presentation lists, or the pages that a text document says it has."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        if "ppt/presentation.xml" in names:
            listed = len(_SLIDE_ID.findall(z.read("ppt/presentation.xml")))
            return listed or sum(_SLIDE.fullmatch(x) is not None for x in names)
        if "docProps/app.xml" in names and any(x.startswith("word/") for x in names):
            found = _PAGES.search(z.read("docProps/app.xml"))
            return int(found[1]) if found else None
    return None


def _value(dictionary: bytes, name: bytes) -> bytes | None:
    """What follows a name in a dictionary."""
    found = re.search(rb"/" + name + rb"(?![A-Za-z])\s*", dictionary)
    return dictionary[found.end() :] if found else None


def _number(dictionary: bytes, name: bytes) -> int | None:
    value = _value(dictionary, name)
    found = re.match(rb"[+-]?\d+(?!\s+\d+\s+R\b)", value) if value is not None else None
    return int(found[0]) if found else None


def _reference(dictionary: bytes, name: bytes) -> int | None:
    value = _value(dictionary, name)
    found = _REFERENCE.match(value) if value is not None else None
    return int(found[1]) if found else None


class Pdf:
    """The objects of a PDF by number, through its cross-reference tables and streams."""

    def __init__(self, content: bytes):
        self.content, self.places, self.root = content, {}, None
        starts = re.findall(rb"startxref\s+(\d+)", content[-2048:])
        at, seen = int(starts[-1]) if starts else None, set()
        with contextlib.suppress(ValueError, TypeError, KeyError, IndexError, zlib.error):  # a damaged section is as good as none
            while at is not None and at not in seen and len(seen) < DEPTH:
                seen.add(at)
                at = self._section(at)
        if self.root is None or self.root not in self.places:
            self._scanned()

    def _scanned(self) -> None:
        """A damaged file: its objects by looking for them."""
        self.places = {int(m[1]): m.start() for m in _OBJECT.finditer(self.content)}
        roots = [int(m[1]) for m in re.finditer(rb"/Root\s+(\d+)\s+\d+\s+R", self.content)]
        if roots:
            self.root = roots[-1]

    def _section(self, at: int) -> int | None:
        """Take in a section of cross-references; where the one before it is."""
        text = self.content
        if text[at : at + 4] == b"xref":
            stop = text.find(b"trailer", at)
            lines, k = text[at + 4 : stop].split(), 0
            while k + 1 < len(lines):
                first, n = int(lines[k]), int(lines[k + 1])
                k += 2
                for i in range(n):
                    if k + 2 < len(lines) and lines[k + 2] == b"n":
                        self.places.setdefault(first + i, int(lines[k]))
                    k += 3
            trailer = text[stop : text.find(b"startxref", stop)]
            hybrid = _number(trailer, b"XRefStm")
            if hybrid is not None:
                self._section(hybrid)
        else:
            trailer, data = self._stream(at)
            widths = [int(x) for x in re.match(rb"\[([\d\s]*)\]", _value(trailer, b"W") or b"[]")[1].split()]
            listed = re.match(rb"\[([\d\s]*)\]", _value(trailer, b"Index") or b"")
            ranges = [int(x) for x in listed[1].split()] if listed else [0, _number(trailer, b"Size") or 0]
            k = 0
            for first, n in zip(ranges[::2], ranges[1::2], strict=False):
                for i in range(n):
                    entry = []
                    for w in widths:
                        entry.append(int.from_bytes(data[k : k + w], "big") if w else 1)
                        k += w
                    if entry[0] == 1:
                        self.places.setdefault(first + i, entry[1])
                    elif entry[0] == 2:
                        self.places.setdefault(first + i, (entry[1], entry[2]))
        if self.root is None:
            self.root = _reference(trailer, b"Root")
        return _number(trailer, b"Prev")

    def _stream(self, at: int) -> tuple[bytes, bytes]:
        """The dictionary and the plain content of the stream at an offset."""
        begin = self.content.index(b"stream", at)
        head = self.content[at:begin]
        begin += 8 if self.content[begin + 6 : begin + 8] == b"\r\n" else 7
        size = _number(head, b"Length")
        if size is None:
            holder = _reference(head, b"Length")
            size = int(re.search(rb"obj\s+(\d+)", self.content[self.places[holder] :])[1])
        data = self.content[begin : begin + size]
        if b"/FlateDecode" in head:
            data = zlib.decompressobj().decompress(data)
        columns = _number(head, b"Columns")
        if (_number(head, b"Predictor") or 1) >= 10 and columns:
            data = self._unpredicted(data, columns)
        return head, data

    @staticmethod
    def _unpredicted(data: bytes, columns: int) -> bytes:
        """Rows of differences (PNG's filters none, sub and up) added up."""
        out, before = [], bytes(columns)
        for k in range(0, len(data), columns + 1):
            kind, row = data[k], bytearray(data[k + 1 : k + 1 + columns])
            if kind == 2:
                row = bytearray((a + b) & 255 for a, b in zip(row, before, strict=False))
            elif kind == 1:
                for i in range(1, len(row)):
                    row[i] = (row[i] + row[i - 1]) & 255
            elif kind:
                raise ValueError("a filter of cross-references")
            before = bytes(row)
            out.append(before)
        return b"".join(out)

    def object(self, number: int) -> bytes:
        """The text of an object, without its stream."""
        place = self.places[number]
        if isinstance(place, tuple):
            head, data = self._stream(self.places[place[0]])
            n, first = _number(head, b"N"), _number(head, b"First")
            pairs = [int(x) for x in data[:first].split()[: 2 * n]]
            own = dict(zip(pairs[::2], pairs[1::2], strict=True))
            later = sorted(x for x in own.values() if x > own[number])
            return data[first + own[number] : first + later[0] if later else None]
        start = self.content.find(b"obj", place) + 3
        ends = [x for x in (self.content.find(b"endobj", start), self.content.find(b"stream", start)) if x >= 0]
        return self.content[start : min(ends, default=None)]

    def pages(self) -> int:
        """Leaves of the page tree; its own count where it can't be walked."""
        top = _reference(self.object(self.root), b"Pages")
        counted = _number(self.object(top), b"Count")
        todo, seen, n = [top], set(), 0
        while todo:
            k = todo.pop()
            if k in seen or k not in self.places:
                return counted
            seen.add(k)
            node = self.object(k)
            kids = _value(node, b"Kids")
            if kids is None:
                n += 1
                continue
            listed = re.match(rb"\[([^\]]*)\]", kids)
            if listed is None:
                return counted
            todo += [int(x) for x, _ in re.findall(rb"(\d+)\s+(\d+)\s+R", listed[1])]
        return n


def page_count(path: str, content: bytes | None) -> int | None:
    """Pages of a file by its name's ending and its content; null for other kinds and for files that can't be read."""
    ending = path.rpartition(".")[2].lower()
    try:
        if ending == "pdf":
            return Pdf(content).pages()
        if ending in ("pptx", "potx", "docx"):
            return zip_pages(content)
    except Exception:  # a damaged file has no count, and fails nothing
        return None
    return None


def page_counts(files: DataFrame) -> DataFrame:
    """(path, document, total_pages) of files (path, content); the document is the file's name without its ending."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = b.column(0).to_pylist()
            counts = [page_count(p or "", b.column(1)[k].as_py()) for k, p in enumerate(paths)]
            yield pa.record_batch([b.column(0), pa.array(counts, pa.int32())], names=["path", "total_pages"])

    ship(files.sparkSession)
    counted = files.select("path", "content").mapInArrow(work, "path string, total_pages int")
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(?i)\.(pptx|pdf|docx|xlsx|potx|ppt)$", "")
    return counted.select("path", name.alias("document"), "total_pages")
