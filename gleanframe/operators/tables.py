"""HTML tables: layout, headers, sections, claims and Markdown.

Cutting markup needs a parser, so one Arrow function reads a table from its markup to the cells that
become claims, row by row; names, units and all else are expressions. No step shuffles.
A cell with spans is kept as a rectangle and laid out one row at a time.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import TEXT_NUMBER
from ..functions.text import PART, joined_context, unit_of
from ..schemas import PARSED
from ..shipping import ship

#: Columns that may hold row labels, and header rows of a rendered table, at most.
LABEL_COLUMNS, RENDERED_HEADERS = 5, 3
#: The greatest spans that HTML allows; greater ones count as these.
SPANS = {"colspan": 1000, "rowspan": 65534}
#: Claims in a row of ``read_tables``, runs of a table that are kept rather than laid out again, and tables in a batch, at most.
CLAIMS_A_ROW, KEPT_RUNS, TABLES_A_BATCH = 2000, 20_000, 200

_NUMBER = re.compile(TEXT_NUMBER, re.ASCII)
_DIGIT = re.compile("[0-9]")
#: White space as Unicode has it.
_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_CLAIM = "array<struct<row:int,col:int,section:string,path:string,heading:string,value:string>>"

#: A stretch of a row: first column, column behind it, text, is header, has a number.
Run = tuple[int, int, str, bool, bool]


def _spans(given: dict) -> tuple[int, ...]:
    """Columns and rows that a cell with these attributes spans."""
    return tuple(min(max(1, int(v)), most) if (v := (given.get(k) or "1").strip()).isascii() and v.isdigit() else 1 for k, most in SPANS.items())


class _Cells(HTMLParser):
    """Rows of (text, is header, column span, row span)."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[tuple[str, bool, int, int]]] = []
        self.row: list | None = None
        self.cell: list | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "tr":
            self.row = []
        elif tag in ("td", "th"):
            self.cell = [[], tag == "th", *(_spans(dict(attrs)) if attrs else (1, 1))]

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell[0].append(data)

    def handle_endtag(self, tag: str) -> None:
        if tag == "tr":
            if self.row:
                self.rows.append(self.row)
            self.row = None
        elif tag in ("td", "th") and self.cell:
            if self.row is not None:
                self.row.append(("".join(self.cell[0]), *self.cell[1:]))
            self.cell = None


#: A tag without angle brackets in its attributes, what needs the whole parser, and an attribute.
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/<>]*)([^<>]*)>")
_HARD = re.compile(r"<[!?]|<(?:script|style|textarea|title|iframe|noembed|noframes|plaintext|xmp|noscript|svg|math)\b", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")


#: A table of nothing but rows and closed cells with spans, and a cell of it.
_MORE = r"(?: (?:col|row)span=(?:\"[0-9]{1,9}\"|'[0-9]{1,9}'|[0-9]{1,9}))*"
_SIMPLE = re.compile(rf"(?:<table>)?(?:<tr>(?:<td{_MORE}>[^<]*</td>|<th{_MORE}>[^<]*</th>)*+</tr>)*+(?:</table>)?")
_CELL = re.compile(rf"<t([dh])({_MORE})>([^<]*)<")


@functools.lru_cache(maxsize=1000)
def _given_spans(attributes: str) -> tuple[int, ...]:
    return _spans({m[1]: m[2] or m[3] or m[4] for m in _ATTRIBUTE.finditer(attributes)}) if attributes else (1, 1)


def _unclear(attributes: str) -> bool:
    """Whether quotes or a slash leave open where the attributes end."""
    return attributes.count('"') % 2 == 1 or attributes.count("'") % 2 == 1 or ('"' in attributes and "'" in attributes) or ("=" in attributes and attributes.endswith("/"))


def _parsed(html: str | None) -> list[list[tuple[str, bool, int, int]]]:
    """Rows of cells. Simple markup is cut by rows, plain one by a pattern, ten times as fast as the parser, which takes all other."""
    if html and _SIMPLE.fullmatch(html):
        if "&" in html:
            return [[(unescape(text), kind == "h", *_given_spans(more)) for kind, more, text in cells] for row in html.split("</tr>") if (cells := _CELL.findall(row))]
        return [[(text, kind == "h", *_given_spans(more)) for kind, more, text in cells] for row in html.split("</tr>") if (cells := _CELL.findall(row))]
    parser = _Cells()
    if not _HARD.search(html or ""):
        parts = _TAG.split(html or "")
        if not any("<" in x for x in parts[::4]) and not any(x and _unclear(x) for x in parts[3::4]):
            for text, end, tag, more in zip(parts[::4], parts[1::4], parts[2::4], parts[3::4], strict=False):
                if text and parser.cell is not None:
                    parser.cell[0].append(unescape(text) if "&" in text else text)
                tag = tag.lower()
                if tag in ("td", "th", "tr"):
                    if end:
                        parser.handle_endtag(tag)
                    else:
                        parser.handle_starttag(tag, [(m[1].lower(), m[2] or m[3] or m[4]) for m in _ATTRIBUTE.finditer(more)] if "=" in more else [])
                        if more.endswith("/"):
                            parser.handle_endtag(tag)
            return parser.rows
    parser.feed(html or "")
    parser.close()
    return parser.rows


def laid_out(rows: list[list[tuple[str, bool, int, int]]]) -> Iterator[list[Run]]:
    """Each row's runs from left to right: its own cells and those that reach down into it.

    A cell begins at the first free column; where it spans taken ones, it covers them.
    """
    reaching: list[tuple[int, int, int, str, bool, bool]] = []  # row behind the last, then a run
    for r, cells in enumerate(rows):
        if reaching:
            reaching = [x for x in reaching if x[0] > r]
        if not reaching and all(x[3] == 1 for x in cells):  # nothing reaches into this row or out of it
            at, runs = 0, []
            for text, header, wide, _ in cells:
                text = _BLANK.sub(" ", text).strip(" ")
                runs.append((at, at + wide, text, header, _NUMBER.search(text) is not None))
                at += wide
            yield runs
            continue
        taken = sorted((x[1], x[2]) for x in reaching)
        at = k = 0
        for text, header, wide, high in cells:
            while k < len(taken) and taken[k][0] <= at:
                at = max(at, taken[k][1])
                k += 1
            text = _BLANK.sub(" ", text).strip(" ")
            reaching.append((r + high, at, at + wide, text, header, _NUMBER.search(text) is not None))
            at += wide
        yield _uncovered([x[1:] for x in reaching])


def _uncovered(runs: list[Run]) -> list[Run]:
    """Runs in order of their columns, without what a later one covers."""
    runs = sorted(enumerate(runs), key=lambda x: x[1][0])
    if all(a[1][1] <= b[1][0] for a, b in zip(runs, runs[1:], strict=False)):
        return [x for _, x in runs]
    out: list[Run] = []
    edges = sorted({e for _, x in runs for e in x[:2]})
    for a, z in zip(edges, edges[1:], strict=False):
        over = max(((n, x) for n, x in runs if x[0] <= a and x[1] >= z), default=None, key=lambda x: x[0])
        if over is not None:
            out.append((a, z, *over[1][2:]))
    return out


def grid_of(html: str | None) -> Iterator[tuple[int, int, str, bool]]:
    """(row, column, text, is header) of a table's cells, spans expanded; cells below the last row are left out."""
    for r, runs in enumerate(laid_out(_parsed(html))):
        for a, z, text, header, _ in runs:
            for c in range(a, z):
                yield r, c, text, header


class _Table:
    """A table's rows, as often as they are asked for, its width, header rows and label columns."""

    def __init__(self, html: str | None):
        self.source, self.kept = _parsed(html), []
        self.width, heads, runs_so_far, first_columns = 0, [], 0, []
        for runs in laid_out(self.source):
            runs_so_far += len(runs)
            if runs_so_far <= KEPT_RUNS:
                self.kept.append(runs)
            self.width = max(self.width, runs[-1][1] if runs else 0)
            wide, number_in_body, firsts = 0, False, []
            for a, z, text, header, number in runs:
                if header:
                    wide += z - a
                elif number:
                    number_in_body = True
                if a <= LABEL_COLUMNS:
                    firsts.append((a, min(z, LABEL_COLUMNS + 1), text, number))
            heads.append((wide, number_in_body))
            first_columns.append(firsts)
        if runs_so_far > KEPT_RUNS:
            self.kept = []
        is_head = [n >= max(1, self.width // 2) and not valued for n, valued in heads]
        first = is_head.index(True) if True in is_head else len(is_head)
        stop = next((r for r in range(first, len(is_head)) if not is_head[r]), len(is_head))
        self.header = range(first, stop)  # the first run of header rows alone
        seen, valued, filled = set(), set(), set()
        for r, firsts in enumerate(first_columns):
            body = r not in self.header
            for a, z, text, number in firsts:
                for c in range(a, z):
                    seen.add(c)
                    if body and text:
                        filled.add(c)
                        if number:
                            valued.add(c)
        ends = [c for c in sorted(seen) if c in valued or c not in filled or c >= LABEL_COLUMNS]
        self.labels = max(1, ends[0] if ends else self.width)

    def rows(self) -> Iterator[list[Run]]:
        return iter(self.kept) if self.kept else laid_out(self.source)

    def claims(self) -> Iterator[tuple[int, int, str | None, str | None, str | None, str]]:
        """(row, column, section, labels, heading, value) of each cell with a number beside the label columns.

        A row with one label alone is a section; blank labels repeat the one above.
        """
        above: list[list[Run]] = []
        headings: dict[int, str | None] = {}
        section, label = None, [""] * LABEL_COLUMNS

        def heading(c: int) -> str | None:
            if c not in headings:
                texts = [text for runs in above for a, z, text, *_ in runs if a <= c < z and text]
                headings[c] = " ".join(dict.fromkeys(texts)) or None
            return headings[c]

        if self.header:
            for r, runs in enumerate(self.rows()):
                if r >= self.header.stop:
                    break
                if r in self.header:
                    above.append(runs)
        for r, runs in enumerate(self.rows()):
            if r in self.header:
                continue
            kinds = {text: number for _, _, text, _, number in runs if text}
            if len(kinds) == 1 and self.width > 1 and not any(kinds.values()):
                section = next(iter(kinds))
                continue
            for a, z, text, *_ in runs:
                if a >= LABEL_COLUMNS:
                    break
                if text:
                    label[a : min(z, LABEL_COLUMNS)] = [text] * (min(z, LABEL_COLUMNS) - a)
            path = PART.join(x for x in label[: self.labels] if x) or None
            for a, z, text, _, number in runs:
                if number:
                    for c in range(max(a, self.labels), z):
                        yield r, c, section, path, heading(c), text

    def markdown(self) -> str | None:
        """The table as Markdown; its header is made of the leading rows without any digit, up to three and one at least, merged by column."""
        if not self.width:
            return None
        lines, plain = [], 0
        for r, runs in enumerate(self.rows()):
            line = [""] * self.width
            for a, z, text, *_ in runs:
                line[a:z] = [text] * (z - a)
            if plain == r < RENDERED_HEADERS and not any(_DIGIT.search(x[2]) for x in runs):
                plain = r + 1
            lines.append(line if r < RENDERED_HEADERS else f"| {' | '.join(line)} |")
        n = max(1, plain)
        merged = [" ".join(dict.fromkeys(x for x in column if x)) for column in zip(*lines[:n], strict=True)]
        shown = [merged, ["---"] * self.width, *lines[n:]]
        return "\n".join(x if isinstance(x, str) else f"| {' | '.join(x)} |" for x in shown)


_CLAIMS_TYPE = pa.list_(pa.struct([("row", pa.int32()), ("col", pa.int32()), *[(x, pa.string()) for x in ("section", "path", "heading", "value")]]))


def _columns(claims: list[list[tuple]]) -> pa.Array:
    """The claims of several rows as one array, made column by column."""
    offsets = [0]
    for x in claims:
        offsets.append(offsets[-1] + len(x))
    kind = _CLAIMS_TYPE.value_type
    columns = list(zip(*[c for x in claims for c in x], strict=True)) or [()] * kind.num_fields
    each = pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(columns, kind, strict=True)], fields=list(kind))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), each, type=_CLAIMS_TYPE)


def read_tables(tables: DataFrame, key: str, html: str, render: bool = True, claim: bool = True) -> DataFrame:
    """(key, part, markdown, claims) of all tables: a row each, more where a table has very many claims; ``markdown`` in the first, if it has cells.

    Without ``render`` there is no Markdown, without ``claim`` there are no claims.
    """
    kind = tables.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made: list[tuple] = []
            held = 0

            def flush(key_type=b.column(0).type) -> pa.RecordBatch:
                *columns, claims = zip(*made, strict=True)
                kinds = (key_type, pa.int32(), pa.string())
                return pa.record_batch([*[pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], _columns(claims)], names=["key", "part", "markdown", "claims"])

            for k in range(b.num_rows):  # one table's text at a time
                table, part, some = _Table(b.column(1)[k].as_py()), 0, []
                own = b.column(0)[k].as_py()
                shown = table.markdown() if render else None
                for one in table.claims() if claim else ():
                    some.append(one)
                    if len(some) == CLAIMS_A_ROW:
                        made.append((own, part, shown if part == 0 else None, some))
                        part, some = part + 1, []
                        yield flush()
                        made, held = [], 0
                if some or part == 0:
                    made.append((own, part, shown if part == 0 else None, some))
                held += 1 + len(some) // 20 + len(shown or "") // 1000
                if held >= TABLES_A_BATCH:
                    yield flush()
                    made, held = [], 0
            if made:
                yield flush()

    ship(tables.sparkSession)
    return tables.select(F.col(key).alias("key"), html).mapInArrow(work, f"key {kind}, part int, markdown string, claims {_CLAIM}")


def table_claims(tables: DataFrame, key: str = "key", html: str = "html", title: str | None = None, read: DataFrame | None = None) -> DataFrame:
    """A claim for each cell with a number beside the label columns: (key, row, col, field_name, canonical_metric, value, ...).

    Names run from title and section over the row's labels to the column's headers. A row with one
    label alone is a section; blank labels repeat the one above. ``read`` is what ``read_tables``
    gave, if it is written already.
    """
    done = read_tables(tables, key, html, render=False) if read is None else read
    values = done.select("key", F.explode("claims").alias("x")).select("key", "x.*")
    if title:
        values = values.join(tables.select(F.col(key).alias("key"), F.col(title).alias("_title")), "key")
    parts = [F.col(x) for x in (["_title"] if title else []) + ["section", "path", "heading"]]
    return values.select(
        F.col("key").alias(key), "row", "col", F.coalesce("heading", F.lit("value")).alias("field_name"), F.coalesce(joined_context(*parts), F.lit("value")).alias("canonical_metric"),
        "value", unit_of(F.col("value")).alias("unit"), F.lit("table").alias("element_type"), F.lit(0.9).alias("confidence"), F.lit(PARSED).alias("citation_tier"),
    )


def whole_table_claims(tables: DataFrame, claims: DataFrame, key: str = "key", html: str = "html") -> DataFrame:
    """Tables with content but without claims, as one claim each."""
    rest = tables.where(F.trim(F.coalesce(html, F.lit(""))) != "").join(claims.select(key).distinct(), key, "left_anti")
    return rest.select(key, F.lit("table").alias("field_name"), F.trim(html).alias("value"), F.coalesce("confidence", F.lit(1.0)).alias("confidence"))


def markdown(tables: DataFrame, key: str = "key", html: str = "html", read: DataFrame | None = None) -> DataFrame:
    """(key, markdown) of each table with cells."""
    done = read_tables(tables, key, html, claim=False) if read is None else read
    return done.where("part = 0 and markdown is not null").select(F.col("key").alias(key), "markdown")
