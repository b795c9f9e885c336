"""WARC archives: writing with payload deduplication, segmentation and chunked transfer, and reading back.

A payload that several records share is stored once, by the record of the smallest id; the others
are revisits. Blocks above a size are split into a first record and continuations. The reader
groups continuations by the identifier of their origin, orders them by segment number, verifies
the total length, and decodes the chunked framing.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batch, callers_path, file_system, operator, qualified, rows_of, staged, write_whole

#: Payloads below this are stored again rather than revisited.
LEAST_REVISITED = 100
#: A record's block has so many bytes at most; longer ones are split.
SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records don't carry the time of writing, so that a task that runs again writes the same bytes.
DATE = "1970-01-01T00:00:00Z"


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as a gzip member."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    data = f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    return gzip.compress(data, compresslevel=4, mtime=0)


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [payload[a : a + size] for a in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(x), x) for x in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped. ValueError if it is malformed."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            raise ValueError("no chunk size")
        n, at = int(size, 16), end + 2
        if not n:
            return b"".join(out)
        if body[at + n : at + n + 2] != b"\r\n":
            raise ValueError("a chunk is cut off")
        out.append(body[at : at + n])
        at += n + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no HTTP header")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:.*\bchunked\s*$", head) else body


def uri_safe(url: str | None) -> str | None:
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def page_records(page: int, url: str | None, payload: bytes, digest: str, refers: int | None, limit: int, copy: str = "0.0") -> Iterator[bytes]:
    """The record of a page and its continuations; ``copy`` tells rows of one page apart."""
    name = f"<urn:page:{page}:{copy}>"
    fields = [("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", name), ("WARC-Date", DATE)]
    if (target := uri_safe(url)) is not None:
        fields.append(("WARC-Target-URI", target))
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers is not None:
        yield record([*fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers}>")], head)
        return
    block = head + chunked(payload)
    if len(block) <= limit:
        yield record(fields, block)
        return
    parts = [block[a : a + limit] for a in range(0, len(block), limit)]
    yield record([*fields, ("WARC-Segment-Number", "1")], parts[0])
    for k, part in enumerate(parts[1:], 2):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{k}>"), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(k))]
        yield record(more + [("WARC-Segment-Total-Length", str(len(block)))] * (k == len(parts)), part)


@operator
def write_archives(
    pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", *, folder: str | None = None, segment_bytes: int = SEGMENT_BYTES
) -> DataFrame:
    """Write a record for each page, a file for each task with rows; returns (path, records).

    Null html is the empty payload; a null url is left out. Of equal payloads of 100 bytes or more
    the page of the smallest id is a response and the others revisit it. Equality is found by the
    payloads' SHA-256 before anything is written; only digests that occur twice come back, and
    Spark broadcasts them if their measured size allows it. Ids are any integers, not null. Rows
    that repeat an id have a record each; of those of the smallest id each is a response. A
    record's name holds the page and the row's place; a revisit names the page that it refers to.
    Other columns are ignored, whatever their names. An empty table gives no files.
    """
    folder = qualified(pages.sparkSession, folder or callers_path(pages.sparkSession, "warc"))
    system, base = file_system(folder)
    system.create_dir(base, recursive=True)
    text = F.coalesce(F.col(html), F.lit(""))
    known = pages.select(F.col(id).cast("long").alias("id"), F.col(url).alias("url"), text.alias("html"), F.sha2(text, 256).alias("digest"))
    big = known.where(F.octet_length("html") >= LEAST_REVISITED)
    shared = staged(big.groupBy("digest").agg(F.min("id").alias("original"), F.count("*").alias("n")).where("n > 1").select("digest", "original"), "payloads")
    marked = known.join(shared, "digest", "left").select("id", "url", "html", "digest", F.when(F.col("original") != F.col("id"), F.col("original")).alias("refers"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        rows = (r for b in rows_of(batches) for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        first = next(rows, None)
        if first is None:
            return
        task = TaskContext.get().partitionId()
        path, n = f"{base}/part-{task:06d}.warc.gz", 0

        def write(f) -> None:
            nonlocal n
            f.write(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{path.rpartition('/')[2]}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
            row, at = first, 0
            while row is not None:
                page, address, content, digest, refers = row
                for x in page_records(page, address, content.encode(), digest, refers, segment_bytes, f"{task}.{at}"):
                    f.write(x)
                    n += 1
                row, at = next(rows, None), at + 1

        write_whole(system, path, write)
        yield pa.record_batch([pa.array([f"{folder}/{path.rpartition('/')[2]}"]), pa.array([n])], names=["path", "records"])

    return staged(by_batch(marked, work, "path string, records long"), "archives")


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an uncompressed stream."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record")
        fields = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode().partition(":")
            fields[k.strip().lower()] = v.strip()
        n = int(fields["content-length"])
        block = stream.read(n)
        if len(block) != n:
            raise ValueError("a record is cut off")
        yield fields, block


def _page(name: str | None) -> int | None:
    """The page that a record, or a revisit's reference, names."""
    found = re.fullmatch(r"<urn:page:(-?\d+)(?::[\d.]+)?(?::\d+)?>", name or "")
    return int(found[1]) if found else None


_READ = "id long, origin string, type string, refers long, declared string, segment long, total long, payload_bytes long, digest string, block binary, problem string"


def _decoded(block: bytes) -> tuple[int | None, str | None, str | None]:
    """Length and SHA-256 of the payload, or what is wrong with it."""
    try:
        payload = payload_of(block)
    except ValueError as e:
        return None, None, str(e)
    return len(payload), hashlib.sha256(payload).hexdigest(), None


@operator
def read_archives(archives: DataFrame) -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to, problem) of each response and revisit in the files (path).

    Continuations are grouped by the name of their first record. A revisit has the payload of a
    response of the page that it refers to, of several that with its own digest. ``problem`` is null, or says what
    is wrong: a gap between segments, another length than declared, malformed framing, a digest
    that differs from the declared one, or a revisit without its response. A table without files
    gives an empty one.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                system, file = file_system(path)
                rows: list[tuple] = []
                with system.open_input_stream(file, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for fields, block in records(stream):
                        kind = fields.get("warc-type")
                        if kind not in ("response", "revisit", "continuation"):
                            continue
                        segment, total = fields.get("warc-segment-number"), fields.get("warc-segment-total-length")
                        origin = fields.get("warc-segment-origin-id") if kind == "continuation" else fields.get("warc-record-id")
                        n, digest, problem = _decoded(block) if kind == "response" and segment is None else (None, None, None)
                        declared = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
                        rows.append((_page(origin), origin, kind, _page(fields.get("warc-refers-to")), declared, segment and int(segment), total and int(total), n, digest, None if segment is None else block, problem))
                        if len(rows) >= 500:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]
        return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=[x.split()[0] for x in _READ.split(", ")])

    files = max(1, archives.count())
    seen = staged(by_batch(archives.select("path").repartition(files, "path"), read, _READ), "records")

    parts = F.array_sort(F.collect_list(F.struct("segment", "block")))
    whole = seen.where("segment is not null").groupBy("origin").agg(
        F.max("id").alias("id"), parts.alias("parts"), F.max("total").alias("total"), F.max("declared").alias("declared"), F.count_if(F.col("type") == "response").alias("heads")
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            out = []
            for page, segments, total, declared, heads in zip(*(c.to_pylist() for c in b.columns), strict=True):
                numbers = [s["segment"] for s in segments]
                block = b"".join(s["block"] for s in segments)
                if heads != 1 or numbers != list(range(1, len(numbers) + 1)):
                    out.append((page, declared, None, None, "a segment is missing or double"))
                elif total != len(block):
                    out.append((page, declared, None, None, "the segments' length isn't the declared one"))
                else:
                    out.append((page, declared, *_decoded(block)))
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
            if out:
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=["id", "declared", "payload_bytes", "digest", "problem"])

    joined = by_batch(whole.select("id", "parts", "total", "declared", "heads"), join, "id long, declared string, payload_bytes long, digest string, problem string")
    single = seen.where("segment is null and type = 'response'").select("id", "declared", "payload_bytes", "digest", "problem")
    responses = staged(single.unionByName(joined), "responses")
    wrong = F.when(F.col("problem").isNotNull(), F.col("problem")).when(F.col("digest") != F.col("declared"), F.lit("the digest isn't the declared one"))
    direct = responses.select("id", "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), wrong.alias("problem"))
    visits = seen.where("type = 'revisit'").select("id", "refers", "declared")
    # of a page with several responses (repeated rows), the one with the revisit's digest if there is, else the first by digest
    known = responses.groupBy(F.col("id").alias("refers"), "digest").agg(F.min(F.struct("payload_bytes", "problem")).alias("x"))
    fits = F.struct((F.col("digest") == F.col("declared")).alias("fits"), "digest", "x")
    visits = visits.withColumn("row", F.monotonically_increasing_id())
    found = visits.join(known, "refers", "left").groupBy("row", "id", "refers", "declared").agg(F.max(fits).alias("best"))
    found = found.select("id", "refers", "declared", F.col("best.digest").alias("digest"), F.col("best.x.payload_bytes").alias("payload_bytes"), F.col("best.x.problem").alias("problem"))
    lost = F.when(F.col("digest").isNull() & F.col("problem").isNull(), F.lit("its response is missing")).otherwise(wrong)
    again = found.select("id", "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), F.col("refers").alias("refers_to"), lost.alias("problem"))
    return direct.unionByName(again)
