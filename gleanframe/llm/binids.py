"""Token-id files: frequency-ranked ids in byte-aligned variable-length code with separate control bytes.

Ids are replaced by their rank of frequency, so that frequent ones take one byte. Four 2-bit
lengths share a control byte; all control bytes of a block come before its data bytes. Decoding
looks up the lengths of each control byte in a table and gathers the data by numpy.

A file holds the documents of a range of document ids, in ascending order, as blocks:
``n_docs n_ids n_data`` (three 64-bit numbers), document ids, ids per document (64-bit each),
control bytes, data bytes, crc32 of all that (32 bits). ``ranking`` beside them lists the ids by rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_batch, callers_path, file_system, operator, qualified, rows_of, staged, strings, write_whole
from .tokens import json_encoder, vocabulary_size

SHARD_BYTES = 16 << 20
#: Lengths of the four values of each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + np.uint8(1)
_TOTALS = LENGTHS.sum(axis=1, dtype=np.int64)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values. The last control byte is filled up with zeros."""
    v = np.ascontiguousarray(values, "<u4")
    extra = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    codes = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    codes[: len(v)] = extra
    quads = codes.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of control and data bytes."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    if n and ends[-1] != len(data) or len(control) != -(-n // 4):
        raise ValueError("control and data bytes don't fit")
    source = np.frombuffer(data + b"\0\0\0", np.uint8)
    at, out = ends - lengths, np.zeros(n, np.uint32)
    for k in range(4):
        more = lengths > k if k else slice(None)
        out[more] |= source[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def block(doc_ids: np.ndarray, lengths: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    head = np.array([len(doc_ids), len(ranks), len(data)], "<i8").tobytes()
    body = head + doc_ids.astype("<i8").tobytes() + lengths.astype("<i8").tobytes() + control + data
    return body + np.uint32(zlib.crc32(body)).tobytes()


def blocks(read: Callable[[int], bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Document ids, ids per document and ranks of each block of a file."""
    while head := read(24):
        docs, ids, size = np.frombuffer(head, "<i8").tolist()
        body = read(16 * docs + -(-ids // 4) + size)
        if zlib.crc32(body, zlib.crc32(head)) != int.from_bytes(read(4), "little"):
            raise ValueError("a block is damaged")
        at = 16 * docs + -(-ids // 4)
        yield np.frombuffer(body[: 8 * docs], "<i8"), np.frombuffer(body[8 * docs : 16 * docs], "<i8"), unpack(body[16 * docs : at], body[at:], ids)


def _raw_blocks(read: Callable[[int], bytes], dtype: np.dtype) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    while head := read(16):
        docs, ids = np.frombuffer(head, "<i8").tolist()
        yield np.frombuffer(read(8 * docs), "<i8"), np.frombuffer(read(8 * docs), "<i8"), np.frombuffer(read(dtype.itemsize * ids), dtype)


@operator
def write_ids(docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", *, end: int = 0, folder: str | None = None) -> DataFrame:
    """Write all documents' ids, each document followed by ``end``; returns (shard, path, docs, ids, before).

    ``vocabulary``: a file of the tokenizers library. Null text is empty. ``before`` counts the ids
    of all earlier shards. Texts are dealt over shards by ranges of their id and encoded once;
    shards first hold plain ids, and are coded anew when the frequencies of all are known. Files
    are written under another name and moved into place, so a lost executor's task can run again.
    Ids are taken as 64-bit integers and are not null; a repeated row is written again, next to the
    other. Other columns are ignored, whatever their names. An empty table gives a shard without documents.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder or callers_path(spark, "ids"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_BYTES))
    system, base = file_system(folder)
    system.create_dir(base, recursive=True)
    size = vocabulary_size(vocabulary)
    width = np.dtype("<u2" if max(size, end + 1) <= 1 << 16 else "<u4")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, (system, base), shard = json_encoder(vocabulary), file_system(folder), TaskContext.get().partitionId()
        counts, total, rows, last = np.zeros(1, np.int64), 0, 0, np.array([end], width)

        def write(f) -> None:
            nonlocal counts, total, rows
            with pa.CompressedOutputStream(f, "zstd") as z:
                for b in rows_of(batches, 2 << 20):
                    ids = encoder(strings(b.column(1)))
                    flat = np.concatenate([x for d in ids for x in (d, last)]).astype(width, copy=False) if ids else np.empty(0, width)
                    z.write(np.array([len(ids), len(flat)], "<i8").tobytes())
                    z.write(b.column(0).to_numpy().astype("<i8").tobytes())
                    z.write(np.array([len(d) + 1 for d in ids], "<i8").tobytes())
                    z.write(flat.tobytes())
                    got = np.bincount(flat, minlength=len(counts))
                    got[: len(counts)] += counts
                    counts, total, rows = got, total + len(flat), rows + len(ids)

        write_whole(system, f"{base}/{shard:08d}.raw", write)
        used = np.flatnonzero(counts)
        columns = [np.full(len(used) + 1, shard), np.append(-1, used), np.append(total, counts[used]), np.append(rows, np.zeros(len(used), int))]
        yield pa.record_batch(list(map(pa.array, columns)), names=["shard", "token", "n", "docs"])

    ordered = docs.select(F.col(id).cast("long"), F.col(text)).repartitionByRange(shards, id).sortWithinPartitions(id)
    counted = staged(by_batch(ordered, encode, "shard long, token long, n long, docs long"), "id-counts")

    frequency = counted.where("token >= 0").groupBy("token").agg(F.sum("n").alias("n")).toPandas()  # a row an id of the vocabulary
    seen = frequency.sort_values(["n", "token"], ascending=[False, True])["token"].to_numpy(np.int64)
    ranking = np.concatenate([seen, np.setdiff1d(np.arange(max(size, end + 1)), seen)]).astype("<u4")
    write_whole(system, f"{base}/ranking", lambda f: f.write(ranking.tobytes()))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        order = np.frombuffer(system.open_input_stream(f"{base}/ranking").read(), "<u4")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        for b in batches:
            for shard in b.column(0).to_pylist():
                done, raw = f"{base}/{shard:08d}.ids", f"{base}/{shard:08d}.raw"

                def write(f, raw=raw) -> None:
                    with system.open_input_stream(raw, compression=None) as g, pa.CompressedInputStream(g, "zstd") as z:
                        for docs_, lengths, ids in _raw_blocks(z.read, width):
                            f.write(block(docs_, lengths, rank[ids]))

                if system.get_file_info(done).is_file:
                    continue  # an earlier attempt came so far
                write_whole(system, done, write)
                system.delete_file(raw)
            yield b

    listed = counted.where("token = -1").select("shard", "docs", F.col("n").alias("ids"))
    coded = staged(by_batch(listed.repartition(shards, "shard"), code, "shard long, docs long, ids long"), "id-shards")
    before = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return coded.select("shard", F.format_string(f"{folder}/%08d.ids", "shard").alias("path"), "docs", "ids", before.alias("before"))


@operator
def read_ids(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files of ``shards`` (path, before), decoded whole.

    ``start`` counts the ids of all documents before it. Other columns are ignored. A table without
    files, or files without documents, give an empty one.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                system, file = file_system(path)
                order = np.frombuffer(system.open_input_stream(file.rpartition("/")[0] + "/ranking").read(), "<u4")
                with system.open_input_stream(file) as f:
                    for docs, lengths, ranks in blocks(f.read):
                        ids = order[ranks]
                        ends = np.cumsum(lengths)
                        buffer = memoryview(ids.astype("<u4").tobytes())
                        crc = [zlib.crc32(buffer[4 * a : 4 * z]) for a, z in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
                        yield pa.record_batch([pa.array(docs), pa.array(start + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += int(lengths.sum())

    n = max(1, shards.count())
    return by_batch(shards.select("path", "before").repartition(n, "path"), work, "doc_id long, start long, n_tokens long, ids_crc32 long")
