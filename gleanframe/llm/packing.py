"""Packing of token sequences by non-negative least squares.

Whole windows are cut off long documents first. What remains of each is shorter than a window;
length combinations of two or three that fill a window exactly are the columns of a least-squares
problem, whose non-negative solution against the histogram of lengths says how often to use each.
Rounded down, it places most remainders uncut. The others are packed greedily, longest first: each
sequence is filled to the brim and the piece that doesn't fit is cut. The last, partly filled
sequence is split into sequences whose lengths are powers of two, which need no padding.

The histogram alone goes to the driver. A remainder's rank among those of its length says where it
goes: closed formulas give its sequence and offset, in any number of tasks.
"""

from __future__ import annotations

import warnings
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_batch, operator, rows_of, staged, strings
from .tokens import json_encoder

#: The most frequent lengths, of which combinations of three are formed.
TRIPLE_LENGTHS = 96
#: The solver stops when no gradient breaks the optimality conditions by more than this share of the greatest count.
TOLERANCE, STEPS = 1e-4, 200_000


def combinations(counts: dict[int, int], window: int, frequent: int = TRIPLE_LENGTHS) -> list[tuple[int, ...]]:
    """Multisets of two or three occurring lengths that fill the window."""
    out = {(window - a, a) for a in counts if 2 * a <= window and window - a in counts}
    top = sorted(counts, key=lambda x: (-counts[x], x))[:frequent]
    for i, a in enumerate(top):
        for b in top[i:]:
            if window - a - b in counts:
                out.add(tuple(sorted((a, b, window - a - b), reverse=True)))
    return sorted(out)


def least_squares(columns: list[tuple[int, ...]], counts: dict[int, int], tolerance: float = TOLERANCE, steps: int = STEPS) -> np.ndarray:
    """x >= 0 that minimises the squared differences of the lengths used from ``counts``.

    Accelerated projected gradients, started anew when they turn. Counts are taken as shares of
    the greatest one, so the result scales with them. It stops when the gradient is within
    ``tolerance`` of the optimality conditions, and warns if ``steps`` don't suffice.
    """
    if not columns:
        return np.zeros(0)
    lengths = sorted(counts)
    row = {v: k for k, v in enumerate(lengths)}
    top = float(max(counts.values()))
    wanted = np.array([counts[v] for v in lengths]) / top
    entries = [(row[v], j, m) for j, c in enumerate(columns) for v, m in Counter(c).items()]
    at, col, times = (np.array(x) for x in zip(*entries, strict=True))
    used = lambda x: np.bincount(at, times * x[col], minlength=len(lengths))
    back = lambda r: np.bincount(col, times * r[at], minlength=len(columns))
    # the greatest eigenvalue of A'A is at most the greatest row sum of its absolute values
    bound = float(back(used(np.ones(len(columns)))).max())
    x = y = np.zeros(len(columns))
    momentum = 1.0
    for n in range(steps):
        gradient = back(used(y) - wanted)
        new = np.maximum(y - gradient / bound, 0)
        if (y - new) @ (new - x) > 0:  # it turned
            momentum = 1.0
        ahead = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        y = new + (momentum - 1) / ahead * (new - x)
        x, momentum = new, ahead
        if n % 50 == 49:
            slope = back(used(x) - wanted)
            if np.maximum(np.where(x > 0, np.abs(slope), -slope), 0).max() <= tolerance:
                break
    else:
        warnings.warn("least squares stopped before the tolerance was reached; more lengths are packed greedily", stacklevel=2)
    return x * top


def plan(counts: dict[int, int], window: int, frequent: int = TRIPLE_LENGTHS) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """How often to use each combination, and what of each length is left."""
    columns = combinations(counts, window, frequent)
    x = least_squares(columns, counts)
    left, used = dict(counts), []
    for j in sorted(range(len(columns)), key=lambda j: (-x[j], columns[j])):
        need = Counter(columns[j])
        n = min(int(x[j] + 1e-9), *(left[k] // m for k, m in need.items()))
        if n > 0:
            used.append((columns[j], n))
            for k, m in need.items():
                left[k] -= n * m
    return used, left


@operator
def packed(docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", *, end: int = 1, window: int = 2048, triple_lengths: int = TRIPLE_LENGTHS) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece of every row's text.

    ``vocabulary``: a file of the tokenizers library; each document's ids are followed by ``end``;
    null text is empty. ``window`` is a power of two. Sequences have ``window`` ids, but for at most
    log2(window) that have a smaller power of two. Combinations of two lengths are formed of all,
    those of three with two of the ``triple_lengths`` most frequent; what no combination takes is
    packed greedily. A repeated row is packed again. Other columns are ignored, whatever their
    names. An empty table gives an empty one.
    """
    if window & (window - 1):
        raise ValueError("the window is a power of two")
    kind = docs.schema[id].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = json_encoder(vocabulary), TaskContext.get().partitionId()
        ranks: Counter[int] = Counter()
        whole = 0
        for b in rows_of(batches, 2 << 20):
            ids = encoder(strings(b.column(1)))
            n = [len(x) + 1 for x in ids]
            rank, first = [], []
            for m in n:
                rank.append(ranks[m % window])
                first.append(whole)
                ranks[m % window] += 1
                whole += m // window
            wide = "<u2" if all(x.dtype.itemsize == 2 for x in ids) and end < 1 << 16 else "<u4"
            data = [np.append(x, end).astype(wide).tobytes() for x in ids]
            same = [task] * len(n)
            arrays = [b.column(0), pa.array(n, pa.int64()), pa.array([m % window for m in n], pa.int64()), pa.array(same, pa.int64()), pa.array(rank, pa.int64()), pa.array(first, pa.int64()), pa.array(data, pa.binary())]
            yield pa.record_batch(arrays, names=["id", "n", "rest", "task", "rank", "first", "ids"])

    rows = staged(by_batch(docs.select(F.col(id).alias("id"), F.col(text)), encode, f"id {kind}, n long, rest long, task long, rank long, first long, ids binary"), "token-ids")

    # ranks of each length over all tasks, and whole windows of all tasks before
    sizes = staged(rows.groupBy("task", "rest").agg(F.count("*").alias("k"), F.sum(F.floor(F.col("n") / window)).alias("whole")), "lengths")
    earlier = lambda c, *by: F.coalesce(F.sum(c).over((Window.partitionBy(*by) if by else Window).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = sizes.groupBy("task").agg(F.sum("whole").alias("whole")).select("task", earlier("whole").alias("whole_before"))
    offsets = staged(sizes.select("task", "rest", earlier("k", "rest").alias("rank_before")).join(tasks, "task"), "rank-offsets")

    counts = {r[0]: r[1] for r in sizes.where("rest > 0").groupBy("rest").agg(F.sum("k")).collect()}  # window - 1 lengths at most
    used, left = plan(counts, window, triple_lengths)
    slots, taken, sequences = [], Counter(), 0
    for lengths, n in used:
        at = 0
        for x in lengths:
            slots.append((x, taken[x], taken[x] + n, sequences, at))
            taken[x] += n
            at += x
        sequences += n
    stream, at = [], 0
    for x in sorted(left, reverse=True):
        if left[x]:
            stream.append((x, taken[x], taken[x] + left[x], -1, at))
            at += x * left[x]
    brim = at - at % window
    tail, edges = at - brim, [brim]
    for bit in reversed(range(window.bit_length() - 1)):
        if tail >> bit & 1:
            edges.append(edges[-1] + (1 << bit))
    spark = docs.sparkSession
    places = spark.createDataFrame([*slots, *stream], "rest long, from_rank long, to_rank long, sequence long, at long")

    # the edges of sequences inside a piece of the stream: one multiple of the window at most, and those of the tail
    total = sequences + brim // window + len(edges) - 1
    known = rows.join(offsets, ["task", "rest"]).withColumn("rank", F.col("rank") + F.col("rank_before"))
    place = (F.col("p.rest") == F.col("k.rest")) & (F.col("k.rank") >= F.col("p.from_rank")) & (F.col("k.rank") < F.col("p.to_rank"))
    known = known.alias("k").join(F.broadcast(places).alias("p"), place, "left").select("k.*", "from_rank", "sequence", "at")  # three rows a combination at most
    begin = F.col("at") + (F.col("rank") - F.col("from_rank")) * F.col("rest")
    rim = (F.floor(begin / window) + 1) * window
    bounds = F.array(*[F.lit(x).cast("long") for x in edges])
    inner = F.filter(F.array_union(F.array(F.when(rim < brim, rim)), bounds), lambda b: b.isNotNull() & (b > begin) & (b < begin + F.col("rest")))
    inner = F.array_sort(inner)
    starts = F.concat(F.array(begin), inner)
    ends = F.concat(inner, F.array(begin + F.col("rest")))
    home = lambda b: F.when(b < brim, F.floor(b / window)).otherwise(brim // window + F.size(F.filter(bounds, lambda e: e <= b)) - 1)
    base = lambda b: F.when(b < brim, F.floor(b / window) * window).otherwise(F.array_max(F.filter(bounds, lambda e: e <= b)))
    cut = (F.col("n") - F.col("rest")).cast("long")
    piece = lambda start, length, sequence, offset: F.struct(start.cast("long").alias("start"), length.cast("long").alias("length"), sequence.cast("long").alias("sequence"), offset.cast("long").alias("offset"))
    streamed = F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda z: piece(cut + z["s"] - begin, z["e"] - z["s"], home(z["s"]) + sequences, z["s"] - base(z["s"])))
    fixed = F.array(piece(cut, F.col("rest"), F.col("sequence") + F.col("rank") - F.col("from_rank"), F.col("at")))
    windows = F.floor(F.col("n") / window)
    whole = F.transform(F.when(windows > 0, F.sequence(F.lit(0).cast("long"), windows - 1)).otherwise(F.array().cast("array<bigint>")), lambda k: piece(k * window, F.lit(window), F.col("whole_before") + F.col("first") + k + total, F.lit(0)))
    last = F.when(F.col("rest") == 0, F.array().cast("array<struct<start:bigint,length:bigint,sequence:bigint,offset:bigint>>")).when(F.col("sequence") < 0, streamed).otherwise(fixed)
    laid = known.select("id", "n", "ids", F.concat(whole, last).alias("pieces"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            out: list[list] = [[] for _ in range(7)]
            for key, n, data, pieces in zip(*(c.to_pylist() for c in b.columns), strict=True):
                width = len(data) // n
                ids = memoryview(np.frombuffer(data, f"<u{width}").astype("<u4").tobytes())
                for p in pieces:
                    row = (key, p["start"], p["length"], zlib.crc32(ids[4 * p["start"] : 4 * (p["start"] + p["length"])]), n, p["sequence"], p["offset"])
                    for x, y in zip(out, row, strict=True):
                        x.append(y)
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.record_batch([pa.array(out[0], b.column(0).type), *(pa.array(x, pa.int64()) for x in out[1:])], names=names)

    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return by_batch(laid, work, schema).withColumnRenamed("id", id)
