"""Byte-level BPE by a segment tree over byte positions, encoding and decoding.

A pre-token's bytes are the leaves. A leaf holds the rank of the pair that starts there, and the
tree's root the leftmost of the least ranks. A merge changes three leaves - the merged one, its
live neighbour to the left, and the one taken in - and each change climbs the tree's height, or as
far as it changes a node. Many pre-tokens of like length are merged side by side in numpy; a few
long ones each by itself in a tree of plain lists.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batch, cached, operator, rows_of, strings
from .tokens import BatchEncoder, PieceEncoder, read_ranks

_NONE = np.int64(1) << np.int64(62)
#: Fewer pre-tokens than this side by side are merged one by one.
_FEW = 20


class PairRanks:
    """Ranks of byte strings, and of pairs of ids by the string that they make together."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, k in ranks.items():
            self.bytes[k] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, k in ranks.items():
            for at in range(1, len(token)):
                a, b = ranks.get(token[:at]), ranks.get(token[at:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = k
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, or a value above all ranks."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], _NONE)


def merged(pieces: list[bytes], table: PairRanks) -> list[np.ndarray]:
    """Ids of byte strings of up to the same power of two in length, by merges of the leftmost least pair rank."""
    count = len(pieces)
    sizes = np.array(list(map(len, pieces)), np.int64)
    width = 1 << max(int(sizes.max()) - 1, 1).bit_length()
    token = np.zeros((count, width), np.int64)
    for k, x in enumerate(pieces):
        token[k, : len(x)] = table.single[np.frombuffer(x, np.uint8)]
    position = np.arange(width)
    after = np.broadcast_to(position + 1, (count, width)).copy()  # next live position; ``sizes`` and above: none
    before = np.broadcast_to(position - 1, (count, width)).copy()
    tree = np.full((count, 2 * width), _NONE)
    inside = position[:-1] + 1 < sizes[:, None]
    ranks = table.of(token[:, :-1], token[:, 1:])
    tree[:, width : 2 * width - 1] = np.where(inside & (ranks < _NONE), ranks * width + position[:-1], _NONE)
    level = width
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2

    def put(rows: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
        node = at + width
        tree[rows, node] = values
        while width > 1 and node[0] > 1:  # all leaves have the same depth
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def pair(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        nxt = after[rows, at]
        live = nxt < sizes[rows]
        ranks = table.of(token[rows, at], token[rows, np.where(live, nxt, at)])
        return np.where(live & (ranks < _NONE), ranks * width + at, _NONE)

    dead = np.zeros((count, width), bool)
    rows = np.flatnonzero(tree[:, 1] < _NONE)
    while len(rows):
        least = tree[rows, 1]
        at, rank = least % width, least // width
        taken = after[rows, at]
        follow = after[rows, taken]
        token[rows, at], after[rows, at], dead[rows, taken] = rank, follow, True
        some = follow < sizes[rows]
        before[rows[some], follow[some]] = at[some]
        put(rows, taken, np.full(len(rows), _NONE))
        put(rows, at, pair(rows, at))
        left = before[rows, at]
        some = left >= 0
        if some.any():
            put(rows[some], left[some], pair(rows[some], left[some]))
        rows = rows[tree[rows, 1] < _NONE]
    live = ~dead & (position < sizes[:, None])
    flat, cuts = token[live], np.cumsum(live.sum(axis=1))[:-1]
    return np.split(flat, cuts)


def merged_alone(piece: bytes, table: PairRanks) -> np.ndarray:
    """Ids of one byte string, by the same merges in a tree of plain lists."""
    n, ranks, none = len(piece), table.pairs, int(_NONE)
    width = 1 << max(n - 1, 1).bit_length()
    token = table.single[np.frombuffer(piece, np.uint8)]
    leaves = np.full(width, _NONE)
    found = table.of(token[:-1], token[1:])
    leaves[: n - 1] = np.where(found < _NONE, found * width + np.arange(n - 1), _NONE)
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(np.minimum(levels[-1][0::2], levels[-1][1::2]))
    tree = np.concatenate([[_NONE], *reversed(levels)]).tolist()
    ids, after, before = token.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))

    def put(at: int, value: int) -> None:
        node = at + width
        tree[node] = value
        node >>= 1
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            least = a if a < b else b
            if tree[node] == least:
                return
            tree[node] = least
            node >>= 1

    while tree[1] < none:
        rank, at = divmod(tree[1], width)
        taken = after[at]
        follow = after[taken]
        ids[at], after[at], ids[taken] = rank, follow, -1
        put(taken, none)
        if follow < n:
            before[follow] = at
            new = ranks.get(rank << 32 | ids[follow])
            put(at, none if new is None else new * width + at)
        else:
            put(at, none)
        left = before[at]
        if left >= 0:
            new = ranks.get(ids[left] << 32 | rank)
            put(left, none if new is None else new * width + left)
    return np.array([x for x in ids if x >= 0], np.int64)


def encode_pieces(pieces: list[bytes], table: PairRanks, most: int = 1 << 18) -> list[np.ndarray]:
    """Ids of each byte string; one that is a token as a whole is that token. Strings are merged in lots of like length."""
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(pieces)
    lots: dict[int, list[int]] = {}
    for k, x in enumerate(pieces):
        if (whole := table.ranks.get(x)) is not None:
            out[k] = np.array([whole])
        elif x:
            lots.setdefault((len(x) - 1).bit_length(), []).append(k)
    for bits, members in lots.items():
        step = max(1, most >> bits)
        for a in range(0, len(members), step):
            part = members[a : a + step]
            texts = [pieces[k] for k in part]
            done = [merged_alone(x, table) for x in texts] if len(part) < _FEW else merged(texts, table)
            for k, ids in zip(part, done, strict=True):
                out[k] = ids
    return out


@cached
def rank_table(path: str) -> PairRanks:
    return PairRanks(read_ranks(path))


@cached
def tree_encoder(path: str, pattern: str) -> BatchEncoder:
    """Encoder of whole texts by a rank file; each match of the pattern is encoded by itself."""
    table = rank_table(path)
    dtype = "<u2" if len(table.bytes) <= 1 << 16 else "<u4"
    encode = lambda pieces: [x.astype(dtype).tobytes() for x in encode_pieces([p.encode() for p in pieces], table)]
    return BatchEncoder(PieceEncoder(pattern, encode), dtype)


def decode(ids: np.ndarray, table: PairRanks) -> bytes:
    """The bytes of the ids."""
    return b"".join(map(table.bytes.__getitem__, ids.tolist()))


@operator
def round_trip(docs: DataFrame, ranks: str, pattern: str = public_tokenizers.PATTERN, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row's text, encoded and decoded again.

    ``ranks``: path of a rank file. Null text is empty: no ids. A repeated row is encoded again.
    Other columns are ignored, whatever their names. An empty table gives an empty one.
    """
    kind = docs.schema[id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = tree_encoder(ranks, pattern), rank_table(ranks)
        for b in rows_of(batches):
            n, coded, decoded = [], [], []
            for ids in encoder(strings(b.column(1))):
                n.append(len(ids))
                coded.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(decode(ids, table)).hexdigest())
            arrays = [b.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
            yield pa.record_batch(arrays, names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return by_batch(docs.select(F.col(id).alias("id"), F.col(text)), work, schema).withColumnRenamed("id", id)
