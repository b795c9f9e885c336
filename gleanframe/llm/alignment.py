"""Links between the tokens of two vocabularies by a dictionary of groups.

Where tokens of both vocabularies end at the same byte, the text is cut; what lies between two cuts
is a group, and each of its tokens of one vocabulary is linked with each of the other. The
distinct groups of the corpus are interned by their ids in both vocabularies; links are expanded once
a distinct group, weighted by the documents that hold it, and what they give is joined back by group.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_batch, cached, operator, rows_of, staged, strings
from .tokens import BatchEncoder, byte_letters, gather, is_plain, json_encoder

SPACE = "▁"
#: Texts of about so many characters make a chunk: what a task says about a group it says once a chunk.
CHUNK = 4 << 20
#: Words whose groups a worker remembers, and groups that it has numbers for, at most.
MEMO = 250_000
WRONG = -1
_CHUNK = (
    "chunk long, ids array<long>, n_a array<int>, n_b array<int>, sizes array<int>, groups array<int>, links array<int>, shas array<string>, "
    "keys array<string>, docs array<int>, twice array<struct<a:int,b:int,n:int>>"
)


class Groups:
    """Numbers of the groups of texts; ``keys`` has each group as the text ``a1,a2|b1`` of its ids in order.

    A text that B's tokens don't spell has the one number WRONG.
    """

    def __init__(self, json_path: str, piece_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.left = json_encoder(json_path)
        bytes_of = set(byte_letters().values())
        vocabulary = Tokenizer.from_file(json_path).get_vocab(with_added_tokens=True)
        self.left_sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, k in vocabulary.items():
            self.left_sizes[k] = sum(1 if c in bytes_of else len(c.encode()) for c in token)
        self.right = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.right.id_to_piece(k) for k in range(self.right.get_piece_size())]
        self.spelled = [bytes([int(x[3:5], 16)]) if self.right.is_byte(k) else x.replace(SPACE, " ").encode() for k, x in enumerate(pieces)]
        self.right_sizes = np.array([len(x) for x in self.spelled])
        # no piece goes on behind a space that follows a letter: the words of a text can be encoded one by one
        self.by_word = not any(" " in x.decode("utf-8", "replace").lstrip(" ") for x in self.spelled)
        self.forget()

    def forget(self) -> None:
        """Number groups anew, so that what a worker remembers stays bounded. ``sides``: a group's tokens of A and of B, and its links."""
        self.keys: list[str] = []
        self.sides: list[tuple[int, int, np.ndarray]] = []
        self.number: dict[int | tuple, int] = {}
        self.words = BatchEncoder(self._words, "<i4", MEMO)

    def _number(self, code: int | tuple, a: list[int], b: list[int]) -> int:
        found = self.number.get(code)
        if found is None:
            found = self.number[code] = len(self.keys)
            self.keys.append(f"{','.join(map(str, a))}|{','.join(map(str, b))}")
            self.sides.append((len(a), len(b), np.array(sorted({x << 32 | y for x in a for y in b}), np.int64)))
        return found

    def _words(self, units: list[str]) -> list[bytes]:
        words = [x.removeprefix(" ") for x in units]
        packed = self.left.missing([" " + x for x in words]) if isinstance(self.left, BatchEncoder) else [x.tobytes() for x in self.left([" " + x for x in words])]
        return [x.tobytes() for x in self.numbered(words, [np.frombuffer(x, self.left.dtype if isinstance(self.left, BatchEncoder) else "<u4") for x in packed])]

    def numbered(self, texts: list[str], left: list[np.ndarray]) -> list[np.ndarray]:
        """The numbers of the groups of a space and each text, whose A ids are given."""
        right = self.right.encode(texts, num_threads=1) if texts else []
        sizes_a, sizes_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (left, right))
        a = np.concatenate([*left, np.empty(0, np.int64)]).astype(np.int64)
        b = np.fromiter(itertools.chain.from_iterable(right), np.int64, int(sizes_b.sum()))
        plain = [b" " + x.encode() for x in texts]
        if b"".join([self.spelled[y] for y in b.tolist()]) != b"".join(plain):
            good = [b"".join([self.spelled[y] for y in x]) == t for x, t in zip(right, plain, strict=True)]
            rest = iter(self.numbered([x for x, y in zip(texts, good, strict=True) if y], [x for x, y in zip(left, good, strict=True) if y]))
            return [next(rest) if y else np.array([WRONG], np.int32) for y in good]
        # all texts behind each other: where tokens of both end, texts end too
        end_a, end_b = np.cumsum(self.left_sizes[a]), np.cumsum(self.right_sizes[b])
        cut_a, cut_b = np.flatnonzero(np.isin(end_a, end_b)) + 1, np.flatnonzero(np.isin(end_b, end_a)) + 1
        from_a, from_b = (np.concatenate([[0], x[:-1]]) if len(x) else x for x in (cut_a, cut_b))
        n_a, n_b = cut_a - from_a, cut_b - from_b
        out = np.empty(len(cut_a), np.int32)
        single = (n_a == 1) & (n_b == 1)
        codes, index = np.unique(a[from_a[single]] << 32 | b[from_b[single]], return_inverse=True)
        out[single] = np.array([self._number(x, [x >> 32], [x & 0xFFFFFFFF]) for x in codes.tolist()], np.int32)[index] if len(codes) else 0
        flat_a, flat_b = a.tolist(), b.tolist()
        for k in np.flatnonzero(~single).tolist():
            x, y = flat_a[from_a[k] : cut_a[k]], flat_b[from_b[k] : cut_b[k]]
            out[k] = self._number((*x, -1, *y), x, y)
        ends = np.searchsorted(cut_a, np.cumsum(sizes_a), "right")
        return np.split(out, ends[:-1]) if texts else []

    def of_texts(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of the groups of a space and each text, encoded whole."""
        return self.numbered(texts, self.left([" " + x for x in texts])) if texts else []


@cached
def groups_of(json_path: str, piece_path: str) -> Groups:
    return Groups(json_path, piece_path)


class Chunk:
    """Documents of a task and the distinct groups in them."""

    def __init__(self, groups: Groups):
        if len(groups.keys) > MEMO:
            groups.forget()
        self.groups, self.size = groups, 0
        self.ids: list[int | None] = []
        self.found: list[np.ndarray] = []

    def add(self, ids: list[int | None], texts: list[str]) -> None:
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        usable = [k for k, x in enumerate(texts) if x and SPACE not in x]
        plain = [k for k in usable if self.groups.by_word and "  " not in f" {texts[k]} " and is_plain(" " + texts[k])]
        rest = sorted(set(usable) - set(plain))
        for some, made in ((plain, self.groups.words), (rest, self.groups.of_texts)):
            for k, x in zip(some, made([texts[k] for k in some]), strict=True):
                if x.min() != WRONG:
                    out[k] = x.copy()  # not a view that keeps the batch alive
        self.ids += ids
        self.found += out
        self.size += sum(map(len, texts))

    def row(self, chunk: int) -> pa.RecordBatch:
        """What the table of chunks holds; a document's links are pairs of tokens, ``docs`` counts documents by group."""
        sizes = np.fromiter(map(len, self.found), np.int64, len(self.found))
        used, flat = np.unique(np.concatenate([*self.found, np.empty(0, np.int32)]), return_inverse=True)
        keys = [self.groups.keys[k] for k in used.tolist()]
        sides = [self.groups.sides[k] for k in used.tolist()]
        n_a, n_b = (np.array([x[side] for x in sides], np.int64) for side in (0, 1))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[flat])])[ends])
        named = self.groups.keys
        shas = [hashlib.sha256(";".join([named[g] for g in x.tolist()]).encode()).hexdigest() if len(x) else "" for x in self.found]
        held = np.unique(np.repeat(np.arange(len(sizes)), sizes) * max(len(keys), 1) + flat)
        doc, group = held // max(len(keys), 1), held % max(len(keys), 1)
        # links that a document holds in several groups count once
        codes = [x[2] for x in sides]
        distinct, name = np.unique(np.concatenate([*codes, np.empty(0, np.int64)]), return_inverse=True)
        width = np.fromiter(map(len, codes), np.int64, len(codes))
        linked = gather(name, (np.cumsum(width) - width)[group], width[group])
        pairs = np.sort(np.repeat(doc, width[group]) * max(len(distinct), 1) + linked)
        again, times = np.unique(pairs[1:][pairs[1:] == pairs[:-1]] % max(len(distinct), 1), return_counts=True)
        twice = [{"a": int(x >> 32), "b": int(x & 0xFFFFFFFF), "n": int(n)} for x, n in zip(distinct[again], times, strict=True)]
        columns = {
            "chunk": chunk, "ids": self.ids, "n_a": sums(n_a), "n_b": sums(n_b), "sizes": sizes, "groups": flat, "links": sums(n_a * n_b), "shas": shas,
            "keys": keys, "docs": np.bincount(group, minlength=len(keys)), "twice": twice,
        }
        kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 5, *[pa.list_(pa.string())] * 2, pa.list_(pa.int32())]
        kinds.append(pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())])))
        return pa.record_batch([pa.array([x], k) for x, k in zip(columns.values(), kinds, strict=True)], names=list(columns))


def chunked(docs: DataFrame, id: str, text: str, json_path: str, piece_path: str) -> DataFrame:
    """A row for each chunk of documents, with its distinct groups and where they stand."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, first, made = groups_of(json_path, piece_path), TaskContext.get().partitionId() << 32, 0
        chunk = Chunk(groups)
        for b in rows_of(batches):
            chunk.add(b.column(0).to_pylist(), strings(b.column(1)))
            if chunk.size >= CHUNK:
                yield chunk.row(first + made)
                chunk, made = Chunk(groups), made + 1
        if chunk.ids:
            yield chunk.row(first + made)

    return by_batch(docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")), work, _CHUNK)


def _side(key: str, side: int) -> Column:
    return F.split(F.split(key, r"\|")[side], ",").cast("array<int>")


def _times(all_ids: str, one: str) -> Column:
    """How often an id stands in a group, most groups being of different ids."""
    return F.when(F.size(all_ids) == 1, 1).otherwise(F.size(F.filter(all_ids, lambda x: x == F.col(one)))).cast("long")


def expanded(dictionary: DataFrame) -> DataFrame:
    """(key, docs, a, b, times): the links of each distinct group (key, docs), each pair of ids once."""
    sides = dictionary.select("key", "docs", _side("key", 0).alias("all_a"), _side("key", 1).alias("all_b"))
    each = sides.select("*", F.explode(F.array_distinct("all_a")).alias("a")).select("*", F.explode(F.array_distinct("all_b")).alias("b"))
    return each.select("key", "docs", "a", "b", (_times("all_a", "a") * _times("all_b", "b")).alias("times"))


def pair_counts(links: DataFrame, chunks: DataFrame) -> DataFrame:
    """(a, b, count, best): the documents that hold each pair linked, and whether that is the most of its ``a``."""
    less = chunks.select(F.explode("twice").alias("x")).select("x.a", "x.b", (-F.col("x.n")).cast("long").alias("docs"))
    counts = links.select("a", "b", "docs").unionByName(less).groupBy("a", "b").agg(F.sum("docs").alias("count"))
    counts = staged(counts, "pairs")
    most = staged(counts.groupBy("a").agg(F.max("count").alias("most")), "most")
    return staged(counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best")), "counted")


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document of a chunk, with the sums over its groups."""
    groups_of.cache_clear()  # the encoders' work is done
    json_encoder.cache_clear()
    for b in batches:
        for row in range(b.num_rows):
            x = {name: b.column(k)[row].values for k, name in enumerate(b.schema.names) if name != "chunk"}
            sizes, groups = x["sizes"].to_numpy(), x["groups"].to_numpy()
            ends, out = np.concatenate([[0], np.cumsum(sizes)]), []
            scores = x["scores"] if x["scores"] is not None else pa.array([], pa.struct([("at", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64())]))
            at = scores.field("at").to_numpy()
            for name in ("n_best", "count_sum"):
                own = np.zeros(len(at), np.int64)
                own[at] = scores.field(name).to_numpy()
                out.append(pa.array(np.diff(np.concatenate([[0], np.cumsum(own[groups] if len(groups) else groups)])[ends]).astype(np.int64)))
            long = [x[name].cast(pa.int64()) for name in ("n_a", "n_b", "sizes", "links")]
            names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
            yield pa.record_batch([x["ids"], *long, *out, x["shas"]], names=names)


@operator
def linked_tokens(docs: DataFrame, json_path: str, piece_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row; ids are integers.

    A's tokens are those of a space and the text by a file of the tokenizers library, B's those of
    the text by a sentencepiece model, which adds the space itself; special tokens' strings are plain
    text. A text that is null or empty, or that B's tokens don't spell (it holds U+2581, or is
    normalised), has no tokens: zeros, and '' for the hash. The count of a pair of ids is the number
    of rows that hold it linked; ``n_best`` counts links whose pair has the highest count of its A
    id, ties included, ``count_sum`` sums the counts over the links. Rows that repeat count each;
    null ids stay null. Other columns are ignored, whatever their names. An empty table gives an
    empty one. Distinct groups and pairs are tables joined by key, never gathered.
    """
    chunks = staged(chunked(docs, id, text, json_path, piece_path), "chunks", large_rows=True)
    keys = chunks.select("chunk", F.posexplode(F.arrays_zip("keys", "docs")).alias("at", "x")).select("chunk", "at", F.col("x.keys").alias("key"), F.col("x.docs").alias("docs"))
    dictionary = staged(keys.groupBy("key").agg(F.sum("docs").alias("docs")), "dictionary")
    links = staged(expanded(dictionary), "links")
    counted = pair_counts(links, chunks)
    best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best")
    scores = links.join(counted, ["a", "b"]).groupBy("key").agg(best, F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    back = keys.join(staged(scores, "scores"), "key").groupBy("chunk").agg(F.collect_list(F.struct("at", "n_best", "count_sum")).alias("scores"))
    whole = chunks.select("chunk", "ids", "n_a", "n_b", "sizes", "groups", "links", "shas").join(staged(back, "back", large_rows=True), "chunk", "left")
    schema = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return by_batch(whole, _summed, schema).withColumnRenamed("id", id)
