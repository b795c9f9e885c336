"""Periodic runs of words by the tandem-repeat method of Gusfield and Stoye, for many texts at once.

The words of a batch of texts are one sequence, each text with words of its own and an end of its
own. Lempel-Ziv blocks give squares that cover the leftmost occurrence of every square; walks along
the suffix links of the suffix tree complete the vocabulary of squares; all places of each, read off
its node, merge into runs. Every step is numpy over whole arrays.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batch, rows_of, strings
from .shingles import word_ids
from .tokens import gather

_SCHEMA = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_words long, n_dropped long"
)


def _count_up(lengths: np.ndarray) -> np.ndarray:
    """0 .. n - 1 for each n, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def _levels(values: np.ndarray, combine: Callable, most: int) -> list[np.ndarray]:
    """At level j, ``combine`` of the 2**j values from each place on (of fewer at the end), as far as ``most`` values."""
    out = [values]
    while 1 << len(out) <= most:
        last, h = out[-1], 1 << len(out) - 1
        out.append(np.concatenate([combine(last[:-h], last[h:]), last[len(last) - h :]]) if h < len(last) else last)
    return out


class SuffixTree:
    """The suffix tree of a sequence in which every text ends with a symbol found nowhere else.

    ``names[j]`` names the 2**j symbols from each place on, so that two common prefixes or suffixes
    are measured by one descent. Nodes are intervals of ``order``, the places sorted by their suffix,
    of those only whose first two symbols occur again: all others are leaves without company.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        head = np.ones(n, bool)
        head[1:] = symbols[order[1:]] != symbols[order[:-1]]
        name = np.empty(n, np.int32)
        name[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        self.symbols, self.names, self.order = name, [name], order[:0]
        slots = np.flatnonzero(~(head & np.append(head[1:], True)))
        while len(slots):
            own, step = order[slots], 1 << len(self.names) - 1
            key = name[own].astype(np.int64) * n + name[own + step]
            sort = np.argsort(key, kind="stable")
            own, key = own[sort], key[sort]
            order[slots] = own
            head = np.ones(len(own), bool)
            head[1:] = key[1:] != key[:-1]
            name = name.copy()
            name[own] = slots[np.maximum.accumulate(np.where(head, np.arange(len(own)), 0))]
            self.names.append(name)
            company = ~(head & np.append(head[1:], True))
            slots = slots[company]
            if len(self.names) == 2:
                inner = slots
        if len(self.names) > 1:
            self.order = order[inner]
        self.at = np.full(n, -1, np.int64)
        self.at[self.order] = np.arange(len(self.order))
        depth = np.zeros(len(self.order) + 1, np.int32)  # common prefix of each suffix and the one before it
        if len(self.order) > 1:
            depth[1:-1] = self.ahead(self.order[:-1], self.order[1:])
        self.depths = _levels(depth, np.minimum, len(depth))

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` and from ``b`` on are the same."""
        n = np.zeros(len(a), np.int64)
        for j in range(len(self.names) - 1, -1, -1):
            name = self.names[j]
            n += (name[a + n] == name[b + n]).astype(np.int64) << j
        return n

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before ``a`` and before ``b`` are the same."""
        n = np.zeros(len(a), np.int64)
        for j in range(len(self.names) - 1, -1, -1):
            name, x, y = self.names[j], a - n - (1 << j), b - n - (1 << j)
            n += ((np.minimum(x, y) >= 0) & (name[np.maximum(x, 0)] == name[np.maximum(y, 0)])).astype(np.int64) << j
        return n

    def node(self, places: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of ``order`` of the suffixes that begin with the ``depth`` symbols (two or more) at each place; (-1, 0) for one without company."""
        low = self.at[places]
        alone = low < 0
        low = np.where(alone, 0, low)
        high = low + 1
        for j in range(len(self.depths) - 1, -1, -1):
            least, step = self.depths[j], 1 << j
            start = low - step + 1
            low = low - step * ((start > 0) & (least[np.maximum(start, 0)] >= depth))
            end = high + step <= len(self.order)
            high = high + step * (end & (least[np.minimum(high, len(least) - 1)] >= depth))
        return np.where(alone, -1, low), np.where(alone, 0, high)

    def child(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """A place in each interval where ``symbol`` follows the ``depth`` symbols, -1 where there is none."""
        left, right = low.copy(), high.copy()
        follows = lambda slot: self.symbols[np.minimum(self.order[np.minimum(slot, len(self.order) - 1)] + depth, len(self.symbols) - 1)]
        while (apart := left < right).any():
            middle = (left + right) // 2
            less = follows(middle) < symbol
            left, right = np.where(apart & less, middle + 1, left), np.where(apart & ~less, middle, right)
        found = (left < high) & (follows(left) == symbol)
        return np.where(found, self.order[np.minimum(left, len(self.order) - 1)], -1)

    def earlier(self) -> np.ndarray:
        """For each place, the most symbols from it on that also stand somewhere before it."""
        first = np.full(len(self.symbols), len(self.symbols), np.int64)
        np.minimum.at(first, self.symbols, np.arange(len(self.symbols)))
        out = (first[self.symbols] < np.arange(len(self.symbols))).astype(np.int64)
        own = self.order
        if not len(own):
            return out
        # next to a suffix, on either side, the nearest that begins before it shares the most with it
        for way in (1, -1):
            x = own[::way]
            at, heads = np.arange(len(x)), np.flatnonzero(self.depths[0][:-1] < 2)
            longest = int(np.diff(np.append(heads, len(x))).max())
            least = _levels(x, np.minimum, longest)  # least[j][k]: of x[k : k + 2**j]
            for j in range(len(least) - 1, -1, -1):
                start = at - (1 << j)
                at = at - ((start >= 0) & (least[j][np.maximum(start, 0)] > x[np.arange(len(x))])).astype(np.int64) * (1 << j)
            some = np.flatnonzero(at > 0)
            np.maximum.at(out, x[some], self.ahead(x[some], x[at[some] - 1]))
        return out


def blocks(tree: SuffixTree) -> np.ndarray:
    """Where the Lempel-Ziv blocks begin, and the end: each is the longest that stands earlier too, or one new symbol."""
    after = (np.arange(len(tree.symbols)) + np.maximum(tree.earlier(), 1)).tolist()
    out, at = [], 0
    while at < len(after):
        out.append(at)
        at = after[at]
    return np.array([*out, at])


def leftmost_squares(tree: SuffixTree, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, half) of squares from which all leftmost occurrences of squares are reached to the right.

    The right half of a square touches two blocks at most, and a leftmost one lies in no single
    block: so it has the edge of a block in its right half, or in its left half.
    """
    h, size = edges[1:-1], np.diff(edges)
    places, halves = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if len(h):
        after = np.append(size[2:], 0)
        for right, most in ((True, np.minimum(size[:-1] + size[1:], h)), (False, np.minimum(size[1:] + after, len(tree.symbols) - 1 - h))):
            k, b = _count_up(most) + 1, np.repeat(h, most)
            a, z = (b - k, b) if right else (b, b + k)
            same = tree.symbols[a] == tree.symbols[z]
            a, z, k = a[same], z[same], k[same]
            back = tree.behind(a, z)
            found = tree.ahead(a, z) + back >= k
            places.append(np.maximum(a - back, a - k + 1)[found])
            halves.append(k[found])
    place, half = np.concatenate(places), np.concatenate(halves)
    rest = half.copy()
    whole = np.ones(len(half), bool)
    for p in _primes(int(half.max(initial=1))):  # a half that is itself a power makes no run of its own
        some = np.flatnonzero(whole & (rest % p == 0)) if p * p <= rest.max(initial=1) else np.empty(0, np.int64)
        if len(some):
            part = half[some] // p
            whole[some] &= tree.ahead(place[some], place[some] + part) < half[some] - part
            while (again := some[rest[some] % p == 0]).size:
                rest[again] //= p
    some = np.flatnonzero(whole & (rest > 1))  # the last prime
    part = half[some] // rest[some]
    whole[some] &= tree.ahead(place[some], place[some] + part) < half[some] - part
    return place[whole], half[whole]


def _primes(most: int) -> list[int]:
    """Primes up to the root of ``most``."""
    root = int(most**0.5) + 1
    sieve = np.ones(root + 1, bool)
    sieve[:2] = False
    for p in range(2, int(root**0.5) + 1):
        if sieve[p]:
            sieve[p * p :: p] = False
    return np.flatnonzero(sieve).tolist()


def square_places(tree: SuffixTree, place: np.ndarray, half: np.ndarray) -> np.ndarray:
    """Sorted half * n + place of all occurrences of all squares whose half is no power.

    From each square a walk follows the suffix links: the square one symbol further is there if
    the symbol that left comes next. Along its own run it is, so a walk leaps to the end of the run
    and asks the tree there. It ends at a node that another walk has been to.
    """
    n = len(tree.symbols)
    marked, found = np.empty(0, np.int64), [np.empty(0, np.int64)]
    while len(place):
        leap = np.minimum(tree.ahead(place, place + half) - half, half - 1)
        x, k = np.repeat(place, leap + 1) + _count_up(leap + 1), np.repeat(half, leap + 1)
        low, high = tree.node(x, 2 * k)
        key = k * n + np.where(low < 0, x, tree.order[np.maximum(low, 0)] if len(tree.order) else x)
        _, fresh = np.unique(key, return_index=True)
        fresh = fresh[~np.isin(key[fresh], marked)]
        marked = np.concatenate([marked, key[fresh]])
        many = fresh[low[fresh] >= 0]
        counts = high[many] - low[many]
        alone = fresh[low[fresh] < 0]
        found += [k[alone] * n + x[alone], np.repeat(k[many], counts) * n + gather(tree.order, low[many], counts)]
        # ends of the walks: by the suffix link, then by the symbol that left
        last = np.zeros(len(x), bool)
        last[np.cumsum(leap + 1) - 1] = True
        on = np.zeros(len(x), bool)
        on[fresh] = True
        e = np.flatnonzero(last & on & (k > 1))
        e = e[tree.at[x[e] + 1] >= 0]
        if not len(e):
            break
        low, high = tree.node(x[e] + 1, 2 * k[e] - 1)
        to = tree.child(low, high, 2 * k[e] - 1, tree.symbols[x[e]])
        place, half = to[to >= 0], k[e][to >= 0]
    return np.unique(np.concatenate(found))


def runs(symbols: np.ndarray, least: int = 2, exponent: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of ``least`` symbols and ``exponent`` periods or more, by start, then period."""
    tree, n = SuffixTree(symbols), max(len(symbols), 1)
    at = square_places(tree, *leftmost_squares(tree, blocks(tree)))
    head = np.ones(len(at), bool)
    head[1:] = at[1:] != at[:-1] + 1
    first = np.flatnonzero(head)
    period, start = at[first] // n, at[first] % n
    length = np.diff(np.append(first, len(at))) - 1 + 2 * period
    keep = length >= np.maximum(least, exponent * period)
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _sha(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def described(ids: list[int | None], texts: list[bytes], least: int, exponent: int, rewrite: Callable[[int | None, int], np.ndarray | None]) -> list[list]:
    """The columns of ``periodic_runs`` for a batch of UTF-8 texts."""
    known, words, counts = word_ids(texts, fold=False)
    begin = np.cumsum(counts) - counts
    parts, changed = [], []
    for k, (doc, n) in enumerate(zip(ids, counts.tolist(), strict=True)):
        new = rewrite(doc, n) if n else None
        own = known[begin[k] : begin[k] + n]
        parts.append(own if new is None else own[new])
        changed.append(new is not None)
    known = np.concatenate([*parts, known[:0]])
    # each text's words are its own, and so is its end
    places = np.arange(len(known)) + np.repeat(np.arange(len(texts)), counts)
    symbols = np.repeat(np.arange(len(texts), dtype=np.int64) * (len(words) + 1) + len(words), counts + 1)
    symbols[places] += known - len(words)
    start, length, period = runs(symbols, least, exponent)
    offset = begin + np.arange(len(texts))
    text_of = np.searchsorted(offset, start, "right") - 1
    cover = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    dropped = np.cumsum(cover[:-1]) > 0
    bounds = np.searchsorted(text_of, np.arange(len(texts) + 1)).tolist()
    out: list[list] = [[] for _ in range(9)]
    for k, n in enumerate(counts.tolist()):
        a, z = bounds[k], bounds[k + 1]
        o = int(offset[k])
        own = [(int(s) - o, int(l), int(p)) for s, l, p in zip(start[a:z], length[a:z], period[a:z], strict=True)]
        gone = dropped[o : o + n]
        if own or changed[k]:
            kept = b" ".join([words[w] for w in parts[k][~gone].tolist()])
        else:
            kept = b" ".join(texts[k].split())
        best = max(own, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        milli = None if not own else 1000 * best[1] // best[2]
        listed = "".join(f"{s},{l},{p}\n" for s, l, p in own).encode()
        row = (len(own), *best, milli, _sha(listed), _sha(kept), n, int(gone.sum()) if own else 0)
        for column, x in zip(out, row, strict=True):
            column.append(x)
    return out


def _as_is(doc: int | None, n: int) -> None:
    return None


def with_planted_runs(doc: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place once a tenth of the documents, by a hash of their ids, repeat themselves to their end."""
    h = zlib.crc32(str(doc).encode())
    g = h // 10
    if doc is None or h % 10:
        return None
    a = g % n
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % (1 + (n - a) // (3 + g % 8)))


def periodic_runs(
    docs: DataFrame, id: str = "doc_id", text: str = "text", *, least: int = 6, exponent: int = 4,
    rewrite: Callable[[int | None, int], np.ndarray | None] = _as_is,
) -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, n_words, n_dropped) of every row; ids are integers.

    Words are ``[^\\x20\\x09-\\x0D]+``. A run is a stretch of words with least period p, of ``least``
    words and ``exponent`` x p words at least, that neither neighbour extends. Start, length and
    period are those of the run with the greatest length / period, of several the first, then that of
    the smallest period; null without runs. A run's words after its first p are dropped; the hashes
    are of all runs' ``start,length,period`` in lines and of the kept words joined by spaces. Null
    and empty texts have no words. ``rewrite`` may replace the words of a text by others of it, by
    (id, count of words). Repeated rows come back as they are; null ids stay null; other columns are
    ignored, whatever their names. An empty table gives an empty one.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            made = described(b.column(0).to_pylist(), [x.encode() for x in strings(b.column(1))], least, exponent, rewrite)
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()] * 2
            names = [x.split(" ")[0] for x in _SCHEMA.split(", ")]
            yield pa.record_batch([b.column(0), *(pa.array(x, t) for x, t in zip(made, kinds, strict=True))], names=["id", *names])

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return by_batch(rows, work, f"id long, {_SCHEMA}").withColumnRenamed("id", id)
