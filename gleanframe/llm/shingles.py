"""Words and word shingles of many texts at once, in numpy.

Inside a batch words have exact numbers. Across batches a word is known by 128 bits of its BLAKE2
digest and a shingle by two independent 64-bit combinations of its words' halves.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@functools.lru_cache(maxsize=8)
def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants."""
    return mix(np.arange(1, n + 1, dtype=_U) * _ODD + _U(seed)) | _U(1)


def word_ids(texts: list[bytes], fold: bool = True) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Numbers of the words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 texts, the distinct words by number, and the count of words per text; ``fold``: A-Z as a-z."""
    joined = b"\n".join([b"", *texts, b""])
    buffer = np.frombuffer(joined.lower() if fold else joined, np.uint8)
    gap = _GAP[buffer]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    first, last = edge[0::2] + 1, edge[1::2] + 1
    offsets = np.concatenate([[0], np.cumsum(last - first)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(buffer[~gap].tobytes())])
    found = words.dictionary_encode()
    ends = np.cumsum(np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts)))
    counts = np.diff(np.searchsorted(first, np.concatenate([[0], ends])))
    return found.indices.to_numpy().astype(np.int64), found.dictionary.to_pylist(), counts


def digests(words: list[bytes]) -> np.ndarray:
    """128 bits of each word as two 64-bit numbers."""
    return np.frombuffer(b"".join([hashlib.blake2b(w, digest_size=16).digest() for w in words]), "<u8").reshape(-1, 2)


def _paired(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Equal numbers exactly for equal pairs."""
    return np.unique(x * (int(y.max(initial=0)) + 1) + y, return_inverse=True)[1].astype(np.int64)


def exact_windows(ids: np.ndarray, width: int) -> np.ndarray:
    """A number of each window of ``width`` ids, equal exactly for equal windows."""
    if len(ids) < width:
        return ids[:0]
    done, size = ids, 1
    while size < width:
        step = min(size, width - size)
        # two windows of ``size``, the second shifted by ``step``, cover size + step ids
        done = _paired(done[: len(done) - step], done[step:])
        size += step
    return done


def _heads(counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether a window of ``width`` words of one text starts at each word; the numbers of texts with fewer words."""
    left = np.repeat(np.cumsum(counts), counts) - np.arange(counts.sum())
    return left >= width, np.flatnonzero((counts > 0) & (counts < width))


def shingle_counts(counts: np.ndarray, width: int) -> np.ndarray:
    return np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))


def shingle_hashes(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes (n x 2) of the shingles of ``width`` words of each text in order, and their count per text.

    A text with fewer words has its whole sequence as one shingle, a text without words none.
    """
    ids, words, counts = word_ids(texts)
    own, n = digests(words), max(len(ids) - width + 1, 0)
    keep, short = _heads(counts, width)
    begin, out = np.cumsum(counts) - counts, []
    keep[begin[short]] = True
    for side in range(2):
        q, h = constants(width, 5 + side), own[:, side][ids]
        rolled = np.zeros(len(ids), _U)
        for j in range(width):
            rolled[:n] += h[j : j + n] * q[j]
        for k in short:
            a = begin[k]
            rolled[a] = (h[a : a + counts[k]] * q[: counts[k]]).sum(dtype=_U) + _U(counts[k])
        out.append(mix(rolled[keep]))
    return np.stack(out, axis=1), shingle_counts(counts, width)


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """The distinct shingles of each text as two hashes (n x 2), sorted by the first."""
    hashes, counts = shingle_hashes(texts, width)
    out, at = [], 0
    for n in counts.tolist():
        x = hashes[at : at + n]
        at += n
        x = x[np.argsort(x[:, 0], kind="stable")]
        out.append(x if n < 2 else x[np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)])])
    return out


def exact_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingles of each text, by numbers that are exact within this call."""
    ids, _, counts = word_ids(texts)
    keep, short = _heads(counts, width)
    windows = exact_windows(ids, width)[keep[: max(len(ids) - width + 1, 0)]]
    out, at, begin, whole, few = [], 0, np.cumsum(counts) - counts, {}, set(short.tolist())
    for k, n in enumerate(shingle_counts(counts, width).tolist()):
        if k in few:
            sequence = tuple(ids[begin[k] : begin[k] + counts[k]].tolist())
            out.append(np.array([-1 - whole.setdefault(sequence, len(whole))], np.int64))
            continue
        out.append(np.unique(windows[at : at + n]))
        at += n
    return out
