"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram's vector is the product of its letters'
vectors, each rotated by its place; a text's vector is the sum over its n-grams. The prototype of a
language is the sum over its texts, and a text gets the language whose prototype has the greatest
cosine with its vector.

Products with a sum are sums of products: the dot product of a text with a prototype is the sum,
over its n-grams, of the n-gram vector's dot product with the prototype. A worker computes those
once per n-gram that occurs. A text's norm is taken from its n-gram counts, around which the norm
of the hypervector scatters by the random products.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ARROW, by_batch, operator, rows_of, settings, strings
from .shingles import mix

NGRAM = 3
DIMENSIONS = 2048
SEED = 20240229
UNKNOWN = "und"
#: Bits of a code point in an n-gram's number.
_BITS = 21
#: N-grams whose products with the prototypes a worker keeps; when there are more it starts again.
_KEPT = 1 << 18
_BLOCK = 512


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """The lower-case letter of each code point as a code point; 0: no letter."""
    out = np.zeros(0x110000, np.int64)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            out[c] = ord(x.lower()[0])
    return out


def letter_vectors(points: np.ndarray, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """A random vector of +1 and -1 for each code point, from a hash of the seed and the point; 0 stands for the gap between words."""
    own = mix(points.astype(np.uint64) + np.uint64(seed << 21))
    words = mix(own[:, None] + np.arange(-(-dimensions // 64), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    bits = np.unpackbits(words.astype("<u8").view(np.uint8), axis=1, bitorder="little")
    return (bits[:, :dimensions].astype(np.int8) << 1) - np.int8(1)


def ngram_vectors(codes: np.ndarray, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """The vectors of n-grams: the product of their letters' vectors, each rotated by its place."""
    parts = np.stack([codes >> (_BITS * (NGRAM - 1 - k)) & ((1 << _BITS) - 1) for k in range(NGRAM)])
    points, at = np.unique(parts, return_inverse=True)
    at = at.reshape(parts.shape)
    own = letter_vectors(points, dimensions, seed)
    out = own[at[0]]
    for k in range(1, NGRAM):
        out *= np.roll(own, k, axis=1)[at[k]]
    return out


def bundled(codes: np.ndarray, counts: np.ndarray, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """The sum of the n-grams' vectors, each as often as counted; whole numbers."""
    out = np.zeros(dimensions)
    for a in range(0, len(codes), _BLOCK):
        out += counts[a : a + _BLOCK].astype(float) @ ngram_vectors(codes[a : a + _BLOCK], dimensions, seed)
    return out


def encode(text: str, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """The hypervector of a text."""
    return bundled(*np.unique(ngrams([text])[0], return_counts=True), dimensions, seed)


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of all texts and the number of them per text. Runs without letters count as one gap."""
    points = np.frombuffer("".join(f"\x00{x.replace(chr(0), ' ')} " for x in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    head = points == 0
    kinds = letters()[points]
    keep = head | (kinds > 0)
    keep[1:] |= kinds[:-1] > 0
    kinds, owner = kinds[keep], np.cumsum(head[keep], dtype=np.int64) - 1
    if len(kinds) < NGRAM:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    codes = kinds[:-2] << 2 * _BITS | kinds[1:-1] << _BITS | kinds[2:]
    whole = (owner[:-2] == owner[2:]) & (codes > 0)
    return codes[whole], np.bincount(owner[:-2][whole], minlength=len(texts))


class Profiles:
    """Prototypes of languages: the normed sums of all their n-grams' vectors."""

    def __init__(self, languages: list[str], sums: np.ndarray, totals: np.ndarray, seed: int = SEED):
        self.languages, self.seed, self.dimensions = languages, seed, sums.shape[1]
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        self.prototypes = sums / np.where(length == 0, 1, length)
        # the chance that two n-grams of a language are the same: a sum's squared norm is about the sum of squared counts times the dimensions
        self.peak = length[:, 0] ** 2 / self.dimensions / np.maximum(totals, 1.0) ** 2
        self._keys, self._products = np.empty(0, np.int64), np.empty((0, len(languages)))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_keys": self._keys[:0], "_products": self._products[:0]}

    def products(self, codes: np.ndarray) -> np.ndarray:
        """Dot products of distinct n-grams' vectors with the prototypes."""
        if len(self._keys) + len(codes) > _KEPT:
            self._keys, self._products = self._keys[:0], self._products[:0]
        new = np.setdiff1d(codes, self._keys)
        if len(new):
            made = [ngram_vectors(new[a : a + _BLOCK], self.dimensions, self.seed) @ self.prototypes.T for a in range(0, len(new), _BLOCK)]
            keys = np.concatenate([self._keys, new])
            order = np.argsort(keys, kind="stable")
            self._keys, self._products = keys[order], np.concatenate([self._products, *made])[order]
        return self._products[np.searchsorted(self._keys, codes)]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language of each text and a score: half of one more than the cosine with its prototype."""
        return self.fit(texts)[:2]

    def fit(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """What ``predict`` gives, the number of n-grams, and how well each text fits its language.

        The fit is the cosine with the language's prototype over what a text of so many n-grams
        drawn from the language would have, so that texts of any length compare; about 1 in the
        language.
        """
        codes, counts = ngrams(texts)
        known = (counts > 0) & (len(self.languages) > 0)
        if not known.any():
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), counts, np.zeros(len(texts))
        found = pa.array(codes).dictionary_encode()
        distinct = found.dictionary.to_numpy()
        owner = np.repeat(np.arange(len(texts), dtype=np.int64), counts)
        pairs, times = np.unique(owner * len(distinct) + found.indices.to_numpy(), return_counts=True)
        owner, at = np.divmod(pairs, len(distinct))
        products = self.products(distinct)
        dots = np.stack([np.bincount(owner, times * products[at, k], minlength=len(texts)) for k in range(len(self.languages))], axis=1)
        best = dots.argmax(axis=1)
        squares = np.bincount(owner, times.astype(float) ** 2, minlength=len(texts))
        cosine = dots[np.arange(len(texts)), best] / np.sqrt(np.maximum(squares, 1) * self.dimensions)
        score = np.where(known, np.clip((1 + cosine) / 2, 0, 1), 0.0)
        mean = counts * self.peak[best]
        expected = np.sqrt(mean / (1 + mean))
        langs = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, known, strict=True)]
        return langs, score, counts, np.where(known & (expected > 0), cosine / np.where(expected > 0, expected, 1), 0.0)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", train: Column | None = None, *, dimensions: int = DIMENSIONS, seed: int = SEED) -> Profiles:
    """Profiles from all rows with text and a language for which ``train`` holds; a repeated row counts again.

    Each task bundles its rows by language, and Spark sums the vectors: what reaches the driver
    are ``dimensions`` numbers a language. Other columns are ignored. An empty table, or one
    without languages or letters, teaches none.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def added(name: str) -> tuple[np.ndarray, np.ndarray]:
            codes = np.concatenate([x for x, _ in found[name]])
            keys, inverse = np.unique(codes, return_inverse=True)
            return keys, np.bincount(inverse, np.concatenate([n for _, n in found[name]]), minlength=len(keys))

        def bundle(name: str) -> pa.RecordBatch:
            codes, counts = added(name)
            found.pop(name)
            values = np.append(counts.sum(), bundled(codes, counts, dimensions, seed))
            return pa.record_batch([pa.array([name] * len(values), pa.string()), pa.array(np.arange(-1, dimensions)), pa.array(np.rint(values).astype(np.int64))], names=["lang", "at", "x"])

        for b in rows_of(batches):
            codes, counts = ngrams(strings(b.column(0)))
            names, which = np.unique(np.array(b.column(1).to_pylist(), object), return_inverse=True)
            own = np.repeat(which, counts)
            for k, name in enumerate(names.tolist()):
                lot = found.setdefault(name, [])
                lot.append(np.unique(codes[own == k], return_counts=True))
                if len(lot) > 1 and sum(len(x) for x, _ in lot[1:]) > max(1 << 17, len(lot[0][0])):
                    found[name] = [added(name)]
                    if len(found[name][0][0]) > 1 << 20:
                        yield bundle(name)
            while len(found) > 64:
                yield bundle(next(iter(found)))
        for name in list(found):
            yield bundle(name)

    own = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    if train is not None:
        own = own.where(train)
    rows = by_batch(own.select(F.col(text), F.col(lang).cast("string")), work, "lang string, at long, x long")
    with settings(docs.sparkSession, ARROW):
        got = rows.groupBy("lang", "at").agg(F.sum("x").alias("x")).toArrow().to_pandas()
    languages = sorted(got.loc[(got["at"] < 0) & (got["x"] > 0), "lang"].unique())
    table = np.zeros((len(languages), dimensions + 1))
    got = got[got["lang"].isin(languages)]
    table[[languages.index(x) for x in got["lang"]], got["at"].to_numpy(np.int64) + 1] = got["x"]
    return Profiles(languages, table[:, 1:], table[:, 0], seed)


@operator
def identified(docs: DataFrame, profiles: Profiles, id: str = "doc_id", text: str = "text", *, fit: bool = False) -> DataFrame:
    """(id, lang_pred, score) of every row; with ``fit`` also n_ngrams and fit (see ``Profiles.fit``).

    ``score`` is (1 + cosine) / 2, the cosine being that with the best prototype. ``und`` with
    score 0 where the text is null or has no letter, or no language was learnt. Ties go to the
    language that comes first by name. A repeated row is judged again. Other columns are ignored.
    An empty table gives an empty one.
    """
    kind = docs.schema[id].dataType.simpleString()
    model = docs.sparkSession.sparkContext.broadcast(profiles)  # ``dimensions`` numbers a language

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            langs, *numbers = (model.value.fit if fit else model.value.predict)(strings(b.column(1)))
            yield pa.record_batch([b.column(0), pa.array(langs, pa.string()), *map(pa.array, numbers)], names=["id", "lang_pred", *names])

    names = ["score", "n_ngrams", "fit"] if fit else ["score"]
    schema = f"id {kind}, lang_pred string, score double" + ", n_ngrams long, fit double" * fit
    return by_batch(docs.select(F.col(id).alias("id"), F.col(text)), work, schema).withColumnRenamed("id", id)
