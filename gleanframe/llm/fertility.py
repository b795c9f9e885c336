"""Quality rules by tokeniser fertility.

Public vocabularies measure, per text, characters per token, the share of tokens that are pieces
of a character's bytes, and the entropy of its tokens. Texts outside the band of their language
(or script, where no language is given) are rejected; where that has few texts, of the band of their
script among all texts, else of that of all texts. The bands are robust fences around the quartiles
of all texts that pass the base rules.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_batch, cached, operator, rows_of, staged, strings
from .shingles import constants, exact_windows, mix, word_ids
from .tokens import rank_encoding, read_ranks

#: Vocabularies by default: one for many languages and one for English and code. Each has bands of its own.
VOCABULARIES = ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken")
SYMBOLS = b"#*$%&|<>"
#: A repeated window has so many words.
WINDOW = 8

_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
#: What each vocabulary measures; column names end with its number.
MEASURES = ("n_tokens", "chars_per_token", "fallback_share", "entropy")


def _table(marked: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(marked)] = True
    return out


_SYMBOL, _GAP = _table(SYMBOLS), _table(b" \t\n\x0b\x0c\r")
_FOLLOWS = np.arange(256) & 0xC0 == 0x80


def repeated_words(texts: list[bytes], width: int = WINDOW) -> list[int]:
    """Words of each text that lie in a window of ``width`` words found twice or more in it; words are exact.

    Windows are sorted by a hash and neighbours of equal hash compared word by word; a text in
    which two different windows share a hash is done by exact numbers of all windows.
    """
    ids, _, counts = word_ids(texts, fold=False)
    q, scattered = constants(width, 13), mix(ids.astype(np.uint64))
    n = max(len(ids) - width + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for j in range(width):
        rolled += scattered[j : j + n] * q[j]
    out, at = [], 0
    for m in counts.tolist():
        windows = m - width + 1
        found = 0
        if windows > 1:
            own = rolled[at : at + windows]
            order = np.argsort(own, kind="stable")
            same = own[order][1:] == own[order][:-1]
            if same.any():
                view = np.lib.stride_tricks.sliding_window_view(ids[at : at + m], width)
                if (view[order[1:][same]] != view[order[:-1][same]]).any():
                    own = exact_windows(ids[at : at + m], width)
                    order = np.argsort(own, kind="stable")
                    same = own[order][1:] == own[order][:-1]
                twice = np.zeros(windows, bool)
                twice[order[1:][same]] = True
                twice[order[:-1][same]] = True
                cover = np.zeros(m + 1, np.int64)
                cover[:windows] += twice
                cover[width : width + windows] -= twice
                found = int((np.cumsum(cover[:m]) > 0).sum())
        out.append(found)
        at += m
    return out


def base_counts(texts: list[bytes]) -> dict[str, list[int]]:
    """The counts of the base rules of UTF-8 texts."""
    out: dict[str, list[int]] = {x: [] for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines")}
    for t in texts:
        a = np.frombuffer(t, np.uint8)
        gap = _GAP[a]
        out["n_words"].append(int((~gap).sum() and (np.count_nonzero(gap[:-1] & ~gap[1:]) + (not gap[0]))))
        out["word_chars"].append(int(len(a) - np.count_nonzero(gap) - np.count_nonzero(_FOLLOWS[a])))
        out["n_symbols"].append(int(np.count_nonzero(_SYMBOL[a])))
        lines = [x for x in t.split(b"\n") if x.split(None, 1)]
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
    return out | {"n_repeat_words": repeated_words(texts)}


@cached
def _partial(path: str) -> np.ndarray:
    """Per id, whether the token is no whole characters: what stands in for characters that the vocabulary lacks."""

    def broken(token: bytes) -> bool:
        try:
            token.decode()
        except UnicodeDecodeError:
            return True
        return False

    ranks = read_ranks(path)
    out = np.zeros(max(ranks.values()) + 1, bool)
    for token, k in ranks.items():
        out[k] = broken(token)
    return out


@functools.lru_cache(maxsize=1)
def scripts() -> tuple[np.ndarray, list[str]]:
    """The number of each code point's script, 0 if it is no letter, and the scripts' names."""
    numbers, out = {"none": 0, "LATIN": 1}, np.zeros(0x110000, np.uint16)
    for c in range(0x110000):
        if chr(c).isalpha():
            name = "LATIN" if c < 0x250 else unicodedata.name(chr(c), "OTHER").split(" ")[0]
            out[c] = numbers.setdefault(name, len(numbers))
    return out, list(numbers)


def script_of(text: str) -> str:
    """The script of most letters of the whole text, of equally many the first by name; ``none`` without letters."""
    if text.isascii():
        return "LATIN" if re.search("[A-Za-z]", text) else "none"
    table, names = scripts()
    seen = np.bincount(table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")], minlength=2)
    seen[0] = 0
    return min(names[k] for k in np.flatnonzero(seen == seen.max())) if seen.any() else "none"


def measured(text: str, path: str, pattern: str) -> tuple[int, float, float, float]:
    """Tokens, characters per token, share of partial tokens and token entropy in bits by one vocabulary."""
    ids = rank_encoding(path, pattern).encode_to_numpy(text)
    n = len(ids)
    if not n:
        return 0, 0.0, 0.0, 0.0
    used = np.bincount(ids)
    used = used[used > 0]
    bits = math.log2(n) - float((used * np.log2(used)).sum()) / n
    return n, len(text) / n, np.count_nonzero(_partial(path)[ids]) / n, bits


def measure(docs: DataFrame, id: str, text: str, lang: str | None, paths: Sequence[str], pattern: str) -> DataFrame:
    """The base counts and the measures of every document."""
    columns = [f"{m}_{k}" for k in range(len(paths)) for m in MEASURES]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            texts = strings(b.column(2))
            base = base_counts([x.encode() for x in texts])
            arrays = [b.column(0), b.column(1)] + [pa.array(x, pa.int64()) for x in base.values()]
            arrays.append(pa.array([len(x) for x in texts], pa.int64()))
            for p in paths:
                found = list(zip(*(measured(x, p, pattern) for x in texts), strict=True)) or [()] * len(MEASURES)
                arrays += [pa.array(x, pa.float64() if j else pa.int64()) for j, x in enumerate(found)]
            arrays.append(pa.array(list(map(script_of, texts)), pa.string()))
            yield pa.record_batch(arrays, names=["id", "lang", *base, "n_chars", *columns, "script"])

    given = F.lit(None).cast("string") if lang is None else F.col(lang).cast("string")
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), given.alias("lang"), F.col(text).alias("text"))
    each = ", ".join(f"{c} {'long' if c.startswith('n_tokens') else 'double'}" for c in columns)
    return by_batch(rows, work, f"id {kind}, lang string, {_BASE}, n_chars long, {each}, script string")


#: Measures that have bands: width of histogram bins, interquartile ranges that a band reaches beyond
#: the quartiles, the least such reach, and what is added to it over the square root of the tokens,
#: for the noise of short texts.
BANDED = {
    "chars_per_token": (1 / 256, 3.5, 0.08, 2.0),
    "fallback_share": (1 / 1024, 3.0, 0.03, 0.3),
    "spread": (1 / 64, 2.0, 0.4, 4.0),
}


#: The band of all texts, and what stands before a script in the key of its band.
ALL, ANY_LANGUAGE = "all", "all, script "


def levels() -> list[Column]:
    """The keys of the bands of a text, from its own to that of all texts; the first letter tells them apart."""
    return [F.concat(F.lit("0"), "key"), F.concat(F.lit("1" + ANY_LANGUAGE), "script"), F.lit("2" + ALL)]


def _numbered(name: str, k: int) -> str:
    return f"{name}_{k}"


def _spread(k: int, tokens: Column) -> Column:
    """The entropy above the line fitted to its growth with the logarithm of the length."""
    line = lambda x: F.coalesce(F.col(_numbered(x, k)), F.lit(0.0))
    return F.col(_numbered("entropy", k)) - line("slope") * F.log2(tokens) - line("offset")


def resolved(known: DataFrame, least_texts: int, vocabularies: int) -> DataFrame:
    """For each (key, script) of ``known`` the first of its bands that there is, without those of fewer than ``least_texts`` texts."""
    per_level = known.where(~F.col("base_failed")).withColumn("key", F.explode(F.array(*levels())))
    found = bands(per_level, least_texts, vocabularies)
    lines = [_numbered(x, k) for k in range(vocabularies) for x in ("slope", "offset")]
    band = found.select(F.col("key").alias("of"), F.struct("bands", *lines, F.substring("key", 2, 1 << 30).alias("band")).alias("x"))
    own = known.select("key", "script").distinct().select("key", "script", F.posexplode(F.array(*levels())).alias("level", "of"))
    first = own.join(band, "of").groupBy("key", "script").agg(F.min_by("x", "level").alias("x"))
    return staged(first.select("key", "script", "x.*"), "bands-by-key")


def bands(known: DataFrame, least_texts: int, vocabularies: int) -> DataFrame:
    """(key, measure -> [low, high]) of each key with ``least_texts`` different texts, and of that of all.

    A band lies around the quartiles of all texts that pass the base rules (see ``BANDED``); texts
    of equal measures, such as copies, count once. Quartiles come from histograms of fixed bins, so
    they don't depend on how rows are dealt out, but for the last bits of the lines fitted to the
    entropies, whose sums of doubles Spark adds in the order in which tasks end.
    """
    each = range(vocabularies)
    own = known.where(~F.col("base_failed")).select("key", "n_chars", *[_numbered(m, k) for k in each for m in MEASURES]).distinct()
    fits = []
    for k in each:
        y, x = F.col(_numbered("entropy", k)), F.log2(_numbered("n_tokens", k))
        fits += [F.regr_slope(y, x).alias(_numbered("slope", k)), F.regr_intercept(y, x).alias(_numbered("offset", k))]
    line = own.groupBy("key").agg(F.count("*").alias("texts"), *fits)
    line = staged(line.where((F.col("texts") >= least_texts) | (F.col("key") == "2" + ALL)), "lines")
    fitted = own.join(line, "key").withColumns({_numbered("spread", k): _spread(k, F.col(_numbered("n_tokens", k))) for k in each})
    binned = [F.struct(F.lit(m).alias("kind"), F.lit(_numbered(m, k)).alias("measure"), F.floor(F.col(_numbered(m, k)) / w).alias("bin")) for k in each for m, (w, *_) in BANDED.items()]
    bins = fitted.select("key", "texts", F.explode(F.array(*binned)).alias("x")).groupBy("key", "texts", "x.kind", "x.measure", "x.bin").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("key", "measure").orderBy("bin"))
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("texts") * q, F.col("bin")))
    found = bins.withColumn("upto", upto).groupBy("key", "kind", "measure").agg(at(0.25).alias("low"), (at(0.75) + 1).alias("high"))
    width, fences, floor = (F.create_map(*[F.lit(x) for m, b in BANDED.items() for x in (m, b[k])])[F.col("kind")] for k in range(3))
    reach = F.greatest((F.col("high") - F.col("low")) * width * fences, floor)
    edges = F.map_from_entries(F.collect_list(F.struct("measure", F.array(F.col("low") * width - reach, F.col("high") * width + reach))))
    return staged(found.groupBy("key").agg(edges.alias("bands")).join(line, "key"), "bands")


@operator
def judged(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str | None = "lang", *, vocabularies: Sequence[str] | None = None,
    pattern: str = public_tokenizers.PATTERN, min_words: int = 20, max_repeat_percent: int = 30, least_texts: int = 50,
) -> DataFrame:
    """The base counts, measures and verdict (``base_failed``, ``kept``) of every row.

    Base rules: fewer than ``min_words`` words, or more than ``max_repeat_percent`` % of the words
    in 8-word windows found twice or more. The others are kept if, by each of the vocabularies,
    characters per token, share of partial tokens and entropy lie in the bands of their language;
    texts without one are judged by script. One with fewer than ``least_texts`` different texts has
    the band of its script among all texts, a script with fewer that of all texts; ``band`` tells
    which. ``vocabularies``: paths of rank files; columns of measures end with a file's number.
    Null text counts as empty and fails. Rows are judged one by one, so a repeated row gets its
    verdict again. Other columns are ignored, whatever their names. An empty table gives an empty one.
    """
    paths = tuple(vocabularies or map(public_tokenizers.path, VOCABULARIES))
    each = range(len(paths))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    key = F.coalesce("lang", F.concat(F.lit("script "), F.col("script")))
    known = staged(measure(docs, id, text, lang, paths, pattern), "fertility").withColumns({"base_failed": failed, "key": key})
    joined = known.join(resolved(known, least_texts, len(paths)), ["key", "script"], "left")
    tokens = {k: F.greatest(F.col(_numbered("n_tokens", k)), F.lit(1)) for k in each}
    joined = joined.withColumns({_numbered("spread", k): _spread(k, tokens[k]) for k in each})

    def inside(m: str, k: int) -> Column:
        noise, band, name = BANDED[m][3] / F.sqrt(tokens[k]), F.col("bands")[_numbered(m, k)], _numbered(m, k)
        above = F.lit(True) if m == "fallback_share" else F.col(name) >= band[0] - noise
        return above & (F.col(name) <= band[1] + noise)

    fits = functools.reduce(Column.__and__, [inside(m, k) for k in each for m in BANDED])
    kept = ~F.col("base_failed") & (F.col("bands").isNull() | fits)
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    more = [_numbered(m, k) for k in each for m in (*MEASURES, "spread")]
    return joined.select(F.col("id").alias(id), *columns, kept.alias("kept"), *more, F.coalesce("band", "key").alias("band"))
