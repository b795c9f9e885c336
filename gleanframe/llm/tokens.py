"""Token ids of whole texts by public vocabularies, unit by unit.

A pre-token never holds a non-space character followed by white space. A text can so be cut
before any space that follows a non-space character and its units be encoded alone. Arrow finds
the distinct units of a batch; only those that a bounded memo lacks are encoded.
"""

from __future__ import annotations

import array
import base64
import contextlib
import itertools
import json
import os
import re
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .common import cached

#: Entries of the memos of units and of their pre-tokens. Those that come first stay: the frequent ones are among them.
MEMO_UNITS, MEMO_PIECES = 500_000, 250_000
#: Units that the library encodes in one call, and entries of the memo before it: two workers of an executor hold one each.
LUMP, MEMO_LUMPS = 500, 250_000
_AMBIGUOUS = re.compile(r"\s (?:\s|\Z)")
_ASCII_PAIRS = tuple(x + " " for x in " \n\t\r\x0b\x0c\x1c\x1d\x1e\x1f")
_CUT = re.compile(r"(?<=\S)(?=[\t-\r ])")


def is_plain(text: str) -> bool:
    """Whether the text may be cut before each of its spaces."""
    if text.isascii():
        return not any(x in text for x in _ASCII_PAIRS)
    return _AMBIGUOUS.search(text) is None


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``flat[starts[k] : starts[k] + lengths[k]]``, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    at = np.repeat(starts - (ends - lengths), lengths)
    at += np.arange(ends[-1])
    return flat[at]


def listed(values: pa.Array) -> list[str]:
    """Python strings of an array without nulls; much faster than ``to_pylist``."""
    return values.to_numpy(zero_copy_only=False).tolist()


class BatchEncoder:
    """Ids of whole texts. ``missing`` encodes units that the memo lacks: texts to packed ids.

    A unit's key is its text without the leading space, or, if it has none, behind a space.
    """

    def __init__(self, missing: Callable[[list[str]], list[bytes]], dtype: str, limit: int = MEMO_UNITS):
        self.missing, self.dtype, self.limit, self.memo = missing, np.dtype(dtype), limit, {}

    def packed(self, keys: list[str]) -> list[bytes]:
        memo = self.memo
        found = list(map(memo.get, keys))
        lack = [k for k, x in enumerate(found) if x is None]
        made = self.missing([keys[k][1:] if keys[k][:1] == " " else " " + keys[k] for k in lack])
        for k, x in zip(lack, made, strict=True):
            found[k] = x
        if len(memo) < self.limit:
            memo.update((keys[k], x) for k, x in zip(lack, made, strict=True) if len(keys[k]) < 200)
        return found

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """An array of ids for each text."""
        units, counts = [], np.zeros(len(texts), np.int64)
        plain = [k for k, x in enumerate(texts) if is_plain(x)]
        rest = sorted(set(range(len(texts))) - set(plain))
        if plain:
            cut = pc.split_pattern(pa.array([texts[k] for k in plain], pa.large_string()), " ")
            at = cut.offsets.to_numpy()
            counts[plain] = np.diff(at)
            found = cut.flatten().dictionary_encode()
            heads = pa.array([" " + texts[k].split(" ", 1)[0] for k in plain], pa.large_string())
            index = found.indices.to_numpy().astype(np.int64)
            index[at[:-1]] = len(found.dictionary) + np.arange(len(plain))
            units.append((listed(found.dictionary) + listed(heads), index))
        if rest:
            cuts = [[" " + u for u in _CUT.split(texts[k])] for k in rest]
            counts[rest] = [len(x) for x in cuts]
            found = pa.array([u for x in cuts for u in x], pa.large_string()).dictionary_encode()
            units.append((listed(found.dictionary), found.indices.to_numpy().astype(np.int64)))
        out: list[np.ndarray] = [np.empty(0, self.dtype)] * len(texts)
        for group, (keys, index) in zip([x for x in (plain, rest) if x], units, strict=True):
            ids = self.packed(keys)
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
            flat = np.frombuffer(b"".join(ids), self.dtype)
            lengths = size[index]
            tokens = gather(flat, (np.cumsum(size) - size)[index], lengths)
            edges = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts[group])])]
            for j, k in enumerate(group):
                out[k] = tokens[edges[j] : edges[j + 1]]
        return out


class PieceEncoder:
    """Packed ids of units by way of their pre-tokens, with a memo of those.

    ``encode`` turns a list of distinct pre-tokens into their packed ids.
    """

    def __init__(self, pattern: str, encode: Callable[[list[str]], list[bytes]], limit: int = MEMO_PIECES):
        self.findall, self.encode, self.limit, self.memo = regex.compile(pattern).findall, encode, limit, {}

    def pieces(self, unit: str) -> list[str]:
        """A word and one mark by a short way; all else by the pattern."""
        word = unit.removeprefix(" ")
        if word[:-1].isalpha() and word[-1] in ".,;:!?":
            return [unit[:-1], unit[-1]]
        return self.findall(unit)

    def __call__(self, units: list[str]) -> list[bytes]:
        cuts, memo = [(x,) if x.removeprefix(" ").isalpha() else self.pieces(x) for x in units], self.memo
        lack = [x for x in set(itertools.chain.from_iterable(cuts)) if x not in memo]
        made = dict(zip(lack, self.encode(lack), strict=True))
        out = [(memo.get(c[0]) or made[c[0]]) if len(c) == 1 else b"".join([memo.get(x) or made[x] for x in c]) for c in cuts]
        if len(memo) < self.limit:
            memo.update((x, y) for x, y in made.items() if len(x) < 200)
        return out


class LumpEncoder:
    """Packed ids of units, many in one call of the library's ``tokenizer``.

    Short units of a space and a text without spaces that doesn't end in white space keep their ids
    when they stand one behind the other, and the id with a unit's space is its first. All others
    go to ``other``, as does a lump in which spaces and units aren't equally many.
    """

    def __init__(self, tokenizer, other: Callable[[list[str]], list[bytes]], dtype: str, space: str):
        self.encode, self.other, self.dtype = tokenizer.encode_batch_fast, other, np.dtype(dtype)
        ids = [k for x, k in tokenizer.get_vocab(with_added_tokens=False).items() if space in x]
        self.spaced = np.zeros(max(ids, default=0) + 1, bool)
        self.spaced[ids] = True

    def lump(self, units: list[str]) -> list[bytes]:
        flat = np.array(self.encode(["".join(units)], add_special_tokens=False)[0].ids, np.int64)
        first = np.flatnonzero(self.spaced[np.minimum(flat, len(self.spaced) - 1)] & (flat < len(self.spaced)))
        if len(first) != len(units) or first[0]:
            return self.other(units)
        width, data = self.dtype.itemsize, flat.astype(self.dtype).tobytes()
        return [data[a:z] for a, z in itertools.pairwise([*(first * width).tolist(), len(data)])]

    def __call__(self, units: list[str]) -> list[bytes]:
        alone = [k for k, x in enumerate(units) if x.rfind(" ") != 0 or len(x) > 200 or x[-1].isspace()]
        out: list[bytes] = [b""] * len(units)
        for k, x in zip(alone, self.other([units[k] for k in alone]), strict=True):
            out[k] = x
        kept = sorted(set(range(len(units))) - set(alone))
        for at in range(0, len(kept), LUMP):
            some = kept[at : at + LUMP]
            for k, x in zip(some, self.lump([units[k] for k in some]), strict=True):
                out[k] = x
        return out


def spelled(pieces: list[str], letters: dict[int, str]) -> list[str]:
    """The pieces in the letters that stand for their bytes: all without line feeds at once, those with one by one."""
    table = np.array([ord(letters[k]) if k != 10 else 10 for k in range(256)], "<u4")
    flat = "\n".join(pieces)
    if flat.count("\n") == len(pieces) - 1:
        return table[np.frombuffer(flat.encode(), np.uint8)].tobytes().decode("utf-32-le").split("\n")
    broken = ["\n" in x for x in pieces]
    rest = iter(spelled([x for x, y in zip(pieces, broken, strict=True) if not y], letters) if not all(broken) else [])
    return [x.encode().decode("latin-1").translate(letters) if y else next(rest) for x, y in zip(pieces, broken, strict=True)]


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


@cached
def json_encoder(path: str) -> Callable[[list[str]], list[np.ndarray]]:
    """Encoder by a file of the tokenizers library, without special tokens.

    Files with a normalizer or another than the plain byte-level pre-tokenizer are encoded text
    by text.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    dtype = "<u2" if t.get_vocab_size() <= 1 << 16 else "<u4"
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    pre = made.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    if not plain or made.get("normalizer") or made["model"].get("type", "BPE") != "BPE":
        return lambda texts: [np.asarray(x.ids, dtype) for x in t.encode_batch_fast(texts, add_special_tokens=False)]
    bpe = t.model
    with contextlib.suppress(AttributeError):
        bpe._resize_cache(0)  # the memos here come first; the model's own costs more than it saves
    letters, tokenize, code, width = byte_letters(), bpe.tokenize, np.dtype(dtype).char, np.dtype(dtype).itemsize

    def encode(pieces: list[str]) -> list[bytes]:
        made = [[y.id for y in tokenize(x)] for x in spelled(pieces, letters)] if pieces else []
        flat = array.array(code, itertools.chain.from_iterable(made)).tobytes()
        ends = list(itertools.accumulate((len(x) * width for x in made), initial=0))
        return [flat[a:z] for a, z in itertools.pairwise(ends)]

    whole = Tokenizer(bpe)
    whole.pre_tokenizer = t.pre_tokenizer
    return BatchEncoder(LumpEncoder(whole, PieceEncoder(public_tokenizers.PATTERN, encode), dtype, letters[32]), dtype, MEMO_LUMPS)


def vocabulary_size(path: str) -> int:
    """One more than the greatest id of a file of the tokenizers library."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()) + 1


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@cached
def rank_encoding(path: str, pattern: str = public_tokenizers.PATTERN):
    """The tiktoken library's encoding of a rank file, without special tokens."""
    import tiktoken

    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
