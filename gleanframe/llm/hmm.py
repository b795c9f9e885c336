"""A hidden Markov language model over words.

Counts of all words come first. Every word seen twice or more is a symbol of its own; those seen
once or never share one symbol, within which a word has the add-one share of its count. Texts are
encoded once, in lots of like length. Baum-Welch runs over all whole training texts: each task adds
up expected counts, Spark sums them, and the driver makes the next model from the sums.

The emissions of the most frequent words are held by every task and re-estimated in each round.
Those of all others are tied over the states until the last round, whose expected counts then give
each of them emissions of its own: a table by word, which grows with the corpus and is joined to the
lots once, for scoring. The scaled forward recursion gives the exact probability of each whole text.
"""

from __future__ import annotations

import gc
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ARROW, by_batch, finished, give_back, operator, rows_of, settings, staged, strings, working_for

STATES = 12
#: Most frequent words, whose emissions every task holds; id 0 stands for the others, 1 for the end.
HELD = 65_534
#: Rounds of Baum-Welch at most; they end sooner when a token's mean log10 probability gains less than this.
ROUNDS, GAIN = 3, 1e-3
#: Steps of the recursions whose forward variables are kept at once; those before are computed again.
BLOCK = 2048
#: Every so many steps the recursions' variables are divided by their sums; between, a step may leave 1e-18 of a text's probability.
RESCALED = 16
#: Most tokens of a text in each kind of lot, and tokens of a lot, but for its last text.
LOTS = ((512, 1 << 18), (BLOCK, 1 << 19), (1 << 62, 1 << 20))
#: Share of a state's emissions that follows the words' overall frequencies.
SMOOTHING = 0.02
#: Frequent words that seed the states, and the neighbours by which they are told apart.
SEEDED, NEIGHBOURS = 2000, 64
#: Expected counts are summed as multiples of 1 / UNIT, so that no order of rows changes them.
UNIT = 1 << 16
_FLUSH = 400_000
#: Tokens whose expected counts of steps are added up at once.
_AT_ONCE = 16384
END = ""


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8."""
    return text.encode().lower().split()


def _strings(words: Iterable[bytes]) -> pa.Array:
    return pa.array(list(words), pa.binary()).cast(pa.string())


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, c) over all documents; the empty word stands for the end of a text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            rows = pa.record_batch([_strings(found), pa.array(found.values(), pa.int64())], names=["word", "c"])
            found.clear()
            return rows

        for b in rows_of(batches):
            for t in strings(b.column(0)):
                found.update(words_of(t))
                found[b""] += 1
                if len(found) > _FLUSH:
                    yield flush()
        if found:
            yield flush()

    return by_batch(docs.select(F.col(text)), work, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Held words by rank, and the totals of the training texts."""

    words: list[str]
    counts: np.ndarray  # of the symbols: words seen once, end, held words
    tokens: int  # N
    types: int  # V
    rare_tokens: int  # of words seen once
    rare_types: int
    tail_tokens: int  # of words seen twice or more that aren't held
    tail_types: int
    last: tuple[int, str] | None  # count and word of the last held, if there may be others

    @property
    def base_scale(self) -> float:
        return float(np.log10(self.tokens + self.types + 1))


def in_tail(last: tuple[int, str] | None) -> Column:
    """Whether a counted word is a symbol that isn't held."""
    if last is None:
        return F.lit(False)
    c, word = last
    return (F.col("c") > 1) & (F.col("word") != END) & ((F.col("c") < c) | ((F.col("c") == c) & (F.col("word") > word)))


def vocabulary(counts: DataFrame, held: int) -> Vocabulary:
    if not 0 < held <= HELD:
        raise ValueError(f"{held} held words; ids have 16 bits, so 1 to {HELD}")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = counts.where((F.col("c") > 1) & (F.col("word") != END)).select("word", "c").orderBy(F.desc("c"), "word").limit(held).toArrow().to_pandas()
    last = (int(top["c"].iloc[-1]), top["word"].iloc[-1]) if len(top) == held else None
    tail = counts.where(in_tail(last)).agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = counts.where(F.col("word") == END).agg(F.sum("c")).first()[0] or 0
    rare = total[0] - ends - tail[0] - (int(top["c"].sum()) if len(top) else 0)
    own = np.concatenate([[rare, ends], top["c"].to_numpy(np.float64)]) if len(top) else np.array([rare, ends], float)
    return Vocabulary(top["word"].tolist(), own.astype(float), total[0], total[1], rare, total[1] - (ends > 0) - len(top) - tail[1], *tail, last)


def encoded(docs: DataFrame, id: str, text: str, known: Vocabulary) -> DataFrame:
    """Lots of texts of like length: ids, tokens of each, symbols of all as 16-bit integers, other words, and which of them each 0 is.

    Training texts and others are in different lots.
    """
    model = docs.sparkSession.sparkContext.broadcast(known.words)
    kind = docs.schema[id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {w.encode(): k + 2 for k, w in enumerate(model.value)}
        open_: dict[tuple[bool, int], list] = {}
        made, task, type_ = 0, TaskContext.get().partitionId() << 32, None

        def closed(key: tuple[bool, int]) -> pa.RecordBatch:
            nonlocal made
            ids, lengths, symbols, others = open_.pop(key)[:4]
            place: dict[bytes, int] = {}
            places = np.fromiter((place.setdefault(w, len(place)) for w in others), np.uint32, len(others))
            made += 1
            row = ([task + made], [key[0]], [ids], [lengths], [b"".join(symbols)], [places.tobytes()])
            types = (pa.int64(), pa.bool_(), pa.list_(type_), pa.list_(pa.int32()), pa.binary(), pa.binary())
            arrays = [pa.array(x, t) for x, t in zip(row, types, strict=True)]
            arrays.insert(5, pa.ListArray.from_arrays(pa.array([0, len(place)], pa.int32()), _strings(place)))
            return pa.record_batch(arrays, names=["lot", "train", "ids", "lengths", "symbols", "words", "places"])

        for b in rows_of(batches):
            type_ = b.column(0).type
            for key, t, train in zip(b.column(0).to_pylist(), strings(b.column(1)), b.column(2).to_pylist(), strict=True):
                own = words_of(t)
                found = np.fromiter(map(index.get, own, repeat(0)), np.uint16, len(own))
                at = (train, next(k for k, (most, _) in enumerate(LOTS) if len(own) < most))
                lot = open_.setdefault(at, [[], [], [], [], 0])
                lot[0].append(key)
                lot[1].append(len(own) + 1)
                lot[2].append(np.append(found, np.uint16(1)).tobytes())
                lot[3] += [own[k] for k in np.flatnonzero(found == 0).tolist()]
                lot[4] += len(own) + 1
                if lot[4] >= LOTS[at[1]][1]:
                    yield closed(at)
        for at in list(open_):
            yield closed(at)

    schema = f"lot long, train boolean, ids array<{kind}>, lengths array<int>, symbols binary, words array<string>, places binary"
    return by_batch(docs.select(F.col(id).alias("id"), F.col(text), "train"), work, schema)


@dataclass
class Model:
    first: np.ndarray  # states
    steps: np.ndarray  # states x states
    emits: np.ndarray  # symbols x states
    tail: np.ndarray | None = None  # 2 x states: a word that isn't held emits its expected count x tail[0] + (c + 1) x tail[1]


class Sequences:
    """Texts side by side, by time: the symbols of all texts at step t stand together, longest texts first."""

    def __init__(self, lengths: np.ndarray, symbols: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        ordered = lengths[self.order]
        self.width = int(ordered[0]) if len(ordered) else 0
        self.live = np.searchsorted(-ordered, -np.arange(self.width), side="left")  # texts longer than t
        self.offset = np.concatenate([[0], np.cumsum(self.live)]).astype(np.int64)
        rank = np.empty(len(lengths), np.int64)
        rank[self.order] = np.arange(len(lengths))
        step = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.place = self.offset[step] + np.repeat(rank, lengths)  # of each token in the order by time
        self.symbols = self.by_time(symbols)

    def by_time(self, values: np.ndarray) -> np.ndarray:
        out = np.empty_like(values)
        out[self.place] = values
        return out

    def forward(self, model: Model, tops: np.ndarray, begin: int, end: int, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Emissions and forward variables of the steps from ``begin`` to ``end``, given those before, and by what they were divided.

        Emissions are divided by the symbol's greatest, ``tops``. So a step leaves a good part of a text's probability, and only every
        ``RESCALED``-th needs to be divided by what is left.
        """
        base, at = self.offset[begin], (self.offset[begin : end + 1] - self.offset[begin]).tolist()
        ids = self.symbols[base : self.offset[end]]
        seen = np.take(model.emits, ids, axis=0)
        seen /= tops[ids, None]
        alpha, scale, ones = np.empty_like(seen), np.ones(len(seen)), np.ones(len(model.first))
        for t, a, z in zip(range(begin, end), at, at[1:]):
            now, m = alpha[a:z], z - a
            if before is None:
                np.multiply(model.first, seen[a:z], out=now)
            else:
                if t % RESCALED == 0:
                    scale[a:z] = total = before[:m] @ ones
                    before = before[:m] / total[:, None]
                np.matmul(before[:m], model.steps, out=now)
                np.multiply(now, seen[a:z], out=now)
            before = now
        return seen, alpha, scale

    def ends(self, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The texts that end within these steps, and the places of their last tokens since ``begin``."""
        after = int(self.live[end]) if end < self.width else 0
        texts = np.arange(after, int(self.live[begin]))
        last = len(self.live) - np.searchsorted(self.live[::-1], texts, side="right") - 1
        return texts, self.offset[last] + texts - self.offset[begin]


def _tops(model: Model) -> np.ndarray:
    top = model.emits.max(axis=1)
    return np.where(top > 0, top, 1.0)


def forward(lengths: np.ndarray, symbols: np.ndarray, model: Model) -> np.ndarray:
    """log10 probability of each sequence, by the scaled forward recursion."""
    s, tops = Sequences(lengths, symbols), _tops(model)
    total, before = np.zeros(len(lengths)), None
    for begin in range(0, s.width, BLOCK):
        end = min(begin + BLOCK, s.width)
        _, alpha, scale = s.forward(model, tops, begin, end, before)
        for t in range(-(-begin // RESCALED) * RESCALED, end, RESCALED):
            total[: s.live[t]] += np.log10(scale[s.offset[t] - s.offset[begin] : s.offset[t + 1] - s.offset[begin]])
        texts, last = s.ends(begin, end)
        total[texts] += np.log10(alpha[last].sum(axis=1))
        before = alpha[s.offset[end - 1] - s.offset[begin] :].copy()
    out = np.empty(len(lengths))
    out[s.order] = total
    return out + np.add.reduceat(np.log10(tops)[symbols], np.cumsum(lengths) - lengths) if len(lengths) else out


def expected(lengths: np.ndarray, symbols: np.ndarray, model: Model, other: np.ndarray | None = None, others: int = 0) -> tuple[np.ndarray, ...]:
    """Expected counts of first states, steps and emissions of whole sequences, the sum of their log10 probabilities, and expected counts of ``others`` words (``other``: number of each token's, or -1).

    The forward recursion keeps its variables at the edges of blocks; the backward recursion goes
    from block to block and has the forward variables of each computed again, but for the last.
    The loops over steps hold the recursions alone; sums are taken of many steps at once.
    """
    k, (n, s), tops = len(model.first), (len(model.emits), Sequences(lengths, symbols)), _tops(model)
    steps, emits, rest, logs = np.zeros((k, k)), np.zeros((n, k)), np.zeros((others, k)), float(np.log10(tops)[symbols].sum())
    first, edges, before, found = np.zeros(k), [], None, None
    begins = range(0, s.width, BLOCK)
    for begin in begins:
        edges.append(before)
        end = min(begin + BLOCK, s.width)
        found = None  # the last block's goes before the next comes
        found = s.forward(model, tops, begin, end, before)
        logs += float(np.log10(found[2]).sum() + np.log10(found[1][s.ends(begin, end)[1]].sum(axis=1)).sum())
        before = found[1][s.offset[end - 1] - s.offset[begin] :].copy()
    marked = None if other is None else s.by_time(other)
    ones, back_steps = np.ones(k), np.ascontiguousarray(model.steps.T)
    ahead = np.ones((len(lengths), k))  # backward variables of the texts that go on behind a block
    for begin, edge in zip(reversed(begins), reversed(edges), strict=True):
        end, base = min(begin + BLOCK, s.width), s.offset[begin]
        back, alpha, scale = found or s.forward(model, tops, begin, end, edge)
        found = None
        at = (s.offset[begin : end + 1] - base).tolist()
        beta = np.ones_like(alpha)
        beta[at[-2] :] = ahead[: at[-1] - at[-2]]
        for t in range(end - 1, begin - 1, -1):
            a, z = at[t - begin], at[t - begin + 1]
            now = back[a:z]
            np.multiply(now, beta[a:z], out=now)
            if t > begin:
                to = beta[at[t - begin - 1] :][: z - a]
                np.matmul(now, back_steps, out=to)
                if t % RESCALED == 0:
                    to /= (to @ ones)[:, None]
            elif t:
                to = now @ back_steps
                ahead[: z - a] = to / (to @ ones)[:, None]
        live = np.diff(at)
        before = np.arange(at[-1]) - np.repeat(np.concatenate([live[:1], live[:-1]]), live)  # the same text's token before, if in the block
        if not begin:
            shares = alpha[: at[1]] * beta[: at[1]]
            first += (shares / (shares @ ones)[:, None]).sum(axis=0)
        pieces = []
        for a in range(0, at[-1], _AT_ONCE):
            z = min(a + _AT_ONCE, at[-1])
            shares = alpha[a:z] * beta[a:z]
            weight = 1 / (shares @ ones)
            shares *= weight[:, None]
            pieces.append(beta[a:z].reshape(k, z - a))  # these are over; the shares take their place, by state
            pieces[-1][:] = shares.T
            back[a:z] *= (weight / scale[a:z])[:, None]
            if (b := max(a, at[1])) < z:
                steps += np.take(alpha, before[b:z], axis=0).T @ back[b:z]
        if edge is not None:
            steps += edge[: at[1]].T @ back[: at[1]]
        ids = s.symbols[base : s.offset[end]]
        numbers = None if marked is None else marked[base : s.offset[end]]
        mine = None if marked is None else np.flatnonzero(numbers >= 0)
        for j in range(k):
            shares = np.concatenate([x[j] for x in pieces])
            emits[:, j] += np.bincount(ids, shares, minlength=n)
            if mine is not None:
                rest[:, j] += np.bincount(numbers[mine], shares[mine], minlength=others)
    return first, steps * model.steps, emits, np.array(logs), rest


def _chain(first: np.ndarray, steps: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First states and steps from their expected counts; every one is possible."""
    steps = steps + 0.1 + 1e-3 * steps.sum(axis=1, keepdims=True) / len(first)
    share = (mass + 1) / (mass + 1).sum()
    return (first + share) / (first + share).sum(), steps / steps.sum(axis=1, keepdims=True)


def tied(first: np.ndarray, steps: np.ndarray, emits: np.ndarray, known: Vocabulary) -> Model:
    """The model of the expected counts in which all words that aren't held have the same emission in each state."""
    emits = emits.copy()
    emits[0] = 0
    mass, prior = emits.sum(axis=0), known.counts + 1
    smooth = SMOOTHING * np.maximum(mass, 1)
    own = (emits + np.outer(prior / prior[1:].sum(), smooth)) / (mass + smooth)
    own[0] = 1  # whatever is the same in all states cancels
    return Model(*_chain(first, steps, mass), own)


def untied(first: np.ndarray, steps: np.ndarray, emits: np.ndarray, rare: np.ndarray, tail_mass: np.ndarray, known: Vocabulary) -> Model:
    """The model of the expected counts with emissions for every symbol; ``rare``: of the words seen once, together."""
    emits = emits.copy()
    emits[0] = rare
    every = (known.counts + 1).sum() + known.tail_tokens + known.tail_types
    mass = emits.sum(axis=0) + tail_mass
    smooth = SMOOTHING * np.maximum(mass, 1)
    tail = np.stack([1 / (mass + smooth), smooth / (mass + smooth) / every])
    own = emits * tail[0] + (known.counts[:, None] + 1) * tail[1]
    return Model(*_chain(first, steps, mass), own, tail)


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Lengths, symbols, other words (or their number) and their places of each lot in (lengths, symbols, words, places)."""
    for b in batches:
        for k in range(b.num_rows):
            lengths, symbols, words, places = (b.column(j)[k] for j in range(4))
            yield lengths.values.to_numpy().astype(np.int64), _numbers(symbols, np.uint16), words.values if isinstance(words, pa.ListScalar) else words.as_py(), _numbers(places, np.uint32)


def _numbers(value: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(value.as_py(), kind).astype(np.int64)


def _units(a: np.ndarray) -> list[pa.Array]:
    """A column of whole multiples of 1 / UNIT for each state."""
    return [pa.array(x) for x in np.rint(a.T * UNIT).astype(np.int64)]


def _columns(states: int) -> list[str]:
    return [f"s{k}" for k in range(states)]


def _keyed(a: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(a.any(axis=1))
    return pa.record_batch([pa.array(at), *_units(a[at])], names=["key", *_columns(a.shape[1])])


def _gathered(rows: DataFrame, keys: int, states: int) -> np.ndarray:
    """Vectors by key, summed over all tasks: (keys x states)."""
    with settings(rows.sparkSession, ARROW):
        got = rows.groupBy("key").agg(*[F.sum(c).alias(c) for c in _columns(states)]).toArrow()
    out = np.zeros((keys, states))
    if got.num_rows:
        out[got["key"].to_numpy()] = np.stack([got[c].to_numpy() for c in _columns(states)], axis=1) / UNIT
    return out


def _schema(states: int, key: str = "key long") -> str:
    return key + "".join(f", {c} long" for c in _columns(states))


def seeded(rows: DataFrame, known: Vocabulary, states: int) -> Model:
    """A first model: the most frequent words, clustered by the frequent words next to them, seed the states."""
    size, near = min(SEEDED, len(known.counts)), min(NEIGHBOURS, len(known.counts))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((size, 2 * near))
        for b in batches:
            for x in b.column(0).to_pylist():
                d = np.frombuffer(x, np.uint16).astype(np.int64)
                a, z = d[:-1], d[1:]
                for word, next_, shift in ((a, z, near), (z, a, 0)):
                    ok = (a != 1) & (word > 0) & (next_ > 0) & (word < size) & (next_ < near)  # a text ends behind 1
                    found += np.bincount(word[ok] * 2 * near + next_[ok] + shift, minlength=found.size).reshape(found.shape)
        yield _keyed(found)

    around = _gathered(by_batch(rows.select("symbols"), work, _schema(2 * near)), size, 2 * near)
    profile = np.sqrt(around)
    profile /= np.maximum(np.linalg.norm(profile, axis=1, keepdims=True), 1e-9)
    weight = known.counts[:size].copy()
    weight[0] = 0
    centres = profile[[int(np.argmax(weight))]]
    while len(centres) < states:  # the word farthest from all centres, by the root of its count
        gap = (1 - (profile @ centres.T).max(axis=1)).clip(0) * np.sqrt(weight)
        centres = np.vstack([centres, profile[int(np.argmax(gap))]])
    for _ in range(20):
        nearest = (profile @ centres.T).argmax(axis=1)
        for s in range(states):
            if (nearest == s).any():
                c = (profile[nearest == s] * np.sqrt(weight[nearest == s])[:, None]).sum(axis=0)
                centres[s] = c / max(np.linalg.norm(c), 1e-9)
    split = np.full((len(known.counts), states), 1.0 / states)
    split[:size] = 0.1 / states
    split[np.arange(size), nearest] += 0.9
    emits = known.counts[:, None] * split
    mass = emits[1:].sum(axis=0)
    return tied(mass, np.outer(mass, mass) / max(mass.sum(), 1), emits, known)


def _tidy(spark: SparkSession) -> None:
    """Lets Spark delete the shuffles that nothing refers to any more; each round has its own."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _counted(rows: DataFrame, model: Model, last: bool) -> DataFrame:
    """Expected counts of each task by key: symbols, then steps, first states, and log10 probability; with ``last`` of other words (``word``, tokens ``n``) instead of a key."""
    k, symbols = len(model.first), len(model.emits)
    now = rows.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((symbols + k + 2, k))
        for lengths, ids, words, places in _lots(batches):
            other = np.full(len(ids), -1, np.int64)
            other[ids == 0] = places
            first, steps, emits, logs, rest = expected(lengths, ids, now.value, other if last else None, len(words) if last else 0)
            sums[:symbols] += emits
            sums[symbols : symbols + k] += steps
            sums[-2] += first
            sums[-1, 0] += logs
            if last and len(words):
                times = np.bincount(places, minlength=len(words))
                yield pa.record_batch([pa.nulls(len(words), pa.int64()), *_units(rest), words, pa.array(times)], names=["key", *_columns(k), "word", "n"])
        if last:
            b = _keyed(sums)
            yield pa.record_batch([*b.columns, pa.nulls(b.num_rows, pa.string()), pa.nulls(b.num_rows, pa.int64())], names=[*b.schema.names, "word", "n"])
        else:
            yield _keyed(sums)

    return by_batch(rows.select("lengths", "symbols", "words", "places"), work, _schema(k) + ", word string, n long" * last)


def _shares(states: int) -> list[Column]:
    """Expected counts as shares of 16 bits, four to a 64-bit number."""
    total = F.greatest(sum((F.col(c) for c in _columns(states)), F.lit(0)), F.lit(1))
    share = [F.round(F.col(c) * 65535 / total).cast("long") for c in _columns(states)]
    return [sum((F.shiftleft(x, 16 * j) for j, x in enumerate(share[a : a + 4])), F.lit(0).cast("long")).alias(f"e{a // 4}") for a in range(0, states, 4)]


def _unpacked(numbers: np.ndarray, states: int) -> np.ndarray:
    """Shares of the states, which add up to 1 in each row, from numbers (n x states / 4)."""
    found = np.ascontiguousarray(numbers).astype("<i8").view("<u2").reshape(len(numbers), -1)[:, :states].astype(float)
    return found / np.maximum(found.sum(axis=1, keepdims=True), 1)


def train(rows: DataFrame, known: Vocabulary, states: int = STATES, rounds: int = ROUNDS, gain: float = GAIN) -> tuple[Model, DataFrame]:
    """Baum-Welch over the training lots ``rows``: the model, and (word, c, e0, ...) of the words that aren't held."""
    model, symbols, spark, before = seeded(rows, known, states), len(known.counts), rows.sparkSession, None
    for _ in range(rounds - 1):
        got = _gathered(_counted(rows, model, False), symbols + states + 2, states)
        _tidy(spark)
        logs = got[-1, 0] / max(known.tokens, 1)
        if before is not None and logs - before < gain:
            break
        before = logs
        model = tied(got[-2], got[symbols:-2], got[:symbols], known)
    sums = [F.sum(c).alias(c) for c in _columns(states)]
    summed = _counted(rows, model, True).groupBy("key", "word").agg(F.sum("n").alias("c"), *sums)
    own = F.col("key").isNotNull() | (F.col("c") == 1)  # of all others the shares are enough
    last = staged(summed.select("key", "word", "c", *[F.when(own, F.col(c)).alias(c) for c in _columns(states)], *[F.when(F.col("c") > 1, x).alias(f"e{j}") for j, x in enumerate(_shares(states))]), "expected")
    _tidy(spark)
    got = _gathered(last.where("key is not null"), symbols + states + 2, states)
    emitted = last.where("word is not null").select("word", "c", *[f"e{j}" for j in range(-(-states // 4))])
    once = last.where("word is not null and c = 1").agg(*sums).first()
    rare = np.array([x or 0 for x in once], float) / UNIT
    packed = [F.col(f"e{j}") for j in range(-(-states // 4))]
    part = lambda k: F.shiftrightunsigned(packed[k // 4], 16 * (k % 4)).bitwiseAND(F.lit(65535)).cast("double")
    total = F.greatest(sum((part(k) for k in range(states)), F.lit(0.0)), F.lit(1.0))
    mass = emitted.where("c > 1").agg(*[F.sum(F.col("c") * part(k) / total) for k in range(states)]).first()
    return untied(got[-2], got[symbols:-2], got[:symbols], rare, np.array([x or 0 for x in mass], float), known), emitted


@operator
def scored(
    docs: DataFrame, id: str = "doc_id", text: str = "text", train_on: Column | None = None, *,
    states: int = STATES, held: int = HELD, rounds: int = ROUNDS, gain: float = GAIN,
) -> DataFrame:
    """(id, train, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end; null text is empty.
    The model learns from the whole texts for which ``train_on`` holds (all, if None), in ``rounds``
    of Baum-Welch at most, which end when a token's mean log10 probability gains less than ``gain``.
    Every word seen twice or more is a symbol. The ``held`` most frequent are re-estimated in each
    round, the others in the last; their expected counts are shares of 16 bits. States start from
    clusters of the ``SEEDED`` most frequent words by their ``NEIGHBOURS`` most frequent neighbours.
    ``base_score`` is the sum of log10((c + 1) / (N + V + 1)), with a token's count c, the number
    of tokens N and of different ones V in training; ``score`` is the hidden Markov model's log10
    probability of the text. Without training texts both still are finite. A repeated row counts
    and is scored again. Other columns are ignored. An empty table gives an empty one.
    """
    trains = F.coalesce(train_on, F.lit(False)) if train_on is not None else F.lit(True)
    own = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), trains.alias("train"))
    counts = staged(word_counts(own.where("train"), "text"), "word-counts")
    known = vocabulary(counts, held)
    finished(counts)
    rows = staged(encoded(own, "id", "text", known), "lots")
    _tidy(docs.sparkSession)
    model, emitted = train(rows.where("train"), known, states, rounds, gain)
    _tidy(docs.sparkSession)

    parts = [f"e{j}" for j in range(-(-states // 4))]
    others = rows.select("lot", F.posexplode("words").alias("at", "word")).join(emitted, "word").select(F.col("lot").alias("of"), "at", "c", *parts)
    now = docs.sparkSession.sparkContext.broadcast((model, known.counts))
    inside = float(np.log10(known.rare_tokens + known.rare_types + 1))
    kind = docs.schema[id].dataType.simpleString()

    def work(lot: pa.Table, met: pa.Table) -> pa.Table:
        working_for(__name__)
        model, counts = now.value
        logs, made = np.log10(counts + 1), []
        for b in lot.to_batches():
            for k, (lengths, ids, words, places) in enumerate(_lots([b.select(["lengths", "symbols", "words", "places"])])):
                c, shares = np.zeros(words, np.int64), np.zeros((words, states))
                if met.num_rows:
                    at = met["at"].to_numpy()
                    c[at] = met["c"].to_numpy()
                    shares[at] = _unpacked(np.stack([met[x].fill_null(0).to_numpy() for x in parts], axis=1), states)
                common = np.flatnonzero(c > 1)
                number = np.zeros(words, np.int64)
                number[common] = len(model.emits) + np.arange(len(common))
                emits = model.emits
                if len(common):
                    emits = np.vstack([emits, c[common, None] * (shares[common] * model.tail[0]) + (c[common, None] + 1) * model.tail[1]])
                other = ids == 0
                token_c = np.where(other, 0, counts[ids])
                token_log = np.where(other, 0, logs[ids])
                token_c[other] = c[places]
                token_log[other] = np.log10(c[places] + 1)
                within = np.zeros(len(ids))
                within[other] = np.where(c[places] > 1, 0, token_log[other] - inside)
                ids = ids.copy()
                ids[other] = number[places]
                starts = np.cumsum(lengths) - lengths
                score = forward(lengths, ids, Model(model.first, model.steps, emits)) + np.add.reduceat(within, starts)
                n_known = np.add.reduceat((token_c > 0).astype(np.int64), starts)
                base = np.add.reduceat(token_log, starts) - lengths * known.base_scale
                arrays = [b.column("ids")[k].values, pa.array([b.column("train")[k].as_py()] * len(lengths)), pa.array(lengths), pa.array(n_known), pa.array(base), pa.array(score)]
                made.append(pa.record_batch(arrays, names=["id", "train", "n_tokens", "n_known", "base_score", "score"]))
        give_back()
        return pa.Table.from_batches(made)

    spark = docs.sparkSession
    # the words' partitions are hashed, not sorted, where all of them are small
    with settings(spark, {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")}):
        lots = rows.withColumn("words", F.size("words"))  # the words themselves stay behind
        found = lots.groupBy("lot").cogroup(others.groupBy("of")).applyInArrow(work, f"id {kind}, train boolean, n_tokens long, n_known long, base_score double, score double")
        return staged(found.select(F.col("id").alias(id), "train", "n_tokens", "n_known", F.lit(known.tokens).cast("long").alias("train_tokens"), "base_score", "score"), "scored")
