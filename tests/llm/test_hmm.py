"""The hidden Markov model's recursions on long texts, and its lots."""

import numpy as np
import pyarrow as pa

from gleanframe.llm import hmm


def test_rare_symbols_between_divisions():
    """Emissions of 1e-200 in states that hardly follow each other: variables are divided every few steps only."""
    rng = np.random.default_rng(3)
    steps = np.array([[1 - 1e-12, 1e-12], [1e-12, 1 - 1e-12]])
    m = hmm.Model(np.array([0.5, 0.5]), steps, np.array([[1e-200, 1e-206], [1e-206, 1e-200], [0.5, 0.5]]))
    lengths = np.array([200, 1, 33, 16])
    symbols = rng.integers(0, 3, lengths.sum())
    want, at = [], 0
    for n in lengths:
        now, total = None, 0.0
        for x in symbols[at : at + n]:
            now = (m.first if now is None else now @ steps) * m.emits[x]
            total += np.log10(now.sum())
            now = now / now.sum()
        want.append(total)
        at += n
    assert np.allclose(hmm.forward(lengths, symbols, m), want, rtol=1e-12)
    first, moves, emits, logs, _ = hmm.expected(lengths, symbols, m)
    assert np.isclose(logs, sum(want), rtol=1e-12)
    assert np.isclose(first.sum(), 4) and np.isclose(moves.sum(), lengths.sum() - 4)
    assert np.allclose(emits.sum(axis=1), np.bincount(symbols, minlength=3))
    _, _, scale = hmm.Sequences(lengths, symbols).forward(m, hmm._tops(m), 0, 200, None)
    assert (scale != 1).sum() <= -(-200 // hmm.RESCALED) * 4  # not every step


def test_words_of_a_lot_stay_in_arrow():
    lot = pa.record_batch([pa.array([[2]], pa.list_(pa.int32())), pa.array([b"\0\0\1\0"]), pa.array([["word"]]), pa.array([b"\0\0\0\0"])], names=["lengths", "symbols", "words", "places"])
    [(lengths, symbols, words, places)] = hmm._lots(iter([lot]))
    assert (lengths.tolist(), symbols.tolist(), places.tolist()) == ([2], [0, 1], [0])
    assert isinstance(words, pa.Array) and words.to_pylist() == ["word"]
