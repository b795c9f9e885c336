"""Whole operators and the pipeline against plain re-computations of their definitions."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from gleanframe.llm import fertility, hmm, hyperlang, tokens
from gleanframe.llm.common import crc_fold

from .test_llm import base_brute, near_brute


def sampled(seed, n, size=60, langs=("en",)):
    """Texts of made-up words by Zipf's law, a vocabulary a language."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        lang = langs[k % len(langs)]
        parts = {"en": ["the", "ing", "and", "ther", "ould", "was"], "de": ["der", "sch", "ung", "ein", "ben", "icht"]}[lang]
        words = ["".join(random.Random(f"{lang}{j}").choices(parts, k=1 + j % 3)) + ("" if j < 40 else str(j)) for j in range(200)]
        out.append((k, " ".join(rng.choices(words, [1 / (j + 1) for j in range(200)], k=rng.randint(size // 2, size * 2))), lang))
    return out


# hidden Markov model

def test_forward_is_the_sum_over_paths():
    rng = np.random.default_rng(0)
    norm = lambda a, axis: a / a.sum(axis=axis, keepdims=True)
    m = hmm.Model(norm(rng.random(3), 0), norm(rng.random((3, 3)), 1), norm(rng.random((5, 3)), 0))
    docs = [np.array(x) for x in ([1], [0, 2, 4, 1], [3, 3, 1], [2, 0, 1, 1, 3, 4, 0, 1])]
    lengths, flat = np.array([len(d) for d in docs]), np.concatenate(docs)
    totals, gammas, moves = [], [], np.zeros((3, 3))
    for d in docs:
        total, gamma, move = 0.0, np.zeros((len(d), 3)), np.zeros((3, 3))
        for path in np.ndindex(*(3,) * len(d)):
            p = m.first[path[0]] * m.emits[d[0], path[0]]
            for t in range(1, len(d)):
                p *= m.steps[path[t - 1], path[t]] * m.emits[d[t], path[t]]
            total += p
            for t, s in enumerate(path):
                gamma[t, s] += p
                if t:
                    move[path[t - 1], s] += p
        totals.append(math.log10(total))
        gammas.append(gamma / total)
        moves += move / total
    emits, other, rest = np.zeros((5, 3)), np.where(flat == 0, np.arange(len(flat)) % 2, -1), np.zeros((2, 3))
    np.add.at(emits, flat, np.concatenate(gammas))
    np.add.at(rest, other[flat == 0], np.concatenate(gammas)[flat == 0])
    for block in (1, 2, 3, 2048):  # edges of blocks lose nothing
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(hmm, "BLOCK", block)
            assert np.allclose(hmm.forward(lengths, flat, m), totals)
            got = hmm.expected(lengths, flat, m, other, 2)
        for x, y in zip(got, (sum(g[0] for g in gammas), moves, emits, sum(totals), rest), strict=True):
            assert np.allclose(x, y)


def dense(ids, m):
    """Posteriors, expected steps and log10 probability of one text by the plain recursions."""
    n, k = len(ids), len(m.first)
    alpha, beta, scale = np.zeros((n, k)), np.ones((n, k)), np.zeros(n)
    for t in range(n):
        now = (m.first if not t else alpha[t - 1] @ m.steps) * m.emits[ids[t]]
        scale[t] = now.sum()
        alpha[t] = now / scale[t]
    for t in range(n - 2, -1, -1):
        beta[t] = m.steps @ (m.emits[ids[t + 1]] * beta[t + 1]) / scale[t + 1]
    move = sum((np.outer(alpha[t], m.emits[ids[t + 1]] * beta[t + 1] / scale[t + 1]) * m.steps for t in range(n - 1)), np.zeros((k, k)))
    return alpha * beta, move, np.log10(scale).sum()


@pytest.mark.parametrize("held", [hmm.HELD, 25])
def test_training_and_scores(spark, held):
    made = [*(t for _, t, _ in sampled(3, 60)), "once only here", None, "", "word " * 3000, "zug bahn zug", "zug bahn"]
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(3)
    states, rounds = 3, 3
    got = {r.doc_id: r for r in hmm.scored(df, train_on=crc_fold("doc_id", 7) != 2, states=states, rounds=rounds, held=held, gain=-1.0).collect()}

    words = {k: [*(t or "").encode().lower().split(), None] for k, t in enumerate(made)}
    train = [k for k in words if zlib.crc32(str(k).encode()) % 7 != 2]
    counts = Counter(w for k in train for w in words[k])
    n, v = sum(counts.values()), len(counts)
    top = sorted((w for w in counts if w and counts[w] > 1), key=lambda w: (-counts[w], w))[:held]
    index = {None: 1} | {w: j + 2 for j, w in enumerate(top)}
    tail = sorted(w for w in counts if w and counts[w] > 1 and w not in index)
    once = [w for w in counts if w and counts[w] == 1]
    known = np.array([len(once), counts[None], *(counts[w] for w in top)], float)

    table = hmm.word_counts(df.where(crc_fold("doc_id", 7) != 2), "text")
    vocabulary = hmm.vocabulary(table, held)
    assert (vocabulary.tokens, vocabulary.types, vocabulary.rare_types, vocabulary.tail_types) == (n, v, len(once), len(tail)) and np.array_equal(vocabulary.counts, known)
    rows = hmm.encoded(df.where(crc_fold("doc_id", 7) != 2).withColumn("train", F.lit(True)), "doc_id", "text", vocabulary)
    m = hmm.seeded(rows, vocabulary, states)

    def chain(first, steps, mass):
        steps = steps + 0.1 + 1e-3 * steps.sum(axis=1, keepdims=True) / states
        share = (mass + 1) / (mass + 1).sum()
        return (first + share) / (first + share).sum(), steps / steps.sum(axis=1, keepdims=True)

    for r in range(rounds):
        first, steps, emits, rest = np.zeros(states), np.zeros((states, states)), np.zeros((len(known), states)), {w: np.zeros(states) for w in [*tail, *once]}
        for k in train:
            ids = [index.get(w, 0) for w in words[k]]
            gamma, move, _ = dense(ids, m)
            first, steps = first + gamma[0], steps + move
            for w, g in zip(words[k], gamma, strict=True):
                if w in rest:
                    rest[w] += g
                else:
                    emits[index[w]] += g
        if r + 1 < rounds:
            mass = emits.sum(axis=0)
            smooth = hmm.SMOOTHING * np.maximum(mass, 1)
            own = (emits + np.outer((known + 1) / (known + 1)[1:].sum(), smooth)) / (mass + smooth)
            own[0] = 1
            m = hmm.Model(*chain(first, steps, mass), own)
    emits[0] = sum((rest[w] for w in once), np.zeros(states))
    every = [*known + 1, *(counts[w] + 1 for w in tail)]
    emits = np.vstack([emits, *(rest[w] for w in tail)])
    mass = emits.sum(axis=0)
    smooth = hmm.SMOOTHING * np.maximum(mass, 1)
    own = (emits + np.outer(np.array(every) / sum(every), smooth)) / (mass + smooth)
    assert np.allclose(own.sum(axis=0), 1)
    m = hmm.Model(*chain(first, steps, mass), own)
    index |= {w: len(known) + j for j, w in enumerate(tail)}
    assert len(got) == len(words)
    for k, w in words.items():
        r = got[k]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(counts[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        wanted = dense([index.get(x, 0) for x in w], m)[2] + sum(math.log10((counts[x] + 1) / (2 * len(once) + 1)) for x in w if x not in index)
        assert math.isclose(r.score, wanted, rel_tol=2e-4), k


def test_scores_of_edges(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (2, None, "x"), (3, "a b " * 400, "x")], "doc_id long, text string, word string")
    assert hmm.scored(df.limit(0), states=2).count() == 0
    rows = hmm.scored(df, states=2, rounds=2).collect()
    assert sorted(r.doc_id for r in rows) == [1, 1, 2, 3] and len({r.score for r in rows if r.doc_id == 1}) == 1 and all(r.train_tokens == 808 for r in rows)
    untrained = hmm.scored(df, train_on=F.lit(False), states=2).collect()
    assert len(untrained) == 4 and all(math.isfinite(r.score) and r.n_known == 0 and r.base_score == 0 for r in untrained)
    with pytest.raises(ValueError):
        hmm.scored(df, held=hmm.HELD + 1)


# tokeniser fertility

def bands_brute(rows, least):
    """id -> (base_failed, kept) of (id, text, lang)."""
    encodings = [tiktoken.Encoding(f"v{k}", pat_str=P.PATTERN, mergeable_ranks=tokens.read_ranks(P.path(v)), special_tokens={}) for k, v in enumerate(fertility.VOCABULARIES)]

    def whole(e, i):
        try:
            e.decode_single_token_bytes(i).decode()
        except UnicodeDecodeError:
            return False
        return True

    found = {}
    for key, t, lang in rows:
        t = t or ""
        words, *_, repeated = base_brute(t)
        own = []
        for e in encodings:
            ids = e.encode_ordinary(t)
            n = len(ids)
            entropy = -sum(c / n * math.log2(c / n) for c in Counter(ids).values()) if n else 0.0
            own.append((n, len(t) / n if n else 0.0, sum(not whole(e, i) for i in ids) / n if n else 0.0, entropy))
        found[key] = (words < 20 or 100 * repeated > 30 * words, lang or f"script {fertility.script_of(t)}", f"all, script {fertility.script_of(t)}", own, len(t))

    def band(members):
        different = {(x[4], *(round(v, 9) for m in x[3] for v in m)): x for x in members}.values()
        out, texts = [], len(different)
        for k in range(len(encodings)):
            a, y = np.array([math.log2(x[3][k][0]) for x in different]), np.array([x[3][k][3] for x in different])
            slope = float(((a - a.mean()) * (y - y.mean())).sum() / ((a - a.mean()) ** 2).sum()) if texts > 1 and np.ptp(a) else 0.0
            offset = float(y.mean() - slope * a.mean())
            edges = {}
            for m, values in (("chars_per_token", [x[3][k][1] for x in different]), ("fallback_share", [x[3][k][2] for x in different]), ("spread", list(y - slope * a - offset))):
                width, fences, floor, _ = fertility.BANDED[m]
                bins = sorted(math.floor(x / width) for x in values)
                at = lambda q, bins=bins: bins[math.ceil(texts * q) - 1]
                reach = max((at(0.75) + 1 - at(0.25)) * width * fences, floor)
                edges[m] = (at(0.25) * width - reach, (at(0.75) + 1) * width + reach)
            out.append((slope, offset, edges))
        return texts, out

    sound = [x for x in found.values() if not x[0]]
    verdicts = {}
    for key, (failed, own, script, measured, _) in found.items():
        lots = [[x for x in sound if x[1] == own], [x for x in sound if x[2] == script], sound]
        made = next((b for n, b in map(band, filter(None, lots[:2])) if n >= least), None) or (band(sound)[1] if sound else None)
        kept = not failed
        for (n, per, share, entropy), (slope, offset, edges) in zip(measured, made or [], strict=True):
            noise = {m: fertility.BANDED[m][3] / math.sqrt(max(n, 1)) for m in fertility.BANDED}
            spread = entropy - slope * math.log2(max(n, 1)) - offset
            for m, x in (("chars_per_token", per), ("spread", spread)):
                kept &= edges[m][0] - noise[m] <= x <= edges[m][1] + noise[m]
            kept &= share <= edges["fallback_share"][1] + noise["fallback_share"]
        verdicts[key] = (failed, bool(kept))
    return verdicts


def corpus():
    """Clean texts, junk of several kinds, edge cases, copies and boilerplate."""
    rng = random.Random(11)
    rows = [(k, f"Menu line of {lang}\n{t}", lang if k % 6 else None) for k, t, lang in sampled(5, 150, 70, ("en", "de"))]
    junk = [" ".join("".join(rng.choice("!#xQ7%\u0436") for _ in range(9)) for _ in range(80)) for _ in range(4)]
    junk += ["\u4e00\u9fa5" * 300, "a b c d e f g h i j " * 20, "short", None, "", "123 456 " * 30, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(900))]
    rows += [(1000 + k, t, ("en", None, "xx")[k % 3]) for k, t in enumerate(junk)]
    words = rows[3][1].split(" ")
    rows += [(2000, rows[3][1], "de"), (2001, " ".join([*words[:20], "changed", *words[21:]]), "de"), (2002, rows[4][1].upper(), "en")]
    return rows


def test_bands(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, key string")
    for least in (50, 5):
        got = {r.doc_id: (r.base_failed, r.kept) for r in fertility.judged(df, least_texts=least).collect()}
        assert got == bands_brute(rows, least)
    assert any(not b and not k for b, k in got.values()) and sum(k for _, k in got.values()) > 130


# language profiles and the pipeline

def language_brute(rows):
    """id -> language, of the texts that fit the language found for them."""
    langs = sorted({x for _, t, x in rows if x and len(hyperlang.ngrams([t or ""])[0])})
    vectors = {k: hyperlang.encode(t or "") for k, t, _ in rows}
    grams = {k: Counter(hyperlang.ngrams([t or ""])[0].tolist()) for k, t, _ in rows}
    sums = {x: sum(vectors[k] for k, _, y in rows if y == x) for x in langs}
    peak = {x: (sums[x] ** 2).sum() / hyperlang.DIMENSIONS / sum(sum(grams[k].values()) for k, _, y in rows if y == x) ** 2 for x in langs}
    found = {}
    for k, _, lang in rows:
        n = sum(grams[k].values())
        if n:
            dots = {x: sums[x] @ vectors[k] / np.linalg.norm(sums[x]) for x in langs}
            best = max(langs, key=lambda x: (dots[x], [-ord(c) for c in x]))
            cosine = dots[best] / math.sqrt(sum(c * c for c in grams[k].values()) * hyperlang.DIMENSIONS)
            found[k] = (best, lang, cosine / math.sqrt(n * peak[best] / (1 + n * peak[best])), n)

    def low(fits):
        a, z = np.percentile([math.floor(x * 256) / 256 for x in fits], [25, 75])
        return a - max(3.0 * (z - a), 0.5)

    overall = low([x[2] for x in found.values()])
    lows = {x: low(own) for x in langs if (own := [f for b, y, f, _ in found.values() if b == y == x])}
    return {k: lang or best for k, (best, lang, fit, n) in found.items() if fit >= lows.get(best, overall) - 1 / math.sqrt(n)}


def lines_brute(rows):
    pages, total = Counter(), Counter()
    for _, t, _, host in rows:
        total[host] += 1
        pages.update({(host, x.strip(" \t\r")) for x in t.split("\n")} - {(host, "")})
    out = []
    for k, t, lang, host in rows:
        bad = lambda x, host=host: pages[host, x] >= 5 and pages[host, x] * 100 > total[host] * 10
        kept = [x for x in t.split("\n") if not bad(x.strip(" \t\r"))]
        out.append((k, "\n".join(kept) if any(x.strip(" \t\r") for x in kept) else t, lang, host))
    return out


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rows = [(k, t, lang, "host", len(t or "")) for k, t, lang in corpus()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    docs, stages = spark.read.parquet(str(tmp_path / "documents.parquet")), dict(corpus_pipeline.STAGES)

    judged = bands_brute([r[:3] for r in rows], 50)
    docs = stages["quality"](spark, docs, "")
    assert {r.doc_id for r in docs.collect()} == {k for k, (_, kept) in judged.items() if kept}
    before = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    docs = stages["language"](spark, docs, "")
    assert {r.doc_id: r.lang for r in docs.collect()} == language_brute(before)
    before = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    docs = stages["line_dedup"](spark, docs, "")
    wanted = lines_brute(before)
    assert sorted((r.doc_id, r.text, r.lang, r.source) for r in docs.collect()) == sorted(wanted) and not any("Menu" in t for _, t, _, _ in wanted)
    near = near_brute({k: t for k, t, _, _ in wanted}, 80)
    docs = stages["near_dedup"](spark, docs, "")
    kept = {k for k, (_, c) in near.items() if c == k}
    assert {r.doc_id for r in docs.collect()} == kept and len(kept) < len(near)
    library = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=tokens.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    pieces = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert pieces.keys() == kept
    texts = {k: t for k, t, _, _ in wanted}
    for k, own in pieces.items():
        ids, at = np.array([*library.encode_ordinary(texts[k]), 1], "<u4"), 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)


def test_pipeline_of_repeated_ids_and_edges(spark):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, gone string, kept int, lang_pred string"
    more = ("s", 0, "clash", 7, "clash")
    rows = [(k, t, lang, *more) for k, t, lang in sampled(7, 60, 70, ("en", "de"))]
    rows += [(0, "short", "en", *more), (5, rows[5][1], None, *more), (900, None, None, *more), (900, None, None, *more)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and stage(spark, docs.limit(0), "").count() == 0, name
        docs = out
    ids = Counter(r.doc_id for r in docs.collect())
    assert ids[0] == 2 and ids[5] == 2 and 900 not in ids and set(ids) <= set(range(60))
