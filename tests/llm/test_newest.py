"""Positional index, group dictionary and periodic runs against plain re-computations."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanframe.llm import alignment, postings, tandem

sha = lambda x: hashlib.sha256(x.encode()).hexdigest()


def rows(df):
    return [r.asDict() for r in df.collect()]


# positional index

def lowered(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def contaminated_brute(docs, items, width=10):
    out = []
    for doc, text in docs:
        w, hit, ids = lowered(text), set(), set()
        for item, passage in items:
            v = lowered(passage)
            n = min(width, len(v))
            windows = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if v else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    ids |= {str(item)} - {"None"}
        out.append((doc, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return out


def made_up(seed, docs=60, items=25, words=30):
    rng = random.Random(seed)
    some = lambda n: " ".join(rng.choice(("W%d", "w%d", "ä%d")) % min(int(rng.expovariate(0.25)), words) for _ in range(n))
    bench = [(k, some(rng.choice((1, 2, 3, 5, 9, 10, 11, 14, 30)))) for k in range(items)]
    texts = []
    for k in range(docs):
        parts = [some(rng.randint(0, 30)) for _ in range(3)]
        if rng.random() < 0.6:
            passage = rng.choice(bench)[1].split(" ")
            a = rng.randrange(len(passage))
            parts.insert(rng.randrange(3), " ".join(passage[a : a + rng.randint(1, 30)]))
        texts.append((k, rng.choice((" ", ", ", "-\n")).join(parts)))
    return texts, bench


@pytest.mark.parametrize("seed", range(3))
def test_contaminated_is_brute_force(spark, seed):
    docs, bench = made_up(seed)
    docs += [(100, None), (101, ""), (102, "!?"), (103, bench[8][1]), (103, bench[8][1]), (104, (bench[3][1] + " ") * 800)]
    bench += [(90, None), (91, ""), (92, "-"), (7, bench[7][1]), (93, "never seen words at all here " * 3), (None, bench[2][1])]
    d = spark.createDataFrame([(*x, 1, 2, 3) for x in docs], "doc_id long, text string, row int, pos int, term int").repartition(3)
    b = spark.createDataFrame([(*x, 1) for x in bench], "item_id long, text string, words int")
    got = rows(postings.contaminated(d, b))
    assert sorted(tuple(r.values()) for r in got) == sorted(contaminated_brute(docs, bench))


def test_contaminated_without_rows(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert postings.contaminated(d.limit(0), b).count() == 0
    assert [r["n_hit"] for r in rows(postings.contaminated(d, b.limit(0)))] == [0]
    assert [r["n_hit"] for r in rows(postings.contaminated(d, b))] == [2]


def test_proximity_is_brute_force(spark):
    docs, bench = made_up(5, items=15)
    docs += [(100, None), (101, ""), (102, "x " * 2000 + "y")]
    bench = [(k, " ".join(x.split(" ")[:3])) for k, x in bench] + [(70, None), (71, "x y"), (72, "nowhere")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = []
    for doc, text in docs:
        w = lowered(text)
        for item, q in bench:
            need = set(lowered(q))
            for k in range(len(w)):
                ahead = w[k : k + 6]
                if need and w[k] in need and need <= set(ahead):
                    want.append((doc, item, k, k + max(ahead.index(x) for x in need)))
    got = postings.proximity(d, spark.createDataFrame(bench, "item_id long, text string"), 6)
    assert len(want) > 20 and sorted(tuple(r) for r in got.collect()) == sorted(want)


# group dictionary

JSON, PIECES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def groups_brute(text):
    import sentencepiece
    from tokenizers import Tokenizer

    if not text:
        return []
    t, s = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    t.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    a = [(x, bytes(letters[c] for c in t.id_to_token(x))) for x in t.encode(" " + text, add_special_tokens=False).ids]
    b = [(x, bytes([int(s.id_to_piece(x)[3:5], 16)]) if s.is_byte(x) else s.id_to_piece(x).replace("▁", " ").encode()) for x in s.encode(text)]
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return []
    ends = lambda tokens: np.cumsum([len(x) for _, x in tokens]).tolist()
    cuts = sorted(set(ends(a)) & set(ends(b)))
    out, at = [], 0
    for z in cuts:
        out.append(tuple([x for (x, _), e in zip(tokens, ends(tokens), strict=True) if at < e <= z] for tokens in (a, b)))
        at = z
    return out


def linked_brute(docs):
    per = [(doc, groups_brute(text)) for doc, text in docs]
    held = Counter(p for _, gs in per for p in {(x, y) for a, b in gs for x in a for y in b})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for doc, gs in per:
        links = [(x, y) for a, b in gs for x in a for y in b]
        key = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in gs)
        best = sum(held[p] == most[p[0]] for p in links)
        out.append((doc, sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), len(links), best, sum(held[p] for p in links), sha(key) if gs else ""))
    return out


ODD = [
    None, "", " ", "  ", "\n", "a  b   c", "tab\tand\nlines \n end ", "<s> </s> <unk> <|endoftext|> <0x41>", "▁under▁line", "Straße œuvre ﬁ ﬂ ½ ①", "日本語のテキスト 中文",
    "😀😀 a😀b", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "1234567890 3.14159", "\x00nul", "café café", "ab ab ab", " nbsp  em", "x" * 3000, "the and the and " * 300, "न्यायालय हिन्दी",
]


def test_linked_tokens_is_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    words = [*"the of and tion ing under line Straße 日本 12 3.4 end. “x” aaaa".split(" "), "a\nb", "\tq", "", "▁"]
    texts = [*ODD, *(" ".join(rng.choices(words, k=rng.randint(1, 25))) for _ in range(60))]
    docs = [*enumerate(texts), (5, texts[5]), (5, texts[5])]
    d = spark.createDataFrame([(*x, 1, "k") for x in docs], "doc_id long, text string, key int, chunk string").repartition(3)
    want = sorted(linked_brute(docs))
    for size in (alignment.CHUNK, 0):
        monkeypatch.setattr(alignment, "CHUNK", size)
        got = rows(alignment.linked_tokens(d, JSON, PIECES))
        assert sorted(tuple(r.values()) for r in got) == want
    assert sum(x[1] == 0 for x in want) >= 4 and sum(x[3] > 2 for x in want) > 30
    assert alignment.linked_tokens(d.limit(0), JSON, PIECES).count() == 0


# periodic runs

def runs_brute(w, least, exponent):
    out, n = [], len(w)
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            length = j + p - i
            if j > i and length >= max(least, exponent * p) and not any(all(w[t] == w[t + q] for t in range(i, i + length - q)) for q in range(1, p)):
                out.append((i, length, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), max_size=30), st.integers(0, 29), st.integers(1, 9)), min_size=1, max_size=4))
def test_runs_are_brute_force(made):
    texts = [[w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))] if w and a + p <= len(w) else w for w, a, p in made]
    symbols, offsets = [], []
    for k, w in enumerate(texts):
        offsets.append(len(symbols))
        symbols += [*(5 * k + x for x in w), 5 * k + 4]
    for least, exponent in ((2, 2), (6, 4), (3, 3)):
        got = tandem.runs(np.array(symbols), least, exponent)
        want = [(o + s, n, p) for o, w in zip(offsets, texts, strict=True) for s, n, p in runs_brute(w, least, exponent)]
        assert list(zip(*(x.tolist() for x in got), strict=True)) == want


def described_brute(doc, text, planted):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc).encode())
    g = h // 10
    if planted and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = runs_brute(w, 6, 4)
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{m},{p}\n" for s, m, p in found)), hashlib.sha256(kept).hexdigest(), n, len(gone))


def test_periodic_runs_are_brute_force(spark):
    rng = random.Random(9)
    texts = [None, "", "  \n ", "one", "a " * 6, "a " * 5, "a b " * 4, "a b " * 3 + "a", "x " + "p q r " * 5 + "y y y y y y y", "  é é é é é é", "la\x0bla\x0cla la la la la"]
    texts += [" ".join(rng.choices("ab", k=rng.randint(1, 60))) for _ in range(60)] + [" ".join(rng.choices([str(k) for k in range(9)], k=rng.randint(1, 120))) for _ in range(120)]
    texts.append("q " * 4000 + "z " + "u v " * 2000)
    docs = [*enumerate(texts), (4, texts[4]), (-7, "a " * 9)]
    d = spark.createDataFrame([(*x, 1, "k") for x in docs], "doc_id long, text string, start int, period string").repartition(3)
    for rewrite, planted in ((tandem.with_planted_runs, True), (tandem._as_is, False)):
        got = rows(tandem.periodic_runs(d, rewrite=rewrite))
        key = lambda r: (r[0], str(r))
        short = [x for x in docs if len(x[1] or "") < 5000]
        want = sorted((described_brute(*x, planted) for x in short), key=key)
        assert sorted((tuple(r.values()) for r in got if r["n_words"] < 2000), key=key) == want
        long = next(r for r in got if r["n_words"] > 7000)
        if not planted or zlib.crc32(str(long["doc_id"]).encode()) % 10:
            assert (long["n_runs"], long["start"], long["length"], long["period"]) == (2, 0, 4000, 1)
    assert tandem.periodic_runs(d.limit(0)).count() == 0
    assert tandem.periodic_runs(spark.createDataFrame([(None, "a " * 8)], "doc_id long, text string")).first()["n_runs"] == 1


def test_linked_tokens_chunks_are_in_small_row_groups(spark, monkeypatch):
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    most = {}
    plain = alignment.staged

    def seen(df, name, *more, **named):
        if name in ("chunks", "back"):  # as many large rows in one task as a large table gives
            many = df.select("*", F.explode(F.sequence(F.lit(1), F.lit(60))).alias("_r")).drop("_r").coalesce(1)
            files = glob.glob(plain(many, name, *more, **named)._staged_at.removeprefix("file://") + "/*.parquet")
            groups = [pq.ParquetFile(f).metadata for f in files]
            most[name] = max(m.row_group(k).num_rows for m in groups for k in range(m.num_row_groups))
        return plain(df, name, *more, **named)

    monkeypatch.setattr(alignment, "staged", seen)
    docs = spark.createDataFrame([(k, f"some words of text {k}") for k in range(60)], "doc_id long, text string")
    assert alignment.linked_tokens(docs, JSON, PIECES).count() == 60
    assert set(most) == {"chunks", "back"} and max(most.values()) <= 4
