"""The training-data operators against brute force, libraries and edge cases."""

import hashlib
import math
import os
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import public_tokenizers as P
from gleanframe.llm import binids, chunkdedup, common, fertility, hyperlang, linefreq, minhash, packing, segbpe, shingles, tokens, warc
from gleanframe.llm.common import crc_fold
from gleanframe.llm.components import connected_components

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n \n", "a  b", "a   b ", "  x", "\n  bar", "x\xa0 y  z ", "it's  <|endoftext|> ok", "a\n\nb c\n", "日本語 😀😀", "a" * 3000, "=" * 70 + " " * 50, "a\tb\r\n c", "\x1c a  .\x1c b", "x\x85 y"]
SCHEMA = "doc_id long, text string, id string, n int, key string, source string, lang string"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=tokens.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    made = [" ".join(rng.choices(words, k=rng.randint(1, 60))) + rng.choice([".", "\n", "!"]) for _ in range(40)]
    made += [made[0], made[0], made[1] + " more", "long " * 5000, "\n".join(made[:5])]
    return ODD + made


def table(spark, texts):
    rows = [(3 * k + 1, t, "clash", 7, "clash", None if k % 5 == 0 else f"s{k % 2}", "en") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def test_encoders_agree_with_the_library(texts, library):
    plain = [t or "" for t in texts]
    wanted = [library.encode_ordinary(t) for t in plain]
    assert [x.tolist() for x in tokens.json_encoder(JSON)(plain)] == wanted
    assert [x.tolist() for x in segbpe.tree_encoder(RANKS, P.PATTERN)(plain)] == wanted


def test_segment_tree_on_random_bytes(library):
    rng, ranks = random.Random(1), segbpe.rank_table(RANKS)
    pieces = [bytes(rng.choices(b"abe \xc3\xa9" if k % 2 else range(256), k=rng.randint(1, 40))) for k in range(300)]
    assert [x.tolist() for x in segbpe.encode_pieces(pieces, ranks)] == [library._encode_single_piece(p) if hasattr(library, "_encode_single_piece") else library._core_bpe.encode_single_piece(p) for p in pieces]


def test_round_trip_of_empty_and_full_tables(spark, texts, library):
    df = table(spark, texts)
    got = {r.doc_id: r for r in segbpe.round_trip(df, RANKS).collect()}
    for k, t in enumerate(texts):
        r, ids = got[3 * k + 1], library.encode_ordinary(t or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert segbpe.round_trip(df.limit(0), RANKS).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    assert segbpe.round_trip(twice, RANKS).count() == 2


def test_long_pre_tokens(library):
    rng, table_ = random.Random(4), segbpe.rank_table(RANKS)
    for n in (2, 255, 257, 3000):
        piece = bytes(rng.choices(b"abcdefghinst", k=n))
        assert segbpe.merged_alone(piece, table_).tolist() == library._core_bpe.encode_single_piece(piece)
    began = time.monotonic()
    ids = segbpe.encode_pieces([bytes(rng.choices(b"abcdefghijklmnopqrstuvwxyz", k=1 << 18))], table_)[0]
    assert segbpe.decode(ids, table_).isalpha() and time.monotonic() - began < 30


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 1000])
def test_variable_length_code(n):
    rng = np.random.default_rng(n)
    v = (rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
    control, data = binids.pack(v)
    assert binids.unpack(control, data, n).tolist() == v.tolist() and len(control) == -(-n // 4)
    if n:
        with pytest.raises(ValueError):
            binids.unpack(control, data + b"x", n)


def test_id_files(spark, texts, library):
    df = table(spark, texts).repartition(5)
    shards = binids.write_ids(df, JSON)
    got, at = {r.doc_id: r for r in binids.read_ids(shards).collect()}, 0
    for k, t in enumerate(texts):
        ids = [*library.encode_ordinary(t or ""), 0]
        r = got[3 * k + 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert binids.read_ids(binids.write_ids(df.limit(0), JSON)).count() == 0


def test_packing(spark, texts, library):
    df = table(spark, [*texts, *(["word " * 700] * 30)])
    rows = packing.packed(df, JSON, window=256).collect()
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    every = {r.doc_id: r.text for r in df.collect()}
    assert set(docs) == set(every)
    for k, pieces in docs.items():
        ids, at = np.array([*library.encode_ordinary(every[k] or ""), 1], "<u4"), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    short = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 256 and (at & (at - 1)) == 0  # a power of two isn't padded
        short += at < 256
    assert short <= 8  # all others are full
    assert packing.packed(df.limit(0), JSON).count() == 0


def test_least_squares_is_optimal():
    rng = random.Random(2)
    counts = {k: rng.randint(1, 50) for k in range(1, 16)}
    columns = packing.combinations(counts, 16)
    x = packing.least_squares(columns, counts)
    a = np.zeros((17, len(columns)))
    for j, c in enumerate(columns):
        for v in c:
            a[v, j] += 1
    gradient = a.T @ (a @ x - np.array([counts.get(k, 0) for k in range(17)]))
    assert (x >= 0).all() and (gradient > -1).all() and (np.abs(gradient[x > 0.3]) < 1).all()
    used, left = packing.plan(counts, 16)
    assert all(sum(c) == 16 for c, _ in used) and min(left.values()) >= 0


def test_least_squares_scales_with_the_counts():
    rng = random.Random(2)
    counts = {k: rng.randint(1, 50) for k in range(1, 256)}
    columns = packing.combinations(counts, 256)
    one = packing.least_squares(columns, counts)
    for scale in (1000, 10**6):
        assert np.allclose(packing.least_squares(columns, {k: v * scale for k, v in counts.items()}), one * scale, rtol=1e-9)
    a = np.zeros((256, len(columns)))
    for j, c in enumerate(columns):
        for v in c:
            a[v, j] += 1
    slope = a.T @ (a @ one - np.array([counts.get(k, 0) for k in range(256)])) / 50
    assert (one >= 0).all() and slope.min() > -2e-4 and np.abs(slope[one > 0]).max() < 2e-4
    with pytest.warns(UserWarning):
        packing.least_squares(columns, counts, steps=3)
    assert packing.least_squares([], {1: 2}).tolist() == []


def near_set(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_brute(rows, percent):
    sets = {k: near_set(t) for k, t in rows.items()}
    root = {k: k for k in rows}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(rows)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k)) for k in rows}


def test_near_duplicates(spark):
    rng = random.Random(7)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(120)]
    made = []
    for _ in range(60):  # one large group of near copies, some of them too far apart
        t = list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = f"x{rng.randint(0, 10**6)}"
        made.append(" ".join(t))
    made += [" ".join(rng.choices(base, k=30)) for _ in range(20)] + [made[0].upper(), made[0], "one two", "One  TWO", "one", *ODD]
    df = table(spark, made)
    wanted = near_brute({r.doc_id: r.text for r in df.collect()}, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()}
    assert {k: v[:2] for k, v in got.items()} == wanted and all(kept == (c == k) for k, (_, c, kept) in got.items())
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_near_duplicates_with_repeated_ids(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, b), (3, a), (4, c), (4, c), (5, None)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 36, 1, True), (1, 36, 1, True), (2, 36, 1, False), (3, 36, 1, False), (4, 36, 4, True), (4, 36, 4, True), (5, 0, 5, True)]


def test_a_pivot_with_very_many_partners(spark):
    base = [f"w{k}" for k in range(200)]
    made = [" ".join(base)] + [" ".join([*base[: 3 + k % 190], f"x{k}", *base[4 + k % 190 :]]) for k in range(300)]
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    pairs = spark.createDataFrame([(0, k) for k in range(1, 301)], "a long, b long")
    got = {(r.a, r.b) for r in minhash.confirmed(pairs, df, "doc_id", "text", 5, 85).collect()}
    zero = near_set(made[0])
    assert got == {(0, k) for k in range(1, 301) if 100 * len(zero & near_set(made[k])) >= 85 * len(zero | near_set(made[k]))} and len(got) == 300


def test_signature_estimate(spark):
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    for share in (0.2, 0.5, 0.9):
        b = np.unique(np.concatenate([a[: int(len(a) * share)], rng.integers(0, 1 << 63, len(a) - int(len(a) * share), dtype=np.uint64)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        _, bits = minhash.signatures([a, b], 8, 44)
        df = spark.createDataFrame([(bits[0].tolist(), bits[1].tolist())], "a array<long>, b array<long>")
        assert abs(df.select(minhash.estimate(F.col("a"), F.col("b"), 352).alias("e")).first()["e"] - true) < 0.12


def thue_morse(n):
    """Two texts of n letters whose difference no polynomial modulo a power of two sees."""
    out = "a"
    while len(out) < n:
        out += out.translate(str.maketrans("ab", "ba"))
    return out, out.translate(str.maketrans("ab", "ba"))


def test_words_are_exact():
    ids, words, counts = shingles.word_ids([b"", b"zz  cc\tAA", b"bb aa"])
    assert ids.tolist() == [0, 1, 2, 3, 2] and words == [b"zz", b"cc", b"aa", b"bb"] and counts.tolist() == [0, 3, 2]
    assert shingles.word_ids([b"Aa aa"], fold=False)[0].tolist() == [0, 1]
    one, two = (shingles.shingle_sets(x)[-1].tolist() for x in ([b"a b c d e f"], [b"x y", b"A  b c D e f"]))
    assert one == two  # hashes don't depend on the batch
    first, second = thue_morse(1024)
    own = [f"w{k}" for k in range(7)]
    assert fertility.repeated_words([" ".join([first, *own, second, *own]).encode()]) == [0]
    assert fertility.repeated_words([" ".join([first, *own, first, *own]).encode()]) == [16]
    sets = [{tuple(x) for x in s.tolist()} for s in shingles.shingle_sets([f"{x} p q r s t".encode() for x in (first, second)])]
    assert len(sets[0]) == len(sets[1]) == 2 and len(sets[0] & sets[1]) == 1


def test_exact_sets():
    rng = random.Random(1)
    made = [" ".join(rng.choices("abcdefg", k=rng.randint(0, 60))) for _ in range(120)]
    wanted = [near_set(t) for t in made]
    exact, hashed = shingles.exact_sets([t.encode() for t in made]), shingles.shingle_sets([t.encode() for t in made])
    for i in range(0, 120, 5):
        for j in range(120):
            assert len(np.intersect1d(exact[i], exact[j])) == len(np.intersect1d(hashed[i][:, 0], hashed[j][:, 0])) == len(wanted[i] & wanted[j])


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (200, 201)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 160)} | {200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_duplicates(spark, texts):
    long = "A sentence that repeats. " * 900
    df = table(spark, [*texts, long, long, long + "x", long[:-1]])
    rows = {r.doc_id: r.text or "" for r in df.collect()}
    same = {}
    for k, t in rows.items():
        same.setdefault(t, []).append(k)
    got = {r.doc_id: r for r in chunkdedup.exact_duplicates(df).collect()}
    assert len(got) == len(rows)
    for k, t in rows.items():
        r = got[k]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (max(same[t]), len(same[t]), k == max(same[t]), hashlib.sha256(t.encode()).hexdigest())
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "a"), (3, ""), (3, None)], "doc_id long, text string")
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in chunkdedup.exact_duplicates(twice).collect())
    assert got == [(1, 2, 4, False)] * 2 + [(2, 2, 4, False), (2, 2, 4, True), (3, 3, 2, False), (3, 3, 2, True)]
    joined = df.select("text", F.array_join(chunkdedup.chunks(F.coalesce("text", F.lit(""))), "").alias("again")).collect()
    assert all((r.text or "") == r.again for r in joined)
    assert chunkdedup.exact_duplicates(df.limit(0)).count() == 0


def test_recipes_of_clashing_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(chunkdedup.F, "xxhash64", lambda c: F.length(c).cast("long"))  # any two chunks of a length clash
    made = ["abc", "abd", "abc", "", None, "x" * 5000, "y" * 5000, "x" * 4999 + "z", "abd"]
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in chunkdedup.exact_duplicates(df).collect()}
    assert got == {0: (2, 2), 2: (2, 2), 1: (8, 2), 8: (8, 2), 3: (4, 2), 4: (4, 2), 5: (5, 1), 6: (6, 1), 7: (7, 1)}


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz ", "ABCDEFGHIJKLMNOPQRSTUVWXYZ ", "абвгдежзийклмнопрстуфхцчшщъыьэюя ", "אבגדהוזחטיכלמנסעפצקרשת ", "กขคงจฉชซดตถทธนบปพฟภมยรลวศสหอ", "\u4e00\u4e50\u4ea4\u5019\u5143\u516c\u5206\u52a8\u5370\u53e3\u547d\u56fd\u5927\u5b66\u5c0f\u5e74\u6210\u65e5\u6c34\u706b"])
def test_chunks_follow_the_content_in_every_script(spark, letters):
    text = "".join(random.Random(3).choices(letters, k=40_000))
    rows = spark.createDataFrame([(text,), ("~" + text,)], "t string").select(chunkdedup.chunks(F.col("t")).alias("c")).collect()
    one, two = (set(r.c) for r in rows)
    assert "".join(rows[0].c) == text and len(one) > 40 and len(one & two) > 0.8 * len(one)


def test_line_frequency(spark):
    rows = [(k, f"  Menu \t\nown line {k}\n\n{'rare' if k < 3 else 'x'}", "clash", 1, "c", "h" if k < 20 else None, "en") for k in range(40)]
    rows += [(100, "Menu", "i", 1, "c", "h", "en"), (101, None, "i", 1, "c", "h", "en"), (102, "", "i", 1, "c", "h", "en")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in linefreq.without_boilerplate(df, min_pages=5, keep_copies=True).collect()}
    assert got[1].text == "own line 1\n\nrare" and (got[1].n_lines, got[1].n_dropped) == (4, 1) and got[30].text == "own line 30\n"
    assert got[100].text == "Menu" and got[101].text is None and got[101].n_lines == 0 and got[102].text == ""
    assert got[1].key == "c" and linefreq.without_boilerplate(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = {r.doc_id: r for r in linefreq.without_boilerplate(df).collect()}  # the ratio alone
    assert alone[100].text == "" and (alone[100].n_lines, alone[100].n_dropped) == (1, 1) and alone[1].text == "own line 1\n"  # rare: 3 of 23 pages
    clash = df.withColumns({"host": F.lit(1), "lines": F.lit(2), "boilerplate": F.lit(3), "n_lines": F.lit("old")})
    again = linefreq.without_boilerplate(clash)
    assert {r.doc_id: r.text for r in again.collect()} == {k: r.text for k, r in alone.items()} and {"host", "lines", "boilerplate"} < set(again.columns)
    few = spark.createDataFrame([(1, "a\nb", "h"), (1, "a\nb", "h"), (2, None, "h"), (3, "c", "h")], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.text or "") for r in linefreq.without_boilerplate(few, percent=40).collect()) == [(1, ""), (1, ""), (2, ""), (3, "c")]


def base_brute(t):
    words = [w for w in t.encode().split()]
    cover, seen = set(), Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    for i in range(len(words) - 7):
        if seen[tuple(words[i : i + 8])] > 1:
            cover.update(range(i, i + 8))
    lines = [x for x in t.split("\n") if x.encode().split()]
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover)


def test_base_counts(texts):
    plain = [t or "" for t in texts] + ["a b c d e f g h " * 3, "a b c d e f g h i a b c d e f g h", "x\nx\ny\n \n \n# $", "Aa " * 9]
    got = fertility.base_counts([t.encode() for t in plain])
    assert list(zip(*(got[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), strict=True)) == [base_brute(t) for t in plain]


def test_fertility_bands(spark):
    rng = random.Random(3)
    words = ["the", "house", "river", "stone", "light", "winter", "morning", "and", "of", "walks", "under", "green"] + [f"{a}{b}" for a in ("lo", "mi", "ra") for b in ("ter", "nal", "ves")]
    clean = [" ".join(rng.choices(words, k=150)) for _ in range(80)]
    junk = [" ".join("".join(rng.choice("!#xQ7%") for _ in range(9)) for _ in range(150)) for _ in range(3)]
    df = table(spark, [*clean, *junk, *ODD])
    got = {r.doc_id: r for r in fertility.judged(df).collect()}
    kept = [got[3 * k + 1].kept for k in range(len(clean) + len(junk) + len(ODD))]
    assert all(kept[:80]) and not any(kept[80:])
    assert fertility.script_of("aя" * 1024) == fertility.script_of("я" + "aя" * 1024) == "CYRILLIC" and fertility.script_of("a" * 9 + "1" * 5000) == "LATIN"
    assert fertility.judged(df.limit(0)).count() == 0 and fertility.judged(df.limit(3), lang=None).count() == 3


def test_language_profiles(spark):
    rng = random.Random(9)
    parts = {"aa": ["the", "ing", "and", "ther", "ould"], "bb": ["der", "sch", "ung", "ein", "ßen"], "cc": ["ción", "que", "los", "ado", "ñas"]}
    rows = []
    for k in range(240):
        lang = sorted(parts)[k % 3]
        rows.append((k, " ".join("".join(rng.choices(parts[lang], k=2)) for _ in range(25)), "i", 1, "k", "s", lang if k % 7 else None))
    rows += [(500, None, "i", 1, "k", "s", "aa"), (501, "123 !", "i", 1, "k", "s", "aa"), (502, "", "i", 1, "k", "s", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    profiles = hyperlang.learn(df, train=crc_fold("doc_id", 4) != 2)
    got = {r.doc_id: r for r in hyperlang.identified(df, profiles).collect()}
    assert all(got[k].lang_pred == sorted(parts)[k % 3] and 0 <= got[k].score <= 1 for k in range(240))
    assert all((got[k].lang_pred, got[k].score) == ("und", 0) for k in (500, 501, 502))
    text = rows[0][1]  # the folded products are those of the text's own vector
    vector, counts = hyperlang.encode(text), np.unique(hyperlang.ngrams([text])[0], return_counts=True)[1]
    cosine = (profiles.prototypes @ vector).max() / math.sqrt((counts**2).sum() * hyperlang.DIMENSIONS)
    assert math.isclose(profiles.predict([text])[1][0], (1 + cosine) / 2, rel_tol=1e-9)
    own = sum(hyperlang.encode(r[1]) for r in rows[:240] if r[6] == "bb" and zlib.crc32(str(r[0]).encode()) % 4 != 2)
    assert np.allclose(profiles.prototypes[1], own / np.linalg.norm(own))
    none = hyperlang.learn(df.limit(0))
    assert {r.lang_pred for r in hyperlang.identified(df, none).collect()} == {"und"}


def test_language_of_texts_with_letters_is_always_known(spark):
    rows = [(1, "the thing then there", "aa"), (1, "the thing then there", "aa"), (2, "zq", None), (3, "mnv", None), (4, "эюя", None), (5, "1 2", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted((r.doc_id, r.lang_pred) for r in hyperlang.identified(df, hyperlang.learn(df)).collect())
    assert got == [(1, "aa"), (1, "aa"), (2, "aa"), (3, "aa"), (4, "aa"), (5, "und")]
    tied = spark.createDataFrame([(1, "abc", "b"), (2, "abc", "a")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in hyperlang.identified(tied, hyperlang.learn(tied)).collect()} == {"a"}


def test_languages_are_told_apart_by_letters_of_their_own():
    points = np.array(sorted(set("абвгдежзийклмнопрстуфхцчшщъыьэюяіїєґąćęłńóśźżàâçéèêëîïôûùüÿñ漢字仮名")), str).view(np.uint32)
    vectors = hyperlang.letter_vectors(points).astype(float)
    products = vectors @ vectors.T / hyperlang.DIMENSIONS - np.eye(len(points))
    assert np.abs(products).max() < 0.15


def test_archives(spark):
    big = "<p>" + "ä<b>line</b>\r\n" * 9000
    pages = [(1, "http://a/ b", "x" * 100), (2, None, "x" * 100), (3, "u", "x" * 99), (4, "u", "x" * 99), (5, "u", None), (6, "u", ""), (7, "u", big), (8, "u\n", big), (9, "u", "WARC/1.1\r\n\r\n0\r\n\r\n" * 20)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, id string").repartition(3)
    got = {r.id: r for r in warc.read_archives(warc.write_archives(df)).collect()}
    assert len(got) == len(pages) and not any(r.problem for r in got.values())
    for k, _, html in pages:
        data = (html or "").encode()
        assert (got[k].payload_bytes, got[k].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
    assert {k: r.refers_to for k, r in got.items() if r.record_type == "revisit"} == {2: 1, 8: 7}
    assert warc.read_archives(warc.write_archives(df.limit(0))).count() == 0


def test_archives_of_any_and_repeated_ids(spark):
    big = "y<p>" * 20000
    rows = [(-5, "u", "x" * 200), (7, "u", "x" * 200), (-5, "u", "x" * 200), (8, "u", big), (8, "v", big + "!"), (9, "u", big), (10, "u", big + "!"), (8, "u", "short")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    got = warc.read_archives(warc.write_archives(df)).collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(map(str, ((r.id, r.payload_digest, r.record_type, r.refers_to, r.problem) for r in got))) == sorted(map(str, [
        (-5, digest("x" * 200), "response", None, None), (-5, digest("x" * 200), "response", None, None), (7, digest("x" * 200), "revisit", -5, None),
        (8, digest(big), "response", None, None), (8, digest(big + "!"), "response", None, None), (8, digest("short"), "response", None, None),
        (9, digest(big), "revisit", 8, None), (10, digest(big + "!"), "revisit", 8, None)]))


def test_damaged_archives(spark, tmp_path):
    page = lambda k, limit, drop=(): b"".join(x for i, x in enumerate(warc.page_records(k, "u", b"y" * 1000, hashlib.sha256(b"y" * 1000).hexdigest(), None, limit)) if i not in drop)
    lost = warc.record([("WARC-Type", "revisit"), ("WARC-Record-ID", "<urn:page:5:0.0>"), ("WARC-Refers-To", "<urn:page:77>")], b"")
    wrong = b"".join(warc.page_records(6, "u", b"z" * 200, "0" * 64, None, 10**6))
    (tmp_path / "a.warc.gz").write_bytes(page(1, 300) + page(2, 300, {1}) + page(3, 300, {0}) + page(4, 10**6) + lost + wrong)
    got = {r.id: r.problem for r in warc.read_archives(spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz",)], "path string")).collect()}
    assert got[1] is None and got[4] is None and all(got[k] for k in (2, 3, 5, 6))
    for body in (b"", b"5\r\nab", b"zz\r\n", b"3\r\nabc\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(body)
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\nT: v\r\n\r\n") == b"abc"


def test_stages_are_deleted_and_settings_kept(spark):
    before, folder = dict(spark.sparkContext.getConf().getAll()), common.shared_dir(spark).removeprefix("file://") + "/gleanframe"
    rows, size = (spark.conf.get(k) for k in common.ARROW)
    had = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    df = spark.createDataFrame([(k, f"some words of text {k} " * 9) for k in range(20)], "doc_id long, text string")
    out = minhash.near_duplicates(df)
    assert len(set(os.listdir(folder)) - had) == 1 and out.count() == 20
    assert [spark.conf.get(k) for k in common.ARROW] == [rows, size] and dict(spark.sparkContext.getConf().getAll()) == before


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(4)
    words = [a + b for a in ("lor", "ven", "mas", "tir", "el", "con") for b in ("em", "ato", "is", "une", "orra", "ix")]
    made = ["Shared menu line\n" + " ".join(rng.choices(words, k=120)) for _ in range(70)]
    made += [made[3] + " plus", made[3], "short", None, "123 " * 40]
    rows = [(k, t, "en" if k % 9 else None, "h", len(t or "")) for k, t in enumerate(made)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
    kept = docs.collect()
    assert {r.doc_id for r in kept} == set(range(70)) and all("menu" not in r.text and r.n_chars == len(r.text) and r.lang for r in kept)
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(range(70))


def test_pipeline_drops_near_copies_at_four_fifths(spark):
    import corpus_pipeline

    words = [f"w{k}" for k in range(55)]
    made = [" ".join(words), " ".join([*words[:27], "x", *words[28:]])]  # 46 of 56 shingles shared: 0.82
    made.append(" ".join([*words[:12], "y", *words[13:27], "z", *words[28:]]))  # 0.67 and 0.82
    made.append(" ".join(f"v{k}" for k in range(55)))
    docs = table(spark, made)
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs.where("doc_id <> 7"), "").collect()} == {1, 10}
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs.where("doc_id in (1, 7)"), "").collect()} == {1, 7}


def test_pipeline_drops_foreign_and_random_texts(spark):
    import corpus_pipeline

    rng = random.Random(12)
    parts = {"aa": ["the", "ing", "and", "ther", "ould", "was"], "bb": ["der", "sch", "ung", "ein", "ben", "icht"]}
    say = lambda lang, n: " ".join("".join(rng.choices(parts[lang], k=2)) for _ in range(n))
    rows = [(k, say("ab"[k % 2] * 2, (4, 30, 200)[k % 3]), "ab"[k % 2] * 2 if k % 5 else None) for k in range(120)]
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)) for n in (200, 600, 3000)]
    foreign = ["nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura " * 2, "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan", "wszyscy ludzie rodzą się wolni i równi pod względem swej godności"]
    rows += [(200 + k, t, None if k % 2 else "aa") for k, t in enumerate([*noise, *foreign, "123 !"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id: r.lang for r in corpus_pipeline.language(spark, docs, "").collect()}
    assert kept == {k: "ab"[k % 2] * 2 for k in range(120)}
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language(spark, unknown, "").count() == len(rows)


def test_languages_of_few_texts_are_judged(spark):
    rng = random.Random(3)
    words = ["the", "house", "river", "stone", "light", "winter", "morning", "and", "of", "walks", "under", "green"] + [f"{a}{b}" for a in ("lo", "mi", "ra") for b in ("ter", "nal", "ves")]
    clean = lambda: " ".join(rng.choices(words, k=150))
    junk = lambda: " ".join("".join(rng.choice("!#xQ7%") for _ in range(9)) for _ in range(150))
    rows = [(k, clean(), "en") for k in range(80)] + [(100, clean(), "xx"), (101, junk(), "xx"), (102, clean(), None), (103, junk(), None)]
    rows.append((104, " ".join("".join(rng.choice("!#7%я") for _ in range(9)) for _ in range(150)), None))
    got = {r.doc_id: r for r in fertility.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert {k for k, r in got.items() if not r.kept} == {101, 103, 104}
    assert (got[0].band, got[100].band, got[102].band, got[104].band) == ("en", "all, script LATIN", "all, script LATIN", "all")


def test_pieces_spelled_at_once():
    letters = tokens.byte_letters()
    one_by_one = lambda xs: [x.encode().decode("latin-1").translate(letters) for x in xs]
    for pieces in (["a", " b", "é\t", "日本"], ["\n", "a\nb"], ["a", "\n\n", " ñ", "\r\n"], ["\n", "x"], [""], ["", "\n"]):
        assert tokens.spelled(pieces, letters) == one_by_one(pieces)
