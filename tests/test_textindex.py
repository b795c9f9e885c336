"""The text index against a full scan."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanframe.operators import textindex


def brute(docs, queries, k):
    cut = [(i, re.findall(r"[^\W_]+", (t or "").lower())) for i, t in docs]
    n, mean = len(cut), sum(len(w) for _, w in cut) / max(1, len(cut)) or 1
    df = Counter(x for _, w in cut for x in set(w))
    out = []
    for q, text in queries:
        terms = set(re.findall(r"[^\W_]+", (text or "").lower())) & set(df)
        scored = []
        for i, w in cut:
            tf = Counter(w)
            s = sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(w) / mean)) for t in terms)
            if any(tf[t] for t in terms):
                scored.append((-round(s, 6), i))
        out += [(q, i, r + 1, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 3, 50])
def test_top_k_is_the_full_scan(spark, tmp_path, monkeypatch, k):
    monkeypatch.setattr(textindex, "SPAN", 16)
    rng = random.Random(k)
    some = lambda n: " ".join(f"w{int(rng.expovariate(0.05))}" for _ in range(n))
    docs = [(i, some(rng.randint(0, 40))) for i in range(400)] + [(900, None), (901, ""), (902, "Ünïcode w1"), (903, some(3000))]
    docs += [(1000 + i, docs[i][1]) for i in range(10)]
    queries = [(q, some(rng.choice((1, 2, 5, 12)))) for q in range(30)] + [(40, None), (41, "unheard"), (42, "ünïcode, ünïcode!"), (43, "w0 w1 w2 w150")]
    index = textindex.build(spark.createDataFrame(docs, "id long, text string").repartition(3), "id", "text", str(tmp_path / f"i{k}"))
    got = textindex.search(index, spark.createDataFrame(queries, "q long, text string"), k=k)
    want = brute(docs, queries, k)
    rows = sorted((r.q, r.id, r["rank"], r.score) for r in got.collect())
    assert [r[:3] for r in rows] == [r[:3] for r in want] and all(abs(a[3] - b[3]) < 2e-6 for a, b in zip(rows, want, strict=True))


def test_fewer_postings_are_read(spark, tmp_path):
    rng = random.Random(1)
    docs = [(i, "the of and " * rng.randint(1, 4) + f"w{rng.randrange(200)} w{rng.randrange(200)}") for i in range(20000)]
    index = textindex.build(spark.createDataFrame(docs, "id long, text string"), "id", "text", str(tmp_path / "i"))
    asked = spark.createDataFrame([(1, "the of w7 and w9")], "q int, text string")
    known, essential = textindex.plan_of(index, asked, "q", "text", 10)
    words = {r.term: r.essential for r in known.collect()}
    assert not words["the"] and not words["of"] and words["w7"]
    read = essential.agg(F.sum(F.size("numbers"))).first()[0]
    every = index.blocks.join(known.select("term"), "term", "left_semi").agg(F.sum(F.size("numbers"))).first()[0]
    assert every > 60000 and read < every / 50
    top = textindex.search(index, asked).collect()
    assert len(top) == 10 and {r.id for r in top if r["rank"] == 1} <= {i for i, t in docs if "w7" in t.split() or "w9" in t.split()}


def test_empty_index(spark, tmp_path):
    none = spark.createDataFrame([], "id string, text string")
    index = textindex.build(none, "id", "text", str(tmp_path / "i"))
    assert textindex.search(index, spark.createDataFrame([(1, "a")], "q int, text string")).count() == 0
    again = textindex.opened(spark, str(tmp_path / "i"))
    assert again.terms.count() == 0


def test_scores_stay_in_the_task_of_their_block(spark, tmp_path):
    rng = random.Random(2)
    docs = [(i, " ".join(f"w{rng.randrange(50)}" for _ in range(20))) for i in range(3000)]
    index = textindex.build(spark.createDataFrame(docs, "id long, text string"), "id", "text", str(tmp_path / "i"))
    top = textindex.search(index, spark.createDataFrame([(1, "w1 w2 w3"), (2, "w4 w2")], "q int, text string"))
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and not re.search(r"Exchange hashpartitioning\(q#\d+L?, \w+#", plan)
