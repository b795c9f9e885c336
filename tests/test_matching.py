"""One-to-one matching, contained names, axes read by a model, reports."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from gleanframe.functions import match
from gleanframe.operators import charts, evaluate
from gleanframe.plans import report


def greedy_brute(pairs):
    out, left, right = set(), set(), set()
    for g, l, r in sorted(set(pairs), key=lambda x: (str(x[0]), x[1], x[2])):
        if (g, l) not in left and (g, r) not in right:
            out.add((g, l, r))
            left.add((g, l))
            right.add((g, r))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_greedy_is_the_fold(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.choice(["a", "b", None, "c"]), rng.randint(1, 15), rng.randint(1, 15)) for _ in range(300)]
    df = spark.createDataFrame([(g, None, l, r) for g, l, r in pairs], "g string, page int, l long, r long").repartition(5)
    got = evaluate._greedy(df, ["g", "page"], "l", "r").collect()
    assert {(r.g, r.l, r.r) for r in got} == greedy_brute(pairs) and len(got) == len(greedy_brute(pairs))
    assert evaluate._greedy(df.limit(0), ["g", "page"], "l", "r").count() == 0


def test_one_page_of_many_pairs(spark):
    df = spark.range(300).select(F.lit("d").alias("g"), F.lit(None).cast("int").alias("page"), F.col("id").alias("l")).crossJoin(spark.range(300).withColumnRenamed("id", "r"))
    evaluate._greedy(df.where("l < 2 and r < 2"), ["g", "page"], "l", "r").count()
    began = time.monotonic()
    got = evaluate._greedy(df, ["g", "page"], "l", "r")
    assert got.count() == 300 and got.where("l = r").count() == 300 and time.monotonic() - began < 30


def test_contained_names(spark):
    rng = random.Random(4)
    some = lambda: "".join(rng.choices("abc", k=rng.choice((0, 1, 2, 3, 4, 6, 9))))
    outer, inner = [some() for _ in range(150)] + [None, "ÄÖÜß", "日本語"], [some() for _ in range(150)] + [None, "öü", "ÖÜ", "本"]
    got = match.containing(spark.createDataFrame([(x,) for x in outer], "a string"), spark.createDataFrame([(x,) for x in inner], "b string"), "a", "b")
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in got.collect()) == sorted({(a, b) for a in outer for b in inner if a and b and b in a})


def test_first_firm(spark):
    rows = spark.createDataFrame([(1, "Acme Corp"), (2, "Big"), (3, " "), (4, None), (5, "zz")], "k int, entity string")
    firms = spark.createDataFrame([("acme", 2, "x"), ("A C", 1, "y"), ("The Big Bank", 3, "z"), ("", 0, "no"), (None, 0, "no")], "firm string, position int, settings string")
    got = {r.k: r.settings for r in match.with_firm(rows, "entity", firms).collect()}
    assert got == {1: "y", 2: "z", 3: None, 4: None, 5: None}


def test_axes_in_answers(spark):
    bars = [{"id": k, "series": "s", "value": "5", "x_center": 10.0 * k} for k in range(3)]
    told = {"bars": bars, "labels": [{"text": "Nov 2024", "x_center": "1.0"}]}
    rows = [(1, json.dumps(told)), (2, f"Here: {json.dumps(told)} as asked."), (3, "no idea"), (4, None), (5, '{"bars": 7}'), (6, '{"bars": [{"id": "x"}], "labels": null}')]
    got = {r.k: r for r in charts.read_axes(spark.createDataFrame(rows, "k int, raw string")).collect()}
    assert got[1].status == "geometry" and [p.period for p in got[1].periods] == ["November 2024", "December 2024", "January 2025"] and got[2].periods == got[1].periods
    assert (got[3].status, got[4].status) == ("unread", "unread") and got[5].bars == [] and got[6].bars[0].id is None and got[6].labels == []


def test_reports(spark):
    truth = spark.createDataFrame([(k, f"d{k % 3}.pdf", 1, "table", f"net x{k}", str(k), "yes" if k < 15 else "no") for k in range(18)], "truth_no int, document string, page int, element_type string, field_name string, value string, should_extract string")
    claims = spark.createDataFrame([(k, f"d{k % 3}.pdf", 1, f"net x{k}", None, str(k)) for k in (0, 1, 16)], "claim_no int, source_document string, page int, field_name string, canonical_metric string, value string")
    out = evaluate.matched(truth, claims)
    lines = report.accuracy_section(evaluate.confusion(out), out)
    assert "TP=2 FP=1 FN=13 TN=2" in lines[1] and "  missed: 13" in lines and "    ... and 5 more" in lines and "  claimed, but decoys: 1" in lines
    pages = evaluate.page_coverage(claims, spark.createDataFrame([("d0", 4), ("d1", 1)], "document string, total_pages int"))
    covered = report.coverage_section(pages)
    assert covered[1] == "  all: 2 of 5 pages, 40.0 %" and covered[2].endswith("<- 3 missing") and "<-" not in covered[3]
    elements = spark.createDataFrame([("d", k, "text", k % 5, False) for k in range(40)], "doc string, pos int, el_type string, page int, ornament boolean")
    audit = report.audit_section(evaluate.coverage_audit(elements, spark.createDataFrame([("d", 1)], "doc string, page int")))
    assert "40 elements (text 40), 8 accounted for (20.0 %), 0 skipped, 32 gaps" in audit[1] and audit[2].endswith("without: 0, 2, 3, 4") and audit[3].count("text on p") == 10
    same = report.robustness_section(evaluate.reproducibility(*[claims.withColumn("element_type", F.lit("table"))] * 2), 1.0)
    assert same[1].startswith("  all          100.0 %") and same[-1] == "  within tolerance 100.0 %"
    whole = report.full_report(lines, covered, audit, same)
    assert whole.count("\n\n") == 4
    text = report.as_text(spark.range(300), "numbers", 5)
    assert text.endswith("... and 295 more") and len(text.split("\n")) == 8
    runs = spark.createDataFrame([("one", 60.0, 1000, 100)], "run string, elapsed_seconds double, input_tokens long, output_tokens long")
    cover = spark.createDataFrame([("one", 4, 2, [3, 4], [4], 7)], "run string, total_pages int, pages_with_claims int, pages_missing_claims array<int>, pages_no_elements array<int>, n_claims int")
    told = spark.createDataFrame([("one", "parsed", "grounded"), ("one", "llm_estimated", None)], "run string, citation_tier string, grounding string")
    shown = report.run_text(evaluate.run_evaluation(runs, cover, told))
    assert "== EVALUATION: one ==" in shown and "page_coverage                  50.0 %" in shown and "FAITHFULNESS" in shown and "COST" in shown
