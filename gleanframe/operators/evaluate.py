"""Evaluation of runs: accuracy, coverage, reproducibility, faithfulness, speed and cost. Ratios aren't rounded."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.match import CHART_TYPES, as_number, field_matches, value_matches, within
from ..functions.text import comparable_document, comparable_value
from ..schemas import LAYOUT, PARSED, Settings

# What counts as true in labelled rows.
YES = ("true", "1", "yes", "y")


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def _greedy(pairs: DataFrame, keys: list[str], left: str, right: str) -> DataFrame:
    """One-to-one pairs: by order of the left number, each takes its first right number that is still free.

    A group's pairs pass by in order, sorted by Spark, and a task remembers only which numbers of the
    group at hand are taken: time follows the pairs, memory the matches of the largest group.
    """
    plain = pairs.select(*keys, F.col(left).cast("long").alias(left), F.col(right).cast("long").alias(right))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, done, taken = None, None, set()
        for b in batches:
            own, kept = [c.to_pylist() for c in b.columns], []
            for row, (*key, l, r) in enumerate(zip(*own, strict=True)):
                if key != group:
                    group, done, taken = key, None, set()
                if l != done and r not in taken:
                    done = l
                    taken.add(r)
                    kept.append(row)
            yield pa.RecordBatch.from_struct_array(b.to_struct_array().take(pa.array(kept, pa.int64())))

    ordered = plain.repartition(*keys).sortWithinPartitions(*keys, left, right)
    return ordered.mapInArrow(work, plain.schema)


def matched(truth: DataFrame, claims: DataFrame, tolerance: float = Settings.chart_tolerance) -> DataFrame:
    """The truth (truth_no, document, page, element_type, field_name, value, should_extract) with its ``outcome``.

    A positive is TP if a claim (claim_no, source_document, page, field_name, canonical_metric,
    value) of its document and page matches in field and value, each claim serving one at most, in
    order of numbers; else FN. A decoy is FP if any claim matches, else TN.
    """
    wanted = F.lower(F.trim(F.coalesce(F.col("should_extract").cast("string"), F.lit("")))).isin(*YES)
    t = truth.select("*", comparable_document(F.col("document")).alias("_doc"), F.lower(F.coalesce("element_type", F.lit(""))).alias("_kind"), wanted.alias("_wanted"))
    c = claims.select("claim_no", comparable_document(F.col("source_document")).alias("_cdoc"), F.col("page").alias("_cpage"), F.coalesce(F.nullif(F.col("canonical_metric"), F.lit("")), F.col("field_name"), F.lit("")).alias("_field"), F.col("value").alias("_value"))
    same = (F.col("_doc") == F.col("_cdoc")) & F.col("page").eqNullSafe(F.col("_cpage"))
    fits = field_matches(F.col("field_name"), F.col("_field")) & value_matches(F.col("_value"), F.col("value"), F.col("_kind"), tolerance)
    pairs = t.join(c, same & fits).select("_doc", F.col("page").alias("_page"), "truth_no", "claim_no", "_wanted")
    hits = _greedy(pairs.where("_wanted"), ["_doc", "_page"], "truth_no", "claim_no").select("truth_no", F.lit(True).alias("_hit"))
    false = pairs.where("not _wanted").select("truth_no", F.lit(True).alias("_hit")).distinct()
    out = t.join(hits.unionByName(false), "truth_no", "left")
    outcome = F.when(F.col("_wanted"), F.when(F.col("_hit"), "TP").otherwise("FN")).otherwise(F.when(F.col("_hit"), "FP").otherwise("TN"))
    return out.withColumn("outcome", outcome).drop("_doc", "_kind", "_wanted", "_hit")


def confusion(outcomes: DataFrame) -> DataFrame:
    """(element_type, tp, fp, fn, tn, precision, recall, accuracy, f1) overall (null) and by type, in one pass."""
    counted = outcomes.withColumn("element_type", F.lower(F.coalesce(F.nullif(F.col("element_type"), F.lit("")), F.lit("unknown"))))
    sums = counted.rollup("element_type").agg(*[F.count_if(F.col("outcome") == k).alias(k.lower()) for k in ("TP", "FP", "FN", "TN")])
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    f1 = F.when((p > 0) & (r > 0), 2 * p * r / (p + r))
    return sums.select("element_type", "tp", "fp", "fn", "tn", p.alias("precision"), r.alias("recall"), ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), f1.alias("f1"))


def page_coverage(chunks: DataFrame, totals: DataFrame) -> DataFrame:
    """(document, total_pages, pages_processed, coverage, missing_pages) of each document and overall (null)."""
    got = chunks.where("page is not null").groupBy(comparable_document(F.col("source_document")).alias("_doc")).agg(F.count_distinct("page").alias("got"))
    both = totals.withColumn("_doc", comparable_document(F.col("document"))).join(got, "_doc", "left")
    sums = both.rollup("document").agg(F.sum("total_pages").alias("total_pages"), F.sum(F.coalesce("got", F.lit(0))).alias("pages_processed"))
    some = F.nullif(F.col("total_pages"), F.lit(0))
    return sums.select("document", "total_pages", "pages_processed", ratio(F.col("pages_processed"), some).alias("coverage"), (some - F.col("pages_processed")).alias("missing_pages"))


def least_of(rows: DataFrame, keys: list[str], order: list[str], k: int, name: str) -> DataFrame:
    """(keys, name): the first ``k`` rows of each key by ``order``, as a list of structs.

    Row numbers up to ``k`` are a group limit, which Spark applies before its shuffle too: a task
    hands on ``k`` rows a key at most, and no list is longer.
    """
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    few = rows.withColumn("_n", n).where(F.col("_n") <= k)
    rest = [c for c in rows.columns if c not in keys]
    listed = few.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_n", *rest))).alias("_few"))
    return listed.select(*keys, F.transform("_few", lambda x: F.struct(*[x[c].alias(c) for c in rest])).alias(name))


def counted_by(rows: DataFrame, key: str, what: str, n: Column, name: str) -> DataFrame:
    """(key, name): a map from each value of ``what``, null left out, to its number."""
    each = rows.where(F.col(what).isNotNull()).groupBy(key, what).agg(n.cast("long").alias("_k"))
    return each.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(what, "_k")))).alias(name))


def coverage_audit(elements: DataFrame, claims: DataFrame, sample: int = 50) -> DataFrame:
    """Per document: elements in all, by type, accounted for, skipped and not accounted for; claims in all and by page; empty pages; the first ``sample`` gaps.

    An element is accounted for if its page has a claim. ``elements`` has ``ornament`` for logos.
    Claims without a page count in all, and account for elements without one.
    """
    per_page = claims.groupBy("doc", "page").agg(F.count("*").alias("k"))
    found = elements.join(per_page.select(F.col("doc").alias("_d"), F.col("page").alias("_p"), F.col("k")), (F.col("doc") == F.col("_d")) & F.col("page").eqNullSafe(F.col("_p")), "left")
    skipped = F.col("el_type").isin(*LAYOUT) | ((F.col("el_type") == "figure") & F.coalesce("ornament", F.lit(False)))
    state = F.when(skipped, "skipped").when(F.col("k").isNotNull(), "accounted").otherwise("unaccounted")
    marked = found.withColumn("state", state)
    # sums over types and pages first: what is left of a document is a row for each of them
    is_ = lambda s: F.count_if(F.col("state") == s)
    by_type = marked.groupBy("doc", "el_type").agg(F.count("*").alias("n"), is_("accounted").alias("accounted"), is_("skipped").alias("skipped"), is_("unaccounted").alias("unaccounted"))
    sums = by_type.groupBy("doc").agg(
        F.sum("n").alias("elements_total"), *[F.sum(x).alias(f"elements_{x}") for x in ("accounted", "skipped", "unaccounted")],
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("el_type", F.lit("")).alias("t"), "n")))).alias("elements_by_type"),
    )
    by_page = marked.where("page is not null").groupBy("doc", "page").agg(F.max(F.coalesce("k", F.lit(0))).alias("k"))
    pages = by_page.groupBy("doc").agg(F.count("*").alias("pages_total"), F.count_if(F.col("k") == 0).alias("empty_pages"), F.array_sort(F.collect_list(F.when(F.col("k") == 0, F.col("page")))).alias("empty_page_list"))
    gaps = least_of(marked.where("state = 'unaccounted'").select("doc", "pos", F.col("el_type").alias("type"), "page"), ["doc"], ["pos"], sample, "gap_sample")
    claimed = per_page.groupBy("doc").agg(F.sum("k").alias("claims_total"))
    claimed = claimed.join(counted_by(per_page, "doc", "page", F.sum("k"), "claims_by_page"), "doc", "left")
    share = 100 * F.col("elements_accounted") / F.greatest(F.lit(1), F.col("elements_total") - F.col("elements_skipped"))
    out = sums.withColumn("accounted_pct", share).join(pages, "doc", "left").join(claimed, "doc", "left").join(gaps, "doc", "left")
    nothing = {"claims_by_page": F.create_map().cast(out.schema["claims_by_page"].dataType), "gap_sample": F.array().cast(out.schema["gap_sample"].dataType)}
    return out.fillna(0, ["claims_total", "pages_total", "empty_pages"]).withColumns({c: F.coalesce(c, empty) for c, empty in nothing.items()})


def coverage_ok(audit: DataFrame, unaccounted: int = 0, empty: int = 0) -> DataFrame:
    return audit.withColumn("coverage_ok", (F.col("elements_unaccounted") <= unaccounted) & (F.col("empty_pages") <= empty))


def modality_coverage(elements: DataFrame, claims: DataFrame, totals: DataFrame | None = None, first_page: int = 0) -> DataFrame:
    """Per document: pages, those with elements, with claims and without, and element types that gave no claim.

    The number of pages is given (doc, pages_in_doc) or follows from the greatest page number.
    """
    e = elements.groupBy("doc").agg(F.count("*").alias("n_elements"), F.collect_set("page").alias("_pages"), F.collect_set("el_type").alias("_types"), F.max("page").alias("_last"))
    c = claims.groupBy("doc").agg(F.count("*").alias("n_claims"), F.collect_set("page").alias("_claimed"), F.collect_set("element_type").alias("_given"))
    both = e.join(c, "doc", "left")
    both = both.join(totals.select("doc", "pages_in_doc"), "doc", "left") if totals is not None else both.withColumn("pages_in_doc", F.lit(None).cast("int"))
    total = F.coalesce(F.nullif(F.col("pages_in_doc"), F.lit(0)), F.col("_last") + 1 - first_page, F.lit(0))
    none = F.array().cast("array<int>")
    claimed, words = F.coalesce("_claimed", none), F.coalesce("_given", F.array().cast("array<string>"))
    every = F.when(F.col("pages_in_doc") > 0, F.sequence(F.lit(first_page), F.col("pages_in_doc") - 1 + first_page)).otherwise(none)
    return both.select(
        "doc", total.alias("total_pages"), F.size("_pages").alias("pages_with_elements"), F.size(claimed).alias("pages_with_claims"),
        F.array_sort(F.array_except("_pages", claimed)).alias("pages_missing_claims"), F.array_sort(F.array_except(every, F.col("_pages"))).alias("pages_no_elements"),
        F.coalesce(ratio(F.size(claimed), total), F.lit(0.0)).alias("page_coverage"),
        F.array_sort(F.array_except(F.array_except("_types", words), F.array(*map(F.lit, LAYOUT)))).alias("types_missing"), "n_elements", F.coalesce("n_claims", F.lit(0)).alias("n_claims"),
    )


def faithfulness(claims: DataFrame, *by: str) -> DataFrame:
    """Claims in all, and the shares parsed by rule, estimated by a model and, where known, grounded."""
    tier = F.lower(F.coalesce("citation_tier", F.lit("unknown")))
    share = lambda c: ratio(F.count_if(c), F.greatest(F.count("*"), F.lit(1)))
    return claims.groupBy(*by).agg(
        F.count("*").alias("n_claims"), share(tier.contains(PARSED) | tier.contains("rule")).alias("grounded_parsed_frac"),
        share(tier.contains("estimated")).alias("llm_estimated_frac"), share(F.coalesce(F.col("grounding") == "grounded", F.lit(False))).alias("grounded_verified_frac"),
    )


def speed(runs: DataFrame) -> DataFrame:
    """Throughput of runs (elapsed_seconds, documents, pages, claims)."""
    took = F.greatest(F.col("elapsed_seconds"), F.lit(1e-9))
    some = lambda c: F.nullif(F.col(c).cast("double"), F.lit(0.0))
    return runs.withColumns({
        "docs_per_min": F.col("documents") / took * 60, "pages_per_min": some("pages") / took * 60, "claims_per_min": some("claims") / took * 60,
        "seconds_per_doc": took / some("documents"), "seconds_per_page": took / some("pages"),
    })


def cost(runs: DataFrame, settings: Settings = Settings(), parse_rate: float = 0.0) -> DataFrame:
    """Cost of runs (input_tokens, output_tokens, documents, pages), model rates per million tokens, parsing per page."""
    model = F.col("input_tokens") / 1e6 * settings.input_rate + F.col("output_tokens") / 1e6 * settings.output_rate
    known = runs.withColumns({"llm_cost_usd": model, "parse_cost_usd": F.col("pages") * parse_rate})
    total = F.col("llm_cost_usd") + F.col("parse_cost_usd")
    return known.withColumns({"total_cost_usd": total, "cost_per_doc_usd": ratio(total, F.col("documents")), "cost_per_page_usd": ratio(total, F.col("pages"))})


def run_summary(coverage: DataFrame, *by: str) -> DataFrame:
    """Sums of per-document coverage over a run, or over each of several."""
    pages, claimed = F.sum("total_pages"), F.sum("pages_with_claims")
    return coverage.groupBy(*by).agg(
        F.count("*").alias("documents"), pages.alias("total_pages"), claimed.alias("pages_with_claims"), F.coalesce(ratio(claimed, pages), F.lit(0.0)).alias("page_coverage"),
        F.sum(F.size("pages_missing_claims")).alias("pages_missing_claims_total"), F.sum(F.size("pages_no_elements")).alias("pages_no_elements_total"), F.sum("n_claims").alias("claims_total"),
    )


def run_evaluation(runs: DataFrame, coverage: DataFrame, claims: DataFrame, settings: Settings = Settings(), parse_rate: float = 0.0) -> DataFrame:
    """Runs (run, elapsed_seconds, input_tokens, output_tokens) with their coverage, faithfulness, speed and cost, a row each.

    ``coverage`` (of documents) and ``claims`` name their ``run``. A run without documents or claims
    has counts and shares of zero and null where a count would divide.
    """
    merged = runs.join(run_summary(coverage, "run"), "run", "left").join(faithfulness(claims, "run").drop("n_claims"), "run", "left")
    merged = merged.fillna(0, [c for c in merged.columns if c not in runs.columns])
    return cost(speed(merged.withColumns({"pages": F.col("total_pages"), "claims": F.col("claims_total")})), settings, parse_rate).drop("pages", "claims")


def scorecard(totals: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Coverage, quality, robustness and cost of batches (documents, claims, gold, review, quarantined, indexed, llm_cost_usd)."""
    docs = F.greatest(F.lit(1), F.col("documents"))
    share = lambda a, b: F.coalesce(100 * ratio(a, b), F.lit(0.0))
    attempted = docs + F.col("quarantined")
    total = F.col("llm_cost_usd") + F.coalesce(F.nullif(F.col("pages"), F.lit(0)), docs) * settings.parse_cost_per_page
    return totals.withColumns({
        "metrics_per_document": F.col("claims") / docs, "gold_rate_pct": share(F.col("gold"), F.col("claims")), "review_rate_pct": share(F.col("review"), F.col("claims")),
        "quarantine_rate_pct": share(F.col("quarantined"), attempted), "success_rate_pct": share(docs, attempted),
        "total_cost_usd": total, "cost_per_document_usd": total / docs, "cost_per_metric_usd": F.coalesce(ratio(total, F.col("claims")), F.lit(0.0)),
    })


def stored_quality(silver: DataFrame) -> DataFrame:
    """Grounded and parsed shares in per cent and mean confidence of stored claims."""
    pct = lambda c: 100 * ratio(F.count_if(F.coalesce(c, F.lit(False))), F.count("*"))
    return silver.agg(pct(F.lower("grounding") == "grounded").alias("grounded_pct"), F.avg("confidence").alias("avg_confidence"), pct(F.lower("citation_tier") == PARSED).alias("parsed_tier_pct"))


def side_by_side(a: DataFrame, b: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, a, b) of two one-row scorecards."""
    long = lambda df, name: df.select([F.col(m).cast("double") for m in metrics]).unpivot([], metrics, "metric", name)
    return long(a, "a").join(long(b, "b"), "metric")


_PRINT = ("doc", "page", "field", "element_type", "norm_value")


def fingerprints(claims: DataFrame) -> DataFrame:
    field = F.lower(F.trim(F.coalesce(F.nullif(F.col("canonical_metric"), F.lit("")), F.col("field_name"), F.lit(""))))
    return claims.select(comparable_document(F.col("source_document")).alias("doc"), "page", field.alias("field"), F.coalesce("element_type", F.lit("")).alias("element_type"), comparable_value(F.col("value")).alias("norm_value"))


def run_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Fingerprints of two runs with how often each has them (in_a, in_b)."""
    both = fingerprints(a).withColumn("_a", F.lit(1)).unionByName(fingerprints(b).withColumn("_a", F.lit(0)))
    return both.groupBy(*_PRINT).agg(F.sum("_a").alias("in_a"), (F.count("*") - F.sum("_a")).alias("in_b"))


def reproducibility(a: DataFrame, b: DataFrame) -> DataFrame:
    """(element_type, stable, only_a, only_b, reproducibility) overall (null) and by type; claims are multisets."""
    d = run_difference(a, b)
    less = F.least("in_a", "in_b")
    sums = d.rollup("element_type").agg(F.sum(less).alias("stable"), F.sum(F.col("in_a") - less).alias("only_a"), F.sum(F.col("in_b") - less).alias("only_b"))
    return sums.withColumn("reproducibility", ratio(F.col("stable"), F.col("stable") + F.col("only_a") + F.col("only_b")))


def recovered(a: DataFrame, b: DataFrame, tolerance: float = Settings.chart_tolerance) -> DataFrame:
    """(doc, page, field, recovered): chart values of run A that lack an equal but have one within the tolerance in run B, one-to-one."""
    d = run_difference(a, b).where(F.col("element_type").isin(*CHART_TYPES)).withColumn("value", as_number(F.col("norm_value")))
    keys = ["doc", "page", "field", "element_type"]
    left = d.where("in_a > in_b").select(*keys, F.col("value").alias("va"), F.explode(F.sequence(F.lit(1), (F.col("in_a") - F.col("in_b")).cast("int"))).alias("_i"))
    right = d.where("in_b > in_a").select(*keys, F.col("value").alias("vb"), F.explode(F.sequence(F.lit(1), (F.col("in_b") - F.col("in_a")).cast("int"))).alias("_i"))
    number = lambda df, v, name: df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(v, "_i"))).drop("_i")
    pairs = number(left, "va", "l").join(number(right, "vb", "r"), keys).where(within(F.col("va"), F.col("vb"), tolerance))
    return _greedy(pairs, keys, "l", "r").groupBy("doc", "page", "field").agg(F.count("*").alias("recovered"))


