"""Small results as text, for a notebook or a mail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _shown(v: object) -> str:
    return "n/a" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v)


def _share(v: float | None) -> str:
    return "n/a" if v is None else f"{100 * v:.1f} %"


def _first(df: DataFrame, most: int) -> tuple[list, int]:
    """The first rows, and how many more there are."""
    rows = df.limit(most + 1).collect()
    return rows[:most], 0 if len(rows) <= most else df.count() - most


def as_text(df: DataFrame, title: str, most: int = 200) -> str:
    """A titled table of up to ``most`` rows; it says how many more there are."""
    rows, more = _first(df, most)
    table = [df.columns, *[[_shown(v) for v in r] for r in rows]]
    width = [max(len(r[k]) for r in table) for k in range(len(df.columns))]
    lines = ["  ".join(v.ljust(w) for v, w in zip(r, width, strict=True)).rstrip() for r in table]
    return "\n".join([f"== {title} ==", *lines, *([f"... and {more} more"] if more else [])])


def scorecard_text(df: DataFrame, title: str = "run") -> str:
    """A one-row scorecard, a measure a line."""
    row = df.first()
    return "\n".join([f"== {title} ==", *[f"{c:32} {_shown(v)}" for c, v in zip(df.columns, row or [None] * len(df.columns), strict=True)]])


def accuracy_section(scores: DataFrame, outcomes: DataFrame, most: int = 8) -> list[str]:
    """Of ``evaluate.confusion`` and ``evaluate.matched``: counts and shares overall and by type, and the first missed items."""
    rows = {r["element_type"]: r for r in scores.collect()}  # a row a type
    lines = ["ACCURACY"]
    for kind, r in sorted(rows.items(), key=lambda x: (x[0] is not None, x[0])):
        counts = " ".join(f"{k.upper()}={r[k]}" for k in ("tp", "fp", "fn", "tn"))
        lines.append(f"  {kind or 'all':12} precision {_share(r['precision'])}  recall {_share(r['recall'])}  accuracy {_share(r['accuracy'])}  F1 {_share(r['f1'])}  ({counts})")
    for state, name in (("FN", "missed"), ("FP", "claimed, but decoys")):
        found, more = _first(outcomes.where(F.col("outcome") == state).orderBy("document", "page", "field_name").select("document", "page", "field_name", "value"), most)
        if found:
            lines.append(f"  {name}: {len(found) + more}")
            lines += [f"    {r['document']} p{_shown(r['page'])} {_shown(r['field_name'])} = {_shown(r['value'])}" for r in found] + ([f"    ... and {more} more"] if more else [])
    return lines


def coverage_section(pages: DataFrame, most: int = 50) -> list[str]:
    """Of ``evaluate.page_coverage``: pages processed overall and of each document, those with gaps first."""
    total = pages.where("document is null").first()
    lines = ["COVERAGE"]
    if total is not None:
        lines.append(f"  all: {_shown(total['pages_processed'])} of {_shown(total['total_pages'])} pages, {_share(total['coverage'])}")
    found, more = _first(pages.where("document is not null").orderBy(F.desc_nulls_last("missing_pages"), "document"), most)
    for r in found:
        lines.append(f"  {r['document']}: {_shown(r['pages_processed'])} of {_shown(r['total_pages'])}, {_share(r['coverage'])}" + (f"  <- {r['missing_pages']} missing" if r["missing_pages"] else ""))
    return lines + ([f"  ... and {more} more documents"] if more else [])


def robustness_section(scores: DataFrame, within: float | None = None) -> list[str]:
    """Of ``evaluate.reproducibility``: shares overall and by type; ``within`` is the share within the tolerance."""
    lines = ["ROBUSTNESS"]
    for r in sorted(scores.collect(), key=lambda r: (r["element_type"] is not None, r["element_type"])):
        lines.append(f"  {r['element_type'] or 'all':12} {_share(r['reproducibility'])}  (stable={r['stable']} only A={r['only_a']} only B={r['only_b']})")
    return lines + ([f"  within tolerance {_share(within)}"] if within is not None else [])


def audit_section(audit: DataFrame, most: int = 20, gaps: int = 10) -> list[str]:
    """Of ``evaluate.coverage_audit``: a block for each document, those with most gaps first."""
    found, more = _first(audit.orderBy(F.desc("elements_unaccounted"), "doc"), most)
    lines = ["AUDIT"]
    for r in found:
        kinds = ", ".join(f"{k or 'no type'} {n}" for k, n in sorted(r["elements_by_type"].items()))
        lines += [
            f"  {r['doc']}: {r['elements_total']} elements ({kinds}), {r['elements_accounted']} accounted for ({r['accounted_pct']:.1f} %), {r['elements_skipped']} skipped, {r['elements_unaccounted']} gaps",
            f"    {r['claims_total']} claims on {r['pages_total']} pages; without: {', '.join(map(str, r['empty_page_list'] or [])) or 'none'}",
        ]
        if r["gap_sample"]:
            lines.append("    gaps: " + ", ".join(f"{_shown(g['type'])} on p{_shown(g['page'])}" for g in r["gap_sample"][:gaps]))
    return lines + ([f"  ... and {more} more documents"] if more else [])


#: What a run's report shows of ``evaluate.run_evaluation``, by section.
_RUN = {
    "COVERAGE": ("documents", "total_pages", "pages_with_claims", "page_coverage", "pages_missing_claims_total", "pages_no_elements_total"),
    "FAITHFULNESS": ("claims_total", "grounded_parsed_frac", "llm_estimated_frac", "grounded_verified_frac"),
    "SPEED": ("elapsed_seconds", "docs_per_min", "seconds_per_page"),
    "COST": ("input_tokens", "output_tokens", "total_cost_usd", "cost_per_doc_usd", "cost_per_page_usd"),
}


def run_text(evaluation: DataFrame) -> str:
    """Each run of ``evaluate.run_evaluation`` in sections."""
    out = []
    for r in evaluation.orderBy("run").collect():  # a row a run
        out.append(f"== EVALUATION: {r['run']} ==")
        for title, names in _RUN.items():
            out.append(title)
            out += [f"  {n:30} {_share(r[n]) if n.endswith(('frac', 'page_coverage')) else _shown(r[n])}" for n in names if n in evaluation.columns]
    return "\n".join(out)


def full_report(*sections: list[str], title: str = "evaluation") -> str:
    """Sections below each other."""
    return "\n\n".join([f"== {title} ==", *["\n".join(x) for x in sections]])
