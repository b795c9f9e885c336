"""Worked examples and properties of the operators."""

import json
import time

import pytest
from pyspark.sql import functions as F

from gleanframe.operators import charts, elements, evaluate, layers, prose, quality, tables
from gleanframe.plans import batch, report
from gleanframe.schemas import RunParameters, Settings
from gleanframe.sources import files, ledger, parsed, prompts, providers
from gleanframe.sources import tables as stored
from gleanframe.streaming import ingest

TABLE = (
    "<table><tr><th rowspan=2>Region</th><th colspan=2>09 Dec</th></tr><tr><th>WWE</th><th>Prior</th></tr><tr><td colspan=3>ASIA</td></tr>"
    "<tr><td>Japan</td><td>98</td><td>76%</td></tr><tr><td></td><td>1,5</td><td>n/a</td></tr></table>"
)


def test_headings_are_forgotten_on_another_page(spark):
    rows = [("d", 0, "title", "T", 1), ("d", 1, "section_header", "S", None), ("d", 2, "text", "x", 1), ("d", 3, "text", "y", 2), ("d", 4, "text", "z", 1), ("d", 5, "page_footer", "f", 1)]
    out = elements.with_context(spark.createDataFrame(rows, "doc string, pos int, el_type string, content string, page int")).orderBy("pos").collect()
    assert [r.context for r in out] == ["T", "T | S", "T | S", None, None]
    assert len({r.segment for r in out}) == 3


def test_prose(spark):
    df = spark.createDataFrame([(1, "X Account purchased £125m"), (2, "a bare 7 here"), (3, "grew 2 Million"), (4, "15%"), (5, None)], "k int, content string")
    got = {r.k: (r.field_name, r.value, r.unit) for r in prose.prose_values(df).collect()}
    assert got == {1: ("X Account purchased", "£125m", "£m"), 3: ("grew", "2 M", "m")}


def test_figure_text(spark):
    text = "A bar chart titled 'Quarterly Revenue 2025' where Q1 at approximately $12M, Q2 at $15M."
    got = prose.figure_values(spark.createDataFrame([(text,)], "description string")).orderBy("n").collect()
    assert [(r.canonical_metric, r.value) for r in got][1] == ("Quarterly Revenue 2025 | Q2", "$15M")


def test_table_claims(spark):
    df = spark.createDataFrame([("t", TABLE), ("none", "no table"), ("null", None)], "key string, html string")
    got = [(r.canonical_metric, r.value) for r in tables.table_claims(df).orderBy("row", "col").collect()]
    assert got == [("ASIA | Japan | 09 Dec WWE", "98"), ("ASIA | Japan | 09 Dec Prior", "76%"), ("ASIA | Japan | 09 Dec WWE", "1,5")]
    assert "| Region" in tables.markdown(df).first()["markdown"]


def test_slots_drift(spark):
    bars = [(i, "s", "v", float(x)) for i, x in enumerate((10, 14, 21, 50, 55))]
    df = spark.createDataFrame([(bars, [("November 2024", 11.0), ("x", 400.0)])], "bars array<struct<id int, series string, value string, x_center double>>, labels array<struct<text string, x_center double>>")
    assert df.select(charts.means(charts.slots(F.col("bars"), F.lit(8.0))).alias("m")).first()["m"] == [12.0, 21.0, 52.5]
    out = charts.resolved(df).first()
    assert out["status"] == "geometry" and {p["id"]: p["period"] for p in out["periods"]}[4] == "January 2025"


@pytest.mark.parametrize(("label", "wanted"), [("Apr '25", (4, 2025)), ("May-75", (5, 1975)), ("2024-3", (3, 2024)), ("sept.", (9, None)), ("12", None), ("", None)])
def test_label_month(spark, label, wanted):
    got = spark.range(1).select(charts.label_month(F.lit(label)).alias("x")).first()["x"]
    assert (got and tuple(got)) == wanted


def test_axis_without_labels_is_normal(spark):
    df = spark.createDataFrame([([(0, "s", "1", 5.0)], None)], "bars array<struct<id int, series string, value string, x_center double>>, labels array<struct<text string, x_center double>>")
    row = charts.resolved(df).first()
    assert row["status"] == "normal" and row["periods"] == []


def test_two_anchors(spark):
    bars = [(k, "s", "v", 10.0 * k) for k in range(5)]
    rows = [
        (1, bars, [("Oct 2024", 11.0), ("January 2025", 40.0)]), (2, bars, [("Oct", 0.0), (None, 10.0)]), (3, bars, None), (4, [], [("May 2024", 1.0)]), (5, None, None), (6, bars, [("Nov 2024", 0.0), ("Nov 2024", 40.0), ("May", 41.0)]),
    ]
    df = spark.createDataFrame(rows, "k int, bars array<struct<id int, series string, value string, x_center double>>, labels array<struct<text string, x_center double>>")
    got = {r.k: (r.status, [p["period"] for p in r.periods]) for r in charts.anchored(df).collect()}
    assert got[1] == ("geometry", ["September 2024", "Oct 2024", "November 2024", "December 2024", "January 2025"])
    assert got[2] == ("flag", ["Oct", "", "FLAG_REVIEW", "FLAG_REVIEW", "FLAG_REVIEW"])
    assert got[3] == ("flag", ["FLAG_REVIEW"] * 5) and got[4] == ("flag", []) and got[5] == ("flag", [])
    assert got[6][1][0] == "Nov 2024" and got[6][1][4] == "May"  # the last label of a bar wins


def test_messages_without_examples(spark):
    df = spark.range(1).select(prompts.messages(prompts.prompt_of(F.lit("Chart")), F.lit(None).cast(prompts.EXAMPLES), F.lit("i")).alias("m"), prompts.prompt_of(F.lit("photo")).alias("p"))
    row = df.first()
    assert [(m.role, m.image) for m in row.m] == [("system", None), ("user", "i")] and row.m[0].text == prompts.PROMPTS["chart"] and row.p is None


def test_gate_splits_all(spark):
    rows = [("a", 0.1, "parsed"), ("b", 0.1, "llm_estimated"), ("c", 0.9, "parsed"), ("d", None, None)]
    df = spark.createDataFrame(rows, "canonical_metric string, confidence double, citation_tier string")
    clean, review = quality.gated(df, df.where("canonical_metric = 'c'").select("canonical_metric"))
    assert {r.canonical_metric for r in clean.collect()} == {"b", "d"}
    assert {(r.canonical_metric, r.review_reason) for r in review.collect()} == {("a", "low_confidence"), ("c", "conflict")}


@pytest.mark.parametrize(("value", "wanted"), [("Risk Management Overview", False), ("this report shows much of it all", False), ("N/A", True), ("12", True), ("small blue", True), ("", False), (None, False)])
def test_is_measure(spark, value, wanted):
    assert spark.range(1).select(quality.is_measure(F.lit(value).cast("string"), F.lit("x")).alias("m")).first()["m"] is wanted


def test_grounding(spark):
    g = lambda v, s: spark.range(1).select(quality.grounding(F.lit(v), F.lit(s), F.lit(False)).alias("g")).first()["g"]
    assert g("£4,844m", "stood at 4,844") == "grounded" and g("£4,844m", "stood at 4,845") == "ungrounded" and g("Nil", "all NIL") == "grounded"


def test_appending_twice_adds_nothing(spark, tmp_path):
    df = spark.createDataFrame([("d", 1, "v", "t", "r"), ("d", 2, "v", "t", "r")], "doc string, pos int, value string, team string, report_type string")
    rows = layers.stamped(df, {}, ("doc", "value"))
    assert layers.append(rows, str(tmp_path / "x")) == 1 and layers.append(rows, str(tmp_path / "x")) == 0
    more = rows.withColumns({"content_hash": F.lit("new"), "extra": F.lit("e")})
    assert layers.append(more, str(tmp_path / "x")) == 1 and "extra" in stored.stored(spark, str(tmp_path / "x")).columns


def test_greedy_matching_uses_a_claim_once(spark):
    truth = spark.createDataFrame([(1, "D.pdf", 1, "table", "net x", "5", "yes"), (2, "d", 1, "table", "net x", "5", "yes"), (3, "d", 1, "", "net x", "5", "no")], "truth_no int, document string, page int, element_type string, field_name string, value string, should_extract string")
    claims = spark.createDataFrame([(1, "d.pptx", 1, "net x", None, "5")], "claim_no int, source_document string, page int, field_name string, canonical_metric string, value string")
    got = {r.truth_no: r.outcome for r in evaluate.matched(truth, claims).collect()}
    assert got == {1: "TP", 2: "FN", 3: "FP"}
    total = evaluate.confusion(evaluate.matched(truth, claims)).where("element_type is null").first()
    assert (total.tp, total.fn, total.fp, total.tn) == (1, 1, 1, 0) and total.precision == 0.5


def test_a_run_reproduces_itself(spark):
    df = spark.createDataFrame([("d", 1, "x", None, "table", "5"), ("d", 1, "x", None, "table", "5"), ("d", 2, "y", "z", "figure", "7")], "source_document string, page int, field_name string, canonical_metric string, element_type string, value string")
    assert {r.reproducibility for r in evaluate.reproducibility(df, df).collect()} == {1.0}
    assert "reproducibility" in report.as_text(evaluate.reproducibility(df, df), "runs")


def test_unreadable_responses_have_no_elements(spark):
    rows = [("a", json.dumps({"document": {"elements": [{"type": "TEXT", "content": "x"}, {"type": "odd"}]}})), ("b", "{broken"), ("c", None), ("d", "{}")]
    out = parsed.elements(spark.createDataFrame(rows, "doc string, response string")).orderBy("pos").collect()
    assert [(r.doc, r.el_type) for r in out] == [("a", "text"), ("a", "odd")]


def test_batch_runs_twice_and_quarantines(spark, tmp_path):
    place = tmp_path / "in/team/rep/Acme  Corp/E1/main"
    place.mkdir(parents=True)
    elements_ = [{"type": "title", "content": "Results", "bbox": [{"page_id": 1}]}, {"type": "text", "content": "Profit was £5m", "bbox": [{"page_id": 1}]}, {"type": "table", "content": TABLE, "bbox": [{"page_id": 1}]}]
    (place / "A_March_2024.json").write_text(json.dumps({"document": {"elements": elements_}}))
    (place / "bad.json").write_text("{")
    first = batch.run_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert first["silver"] == 4 and first["quarantine"] == 1 and first["chunks"] == 3 and (first["bronze"], first["review"], first["audit"]) == (3, 0, 1)
    markdown = [r.content for r in stored.stored(spark, str(tmp_path / "out/chunks")).collect() if r.content.startswith("|")]
    assert len(markdown) == 1 and "| --- |" in markdown[0]
    totals = batch.batch_totals(spark, str(tmp_path / "out"))
    got = {}
    rows = {r.metric: r.value for r in batch.run_metrics(totals, "run 1", lambda run, m: got.update(m)).collect()}
    assert rows == got and (rows["documents"], rows["pages"], rows["claims"], rows["quarantined"], rows["indexed"], rows["review"]) == (1, 1, 4, 1, 3, 0)
    assert not any(batch.run_batch(spark, str(tmp_path / "in"), str(tmp_path / "out")).values())
    gold = stored.stored(spark, str(tmp_path / "out/gold"))
    assert {r.report_date for r in gold.collect()} == {"March 2024"} and gold.first()["entity_ref"] == "Acme Corp"


def test_append_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "doc string, pos int, value string, team string, report_type string, content_hash string")
    path = str(tmp_path / "x")
    assert layers.append(none, path) == 0 and layers.append(none, path) == 0 and layers.stored_rows(spark, path) is None
    rows = spark.createDataFrame([("d", 1, "v", "t", "r", "h"), ("d", 2, "w", None, "r", "i"), ("d", 3, "w", "u", "r", None)], none.schema)
    assert layers.append(rows, path) == 3 and layers.append(rows, path) == 0 and layers.append(none, path) == 0
    assert layers.append(rows.where("pos = 1").withColumn("content_hash", F.lit("new")), path) == 1 and layers.stored_rows(spark, path).count() == 4


def test_batch_of_tables_without_numbers_and_read_figures(spark, tmp_path):
    place = tmp_path / "in/team/rep/Acme/E1/main"
    place.mkdir(parents=True)
    listed = [{"type": "table", "content": "<table><tr><td>only words</td></tr></table>", "bbox": [{"page_id": 1}]}, {"type": "figure", "content": "", "description": "", "bbox": [{"page_id": 2}]}, {"type": "figure", "content": "", "description": "Sales titled 'S' reached 7%", "bbox": [{"page_id": 2}]}]
    (place / "A.json").write_text(json.dumps({"document": {"elements": listed, "pages": [{"id": 1, "image_uri": "i1"}, {"id": 2, "image_uri": "i2"}]}}))
    doc = str(place / "A.json")
    answer = json.dumps([{"field_name": "Profit", "value": "12", "unit": "%", "source_type": "chart"}])
    got = batch.run_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"), read=providers.Replay({(doc, 1): answer, (doc, 2): "[]"}))
    silver = {(int(r.pos), r.field_name, r.value) for r in stored.stored(spark, str(tmp_path / "out/silver")).collect()}
    assert got["silver"] == 3 and silver == {(0, "table", "<table><tr><td>only words</td></tr></table>"), (1, "Profit", "12"), (2, "Sales titled 'S'", "7%")}, silver
    assert ledger.recorded(spark, str(tmp_path / "out/answers")).count() == 3


def test_one_long_text_takes_linear_time(spark):
    def seconds(n):
        df = spark.createDataFrame([(" ".join(f"metric {k} was £{k}m, and" for k in range(n)),)], "content string")
        began = time.monotonic()
        rows = prose.prose_values(df).collect()
        figures = prose.figure_values(df.withColumnRenamed("content", "description")).collect()
        assert len(rows) == len(figures) == n and rows[-1]["field_name"].endswith(f"metric {n - 1} was") and figures[-1]["field_name"] == f"metric {n - 1}"
        return time.monotonic() - began

    seconds(50)
    assert seconds(2000) < 20


def test_spans_are_bounded(spark):
    html = "<table><tr><td colspan=1000000000 rowspan=999999999>a</td></tr><tr><td>5</td></tr></table>"
    assert max(c for _, c, _, _ in tables.grid_of(html)) <= 1000


def test_images_by_time(spark):
    rows = [("/a/p2.png", 20), ("/a/p1.JPG", 30), ("/a/x.txt", 10), ("/b/q.png", 5), ("/a/p0.png", 20)]
    df = spark.createDataFrame(rows, "path string, t int").select("path", F.timestamp_seconds("t").alias("modified"))
    assert sorted((r.path, r.place) for r in files.images_by_time(df).collect()) == [("/a/p0.png", 0), ("/a/p1.JPG", 2), ("/a/p2.png", 1), ("/b/q.png", 0)]


def test_submissions_by_path(spark, tmp_path):
    for name in ("c", "a", "b"):
        place = tmp_path / f"team/rep/Ent  {name}/E/main"
        place.mkdir(parents=True)
        (place / f"{name}.bin").write_bytes(name.encode())
    got = files.submissions(spark, str(tmp_path), 2).collect()
    assert {(bytes(r.content), r.entity_ref) for r in got} == {(b"a", "Ent a"), (b"b", "Ent b")}
    assert files.submissions(spark, str(tmp_path)).count() == 3 and files.submissions(spark, str(tmp_path / "none")).count() == 0


def test_model_reads_with_retries(spark, tmp_path):
    df = spark.createDataFrame([("d", 1), ("d", 2)], "doc string, pos int")
    got = {r.pos: (r.raw, r.error is None) for r in providers.read_by_model(df, providers.Replay({("d", 1): "[]"}), str(tmp_path / "a"), attempts=2, first_delay=0.0).collect()}
    assert got == {1: ("[]", True), 2: (None, False)}


def test_stream_ends_and_resumes(spark, tmp_path):
    src, seen = str(tmp_path / "src"), []
    spark.createDataFrame([(1,)], "a int").write.parquet(src)
    run = lambda: ingest.ingest_available(spark, src, "a int", lambda df, n: seen.extend(r.a for r in df.collect()), str(tmp_path / "ck"))
    run()
    run()
    assert seen == [1]


def test_parameters():
    assert RunParameters("/volumes/a/b/c/d", " run_ ").checked().prefix == "run_"
    with pytest.raises(ValueError):
        RunParameters("/tmp/x", "p").checked()
    with pytest.raises(ValueError):
        RunParameters("/volumes/a/b/c/d", "p").checked({"p_"})
    assert Settings().table_name("gold", "Team A", "LCR") == "prod_gold_team_a_lcr"


def test_simple_markup_is_cut_as_the_parser_does(spark):
    import random

    rng = random.Random(5)
    span = lambda: rng.choice(["", "", "", " colspan=2", " rowspan='3'", ' colspan="0" rowspan=2', " colspan=99999"])
    cell = lambda: f"<{(t := rng.choice(['td', 'th']))}{span()}>{rng.choice(['', 'Row  1', '£5m', '7 &gt; 5', 'a > b', chr(160) + '3'])}</{t}>"
    for _ in range(300):
        html = "<table>" + "".join("<tr>" + "".join(cell() for _ in range(rng.randint(0, 4))) + "</tr>" for _ in range(rng.randint(0, 5))) + "</table>"
        assert tables._SIMPLE.fullmatch(html)
        parser = tables._Cells()
        parser.feed(html)
        parser.close()
        assert tables._parsed(html) == parser.rows
    for odd in ("<table><tr><td>1<td>2</tr></table>", "<tr><td>1</th></tr>", "<table><tr><td class=x>1</td></tr></table>", "<TABLE><tr></tr></TABLE>", "x"):
        assert not tables._SIMPLE.fullmatch(odd)
    df = spark.createDataFrame([(1, "<table><tr><th>A</th><th>B</th></tr><tr><td>r</td><td>5</td></tr></table>"), (2, None)], "key int, html string")
    whole = tables.read_tables(df, "key", "html").collect()
    assert [len(r.claims) for r in whole] == [1, 0]
    assert [(r.key, r.markdown, len(r.claims)) for r in tables.read_tables(df, "key", "html", claim=False).collect()] == [(r.key, r.markdown, 0) for r in whole]
