"""Ledger, atomic batches, pruned appends, file streams and page counts."""

import io
import json
import os
import random
import sys
import zipfile
import zlib

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from gleanframe.operators import batches, evaluate, layers
from gleanframe.plans import batch
from gleanframe.sources import ledger, parsed, rawpages
from gleanframe.sources import tables as stored
from gleanframe.streaming import ingest

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors can't import tests

TABLE = "<table><tr><th>Region</th><th>Dec</th></tr><tr><td>Japan</td><td>98</td></tr></table>"


class Counted:
    """A parser and a model that leave a mark for each call."""

    def __init__(self, folder, broken=()):
        self.folder, self.broken = str(folder), broken
        os.makedirs(self.folder, exist_ok=True)

    def _mark(self, what):
        with open(f"{self.folder}/calls", "a") as f:
            f.write(what + "\n")

    def calls(self):
        try:
            with open(f"{self.folder}/calls") as f:
                return f.read().split()
        except FileNotFoundError:
            return []

    def __call__(self, path, content, options=None):
        self._mark("parse")
        if options and options.get("fail"):
            raise ValueError("as told")
        return content.decode()

    async def read(self, row):
        self._mark("read")
        return json.dumps([{"field_name": "Profit", "value": "12", "unit": "%"}])


def submit(root, name, text="Profit was £5m", team="team"):
    place = root / f"{team}/rep/Acme/E1/main"
    place.mkdir(parents=True, exist_ok=True)
    listed = [{"type": "text", "content": text, "bbox": [{"page_id": 1}]}, {"type": "table", "content": TABLE, "bbox": [{"page_id": 1}]}, {"type": "figure", "content": "", "description": "", "bbox": [{"page_id": 2}]}]
    (place / name).write_text(json.dumps({"document": {"elements": listed}}))


def test_a_second_run_asks_nothing(spark, tmp_path, monkeypatch):
    for k in range(6):
        submit(tmp_path / "in", f"d{k}.json", f"Profit was £{k}m")
    submit(tmp_path / "in", "copy.json", "Profit was £0m")
    p = Counted(tmp_path / "marks")
    first = batch.run_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"), p, read=p.read)
    calls = p.calls()
    assert calls.count("parse") == 6 and calls.count("read") == 7 and first["bronze"] == 21 and first["gold"] > 0
    again = batch.run_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"), p, read=p.read)
    assert not any(again.values()) and p.calls() == calls
    submit(tmp_path / "in", "new.json", "Profit was £77m")
    more = batch.run_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"), p, read=p.read)
    assert more["bronze"] == 3 and len(p.calls()) == len(calls) + 2
    # other options are other questions
    batch.run_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"), p, options={"v": 2})
    assert len(p.calls()) == len(calls) + 2 + 7


def test_each_table_is_cut_once(spark, tmp_path):
    for k in range(3):
        submit(tmp_path / "in", f"d{k}.json")

    from gleanframe.operators import tables

    once, seen = tables.read_tables, []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(tables, "read_tables", lambda *a, **b: (seen.append(a), once(*a, **b))[1])
        batch.run_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert len(seen) == 1  # and what it gives is written


def test_a_killed_task_asks_only_what_is_not_recorded(spark, tmp_path):
    marks = tmp_path / "marks"
    marks.mkdir()

    def answer(rows):
        out = []
        for x in rows:
            if x["n"] == 37 and not os.path.exists(f"{marks}/died"):
                open(f"{marks}/died", "w").close()
                raise RuntimeError("lost")
            with open(f"{marks}/calls", "a") as f:
                f.write(f"{x['n']}\n")
            out.append((None, "no") if x["n"] % 10 == 9 else (str(x["n"]), None))
        return out

    asked = spark.range(40).select(F.col("id").alias("n"), ledger.question(F.col("id")).alias("key"))
    asked = asked.union(asked.where("n = 5"))
    with pytest.raises(Exception, match="lost"):
        ledger.ask(asked, str(tmp_path / "ledger"), answer, segment=1)
    before = (marks / "calls").read_text().split()
    out = ledger.answered(asked, str(tmp_path / "ledger"), answer, segment=1).collect()
    calls = (marks / "calls").read_text().split()
    assert sorted(map(int, calls)) == list(range(40)) and len(calls) == len(set(calls)) and before
    assert len(out) == 41 and all((r.raw == str(r.n)) if r.n % 10 != 9 else (r.raw is None and r.error == "no") for r in out)
    assert ledger.ask(asked, str(tmp_path / "ledger"), answer) == 0 and ledger.ask(asked, str(tmp_path / "ledger"), answer, retry_failed=True) == 4
    assert ledger.compacted(spark, str(tmp_path / "ledger"), str(tmp_path / "few")).count() == 40


def rows_of(spark, rows, columns="doc string, pos int, content_hash string, team string, report_type string"):
    return spark.createDataFrame(rows, columns)


def test_appends_read_only_their_folders(spark, tmp_path):
    path = str(tmp_path / "lake/x")
    for t in range(5):
        layers.append(rows_of(spark, [("d", k, f"{t}-{k}", f"t{t}", "r") for k in range(30)]), path)
    known = batches.commits(spark, str(tmp_path / "lake"))
    mine = batches.in_folders(batches._stored(spark, path, known), [("t1", "r")], ("team", "report_type"))
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(team" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {f.split("team=")[1].split("/")[0] for f in (r[0] for r in mine.select(F.input_file_name()).distinct().collect())} == {"t1"}
    # what is stored elsewhere doesn't count, what is stored here does
    more = rows_of(spark, [("d", 1, "0-1", "t1", "r"), ("d", 2, "1-2", "t1", "r"), ("d", 3, "new", "t1", "r"), ("d", 4, "new", "t1", "r"), ("d", 5, "n", None, "r")])
    assert layers.append(more, path) == 3 and layers.append(more, path) == 0 and layers.stored_rows(spark, path).count() == 153
    extra = rows_of(spark, [("d", 1, "e", "t1", "r", 5)], "doc string, pos int, content_hash string, team string, report_type string, page int")
    assert layers.append(extra, path) == 1 and stored.stored(spark, path).where("page = 5").count() == 1


@pytest.mark.parametrize("n", [1, 3000, 60000])
def test_filters_have_no_false_negatives(spark, n):
    keys = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.when(F.col("id") % 3 == 0, "a").alias("team"))
    seen = batches.filters(keys, "k", ("team",))
    assert batches.possible(keys, "k", seen, ("team",)).count() == n
    others = spark.range(n, n + 3000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.when(F.col("id") % 3 == 0, "a").alias("team"))
    assert batches.possible(others, "k", seen, ("team",)).count() < 60
    whole = batches.filters(keys.drop("team"), "k", ())
    assert batches.possible(keys, "k", whole, ()).count() == n and batches.possible(others, "k", whole, ()).count() < 60
    assert batches.possible(keys.where("team = 'a'").withColumn("team", F.lit("z")), "k", seen, ("team",)).count() == 0


def test_layers_without_folders(spark, tmp_path):
    rows = rows_of(spark, [("d", 1, "a", "t", "r"), ("d", 2, "b", "t", "r")])
    for wanted in (2, 0):
        with batches.Batch(spark, str(tmp_path / "lake")) as b:
            assert b.append(rows, "x", by=()) == wanted
    assert layers.stored_rows(spark, str(tmp_path / "lake/x")).count() == 2


def test_half_a_batch_is_not_seen(spark, tmp_path):
    out, by = str(tmp_path / "lake"), rows_of(spark, [("d", 1, "h", "t", "r")])
    with pytest.raises(RuntimeError, match="between"), batches.Batch(spark, out, "one") as b:
        assert b.append(by, "silver") == 1
        raise RuntimeError("between silver and gold")
    assert layers.stored_rows(spark, f"{out}/silver") is None
    with batches.Batch(spark, out, "one") as b:
        assert b.append(by, "silver") == 1 and b.append(by, "gold") == 1
    assert layers.stored_rows(spark, f"{out}/silver").count() == 1 and layers.stored_rows(spark, f"{out}/gold").count() == 1
    with batches.Batch(spark, out, "one") as b:
        assert b.done and b.append(by.withColumn("content_hash", F.lit("other")), "silver") == 0
    assert batches.vacuum(spark, out, "silver") == 2 and layers.stored_rows(spark, f"{out}/silver").count() == 1


def test_a_stream_of_files_takes_new_ones_and_restarts(spark, tmp_path):
    p, root, out, ck = Counted(tmp_path / "marks"), tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    submit(root, "a.json", "Profit was £1m")
    assert [x["bronze"] for x in ingest.ingest_files(spark, str(root), out, ck, parse=p)] == [3] and len(p.calls()) == 1
    assert ingest.ingest_files(spark, str(root), out, ck, parse=p) == []
    submit(root, "b.json", "Profit was £2m")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(batches.Batch, "commit", lambda self: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            ingest.ingest_files(spark, str(root), out, ck, parse=p)
    assert layers.stored_rows(spark, f"{out}/bronze").count() == 3 and len(p.calls()) == 2
    assert [x["bronze"] for x in ingest.ingest_files(spark, str(root), out, ck, parse=p)] == [3]
    assert layers.stored_rows(spark, f"{out}/bronze").count() == 6 and len(p.calls()) == 2


# page counts

def pptx(slides, listed=True):
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w") as z:
        ids = "".join(f'<p:sldId id="{256 + k}" r:id="rId{k}"/>' for k in range(slides)) if listed else ""
        z.writestr("ppt/presentation.xml", f"<p:presentation><p:sldIdLst>{ids}</p:sldIdLst></p:presentation>")
        for k in range(slides):
            z.writestr(f"ppt/slides/slide{k + 1}.xml", "<x/>")
        z.writestr("ppt/slides/_rels/slide1.xml.rels", "<x/>")
    return f.getvalue()


def pdf(pages, fanout=3, packed=False):
    """A PDF with a tree of pages; ``packed``: objects in a stream, cross-references as a stream with a predictor."""
    objects, counts = {}, {}

    def tree(n, parent):
        k = len(objects) + 3
        objects[k] = b""
        if n <= fanout:
            kids = []
            for _ in range(n):
                x = len(objects) + 3
                objects[x] = b"<< /Type /Page /Parent %d 0 R >>" % k
                kids.append(x)
        else:
            sizes = [n // 2, n - n // 2]
            kids = [tree(s, k) for s in sizes]
        objects[k] = b"<< /Type /Pages /Kids [%s] /Count %d >>" % (b" ".join(b"%d 0 R" % x for x in kids), n)
        counts[k] = n
        return k

    top = tree(pages, None)
    objects[1] = b"<< /Type /Catalog /Pages %d 0 R >>" % top
    body, places = bytearray(b"%PDF-1.7\n"), {}
    if not packed:
        for k, x in sorted(objects.items()):
            places[k] = len(body)
            body += b"%d 0 obj\n%s\nendobj\n" % (k, x)
        start, last = len(body), max(objects) + 1
        body += b"xref\n0 %d\n0000000000 65535 f \n" % last
        for k in range(1, last):
            body += b"%010d 00000 n \n" % places[k] if k in places else b"0000000000 00000 f \n"
        body += b"trailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (last, start)
        return bytes(body)
    numbers, text, pairs = sorted(objects), b"", []
    for k in numbers:
        pairs += [k, len(text)]
        text += objects[k] + b" "
    head = b" ".join(b"%d" % x for x in pairs) + b" "
    data = zlib.compress(head + text)
    holder = max(objects) + 1
    at = len(body)
    body += b"%d 0 obj\n<< /Type /ObjStm /N %d /First %d /Length %d /Filter /FlateDecode >>\nstream\n" % (holder, len(numbers), len(head), len(data)) + data + b"\nendstream\nendobj\n"
    start, rows = len(body), []
    for k in range(holder + 2):
        entry = (2, holder, numbers.index(k)) if k in objects else (1, at, 0) if k == holder else (1, start, 0) if k == holder + 1 else (0, 0, 0)
        rows.append(bytes([entry[0]]) + entry[1].to_bytes(4, "big") + entry[2].to_bytes(2, "big"))
    before, filtered = bytes(7), b""
    for r in rows:
        filtered += b"\x02" + bytes((a - b) & 255 for a, b in zip(r, before, strict=True))
        before = r
    data = zlib.compress(filtered)
    body += b"%d 0 obj\n<< /Type /XRef /Size %d /W [1 4 2] /Root 1 0 R /Filter /FlateDecode /DecodeParms << /Predictor 12 /Columns 7 >> /Length %d >>\nstream\n" % (holder + 1, holder + 2, len(data)) + data
    return bytes(body + b"\nendstream\nendobj\nstartxref\n%d\n%%%%EOF" % start)


def test_page_counts(spark, tmp_path):
    for n in (1, 2, 3, 4, 17, 200):
        assert rawpages.page_count("x.PDF", pdf(n)) == n and rawpages.page_count("x.pdf", pdf(n, packed=True)) == n
        assert rawpages.page_count("x.pptx", pptx(n)) == n and rawpages.page_count("x.potx", pptx(n, False)) == n
    assert rawpages.page_count("x.pdf", pdf(5).replace(b"startxref\n", b"startxref\n9")) == 5  # found by looking for it
    for bad in (b"", b"%PDF-1.7", pdf(5)[:200], os.urandom(300), None):
        assert rawpages.page_count("x.pdf", bad) is None and rawpages.page_count("x.pptx", bad) is None
    assert rawpages.page_count("x.json", b"{}") is None
    files = spark.createDataFrame([("/in/a_b.PPTX", bytearray(pptx(4))), ("/in/c.pdf", bytearray(pdf(3))), ("/in/d.pdf", None), ("/in/e.txt", bytearray(b"x"))], "path string, content binary")
    got = {r.document: r.total_pages for r in rawpages.page_counts(files).collect()}
    assert got == {"a_b": 4, "c": 3, "d": None, "e.txt": None}
    chunks = spark.createDataFrame([("A_b.pptx", 1), ("A_b.pptx", 2), ("c.pdf", 3)], "source_document string, page int")
    cover = {r.document: r.pages_processed for r in evaluate.page_coverage(chunks, rawpages.page_counts(files).where("total_pages is not null")).collect()}
    assert cover == {"a_b": 2, "c": 1, None: 3}


def test_damaged_pdfs_fail_nothing():
    rng = random.Random(1)
    whole = pdf(9, packed=True)
    for _ in range(300):
        x = bytearray(whole)
        for _ in range(rng.randint(1, 30)):
            x[rng.randrange(len(x))] = rng.randrange(256)
        n = rawpages.page_count("x.pdf", bytes(x))
        assert n is None or isinstance(n, int)


def test_images_of_pages(spark):
    images = [("a", 0, 1, "p1"), ("a", 1, 6, "p6"), ("a", 2, 6, "again"), ("a", 3, 9, None), ("b", 0, None, "b0"), ("b", 1, None, "b1")]
    wanted = [("a", 1), ("a", 2), ("a", 6), ("a", 7), ("a", 8), ("a", 9), ("a", None), ("b", 0), ("b", 1), ("b", 2), ("c", 2), ("c", 9), ("a", 6)]
    files = [("c", 0, "t0"), ("c", 1, "t1"), ("a", 7, "t7")]
    df = lambda rows, s: spark.createDataFrame(rows, s)
    got = parsed.page_images(df(wanted, "doc string, page int"), df(images, "doc string, pos int, page int, image_uri string"), df(files, "doc string, place int, path string"))
    rows = sorted(((r.doc, r.page, r.image_uri) for r in got.collect()), key=str)
    assert rows == sorted([("a", 1, "p1"), ("a", 2, "p1"), ("a", 6, "p6"), ("a", 6, "p6"), ("a", 7, "p6"), ("a", 8, "t7"), ("a", 9, None), ("a", None, None), ("b", 0, "b0"), ("b", 1, "b1"), ("b", 2, "b1"), ("c", 2, "t1"), ("c", 9, None)], key=str)


def test_audit_counts_and_bounds(spark):
    rows = [("d", k, ("text", "table", "page_footer", None)[k % 4], None if k % 11 == 0 else k % 7, False) for k in range(900)] + [("e", 0, "text", 1, False)]
    claims = [("d", p) for p in (1, 1, 3, None)]
    df = spark.createDataFrame(rows, "doc string, pos int, el_type string, page int, ornament boolean")
    audit = evaluate.coverage_audit(df, spark.createDataFrame(claims, "doc string, page int"), 50)
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert "50, Partial" in plan and "50, Final" in plan  # limits before and after the shuffle
    got = {r.doc: r for r in audit.collect()}
    d = got["d"]
    lost = [k for k, r in enumerate(rows[:900]) if r[2] != "page_footer" and r[3] not in (1, 3, None)]
    assert [g.pos for g in d.gap_sample] == lost[:50] and d.elements_unaccounted == len(lost)
    assert d.elements_by_type == {"text": 225, "table": 225, "page_footer": 225, "": 225} and d.claims_by_page == {1: 2, 3: 1} and d.claims_total == 4
    assert (got["e"].claims_total, got["e"].claims_by_page, len(got["e"].gap_sample)) == (0, {}, 1)


def test_small_sources(spark, tmp_path):
    (tmp_path / "t.csv").write_text("﻿Document , PAGE,value\nd.pdf,3.0,5\nd.pdf,x,6\n", encoding="utf-8")
    assert [(r.document, r.page, r.value) for r in stored.ground_truth(spark, str(tmp_path / "t.csv")).collect()] == [("d.pdf", 3, "5"), ("d.pdf", None, "6")]
    (tmp_path / "x.jsonl").write_text('{"a": 1, "b": "x"}\n{"a": 2}\nbroken\n')
    got = stored.json_lines(spark, str(tmp_path / "x.jsonl"), "a int, b string").orderBy("a").collect()
    assert [(r.a, r.b) for r in got] == [(None, None), (1, "x"), (2, None)]
    for name in ("prod_gold_a", "prod_gold_b", "other"):
        spark.range(1).createOrReplaceTempView(name)
    assert stored.table_names(spark, "prod_gold_*") == ["prod_gold_a", "prod_gold_b"] and stored.table_names(spark, "x' or '1'='1") == []
