"""All training-data queries at the smallest size against their contracts' columns, and what they leave behind."""

import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gleanframe.llm import common, linefreq, minhash, queries

SF = "/root/testdata/sf0.001"
CONTRACT = {
    "op1": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op2": "doc_id bigint, held_out boolean, lang_pred string, score double", "op3": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op4": "doc_id bigint, source string, n_lines bigint, n_dropped bigint, text_sha256 string",
    "op5": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op6": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op7": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op8": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op9": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op10": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op11": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op12": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
    "op13": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
}


def left_behind(spark):
    place = common.shared_dir(spark).removeprefix("file:").replace("//", "/") + "/gleanframe"
    return set(os.listdir(place)) if os.path.isdir(place) else set()


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query_keeps_its_contract(spark, name):
    before = left_behind(spark)
    out = queries.QUERIES[name](spark, SF)
    columns = dict(out.dtypes)
    wanted = dict(x.split(" ") for x in CONTRACT[name.split("_")[0]].split(", "))
    assert {c: columns.get(c) for c in wanted} == wanted
    rows = out.collect()
    table = spark.read.parquet(f"{SF}/{'pages' if name.startswith('op5') else 'documents'}.parquet")
    key = table.columns[0]
    ids = sorted(r[0] for r in table.select(key).collect())
    assert sorted({r[key] for r in rows}) == ids and (name.startswith("op9") or len(rows) == len(ids))
    folds = {"op2": (4, 2), "op7": (7, 2)}.get(name.split("_")[0])
    if folds:
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds[0] == folds[1]) for r in rows)
    left = left_behind(spark) - before
    assert len(left) <= 1, left  # the result alone


def test_a_failed_operator_leaves_nothing(spark):
    @common.operator
    def fails(df):
        common.staged(df, "some")
        raise ValueError("no")

    before = left_behind(spark)
    with pytest.raises(ValueError, match="no"):
        fails(spark.range(3))
    assert left_behind(spark) == before


def test_pipeline_over_no_documents(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 9, 10, 11, 30])
def test_small_hosts(spark, n):
    rows = [(k, f"menu\nown {k}", "h") for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    alone = {r.text for r in linefreq.without_boilerplate(df).collect()}
    assert alone == ({""} if n < 10 else {f"own {k}" for k in range(n)})  # 1 of 9 pages is over 10 %, 1 of 10 is not
    others = {r.text for r in linefreq.without_boilerplate(df, others=True).collect()}
    assert others == ({"menu\nown 0"} if n == 1 else {f"own {k}" for k in range(n)})


@pytest.mark.parametrize("percent", [80, 85])
def test_prefix_pairs_are_complete(spark, percent):
    rng = random.Random(percent)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.choice((12, 40, 41, 47, 50, 120)))] for _ in range(12)]
    rows = []
    for k in range(160):
        w = list(rng.choice(base))
        for _ in range(rng.choice((0, 1, 1, 2))):
            w[rng.randrange(len(w))] = f"x{rng.randrange(30)}"
        rows.append((k, k % 5 if k % 3 else 1000, " ".join(w[: len(w) - rng.choice((0, 0, 1, 4))])))
    shingles = lambda t: {tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))}
    sets = {k: shingles(t) for k, _, t in rows}
    want = {(a, b) for a, ca, _ in rows for b, cb, _ in rows if a < b and ca != cb and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    got = {(r.a, r.b) for r in minhash.prefix_pairs(spark.createDataFrame(rows, "id long, component long, text string").repartition(3), 5, percent).collect()}
    assert len(want) > 40 and want <= got


def test_template_texts_do_not_meet(spark):
    template = [f"t{k}" for k in range(60)]
    n = 3000
    rows = spark.range(n).select("id", F.col("id").alias("component"), F.concat_ws(" ", *[F.lit(x) for x in template[:20]], F.concat(F.lit("a"), "id"), *[F.lit(x) for x in template[20:40]], F.concat(F.lit("b"), "id"), *[F.lit(x) for x in template[40:]]).alias("text"))
    pairs = minhash.prefix_pairs(rows, 5, 85)
    assert pairs.count() == 0
