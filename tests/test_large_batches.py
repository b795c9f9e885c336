"""What keeps a task's work from growing with the input: how keys and whole rows are dealt."""

import pytest
from pyspark.sql import functions as F

from gleanframe.operators import batches, layers

COLUMNS = "doc string, pos int, content_hash string, team string, report_type string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_deal_keys_by_block(spark, monkeypatch):
    monkeypatch.setattr(batches, "KEYS_A_TASK", 1000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = spark.range(3500).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.when(F.col("id") % 3 == 0, "a").alias("team"))
        seen = batches.filters(keys, "k", ("team",))
        plan = plan_of(seen)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # keys aren't dealt by folder
        before_bits = plan[plan.index("Generate explode"):]  # what the bits of a key are made from
        assert ", 4), REPARTITION_BY_NUM" in before_bits
        assert batches.possible(keys, "k", seen, ("team",)).count() == 3500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("often", [50, 2])
@pytest.mark.parametrize("as_many", [0, 2])
def test_appended_rows_are_dealt_once(spark, tmp_path, monkeypatch, as_many, often):
    monkeypatch.setattr(batches, "AS_MANY", as_many)
    monkeypatch.setattr(batches, "LOOKED_AT", 1.0)
    monkeypatch.setattr(batches, "OFTEN", often)
    sorted_first, new_rows = [], layers.new_rows
    monkeypatch.setattr(layers, "new_rows", lambda rows, held, key, order, copies: sorted_first.append((copies, plan_of(new_rows(rows, held, key, order, copies)))) or new_rows(rows, held, key, order, copies))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame([("d", k, f"h{k % 60}", f"t{k % 2}", "r") for k in range(120)], COLUMNS)
        path = str(tmp_path / "lake/x")
        assert layers.append(rows.where("pos < 7"), path) == 7
        assert layers.append(rows.unionByName(rows), path) == 53 and layers.append(rows, path) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = layers.stored_rows(spark, path).collect()
    assert sorted(r.content_hash for r in got) == sorted(f"h{k}" for k in range(60))
    copies, plan = sorted_first[1]
    assert copies == (often == 2) and ("WindowGroupLimit" in plan) == copies
    # whole rows once, the stored keys and, where filters were asked, the keys that they let through
    assert plan.count("Exchange hashpartitioning(content_hash") == (3 if as_many == 0 else 2)
