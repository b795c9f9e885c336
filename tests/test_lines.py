"""Lines are grouped in tasks whose size doesn't grow with the input."""

from gleanframe.plans import catalog


def test_lines_are_dealt_by_order_and_sorted_once(spark, monkeypatch):
    monkeypatch.setattr(catalog, "LINES_A_TASK", 1000)
    lines = catalog.frame(spark, "/root/testdata/sf0.001", catalog.LINES)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1
    assert "REPARTITION_BY_NUM" in plan and lines.rdd.getNumPartitions() == 6
