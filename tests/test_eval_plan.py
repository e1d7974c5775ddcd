"""The evaluation tags every chunk once, with both dictionaries."""

from spanforge.plans.queries import eval_rows

SF = "/root/testdata/sf0.001"


def test_evaluation_joins_no_text(spark):
    rows = eval_rows(spark, SF)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == plan.count("Join") >= 1  # the dictionary's
    assert plan.count("hashpartitioning(doc_id") == 1 or plan.count("Exchange hashpartitioning") <= 3
    got = rows.collect()
    assert got and all(len(r.tokens) == len(r.gold) == len(r.pred) for r in got) and any(r.gold != r.pred for r in got)
