"""Round 5: blocks of vectors are never collected on the driver."""

import random

import pytest

pytest.importorskip("pyarrow")

from skein.llm import topk  # noqa: E402


def test_repeated_query_blocks_are_not_broadcast(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = topk.top_k(df.where("vec_id % 10 = 0"), df, k=3)
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in out.collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    whole = {i: [int(x * 256 // 1) for x in v] for i, v in rows}
    for q in range(0, 60, 10):
        best = sorted((-sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in whole if c != q)[:3]
        assert [(q, n + 1, c) for n, (_, c) in enumerate(best)] == [g for g in got if g[0] == q]
