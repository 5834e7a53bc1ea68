"""Round 5: what is exchanged and stored by the passes over many metrics."""

import re

from pyspark.sql import functions as F

from skein.operators import aggregate as A
from skein.operators import opponent as O
from skein.operators import running as R
from skein.operators import windows as W
from tests.conftest import rows

ORDER = ["day", "match", "who"]


def _matches(spark, n=60):
    data = [(m % 9 if m % 13 else None, m, w, float(m % 5), float(m % 7 * w), float(m % 4 + w), 0.25 * m if m % 6 else None) for m in range(n) for w in (0, 1)]
    return spark.createDataFrame([(None if d is None else int(d), m, (m + 3 * w) % 8, k, a, b, f) for d, m, w, k, a, b, f in data],
                                 "day int, match long, who long, kd double, head_landed double, head_attempted double, f double")


METRICS = ["kd", "head_landed", "head_attempted", "f", "head_accuracy"]


def _exchanged(df):
    """The columns under the last exchange by participant."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "Window" in line)
    return "\n".join(lines[at:])


def test_no_copy_of_a_double_is_exchanged(spark):
    out = R.running(_matches(spark), "who", ORDER, [R.cum_sum("s", F.col("kd")), R.cum_sum_before("b", "s", F.col("kd")), R.cum_sum("t", F.col("kd") * 2.0)])
    below = _exchanged(out)
    assert len(set(re.findall(r"_rk_x\d+", below))) == 1  # that of the product


def test_late_metrics_are_not_exchanged_and_equal(spark, monkeypatch):
    df = _matches(spark).localCheckpoint()
    for limit in (50_000, 5):  # without and with hot keys
        for strategy in ("chunked", "window"):
            monkeypatch.setattr(R, "CHUNK_ROWS", limit)
            monkeypatch.setattr(R, "SAMPLES", 4)
            early = W.metric_stats(A.accuracy(df, ["head"]), "who", ORDER, METRICS, strategy=strategy)
            late = W.metric_stats(df, "who", ORDER, METRICS, strategy=strategy, late=lambda d: A.accuracy(d, ["head"]))
            assert early.columns == late.columns and early.dtypes == late.dtypes
            assert rows(early) == rows(late, *early.columns)
    monkeypatch.setattr(R, "CHUNK_ROWS", 50_000)
    late = W.metric_stats(df, "who", ORDER, METRICS, late=lambda d: A.accuracy(d, ["head"]))
    plan = late._jdf.queryExecution().optimizedPlan().toString()
    assert "head_accuracy" not in plan[plan.index("RepartitionByExpression"):]
    physical = late._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning(who") == 1 and physical.count("Sort [who") == 1


def test_only_kept_columns_pass_the_lookup(spark, monkeypatch):
    stored, keep = [], O.stored_table

    def spy(df, name):
        stored.append(df.columns)
        return keep(df, name)

    monkeypatch.setattr(O, "stored_table", spy)
    df = O.opponent_by_reversal(_matches(spark), "match", "who", order=["who"])
    st = W.metric_stats(A.accuracy(df, ["head"]), "who", ORDER, METRICS, windows=()).localCheckpoint()
    kw = {"entity_col": "who", "date_col": "day", "match_col": "match", "materialize": True}
    for on in ("asof", "match"):
        whole = O.opponent_metrics(st, METRICS, on=on, **kw)
        kept = O.opponent_metrics(st, METRICS, on=on, keep=["match", "who", "opp_url"], **kw)
        assert kept.columns == ["match", "who", "opp_url", *[c for c in whole.columns if c.startswith("opp_") and c != "opp_url"]]
        assert rows(kept) == rows(whole, *kept.columns)
    assert not [c for c in stored[-1] if c.startswith("avg_") or c in METRICS]


def test_many_limbs_stay_out_of_one_method(spark):
    df = _matches(spark).select("*", *[(F.col("f") / (i + 3)).alias(f"g{i}") for i in range(14)]).localCheckpoint()
    names = [f"g{i}" for i in range(14)]
    out = R.running(df, "who", ORDER, [R.cum_sum(f"s_{g}", F.col(g)) for g in names])
    assert "lambdafunction" in out._jdf.queryExecution().optimizedPlan().toString()
    few = R.running(df, "who", ORDER, [R.cum_sum("s_g0", F.col("g0"))])
    assert "lambdafunction" not in few._jdf.queryExecution().optimizedPlan().toString()
    assert rows(out, "match", "who", "s_g0") == rows(few, "match", "who", "s_g0")


def test_label_maps_share_one_exchange_and_hand_on_what_is_kept(spark, tmp_path):
    data = [(i % 5 if i % 11 else None, i, i % 7, float(i)) for i in range(200)]
    spark.createDataFrame(data, "who long, at long, label long, price double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    whole = W.category_maps(df, "label", "who", ["at", "price"], block=8, text=True)
    kept = W.category_maps(df, "label", "who", ["at", "price"], block=8, text=True, keep=["at", "label"])
    assert kept.columns == ["at", "label", "totals", "totals_size"]
    assert rows(kept) == rows(whole, *kept.columns)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    moved = plan[plan.index("RepartitionByExpression"):].split("\n")[1:]
    assert "price" not in next(line for line in moved if "Project" in line and "_block" in line)
    below, under = [], False  # between the numbering pass and the table
    for line in plan.split("\n"):
        under = (under or "Window [" in line and "_n#" in line) and "Relation [" not in line
        below += [line] if under and "Window [" not in line else []
    assert not any("_label" in line for line in below)
