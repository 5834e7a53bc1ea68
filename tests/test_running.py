"""The running engine: chunked (skew-safe) == window on random data with a hot key, tiny
chunks and multi-hop halos; as-of join == brute force in both directions with ties."""

import random

import pytest
from pyspark.sql import functions as F

from skein.operators import running as R
from skein.operators.asof import asof_join


def _measures():
    return [
        R.cum_sum("s", "x"), R.cum_sum("se", "x", False), R.cum_count("c", "x"), R.row_number("rn"),
        R.cum_min("mn", "x"), R.cum_max("mx", "x", False),
        R.cum_last("ls", F.when(F.col("x") > 5, F.struct("x", "id"))),
        R.rows_sum("f3", "x", -2, 0), R.rows_avg("f5i", "x", -5, -1), R.rows_count("c3i", "x", -3, -1), R.lag("lg", "t", 1),
        R.rows_max("mx2", "x", -4, -2),
    ]


@pytest.fixture
def tiny_chunks(monkeypatch):
    """Chunks of a few rows: every key with more is cut, and halo rows pass several chunks."""
    monkeypatch.setattr(R, "CHUNK_ROWS", 3)
    monkeypatch.setattr(R, "SAMPLES", 2)


@pytest.mark.parametrize("partitions", [3, 64])
def test_chunked_equals_window(spark, tiny_chunks, partitions):
    rng = random.Random(partitions)
    data = []
    for i in range(1500):
        k = 0 if rng.random() < 0.4 else rng.randint(1, 40)  # one key holds ~40% of rows
        if rng.random() < 0.01:
            k = None
        x = None if rng.random() < 0.2 else rng.randint(0, 9)
        data.append((k, rng.randint(0, 50), i, x))
    df = spark.createDataFrame(data, "k int, t int, id int, x int")
    order = R.order_cols("t", "id")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))  # 64: many tiny chunks -> multi-hop halos
    try:
        a = R.running(df, "k", order, _measures(), strategy="window")
        b = R.running(df, "k", order, _measures(), strategy="chunked")
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_double_sums_are_equal_in_every_configuration(spark, tiny_chunks):
    rnd = random.Random(4)
    rows = [(rnd.choice([1, 1, 1, 2, None]), i, rnd.choice([0.1, 1e9 / 3, -7.7e-5, float("nan"), None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t int, x double")
    ms = [R.cum_sum("s", "x"), R.cum_sum("s_in", "x", inclusive=False), R.cum_next("nxt", F.when(F.col("t") % 7 == 0, F.col("t")))]
    seen = []
    for strategy, parts in (("window", 8), ("chunked", 8), ("chunked", 3)):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            seen.append(sorted(map(repr, R.running(df, "k", R.order_cols("t"), ms, strategy).collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1] == seen[2]
    ahead = {r["t"]: r["nxt"] for r in R.running(df.where("k = 1"), "k", R.order_cols("t"), ms).collect()}
    marks = [t for t in sorted(ahead) if t % 7 == 0]
    assert all(n == next((m for m in marks if m >= t), None) for t, n in ahead.items())


def test_no_job_runs_while_a_window_plan_is_built(spark):
    df = spark.range(10).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plan only")
    try:
        R.running(df, "k", R.order_cols("t"), [R.row_number("n")], "window")
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")


def _brute_asof(left, right, direction):
    out = []
    for lid, lk, lt in left:
        cands = [(rt, rtie, rv) for rk, rt, rtie, rv in right if rk == lk and lt is not None
                 and (rt <= lt if direction == "backward" else rt >= lt)]
        if not cands:
            out.append((lid, None))
            continue
        if direction == "backward":
            best = max(cands, key=lambda c: (c[0], c[1]))  # latest time, last tie
        else:
            best = min(cands, key=lambda c: (c[0], c[1]))  # earliest time, first tie
        out.append((lid, best[2]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("strategy", ["window", "chunked"])
def test_asof_matches_brute_force(spark, tiny_chunks, direction, strategy):
    rng = random.Random(7)
    left = [(i, rng.randint(0, 3), rng.choice([None] + list(range(30)))) for i in range(300)]
    right = [(rng.randint(0, 3), rng.randint(0, 30), j, f"v{j}") for j in range(200)]  # many equal times (ties)
    ldf = spark.createDataFrame(left, "lid int, k int, t int")
    rdf = spark.createDataFrame(right, "k int, t int, tie int, v string")
    got = asof_join(ldf, rdf, on="t", by="k", payload=["v"], direction=direction, right_ties=["tie"], strategy=strategy)
    assert got.columns == ["lid", "k", "t", "v"]
    assert sorted(((r["lid"], r["v"]) for r in got.collect()), key=repr) == _brute_asof(left, right, direction)


def test_asof_suffix_on_collision(spark):
    ldf = spark.createDataFrame([(1, 1, 5)], "id int, k int, v int")
    rdf = spark.createDataFrame([(1, 3, 9)], "k int, t int, v int")
    got = asof_join(ldf.withColumnRenamed("v", "t_l").withColumn("v", F.lit(0)), rdf, on="t_l", by="k", right_on="t",
                    payload=["v"], suffix="_opp_in")
    assert "v_opp_in" in got.columns
    assert got.first()["v_opp_in"] == 9


def test_chunked_composite_keys_descending_and_empty(spark, tiny_chunks):
    rng = random.Random(3)
    data = [(rng.choice([0, 0, 0, 1, None]), rng.choice(["a", "b"]), rng.randint(0, 30), i, rng.randint(0, 5)) for i in range(800)]
    df = spark.createDataFrame(data, "k1 int, k2 string, t int, id int, x int")
    order = [F.col("t").desc_nulls_last(), F.col("id").desc_nulls_last()]
    ms = [R.cum_sum("s", "x"), R.rows_sum("r", "x", -3, -1), R.lag("p", "id", 2), R.cum_last("l", F.when(F.col("x") > 3, F.col("id")))]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        a = R.running(df, ["k1", "k2"], order, ms, strategy="window")
        b = R.running(df, ["k1", "k2"], order, ms, strategy="chunked")
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        assert R.running(df.limit(0), ["k1", "k2"], order, ms, strategy="chunked").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_exact_sums_of_any_magnitude(spark, tiny_chunks):
    """Values from the smallest to the largest double: equal to exact rational sums to the last
    bit or the one next to it, equal in every configuration, nothing raises."""
    from fractions import Fraction
    from math import inf, nan, ulp

    rnd = random.Random(8)
    values = [1e300, 1e-300, -1e300, 3e20, 1e-19, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308, 0.1, -0.1, 1 / 3, 2.0**24, -0.0, None, nan]
    rows = [("mix", i, rnd.choice(values)) for i in range(300)]
    rows += [("tiny", i, 1e-19) for i in range(100)] + [("third", i, 3.33e-7 / 3) for i in range(100)]
    rows += [("cancel", i, [1e300, 1e-300, -1e300, 7.0, 1e16, -1e16][i % 6]) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, t int, x double")
    ms = [R.cum_sum("s", "x"), R.cum_sum("s_ex", "x", inclusive=False), R.cum_sum_before("s_in", "s", "x")]
    window = {(r["k"], r["t"]): (r["s"], r["s_ex"], r["s_in"]) for r in R.running(df, "k", ["t"], ms, "window").collect()}
    assert repr(sorted(window.items())) == repr(sorted({(r["k"], r["t"]): (r["s"], r["s_ex"], r["s_in"]) for r in R.running(df, "k", ["t"], ms).collect()}.items()))

    def nearest(v):
        return float(v) if abs(v) < 2**1024 - 2**970 else inf if v > 0 else -inf

    def close(got, want):
        return got == want or abs(got - want) <= ulp(want)

    so_far, seen = {}, {}
    for k, t, x in rows:
        before = so_far.get(k, Fraction(0))
        here = seen.get(k, False)
        assert close(window[k, t][2], nearest(before)), (k, t)
        assert (window[k, t][1] is None) == (not here)
        if x is not None and x == x:
            so_far[k], seen[k] = before + Fraction(x), True
        if not seen.get(k):
            assert window[k, t][0] is None
            continue
        assert close(window[k, t][0], nearest(so_far[k])), (k, t)
    infinite = spark.createDataFrame([("a", 1, 1.5), ("a", 2, inf), ("a", 3, 2.0), ("a", 4, -inf), ("b", 1, -inf), ("b", 2, nan)], "k string, t int, x double")
    got = {(r["k"], r["t"]): r["s"] for r in R.running(infinite, "k", ["t"], ms[:1]).collect()}
    assert got["a", 1] == 1.5 and got["a", 2] == got["a", 3] == inf and got["a", 4] != got["a", 4] and got["b", 1] == got["b", 2] == -inf


@pytest.mark.parametrize("kind", ["string", "double", "timestamp_ntz", "date", "boolean"])
def test_descending_order_of_every_type_across_chunks(spark, tiny_chunks, kind):
    rnd = random.Random(2)
    text = {"string": lambda i: "ab"[: rnd.randint(0, 2)] + "é" * (i % 3), "binary": lambda i: "xy"[: rnd.randint(0, 2)], "double": lambda i: rnd.choice(["NaN", "-1.5", "0", "7", "Infinity"]),
            "boolean": lambda i: rnd.choice(["true", "false"])}.get(kind, lambda i: str(rnd.randint(-5, 5)))
    date = kind in ("timestamp_ntz", "timestamp", "date")
    rows = [(0, i, rnd.choice([None, f"19{rnd.randint(60, 80)}-03-0{rnd.randint(1, 9)} 0{rnd.randint(0, 9)}:00:00.123456" if date else text(i)])) for i in range(150)]
    df = spark.createDataFrame(rows, "k int, id int, v string").withColumn("v", F.col("v").cast(kind))
    for order in ([R.By("v", True), "id"], [R.By("v", True, True), R.By("id", True)]):
        ms = [R.row_number("n"), R.rows_left("l"), R.lag("p", "id", 2), R.cum_last("c", F.when(F.col("id") % 5 == 0, F.col("id")))]
        a, b = (sorted(tuple(r)[1:2] + tuple(r)[3:] for r in R.running(df, "k", order, ms, s).collect()) for s in ("window", "chunked"))
        assert a == b and [r[1] + r[2] for r in a] == [151] * 150


def test_rows_without_a_key_are_spread(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK_ROWS", 20)
    df = spark.createDataFrame([(None if i % 3 else 1, i, 1) for i in range(900)], "k int, t int, x int")
    plan, _ = R.layout(df, "k", ["t"])
    assert plan.spread_nulls and plan.bounds is not None
    out = R.running(df, "k", ["t"], [R.cum_sum("s", "x"), R.lag("p", "t")], plan=plan)
    assert out.where("k is null and (s is not null or p is not null)").count() == 0 and out.count() == 900
    assert [r["s"] for r in out.where("k = 1").orderBy("t").collect()] == list(range(1, 301))
    assert out.where("k is null")._jdf.queryExecution().executedPlan().toString().count("_rk_chunk") > 0
    cold, _ = R.layout(df.where("k is null"), "k", ["t"])
    alone = R.running(df.where("k is null"), "k", ["t"], [R.row_number("n")], plan=cold)
    assert cold.spread_nulls and cold.bounds is None and alone.where("n is null").count() == 600
