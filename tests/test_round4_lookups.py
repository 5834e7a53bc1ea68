"""Opponents' statistics summed in the lookup's own pass: the same rows as looking up finished
statistics, with metrics and no statistics stored or exchanged before it."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skein.operators import opponent as O
from skein.operators import running as R
from skein.operators import windows as W
from skein.plans import jobs


def _wide(spark, n=160, people=9, seed=3):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        a, b = rnd.sample(range(people), 2)
        first, second = f"p{a}", None if rnd.random() < 0.1 else f"p{b}"
        if rnd.random() < 0.04:
            first = None
        result = rnd.choice(["Win", "Loss", "Draw", None])
        rows.append((f"f{i:03d}", f"e{rnd.randint(0, 45)}", first, second, result, {"Win": "Loss", "Loss": "Win"}.get(result, result),
                     rnd.choice([None, float(rnd.randint(1, 900)), rnd.random()])))
    wide = spark.createDataFrame(rows, "fight_url string, event_url string, fighter1_url string, fighter2_url string, fighter1_result string, fighter2_result string, time_seconds double")
    for c in jobs.RESULTS_REQUIRED:
        if c not in wide.columns:
            wide = wide.withColumn(c, F.lit(None).cast("string"))
    days = [(f"e{i}", None if i % 9 == 0 else dt.datetime(2000, 1, 1) + dt.timedelta(days=rnd.randint(0, 25))) for i in range(40)]
    return wide, spark.createDataFrame(days, "event_url string, date timestamp_ntz")


def _rounds(spark, seed=5):
    rnd, rows = random.Random(seed), []
    for i in range(140):
        for who in rnd.sample(range(8), rnd.choice([1, 2, 2, 2, 3])):
            for k in range(rnd.randint(1, 3)):
                rows.append((f"f{i:03d}", f"p{who}", float(k + 1), rnd.choice([None, rnd.randint(0, 9) / 1.0, rnd.random()]), rnd.randint(0, 30), rnd.randint(1, 40)))
    df = spark.createDataFrame(rows, "fight_url string, fighter string, round double, kd double, head_landed int, head_attempted int")
    for c in jobs.ROUNDS_REQUIRED:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(1.0))
    date = F.when(F.col("fight_url") == "f007", None).otherwise(F.to_timestamp_ntz(F.lit("2001-01-01")) + F.make_dt_interval(F.substring("fight_url", 2, 3).cast("int") % 30))
    return df.withColumn("event_date", date)


def _rows(df, cols):
    return sorted(tuple(repr(v) for v in r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("strategy,limit", [("chunked", None), ("window", None), ("chunked", 12)])
def test_results_equal_looked_up_statistics(spark, monkeypatch, strategy, limit):
    from skein.operators import joins as J
    from skein.operators.reshape import wide_to_long

    wide, events = _wide(spark)
    order = ["event_date", "fight_url", "fighter_url"]
    own = W.results_own_stats(wide_to_long(J.merge_events(wide, events)), "fighter_url", order, strategy="window")
    expected = O.opponent_totals(O.opponent_records(own, strategy="window"), "fighter_url", order, strategy="window")
    if limit:
        monkeypatch.setattr(R, "CHUNK_ROWS", limit)
        monkeypatch.setattr(R, "SAMPLES", 4)
    got = jobs.results_stats(wide, events, strategy=strategy)
    assert got.schema.names == expected.schema.names and [f.dataType for f in got.schema] == [f.dataType for f in expected.schema]
    assert _rows(got, expected.columns) == _rows(expected, expected.columns)


@pytest.mark.parametrize("strategy,limit", [("chunked", None), ("window", None), ("chunked", 12)])
def test_fights_equal_looked_up_statistics(spark, monkeypatch, strategy, limit):
    from skein.operators import aggregate as A

    rounds = _rounds(spark)
    fights = A.accuracy(A.aggregate_rounds(rounds))
    metrics = W.metric_columns(fights, exclude=["fight_url", "fighter", "event_date", "fight_order"])
    fights = O.opponent_by_reversal(fights, "fight_url", "fighter", order=["fighter"], strategy="window")
    stats = W.metric_stats(fights, "fighter", ["event_date", "fight_url", "fighter"], metrics, strategy="window")
    expected = O.opponent_metrics(stats, metrics, strategy="window").drop("fight_order").withColumnRenamed("fighter", "fighter_url")
    monkeypatch.setattr(W, "synthetic_dates", lambda df, *a: df)  # the rounds carry their dates
    if limit:
        monkeypatch.setattr(R, "CHUNK_ROWS", limit)
        monkeypatch.setattr(R, "SAMPLES", 4)
    got = jobs.fight_stats(rounds, strategy=strategy)
    assert sorted(got.dtypes) == sorted(expected.dtypes)
    assert _rows(got, expected.columns) == _rows(expected, expected.columns)


def test_no_statistics_are_stored(spark, monkeypatch):
    stored, keep = [], O.stored_table

    def spy(df, name):
        stored.append(df.columns)
        return keep(df, name)

    for module in (O, jobs):
        monkeypatch.setattr(module, "stored_table", spy)
    wide, events = _wide(spark, 30)
    jobs.results_stats(wide, events).count()
    monkeypatch.setattr(W, "synthetic_dates", lambda df, *a: df)
    jobs.fight_stats(_rounds(spark)).count()
    assert len(stored) == 1 and not [c for c in stored[0] if c.startswith(("cum_", "avg_", "rolling_", "cumulative_"))]


def test_results_cross_the_network_twice(spark):
    wide, events = _wide(spark, 30)
    plan = jobs.results_stats(wide.localCheckpoint(), events.limit(0).localCheckpoint())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_lk_key") == 1 and plan.count("Exchange hashpartitioning(fighter_url") == 1
    assert "Union" not in plan


def test_rates_round_as_decimal_numbers(spark):
    from skein.plans import queries as Q

    rnd = random.Random(7)
    values = [rnd.randint(0, 40) / rnd.randint(1, 40) for _ in range(2000)] + [rnd.randint(-10**6, 10**6) / 100000 for _ in range(2000)]
    values += [0.0, -0.0, -2e-5, 5e-5, None, float("nan"), float("inf"), 1e300, 0.00005, 2.5e5, 123456789.123449999]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert all(repr(r["a"]) == repr(r["b"]) for r in df.select(Q.r4double(F.col("x")).alias("a"), Q.r4("x").alias("b")).collect())
    out = spark.createDataFrame([("f", 0.5)], "fight_url string, win_rate_after double")
    assert "rint" in str(Q.r4double(out["win_rate_after"]))
