"""Running totals (W1-W5) with the literal cases of the reference tests, plus the
results/metric statistics (W6-W15) on hand-computed frames. Every window test runs with
both physical strategies."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skein.operators import running as R
from skein.operators import windows as W
from tests.conftest import rows

STRATEGIES = ["window", "chunked"]


def _ordered(spark, data, schema):
    # explicit order column: the reference's implicit row order
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, " + schema)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_dummy_totals_basic(spark, strategy):
    df = _ordered(spark, [("A", "Win"), ("A", "Loss"), ("A", "Win"), ("B", "Loss"), ("B", "win")], "group string, result string")
    out = W.career_totals(df, "group", ["i"], dummy_cols=["result"], row_count_col="row_count", strategy=strategy)
    got = rows(out.orderBy("i"), "i", "total_win", "total_loss", "row_count")
    assert [(w, l, n) for _, w, l, n in got] == [(1, 0, 1), (1, 1, 2), (2, 1, 3), (0, 1, 1), (1, 1, 2)]
    assert "win" not in out.columns and "loss" not in out.columns


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_numeric_totals_coerced(spark, strategy):
    df = _ordered(spark, [("A", "1"), ("A", "2"), ("B", "3"), ("B", "bad")], "group string, score string")
    out = W.numeric_totals(df, "score", "group", ["i"], strategy=strategy)
    got = rows(out, "i", "score", "total_score")
    assert [(s, t) for _, s, t in got] == [(1.0, 1.0), (2.0, 3.0), (3.0, 3.0), (0.0, 3.0)]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_all_totals_with_null_number(spark, strategy):
    df = _ordered(spark, [("A", "Win", 1), ("A", "Loss", None), ("B", "Win", 2), ("B", "Loss", 3), ("B", "Loss", 4)],
                  "group string, result string, score int")
    out = W.career_totals(df, "group", ["i"], dummy_cols=["result"], numerical_cols=["score"], strategy=strategy)
    got = rows(out, "i", "total_win", "total_loss", "total_score")
    assert [tuple(r[1:]) for r in got] == [(1, 0, 1), (1, 1, 1), (1, 0, 2), (1, 1, 5), (1, 2, 9)]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_custom_prefix_and_row_count(spark, strategy):
    df = _ordered(spark, [("X", "Yes", 5), ("X", "No", 10), ("Y", "Yes", 20)], "grp string, outcome string, value int")
    out = W.career_totals(df, "grp", ["i"], dummy_cols=["outcome"], numerical_cols=["value"], prefix="cumsum_",
                          row_count_col="count", strategy=strategy)
    got = rows(out, "i", "cumsum_yes", "cumsum_no", "cumsum_value", "count")
    assert [tuple(r[1:]) for r in got] == [(1, 0, 5, 1), (1, 1, 15, 2), (1, 0, 20, 1)]


def test_integer_categories(spark):
    df = _ordered(spark, [("G1", 1), ("G1", 2), ("G2", 1), ("G2", 2)], "grp string, cat int")
    out = W.dummy_totals(df, "cat", "grp", ["i"])
    assert [tuple(r[1:]) for r in rows(out, "i", "total_1", "total_2")] == [(1, 0), (1, 1), (1, 0), (1, 1)]


def test_empty_input(spark):
    df = spark.createDataFrame([], "i int, grp string, result string")
    out = W.career_totals(df, "grp", ["i"], dummy_cols=["result"], categories={"result": []})
    assert out.count() == 0


def test_category_collision_raises(spark):
    df = _ordered(spark, [("A", "x")], "grp string, r string")
    df = df.withColumn("total_x", F.lit(1))
    with pytest.raises(ValueError):
        W.dummy_totals(df, "r", "grp", ["i"])
    out = W.dummy_totals(df, "r", "grp", ["i"], qualify=True)
    assert "total_r_x" in out.columns


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_null_group_gets_null_totals(spark, strategy):
    df = _ordered(spark, [(None, "Win"), ("A", "Win"), (None, "Loss")], "grp string, result string")
    out = W.career_totals(df, "grp", ["i"], dummy_cols=["result"], strategy=strategy)
    got = {r["i"]: r["row_count"] for r in out.collect()}
    assert got == {0: None, 1: 1, 2: None}


def _latest_input(spark, data):
    return spark.createDataFrame(data, "fighter string, date string, score int")


def test_latest_basic(spark):
    df = _latest_input(spark, [("A", "2021-01-01", 10), ("A", "2021-02-01", 20), ("B", "2020-12-31", 15),
                               ("B", "2021-03-15", 30), ("C", "2021-05-05", 25)])
    out = W.latest_per_entity(df, "fighter", "date")
    assert rows(out, "fighter", "score") == [("A", 20), ("B", 30), ("C", 25)]


def test_latest_bad_dates_dropped(spark):
    df = _latest_input(spark, [("A", "2021-01-01", 10), ("A", "invalid_date", 99), ("B", "2021-03-15", 30)])
    assert rows(W.latest_per_entity(df, "fighter", "date"), "fighter", "score") == [("A", 10), ("B", 30)]


def test_latest_all_bad(spark):
    df = _latest_input(spark, [("A", "bad", 1), ("B", "worse", 2)])
    out = W.latest_per_entity(df, "fighter", "date")
    assert out.count() == 0 and out.columns == ["fighter", "date", "score"]


def test_latest_tie_first_and_last(spark):
    df = spark.createDataFrame([(0, "A", "2021-06-01", 10), (1, "A", "2021-06-01", 20)], "i int, fighter string, date string, score int")
    assert rows(W.latest_per_entity(df, "fighter", "date", ties=["i"]), "score") == [(10,)]
    assert rows(W.latest_per_entity(df, "fighter", "date", ties=["i"], tie="last"), "score") == [(20,)]


def test_latest_missing_column(spark):
    df = _latest_input(spark, [("A", "2021-01-01", 1)])
    with pytest.raises(KeyError):
        W.latest_per_entity(df.drop("date"), "fighter", "date")
    with pytest.raises(KeyError):
        W.latest_per_entity(df.drop("fighter"), "fighter", "date")


def _long(spark):
    d = dt.datetime
    data = [  # fighter, match, date, result, time
        ("A", "m1", d(2020, 1, 1), "Win", 100.0),
        ("A", "m2", d(2020, 2, 1), "Loss", None),
        ("A", "m3", d(2020, 2, 3), "Win", 300.0),
        ("A", "m4", d(2020, 6, 1), "Draw", 50.0),
        ("B", "m1", d(2020, 1, 1), "Loss", 100.0),
    ]
    return spark.createDataFrame(data, "fighter_url string, fight_url string, event_date timestamp, result string, time_seconds double")


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_results_own_stats(spark, strategy):
    out = W.results_own_stats(_long(spark), "fighter_url", ["event_date", "fight_url", "fighter_url"], strategy=strategy)
    a = {r["fight_url"]: r for r in out.where("fighter_url = 'A'").collect()}
    # after
    assert [a[m]["total_fights_after"] for m in ("m1", "m2", "m3", "m4")] == [1, 2, 3, 4]
    assert [a[m]["cumulative_wins_after"] for m in ("m1", "m2", "m3", "m4")] == [1, 1, 2, 2]
    assert a["m3"]["win_rate_after"] == pytest.approx(2 / 3)
    assert a["m2"]["avg_time_seconds_after"] == pytest.approx(100.0)  # NULL time skipped
    # incoming: first row 0 / NULL
    assert (a["m1"]["total_fights_in"], a["m1"]["cumulative_wins_in"], a["m1"]["win_rate_in"], a["m1"]["avg_time_seconds_in"]) == (0, 0, None, None)
    assert a["m4"]["cumulative_losses_in"] == 1 and a["m4"]["avg_time_seconds_in"] == pytest.approx(200.0)
    # rolling: after [-2, 0], incoming [-3, -1]; first incoming row: wins NULL, fights 0
    assert a["m4"]["rolling_3_wins"] == 1 and a["m4"]["rolling_3_fights"] == 3
    assert (a["m1"]["rolling_3_wins_in"], a["m1"]["rolling_3_fights_in"], a["m1"]["rolling_3_win_rate_in"]) == (None, 0, None)
    assert a["m4"]["rolling_3_wins_in"] == 2 and a["m4"]["rolling_3_avg_time_in"] == pytest.approx(200.0)
    # day gaps
    assert [a[m]["time_since_first_fight"] for m in ("m1", "m2", "m3", "m4")] == [0, 31, 33, 152]
    assert [a[m]["time_since_last_fight"] for m in ("m1", "m2", "m3", "m4")] == [None, 31, 2, 119]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_metric_stats_missing_value(spark, strategy):
    df = spark.createDataFrame([("A", "m1", 1, 5.0), ("A", "m2", 2, None), ("A", "m3", 3, 7.0)],
                               "fighter string, fight_url string, d int, kd double")
    out = W.metric_stats(df, "fighter", ["d", "fight_url"], ["kd"], windows=(3,), strategy=strategy)
    got = {r["fight_url"]: r for r in out.collect()}
    assert [got[m]["fight_order"] for m in ("m1", "m2", "m3")] == [0, 1, 2]
    assert [got[m]["cum_kd_current"] for m in ("m1", "m2", "m3")] == [5.0, None, 12.0]
    assert [got[m]["cum_kd_in"] for m in ("m1", "m2", "m3")] == [0, 5.0, 5.0]  # D16: real total of earlier rows
    assert got["m1"]["avg_kd_in"] is None and got["m3"]["avg_kd_in"] == pytest.approx(2.5)
    assert got["m3"]["rolling_3_kd_in"] == 5.0 and got["m3"]["rolling_3_avg_kd_in"] == 5.0
    assert [got[m]["rolling_3_fights_in"] for m in ("m1", "m2", "m3")] == [0, 1, 2]


def test_synthetic_dates(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    got = rows(W.synthetic_dates(df, ["k"]), "k", "event_date")
    assert got == [(1, dt.date(1970, 1, 1)), (2, dt.date(1970, 1, 2)), (3, dt.date(1970, 1, 3))]


def test_null_category_column_and_option(spark):
    df = _ordered(spark, [("A", "Win"), ("A", None)], "grp string, result string")
    out = W.dummy_totals(df, "result", "grp", ["i"])
    assert [r["total_"] for r in out.orderBy("i").collect()] == [0, 1]  # NULL -> category ''
    assert "total_" not in W.dummy_totals(df, "result", "grp", ["i"], drop_null_category=True).columns


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_rolling_metrics_from_lagged_rows_equal_the_aggregates(spark, strategy, monkeypatch):
    rnd = random.Random(5)
    some = lambda v: v if rnd.random() < 0.7 else None
    data = [(rnd.choice(["a", "a", "a", "b", None]), i, some(rnd.randrange(9)), some(rnd.uniform(-5, 5)), some(rnd.random() < 0.5)) for i in range(300)]
    df = spark.createDataFrame(data, "fighter string, fight_url int, n int, x double, yes boolean")
    monkeypatch.setattr(R, "CHUNK_ROWS", 20)
    names = [f"rolling_{w}_{m}" for w in (1, 4) for m in ("n_in", "x_in", "yes_in", "avg_n_in", "avg_x_in", "avg_yes_in", "fights_in")]

    def run():
        out = W.metric_stats(df, "fighter", ["fight_url"], ["n", "x", "yes"], windows=(1, 4), strategy=strategy)
        return [f.dataType for f in out.select(*names).schema], sorted(out.select("fight_url", *names).collect())

    lagged = run()
    monkeypatch.setattr(W, "LAGGED", 0)
    assert lagged == run()
