"""A1-A8, F1-F5, P6, J8, W11, W12, W16 on small hand-computed frames; CL1-CL4 and E9."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skein.operators import aggregate as AG
from skein.operators import cleaners as CL
from skein.operators import opponent as OP
from skein.operators import profile as PR
from skein.operators import windows as W
from tests.conftest import rows


def test_aggregate_rounds_and_accuracy(spark):
    df = spark.createDataFrame(
        [("f1", "a", 1, 2.0, 10.0, None, True), ("f1", "a", 2, 3.0, 0.0, "x", False), ("f1", "a", 3, None, 5.0, "y", True),
         ("f1", None, 1, 9.0, 9.0, "z", True), ("f2", "b", 1, None, None, None, None)],
        "fight_url string, fighter string, round int, sig_str_landed double, sig_str_attempted double, note string, bonus boolean")
    out = AG.accuracy(AG.aggregate_rounds(df))
    got = {r["fight_url"]: r for r in out.collect()}
    assert set(got) == {"f1", "f2"}  # NULL participant dropped
    f1 = got["f1"]
    assert (f1["round"], f1["sig_str_landed"], f1["sig_str_attempted"], f1["note"], f1["bonus"]) == (3, 5.0, 15.0, "x", 2)
    assert f1["sig_accuracy"] == pytest.approx(1 / 3)
    f2 = got["f2"]
    assert (f2["sig_str_landed"], f2["sig_accuracy"], f2["note"]) == (0, None, None)  # sum of nothing = 0; 0 attempts -> NULL


def _dates(spark):
    d = dt.datetime
    return spark.createDataFrame([("a", d(2020, 1, 1)), ("a", d(2020, 1, 11)), ("a", d(2020, 1, 22, 12)), ("b", d(2021, 1, 1))],
                                 "e string, d timestamp")


def test_intervals(spark):
    assert rows(AG.avg_interval(_dates(spark), "e", "d"), "e", "avg_interval") == [("a", 10.5)]
    assert rows(AG.avg_interval_days(_dates(spark), "e", "d"), "e", "avg_interval_days") == [("a", 10), ("b", None)]


def test_histogram_includes_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.0,), (10.0,)], "x double")
    h = AG.histogram(df, "x", 5)
    got = rows(h, "bin", "count")
    assert got == [(0, 3), (1, 0), (2, 0), (3, 0), (4, 1)]


def test_outcome_matrix(spark):
    df = spark.createDataFrame([("a", 2, 1)], "e string, total_win_knockout int, total_loss_decision int")
    got = {(r["method"], r["outcome"]): r["n"] for r in AG.outcome_matrix(df, "e").collect()}
    assert got[("Knockout", "wins")] == 2 and got[("Decision", "losses")] == 1 and got[("Submission", "wins")] == 0
    assert len(got) == 6


def test_profile(spark):
    d = dt.datetime
    df = spark.createDataFrame(
        [("a", "m1", d(2020, 1, 1), "Win", 300.0, dt.date(1990, 1, 1)), ("a", "m2", d(2020, 3, 1), "Loss", 90000.0, dt.date(1990, 1, 1))],
        "fighter_url string, fight_url string, date timestamp, result string, fight_duration_seconds double, date_of_birth date")
    careers = W.career_totals(df, "fighter_url", ["date", "fight_url"], dummy_cols=["result"],
                              numerical_cols=["fight_duration_seconds"], row_count_col="total_fights")
    p = PR.entity_profile(careers, "2021-01-01").first()
    assert (p["fight_url"], p["record_wld"], p["time_since_last_days"], p["avg_interval_days"], p["age"]) == ("m2", "1-1-0", 306, 60, 31)
    assert p["total_time_display"] == "1 day, 1:05:00" and p["last_date_display"] == "March 01, 2020"
    hist = PR.history(careers, columns=("date", "result", "fight_duration")).collect()
    assert [h["date"] for h in hist] == ["March 01, 2020", "January 01, 2020"]
    assert [h["fight_duration"] for h in hist] == ["1 day, 1:00:00", "0:05:00"]


def test_opponent_by_reversal(spark):
    df = spark.createDataFrame([("m1", "a"), ("m1", "b"), ("m2", "c"), ("m3", "x"), ("m3", "y"), ("m3", "z")],
                               "fight_url string, fighter string")
    got = dict(((r["fight_url"], r["fighter"]), r["opp_url"]) for r in OP.opponent_by_reversal(df, "fight_url", "fighter").collect())
    assert got == {("m1", "a"): "b", ("m1", "b"): "a", ("m2", "c"): "c", ("m3", "x"): "z", ("m3", "y"): "y", ("m3", "z"): "x"}


def _long(spark):
    d = dt.datetime
    data = [  # fight, date, fighter, result, opp
        ("m1", d(2020, 1, 1), "a", "Win", "b"), ("m1", d(2020, 1, 1), "b", "Loss", "a"),
        ("m2", d(2020, 2, 1), "a", "Win", "c"), ("m2", d(2020, 2, 1), "c", "Loss", "a"),
        ("m3", d(2020, 3, 1), "b", "Win", "c"), ("m3", d(2020, 3, 1), "c", "Loss", "b"),
    ]
    df = spark.createDataFrame(data, "fight_url string, event_date timestamp, fighter_url string, result string, opp_url string")
    return df.withColumn("time_seconds", df["event_date"].cast("long") * 0.0)


@pytest.mark.parametrize("strategy", ["window", "chunked"])
@pytest.mark.parametrize("on", ["asof", "match"])
def test_opponent_records_and_totals(spark, strategy, on):
    order = ["event_date", "fight_url", "fighter_url"]
    own = W.results_own_stats(_long(spark), "fighter_url", order, rolling=False, time_diffs=False, strategy=strategy)
    opp = OP.opponent_records(own, on=on, strategy=strategy)
    got = {(r["fight_url"], r["fighter_url"]): r for r in opp.collect()}
    # in m3, b's opponent c had lost once before (m2) and twice after
    r = got[("m3", "b")]
    assert (r["opp_cumulative_wins_in"], r["opp_cumulative_losses_in"]) == (0, 1)
    assert (r["opp_cumulative_wins_after"], r["opp_cumulative_losses_after"]) == (0, 2)
    # first match of both: incoming record NULL (no earlier fight), after = record including m1
    r = got[("m1", "a")]
    assert (r["opp_cumulative_wins_in"], r["opp_cumulative_losses_after"]) == (None, 1)
    tot = {(t["fight_url"], t["fighter_url"]): t for t in OP.opponent_totals(opp, strategy=strategy).collect()}
    assert tot[("m2", "a")]["total_opp_cumulative_losses_after"] == 1 + 1


def test_opponent_metrics(spark):
    df = spark.createDataFrame([("m1", 1, "a", 2.0), ("m1", 1, "b", 5.0), ("m2", 2, "a", 4.0), ("m2", 2, "b", 1.0)],
                               "fight_url string, d int, fighter string, kd double")
    df = df.withColumn("event_date", df["d"].cast("timestamp"))
    st = W.metric_stats(df, "fighter", ["event_date", "fight_url", "fighter"], ["kd"], windows=(3,))
    st = OP.opponent_by_reversal(st, "fight_url", "fighter")
    out = {(r["fight_url"], r["fighter"]): r for r in OP.opponent_metrics(st, ["kd"]).collect()}
    assert out[("m2", "a")]["opp_cum_kd_in"] == 5.0 and out[("m2", "a")]["opp_cum_kd_current"] == 6.0
    assert out[("m1", "a")]["opp_avg_kd_in"] is None and out[("m1", "a")]["opp_avg_kd_current"] == 5.0


def test_cleaners(spark):
    ev = spark.createDataFrame([("E", "/e", "March 30, 2024", "Atlantic City, New Jersey, USA"), ("F", "/f", "bad", "Macau, China")],
                               CL.schema_of("events"))
    got = {r["event"]: r for r in CL.clean_events(ev).collect()}
    assert got["E"]["date"] == dt.date(2024, 3, 30) and (got["E"]["city"], got["E"]["state"], got["E"]["country"]) == (
        "Atlantic City", "New Jersey", "USA")
    assert got["F"]["date"] is None and got["F"]["state"] is None and got["F"]["country"] == "China"
    res = spark.createDataFrame([("/f", "/e", "win", ["/a", "/b"], "LW", "SUB\n\n  Guillotine Choke", "3", "1:30", True, False, False)],
                                CL.schema_of("results"))
    r = CL.clean_results(res).first()
    assert (r["time_seconds"], r["round"], r["fight_duration_seconds"], r["method_short"], r["method_detail"]) == (
        90.0, 3, 690.0, "SUB", "Guillotine Choke")
    assert (r["result_type"], r["method_type"], r["fighter1_url"], r["fighter2_result"]) == ("Win", "Submission", "/a", "Loss")
    assert "winner" not in r.asDict() and "fighters_urls" not in r.asDict()
    fi = spark.createDataFrame([("X", "/x", None, "5' 10\"", '70"', "Orthodox", "Jul 22, 1989", "1-0-0")], CL.schema_of("fighters"))
    f = CL.clean_fighters(fi).first()
    assert f["date_of_birth"] == dt.date(1989, 7, 22) and f["height_cm"] == pytest.approx(177.8) and f["reach_cm"] == pytest.approx(177.8)
    rd = spark.createDataFrame([(1, "/f", "/a", "1", "20 of 53", "37%", "30 of 60", "1 of 2", "50%", "0", "0", "1:43",
                                 "10 of 20", "5 of 10", "5 of 23", "15 of 40", "3 of 7", "2 of 6")], CL.schema_of("rounds"))
    o = CL.clean_rounds(rd).first()
    assert (o["sig_str_landed"], o["sig_str_attempted"], o["ctrl_seconds"], o["sig_str_pct_num"], o["td_landed"]) == (20.0, 53.0, 103.0, 37.0, 1.0)
    assert "ctrl" not in o.asDict()


def test_validate_rows(spark):
    df = spark.createDataFrame([("a", "1"), (None, "2"), ("c", "x")], "k string, n string")
    ok, bad = CL.validate_rows(df, ["k"], {"n": "int"})
    assert rows(ok, "k") == [("a",)]
    assert rows(bad, "_reason") == [("k is null",), ("n is not int",)]
    from skein.operators.reshape import validate_columns
    with pytest.raises(ValueError):
        validate_columns(df, ["k", "missing"])


def test_validate_raw_required_fields(spark):
    df = spark.createDataFrame([("E", "/e", "March 1, 2020", "X"), ("F", None, "March 2, 2020", "Y")], CL.schema_of("events"))
    ok, bad = CL.validate_raw(df, "events")
    assert rows(ok, "event") == [("E",)] and rows(bad, "_reason") == [("event_url is null",)]


def _hot(spark):
    """Repeated and NULL match ids, repeated participants, a NULL opponent and a NULL date."""
    d = lambda n: dt.datetime(2020, 1, n)
    data = [("m1", d(1), "a", "Win", "b")] * 4 + [(None, d(2), "a", "Loss", "b")] * 5 + [("m2", d(3), "b", "Win", "a"), ("m3", d(4), "c", "Win", None), ("m4", None, "b", "Loss", "a")]
    df = spark.createDataFrame(data, "fight_url string, event_date timestamp, fighter_url string, result string, opp_url string")
    return df.withColumns({"time_seconds": F.lit(1.0), "kd": F.lit(2.0)})


@pytest.mark.parametrize("strategy", ["window", "chunked"])
@pytest.mark.parametrize("on", ["asof", "match"])
def test_opponent_lookups_keep_the_rows(spark, strategy, on):
    df, order = _hot(spark), ["event_date", "fight_url", "fighter_url"]
    own = W.results_own_stats(df, "fighter_url", order, rolling=False, time_diffs=False, strategy=strategy)
    records = OP.opponent_records(own, on=on, strategy=strategy)
    assert rows(records, "fight_url", "fighter_url", "result") == rows(df, "fight_url", "fighter_url", "result")
    stats = W.metric_stats(df.withColumnRenamed("fighter_url", "fighter"), "fighter", ["event_date", "fight_url", "fighter"], ["kd"], strategy=strategy)
    metrics = OP.opponent_metrics(stats, ["kd"], on=on, strategy=strategy)
    assert rows(metrics, "fight_url", "fighter", "result") == rows(df.withColumnRenamed("fighter_url", "fighter"), "fight_url", "fighter", "result")
    none = [r for r in metrics.collect() if r["opp_url"] is None or r["event_date"] is None]
    assert all(r["opp_cum_kd_in"] is None and (on == "match" or r["opp_cum_kd_current"] is None) for r in none)


@pytest.mark.parametrize("strategy", ["window", "chunked"])
def test_reversal_keeps_the_rows(spark, strategy):
    pairs = [("m", "a")] * 3 + [("m", "b"), (None, "a"), (None, "b"), ("n", None), ("n", "z")]
    df = spark.createDataFrame(pairs, "fight_url string, fighter string")
    got = rows(OP.opponent_by_reversal(df, "fight_url", "fighter", strategy=strategy))
    assert got == sorted([("m", "a", "b"), ("m", "a", "a"), ("m", "a", "a"), ("m", "b", "a"), (None, "a", None), (None, "b", None), ("n", None, "z"), ("n", "z", None)], key=repr)


def test_opponent_lookup_plan_has_one_pass(spark):
    stats = W.metric_stats(_hot(spark).withColumnRenamed("fighter_url", "fighter"), "fighter", ["event_date"], ["kd"], strategy="window")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = OP.opponent_metrics(stats, ["kd"], strategy="window", materialize=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
