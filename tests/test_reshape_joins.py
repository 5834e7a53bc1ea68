"""P1, E6, J7, K1-K3, D3, U1 with the literal cases of the reference tests."""

import pytest
from pyspark.sql import functions as F

from skein.functions.scalars import normalize_header
from skein.operators import joins as J
from skein.operators import reshape as RS
from skein.sources.extract import natural_merge
from tests.conftest import rows

WIDE = "fight_url string, event_url string, weight_class string, fighter1_url string, fighter2_url string, " \
       "fighter1_result string, fighter2_result string"


def test_wide_to_long_standard(spark):
    df = spark.createDataFrame([("f1", "e1", "LW", "a", "b", "Win", "Loss"), ("f2", "e1", "HW", "c", "d", "Draw", "Draw")], WIDE)
    out = RS.wide_to_long(df)
    assert out.columns == ["fight_url", "event_url", "weight_class", "fighter_url", "result", "role", "opp_url"]
    assert rows(out, "fight_url", "fighter_url", "result", "role", "opp_url") == [
        ("f1", "a", "Win", "fighter1", "b"), ("f1", "b", "Loss", "fighter2", "a"),
        ("f2", "c", "Draw", "fighter1", "d"), ("f2", "d", "Draw", "fighter2", "c")]


def test_wide_to_long_one_row_and_missing(spark):
    df = spark.createDataFrame([("f1", "e1", "LW", "a", "b", "Win", "Loss")], WIDE)
    assert RS.wide_to_long(df).count() == 2
    with pytest.raises(KeyError):
        RS.wide_to_long(df.drop("fighter2_url"))
    out = RS.wide_to_long(df.drop("fighter1_result", "fighter2_result"))
    assert {r["result"] for r in out.collect()} == {None}


def test_wide_to_long_extra_columns_sorted_output(spark):
    df = spark.createDataFrame([("f2", "e2", "LW", "x", "y", "Win", "Loss", 7), ("f1", "e1", "HW", "b", "a", "Loss", "Win", 3)],
                               WIDE + ", extra int")
    out = RS.sorted_output(RS.wide_to_long(df), ["event_url", "fight_url", "fighter_url"])
    assert [r["fighter_url"] for r in out.collect()] == ["a", "b", "x", "y"]
    assert "extra" in out.columns


def test_normalize_headers():
    got = [normalize_header(h) for h in ["Column Name", "Total%", "Value.Value", "Other Column"]]
    assert got == ["column_name", "totalpct", "valuevalue", "other_column"]


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`Sig. str.` int, `Td %` int")
    assert RS.normalize_columns(df).columns == ["sig_str", "td_pct"]


def test_natural_join_cases(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, x string")
    b = spark.createDataFrame([(2, "B"), (3, "C"), (4, "D")], "id int, y string")
    assert rows(J.natural_join(a, b, "outer"), "id", "x", "y") == [(1, "a", None), (2, "b", "B"), (3, "c", "C"), (4, None, "D")]
    assert rows(J.natural_join(a, b, "inner"), "id", "x", "y") == [(2, "b", "B"), (3, "c", "C")]
    assert J.natural_join(a.limit(0), b.limit(0), "outer").count() == 0
    with pytest.raises(ValueError):
        J.natural_join(a, b, "sideways")
    with pytest.raises(ValueError):
        J.natural_join(a, {"id": [1]}, "outer")


def test_natural_join_positional(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "i int, x string")
    b = spark.createDataFrame([(10, "p"), (20, "q")], "j int, y string")
    got = rows(J.natural_join(a, b, "outer", order_a=["i"], order_b=["j"]), "x", "y")
    assert got == [("a", "p"), ("b", "q"), ("c", None)]


def test_natural_merge_small_lists():
    a = [{"id": 1, "x": "a"}, {"id": 2, "x": "b"}]
    b = [{"id": 2, "y": "B"}, {"id": 3, "y": "C"}]
    assert len(natural_merge(a, b, "outer")) == 3
    assert natural_merge(a, b, "inner") == [{"id": 2, "x": "b", "y": "B"}]
    with pytest.raises(ValueError):
        natural_merge(a, b, "bad")


def test_worklists(spark):
    df = spark.createDataFrame([("e1", ["u1", "u2"], "f1"), ("e1", ["u2"], "f1"), ("e2", [], "f2")],
                               "event_url string, fighters_urls array<string>, fight_url string")
    assert RS.event_urls(df).count() == 3  # duplicates kept
    assert rows(RS.flattened_urls(df), "url") == [("u1",), ("u2",)]
    assert rows(RS.distinct_urls(df), "fight_url") == [("f1",), ("f2",)]
    with pytest.raises(KeyError):
        RS.event_urls(df.drop("event_url"))
    with pytest.raises(ValueError):
        RS.flattened_urls(df.drop("fighters_urls"))
    with pytest.raises(ValueError):
        RS.distinct_urls(df.drop("fight_url"))
    assert RS.flattened_urls(df.limit(0)).count() == 0


def test_null_safe_join(spark):
    a = spark.createDataFrame([(1, None), (2, 5)], "id int, k int")
    b = spark.createDataFrame([(None, "n"), (5, "five")], "k int, name string")
    assert rows(J.join_on(a, b, ["k"], "left", null_safe=True), "id", "name") == [(1, "n"), (2, "five")]
    assert rows(J.join_on(a, b, ["k"], "left"), "id", "name") == [(1, None), (2, "five")]


def test_dimension_merges(spark):
    df = spark.createDataFrame([("f1", "a", "e1"), ("f2", "b", None)], "fight_url string, fighter_url string, event_url string")
    ev = spark.createDataFrame([("e1", "2020-01-01")], "event_url string, date string")
    assert "event_date" in J.merge_events(df, ev).columns
    with pytest.raises(ValueError):
        J.merge_events(df, ev.drop("date"))
    fighters = spark.createDataFrame([("a", "Ann"), ("a", "Ann")], "fighter_url string, full_name string")
    assert J.merge_entities(df, fighters).count() == 2  # duplicate entity rows collapsed first
    res = spark.createDataFrame([("f1", "e9"), ("f1", "e9")], "fight_url string, event_url string")
    assert J.merge_results(df.drop("event_url"), res).count() == 2


def test_union_and_keyed_concat(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 3.0)], "k int, b double")
    assert rows(RS.union_rows(a, b), "k", "a", "b") == [(1, "x", None), (2, None, 3.0)]
    arr = spark.createDataFrame([("m", ["r1", "r2"])], "m string, vals array<string>")
    assert rows(RS.keyed_concat(arr, "vals"), "round", "value") == [(1, "r1"), (2, "r2")]


def test_tail_rows(spark):
    df = spark.range(10).withColumn("d", F.col("id"))
    assert [r["id"] for r in RS.tail_rows(df, ["d"], 3).collect()] == [9, 8, 7]


def test_small_projections(spark):
    from skein.functions.scalars import nullif_blank
    from skein.operators.aggregate import dedupe
    from skein.operators.cleaners import apply_cleaner

    df = spark.createDataFrame([("a", ""), ("b", "--"), ("b", "--")], "k string, v string")
    assert RS.rename(df, {"k": "key", "absent": "x"}).columns == ["key", "v"]  # P2: absent ignored
    assert RS.drop_existing(df, ["v", "absent"]).columns == ["k"]
    assert [r["o"] for r in df.select(nullif_blank("v", "", "--").alias("o")).collect()] == [None, None, None]  # P8
    assert dedupe(df).count() == 2 and dedupe(df, ["k"]).count() == 2  # A5
    assert apply_cleaner(df, lambda d: d.where("k = 'a'")).count() == 1  # CL0
    assert rows(RS.entity_rows(df, "k", "b"), "k") == [("b",), ("b",)]  # P3


def test_star_join_and_suffixes(spark):
    long = spark.createDataFrame([("f1", "e1", "a", "b"), ("f1", "e1", "b", "a"), ("f2", "e9", "a", "z")],
                                 "fight_url string, event_url string, fighter_url string, opp_url string")
    ents = spark.createDataFrame([("a", "Ann"), ("b", "Bob")], "fighter_url string, full_name string")
    evs = spark.createDataFrame([("e1", "2020-01-01")], "event_url string, date string")
    out = J.star_join(long, ents, evs)
    # inner joins: the row whose opponent (z) and event (e9) are unknown is lost
    assert rows(out, "fight_url", "fighter_url", "full_name", "opp_full_name", "date") == [
        ("f1", "a", "Ann", "Bob", "2020-01-01"), ("f1", "b", "Bob", "Ann", "2020-01-01")]
    right = spark.createDataFrame([("a", "x", 1)], "fighter_url string, full_name string, n int")
    assert J.suffix_collisions(ents, right, ["fighter_url"], "_opp_in").columns == ["fighter_url", "full_name_opp_in", "n"]


def test_career_table_job(spark):
    import datetime as dt

    from skein.plans.jobs import career_table

    res = spark.createDataFrame(
        [("f1", "e1", "a", "b", "Win", "Loss", "Knockout", "LW", True, False, False, 100.0),
         ("f2", "e2", "a", "b", "Loss", "Win", "Decision", "LW", False, True, False, 900.0)],
        "fight_url string, event_url string, fighter1_url string, fighter2_url string, fighter1_result string, "
        "fighter2_result string, method_type string, weight_class string, title_fight boolean, perf_bonus boolean, "
        "fight_of_the_night boolean, fight_duration_seconds double")
    ents = spark.createDataFrame([("a", "Ann"), ("b", "Bob")], "fighter_url string, full_name string")
    evs = spark.createDataFrame([("e1", dt.date(2020, 1, 1)), ("e2", dt.date(2020, 2, 1))], "event_url string, date date")
    out = {(r["fight_url"], r["fighter_url"]): r for r in career_table(res, ents, evs).collect()}
    a2 = out[("f2", "a")]
    assert (a2["total_win"], a2["total_loss"], a2["total_win_knockout"], a2["total_loss_decision"], a2["total_lw"]) == (1, 1, 1, 1, 2)
    assert (a2["total_title_fight"], a2["total_fight_duration_seconds"], a2["total_fights"], a2["opp_full_name"]) == (1, 1000.0, 2, "Bob")
