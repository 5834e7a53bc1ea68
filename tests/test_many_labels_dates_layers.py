"""Label maps without a label list, date forms inferred from the first value, transformed
layers by year, mirrored matches of any size."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from skein.operators import opponent as O
from skein.operators import running as R
from skein.operators import windows as W
from skein.sources import io


@pytest.mark.parametrize("block", [3, 32])
def test_category_maps_equal_running_counts(spark, block):
    rnd = random.Random(block)
    rows = [(rnd.choice([1, 1, 1, 2, None]), i, rnd.choice([None, *[f"v{j}" for j in range(40)]])) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    got = {r["t"]: r["totals"] for r in W.category_maps(df, "v", "k", ["t"], clean=False, block=block).collect()}
    seen = defaultdict(Counter)
    for k, t, v in rows:
        if v is not None and k is not None:
            seen[k][v] += 1
        assert got[t] == (dict(seen[k]) if k is not None else None), t
    assert W.category_maps(df.where("false"), "v", "k", ["t"]).count() == 0


@pytest.mark.parametrize("block", [4, 512])
def test_category_maps_come_in_label_order_and_as_text(spark, block):
    rnd = random.Random(5)
    rows = [(rnd.choice([1, 2, None]), i, rnd.choice([None, *range(-30, 30)])) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, t int, v bigint")
    made = W.category_maps(df, "v", "k", ["t"], block=block).withColumn("totals", F.map_entries("totals"))
    maps = {r["t"]: r["totals"] for r in made.collect()}
    texts = {r["t"]: (r["totals"], r["totals_size"]) for r in W.category_maps(df, "v", "k", ["t"], block=block, text=True).collect()}
    assert len(maps) == len(texts) == 300
    for (k, t, _v) in rows:
        if k is None:
            assert maps[t] is None and texts[t] == (None, None)
        else:
            assert [x for x, _ in maps[t]] == sorted(x for x, _ in maps[t])
            assert texts[t] == (",".join(f"{x}:{n}" for x, n in maps[t]), len(maps[t]))


def test_dates_are_read_like_the_first_value(spark):
    rows = [(1, None), (2, "  "), (3, "March 5, 2021"), (4, "2021-03-06"), (5, "March\u00a07, 2021"), (6, "no date"), (7, "Mar 8, 2021")]
    df = spark.createDataFrame(rows, "id int, d string")
    got = {r["id"]: str(r["x"])[:10] if r["x"] else None for r in W.dates_like_first(df, "d", ["id"], "x").collect()}
    assert got[3] == "2021-03-05" and got[5] == "2021-03-07" and got[4] is None and got[6] is None and got[1] is None
    assert W.first_format(df, "d", [R.By("id", True)]) == "MMM d, yyyy"
    assert W.first_format(df.where("id = 6"), "d", ["id"]) is None and W.first_format(df.where("false"), "d", ["id"]) is None
    assert W.dates_like_first(df.where("id = 6"), "d", ["id"]).where("d is not null").count() == 0


def test_only_written_years_are_replaced(spark, tmp_path):
    path = str(tmp_path / "layer")
    rows = [(i, f"20{10 + i % 3}-05-0{1 + i % 9}", i % 2) for i in range(60)] + [(99, None, 1)]
    df = spark.createDataFrame(rows, "id int, event_date string, x int").withColumn("event_date", F.to_date("event_date"))
    io.write_years(df, path)
    io.write_years(df.withColumn("x", F.lit(7)), path, years=[2011])
    io.write_years(df.where("year(event_date) = 2012 AND id < 30").withColumn("x", F.lit(8)), path)
    back = {r["id"]: (r["event_year"], r["x"]) for r in io.read_parquet(spark, path).collect()}
    for i, day, x in rows:
        year = int(day[:4]) if day else None
        want = 7 if year == 2011 else 8 if year == 2012 else x
        assert (back.get(i) == (year, want)) if year != 2012 or i < 30 else i not in back


def test_mirror_of_a_match_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK_ROWS", 5)
    monkeypatch.setattr(R, "SAMPLES", 2)
    rows = [(1, i) for i in range(101)] + [(2, 500), (2, 501), (3, 600), (None, 700), (None, 701), (2, 500)]
    df = spark.createDataFrame(rows, "m int, e int")
    got = sorted(((r["m"], r["e"], r["opp"]) for r in O.opponent_by_reversal(df, "m", "e", name="opp").collect()), key=repr)
    want = [(1, i, 100 - i) for i in range(101)] + [(2, 500, 501), (2, 500, 500), (2, 501, 500), (3, 600, 600), (None, 700, None), (None, 701, None)]
    assert got == sorted(want, key=repr)
    plan = O.opponent_by_reversal(df, "m", "e", name="opp")._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def test_narrow_lookup_equals_the_wide_one(spark):
    """Numbers in place of left rows: same rows, also where ids are NULL or repeat."""
    rnd = random.Random(6)
    rows = [(rnd.choice([None, 1, 1, 2, 3]), rnd.choice([None, "a", "b", "c"]), rnd.choice([None, "a", "b", "c"]), rnd.choice([None, *range(1, 9)]), rnd.randint(0, 5)) for _ in range(120)]
    df = spark.createDataFrame(rows, "fight_url int, fighter string, opp_url string, event_date int, kd int")
    df = df.withColumns({"cum_kd_in": F.col("kd") + 1, "cum_kd_current": F.col("kd") + 2, "fight_order": F.col("kd")})
    first = df.dropDuplicates(["fighter", "event_date", "fight_url"])  # a total order, so ties can't differ
    wide, narrow = (O.opponent_metrics(first, ["kd"], narrow=n) for n in (False, True))
    assert narrow.columns == wide.columns
    assert sorted(map(repr, narrow.collect())) == sorted(map(repr, wide.collect()))
