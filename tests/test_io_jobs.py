"""Raw JSON arrays -> cleaners -> clean Parquet layer -> lazy layer load."""

import json

from skein.plans.jobs import run_clean
from skein.sources import io


def test_run_clean_layers(spark, tmp_path):
    paths = io.layer_paths(str(tmp_path))
    raw = {
        "events": [{"event": "E", "event_url": "/e", "date": "March 30, 2024", "location": "Macau, China"}],
        "results": [{"fight_url": "/f", "event_url": "/e", "winner": "win", "fighters_urls": ["/a", "/b"], "weight_class": "LW",
                     "method": "KO/TKO\n Punch", "round": "1", "time": "0:30", "title_fight": True, "perf_bonus": False,
                     "fight_of_the_night": False}],
        "fighters": [{"full_name": "A", "fighter_url": "/a", "nickname": None, "height": "5' 10\"", "reach": '70"',
                      "stance": "Orthodox", "date_of_birth": "Jul 22, 1989", "record": "1-0-0"}],
        "rounds": [{"round": 1, "fight_url": "/f", "fighter": "/a", "kd": "1", "sig_str": "5 of 9", "sig_str_pct": "55%",
                    "total_str": "6 of 10", "td": "0 of 1", "td_pct": "0%", "sub_att": "0", "rev": "0", "ctrl": "0:12",
                    "head": "1 of 2", "body": "1 of 1", "leg": "3 of 6", "distance": "5 of 9", "clinch": "0 of 0",
                    "ground": "0 of 0"}],
    }
    for t, recs in raw.items():
        p = tmp_path / f"{t}.json"
        p.write_text(json.dumps(recs))  # one JSON array per file, as the scraper writes it
        paths["raw"][t] = str(p)
    run_clean(spark, paths)
    layer = io.load_layer(spark, paths, "clean")
    assert layer["events"].first()["country"] == "China"
    r = layer["results"].first()
    assert (r["fighter1_url"], r["method_type"], r["fight_duration_seconds"]) == ("/a", "Knockout", 30.0)
    assert layer["fighters"].first()["height_cm"] == 177.8
    assert layer["rounds"].first()["ctrl_seconds"] == 12.0


def test_json_and_parquet_roundtrip(spark, tmp_path):
    df = io.rows_to_frame(spark, [(1, "a"), (2, "b")], "k int, v string")
    io.write_json(df, str(tmp_path / "j"))
    assert sorted(r["k"] for r in io.read_json(spark, str(tmp_path / "j"), "k int, v string", multiline=False).collect()) == [1, 2]
    io.write_parquet(df, str(tmp_path / "p"), partition_by=["v"])
    assert io.read_parquet(spark, str(tmp_path / "p"), ["k", "v"]).count() == 2


def _wide(spark):
    import datetime as dt

    cols = ("fight_url string, event_url string, weight_class string, method string, round int, time string, title_fight boolean, "
            "perf_bonus boolean, fight_of_the_night boolean, time_seconds double, fight_duration_seconds double, fighter1_url string, "
            "fighter2_url string, fighter1_result string, fighter2_result string, result_type string")
    rows = [("m1", "e1", "LW", "KO", 1, "1:00", False, False, False, 60.0, 60.0, "a", "b", "Win", "Loss", "Win"),
            ("m2", "e2", "LW", "KO", 1, "2:00", False, False, False, 120.0, 120.0, "a", "c", "Win", "Loss", "Win"),
            ("m3", "e3", "LW", "KO", 1, "3:00", False, False, False, 180.0, 180.0, "b", "c", "Win", "Loss", "Win")]
    events = spark.createDataFrame([("e1", dt.date(2020, 1, 1)), ("e2", dt.date(2020, 2, 1)), ("e3", dt.date(2020, 3, 1))],
                                   "event_url string, date date")
    return spark.createDataFrame(rows, cols), events


def test_results_stats_job(spark):
    import pytest

    from skein.plans.jobs import results_stats

    wide, events = _wide(spark)
    with pytest.raises(ValueError):
        results_stats(wide.drop("result_type"), events)
    out = {(r["fight_url"], r["fighter_url"]): r for r in results_stats(wide, events).collect()}
    assert len(out) == 6
    r = out[("m3", "b")]  # b lost m1; opponent c lost m2 before m3 and m3 itself
    assert (r["cumulative_losses_in"], r["opp_cumulative_losses_in"], r["opp_cumulative_losses_after"]) == (1, 1, 2)
    # b's opponents' wins after each of b's matches: a after m1 = 1, c after m3 = 0 -> running sum 1
    assert r["total_opp_cumulative_wins_after"] == 1


def test_fight_stats_job_without_events(spark):
    from skein.plans.jobs import ROUNDS_REQUIRED, fight_stats

    cols = ", ".join(f"{c} {'string' if c in ('fight_url', 'fighter') else 'double'}" for c in ROUNDS_REQUIRED)
    base = {c: 1.0 for c in ROUNDS_REQUIRED}
    data = []
    for m, (p, q) in enumerate([("a", "b"), ("a", "c")]):
        for who in (p, q):
            for rnd in (1.0, 2.0):
                rec = dict(base, fight_url=f"m{m}", fighter=who, round=rnd)
                data.append(tuple(rec[c] for c in ROUNDS_REQUIRED))
    out = fight_stats(spark.createDataFrame(data, cols))  # no events: synthetic dates (W17)
    got = {(r["fight_url"], r["fighter_url"]): r for r in out.collect()}
    assert len(got) == 4 and got[("m0", "a")]["opp_url"] == "b" and got[("m1", "c")]["opp_url"] == "a"
    assert got[("m1", "a")]["cum_kd_in"] == 2.0 and got[("m1", "a")]["avg_kd_current"] == 2.0
    assert "fight_order" not in out.columns  # a helper of the job, as specified
