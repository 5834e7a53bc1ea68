"""Composite jobs (G1-G5): cleaning, the enriched career table, results statistics,
match statistics from rounds, and the page-extraction chain."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import scalars as S
from skein.operators import aggregate as A
from skein.operators import joins as J
from skein.operators import opponent as O
from skein.operators import running as R
from skein.operators import windows as W
from skein.operators.cleaners import CLEANERS, schema_of
from skein.operators.reshape import validate_columns, wide_to_long
from skein.session import stored_table
from skein.sources import io

# The career table's category and numeric running totals.
CAREER_DUMMIES = ("result", "result_method", "weight_class")
CAREER_NUMERICS = ("title_fight", "perf_bonus", "fight_of_the_night", "fight_duration_seconds")

# Required columns of the wide results table and of the clean rounds table.
RESULTS_REQUIRED = (
    "fight_url", "event_url", "weight_class", "method", "round", "time", "title_fight", "perf_bonus",
    "fight_of_the_night", "time_seconds", "fight_duration_seconds", "fighter1_url", "fighter2_url",
    "fighter1_result", "fighter2_result", "result_type",
)
ROUNDS_REQUIRED = (
    "fight_url", "fighter", "round", "kd", "sub_att", "rev", "ctrl_seconds", "sig_str_landed", "sig_str_attempted",
    "total_str_landed", "total_str_attempted", "head_landed", "head_attempted", "body_landed", "body_attempted",
    "leg_landed", "leg_attempted", "distance_landed", "distance_attempted", "clinch_landed", "clinch_attempted",
    "ground_landed", "ground_attempted", "td_landed", "td_attempted",
)


def run_clean(spark: SparkSession, paths: Mapping[str, Mapping[str, str]], location_width: str = "row", multiline: bool = True) -> dict:
    """G1: raw JSON (explicit schemas; one array a file, or JSON Lines without ``multiline``)
    -> cleaners -> clean Parquet layer. Map-only jobs."""
    out = {}
    for table, cleaner in CLEANERS.items():
        raw = io.read_json(spark, paths["raw"][table], schema_of(table), multiline)
        clean = cleaner(raw, width=location_width) if table == "events" else cleaner(raw)
        io.write_parquet(clean, paths["clean"][table])
        out[table] = paths["clean"][table]
    return out


def career_table(
    results: DataFrame, fighters: DataFrame, events: DataFrame, order_date: str = "date",
    categories: dict | None = None, strategy: str | None = None,
) -> DataFrame:
    """Wide -> long (P1), star join (J4), composite label (C16), running totals."""
    long = wide_to_long(results)
    df = J.star_join(long, fighters, events)
    df = df.withColumn("result_method", S.composite_label("result", "method_type"))
    return W.career_totals(
        df, "fighter_url", [order_date, "fight_url", "fighter_url"], dummy_cols=CAREER_DUMMIES,
        numerical_cols=CAREER_NUMERICS, row_count_col="total_fights", categories=categories, strategy=strategy,
    )


def results_stats(
    results: DataFrame, events: DataFrame | None = None, fighters: DataFrame | None = None,
    windows: Sequence[int] = (3, 5), on: str = "asof", strategy: str | None = None, materialize: bool = True,
) -> DataFrame:
    """V1 -> J1 -> P1 -> W6-W10 -> W11 -> W12 -> J3."""
    validate_columns(results, RESULTS_REQUIRED, "results")
    df = J.merge_events(results, events) if events is not None else results
    long = wide_to_long(df)
    order = ["event_date", "fight_url", "fighter_url"]
    if on == "asof":
        # the opponents' records first, while the rows are narrow. Rows without a participant
        # have no statistics and are dealt apart, so both passes by participant share an exchange
        # (participants and seconds don't depend on the events)
        who = wide_to_long(results).select("time_seconds", F.explode(F.array("fighter_url", "opp_url")).alias("k"))
        fits, limbs = R.even(who, "k", "time_seconds", count=strategy != "window")
        plan = R.Layout(limbs=limbs) if fits else None
        if plan is None and materialize:
            long = stored_table(long, "matches")
        home = plan or R.Layout(R.layout(long, "fighter_url", order)[0].bounds, limbs=limbs)
        apart = F.when(F.col("fighter_url").isNull(), F.pmod(F.xxhash64("fight_url", "opp_url"), F.lit(256)).cast("int")).otherwise(0)
        key = "fighter_url" if home.bounds is not None else ["fighter_url", "_apart"]
        opp = O.opponent_records(long, on=on, strategy=strategy, plan=plan).withColumn("_apart", apart)
        own = W.results_own_stats(opp, key, order, windows=windows, strategy=strategy, plan=home)
        out = O.opponent_totals(own, key, order, strategy=strategy, plan=home)
        records = [c for c in opp.columns if c not in long.columns and c != "_apart"]
        totals = [c for c in out.columns if c not in own.columns]
        out = out.select(*[c for c in own.columns if c not in records and c != "_apart"], *records, *totals)
    else:
        # both passes by participant take one layout: the same rows, key and order
        plan = R.layout(long, "fighter_url", order)[0] if strategy != "window" else None
        own = W.results_own_stats(long, "fighter_url", order, windows=windows, strategy=strategy, plan=plan)
        opp = O.opponent_records(own, on=on, strategy=strategy, materialize=materialize)
        out = O.opponent_totals(opp, "fighter_url", order, strategy=strategy, plan=plan)
    return J.merge_entities(out, fighters) if fighters is not None else out


def fight_stats(
    rounds: DataFrame, results: DataFrame | None = None, events: DataFrame | None = None,
    fighters: DataFrame | None = None, windows: Sequence[int] = (3, 5), on: str = "asof",
    strategy: str | None = None, materialize: bool = True,
) -> DataFrame:
    """V1 -> J2 -> J1 (or W17) -> A1 -> A2 -> W13-W15 -> J8 -> W16 -> J3."""
    validate_columns(rounds, ROUNDS_REQUIRED, "rounds")
    df = J.merge_results(rounds, results) if results is not None else rounds
    if events is not None:
        df = J.merge_events(df, events)
    else:
        df = W.synthetic_dates(df, ["fight_url", "fighter", "round"])
    fights = A.accuracy(A.aggregate_rounds(df))
    if "event_date" not in fights.columns:
        raise ValueError("the matches have no event_date: pass events, or rounds that carry it")
    fights = fights.withColumn("event_date", F.col("event_date").cast("timestamp_ntz"))
    keys = ["fight_url", "fighter", "event_date", "fight_order"]
    metrics = W.metric_columns(fights, exclude=keys)
    order = ["event_date", "fight_url", "fighter"]
    # the opponent mapping only needs (match, participant): attach it while rows are narrow.
    fights = O.opponent_by_reversal(fights, "fight_url", "fighter", order=["fighter"], strategy=strategy)
    if materialize:  # the statistics ask for row counts and magnitudes before they read the rows
        fights = stored_table(fights, "fights")
    if on == "asof":
        # the opponents' sums first, while the rows hold metrics and no statistics of them
        who = fights.select(F.explode(F.array("fighter", "opp_url")).alias("k"))
        plan = R.Layout() if R.even(who, "k", count=strategy != "window")[0] else None
        opp = O.opponent_metrics(fights, metrics, entity_col="fighter", on=on, strategy=strategy, plan=plan, averages=False)
        if plan is None and materialize:
            opp = stored_table(opp, "opponents")
        stats = W.metric_stats(opp, "fighter", order, metrics, windows, strategy=strategy, plan=plan)
        found = [c for c in opp.columns if c not in fights.columns]
        stats = O.opponent_averages(stats.select(*[c for c in stats.columns if c not in found], *found), metrics)
    else:
        stats = W.metric_stats(fights, "fighter", order, metrics, windows, strategy=strategy)
        stats = O.opponent_metrics(stats, metrics, entity_col="fighter", on=on, strategy=strategy, materialize=materialize)
    stats = stats.drop("fight_order").withColumnRenamed("fighter", "fighter_url")
    return J.merge_entities(stats, fighters) if fighters is not None else stats


def run_transform(
    spark: SparkSession, paths: Mapping[str, Mapping[str, str]], years: Sequence[int] | None = None,
    tables: Sequence[str] = ("results", "rounds"), on: str = "asof",
) -> dict:
    """S4 -> G3 and G4 -> S7: the clean layer's tables in, the transformed ``results`` and
    ``rounds`` (one row per match and participant) out, by event year. Statistics always run
    over all years, since every row depends on the ones before; ``years`` limits what is
    written, and years that are not written keep their files."""
    clean = io.load_layer(spark, paths, "clean")
    made = {
        "results": lambda: results_stats(clean["results"], clean["events"], clean["fighters"], on=on),
        "rounds": lambda: fight_stats(clean["rounds"], clean["results"], clean["events"], clean["fighters"], on=on),
    }
    for name in tables:
        io.write_years(made[name](), paths["transformed"][name], "event_date", years)
    return {name: paths["transformed"][name] for name in tables}
