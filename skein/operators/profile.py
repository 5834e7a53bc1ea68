"""Profile metrics (F1-F5) and the history view (P6), set-oriented: every entity at once.
``as_of`` replaces "today" so results are reproducible (D11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import scalars as S
from skein.operators.aggregate import avg_interval_days, outcome_matrix
from skein.operators.windows import latest_per_entity


def _as_of(as_of) -> Column:
    return F.lit(str(as_of)).cast("timestamp_ntz")


def age_years(dob, as_of) -> Column:
    """whole elapsed days // 365 (not calendar years)."""
    return F.floor(S.day_diff(_as_of(as_of), dob) / 365).cast("bigint")


def days_since(d, as_of) -> Column:
    """whole days from ``d`` to ``as_of``."""
    return S.day_diff(_as_of(as_of), d)


def entity_profile(
    careers: DataFrame,
    as_of,
    entity_col: str = "fighter_url",
    date_col: str = "date",
    ties: tuple = ("fight_url", "fighter_url"),
    dob_col: str | None = "date_of_birth",
    prefix: str = "total_",
) -> DataFrame:
    """F3 + F4 + F5: one profile row per entity — the latest career row (W5) with age, days
    since the last match, floored average days between matches (A4), the ``W-L-D`` record,
    total time as a clock string, display date and the cumulative bonus totals."""
    latest = latest_per_entity(careers, entity_col, date_col, ties=list(ties))
    intervals = avg_interval_days(careers, entity_col, date_col)
    prof = latest.join(intervals, entity_col, "left")
    total = lambda n: F.col(prefix + n) if prefix + n in prof.columns else F.lit(0)
    new = {
        "time_since_last_days": days_since(F.col(date_col), as_of),
        "record_wld": S.record_string(total("win"), total("loss"), total("draw")),
        "last_date_display": S.date_display(F.col(date_col)),
    }
    if dob_col and dob_col in prof.columns:
        new["age"] = age_years(F.col(dob_col), as_of)
    if prefix + "fight_duration_seconds" in prof.columns:
        new["total_time_display"] = S.seconds_to_clock(F.col(prefix + "fight_duration_seconds"))
    for c in ("height_cm", "reach_cm"):
        if c in prof.columns:
            new[c + "_display"] = S.display_round(F.col(c), 2)
    return prof.withColumns(new)


def profile_outcomes(careers: DataFrame, entity_col: str = "fighter_url", date_col: str = "date",
                     ties: tuple = ("fight_url", "fighter_url")) -> DataFrame:
    """F5 chart data: the outcome matrix (A8) of each entity's latest totals."""
    return outcome_matrix(latest_per_entity(careers, entity_col, date_col, ties=list(ties)), entity_col)


# The history table's columns, in display order.
HISTORY_COLUMNS = (
    "date", "event", "weight_class", "opp_full_name", "method", "round", "time", "result",
    "fight_duration", "title_fight", "perf_bonus", "fight_of_the_night",
)


def history(careers: DataFrame, entity_col: str = "fighter_url", entity=None, columns=HISTORY_COLUMNS,
            date_col: str = "date", duration_col: str = "fight_duration_seconds", ties: tuple = ()) -> DataFrame:
    """P6 (+P3, O3): per-match history rows with the duration as a clock string and the date
    for display, newest first, equal dates by the ``ties`` columns. ``entity`` filters one
    entity (pushed to the scan)."""
    df = careers if entity is None else careers.where(F.col(entity_col) == F.lit(entity))
    derived = {"fight_duration": S.seconds_to_clock(F.col(duration_col)), "_sort_date": F.col(date_col)}
    df = df.withColumns(derived).withColumn(date_col, S.date_display(F.col(date_col)))
    cols = [entity_col] + [c for c in columns if c in df.columns]
    return df.orderBy(F.col("_sort_date").desc_nulls_last(), *ties).select(*cols)
