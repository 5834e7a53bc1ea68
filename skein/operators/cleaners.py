"""Table cleaners (CL0-CL4) and row contracts (V1, E9). Map-only projections: each is one
``select``/``withColumns`` over native expressions, no shuffle."""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions import scalars as S
from skein.operators.aggregate import FRACTION_STATS
from skein.operators.reshape import validate_columns

# Raw-table required fields (non-NULL) per row model.
REQUIRED_FIELDS = {
    "events": ("event", "event_url", "date", "location"),
    "results": ("fight_url", "winner", "fighters_urls", "weight_class", "method", "round", "time"),
    "rounds": ("round", "fight_url", "fighter"),
    "fighters": ("full_name", "record"),
}

RAW_SCHEMAS = {
    "events": "event string, event_url string, date string, location string",
    "results": (
        "fight_url string, event_url string, winner string, fighters_urls array<string>, weight_class string, "
        "method string, round string, time string, title_fight boolean, perf_bonus boolean, "
        "fight_of_the_night boolean"
    ),
    "rounds": (
        "round int, fight_url string, fighter string, kd string, sig_str string, sig_str_pct string, "
        "total_str string, td string, td_pct string, sub_att string, rev string, ctrl string, head string, "
        "body string, leg string, distance string, clinch string, ground string"
    ),
    "fighters": (
        "full_name string, fighter_url string, nickname string, height string, reach string, stance string, "
        "date_of_birth string, record string"
    ),
}


def apply_cleaner(df: DataFrame, cleaner: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """CL0: ``df.transform(cleaner)``."""
    return df.transform(cleaner)


def location_width(df: DataFrame, column: str = "location") -> int:
    """Widest split of the column (one scalar aggregate)."""
    w = df.agg(F.max(F.size(F.split(F.col(column), ",")))).first()[0]
    return int(w or 0)


def clean_events(df: DataFrame, width: str = "row", date_format: str = "MMMM d, yyyy") -> DataFrame:
    """CL1: parse the date, split the location into city/state/country (C1; ``width``
    ``"row"`` = documented per-row rule, ``"dataset"`` = widest row of the column)."""
    w = location_width(df) if width == "dataset" else None
    loc = S.location_parts("location", w)
    return df.withColumn("date", S.parse_date("date", date_format)).withColumns(
        {"city": loc["city"], "state": loc["state"], "country": loc["country"]}
    )


def _integral(c):
    x = S.to_number(c)
    return F.when(x == F.floor(x), x.cast("int"))


def clean_results(df: DataFrame) -> DataFrame:
    """CL2: seconds, round, duration, method split, result label, method type, participant
    columns and per-participant outcomes; drops ``winner`` and ``fighters_urls``."""
    t = S.time_to_seconds("time")
    rnd = _integral("round")
    meth = S.split_method("method")
    result_type = S.capitalize("winner")
    outcomes = S.participant_outcomes(result_type)
    out = df.withColumns({"time_seconds": t, "round": rnd})
    out = out.withColumns(
        {
            "fight_duration_seconds": S.fight_duration("time_seconds", "round"),
            "method_short": meth["short"],
            "method_detail": meth["detail"],
            "result_type": result_type,
        }
    )
    out = out.withColumns(
        {
            "method_type": S.method_type("method_short"),
            "fighter1_url": S.list_item("fighters_urls", 0),
            "fighter2_url": S.list_item("fighters_urls", 1),
            "fighter1_result": outcomes["first"],
            "fighter2_result": outcomes["second"],
        }
    )
    return out.drop("winner", "fighters_urls")


def clean_fighters(df: DataFrame, date_format: str = "MMM d, yyyy") -> DataFrame:
    """CL3: date of birth, height and reach in centimetres."""
    return df.withColumns(
        {
            "date_of_birth": S.parse_date("date_of_birth", date_format),
            "height_cm": S.height_to_cm("height"),
            "reach_cm": S.reach_to_cm("reach"),
        }
    )


def clean_rounds(df: DataFrame) -> DataFrame:
    """CL4: numeric counters, control seconds, percentages, 9 landed/attempted pairs; the 12
    raw text columns dropped."""
    new = {c: S.to_number(c) for c in ("round", "kd", "sub_att", "rev")}
    new["ctrl_seconds"] = S.time_to_seconds("ctrl")
    new["sig_str_pct_num"] = S.parse_percentage("sig_str_pct")
    new["td_pct_num"] = S.parse_percentage("td_pct")
    for s in FRACTION_STATS:
        frac = S.parse_fraction(s)
        new[f"{s}_landed"] = frac["landed"]
        new[f"{s}_attempted"] = frac["attempted"]
    raw = ["ctrl", "sig_str", "total_str", "td_pct", "sig_str_pct", "head", "body", "leg", "distance", "clinch", "ground", "td"]
    return df.withColumns(new).drop(*raw)


CLEANERS: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "events": clean_events,
    "results": clean_results,
    "fighters": clean_fighters,
    "rounds": clean_rounds,
}


def validate_rows(
    df: DataFrame, required: Sequence[str], typed: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows + ``_reason``). A row is rejected when a required
    field is NULL or a typed field does not cast (``try_cast``)."""
    validate_columns(df, required)
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in required]
    for c, t in (typed or {}).items():
        checks.append(F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(f"{c} is not {t}")))
    reasons = F.filter(F.array(*checks), lambda x: x.isNotNull())
    tagged = df.withColumn("_reasons", reasons)
    valid = tagged.where(F.size("_reasons") == 0).drop("_reasons")
    rejected = tagged.where(F.size("_reasons") > 0).withColumn("_reason", F.array_join("_reasons", "; ")).drop("_reasons")
    return valid, rejected


def validate_raw(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """E9 for a raw table: the row model's required fields must be non-NULL."""
    return validate_rows(df, REQUIRED_FIELDS[table])


def schema_of(table: str) -> str:
    """DDL schema of a raw table (readers take DDL strings)."""
    return RAW_SCHEMAS[table]
