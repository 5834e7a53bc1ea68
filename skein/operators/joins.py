"""Dimension joins.

No unconditional broadcast hints: dimension tables grow with the data, so the join
strategy is left to Spark's size checks (``autoBroadcastJoinThreshold`` from statistics,
and AQE re-planning from the actual shuffle sizes). ``bounded_dim`` marks a dimension
whose size is bounded by construction (e.g. 25 nations) and hints the broadcast.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators import running as R
from skein.operators.reshape import validate_columns

HOWS = ("outer", "inner", "left", "right")


def bounded_dim(df: DataFrame) -> DataFrame:
    """Broadcast hint for a dimension with a size bound that does not grow with the data."""
    return F.broadcast(df)


def merge_events(df: DataFrame, events: DataFrame, key: str = "event_url", date_col: str = "date") -> DataFrame:
    """Left join of the event table; ``date`` becomes ``event_date``."""
    validate_columns(events, [key, date_col], "Events DataFrame")
    return df.join(events.withColumnRenamed(date_col, "event_date"), key, "left")


def merge_results(df: DataFrame, results: DataFrame, key: str = "fight_url", bring: str = "event_url") -> DataFrame:
    """Left join of the DISTINCT (match, event) bridge."""
    validate_columns(results, [key, bring], "Results DataFrame")
    return df.join(results.select(key, bring).dropDuplicates(), key, "left")


def merge_entities(df: DataFrame, entities: DataFrame, key: str = "fighter_url") -> DataFrame:
    """Full-row dedupe of the entity table, then left join."""
    validate_columns(entities, [key], "Entity DataFrame")
    return df.join(entities.dropDuplicates(), key, "left")


def star_join(
    long_df: DataFrame,
    entities: DataFrame,
    events: DataFrame,
    entity_key: str = "fighter_url",
    opp_key: str = "opp_url",
    event_key: str = "event_url",
    name_col: str = "full_name",
    opp_name: str = "opp_full_name",
) -> DataFrame:
    """Inner joins to the participant dimension, the role-playing opponent dimension
    (key and name renamed) and the event dimension."""
    opp = entities.select(F.col(entity_key).alias(opp_key), F.col(name_col).alias(opp_name))
    return long_df.join(entities, entity_key).join(opp, opp_key).join(events, event_key)


def suffix_collisions(left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    """Rename right-side non-key columns that collide with left columns."""
    ren = {c: c + suffix for c in right.columns if c in left.columns and c not in keys}
    return right.withColumnsRenamed(ren) if ren else right


def join_on(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner", null_safe: bool = False) -> DataFrame:
    """D3: equi-join; ``null_safe`` matches NULL keys to each other (``<=>``, still a hash
    join), which is pandas ``merge`` behaviour. Keys are coalesced into one column."""
    if not null_safe:
        return a.join(b, list(keys), how)
    br = b.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = None
    for k in keys:
        c = a[k].eqNullSafe(br[f"_r_{k}"])
        cond = c if cond is None else cond & c
    out = a.join(br, cond, how)
    merged = {k: F.coalesce(F.col(k), F.col(f"_r_{k}")) for k in keys}
    return out.withColumns(merged).drop(*[f"_r_{k}" for k in keys])


def natural_join(
    a: DataFrame, b: DataFrame, how: str = "outer", order_a: Sequence[str] | None = None,
    order_b: Sequence[str] | None = None,
) -> DataFrame:
    """Join on all common columns (sorted, coalesced); with no common column, a
    positional side-by-side concat given an order for each side (row index from the
    skew-safe running engine, then an equi-join on it)."""
    if not isinstance(a, DataFrame) or not isinstance(b, DataFrame):
        raise ValueError("natural_join takes two DataFrames")
    if how not in HOWS:
        raise ValueError(f"how must be one of {', '.join(HOWS)}, not {how!r}")
    common = sorted(set(a.columns) & set(b.columns))
    if common:
        spark_how = "full" if how == "outer" else how
        return a.join(b, common, spark_how)
    if not order_a or not order_b:
        raise ValueError("no common columns: positional concat needs order_a and order_b")
    ia = _indexed(a, order_a)
    ib = _indexed(b, order_b)
    return ia.join(ib, "_row", "full").drop("_row")


def _indexed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    keyed = df.withColumn("_all", F.lit(0))
    out = R.running(keyed, "_all", order, [R.row_number("_row")], "chunked")
    return out.drop("_all")
