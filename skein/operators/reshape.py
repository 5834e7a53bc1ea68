"""Projections, reshapes, set operations and work lists."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import scalars as S


def validate_columns(df: DataFrame, required: Sequence[str], df_name: str = "input") -> None:
    """V1: driver-side schema check, no job."""
    absent = sorted(set(required) - set(df.columns))
    if absent:
        raise ValueError(f"{df_name} lacks {', '.join(absent)}")


def wide_to_long(
    df: DataFrame,
    first: str = "fighter1",
    second: str = "fighter2",
    entity: str = "fighter_url",
    result: str = "result",
    opp: str = "opp_url",
    role: str = "role",
) -> DataFrame:
    """Two-participant rows -> one row per participant (role, entity, result, opponent).

    One scan: ``explode`` of a two-element array of structs. Other columns keep their
    place; the entity/result columns take the place of the first participant's columns,
    role and opponent are appended. Missing ``*_url`` -> KeyError; missing ``*_result``
    -> NULL result.
    """
    u1, u2, r1, r2 = f"{first}_url", f"{second}_url", f"{first}_result", f"{second}_result"
    missing = [c for c in (u1, u2) if c not in df.columns]
    if missing:
        raise KeyError(f"missing participant columns {missing}")
    null = F.lit(None).cast("string")
    res1 = F.col(r1) if r1 in df.columns else null
    res2 = F.col(r2) if r2 in df.columns else null
    pair = F.array(
        F.struct(F.lit(first).alias("role"), F.col(u1).alias("e"), res1.alias("r"), F.col(u2).alias("o")),
        F.struct(F.lit(second).alias("role"), F.col(u2).alias("e"), res2.alias("r"), F.col(u1).alias("o")),
    )
    out_cols: list[Column] = []
    placed_result = False
    for c in df.columns:
        if c == u1:
            out_cols.append(F.col("_p.e").alias(entity))
        elif c == r1:
            out_cols.append(F.col("_p.r").alias(result))
            placed_result = True
        elif c in (u2, r2):
            continue
        else:
            out_cols.append(F.col(c))
    if not placed_result:
        out_cols.append(F.col("_p.r").alias(result))
    out_cols += [F.col("_p.role").alias(role), F.col("_p.o").alias(opp)]
    return df.withColumn("_p", F.explode(pair)).select(*out_cols)


def union_rows(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by name; missing columns become NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def keyed_concat(df: DataFrame, array_col: str, ordinal: str = "round", value: str = "value") -> DataFrame:
    """One row per array element with a 1-based ordinal (``posexplode``)."""
    return df.select("*", F.posexplode(array_col).alias("_pos", value)).withColumn(ordinal, F.col("_pos") + 1).drop(
        "_pos", array_col
    )


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename, ignoring absent columns."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def drop_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop, ignoring absent columns (``errors='ignore'``)."""
    return df.drop(*[c for c in cols if c in df.columns])


def entity_rows(df: DataFrame, column: str, value) -> DataFrame:
    """Rows of one entity (pushed down to the Parquet scan)."""
    return df.where(F.col(column) == F.lit(value))


def normalize_columns(df: DataFrame) -> DataFrame:
    """E6 on a DataFrame's header."""
    return df.toDF(*[S.normalize_header(c) for c in df.columns])


def event_urls(df: DataFrame, column: str = "event_url") -> DataFrame:
    """K1: projection, duplicates kept; missing column -> KeyError."""
    if column not in df.columns:
        raise KeyError(column)
    return df.select(column)


def flattened_urls(df: DataFrame, column: str = "fighters_urls", name: str = "url") -> DataFrame:
    """K2: distinct elements of a list column; missing column -> ValueError."""
    if column not in df.columns:
        raise ValueError(f"column {column!r} not found")
    return df.select(F.explode(column).alias(name)).distinct()


def distinct_urls(df: DataFrame, column: str = "fight_url") -> DataFrame:
    """K3: distinct values; missing column -> ValueError."""
    if column not in df.columns:
        raise ValueError(f"column {column!r} not found")
    return df.select(column).distinct()


def sorted_output(df: DataFrame, cols: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    """Final presentation sort, NULLs last as in pandas. Only at output."""
    return df.orderBy(*[F.col(c).desc_nulls_last() if c in descending else F.col(c).asc_nulls_last() for c in cols])


def tail_rows(df: DataFrame, cols: Sequence[str], n: int = 5) -> DataFrame:
    """The last ``n`` rows in ``cols`` order (top-k: a limited sort, no full sort)."""
    return df.orderBy(*[F.col(c).desc_nulls_first() for c in cols]).limit(n)
