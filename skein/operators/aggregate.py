"""Aggregations (A1-A8). All grouped work uses partial (map-side) aggregation, so a hot
group is reduced in every map task before the shuffle; nothing collects a group."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.functions import scalars as S
from skein.session import cut_lineage

# The nine landed/attempted statistic pairs of the round tables.
FRACTION_STATS = ("sig_str", "total_str", "head", "body", "leg", "distance", "clinch", "ground", "td")


def aggregate_rounds(
    df: DataFrame,
    group_cols: Sequence[str] = ("fight_url", "fighter"),
    max_cols: Sequence[str] = ("round",),
    order_col: str | Sequence[str] = "round",
) -> DataFrame:
    """A1: per (match, participant): ``max`` of ``max_cols``, ``sum`` of every other numeric
    or boolean column (sum of nothing = 0), first non-NULL (in ``order_col`` order, extra
    columns break ties) of every other column. Rows with a NULL group key are dropped."""
    ocols = [order_col] if isinstance(order_col, str) else list(order_col)
    okey = F.struct(*[F.col(c) for c in ocols]) if len(ocols) > 1 else F.col(ocols[0])
    keyed = df
    for g in group_cols:
        keyed = keyed.where(F.col(g).isNotNull())
    aggs = []
    for f in df.schema.fields:
        c = f.name
        if c in group_cols:
            continue
        if c in max_cols:
            aggs.append(F.max(c).alias(c))
        elif isinstance(f.dataType, T.BooleanType):
            aggs.append(F.coalesce(F.sum(F.col(c).cast("bigint")), F.lit(0)).alias(c))
        elif isinstance(f.dataType, T.NumericType):
            aggs.append(F.coalesce(F.sum(c), F.lit(0)).alias(c))
        else:
            if c in ocols:
                continue
            aggs.append(F.min_by(c, F.when(F.col(c).isNotNull(), okey)).alias(c))
    return keyed.groupBy(*group_cols).agg(*aggs)


def accuracy(df: DataFrame, stats: Sequence[str] = FRACTION_STATS) -> DataFrame:
    """A2: ``<first token>_accuracy = landed / attempted`` when attempted > 0; pairs whose
    columns are absent are skipped."""
    new = {}
    for s in stats:
        landed, attempted = f"{s}_landed", f"{s}_attempted"
        if landed in df.columns and attempted in df.columns:
            new[f"{landed.split('_')[0]}_accuracy"] = S.safe_ratio(F.col(landed), F.col(attempted))
    return df.withColumns(new) if new else df


def _span_micros(date_col: str):
    t = F.col(date_col).cast("timestamp_ntz")
    return S.wall_micros(F.max(t), F.min(t))


def avg_interval(df: DataFrame, entity_col: str, date_col: str, name: str = "avg_interval") -> DataFrame:
    """A3: per entity ``days(max - min) / (n - 1)`` (float), entities with n > 1 only."""
    n = F.count(date_col)
    days = F.floor(_span_micros(date_col) / F.lit(86_400_000_000))
    return (
        df.groupBy(entity_col)
        .agg((days / (n - 1)).alias(name), n.alias("_n"))
        .where(F.col("_n") > 1)
        .drop("_n")
    )


def avg_interval_days(df: DataFrame, entity_col: str, date_col: str, name: str = "avg_interval_days") -> DataFrame:
    """A4: ``(max - min) / (n - 1)`` floored to whole days; NULL when n <= 1."""
    n = F.count(date_col)
    days = F.floor(_span_micros(date_col) / (n - 1) / F.lit(86_400_000_000)).cast("bigint")
    return df.groupBy(entity_col).agg(F.when(n > 1, days).alias(name))


def dedupe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A5: drop duplicate rows (or by a column subset); NULLs compare equal."""
    return df.dropDuplicates(list(cols)) if cols else df.dropDuplicates()


def histogram(df: DataFrame, col: str, nbins: int = 40) -> DataFrame:
    """Equal-width histogram between min and max, empty bins included.

    The column is stored once (its input may be a long plan), then read for the bounds, one
    global min/max aggregate (two scalars to the driver), and for the counts, a partial
    aggregation by bin; the ``nbins`` bin rows come from ``range``.
    """
    df = cut_lineage(df.select(col))
    lo, hi = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_start double, bin_end double, count bigint")
    width = (hi - lo) / nbins if hi > lo else 1.0
    x = F.col(col).cast("double")
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(nbins - 1))
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    bins = spark.range(nbins).select(F.col("id").cast("int").alias("bin"))
    return (
        bins.join(counts, "bin", "left")
        .select(
            "bin",
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
            (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
            F.coalesce(F.col("count"), F.lit(0)).alias("count"),
        )
    )


# Outcome categories of the outcome matrix, in display order.
OUTCOME_METHODS = ("Knockout", "Submission", "Decision")


def outcome_matrix(latest: DataFrame, entity_col: str, prefix: str = "total_") -> DataFrame:
    """Per entity, {Knockout, Submission, Decision} x {wins, losses} counts from the
    latest running totals (absent total -> 0), as (entity, method, outcome, n) rows."""
    rows = []
    for m in OUTCOME_METHODS:
        for outcome, word in (("wins", "win"), ("losses", "loss")):
            c = f"{prefix}{word}_{m.lower()}"
            v = F.coalesce(F.col(c), F.lit(0)) if c in latest.columns else F.lit(0)
            rows.append(F.struct(F.lit(m).alias("method"), F.lit(outcome).alias("outcome"), v.cast("bigint").alias("n")))
    return latest.select(entity_col, F.explode(F.array(*rows)).alias("_o")).select(entity_col, "_o.*")
