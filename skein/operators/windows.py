"""Per-entity running statistics (W1-W10, W13-W15, W17) on the ``running`` engine.

Every function takes the entity column and the order columns explicitly (Spark has no
row order). All measures of one call are built in one ``running`` pass, i.e. one shared
partitioning and one Window node.
"""

from __future__ import annotations

from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.functions import scalars as S
from skein.operators import running as R


def _require(df: DataFrame, cols: Iterable[str], what: str = "DataFrame") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"Missing required columns in {what}: {missing}")


# ---------------------------------------------------------------- W1-W4 running totals


def _label(df: DataFrame, column: str, clean: bool) -> Column:
    return S.clean_label(column) if clean and _is_string(df, column) else F.col(column)


def category_values(df: DataFrame, column: str, clean: bool = True) -> list:
    """Distinct category labels: the names of the total columns to come, so as many as the
    result has columns. For labels that grow with the data use ``category_totals``, whose
    schema does not depend on them."""
    found = df.select(_label(df, column, clean).alias("v")).where(F.col("v").isNotNull()).distinct().collect()
    return sorted(r["v"] for r in found)


def category_totals(df: DataFrame, column: str, group_col: str, order: Sequence, clean: bool = True,
                    strategy: str | None = None) -> DataFrame:
    """W1 in long form: every row with ``category`` (its own label) and ``total`` (rows of its
    entity with that label so far). The number of labels does not shape the schema, so it
    needs no list and has no limit."""
    _require(df, [group_col, column])
    labelled = df.withColumn("category", _label(df, column, clean))
    out = R.running(labelled, [group_col, "category"], order, [R.row_number("total")], strategy)
    return out.withColumn("total", F.col("total").cast("bigint"))


def category_maps(df: DataFrame, column: str, group_col: str, order: Sequence, name: str = "totals", clean: bool = True,
                  block: int = 512, strategy: str | None = None, text: bool = False, keep: Sequence[str] | None = None) -> DataFrame:
    """W1 for labels of any number: every row with a map ``name`` from each label its entity has
    had so far to its count, in order of the labels; a label that has not come yet has no entry
    (its total is 0). With ``text`` the map is written as ``label:count,...`` and its number of
    entries stands in ``{name}_size``.

    Rows are numbered by the running engine and taken in blocks of ``block`` rows. The counts
    before a block are merged from the blocks' counts per label (a label's count at its last
    block carries over to the blocks up to its next one); a block's rows then follow them in
    order, each adding its own label. No list of labels reaches the driver, and no row looks
    further back than its block. Rows without an entity have a NULL map. ``keep``: the columns
    of ``df`` that the caller wants (all by default); the others do not travel with the blocks.
    """
    _require(df, [group_col, column, *(keep or [])])
    label = _label(df, column, clean).alias("_label")
    # the label comes after the pass: then all that reads the rows below shares one exchange of them
    rows = R.running(df, group_col, order, [R.row_number("_n")], strategy)
    rows = rows.select("*", label).withColumn("_block", F.floor((F.col("_n") - 1) / block))
    keyed = rows.where(F.col("_n").isNotNull())
    counts = keyed.where(F.col("_label").isNotNull()).groupBy(group_col, "_label", "_block").agg(F.count(F.lit(1)).alias("_c"))
    last = keyed.groupBy(group_col).agg(F.max("_block").alias("_last"))
    line = Window.partitionBy(group_col, "_label").orderBy("_block")
    so_far = counts.select(group_col, "_label", "_block", F.sum("_c").over(line).alias("_c"), F.lead("_block").over(line).alias("_next"))
    held = so_far.join(last.where(F.col("_last") > 0), group_col).withColumn("_until", F.coalesce("_next", "_last"))
    carried = held.where(F.col("_until") > F.col("_block")).select(
        group_col, F.explode(F.sequence(F.col("_block") + 1, F.col("_until"))).alias("_block"), F.struct("_label", "_c", F.col("_label").cast("string").alias("_t")).alias("_e"))
    heads = carried.groupBy(group_col, "_block").agg(F.collect_list("_e").alias("_before")).withColumn("_n", F.lit(0).cast(rows.schema["_n"].dataType))
    none = F.lit(None).cast(heads.schema["_before"].dataType)
    kept = df.columns if keep is None else list(keep)
    passed = keyed.select(*dict.fromkeys([*kept, group_col]), "_label", "_n", "_block").withColumn("_before", none)
    both = heads.unionByName(passed, allowMissingColumns=True)
    dealt = both.repartition(group_col, "_block").sortWithinPartitions(group_col, "_block", "_n")
    made = [T.StructField(name, T.MapType(rows.schema["_label"].dataType, T.LongType()))]
    if text:
        made = [T.StructField(name, T.StringType()), T.StructField(f"{name}_size", T.IntegerType())]
    shown = F.col("_label").cast("string").alias("_shown")
    dealt = dealt.select(*kept, F.col(group_col).alias("_key"), "_label", shown, "_n", "_before", "_block")
    counted = dealt.mapInArrow(_label_maps(len(kept), name, text), T.StructType([*dealt.schema.fields[: len(kept)], *made]))
    without = rows.where(F.col("_n").isNull())
    return counted.unionAll(without.select(*kept, *[F.lit(None).cast(f.dataType).alias(f.name) for f in made]))


_MAP_ENTRIES = 1 << 18  # entries of the maps that are handed on together


def _label_maps(width: int, name: str, text: bool):
    """Rows of (``width`` columns, key, label, its text, number, counts before the block, block),
    blocks in order of the number and headed by those counts -> the columns and every row's map,
    or its text and size."""

    def run(batches):
        from bisect import bisect_left

        import pyarrow as pa

        place, labels, counts, shown = None, [], [], []  # the block at hand, its labels in order
        for batch in batches:
            key, label, written, number, before, block = batch.columns[width:]
            n, lab, words = number.to_pylist(), label.to_pylist(), written.to_pylist()
            places = list(zip(key.to_pylist(), block.to_pylist()))
            keys, values, ends, taken = [], [], [0], []

            def made():
                some = batch.take(pa.array(taken, pa.int64())).columns[:width]
                if text:
                    out, names = [pa.array(keys, pa.string()), pa.array(values, pa.int32())], [name, f"{name}_size"]
                else:
                    out, names = [pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys, label.type), pa.array(values, pa.int64()))], [name]
                return pa.RecordBatch.from_arrays([*some, *out], names=[*batch.schema.names[:width], *names])

            for i, v in enumerate(lab):
                if places[i] != place:
                    place, labels, counts, shown = places[i], [], [], []
                if n[i] == 0:
                    first = sorted((e["_label"], e["_c"], e["_t"]) for e in before[i].as_py())
                    labels, counts = [e[0] for e in first], [e[1] for e in first]
                    shown = [f"{e[2]}:{e[1]}" for e in first] if text else []
                    continue
                if v is not None:
                    j = bisect_left(labels, v)
                    if j < len(labels) and labels[j] == v:
                        counts[j] += 1
                        if text:
                            shown[j] = f"{words[i]}:{counts[j]}"
                    else:
                        labels.insert(j, v)
                        counts.insert(j, 1)
                        if text:
                            shown.insert(j, f"{words[i]}:1")
                if text:
                    keys.append(",".join(shown))
                    values.append(len(shown))
                else:
                    keys += labels
                    values += counts
                ends.append(ends[-1] + len(labels))
                taken.append(i)
                if ends[-1] >= _MAP_ENTRIES:
                    yield made()
                    keys, values, ends, taken = [], [], [0], []
            if taken:
                yield made()

    return run


def _is_string(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def _dummy_measures(df, column, prefix, categories, clean, qualify, taken, drop_null_category=False):
    label = _label(df, column, clean)
    if categories is None:
        categories = category_values(df, column, clean)
    if drop_null_category:  # D2 option: NULL (cleaned to '') gets no total column
        categories = [v for v in categories if v != ""]
    out = []
    for v in categories:
        name = f"{prefix}{column}_{v}" if qualify else f"{prefix}{v}"
        if name in taken:
            raise ValueError(f"category column {name!r} collides with an existing column; use qualify=True")
        taken.add(name)
        out.append(R.cum_sum(name, F.when(label == F.lit(v), F.lit(1)).otherwise(F.lit(0)).cast("bigint")))
    return out


def numeric_input(df: DataFrame, column: str) -> Column:
    """W2 coercion: bool -> int, numeric as is, text -> lenient number; NULL -> 0."""
    dt = df.schema[column].dataType
    if isinstance(dt, T.BooleanType):
        c = F.col(column).cast("int")
    elif isinstance(dt, T.NumericType):
        c = F.col(column)
    else:
        c = S.to_number(column)
    return F.coalesce(c, F.lit(0))


def career_totals(
    df: DataFrame,
    group_col: str,
    order: Sequence,
    dummy_cols: Sequence[str] = (),
    numerical_cols: Sequence[str] = (),
    prefix: str = "total_",
    row_count_col: str | None = "row_count",
    categories: dict | None = None,
    clean: bool = True,
    qualify: bool = False,
    strategy: str | None = None,
    drop_null_category: bool = False,
) -> DataFrame:
    """W4 (W1 + W2 + W3): running counts per category, running sums, running row count.

    Numeric inputs are replaced by their coerced value (NULL/junk -> 0), as the totals are
    sums of that value. Category columns are sorted by label per dummy column.
    """
    _require(df, [group_col, *dummy_cols, *numerical_cols])
    categories = categories or {}
    taken = set(df.columns)
    measures = []
    for c in dummy_cols:
        measures += _dummy_measures(df, c, prefix, categories.get(c), clean, qualify, taken, drop_null_category)
    coerced = {c: numeric_input(df, c) for c in numerical_cols}
    base = df.withColumns(coerced) if coerced else df
    for c in numerical_cols:
        name = f"{prefix}{c}"
        if name in taken:
            raise ValueError(f"total column {name!r} collides with an existing column")
        taken.add(name)
        measures.append(R.cum_sum(name, F.col(c)))
    if row_count_col:
        measures.append(R.row_number(row_count_col))
    out = R.running(base, group_col, order, measures, strategy)
    if row_count_col:
        out = out.withColumn(row_count_col, F.col(row_count_col).cast("bigint"))
    return out


def dummy_totals(df, dummy_col, group_col, order, prefix="total_", **kw) -> DataFrame:
    """W1 alone."""
    return career_totals(df, group_col, order, dummy_cols=[dummy_col], prefix=prefix, row_count_col=None, **kw)


def numeric_totals(df, num_col, group_col, order, prefix="total_", **kw) -> DataFrame:
    """W2 alone."""
    return career_totals(df, group_col, order, numerical_cols=[num_col], prefix=prefix, row_count_col=None, **kw)


def row_count(df, group_col, order, name="row_count", strategy=None) -> DataFrame:
    """1-based running row number."""
    out = R.running(df, group_col, order, [R.row_number(name)], strategy)
    return out.withColumn(name, F.col(name).cast("bigint"))


# ---------------------------------------------------------------- W5 latest snapshot


def _as_time(df: DataFrame, column: str, date_format: str | None) -> Column:
    if not isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column)
    text = F.trim(F.col(column))
    return F.try_to_timestamp(text, F.lit(date_format)) if date_format else F.try_to_timestamp(text)


def unparsed_dates(df: DataFrame, date_col: str, date_format: str | None = None) -> DataFrame:
    """Rows whose text date is there but not readable: the rows that P4 and W5 leave out."""
    return df.where(F.col(date_col).isNotNull() & _as_time(df, date_col, date_format).isNull())


def drop_unparsed(df: DataFrame, date_col: str, date_format: str | None = None) -> DataFrame:
    """``date_col`` as a timestamp; rows without a readable date are left out."""
    return df.withColumn(date_col, _as_time(df, date_col, date_format)).where(F.col(date_col).isNotNull())


def latest_per_entity(
    df: DataFrame, entity_col: str, date_col: str, ties: Sequence[str] = (), tie: str = "first",
    date_format: str | None = None,
) -> DataFrame:
    """W5 + P4: one row per entity at its latest date; unparseable dates and NULL entities
    dropped. ``tie='first'`` keeps the first row of the last day in ``ties`` order (reference
    behaviour), ``'last'`` the last one (complete totals).

    Text dates are read by ``date_format`` (a Spark pattern such as ``MMMM d, yyyy``; without
    one, ISO forms); ``unparsed_dates`` lists the rows this leaves out.

    A grouped ``min_by``/``max_by`` (map-side partial aggregation) instead of a window: a hot
    entity is reduced in every map task before the shuffle.
    """
    _require(df, [entity_col, date_col])
    cols = df.columns
    base = drop_unparsed(df, date_col, date_format).where(F.col(entity_col).isNotNull())
    row = F.struct(*[F.col(c) for c in cols])
    tkey = S.wall_micros(F.col(date_col), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    if tie == "first":
        pick = F.min_by(row, F.struct(-tkey, *[F.col(c) for c in ties]))
    elif tie == "last":
        pick = F.max_by(row, F.struct(tkey, *[F.col(c) for c in ties]))
    else:
        raise ValueError("tie must be 'first' or 'last'")
    return base.groupBy(entity_col).agg(pick.alias("_r")).select("_r.*")


# The date forms that a column may be written in, most likely first.
DATE_FORMATS = ("MMMM d, yyyy", "MMM d, yyyy", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy", "d.M.yyyy", "yyyyMMdd")


def first_format(df: DataFrame, column: str, order: Sequence[str], formats: Sequence[str] = DATE_FORMATS) -> str | None:
    """The form of the first value that is there (in ``order``, blanks skipped): the first of
    ``formats`` that reads it, None if none does. One aggregate with a single row; of the
    table only the first value reaches the driver."""
    text = F.trim(F.translate(F.col(column), "\u00a0", " "))
    kinds = [R.By(o) if isinstance(o, str) else o for o in order]
    place = F.struct(*[c.alias(f"o{i}_{j}") for i, o in enumerate(kinds) for j, c in enumerate(o.place(df.schema[o.name].dataType))])
    first = df.where(text != "").agg(F.min_by(text, place).alias("v"))
    chosen = F.coalesce(*[F.when(_read(F.col("v"), f).isNotNull(), F.lit(f)) for f in formats])
    return first.select(chosen.alias("f")).first()["f"]


def _read(text: Column, fmt: str) -> Column:
    return F.try_to_timestamp(F.trim(F.translate(text, "\u00a0", " ")), F.lit(fmt))


def dates_like_first(df: DataFrame, column: str, order: Sequence[str], name: str | None = None, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """``column`` read by the form of its first value; values of any other form are NULL, as
    are all of them if the first has no known form. ``name`` (default: the column itself) gets
    the timestamp; with another name, rows that were not read are those with a text and no date."""
    fmt = first_format(df, column, order, formats)
    return df.withColumn(name or column, _read(F.col(column), fmt) if fmt else F.lit(None).cast("timestamp"))


# ---------------------------------------------------------------- W6-W10 results stats


def results_own_stats(
    df: DataFrame,
    entity_col: str | Sequence[str] = "fighter_url",
    order: Sequence = ("event_date", "fight_url", "fighter_url"),
    result_col: str = "result",
    time_col: str = "time_seconds",
    date_col: str | None = "event_date",
    windows: Sequence[int] = (3, 5),
    after: bool = True,
    incoming: bool = True,
    rolling: bool = True,
    time_diffs: bool = True,
    strategy: str | None = None,
    plan: R.Layout | None = None,
) -> DataFrame:
    """W6 (after), W7 (incoming), W8/W9 (fixed windows), W10 (day gaps) in one pass."""
    _require(df, [*([entity_col] if isinstance(entity_col, str) else entity_col), result_col, time_col] + ([date_col] if time_diffs and date_col else []))
    base = df.withColumns(
        {
            "win": F.coalesce(F.col(result_col) == "Win", F.lit(False)).cast("int"),
            "loss": F.coalesce(F.col(result_col) == "Loss", F.lit(False)).cast("int"),
        }
    )
    win, loss, tm = F.col("win"), F.col("loss"), F.col(time_col)
    ms = [
        R.row_number("_n"),
        R.cum_sum("_w", win),
        R.cum_sum("_l", loss),
        R.cum_sum("_ts", tm),
        R.cum_count("_tc", tm),
        R.cum_sum_before("_tsi", "_ts", tm),
    ]
    if rolling:
        for w in windows:
            ms += [
                R.rows_sum(f"rolling_{w}_wins", win, -(w - 1), 0),
                R.rows_count(f"rolling_{w}_fights", win, -(w - 1), 0),
                R.rows_avg(f"rolling_{w}_avg_time", tm, -(w - 1), 0),
                R.rows_sum(f"rolling_{w}_wins_in", win, -w, -1),
                R.rows_count(f"rolling_{w}_fights_in", win, -w, -1),
                R.rows_avg(f"rolling_{w}_avg_time_in", tm, -w, -1),
            ]
    if time_diffs and date_col:
        ms += [R.cum_min("_first", date_col), R.lag("_prev", date_col, 1)]
    out = R.running(base, entity_col, order, ms, strategy, plan)
    n = F.col("_n").cast("bigint")
    derived = {}
    if after:
        derived.update(
            {
                "total_fights_after": n,
                "cumulative_wins_after": F.col("_w"),
                "cumulative_losses_after": F.col("_l"),
                "win_rate_after": F.col("_w") / n,
                "avg_time_seconds_after": S.safe_ratio(F.col("_ts"), F.col("_tc")),
            }
        )
    if incoming:  # what came before is the running total without the row
        wins_in = F.coalesce(F.col("_w") - win, F.lit(0)).cast("bigint")
        derived.update(
            {
                "total_fights_in": n - 1,
                "cumulative_wins_in": wins_in,
                "cumulative_losses_in": F.coalesce(F.col("_l") - loss, F.lit(0)).cast("bigint"),
                "win_rate_in": S.safe_ratio(wins_in, n - 1),
                "avg_time_seconds_in": S.safe_ratio(F.col("_tsi"), F.col("_tc") - tm.isNotNull().cast("bigint")),
            }
        )
    if rolling:
        for w in windows:
            derived[f"rolling_{w}_win_rate"] = F.col(f"rolling_{w}_wins") / F.col(f"rolling_{w}_fights")
            derived[f"rolling_{w}_win_rate_in"] = S.safe_ratio(F.col(f"rolling_{w}_wins_in"), F.col(f"rolling_{w}_fights_in"))
    if time_diffs and date_col:
        derived["time_since_first_fight"] = S.day_diff(F.col(date_col), F.col("_first"))
        derived["time_since_last_fight"] = S.day_diff(F.col(date_col), F.col("_prev"))
    out = out.withColumns(derived)
    helpers = ["_n", "_w", "_l", "_ts", "_tc", "_tsi", "_first", "_prev"]
    return out.drop(*[h for h in helpers if h in out.columns])


def time_differences(
    df: DataFrame, entity_col: str, order: Sequence, date_col: str, strategy: str | None = None
) -> DataFrame:
    """W10 alone: days since the entity's first date and since its previous row."""
    ms = [R.cum_min("_first", date_col), R.lag("_prev", date_col, 1)]
    out = R.running(df, entity_col, order, ms, strategy)
    return out.withColumns(
        {
            "time_since_first_fight": S.day_diff(F.col(date_col), F.col("_first")),
            "time_since_last_fight": S.day_diff(F.col(date_col), F.col("_prev")),
        }
    ).drop("_first", "_prev")


# ---------------------------------------------------------------- W13-W15 per-metric stats


def metric_columns(df: DataFrame, exclude: Sequence[str] = (), prefixes=("cum_", "avg_", "rolling_")) -> list[str]:
    """Numeric (incl. boolean) columns minus keys minus derived prefixes."""
    out = []
    for f in df.schema.fields:
        if not isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            continue
        if f.name in exclude or any(f.name.startswith(p) for p in prefixes):
            continue
        out.append(f.name)
    return out


LAGGED = 16  # longest rolling frame that is read from lagged rows


def metric_stats(
    df: DataFrame,
    entity_col: str,
    order: Sequence,
    metrics: Sequence[str],
    windows: Sequence[int] = (3, 5),
    order_col: str | None = "fight_order",
    strategy: str | None = None,
    plan: R.Layout | None = None,
    late: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """W13 (0-based order), W14 (cumulative current/incoming + averages), W15 (rolling
    incoming sums, means and counts) for every metric, in one Window pass.

    A rolling frame of up to ``LAGGED`` rows is read from the metrics of the rows before, which
    travel as one struct per place: one offset function a place, however many metrics there
    are, in place of two sliding aggregates a metric and window. The sums add from the oldest
    row on, as the aggregate does. Longer frames and decimals keep the aggregates.

    ``late`` adds metrics that are made of a row's own columns (accuracies) once the rows are
    dealt and sorted, so they are not exchanged."""
    full = late(df) if late else df
    _require(full, [entity_col, *metrics])
    ms = [R.row_number("_n")]
    kinds = {m: full.schema[m].dataType for m in metrics}
    x = {m: F.col(m).cast("double") if isinstance(kinds[m], T.BooleanType) else F.col(m) for m in metrics}
    decimal = {m for m in metrics if isinstance(kinds[m], T.DecimalType)}
    lagged = [w for w in windows if w <= LAGGED]
    numbers = [m for m in metrics if m not in decimal]
    for m in metrics:
        ms += [R.cum_sum(f"_cur_{m}", x[m]), R.cum_sum_before(f"_in_{m}", f"_cur_{m}", x[m])]
        for w in windows:
            if m in decimal or w > LAGGED:
                mean = R.rows_avg if m in decimal else R.rows_count  # else the mean is sum over count
                ms += [R.rows_sum(f"rolling_{w}_{m}_in", x[m], -w, -1), mean(f"rolling_{w}_avg_{m}_in", x[m], -w, -1)]
    places = list(range(1, max(lagged, default=0) + 1)) if numbers else []
    if places:
        wide = F.struct(*[x[m].cast("bigint" if isinstance(kinds[m], T.IntegralType) else "double").alias(f"v{i}") for i, m in enumerate(numbers)])
        ms += [R.lag(f"_lag{j}", wide, j) for j in places]
    out = R.running(df, entity_col, order, ms, strategy, plan, late)
    k = F.col("_n").cast("bigint") - 1
    derived, means = {}, {}
    if order_col:
        derived[order_col] = k
    for m in metrics:
        cur = F.when(F.col(m).isNotNull(), F.col(f"_cur_{m}"))
        before = F.col(f"_in_{m}")
        derived[f"cum_{m}_current"] = cur
        derived[f"avg_{m}_current"] = cur / (k + 1)
        derived[f"cum_{m}_in"] = before
        derived[f"avg_{m}_in"] = F.when(k > 0, before / k)
    for w in windows:
        for m in numbers:
            total, count = f"`rolling_{w}_{m}_in`", f"`rolling_{w}_avg_{m}_in`"
            if w in lagged:
                values = [f"_lag{j}.v{numbers.index(m)}" for j in range(w, 0, -1)]
                zero = "0L" if isinstance(kinds[m], T.IntegralType) else "0D"
                summed = " + ".join(f"coalesce({v}, {zero})" for v in values)
                derived[f"rolling_{w}_{m}_in"] = F.expr(f"CASE WHEN coalesce({', '.join(values)}) IS NOT NULL THEN {summed} END")
                count = " + ".join(f"CAST({v} IS NOT NULL AS INT)" for v in values)
            means[f"rolling_{w}_avg_{m}_in"] = F.expr(f"{total} / nullif({count}, 0)")
        derived[f"rolling_{w}_fights_in"] = F.when(k.isNotNull(), F.least(k, F.lit(w).cast("bigint")))
    out = out.withColumns(derived)
    if means:
        out = out.withColumns(means)
    return out.drop("_n", *[f"_{s}_{m}" for m in metrics for s in ("cur", "in")], *[f"_lag{j}" for j in places])


# ---------------------------------------------------------------- W17


def synthetic_dates(df: DataFrame, order: Sequence, name: str = "event_date", start: str = "1970-01-01") -> DataFrame:
    """``start + (row index)`` days over a given total order (no event table).

    The row index is a global order: the running engine with a constant key, which it cuts
    into chunks like any hot key, so no single task sees all rows.
    """
    keyed = df.withColumn("_all", F.lit(0))
    out = R.running(keyed, "_all", order, [R.row_number("_i")], "chunked")
    return out.withColumn(name, F.date_add(F.to_date(F.lit(start)), (F.col("_i") - 1).cast("int"))).drop("_all", "_i")
