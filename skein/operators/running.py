"""Ordered per-key running measures — the engine under every career statistic.

A *measure* is a window function over the rows of one key in a total order:
cumulative (sum / count / min / max / last non-null, frame ending at the current or the
previous row; next non-null and rows left, looking ahead), bounded ROWS frames looking back
(``[lo, hi]``, ``lo <= hi <= 0``) and lag.

``chunked`` (default, skew-safe)
    1. One narrow aggregate job counts the rows of each key (key column only). A key is
       *hot* if it has more rows than one task should hold: ``CHUNK_ROWS``, or the rows of
       the table over the number of shuffle partitions if that is more, so there are fewer
       hot keys than shuffle partitions.
    2. Without hot keys the plan is a plain window over the key: one exchange, one sort.
    3. The rows of a hot key are cut at literal bounds of the order, taken from a hash sample
       (``SAMPLES`` rows a chunk; a task's chunk is about as long as step 1 allows). A row's
       chunk is the number of bounds at or before its place in the order, so the window runs over
       ``(key, chunk)`` after the same single exchange. Full rows are written nowhere.
    4. Per (hot key, chunk) a partial aggregate gives the chunk's totals; their prefix over the
       key's chunks is stored and joined back on (key, chunk), for which the window's own
       partitioning and sort already serve.
    5. Bounded frames and lag get the last ``h`` rows of earlier chunks as *halo* rows (a
       partial top-k per chunk); cumulative measures skip them, and they are dropped.
    Rows without a key have no measures; where they are many they are spread by a hash.
    What is broadcast is at most two places in the order per shuffle partition.
    The jobs of 1 and 3-5 read the input again, pruned to the columns they need and, for 3-5,
    to the hot keys: an input that is dear to compute should be stored by the caller first.

``window``
    ``Window.partitionBy(key).orderBy(order)`` and no count: a key's rows all go to one task.
    Only for groups that the caller knows to be bounded.

Sums of DOUBLE and FLOAT columns are exact. A value is cut into whole multiples of powers of
2**24 (limbs); each limb is summed as a long, where the order of additions cannot matter, and
the totals are put together once per row. Which limbs occur is asked of the data (one narrow
aggregate: largest and smallest magnitude, fractions, infinities; whole numbers below 2**24
need a single limb). No magnitude is lost and nothing raises between the smallest and the
largest double: 2**39 rows of one key are needed to fill a limb's long. NaN counts as
missing; infinities give infinity, or NaN if both signs occurred. Both strategies and any
number of partitions give equal values, bit for bit.

The order must be total (append unique tie-breakers) so results and retried tasks are
deterministic. Rows with a NULL key get NULL measures (pandas ``groupby`` drops them).
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field, replace
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.session import cut_lineage

DEFAULT = "chunked"
CHUNK_ROWS = 50_000
SAMPLES = 64  # sampled rows per chunk, and bounds per group of bounds
LIMB = 24  # bits
_CUMULATIVE = ("sum", "count", "min", "max", "last", "next", "rest")
_AHEAD = ("next", "rest")
_FRAMED = ("frame_sum", "frame_count", "frame_avg", "frame_min", "frame_max", "lag")


@dataclass(frozen=True)
class Measure:
    name: str
    kind: str
    expr: Column = field(compare=False)
    inclusive: bool = True
    lo: int = 0
    hi: int = 0
    of: str | None = None

    @property
    def halo(self) -> int:
        if self.kind == "lag":
            return self.lo
        if self.kind in _FRAMED:
            return -self.lo
        return 0


def _e(expr) -> Column:
    return F.col(expr) if isinstance(expr, str) else expr


def cum_sum(name, expr, inclusive=True) -> Measure:
    return Measure(name, "sum", _e(expr), inclusive)


def cum_sum_before(name, of, expr) -> Measure:
    """The running sum ``of`` (a ``cum_sum`` of the same expression in the same call) without
    the row itself, taken from it exactly; 0 where nothing came before."""
    return Measure(name, "before", _e(expr), False, of=of)


def cum_count(name, expr, inclusive=True) -> Measure:
    return Measure(name, "count", _e(expr), inclusive)


def cum_min(name, expr, inclusive=True) -> Measure:
    return Measure(name, "min", _e(expr), inclusive)


def cum_max(name, expr, inclusive=True) -> Measure:
    return Measure(name, "max", _e(expr), inclusive)


def cum_last(name, expr, inclusive=True) -> Measure:
    """Last non-NULL value so far (as-of lookups carry their payload as a struct)."""
    return Measure(name, "last", _e(expr), inclusive)


def cum_next(name, expr) -> Measure:
    """First non-NULL value at or after the row."""
    return Measure(name, "next", _e(expr), True)


def row_number(name) -> Measure:
    return Measure(name, "count", F.lit(1), True)


def rows_left(name) -> Measure:
    """Number of rows from this one to the key's last: a row number from the end."""
    return Measure(name, "rest", F.lit(1), True)


def rows_sum(name, expr, lo, hi=0) -> Measure:
    return Measure(name, "frame_sum", _e(expr), True, lo, hi)


def rows_count(name, expr, lo, hi=0) -> Measure:
    return Measure(name, "frame_count", _e(expr), True, lo, hi)


def rows_avg(name, expr, lo, hi=0) -> Measure:
    return Measure(name, "frame_avg", _e(expr), True, lo, hi)


def rows_min(name, expr, lo, hi=0) -> Measure:
    return Measure(name, "frame_min", _e(expr), True, lo, hi)


def rows_max(name, expr, lo, hi=0) -> Measure:
    return Measure(name, "frame_max", _e(expr), True, lo, hi)


def lag(name, expr, k=1) -> Measure:
    return Measure(name, "lag", _e(expr), True, k, k)


# ---------------------------------------------------------------- order


@dataclass(frozen=True)
class By:
    """A column of the order. NULLs come last unless ``nulls_first``, as in pandas."""

    name: str
    descending: bool = False
    nulls_first: bool = False

    def sort(self, back: bool = False) -> Column:
        c = F.col(self.name)
        if self.descending != back:
            return c.desc_nulls_first() if self.nulls_first != back else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first != back else c.asc_nulls_last()

    def place(self, kind: T.DataType) -> list[Column]:
        """Columns that ascend as the rows are ordered."""
        c = F.col(self.name)
        return [c.isNotNull() if self.nulls_first else c.isNull(), *(_inverted(c, kind) if self.descending else [c])]


_SORT = re.compile(r"Column<'(.+) (ASC|DESC) NULLS (FIRST|LAST)'>")


def by(order: Sequence) -> list[By]:
    """Order columns: names (ascending), ``By``, or a plain column's ``asc``/``desc`` form."""
    out = []
    for o in order:
        if isinstance(o, str):
            o = By(o)
        elif isinstance(o, Column):
            m = _SORT.fullmatch(str(o))
            o = By(m[1], m[2] == "DESC", m[3] == "FIRST") if m else By(str(o)[8:-2])
        out.append(o)
    return out


def order_cols(*names, descending: Sequence[str] = ()) -> list[By]:
    """pandas-compatible sort orders: NULLs last in both directions."""
    return [By(n, n in descending) for n in names]


def _inverted(c: Column, kind: T.DataType) -> list[Column]:
    """Columns that ascend where ``c`` descends."""
    if isinstance(kind, T.IntegralType):
        return [F.bitwise_not(c)]
    if isinstance(kind, T.DecimalType):
        return [-c]
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return [~F.isnan(c), F.when(~F.isnan(c), -c)]  # NaN is the largest number
    if isinstance(kind, T.BooleanType):
        return [~c]
    if isinstance(kind, T.DateType):
        return [F.bitwise_not(F.unix_date(c))]
    if isinstance(kind, T.TimestampType):
        return [F.bitwise_not(F.unix_micros(c))]
    if isinstance(kind, T.TimestampNTZType):
        day = c.cast("date")
        return [F.bitwise_not(F.unix_date(day)), F.bitwise_not(F.timestamp_diff("MICROSECOND", day.cast("timestamp_ntz"), c))]
    if isinstance(kind, (T.StringType, T.BinaryType)):  # a beginning comes after what it begins
        return [F.concat(F.translate(F.hex(c), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))]
    raise TypeError(f"can't order by a descending {kind.simpleString()}")


def _place(df: DataFrame, order: Sequence[By]) -> Column:
    return F.struct(*[c.alias(f"o{i}_{j}") for i, o in enumerate(order) for j, c in enumerate(o.place(df.select(o.name).schema[0].dataType))])


# ---------------------------------------------------------------- exact sums


# Built as SQL text: a call that sums thirty columns has thousands of expression nodes, and one
# parsed text costs the driver far less than a round trip to the JVM for each node.


def _scaled(x: str, power: int) -> str:
    """``x * 2**power``, in two steps where the factor is no double."""
    if abs(power) <= 1000:
        return f"{x} * {_double(2.0**power)}" if power else x
    return f"{x} * {_double(2.0 ** (power // 2))} * {_double(2.0 ** (power - power // 2))}"


def _double(v: float) -> str:
    return f"{v!r}D"


@dataclass(frozen=True)
class Limbs:
    """The limbs that a DOUBLE column's values occupy: multiples of 2**(24 b), low <= b <= high."""

    low: int = 0
    high: int = 0
    infinite: bool = False

    @staticmethod
    def survey(x: str) -> dict[str, str]:
        """What ``found`` reads, as aggregates; ``_min`` folds by the minimum, ``_max`` by the
        maximum."""
        return {f"{x}_max": f"max(CASE WHEN NOT isnan({x}) THEN abs({x}) END)",
                f"{x}_min": f"min(CASE WHEN {_finite(x)} AND {x} <> rint({x}) THEN abs({x}) END)"}

    @classmethod
    def found(cls, row, x: str) -> "Limbs":
        largest, fraction = row[f"{x}_max"] or 0.0, row[f"{x}_min"]
        exponent = lambda v: math.frexp(v)[1] - 1
        infinite = math.isinf(largest)
        high = 1023 // LIMB if infinite else exponent(largest) // LIMB if largest else 0
        low = 0 if fraction is None else max((exponent(fraction) - 52) // LIMB, -45)
        return cls(low, max(high, low), infinite)

    def names(self) -> list[str]:
        return [str(b).replace("-", "m") for b in range(self.low, self.high + 1)] + ["pos", "neg"] * self.infinite

    def parts(self, x: str) -> dict[str, str]:
        """Longs whose sums make up the sum; all NULL for a missing value."""
        out = {}
        for b, name in zip(range(self.low, self.high + 1), self.names()):
            y = _scaled(x, -LIMB * b)
            if b == self.high and not self.infinite:  # nothing lies above it
                out[name] = f"CASE WHEN NOT isnan({x}) THEN CAST({y} AS BIGINT) END"
                continue
            above = f"CAST(CAST({y} * {_double(2.0**-LIMB)} AS BIGINT) AS DOUBLE) * {_double(2.0**LIMB)}"
            own = f"CASE WHEN abs({y}) < {_double(2.0 ** (53 + LIMB))} THEN CAST({y} - {above} AS BIGINT) ELSE 0L END"
            out[name] = f"CASE WHEN {_finite(x)} THEN {own} WHEN NOT isnan({x}) THEN 0L END"
        if self.infinite:
            for name, sign in (("pos", ""), ("neg", "-")):
                out[name] = f"CASE WHEN NOT isnan({x}) THEN CAST({x} = double('{sign}Infinity') AS BIGINT) END"
        return out

    def total(self, parts: dict[str, str]) -> Column:
        """The sum as a double: carries first, then the limbs from the top."""
        powers, names = list(range(self.low, self.high + 1)), self.names()
        limbs, mask = [parts[n] for n in names[: len(powers)]], (1 << LIMB) - 1
        if len(limbs) <= 16:
            carry, digits = "0L", []
            for v in limbs:
                digits.append(f"(({v} + {carry}) & {mask}L)")
                top, carry = f"({v} + {carry})", f"shiftright({v} + {carry}, {LIMB})"
            digits[-1] = top
            out = " + ".join(f"({_scaled(f'CAST({d} AS DOUBLE)', LIMB * b)})" for b, d in reversed(list(zip(powers, digits))))
        else:  # the same over an array, so the text stays short
            step = f"(s, v) -> named_struct('d', array_append(s.d, (v + s.c) & {mask}L), 'c', shiftright(v + s.c, {LIMB}))"
            carried = f"aggregate(array({', '.join(limbs)}), named_struct('d', CAST(array() AS ARRAY<BIGINT>), 'c', 0L), {step})"
            units = ", ".join(f"named_struct('a', {_double(2.0 ** (LIMB * b // 2))}, 'b', {_double(2.0 ** (LIMB * b - LIMB * b // 2))})" for b in powers)
            whole = f"array_append(slice({carried}.d, 1, {len(limbs) - 1}), shiftleft({carried}.c, {LIMB}) + element_at({carried}.d, -1))"
            terms = f"zip_with({whole}, array({units}), (d, u) -> CAST(d AS DOUBLE) * u.a * u.b)"
            out = f"CASE WHEN {limbs[0]} IS NOT NULL THEN aggregate(reverse({terms}), 0.0D, (s, t) -> s + t) END"
        if self.infinite:
            up, down = f"{parts['pos']} > 0", f"{parts['neg']} > 0"
            out = f"CASE WHEN {up} AND {down} THEN double('NaN') WHEN {up} THEN double('Infinity') WHEN {down} THEN double('-Infinity') ELSE {out} END"
        return F.expr(out)


def _own_double(df: DataFrame, e: Column) -> str | None:
    """The name of the DOUBLE column of ``df`` that ``e`` stands for: such a column is summed as it
    is, and no copy of it is exchanged."""
    name = str(e)[8:-2]
    return name if name.isidentifier() and name in df.columns and isinstance(df.schema[name].dataType, T.DoubleType) else None


MANY_LIMBS = 32  # more of them in one pass make a method that the JVM's compiler refuses


def _split(e: Column) -> Column:
    """``e``, computed outside whole-stage code: its projection is then compiled as many small
    methods. In one method over the compiler's limit every row would be interpreted."""
    return F.get(F.transform(F.array(e), lambda v: v), 0)


def _finite(x: str) -> str:
    return f"abs({x}) < double('Infinity')"  # NaN is larger


def _floating(df: DataFrame, measures: Sequence[Measure]) -> set[str]:
    """Names of the sums over floating-point input (analysis only, no job)."""
    sums = [m for m in measures if m.kind in ("sum", "before")]
    kinds = df.select(*[m.expr.alias(f"_t{i}") for i, m in enumerate(sums)]).schema.fields if sums else []
    return {m.name for m, f in zip(sums, kinds) if isinstance(f.dataType, (T.DoubleType, T.FloatType))}


# ---------------------------------------------------------------- layout


@dataclass(frozen=True)
class Layout:
    """How the rows of a key are dealt; later passes over the same rows, key and order take
    it as it is. ``bounds`` is None without hot keys. ``limbs``: those of every DOUBLE that is
    summed over these rows, where the caller knows them; else each pass asks its data."""

    bounds: DataFrame | None = None
    spread_nulls: bool = False
    limbs: Limbs | None = None


_CH, _AT, _B, _HALO = "_rk_chunk", "_rk_at", "_rk_bounds", "_rk_halo"


def _full(keys: Sequence[str]) -> Column:
    full = F.lit(True)
    for k in keys:
        full = full & F.col(k).isNotNull()
    return full


def layout(df: DataFrame, key: str | Sequence[str], order: Sequence, surveys: dict[str, Column] | None = None) -> tuple[Layout, object]:
    """The layout and one row of the ``surveys`` aggregates, both from one narrow job; only hot
    keys cost more (their sampled places in the order are sorted and stored)."""
    keys = [key] if isinstance(key, str) else list(key)
    surveys = surveys or {}
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[s.alias(n) for n, s in surveys.items()])
    outer = [(F.min if n.endswith("_min") else F.max)(n).alias(n) for n in surveys]
    full = _full(keys)
    stats = counted.agg(F.sum("_n").alias("_rows"), F.max(F.when(full, F.col("_n"))).alias("_most"), F.sum(F.when(~full, F.col("_n"))).alias("_without"), *outer).first()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = max(CHUNK_ROWS, -(-(stats["_rows"] or 0) // parts))
    spread = (stats["_without"] or 0) > limit
    if (stats["_most"] or 0) <= limit:
        return Layout(None, spread), stats
    hot = cut_lineage(counted.where(full & (F.col("_n") > limit)).select(*keys))  # fewer than shuffle partitions
    at = _place(df, by(order))
    rows = df.join(F.broadcast(hot), keys, "left_semi").select(*keys, at.alias(_AT))
    sampled = rows.where(F.pmod(F.xxhash64(*keys, _AT), F.lit(limit)) < SAMPLES)
    places = sampled.groupBy(*keys).agg(F.sort_array(F.collect_list(_AT)).alias("s"))
    s = F.col("s")
    cuts = F.transform(F.sequence(F.lit(1), F.floor(F.size(s) / SAMPLES).cast("int")), lambda i: F.get(s, i * SAMPLES - 1))
    cut = places.where(F.size(s) >= SAMPLES).withColumn("c", cuts)
    c = F.col("c")  # groups of bounds: a row compares with the groups' first ones, then within one
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(c) - 1) / SAMPLES).cast("int")), lambda g: F.slice(c, g * SAMPLES + 1, SAMPLES))
    return Layout(cut_lineage(cut.select(*keys, groups.alias(_B))), spread), stats


def even(df: DataFrame, key: str, summed: str | None = None, count: bool = True) -> tuple[bool, Limbs | None]:
    """Whether no key is hot (passes over such rows may take a layout without bounds), and the
    limbs of the column ``summed`` if it is a DOUBLE or FLOAT. One narrow job; without
    ``count`` keys pass as even."""
    floating = summed is not None and isinstance(df.schema[summed].dataType, (T.DoubleType, T.FloatType))
    if not (floating or count):
        return True, None
    rows = df.select(key, F.col(summed).cast("double").alias("_x")) if floating else df.select(key)
    ask = {n: F.expr(c) for n, c in Limbs.survey("_x").items()} if floating else {}
    if count:
        n = F.count(F.when(F.col(key).isNotNull(), F.lit(1))).alias("_n")
        outer = [(F.min if a.endswith("_min") else F.max)(a).alias(a) for a in ask]
        seen = rows.groupBy(key).agg(n, *[c.alias(a) for a, c in ask.items()]).agg(F.sum("_n").alias("_rows"), F.max("_n").alias("_most"), *outer).first()
    else:
        seen = rows.agg(*[c.alias(a) for a, c in ask.items()]).first()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fits = not count or (seen["_most"] or 0) <= max(CHUNK_ROWS, -(-(seen["_rows"] or 0) // parts))
    return fits, Limbs.found(seen, "_x") if floating else None


def _chunk(at: Column) -> Column:
    groups = F.col(_B)
    first = F.size(F.filter(groups, lambda g: F.get(g, F.lit(0)) <= at))
    within = F.size(F.filter(F.get(groups, first - 1), lambda b: b <= at))
    return F.when(groups.isNull() | (first == 0), F.lit(0)).otherwise((first - 1) * SAMPLES + within)


# ---------------------------------------------------------------- the pass


_FN = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "frame_sum": F.sum, "frame_count": F.count, "frame_avg": F.avg, "frame_min": F.min, "frame_max": F.max}


def _over(measures: Sequence[Measure], exprs: Sequence[Column], there, back) -> list[Column]:
    """Window expressions of the measures; each frame is made once."""
    frames: dict = {}

    def frame(spec, lo, hi):
        key = (spec is back, lo, hi)
        if key not in frames:
            frames[key] = spec.rowsBetween(lo, hi)
        return frames[key]

    out = []
    for m, e in zip(measures, exprs):
        if m.kind in _AHEAD:  # ``back`` runs from the end: what has been seen is what is to come
            agg, over = F.last(e, ignorenulls=True) if m.kind == "next" else F.count(e), frame(back, Window.unboundedPreceding, Window.currentRow)
        elif m.kind == "lag":
            agg, over = F.lag(e, m.lo), there
        elif m.kind in _CUMULATIVE:
            agg = F.last(e, ignorenulls=True) if m.kind == "last" else _FN[m.kind](e)
            over = frame(there, Window.unboundedPreceding, Window.currentRow if m.inclusive else -1)
        else:
            agg, over = _FN[m.kind](e), frame(there, m.lo, m.hi)
        out.append(agg.over(over).alias(m.name))
    return out


def running(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence,
    measures: Iterable[Measure],
    strategy: str | None = None,
    plan: Layout | None = None,
    late: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Append one column per measure. ``order`` = names, ``By`` or sorted columns, total within
    a key. ``plan`` = the ``layout`` of an earlier pass over the same rows, key and order.
    ``late`` adds columns that are made of a row's own ones (neither key nor order): without
    hot keys the rows are dealt and sorted before they get them."""
    keys = [key] if isinstance(key, str) else list(key)
    measures, order = list(measures), by(order)
    narrow, df = df, late(df) if late else df
    if not measures:
        return df
    strategy = strategy or DEFAULT
    if strategy not in ("chunked", "window"):
        raise ValueError(f"unknown strategy {strategy!r}; expected 'chunked' or 'window'")
    floating = _floating(df, measures)
    x = {m.name: _own_double(df, m.expr) or f"_rk_x{i}" for i, m in enumerate(measures) if m.kind == "sum" and m.name in floating}
    copies = [m.expr.cast("double").alias(x[m.name]) for m in measures if m.name in x and x[m.name] not in df.columns]
    rows = df.select("*", *copies) if copies else df
    ask = {n: F.expr(c) for name in x.values() for n, c in Limbs.survey(name).items()}
    if strategy == "chunked" and plan is None:
        plan, seen = layout(rows, keys, order, ask)
    else:
        plan = plan or Layout()
        seen = rows.agg(*[c.alias(n) for n, c in ask.items()]).first() if ask and plan.limbs is None else None
    limbs = {name: plan.limbs or Limbs.found(seen, col) for name, col in x.items()}
    inner, finals = [], {}
    for m in measures:
        if m.name in x:  # one sum per limb
            inner += [replace(m, name=f"_rk_{m.name}_{n}", expr=F.expr(c)) for n, c in limbs[m.name].parts(x[m.name]).items()]
            finals[m.name] = limbs[m.name].total({n: f"`_rk_{m.name}_{n}`" for n in limbs[m.name].names()})
        elif m.kind != "before":
            inner.append(m)
            finals[m.name] = F.col(m.name)
        elif m.of in x:
            own = limbs[m.of].parts(x[m.of])
            finals[m.name] = limbs[m.of].total({n: f"(coalesce(`_rk_{m.of}_{n}`, 0L) - coalesce({c}, 0L))" for n, c in own.items()})
        else:
            finals[m.name] = F.coalesce(F.col(m.of), F.lit(0)) - F.coalesce(m.expr, F.lit(0))
    if late and plan.bounds is None and not plan.spread_nulls:
        rows = late(narrow.repartition(*keys).sortWithinPartitions(*keys, *[o.sort() for o in order]))
        rows = rows.select("*", *copies) if copies else rows
    cut = [i for i, m in enumerate(inner) if m.name.startswith("_rk_")]
    if len(cut) > MANY_LIMBS:
        inner[cut[0]] = replace(inner[cut[0]], expr=_split(inner[cut[0]].expr))
    out = _dealt(rows, keys, order, inner, plan)
    full = _full(keys)
    return out.select(*df.columns, *[F.when(full, c).alias(n) for n, c in finals.items()])


def _dealt(df: DataFrame, keys, order, measures, plan: Layout) -> DataFrame:
    cols = df.columns
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # rows without a key have no measures: any place will do
    apart = F.when(~_full(keys), -1 - F.pmod(F.xxhash64(*[o.name for o in order]), F.lit(parts).cast("bigint")).cast("int"))
    there_by, back_by = [o.sort() for o in order], [o.sort(back=True) for o in order]
    if plan.bounds is None:
        if plan.spread_nulls:
            df = df.withColumn(_CH, apart)
        part = Window.partitionBy(*keys, *([_CH] if plan.spread_nulls else []))
        return df.select(*cols, *_over(measures, [m.expr for m in measures], part.orderBy(*there_by), part.orderBy(*back_by)))
    at = _place(df, order)
    cut = df.withColumn(_AT, at).join(F.broadcast(plan.bounds), keys, "left").withColumn(_CH, F.coalesce(apart, _chunk(F.col(_AT))) if plan.spread_nulls else _chunk(F.col(_AT)))
    hot = cut.where(F.col(_B).isNotNull())
    rows = cut.drop(_AT, _B)
    totals, routes = _chunk_totals(hot, keys, measures)
    halo = max([m.halo for m in measures] + [0])
    body, not_halo = rows, F.lit(True)
    if halo:
        tails = _tails(hot, keys, order, routes, halo).select(*rows.columns)
        body = rows.withColumn(_HALO, F.lit(False)).unionByName(tails.withColumn(_HALO, F.lit(True)))
        not_halo = ~F.col(_HALO)
    part = Window.partitionBy(*keys, _CH)
    there, back = part.orderBy(*there_by), part.orderBy(*back_by)
    own = _over(measures, [F.when(not_halo, m.expr) if halo and m.kind in _CUMULATIVE else m.expr for m in measures], there, back)
    done = body.select(*cols, _CH, *([_HALO] if halo else []), *own).where(not_halo)
    if totals is None:
        return done
    # (key, chunk) is how the window has dealt and sorted its rows
    out = done.join(totals, [*keys, _CH], "left")
    finals = []
    for i, m in enumerate(measures):
        if m.kind not in _CUMULATIVE:
            finals.append(F.col(m.name))
            continue
        loc, off = F.col(m.name), F.col(f"_o{i}")
        if m.kind in ("sum", "count", "rest"):
            both = F.when(loc.isNull() & off.isNull(), loc).otherwise(F.coalesce(loc, F.lit(0)) + F.coalesce(off, F.lit(0)))
        elif m.kind in ("min", "max"):
            both = (F.least if m.kind == "min" else F.greatest)(loc, off)
        else:
            both = F.coalesce(loc, off)
        finals.append(both.alias(m.name))
    return out.select(*cols, *finals)


def _chunk_totals(hot: DataFrame, keys, measures) -> tuple[DataFrame | None, DataFrame]:
    """Per (hot key, chunk): what comes before (or after) it of every cumulative measure, and
    the following chunks with their numbers of rows. Both stored."""
    halo = max([m.halo for m in measures] + [0])
    aggs, cums = [F.count(F.lit(1)).alias("_n")], [(i, m) for i, m in enumerate(measures) if m.kind in _CUMULATIVE]
    for i, m in cums:
        e = m.expr
        if m.kind in ("next", "last"):
            pick = F.min_by if m.kind == "next" else F.max_by
            aggs.append(pick(e, F.when(e.isNotNull(), F.col(_AT))).alias(f"_c{i}"))
        else:
            fn = {"sum": F.sum, "count": F.count, "rest": F.count, "min": F.min, "max": F.max}[m.kind]
            aggs.append(fn(e).alias(f"_c{i}"))
    chunks = hot.groupBy(*keys, _CH).agg(*aggs)
    line = Window.partitionBy(*keys).orderBy(_CH)
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.col(_CH).desc()).rowsBetween(Window.unboundedPreceding, -1)
    cols = []
    for i, m in cums:
        c, frame = F.col(f"_c{i}"), after if m.kind in _AHEAD else before
        if m.kind in ("next", "last"):
            cols.append(F.last(c, ignorenulls=True).over(frame).alias(f"_o{i}"))
        else:
            cols.append({"min": F.min, "max": F.max}.get(m.kind, F.sum)(c).over(frame).alias(f"_o{i}"))
    for j in range(1, halo + 1):
        cols += [F.lead(_CH, j).over(line).alias(f"_np{j}"), F.lead("_n", j).over(line).alias(f"_nn{j}")]
    table = cut_lineage(chunks.select(*keys, _CH, *cols))
    return (table.select(*keys, _CH, *[f"_o{i}" for i, _ in cums]) if cums else None), table


def _tails(hot: DataFrame, keys, order, routes: DataFrame, halo: int) -> DataFrame:
    """The last ``halo`` rows of every chunk, once for each later chunk that needs them."""
    last = Window.partitionBy(*keys, _CH).orderBy(*[o.sort(back=True) for o in order])
    tail = hot.drop(_AT, _B).withColumn("_r", F.row_number().over(last)).where(F.col("_r") <= halo)
    targets, skipped = [], F.lit(0)
    for j in range(1, halo + 1):
        targets.append(F.when(F.col(f"_np{j}").isNotNull() & (F.col("_r") + skipped <= halo), F.col(f"_np{j}")))
        skipped = skipped + F.coalesce(F.col(f"_nn{j}"), F.lit(0))
    routed = tail.join(routes.select(*keys, _CH, *[f"_n{x}{j}" for j in range(1, halo + 1) for x in "pn"]), [*keys, _CH])
    sent = routed.withColumn("_to", F.explode(F.filter(F.array(*targets), lambda x: x.isNotNull()))).drop(_CH).withColumnRenamed("_to", _CH)
    return cut_lineage(sent.drop(*[f"_n{x}{j}" for j in range(1, halo + 1) for x in "pn"], "_r"))
