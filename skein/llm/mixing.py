"""Mixing sources to target weights by entropy balancing.

Every source s has a target of T(s) words, at most twice its size S(s). A document's rate
r in (0, 2) is the expected number of its copies; among all rates that meet the target
exactly, the chosen ones have the least relative entropy to one copy each. With the
relative entropy of a document weighted by its size plus the source's mean size m(s), the
convex dual has one unknown per source and the rates are exponentially tilted:

    r(d) = 2 / (1 + exp(-lambda(s) * size / (size + m(s))))

Newton iterations find all lambdas at once: each round is one aggregation over the
distinct (source, size) pairs, joined to the current lambdas. The start is 0; the dual's
gradient is concave above 0 and convex below, so the steps approach the root from one side.

Rounding: copy c (1 or 2) of a document has the break point c - r - u, u in [0, 1) from a hash
of its id and text; at 0 a document has r copies in expectation. Copies are taken by break
point while they fit. The first that does not fit ends a round; rows that are equal in id and
text share a break point, and of such a group as many rows are taken as fit. The next round
goes on behind it with the copies that are no longer than the words still missing, until
none is left: no document that was left out would fit. Within one size a document with an
earlier break point goes first. A histogram of break points (``5 * GRID`` cells a source) says how
far a round reads; only the rows of those cells are then summed in order, by the
skew-safe running sums of the library.

Scale: documents are never grouped by source without partial aggregation, the source
table is joined (broadcast only when Spark knows it to be small), and reruns agree because
every choice is a function of the row and of sums over all rows (the Newton sums are
decimal, so their order does not matter; of rows equal in id and text those with the least hash
of all their columns go first).

Defined cases: NULL text has size 0; a NULL source is a source of its own, last in order;
an empty source (all sizes 0) has target 0; of rows equal in id and text some may be taken and
others not; an empty table gives an empty mix; Newton steps that don't converge raise an error.
Other columns are passed through; an output whose name the input has gets underscores
appended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import free, stored, word_count, written
from skein.operators import running as R

GRID = 1 << 10  # cells of the histogram per copy
UNIT = 1 << 50  # break points per copy
TOLERANCE = 1e-7
MAX_ROUNDS = 200
SALTS = 32


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` (from 0): order of the column ``source`` by code point,
    NULL last. Ranges are numbered apart and shifted by the sizes of those before."""
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = stored(sources.repartitionByRange(parts, F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    before, shift = 0, []
    for r in ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():  # a row per range
        shift += [F.lit(r["part"]), F.lit(before).cast("long")]
        before += r["n"]
    if not shift:
        return ordered.withColumn("rank", F.lit(0).cast("long")).drop("part")
    w = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return ordered.withColumn("rank", F.row_number().over(w) - 1 + F.element_at(F.create_map(*shift), F.col("part"))).drop("part")


def targets(sources: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sources`` (source, source_size, ...) with ``target``: ``share`` of all sizes dealt
    by repeating ``weights``, nowhere above ``most`` times the source's size."""
    listed = F.array(*[F.lit(w) for w in weights])
    rows = stored(_ranked(sources).withColumn("w", F.get(listed, (F.col("rank") % len(weights)).cast("int"))))
    cap = most * F.col("source_size")
    level = 0.0
    while True:  # capped sources only get more as the level rises
        at_cap = F.col("w") * F.lit(level) > cap
        r = rows.agg(F.sum("source_size").alias("all"), F.sum(F.when(at_cap, F.col("source_size")).otherwise(0)).alias("capped"), F.sum(F.when(at_cap, 0).otherwise(F.col("w"))).alias("w")).first()
        if not r["w"]:
            break
        new = (share * r["all"] - most * r["capped"]) / r["w"]
        if new <= level:
            break
        level = new
    return rows.withColumn("target", F.least(cap.cast("double"), F.col("w") * F.lit(float(level)))).drop("w", "rank")


def _feature(size, mean):
    return size / (size + mean)


def _rate(tilt, size, mean):
    """Expected copies; a NULL tilt means that the target is the cap."""
    return F.coalesce(2.0 / (1.0 + F.exp(-tilt * _feature(size, mean))), F.lit(2.0))


def balance(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id", weights: tuple = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """The mix of each source: source, source_size, mean, target, tilt, cut."""
    sized = docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    hist = stored(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sums = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("filled"))
    state = targets(sums, weights, share).withColumn("mean", F.col("source_size") / F.greatest("filled", F.lit(1)))
    free = (F.col("target") > 0) & (F.col("target") < F.col("source_size") * 2.0 * (1 - 1e-9))
    state = stored(state.select("source", "source_size", "mean", "target", F.when(free, 0.0).alias("tilt"), F.lit(1.0).alias("miss")))
    hist = hist.where("size > 0").withColumnRenamed("source", "s")
    for _ in range(MAX_ROUNDS):
        sigma = 1.0 / (1.0 + F.exp(-F.col("tilt") * _feature(F.col("size"), F.col("mean"))))
        mass = 2.0 * F.col("n") * F.col("size")
        both = hist.join(state.where("tilt IS NOT NULL"), F.col("s").eqNullSafe(F.col("source")))
        exact = lambda x: F.sum(x.cast("decimal(38,12)")).cast("double")  # noqa: E731 - the order of additions can't matter
        sums = both.groupBy("s").agg(exact(mass * sigma).alias("got"), exact(mass * _feature(F.col("size"), F.col("mean")) * sigma * (1 - sigma)).alias("slope"))
        state = state.drop("miss").join(sums, F.col("source").eqNullSafe(F.col("s")), "left")
        state = stored(state.select("source", "source_size", "mean", "target", (F.col("tilt") + (F.col("target") - F.col("got")) / F.greatest("slope", F.lit(1e-300))).alias("tilt"), (F.abs(F.col("got") - F.col("target")) / F.col("target")).alias("miss")))
        if (state.agg(F.max("miss")).first()[0] or 0.0) < TOLERANCE:
            break
    else:
        raise RuntimeError(f"the dual did not converge in {MAX_ROUNDS} Newton steps")
    return _cuts(docs, state.drop("miss"), source_col, text_col, id_col)


def _breaks(size, mean, tilt, id_col, text_col):
    """Break point of a document's first copy, in units of 1 / UNIT from -3; the second comes
    ``UNIT`` later."""
    u = F.pmod(F.xxhash64(id_col, text_col, F.lit("copies")), F.lit(UNIT)) / float(UNIT)
    return F.floor((3.0 - _rate(tilt, size, mean) - u) * UNIT)


_CUTS = "array<struct<whole:bigint,longest:double,part:bigint,rows:bigint>>"


def _cuts(docs: DataFrame, state: DataFrame, source_col: str, text_col: str, id_col: str) -> DataFrame:
    """``state`` with ``cuts``, one per round: copies up to break point ``whole`` and no longer than
    ``longest`` words are taken, and ``rows`` of the equal rows at break point ``part``."""
    state = written(state, "mix-rates")
    s = state.withColumnRenamed("source", "s")
    rows = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("i"), F.col(text_col).alias("t"), word_count(F.col(text_col)).alias("size")).where("size > 0")
    rows = rows.join(s, F.col("source").eqNullSafe(F.col("s"))).where("target > 0")
    point = _breaks(F.col("size"), F.col("mean"), F.col("tilt"), F.col("i"), F.col("t"))
    one = written(rows.select("source", "size", point.alias("b")).groupBy("source", "b", "size").agg(F.count(F.lit(1)).alias("n")), "mix-points")
    points = one.unionAll(one.withColumn("b", F.col("b") + UNIT)).withColumn("cell", F.floor(F.col("b") / (UNIT // GRID)))
    hist = stored(points.groupBy("source", "cell", "size").agg(F.sum(F.col("size") * F.col("n")).alias("words")))
    none = F.array().cast(_CUTS)
    level = state.select(F.col("source").alias("s"), F.lit(-1).cast("long").alias("cut"), F.col("target").alias("missing"), none.alias("cuts"))
    same = F.col("source").eqNullSafe(F.col("s"))
    by_cell = Window.partitionBy("source").orderBy("cell")

    def upto(open_):
        cells = open_.groupBy("source", "cell").agg(F.sum("words").alias("words"), F.first("missing").alias("missing"))
        return cells.withColumn("upto", F.sum("words").over(by_cell))

    # the first round takes whole cells before it looks at single break points
    first = upto(hist.join(level.drop("cuts"), same).where(F.col("size") <= F.col("missing"))).where(F.col("upto") <= F.col("missing"))
    best = first.groupBy(F.col("source").alias("c")).agg(((F.max("cell") + 1) * (UNIT // GRID) - 1).alias("new"), F.max("upto").alias("got"))
    entry = F.struct(F.col("new").alias("whole"), F.col("missing").alias("longest"), F.lit(-1).cast("long").alias("part"), F.lit(0).cast("long").alias("rows"))
    level = level.join(best, F.col("s").eqNullSafe(F.col("c")), "left").select(
        "s", F.coalesce("new", "cut").alias("cut"), (F.col("missing") - F.coalesce("got", F.lit(0))).alias("missing"),
        F.when(F.col("new").isNotNull(), F.array(entry)).otherwise(none).alias("cuts"))
    level = written(level, "mix-cuts")
    while True:
        here = F.floor(F.col("cut") / (UNIT // GRID))
        later = upto(hist.join(level.drop("cuts"), same).where((F.col("size") <= F.col("missing")) & (F.col("cell") > here)))
        far = later.where(F.col("upto") > F.col("missing")).groupBy(F.col("source").alias("c")).agg(F.min("cell").alias("far"))
        reach = level.join(far, F.col("s").eqNullSafe(F.col("c")), "left").drop("c")
        # a hot source's points meet the level in SALTS tasks
        salted = reach.drop("cuts").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        fit = points.join(salted, same & (F.col("salt") == F.pmod(F.col("b"), F.lit(SALTS)).cast("int"))).where(
            (F.col("b") > F.col("cut")) & (F.col("size") <= F.col("missing")) & (F.col("far").isNull() | (F.col("cell") <= F.col("far"))))
        groups = stored(fit.groupBy("source", "b", "missing").agg(F.max("size").alias("size"), F.sum("n").alias("n"), F.sum(F.col("size") * F.col("n")).alias("words")))
        if groups.isEmpty():
            break
        summed = R.running(groups.withColumn("key", F.struct(F.col("source").isNull(), "source")), "key", ["b"], [R.cum_sum("upto", "words")])
        over = F.col("upto") > F.col("missing")
        found = summed.groupBy(F.col("source").alias("c")).agg(
            F.max(F.when(~over, F.struct("b", "upto"))).alias("all"), F.min(F.when(over, F.struct("b", "size", (F.col("upto") - F.col("words")).alias("before")))).alias("cut_off"))
        rest = F.floor((F.col("missing") - F.col("cut_off.before")) / F.col("cut_off.size")).cast("long")
        whole = F.coalesce(F.col("cut_off.b") - 1, F.col("all.b"))
        got = F.coalesce(F.col("cut_off.before") + rest * F.col("cut_off.size"), F.col("all.upto"))
        cut = F.struct(whole.alias("whole"), F.col("missing").alias("longest"), F.coalesce("cut_off.b", F.lit(-1)).cast("long").alias("part"), F.coalesce(rest, F.lit(0)).cast("long").alias("rows"))
        level = written(level.join(found, F.col("s").eqNullSafe(F.col("c")), "left").select(
            "s", F.coalesce("cut_off.b", "all.b", "cut").alias("cut"), (F.col("missing") - F.coalesce(got, F.lit(0))).alias("missing"),
            F.when(F.col("c").isNotNull() | F.col("all").isNotNull() | F.col("cut_off").isNotNull(), F.concat("cuts", F.array(cut))).otherwise(F.col("cuts")).alias("cuts")), "mix-cuts")
    return written(state.join(level.select("s", "cuts"), F.col("source").eqNullSafe(F.col("s"))).drop("s"), "mix")


def copies(docs: DataFrame, mix: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies``
    (0, 1 or 2; a document without words keeps one copy, which takes no words)."""
    m = mix.select(*[F.col(c).alias(f"m_{c}") for c in ("source", "source_size", "mean", "target", "tilt", "cuts")])
    row = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    source, text, id_ = (F.col("row").getField(c) for c in (source_col, text_col, id_col))
    both = row.withColumn("size", word_count(text)).join(m, source.eqNullSafe(F.col("m_source")))
    both = both.withColumn("b", _breaks(F.col("size"), F.col("m_mean"), F.col("m_tilt"), id_, text))

    def has(point, nth):
        inside = F.exists("m_cuts", lambda c: (point <= c["whole"]) & (F.col("size") <= c["longest"]))
        part = F.exists("m_cuts", lambda c: (point == c["part"]) & (F.col("size") <= c["longest"]) & (nth <= c["rows"]))
        return (inside | part).cast("int")

    def counted(rows, nth):
        n = F.when(F.col("size") == 0, 1).otherwise(F.coalesce(has(F.col("b"), nth) + has(F.col("b") + UNIT, nth), F.lit(0)))
        outs = {"mix_size": F.col("size"), "mix_source_size": F.col("m_source_size"), "mix_target": F.col("m_target"), "mix_copies": n}
        return rows.select("row.*", *[c.alias(free(docs.columns, name)) for name, c in outs.items()])

    split = F.exists("cuts", lambda c: c["rows"] > 0)
    if mix.where(split).isEmpty():
        return counted(both, F.lit(1))
    # some of a group of equal rows are taken: these rows, and only these, are numbered
    at = F.exists("m_cuts", lambda c: (c["rows"] > 0) & ((c["part"] == F.col("b")) | (c["part"] == F.col("b") + UNIT)))
    simple = [F.col("row").getField(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    several = both.where(at).withColumns({"like": F.xxhash64(*simple), "place": F.monotonically_increasing_id(), "key": F.xxhash64("m_source", "b")})
    ranked = R.running(several, "key", ["like", "place"], [R.row_number("nth")])
    return counted(both.where(~at), F.lit(1)).unionAll(counted(ranked, F.col("nth")))
