"""Hard-negative mining with score bounds along a spanning tree of the anchors.

Scores are integer inner products of floored, scaled vectors. For two anchors p and q and
any candidate x, ``|q.x - p.x| <= |q - p| |x|``: a score at p bounds the score at q. The
anchors of a block are joined by a minimum spanning tree (short edges give tight bounds).
Its root scores every candidate; each child gets an interval per candidate from its
parent's interval, and only candidates whose interval overlaps one of the child's score
windows are scored again. Scored candidates pass an exact score on to the next children.

A window is (lowest score, highest score, how many). While a task goes through a block of
candidates its windows close from below: once a window has its number of scores, nothing
under the least of them can enter. The same search runs twice: one window without limits
over rows of the anchor's own label gives the positives; a window of 30 to 90 hundredths of
each positive's score over rows of other labels gives its negatives.

Scale: anchors and candidates are dealt into blocks of stated sizes and joined on block
numbers, every anchor block with every candidate block once; a task holds one pair. What
returns is at most the asked number of rows per anchor, window and block. Rows of the same
values are dealt by their place, so a vector that repeats does not fill a block.

Defined cases: a row takes part if label, id and vector are not NULL and every component is
finite; unequal lengths are compared over the components both have; a row never meets rows
of its own id; rows that repeat an id are candidates each, and anchors that are equal in id,
label and vector are one anchor; positives and negatives that tie go by the smaller id; an
empty table gives an empty result; components of 2**53 and scores of 2**62 or more (after
scaling) raise an error; labels that are not whole numbers are compared by a 64-bit hash;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import written

ANCHOR_BLOCK = 512
CANDIDATE_BLOCK = 16384
_SLICE = 4096  # candidates that are scored before windows close further
_OPEN = 2**62


def _dealt(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """Rows as (name, r): about ``size`` rows a block, dealt by a hash of the row's place, so
    that equal rows spread."""
    n = max(1, -(-rows.count() // size))
    place = F.monotonically_increasing_id()
    dealt = rows.withColumn(name, F.pmod(F.xxhash64(place, "vec_id"), F.lit(n).cast("long")))
    return dealt.groupBy(name).agg(F.collect_list(F.struct(*[F.col(c) for c in rows.columns])).alias("r")), n


def _spanning_tree(m: np.ndarray) -> list[tuple[int, int, float]]:
    """(node, parent, distance) in an order with every parent first; root: parent -1. Prim's
    rule on Euclidean distances, rounded up so that bounds stay true."""
    n = len(m)
    x = m.astype(float)
    dist, near = np.full(n, np.inf), np.full(n, -1)
    left, order, node = np.ones(n, bool), [], 0
    for _ in range(n):
        left[node] = False
        order.append((node, int(near[node]), float(dist[node]) if near[node] >= 0 else 0.0))
        d = np.sqrt(((x - x[node]) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-6
        closer = left & (d < dist)
        dist[closer], near[closer] = d[closer], node
        if left.any():
            node = int(np.flatnonzero(left)[np.argmin(dist[left])])
    return order


class _Best:
    """The highest (score, smallest id) rows of a window so far."""

    def __init__(self, lo: int, hi: int, k: int):
        self.lo, self.hi, self.k = lo, hi, k
        self.floor = lo
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        fits = (score >= self.floor) & (score <= self.hi)
        if not fits.any():
            return
        s, i = np.concatenate([self.score, score[fits]]), np.concatenate([self.id, ids[fits]])
        order = np.lexsort((i, -s))[: self.k]
        self.score, self.id = s[order], i[order]
        if len(order) == self.k:
            self.floor = int(self.score[-1])


def search(anchors: np.ndarray, windows: list, cands: np.ndarray, cand_ids: np.ndarray, allowed) -> int:
    """Fills every anchor's windows (lists of ``_Best``) from the candidates;
    ``allowed(anchor)`` is the mask of candidates it may take. Returns the scores computed.
    ``anchors`` and ``cands`` are integer matrices of one width."""
    order = _spanning_tree(anchors)
    # sums of whole numbers are exact in doubles below 2**53, and doubles multiply faster
    small = np.abs(anchors).max(initial=0) * float(np.abs(cands).max(initial=0)) * max(anchors.shape[1], 1) < 2**53
    cands, weights = (cands.astype(float), anchors.astype(float)) if small else (cands, anchors)
    masks = {node: allowed(node) for node, _, _ in order}
    norms = np.sqrt((cands.astype(float) ** 2).sum(axis=1)) * (1 + 1e-9)
    scored = 0
    for at in range(0, len(cands), _SLICE):
        part, ids, norm = cands[at:at + _SLICE], cand_ids[at:at + _SLICE], norms[at:at + _SLICE]
        bounds: dict = {}
        last_child = {parent: i for i, (_, parent, _) in enumerate(order)}
        for i, (node, parent, dist) in enumerate(order):
            if parent < 0:
                low, high = np.full(len(part), -np.inf), np.full(len(part), np.inf)
            else:
                low, high = bounds[parent][0] - dist * norm, bounds[parent][1] + dist * norm
            open_ = [w for w in windows[node] if w.floor <= w.hi]
            want = np.full(len(part), parent < 0)  # the root scores every candidate
            may = masks[node][at:at + _SLICE]
            for w in open_:
                want |= may & (high >= w.floor) & (low <= w.hi)
            rows = np.flatnonzero(want)
            if len(rows):
                exact = (part if len(rows) == len(part) else part[rows]) @ weights[node]
                exact = np.rint(exact).astype(np.int64)
                scored += len(rows)
                low[rows] = high[rows] = exact
                ok = may[rows]
                for w in open_:
                    w.add(exact[ok], ids[rows][ok])
            bounds[node] = (low, high)
            if last_child.get(parent) == i:
                bounds.pop(parent, None)
    return scored


def _whole(rows: DataFrame, id_col: str, vec_col: str, label: Column, scale: float) -> DataFrame:
    """(vec_id, label, v array<double>) of the rows that take part; v holds whole numbers."""
    x = F.col(vec_col).cast("array<double>")
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    part = F.col(id_col).isNotNull() & label.isNotNull() & F.col(vec_col).isNotNull() & finite
    whole = F.transform(x, lambda c: F.floor(c * F.lit(scale)).cast("double"))
    kind = rows.select(label.alias("x")).schema["x"].dataType
    code = label.cast("long") if isinstance(kind, T.IntegralType) else F.xxhash64(label.cast("string"))
    return rows.where(part).select(F.col(id_col).cast("long").alias("vec_id"), code.alias("label"), whole.alias("v"))


def _integers(vecs, width: int) -> np.ndarray:
    """Rows of whole numbers as an integer matrix, padded with zeros."""
    lens = np.diff(vecs.offsets.to_numpy())
    m = np.zeros((len(vecs), width))
    m[np.arange(width)[None, :] < lens[:, None]] = vecs.flatten().to_numpy(zero_copy_only=False)
    if np.abs(m).max(initial=0) >= 2**53:
        raise ValueError("components beyond 2**53 after scaling are not whole in double precision")
    return m.astype(np.int64)


def _width(rows) -> int:
    return int(np.diff(rows.field("v").offsets.to_numpy()).max(initial=0))


def _pairs(anchors: DataFrame, pool: DataFrame, n_pool: int) -> DataFrame:
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_pool - 1).cast("long")))
    return anchors.select(F.col("r").alias("q"), every.alias("cb")).join(pool.withColumnRenamed("r", "c"), "cb").select("q", "c")


def _searched(pairs: DataFrame, schema: str, windows_of, allowed_of, rows_of) -> DataFrame:
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                q, c = b.column(0)[i].values, b.column(1)[i].values
                width = max(_width(q), _width(c))
                a, x = _integers(q.field("v"), width), _integers(c.field("v"), width)
                if np.abs(a).max(initial=0) * float(np.abs(x).max(initial=0)) * max(width, 1) >= 2**62:
                    raise ValueError("inner products beyond a long: scale the vectors down")
                cols = {n: c.field(n).to_numpy(zero_copy_only=False) for n in ("vec_id", "label")}
                asked = {n: q.field(n) for n in [f.name for f in q.type] if n != "v"}
                windows = windows_of(asked)
                search(a, windows, x, cols["vec_id"], allowed_of(asked, cols))
                out = [r for j, ws in enumerate(windows) for w in ws for r in rows_of(asked, j, w)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(len(names))], names=names)

    return pairs.mapInArrow(run, schema)


def hard_negatives(
    rows: DataFrame, anchors: Column, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
    id_col: str = "vec_id", vec_col: str = "embedding", label: Column | str = "label", scale: float = 256.0,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every
    row that ``anchors`` holds for and each of its ``n_positives`` best rows of the same label,
    the ``n_negatives`` best rows of other labels whose score lies between ``low`` and ``high``
    hundredths of the positive's score."""
    label = F.col(label) if isinstance(label, str) else label
    whole = _whole(rows, id_col, vec_col, label, scale)
    chosen = _whole(rows.where(anchors), id_col, vec_col, label, scale).distinct()
    asked = written(chosen.withColumn("anchor", F.monotonically_increasing_id()), "negatives-anchors")
    pool, n_pool = _dealt(written(whole, "negatives-rows"), CANDIDATE_BLOCK, "cb")
    pool = written(pool, "negatives-pool")
    blocks, _ = _dealt(asked, ANCHOR_BLOCK, "qb")

    def own(a, c):
        return lambda j: (c["label"] == a["label"][j].as_py()) & (c["vec_id"] != a["vec_id"][j].as_py())

    def others(a, c):
        return lambda j: c["label"] != a["label"][j].as_py()

    near = _searched(
        _pairs(blocks, pool, n_pool), "anchor bigint, vec_id bigint, score bigint",
        lambda a: [[_Best(-_OPEN, _OPEN, n_positives)] for _ in range(len(a["anchor"]))], own,
        lambda a, j, w: [(a["anchor"][j].as_py(), int(i), int(s)) for i, s in zip(w.id, w.score)])
    by_score = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "vec_id")
    positives = near.withColumn("nth", F.row_number().over(by_score)).where(F.col("nth") <= n_positives)
    listed = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("positives"))
    with_positives = written(asked.join(listed, "anchor"), "negatives-positives")
    blocks, _ = _dealt(with_positives.select("vec_id", "label", "v", "anchor", F.transform("positives", lambda p: p["score"]).alias("scores")), ANCHOR_BLOCK, "qb")

    def windows(a):
        # low * p <= 100 * n <= high * p, in whole numbers
        return [[_Best(-((-low * p) // 100), (high * p) // 100, n_negatives) for p in s.as_py()] for s in a["scores"]]

    def found(a, j, w):
        key = a["anchor"][j].as_py()
        return [(key, w.lo, w.hi, int(i), int(s)) for i, s in zip(w.id, w.score)]

    far = _searched(
        _pairs(blocks, pool, n_pool), "anchor bigint, lo bigint, hi bigint, negative_id bigint, negative_score bigint",
        lambda a: [list({(w.lo, w.hi): w for w in ws}.values()) for ws in windows(a)], others, found)
    best = Window.partitionBy("anchor", "lo", "hi").orderBy(F.col("negative_score").desc(), "negative_id")
    negatives = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives)
    p = with_positives.select("anchor", F.col("vec_id").alias("anchor_id"), F.explode("positives").alias("p"))
    score = F.col("p.score")
    wanted = p.select(
        "anchor", "anchor_id", F.col("p.vec_id").alias("positive_id"), score.alias("positive_score"),
        (-F.floor((-low * score).cast("decimal(38,0)") / 100)).cast("long").alias("lo"),
        F.floor((high * score).cast("decimal(38,0)") / 100).cast("long").alias("hi"))
    return wanted.join(negatives, ["anchor", "lo", "hi"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
