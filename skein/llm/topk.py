"""Exact top-k inner products: exhaustive term-at-a-time accumulation.

Vectors become integers (floor of ``scale`` times each component). A candidate block keeps
one posting list per dimension (term): the positions and weights of its nonzero
components. For each query row the nonzero terms are taken one by one, and the term's
weight times its postings is added into a dense score array over the block; the block's k
best are picked by partition selection, and the blocks' picks merge in a per-query ranking.

Scale: queries and candidates are dealt into blocks of stated sizes; a pair of blocks is
one task's unit, joined on block numbers (every query block meets every candidate block
once) by a sort-merge join, so no side is ever collected. Work is queries x candidates by definition of an exhaustive search; what moves is
each query block once per candidate block and k rows per query and block back. Score
arrays are bounded by ``QUERY_SLICE`` x the candidate block.

Defined cases: a vector that is NULL or holds a NULL, NaN or infinite component takes no
part; an empty vector scores 0; vectors of unequal length are compared over the terms both
have; rows that repeat a vec_id are candidates each, also where they are equal in all; queries
that are equal in id and vector are one query; no row with the query's own id is its
candidate; rows with a NULL id take no part; scores beyond a long are clamped to its range. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 16384
QUERY_SLICE = 64
_LIMIT = 2**63 - 1


def _whole(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    x = F.col(vec_col).cast("array<double>")
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    part = F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & finite
    return vectors.where(part).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("v"))


def _blocks(vectors: DataFrame, rows: int, name: str) -> tuple[DataFrame, int]:
    """(name, rows): about ``rows`` vectors a row, dealt by a hash of id, vector and the number of
    the copy, so that rows of one id spread even if they are equal in all."""
    n = max(1, -(-vectors.count() // rows))
    counted = vectors.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies"))
    each = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    dealt = F.pmod(F.xxhash64("vec_id", "v", "copy"), F.lit(n).cast("long")).alias(name)
    return each.select(dealt, F.struct("vec_id", "v").alias("r")).groupBy(name).agg(F.collect_list("r").alias("r")), n


def _matrix(rows, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(ids ascending, integer matrix padded with zeros); Python integers if a long can't
    hold every sum of products."""
    ids = rows.field(0).to_numpy(zero_copy_only=False)
    vecs = rows.field(1)
    lens = np.array([len(v) for v in vecs], dtype=np.int64)
    width = int(lens.max(initial=0))
    m = np.zeros((len(ids), width))
    flat = vecs.flatten().to_numpy(zero_copy_only=False)
    m[np.arange(width)[None, :] < lens[:, None]] = flat
    order = np.argsort(ids, kind="stable")
    m = np.floor(m * scale)[order]
    if np.abs(m).max(initial=0) < 2**53:
        m = m.astype(np.int64)
    else:
        m = np.array([[int(x) for x in row] for row in m.tolist()], dtype=object).reshape(m.shape)
    return ids[order], m


def _accumulate(queries: np.ndarray, postings: list, n: int) -> np.ndarray:
    """Dense scores (queries x candidates), one term of every query row at a time."""
    scores = np.zeros((len(queries), n), dtype=queries.dtype)
    for term, (at, weight) in enumerate(postings[: queries.shape[1]]):
        rows = np.flatnonzero(queries[:, term])
        if len(rows) and len(at) == n:
            scores[rows] += queries[rows, term][:, None] * weight[None, :]
        elif len(rows):
            scores[np.ix_(rows, at)] += queries[rows, term][:, None] * weight[None, :]
    return scores


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, the earlier position first among equals."""
    if len(scores) > k:
        kth = np.partition(scores, -k)[-k]
        above = np.flatnonzero(scores > kth)
        at = np.concatenate([above, np.flatnonzero(scores == kth)[: k - len(above)]])
    else:
        at = np.arange(len(scores))
    return at


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products over
    all ``vectors`` but those with its own id; ties go to the smaller vec_id."""

    def run(batches):
        for b in batches:
            out = []
            for i in range(b.num_rows):
                qids, q = _matrix(b.column(0)[i].values, scale)
                keys = np.arange(len(q)) + (b.column(2)[i].as_py() << 32)  # a query's number: its block and place
                cids, c = _matrix(b.column(1)[i].values, scale)
                if q.dtype == object or c.dtype == object or np.abs(q).max(initial=0) * float(np.abs(c).max(initial=0)) * max(c.shape[1], 1) >= 2**62:
                    q, c = q.astype(object), c.astype(object)
                postings = [(at, c[at, t]) for t in range(c.shape[1]) for at in [np.flatnonzero(c[:, t])]]
                for lo in range(0, len(q), QUERY_SLICE):
                    scores = _accumulate(q[lo:lo + QUERY_SLICE], postings, len(c))
                    for qid, key, s in zip(qids[lo:lo + QUERY_SLICE], keys[lo:lo + QUERY_SLICE], scores):
                        lo_own, hi_own = np.searchsorted(cids, [qid, qid + 1]) if qid < _LIMIT else (np.searchsorted(cids, qid), len(cids))
                        if hi_own > lo_own:
                            s, ids = np.delete(s, slice(lo_own, hi_own)), np.delete(cids, slice(lo_own, hi_own))
                        else:
                            ids = cids
                        out += [(qid, key, ids[j], max(-_LIMIT - 1, min(_LIMIT, int(s[j])))) for j in _best(s, k)]
            cols = [pa.array([r[j] for r in out], pa.int64()) for j in range(4)]
            yield pa.RecordBatch.from_arrays(cols, names=["query_id", "query", "vec_id", "score"])

    asked, _ = _blocks(_whole(queries, id_col, vec_col).distinct(), QUERY_BLOCK, "qb")
    pool, n_pool = _blocks(_whole(vectors, id_col, vec_col), CANDIDATE_BLOCK, "cb")
    asked = asked.withColumn("r", F.sort_array("r"))  # every task sees a block's queries in one order
    sent = asked.select(F.col("r").alias("q"), "qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_pool - 1).cast("long"))).alias("cb"))
    # a planner that goes by the size of the blocks before they are repeated would broadcast them all
    picked = sent.hint("merge").join(pool.withColumnRenamed("r", "c"), "cb").select("q", "c", "qb").mapInArrow(run, "query_id bigint, query bigint, vec_id bigint, score bigint")
    w = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return picked.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
