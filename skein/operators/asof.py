"""As-of join (J5 backward, J6 forward) without a range join.

Left and right rows are tagged and unioned, then one ordered pass per ``by`` key carries
the last right payload seen so far (``running.cum_last`` over a struct, so NULL payload
fields survive ``ignorenulls``). Backward orders by ``(on, side, right ties)`` with right
rows first at equal ``on`` (exact matches allowed, the last of tied right rows wins).
Forward runs the same pass in reversed order (never a frame ending at
unboundedFollowing): the nearest right row at or after ``on``, the first of tied rows.

Cost: the union doubles nothing but the right payload; one running pass (skew-safe by
default: a hot ``by`` key is split over range partitions).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.operators import running as R


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: str | Sequence[str],
    payload: Sequence[str] | None = None,
    direction: str = "backward",
    right_on: str | None = None,
    right_by: str | Sequence[str] | None = None,
    right_ties: Sequence[str] = (),
    allow_exact_matches: bool = True,
    suffix: str = "_right",
    strategy: str | None = None,
) -> DataFrame:
    """Left-preserving as-of join. Returns left columns + payload columns (a payload name
    that collides with a left column gets ``suffix``, J9). Left rows with a NULL ``on`` or
    ``by`` get NULL payload (D10)."""
    if direction not in ("backward", "forward"):
        raise ValueError("direction must be 'backward' or 'forward'")
    lby = [by] if isinstance(by, str) else list(by)
    rby = lby if right_by is None else ([right_by] if isinstance(right_by, str) else list(right_by))
    ron = right_on or on
    if payload is None:
        payload = [c for c in right.columns if c not in rby and c != ron]
    payload = list(payload)
    out_names = [p + suffix if p in left.columns else p for p in payload]

    lcols = left.columns
    lstruct_t = T.StructType([T.StructField(c, left.schema[c].dataType, True) for c in lcols])
    pstruct_t = T.StructType([T.StructField(n, right.schema[p].dataType, True) for p, n in zip(payload, out_names)])
    tie_t = [right.schema[c].dataType for c in right_ties]
    keys = [f"_ak{i}" for i in range(len(lby))]

    # side: right rows sort before left rows at equal `on` when exact matches count.
    right_side, left_side = (0, 1) if allow_exact_matches else (1, 0)
    lrows = left.select(
        *[F.col(c).alias(k) for c, k in zip(lby, keys)],
        F.col(on).alias("_at"),
        F.lit(left_side).alias("_as"),
        *[F.lit(None).cast(t).alias(f"_rt{i}") for i, t in enumerate(tie_t)],
        F.struct(*[F.col(c) for c in lcols]).alias("_al"),
        F.lit(None).cast(pstruct_t).alias("_ap"),
    )
    rvalid = F.col(ron).isNotNull()
    for c in rby:
        rvalid = rvalid & F.col(c).isNotNull()
    rrows = right.where(rvalid).select(
        *[F.col(c).alias(k) for c, k in zip(rby, keys)],
        F.col(ron).alias("_at"),
        F.lit(right_side).alias("_as"),
        *[F.col(c).alias(f"_rt{i}") for i, c in enumerate(right_ties)],
        F.lit(None).cast(lstruct_t).alias("_al"),
        F.struct(*[F.col(p).alias(n) for p, n in zip(payload, out_names)]).alias("_ap"),
    )
    unioned = lrows.unionByName(rrows)
    back = direction == "forward"
    order = [R.By("_at", back), R.By("_as"), *[R.By(f"_rt{i}", back) for i in range(len(tie_t))]]
    matched = R.running(unioned, keys, order, [R.cum_last("_m", "_ap")], strategy)
    return matched.where(F.col("_as") == left_side).select(
        "_al.*",
        *[F.when(F.col("_at").isNotNull(), F.col(f"_m.{n}")).alias(n) for n in out_names],
    )
