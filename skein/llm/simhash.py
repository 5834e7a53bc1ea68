"""SimHash near-duplicates: covering locality-sensitive hashing.

``fingerprints`` turns each text into a 64-bit SimHash of its word shingles.
``near_duplicates`` links fingerprints at most ``radius`` bits apart and labels the
connected components.

Covering masks (Pagh, "Locality-sensitive hashing without false negatives", 2016): every
bit position i gets a nonzero vector v(i) of r+1 bits; table a (a = 1 .. 2^(r+1)-1) keeps
the bits whose v(i) has an odd overlap with a. Two fingerprints that differ in r places
pose r linear conditions on a, so some nonzero a keeps none of those places and both meet
in that table: no pair within the radius is lost.

Scale and skew: copies collapse to one row per distinct fingerprint before any table is
built. In a table only keys held by two or more fingerprints are kept. Small buckets are
compared inside one row; a bucket above ``small_bucket`` is not compared pairwise but
regrouped by the points around each fingerprint (radius 2: itself and itself with one bit
flipped; two fingerprints are within 2 bits if and only if they share such a point, and
all that share one are). Both ways are exact, and no group holds more than 65
fingerprints or ``small_bucket`` ones.

Defined cases: a NULL or word-free text has fingerprint 0 and is linked like any other;
rows repeated or with equal ids keep one output row each; a component of rows that all
have a NULL id has a NULL component id; an empty table gives an empty result. Other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import stored
from skein.llm.components import connected_components

BITS = 64
CHUNK = 255 * 128


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit; 255 rows at a time fit a byte counter."""
    rows = np.zeros((-(-len(h) // 255) * 255, 8), dtype=np.uint8)
    rows[: len(h)] = h.view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(rows, axis=1, bitorder="little").reshape(-1, 255, BITS)
    return bits.sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned SimHash: a bit is set when more than half of the shingle hashes have it."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z fold, only ASCII space splits
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, n, CHUNK):
        part = words[lo:min(lo + CHUNK, n) + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        h = np.fromiter((digest(g, seed) for g in grams), dtype="<u8")
        ones += _bit_counts(h)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the SimHash of every whole text as a signed long."""

    def run(batches):
        for b in batches:
            fps = [simhash(t.as_py(), shingle, seed) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], names=["doc_id", "fp"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, fp long")


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """One mask per table, as signed 64-bit numbers."""
    tables = (1 << (radius + 1)) - 1
    masks = []
    for a in range(1, tables + 1):
        m = sum(1 << i for i in range(bits) if bin(a & (1 + i % tables)).count("1") % 2)
        masks.append(m - (1 << 64) if m >> 63 else m)
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, radius: int = 2, small_bucket: int = 64) -> DataFrame:
    """(a, b): edges between distinct fingerprints whose connected components are those of
    all pairs at most ``radius`` bits apart; ``fps`` has one column ``fp`` without repeats."""
    masks = covering_masks(radius)
    keyed = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for t, m in enumerate(masks)])).alias("e")).select("fp", "e.t", "e.k")
    crowded = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    live = stored(keyed.join(crowded, ["t", "k"]))

    def compare(batches):
        for b in batches:
            out = []
            for fs in b.column(0):
                f = np.sort(np.array(fs.as_py(), dtype=np.int64))
                near = np.bitwise_count((f[:, None] ^ f[None, :]).view(np.uint64)) <= radius
                root = list(range(len(f)))  # forest of this bucket: at most len(f) - 1 edges

                def find(i, root=root):
                    while root[i] != i:
                        i = root[i] = root[root[i]]
                    return i

                for i, j in zip(*np.nonzero(np.triu(near, 1))):
                    ri, rj = find(i), find(j)
                    if ri != rj:
                        root[max(ri, rj)] = min(ri, rj)
                        out.append((f[i], f[j]))
            a = np.array(out, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(a[:, 0].copy()), pa.array(a[:, 1].copy())], names=["a", "b"])

    small = live.where(F.col("n") <= small_bucket).groupBy("t", "k").agg(F.collect_list("fp").alias("fps")).select("fps").mapInArrow(compare, "a long, b long")
    if radius != 2:  # the regrouping below holds for radius 2 only
        raise ValueError("radius must be 2")
    around = F.create_map(*[x for t, m in enumerate(masks) for x in (F.lit(t), F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)).cast("long") for i in range(BITS) if not (m >> i) & 1]))])
    points = live.where(F.col("n") > small_bucket).select("fp", "t", F.explode(around[F.col("t")]).alias("x")).select("fp", "t", F.col("fp").bitwiseXOR(F.col("x")).alias("p"))
    balls = points.groupBy("t", "p").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    large = balls.select("a", F.explode("fps").alias("b")).where("a <> b")
    return small.unionByName(large).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """(doc_id, fp, component_id): one row per input row; ``component_id`` is the smallest id
    reachable over links of at most ``radius`` bits, the row's own included."""
    marked = stored(fingerprints(docs, id_col, text_col, shingle, seed))
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("low"))
    labels = connected_components(links(distinct.select("fp"), radius))
    classes = distinct.join(labels, distinct["fp"] == labels["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    classes = stored(classes)
    lowest = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    named = classes.join(lowest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
