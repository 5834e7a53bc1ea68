"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer when the smallest hash among its inner s-mers
is at its first or last place (Edgar, "Syncmers are more sensitive than minimizers for
selecting conserved k-mers", 2021). Whether a k-mer is chosen depends on nothing outside
it, so an edit only touches the anchors that overlap it: an edited text's anchors are
taken from the original's before the edit and computed anew after it.

``anchors`` gives every chosen position and its hash. A fingerprint is all distinct anchor
hashes of the text, 8 hex digits each, ascending, so it grows with the text; two
fingerprints' likeness is the Jaccard likeness of these sets, whatever the texts' lengths.
(With a number for ``sketch`` a fingerprint is only that many smallest hashes and the
likeness a bottom-k estimate; the query does not do so.) ``fingerprints`` also gives every
anchor's position and hash in text order, and ``passages`` matches two texts' anchors by
position: runs of anchors at a constant distance are the passages both texts share.

Defined cases: NULL text is the empty text; the empty text has the empty fingerprint, and
two empty fingerprints have likeness 1, an empty and another 0; a text shorter than k is
one anchor, its own hash. Equal texts have equal fingerprints.

``with_next`` gives every row its successor in ascending id order without a global
window: rows are dealt to ranges of ids, sorted there and streamed, and each range also
gets a copy of the next range's first row. NULL ids come first, equal ids are ordered by
their text. Texts move once; a task holds two texts at a time. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import stored

K, S = 16, 8
SKETCH = None  # all anchors
_MULT = 0x9E3779B97F4A7C15
SLAB = 1 << 18  # code points hashed at a time
OUT = 1 << 20  # code points of texts whose results are held at a time


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _rolled(codes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of n code points."""
    h = np.zeros(len(codes) - n + 1, dtype=np.uint64)
    for i in range(n):
        h *= np.uint64(_MULT)
        h += codes[i:i + len(h)]
    return _mixed(h)


def anchors(codes: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the closed syncmers of an array of code points."""
    if len(codes) == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    codes = codes.astype(np.uint64)
    if len(codes) < k:
        return np.zeros(1, dtype=np.int64), _rolled(codes, len(codes))
    at, hashes = [], []
    for lo in range(0, len(codes) - k + 1, SLAB):
        part = codes[lo:lo + SLAB + k - 1]
        inner = _rolled(part, s)
        low = inner
        have, want = 1, k - s + 1  # running minimum over the k-s+1 inner s-mers, by doubling
        while have < want:
            step = min(have, want - have)
            low = np.minimum(low[:-step], low[step:])
            have += step
        n = len(part) - k + 1
        chosen = np.flatnonzero((inner[:n] == low) | (inner[k - s:k - s + n] == low))
        h = np.zeros(len(chosen), dtype=np.uint64)
        for o in [*range(0, k - s, s), k - s]:  # inner s-mers that cover the k-mer
            h = _mixed((h + inner[chosen + o]) * np.uint64(_MULT))
        at.append(chosen + lo)
        hashes.append(h)
    return np.concatenate(at), np.concatenate(hashes)


def _smallest(hashes: np.ndarray, sketch: int | None) -> np.ndarray:
    h = (hashes >> np.uint64(32)).astype(np.uint32)
    if sketch is not None and len(h) > 8 * sketch:  # repeats are rare: a generous selection first, checked below
        few = np.unique(np.partition(h, 4 * sketch)[: 4 * sketch])
        if len(few) >= sketch:
            return few[:sketch]
    return np.unique(h)[:sketch]


def likeness(a: np.ndarray, b: np.ndarray, sketch: int | None = SKETCH) -> float:
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    common = np.intersect1d(a, b, assume_unique=True)
    if sketch is None:
        return float(len(common) / (len(a) + len(b) - len(common)))
    union = np.union1d(a, b)[:sketch]
    return float(len(np.intersect1d(common, union)) / len(union))


def passages(at_a: np.ndarray, a: np.ndarray, at_b: np.ndarray, b: np.ndarray, k: int = K) -> list[tuple[int, int, int]]:
    """(start in a, start in b, code points) of the passages two texts share, by position in
    a: maximal runs of anchors with equal hashes, neighbours in both texts at the same
    distance. Arguments are positions and hashes of all anchors in text order. An anchor
    that stands several times is matched at every place, so a passage repeated r times in a
    and s times in b gives r * s passages. For texts of k or more code points."""
    order = np.argsort(b, kind="stable")
    lo, hi = np.searchsorted(b[order], a, side="left"), np.searchsorted(b[order], a, side="right")
    n = hi - lo
    i = np.repeat(np.arange(len(a)), n)
    j = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - lo, n)]
    by = np.lexsort((i, j - i))  # neighbours in both texts follow each other
    i, j = i[by], j[by]
    shift = np.asarray(at_a)[i] - np.asarray(at_b)[j]
    new = np.r_[True, (np.diff(i) != 1) | (np.diff(j) != 1) | (np.diff(shift) != 0)][: len(i)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(i)][: len(first)] - 1
    found = zip(np.asarray(at_a)[i[first]], np.asarray(at_b)[j[first]], np.asarray(at_a)[i[last]] + k - np.asarray(at_a)[i[first]])
    return sorted((int(x), int(y), int(m)) for x, y, m in found)


def once(at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchors whose hash stands once in the text, in text order: matched by position they
    give at most one place each, however often a text repeats a line."""
    _, first, n = np.unique(hashes, return_index=True, return_counts=True)
    kept = np.sort(first[n == 1])
    return np.asarray(at)[kept], hashes[kept]


def covered(found: list[tuple[int, int, int]]) -> int:
    """Code points of the first text that lie in at least one passage."""
    total, end = 0, 0
    for start, _, n in found:  # ascending starts
        total += max(start + n - max(start, end), 0)
        end = max(end, start + n)
    return total


def to_hex(sketched: np.ndarray) -> str:
    return sketched.astype(">u4").tobytes().hex()


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S, sketch: int | None = SKETCH) -> DataFrame:
    """(id, fingerprint, positions, hashes): fingerprint of every whole text, positions and
    hashes of all its anchors in text order."""

    def run(batches):
        for b in batches:
            prints, places, hashes = [], [], []
            for t in b.column(1):
                at, h = anchors(_codes(t.as_py() or ""), k, s)
                prints.append(to_hex(_smallest(h, sketch)))
                places.append(at)
                hashes.append(h.view(np.int64))
            each = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints, pa.string()), pa.array(places, each), pa.array(hashes, each)], names=["doc_id", "fingerprint", "positions", "hashes"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, fingerprint string, positions array<long>, hashes array<long>")


RANGES_A_TASK = 4  # a task gets the ranges whose numbers are equal modulo the tasks
SAMPLES = 16  # sampled places a range; every sixteenth is a bound
HEAD = 16  # characters of a text that order rows of one id


def with_next(docs: DataFrame, id_col: str, text_col: str, tasks: int) -> DataFrame:
    """(range, copy, doc_id, text) sorted inside each range; ``copy`` marks the row that
    follows the range's last one (the first row of the next range that has rows, the first
    of all after the last).

    Bounds are every ``SAMPLES``-th of a hash sample of the rows' places, about as many as there
    are ranges; no row count or place reaches the driver but the numbers of rows. A place is
    the id alone unless some id holds more rows than a range should; then it goes on with
    what orders rows of one id (the text's first ``HEAD`` characters and its hash) and a row
    number, so rows without an id and copies of one row are spread too. ``docs`` is read
    several times and has to give the same rows in the same order each time, as files do."""
    ranges = tasks * RANGES_A_TASK
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("all"), F.max("n").alias("most")).first()
    every = max((counts["all"] or 0) // (ranges * SAMPLES), 1)
    head, digest = F.substring("text", 1, HEAD), F.xxhash64("text")
    if (counts["most"] or 0) > every * SAMPLES:
        ties, row = [head.alias("head"), digest.alias("digest")], F.monotonically_increasing_id()
    else:
        ties, row = [F.lit("").alias("head"), F.lit(0).cast("long").alias("digest")], F.lit(0).cast("long")
    placed = rows.select("doc_id", "text", F.struct("doc_id", *ties).alias("key"), row.alias("row"))
    place = F.struct("key", "row")
    sampled = placed.where(F.pmod(F.xxhash64("key", "row"), F.lit(every)) == 0)
    c = F.col("c")
    step = max(int(ranges ** 0.5), 1)  # bounds in blocks: a row is compared with the blocks' first ones, then inside one
    picked = F.sort_array(F.collect_list(place))
    cut = sampled.agg(F.filter(picked, lambda x, i: i % SAMPLES == SAMPLES - 1).alias("c")).where(F.size("c") > 0)
    bounds = stored(cut.select(F.transform(F.sequence(F.lit(0), F.floor((F.size(c) - 1) / step).cast("int")), lambda g: F.slice(c, g * step + 1, step)).alias("blocks"), F.lit(0).cast("long").alias("one")))
    blocks = F.col("blocks")  # one row for all: every row's number modulo 1 meets it
    below = F.size(F.filter(F.transform(blocks, lambda b: F.get(b, F.lit(0))), lambda x: x <= F.col("place")))
    inside = F.size(F.filter(F.get(blocks, below - 1), lambda x: x <= F.col("place")))
    number = F.when(blocks.isNull() | (below == 0), F.lit(0)).otherwise((below - 1) * step + inside)
    beside = placed.withColumns({"place": place, "one": F.pmod(F.xxhash64("doc_id"), F.lit(1).cast("long"))}).join(F.broadcast(bounds), "one", "left")
    dealt = beside.select("doc_id", "text", "key", number.alias("range"))
    # at most one row per range: its first key, and the range before it (the last one before the first)
    firsts = dealt.groupBy("range").agg(F.min("key").alias("key"))
    line = Window.orderBy("range")
    last = F.last("range").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = stored(firsts.select("range", "key", F.coalesce(F.lag("range").over(line), last).alias("before")))
    order = F.struct("doc_id", head.alias("head"), digest.alias("digest"), "text")
    heads = dealt.join(F.broadcast(firsts), ["range", "key"])
    copies = heads.groupBy(F.col("before").alias("range")).agg(F.min(order).alias("h")).select("range", F.lit(True).alias("copy"), "h.doc_id", "h.text")
    both = dealt.select("range", F.lit(False).alias("copy"), "doc_id", "text").unionAll(copies)
    return both.repartitionById(tasks, "range").sortWithinPartitions("range", "copy", F.col("doc_id").asc_nulls_first(), head, digest, "text")


_EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S, sketch: int | None = SKETCH, positions: bool = False) -> DataFrame:
    """Fingerprints of every text and of its edited text: the last quarter of its code
    points replaced by as many from the start of the next document. With ``positions`` also
    ``kept_chars``: code points of the text in passages that the edited text shares, matched
    by the positions of anchors that stand once in each (texts of k or more code points)."""

    def pair(now, nxt):
        key, text, codes, at, h = now
        cut = len(codes) - len(codes) // 4
        edited = np.concatenate([codes[:cut], nxt[2][: len(codes) // 4]])
        if len(codes) < k or len(edited) < k:
            at_new, new = anchors(edited, k, s)
        else:  # anchors wholly before the edit stand; those that touch it are computed anew
            keep = max(cut - k + 1, 0)
            stand = np.searchsorted(at, keep)
            at_more, more = anchors(edited[keep:], k, s) if len(edited) - keep >= k else (at[:0], h[:0])
            at_new, new = np.concatenate([at[:stand], at_more + keep]), np.concatenate([h[:stand], more])
        mine, theirs, after = _smallest(h, sketch), _smallest(new, sketch), _smallest(nxt[4], sketch)
        sha = hashlib.sha256(edited.astype("<u4").tobytes().decode("utf-32-le").encode()).hexdigest()
        row = (key, len(codes), sha, to_hex(mine), to_hex(theirs), likeness(mine, theirs, sketch), likeness(mine, after, sketch))
        if not positions:
            return row
        shared = passages(*once(at, h), *once(at_new, new), k) if min(len(codes), len(edited)) >= k else []
        return (*row, covered(shared))

    columns = _EDITED + (", kept_chars long" if positions else "")
    names, kinds = [c.split()[0] for c in columns.split(", ")], {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    types = [kinds[c.split()[1]] for c in columns.split(", ")]

    def batch(out):
        cols = list(zip(*out)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    def run(batches):
        held, last = None, None
        for b in batches:
            out, held_chars = [], 0
            for r, copy, key, text in zip(*(b.column(c) for c in range(4))):
                r, key, codes = r.as_py(), key.as_py(), _codes(text.as_py())
                now = (key, None, codes, *anchors(codes, k, s))
                if held is not None and r == last:
                    out.append(pair(held, now))
                    held_chars += len(held[2])
                held, last = None if copy.as_py() else now, r
                if held_chars > OUT:  # a slice of results at a time
                    yield batch(out)
                    out, held_chars = [], 0
            yield batch(out)

    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return with_next(docs, id_col, text_col, tasks).mapInArrow(run, columns)
