"""Line dedup by distinct-site spread.

A line (trimmed of spaces; blank lines are never counted) that stands on ``min_sites`` or
more distinct sites is boilerplate: it stays in the document with the smallest id that has
it and goes from all others, so that the text itself is not lost. The order of the other
lines is kept.

Lines become 64-bit hashes. Sketches are kept only for lines that could qualify, those
with at least ``min_sites`` occurrences on more than one site (an exact bound). Their
HyperLogLog sketches merge map-side and by shuffle; a line whose estimate is within
``band`` of the threshold gets an exact distinct count of its sites.

Scale: the text is read twice and moved at most once, when the removals are joined to the
documents; all counting works on (document, site, line) hashes. Every grouping is a partial
aggregation, and joins on a line are dealt by (line, salt), the salt being a hash of the
document's id and text: a line on a third of all rows spreads over ``SALTS`` tasks, each of
which makes a sketch of its share, and the sketches of a line are then merged. Removals are
gathered by id and text, so they are bounded by a document's own lines also where many
documents have one id or none.

Defined cases: a NULL text stays NULL; a NULL site is no site; a NULL id counts as the
smallest only if all documents with the line have NULL ids (then it stays in all of them);
rows with equal ids are kept or cleaned alike; a text whose lines all go becomes empty;
an empty table gives an empty result. Other columns are passed through,
and if one is called ``lines_removed``, underscores are appended to the new column's name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import free, stored, written


SALTS = 32


def _salted(rows: DataFrame, few: DataFrame) -> DataFrame:
    """``rows`` (with ``salt``) joined to the lines of ``few``, which are repeated per salt."""
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    return rows.join(few.withColumn("salt", F.explode(salts)), ["line", "salt"])


def _hash(line):
    return F.xxhash64(F.trim(line))


def _with_salt(lines: DataFrame) -> DataFrame:
    return lines.withColumn("salt", F.pmod(F.xxhash64(*[c for c in lines.columns if c != "line"]), F.lit(SALTS).cast("long")))


def spread(lines: DataFrame, min_sites: int, band: float = 0.1, lg_k: int = 12) -> DataFrame:
    """(line, keeper) of boilerplate lines; ``lines`` holds doc_id, site and line hashes;
    other columns only spread equal ids over more tasks."""
    bound = lines.groupBy("line").agg(F.count("site").alias("n"), F.min("site").alias("a"), F.max("site").alias("b"), F.min("doc_id").alias("keeper"))
    able = stored(bound.where((F.col("n") >= min_sites) & ((F.col("a") < F.col("b")) | F.lit(min_sites <= 1))).select("line", "keeper"))
    some = _salted(_with_salt(lines.where("site IS NOT NULL")), able.select("line")).select("line", "salt", "site")
    shares = some.groupBy("line", "salt").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"))
    merged = shares.groupBy("line").agg(F.hll_union_agg("sketch").alias("sketch"))
    guess = stored(merged.select("line", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= min_sites * (1 - band)))
    near = guess.where(F.col("sites") <= min_sites * (1 + band)).select("line")
    exact = _salted(some, near).select("line", "site").distinct().groupBy("line").agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites)
    found = guess.where(F.col("sites") > min_sites * (1 + band)).select("line").unionAll(exact.select("line"))
    return found.join(able, "line")


def remove_boilerplate(docs: DataFrame, min_sites: int = 10, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", band: float = 0.1) -> DataFrame:
    """``docs`` with cleaned texts and ``lines_removed``."""
    each = F.explode(F.array_distinct(F.split(F.col(text_col), "\n"))).alias("l")
    split = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("same"), F.xxhash64(site_col).alias("h"), F.col(site_col).isNull().alias("none"), each)
    lines = written(split.where(F.trim("l") != "").select("doc_id", "same", F.when(~F.col("none"), F.col("h")).alias("site"), _hash(F.col("l")).alias("line")), "lines")
    common = spread(lines, min_sites, band)
    hits = _salted(_with_salt(lines), common).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    bad = hits.groupBy("doc_id", "same").agg(F.collect_set("line").alias("bad"))
    row = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"))
    joined = row.join(bad, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("text_hash") == F.col("same")), "left")
    whole = F.col("row").getField(text_col)
    old = F.split(whole, "\n")
    kept = F.filter(old, lambda line: ~F.array_contains(F.col("bad"), _hash(line)) | (F.trim(line) == ""))
    joined = joined.withColumn("kept", F.when(F.col("bad").isNotNull(), kept))
    text = F.when(F.col("kept").isNull(), whole).otherwise(F.array_join("kept", "\n"))
    gone = F.coalesce(F.size(old) - F.size("kept"), F.lit(0))
    fields = [(text if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns]
    return joined.select(*fields, gone.alias(free(docs.columns, "lines_removed")))
