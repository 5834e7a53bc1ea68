"""Corpus pipeline: documents in, token ids out.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns the
rows for the next stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import langid, line_dedup, mixing, sentencepieces, simhash
from skein.llm.common import free, table, written

LEAST_SCORE = 0.5  # share of the letters that the predicted language must have
MIN_SITES = 10


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of which no language has half the letters, go; the
    label column becomes the predicted language."""
    model = langid.train(docs)
    found = langid.label_rows(docs, model)
    pred, score = found.columns[-2:]
    kept = found.where((F.col(pred) != langid.UND) & (F.col(score) >= LEAST_SCORE))
    return kept.select(*[F.col(pred).alias(c) if c == "lang" else F.col(c) for c in docs.columns])


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on ten or more sources stay in one document only; ``n_chars`` follows."""
    clean = line_dedup.remove_boilerplate(docs, min_sites=MIN_SITES)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id (rows
    without an id come last, equal ids are ordered by a hash of their text, and of rows equal
    in both one stays)."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), F.xxhash64("text").alias("h"))
    name = free(docs.columns, "_key")
    keyed = docs.withColumn(name, key)
    found = simhash.near_duplicates(keyed, id_col=name, shingle=3, radius=2)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias(name)).distinct()
    return keyed.join(kept, name).dropDuplicates([name]).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it (0, 1 or 2)."""
    taken = mixing.copies(docs, mixing.balance(docs))
    each = taken.withColumn(free(taken.columns, "_copy"), F.explode(F.array_repeat(F.lit(1), F.col(taken.columns[-1]))))
    return each.select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the text that the ids decode to."""
    import public_tokenizers

    model = sentencepieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    return sentencepieces.round_trip(docs, model)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_deduplication),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage is written once and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
