"""One query per operator over the whole given tables, and DuckDB SQL where SQL can
express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import (
    chat, langid, licenses, line_dedup, mixing, negatives, repair, sentencepieces, simhash, syncmers, token_files, topk, warc,
)
from skein.llm.common import shared_path, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates of documents: 3-word shingles, at most 2 differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@_query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of documents written to files and fetched back by doc_id through the
    minimal perfect hash index; documents without an id have no key and are scanned for."""
    import public_tokenizers

    path = shared_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    token_files.write(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.fetch(docs, path, ids=False).unionByName(token_files.read(spark, path, without_id=True))


@_query
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each 50th vector's 5 highest integer inner products over all other vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors, k=5, scale=256.0)


ORACLE["op7_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
q AS (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 50 = 0),
s AS (
  SELECT q.vec_id AS query_id, q.e, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM q JOIN v c ON q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, e ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@_query
def op8_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Syncmer fingerprints of documents and of their edited texts."""
    return syncmers.edited_fingerprints(table(spark, sf_dir, "documents"), positions=True)


@_query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of documents under the public SentencePiece model, and the texts that the
    ids decode to."""
    import public_tokenizers

    model = sentencepieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    return sentencepieces.round_trip(table(spark, sf_dir, "documents"), model)


@_query
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best licence template of each document's pieces: Dice 0.8 or more on word bigrams."""
    return licenses.scan(table(spark, sf_dir, "documents"), threshold=0.8).select("doc_id", "license", "dice", "license_pieces")


def _license_sql(threshold: float) -> str:
    listed = ",\n    ".join(f"('{name}', [{', '.join(repr(g) for g in grams)}])" for name, grams in licenses._prepared(licenses.TEMPLATES))
    return f"""
WITH t(name, grams) AS (VALUES
    {listed}),
p AS (
  SELECT doc_id, text, unnest(list_concat(
      string_split(text, chr(10)),
      list_filter(string_split_regex(text, '\\n[ \\t\\r]*\\n'), lambda b: contains(b, chr(10))),
      CASE WHEN contains(text, chr(10)) THEN [text] ELSE [] END)) AS piece
  FROM documents),
w AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(lower(piece), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM p),
g AS (
  SELECT doc_id, row_number() OVER () AS piece, list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) AS g
  FROM w WHERE len(w) > 1),
d AS (
  SELECT doc_id, piece, name, 2.0::DOUBLE * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice
  FROM g JOIN t ON len(g) * (2 - {threshold}) >= {threshold} * len(grams) AND len(g) * {threshold} <= (2 - {threshold}) * len(grams)),
h AS (
  SELECT doc_id, max(dice) AS dice, CAST(count(DISTINCT piece) AS INTEGER) AS license_pieces, arg_max(name, (dice, -ord)) AS license
  FROM (SELECT *, dense_rank() OVER (ORDER BY name) AS ord FROM d WHERE dice >= {threshold}) GROUP BY doc_id)
SELECT documents.doc_id, license, dice, coalesce(license_pieces, 0) AS license_pieces
FROM documents LEFT JOIN h ON documents.doc_id = h.doc_id
"""


ORACLE["op3_licenses"] = _license_sql(0.8)


@_query
def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    found = langid.identify(docs, model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "spans")


@_query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all documents: sources weighted 3, 1, 2, ... share 150 % of all words."""
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.copies(docs, mixing.balance(docs, weights=(3, 1, 2), share=1.5))
    size = F.col("mix_size")
    return mixed.select("doc_id", size.alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), (size * F.col("mix_copies")).alias("taken"), F.col("mix_copies").alias("copies"))


@_query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on 10 or more sources, but for one copy."""
    clean = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"), min_sites=10)
    return clean.select("doc_id", "text", "lines_removed")


ORACLE["op9_line_dedup"] = """
WITH l AS (
  SELECT doc_id, source, i, line, trim(line, ' ') AS t
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM documents)),
b AS (SELECT t, min(doc_id) AS keeper FROM l WHERE t <> '' GROUP BY t HAVING count(DISTINCT source) >= 10),
k AS (SELECT l.*, b.t IS NOT NULL AND l.doc_id IS DISTINCT FROM b.keeper AS gone FROM l LEFT JOIN b ON l.t = b.t),
c AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text,
             CAST(count(*) FILTER (WHERE gone) AS INTEGER) AS lines_removed FROM k GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE c.text END AS text, coalesce(c.lines_removed, 0) AS lines_removed
FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id
"""


_CONTROL = "\\### Assistant: </turn> ok"


@_query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, as a log of messages, deltas, edits and
    regenerations that is folded, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_CONTROL).alias("text"))
    messages = chat.fold(chat.streamed(chat.conversation_events(rows.unionByName(planted))), repeats=True)
    back = chat.parse(chat.render(messages, trained=("assistant",)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE["op10_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
s AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
         sum(length(role) + length(text) + 15 + 2 * length(role) - length(replace(replace(role, '\', ''), '<', '')) - length(replace(role, chr(10), ''))
             + length(text) - length(replace(replace(text, '\', ''), '<', ''))) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM s
""".replace("\\\\", "\\")


@_query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives (chunked framing, segments, revisits) and read back."""
    path = shared_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    found = warc.read(spark, path).where("complete")
    return found.select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to_page").cast("long").alias("refers_to"))


@_query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th vector: for each of its 5 best rows of the same label, the
    10 best rows of other labels within 30 to 90 hundredths of that score."""
    vec_id, label = F.col("vec_id"), F.col("label")
    shifted = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, label=shifted)


ORACLE["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS vec_id,
         CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a, v c WHERE a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth
  FROM s WHERE same),
n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
  WHERE p.nth <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


@_query
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations repaired at least cost; one row per conversation of the table."""
    rows = table(spark, sf_dir, "conversations")
    report, messages = repair.repair(repair.damaged(rows))
    found = report.alias("r").join(repair.digests(messages).withColumnRenamed("conv", "c2"), F.col("r.conv").eqNullSafe(F.col("c2")), "left")
    every = rows.select("conv_id").distinct()
    whole = every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return whole.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
