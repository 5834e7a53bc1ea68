"""The corpus pipeline, stage by stage, on a small table with the edge cases."""

import random

import corpus_pipeline
from skein.llm.common import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORDS = {"en": "the and of with from that which would there their about people".split(), "de": "der und nicht sich einem werden zwischen über haben diese".split()}


def make(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(160):
        lang = rnd.choice(["en", "de"])
        text = ". ".join(" ".join(rnd.choice(WORDS[lang]) for _ in range(12)) for _ in range(4))
        rows.append((i, f"{text}\nshared footer line {i // 200}", lang, f"s{i % 14}"))
    rows += [(200 + i, rows[5][1], "en", f"s{i % 3}") for i in range(30)]
    rows += [(300, None, None, None), (301, "", "en", "s1"), (302, "1 2 3", "en", "s1"), (303, rows[7][1], None, None), (303, rows[7][1], None, None), (None, rows[9][1], "en", "s2")]
    rows += [(None, " ".join(rnd.choice(WORDS["de"]) for _ in range(40)), "de", "s3") for _ in range(3)]
    return rows, spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark):
    rows, docs = make(spark)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "line dedup", "SimHash near-dedup", "mixing sources to target weights", "SentencePiece encoding and decoding"]
    kept = corpus_pipeline.language_id(spark, docs, "").cache()
    assert kept.columns == COLUMNS and kept.count() == len(rows) - 3  # NULL, empty and digits go, all else stays
    lines = corpus_pipeline.line_deduplication(spark, kept, "").cache()
    assert lines.columns == COLUMNS and lines.count() == kept.count()
    assert [r["doc_id"] for r in lines.where("text LIKE '%footer%'").collect()] == [0]
    assert lines.where("n_chars <> length(text)").count() == 0
    single = corpus_pipeline.near_duplicates(spark, lines, "").cache()
    listed = [r["doc_id"] for r in single.select("doc_id").collect()]
    ids = [i for i in listed if i is not None]
    assert single.columns == COLUMNS and len(ids) == len(set(ids)) and not any(i >= 200 for i in ids)
    assert len(listed) - len(ids) == 3  # texts without an id are groups of their own
    assert set(range(160)) - {0} <= set(ids) | {0}
    mixed = corpus_pipeline.mix(spark, single, "").cache()
    assert mixed.columns == COLUMNS and max(r["count"] for r in mixed.groupBy("doc_id", "text").count().collect()) <= 2
    out = corpus_pipeline.token_ids(spark, mixed, "")
    assert out.count() == mixed.count()
    pairs = sorted((str(r["doc_id"]), r["text"]) for r in mixed.collect())
    assert pairs == sorted((str(r["doc_id"]), r["text"]) for r in out.collect())


def test_stages_on_an_empty_table(spark):
    _, docs = make(spark)
    docs = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_run_reads_the_documents(spark, tmp_path):
    _, docs = make(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "ids", "n_tokens", "text"] and out.count() > 0
    assert table(spark, str(tmp_path), "documents").count() == docs.count()
