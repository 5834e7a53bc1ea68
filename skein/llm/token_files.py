"""Token-id files with a minimal-perfect-hash index.

Layout of a dataset folder (every table is Parquet, so any store Spark writes will do):

``shards``  one row per block: part, block, doc_ids (in order), ``ends`` (ids up to and with
            each document), and ``payload``, the raw little-endian ids of the block's documents end to end
            (unsigned 16-bit if the vocabulary fits, else 32-bit)
``blocks``  part, block, start (ids before the block in the whole dataset), n_docs, n_ids,
            first_id, and ``goes_on``: the block before ends with the same document id
``index``   one row per key bucket: the bit levels of a minimal perfect hash over the
            bucket's document ids and, by slot, the key's 32-bit fingerprint, part, block,
            place in the block (whose ``ends`` give the offset), and how many documents and ids carry the key
``meta``    one row: number of buckets, id width, end id

Documents lie in ascending id order (NULL ids first, equal ids by a hash of their text),
parts being ranges of ids, so a block is a contiguous slice. A key's bucket is its hash
modulo the bucket count and its slot takes one probe per level: access time does not
depend on the number of documents. A stranger's key fails the fingerprint (one in 2^32
passes) and is then compared by ``fetch`` with the id stored at the place found.

Scale: the text is shuffled once, on range bounds that include the text hash, so many rows
of one id split over parts. A block closes at ``block_ids`` ids; one document never spans
blocks. Offsets of blocks need one prefix sum over per-part totals, one row per part.

Defined cases: NULL text is an empty document (only the end id); a NULL id is stored but
not indexed (``read`` gives it); rows with equal ids are all stored, the index gives their
first place and their number, and ``fetch`` returns all of them, following ``goes_on``
into later blocks; an empty table gives empty shards and index. Other columns are ignored.
"""

from __future__ import annotations

import gc
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm import mph
from skein.llm.wordcache import WordIds

BLOCK_IDS = 1 << 20
BUCKET_KEYS = 2048
DEPTH = 4 << 20  # bytes of text whose words are looked up together
WORDS, UNITS = 800_000, 600_000  # remembered per generation in a Python worker: some 200 MB at most

_CLOSING = re.compile(rb"(?<=[a-z0-9])[.,;:!?]+(?=\n)").sub  # punctuation that closes a line

_SHARD = "part int, block int, doc_ids array<bigint>, ends array<bigint>, payload binary"


class _Words:
    """Ids of white-space-free words by the ``tokenizers`` library.

    A word is cut where the library cuts anyway: before closing punctuation that follows an
    ASCII letter or digit; ASCII capitals are folded as the library folds them. Words of
    letters only are one unit to the library, so they are encoded many in one text, and the
    units' last tokens (those with the end-of-word suffix) tell them apart."""

    def __init__(self, model: bytes, width: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok, self.width = Tokenizer.from_str(model.decode()), np.dtype(width)
        spec = json.loads(model)
        suffix = spec["model"].get("end_of_word_suffix")
        kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.plain = bool(suffix) and kinds == ["NFC", "Replace", "Lowercase"]
        vocab = self.tok.get_vocab(with_added_tokens=True)
        if self.plain:  # a-z only: nothing to normalise or to cut but at white space
            last_step = spec["pre_tokenizer"]["pretokenizers"][-1]
            spec |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, last_step]}}
            self.lean = Tokenizer.from_str(json.dumps(spec))
        self.units = WordIds(self._encode_units, UNITS)
        self.last = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.last[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True

    def encode(self, words: list) -> list[bytes]:
        if not self.plain:
            return self._encode_units(words)
        lines = _CLOSING(rb" \g<0>", b"\n".join(words).lower() + b"\n").split(b"\n")[:-1] if words else []
        for i, w in enumerate(words) if b"<|" in b"\n".join(words) else ():
            if b"<|" in w:  # may be a special token: to the library as it is
                lines[i] = w
        self.units.learn(set(b"\n".join(lines).replace(b" ", b"\n").split(b"\n")) - {b""})
        ids, out = self.units.known, []
        for line in lines:
            found = ids.get(line)
            if found is None:
                core, _, closing = line.partition(b" ")
                found = ids[core] + ids[closing]
            out.append(found)
        return out

    def _encode_units(self, units: list) -> list[bytes]:
        texts = [u.decode() for u in units]
        out: list = [None] * len(units)
        if self.plain:
            letters = [i for i, t in enumerate(texts) if t.isalpha()]
            self._encode_letters(texts, [i for i in letters if texts[i].isascii()], self.lean, out)
            self._encode_letters(texts, [i for i in letters if not texts[i].isascii()], self.tok, out)
        rest = [i for i, x in enumerate(out) if x is None]
        for lo in range(0, len(rest), 4096):
            part = rest[lo:lo + 4096]
            for i, e in zip(part, self.tok.encode_batch_fast([texts[i] for i in part], add_special_tokens=False)):
                out[i] = np.array(e.ids, dtype=self.width).tobytes()
        return out

    def _encode_letters(self, texts: list, places: list, tok, out: list) -> None:
        """Fill ``out`` at the ``places`` of units of letters only, many in one text."""
        size = self.width.itemsize
        for lo in range(0, len(places), 512):
            part = places[lo:lo + 512]
            got = np.array(tok.encode_batch_fast([" ".join([texts[i] for i in part])], add_special_tokens=False)[0].ids, dtype=self.width)
            ends = ((np.flatnonzero(self.last[got]) + 1) * size).tolist()
            if len(ends) == len(part):
                raw = got.tobytes()
                for i, a, b in zip(part, [0, *ends], ends):
                    out[i] = raw[a:b]


_LOADED: dict = {}


def _store(model: bytes, width: str) -> WordIds:
    """The tokenizer and the words met so far, once per Python worker."""
    if (model, width) not in _LOADED:
        _LOADED.clear()
        _LOADED[model, width] = WordIds(_Words(model, width).encode, WORDS)
        gc.freeze()  # the vocabulary stays as long as the worker
    return _LOADED[model, width]


def _slices(batches, bound: int = DEPTH):
    """(id, words) lists of about ``bound`` bytes of text; words are split at ASCII white
    space, which the tokenizer drops and never joins across."""
    held, n = [], 0
    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
            raw = text.as_py() or b""
            held.append((key, raw.split()))
            n += len(raw)
            if n >= bound:
                yield held
                held, n = [], 0
    if held:
        yield held


def write(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, block_ids: int = BLOCK_IDS) -> None:
    """Encode every whole text with the ``tokenizers`` file and write the dataset folder."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    with open(tokenizer, "rb") as f:
        raw = f.read()
    size = Tokenizer.from_str(raw.decode()).get_vocab_size(with_added_tokens=True)
    width = "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"
    model = spark.sparkContext.broadcast(raw)  # one vocabulary file: a few MB
    end = np.array([end_id], dtype=width).tobytes()

    def encode(batches):
        from pyspark import TaskContext

        store, part, block = _store(model.value, width), TaskContext.get().partitionId(), 0
        keys, ends, payload, n = [], [], [], 0
        step = np.dtype(width).itemsize

        def row():
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([keys], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())), pa.array([b"".join(payload)], pa.binary())], names=["part", "block", "doc_ids", "ends", "payload"])

        gc.disable()  # lists of words are many and never in a cycle
        try:
            for docs_in in _slices(batches):
                store.learn(set().union(*(words for _, words in docs_in)))
                for key, words in docs_in:
                    ids = store.ids(words) + end
                    n += len(ids) // step
                    keys.append(key), ends.append(n), payload.append(ids)
                    if n >= block_ids:
                        yield row()
                        block, n = block + 1, 0
                        keys, ends, payload = [], [], []
            if keys:
                yield row()
        finally:
            gc.enable()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
        .repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "h")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(encode, _SHARD).write.option("compression", "zstd").parquet(f"{path}/shards")
    model.unpersist()
    shards = spark.read.schema(_SHARD).parquet(f"{path}/shards")

    sizes = shards.select("part", "block", F.size("doc_ids").cast("long").alias("n_docs"), F.element_at("ends", -1).alias("n_ids"), F.element_at("doc_ids", 1).alias("first_id"), F.element_at("doc_ids", -1).alias("last_id"))
    totals = sizes.groupBy("part").agg(F.sum("n_ids").alias("part_ids"), F.max_by("last_id", "block").alias("last_id"))
    parts_in_order = Window.orderBy("part")  # one row per part
    before = totals.select("part", (F.sum("part_ids").over(parts_in_order) - F.col("part_ids")).alias("part_start"), F.lag("last_id").over(parts_in_order).alias("id_before"))
    in_part = Window.partitionBy("part").orderBy("block")
    placed = sizes.withColumns({"in_part": F.sum("n_ids").over(in_part) - F.col("n_ids"), "nth": F.row_number().over(in_part), "same_part": F.lag("last_id").over(in_part)}).join(before, "part")
    last = F.when(F.col("nth") == 1, F.col("id_before")).otherwise(F.col("same_part"))
    goes_on = F.coalesce(F.col("first_id") == last, F.lit(False)).alias("goes_on")
    placed.select("part", "block", (F.col("part_start") + F.col("in_part")).alias("start"), "n_docs", "n_ids", "first_id", goes_on).write.parquet(f"{path}/blocks")

    entries = _places(shards).where(F.col("doc_id").isNotNull())
    keyed = entries.groupBy("doc_id").agg(F.min(F.struct("part", "block", "nth")).alias("at"), F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_ids"))
    n_docs = spark.read.parquet(f"{path}/blocks").agg(F.sum("n_docs")).first()[0] or 0
    buckets = max(1, -(-n_docs // BUCKET_KEYS))

    def index(batches):
        for b in batches:
            for bucket, rows in zip(b.column(0), b.column(1)):
                rows = rows.as_py()
                keys = np.array([r["doc_id"] for r in rows], dtype=np.int64)
                levels = mph.build(keys)
                order = np.argsort(mph.slots(levels, keys))
                take = [rows[i] for i in order]
                cols = [bucket.as_py(), levels, mph.fingerprint(keys[order]).astype(np.int64).tolist()] + [[r[c] for r in take] for c in ("part", "block", "nth", "n_docs", "n_ids")]
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cols, (pa.int64(), pa.list_(pa.binary()), *[pa.list_(pa.int64())] * 6))], names=[c.split()[0] for c in _INDEX.split(", ")])

    grouped = keyed.select(_bucket(buckets), F.struct("doc_id", "at.part", "at.block", "at.nth", "n_docs", "n_ids").alias("r")).groupBy("bucket").agg(F.collect_list("r").alias("rows"))
    grouped.mapInArrow(index, _INDEX).write.parquet(f"{path}/index")
    spark.range(1).select(F.lit(buckets).cast("long").alias("buckets"), F.lit(width).alias("width"), F.lit(end_id).alias("end_id")).write.parquet(f"{path}/meta")


_INDEX = "bucket bigint, levels array<binary>, fingerprint array<bigint>, part array<bigint>, block array<bigint>, nth array<bigint>, n_docs array<bigint>, n_ids array<bigint>"


def _bucket(buckets):
    return F.pmod(F.xxhash64("doc_id"), F.lit(buckets).cast("long")).alias("bucket")


def _places(shards: DataFrame) -> DataFrame:
    """(doc_id, part, block, nth, n_tokens) of every stored document; ``nth`` is its place in
    the block, from 0."""
    before = F.concat(F.array(F.lit(0).cast("long")), "ends")
    both = shards.select("part", "block", F.posexplode(F.arrays_zip("doc_ids", F.zip_with("ends", F.slice(before, F.lit(1), F.size("ends")), lambda e, s: e - s).alias("n"))))
    return both.select(F.col("col.doc_ids").alias("doc_id"), "part", "block", F.col("pos").cast("long").alias("nth"), F.col("col.n").alias("n_tokens"))


_READ = "doc_id bigint, part int, block int, offset bigint, n_tokens bigint, ids_crc32 bigint"


def read(spark: SparkSession, path: str, without_id: bool = False) -> DataFrame:
    """Every stored document from the files, or those without an id, which have no key:
    doc_id, start (ids of all documents before it), n_tokens, and the crc32 of its ids as
    little-endian 32-bit numbers."""
    width = spark.read.parquet(f"{path}/meta").first()["width"]

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                part, block, keys, ends, payload = (b.column(c)[i] for c in range(5))
                ends = np.array(ends.as_py(), dtype=np.int64)
                lens = np.diff(ends, prepend=0)
                ids = memoryview(np.frombuffer(payload.as_buffer(), dtype=width).astype("<u4").tobytes())
                crcs = [zlib.crc32(ids[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lens.tolist())]
                cols = [keys.values, pa.array([part.as_py()] * len(lens), pa.int32()), pa.array([block.as_py()] * len(lens), pa.int32()), pa.array(ends - lens), pa.array(lens), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in _READ.split(", ")])

    shards = spark.read.schema(_SHARD).parquet(f"{path}/shards")
    stored = (shards.where(F.element_at("doc_ids", 1).isNull()) if without_id else shards).mapInArrow(run, _READ)  # NULL ids come first
    stored = stored.where("doc_id IS NULL") if without_id else stored
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "block", F.col("start").alias("block_start"))
    # joined after the payload is digested, so only short rows move
    return stored.join(blocks, ["part", "block"]).select("doc_id", (F.col("block_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def lookup(keys: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Places of the keys by the index: doc_id, part, block, nth, n_docs, n_ids. Keys are
    taken once each; keys the index does not hold give no row."""
    spark = keys.sparkSession
    buckets = spark.read.parquet(f"{path}/meta").first()["buckets"]

    def probe(batches):
        for b in batches:
            for i in range(b.num_rows):
                keys, *cols = (b.column(c)[i].values.to_numpy() for c in (0, 2, 3, 4, 5, 6, 7))
                at = mph.slots(b.column(1)[i].as_py(), keys)
                hit = (at >= 0) & (cols[0][np.maximum(at, 0)] == mph.fingerprint(keys))
                yield pa.RecordBatch.from_arrays([pa.array(keys[hit]), *[pa.array(c[at[hit]]) for c in cols[1:]]], names=["doc_id", "part", "block", "nth", "n_docs", "n_ids"])

    asked = keys.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    index = spark.read.parquet(f"{path}/index")
    share = max(1, -(-asked.count() // (buckets * BUCKET_KEYS)))  # many more keys than the index holds: several rows a bucket
    packed = asked.groupBy(_bucket(buckets), F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(share)).alias("s")).agg(F.collect_set("doc_id").alias("doc_ids"))
    return packed.join(index, "bucket").select("doc_ids", *[c.split()[0] for c in _INDEX.split(", ")][1:]).mapInArrow(probe, "doc_id bigint, part bigint, block bigint, nth bigint, n_docs bigint, n_ids bigint")


_FETCHED = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def fetch(keys: DataFrame, path: str, id_col: str = "doc_id", ids: bool = True) -> DataFrame:
    """Documents by key: doc_id, start, n_tokens and ids_crc32 as ``read`` gives them, and
    ``ids`` (array<int>, or bigint where ids have 32 bits) if asked for. Every stored
    document of a key comes back, keys are taken once each, and keys that the files do not
    hold give no row.

    Places from the index are gathered by block (at most the block's documents), so a block
    is opened once for all its keys and other blocks are not. Blocks are dealt over as many
    tasks as wrote them, not merged into fewer, since a task is handed whole payloads."""
    spark = keys.sparkSession
    width = spark.read.parquet(f"{path}/meta").first()["width"]
    item, kind = (pa.int32(), "int") if width == "<u2" else (pa.int64(), "bigint")
    schema = _FETCHED + f", ids array<{kind}>" * ids
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                start, asked, ends = b.column(0)[i].as_py(), b.column(1)[i].values, b.column(3)[i].values.to_numpy()
                stored = b.column(2)[i].values
                blank, held = stored.null_count, stored.drop_null().to_numpy()  # NULL ids come first, the others ascend
                want, at, n = (asked.field(c).to_numpy() for c in range(3))
                hit = (at >= blank) & (at < len(ends))
                want, at, n = want[hit], at[hit], n[hit]
                hit = held[at - blank] == want  # else a stranger was led there
                want, at, n = want[hit], at[hit], n[hit]
                n = np.minimum(n, np.searchsorted(held, want, side="right") + blank - at)
                docs = np.repeat(at - np.cumsum(n) + n, n) + np.arange(n.sum())
                lens = np.diff(ends, prepend=0)[docs]
                begins = ends[docs] - lens
                raw = np.frombuffer(b.column(4)[i].as_buffer(), dtype=width)
                crcs = [zlib.crc32(raw[s:s + k].astype("<u4")) for s, k in zip(begins.tolist(), lens.tolist())]
                cols = [pa.array(np.repeat(want, n)), pa.array(start + begins), pa.array(lens), pa.array(crcs, pa.int64())]
                if ids:
                    to = np.cumsum(lens)
                    flat = raw[np.repeat(begins - to + lens, lens) + np.arange(lens.sum())]
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], to]).astype(np.int32)), pa.array(flat).cast(item)))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    shards, blocks = spark.read.schema(_SHARD).parquet(f"{path}/shards"), spark.read.parquet(f"{path}/blocks")
    first = lookup(keys, path, id_col).select("part", "block", "doc_id", "nth", "n_docs")
    asked = keys.select(F.col(id_col).cast("long").alias("doc_id"))
    later = blocks.where("goes_on").withColumnRenamed("first_id", "doc_id").join(asked, "doc_id", "left_semi")
    places = first.unionByName(later.select("part", "block", "doc_id", F.lit(0).cast("long").alias("nth"), "n_docs"))
    by_block = places.groupBy("part", "block").agg(F.collect_list(F.struct("doc_id", "nth", "n_docs")).alias("asked"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = by_block.join(blocks.select("part", "block", "start"), ["part", "block"])
    opened = shards.withColumn("part", F.col("part").cast("long")).withColumn("block", F.col("block").cast("long")).repartition(parts, "part", "block").join(placed, ["part", "block"])
    return opened.select("start", "asked", "doc_ids", "ends", "payload").mapInArrow(run, schema)


def starts(spark: SparkSession, path: str, found: DataFrame) -> DataFrame:
    """(doc_id, index_start, index_tokens) from the rows of ``lookup``: place in the whole
    dataset and number of ids of all documents with the key."""
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "block", F.col("start").alias("block_start"))
    shards = spark.read.schema(_SHARD).parquet(f"{path}/shards").select("part", "block", "ends")
    offset = F.coalesce(F.get("ends", F.col("nth").cast("int") - 1), F.lit(0).cast("long"))
    return found.join(blocks, ["part", "block"]).join(shards, ["part", "block"]).select("doc_id", (F.col("block_start") + offset).alias("index_start"), F.col("n_ids").alias("index_tokens"))
