"""WARC archives: writing pages as records, and reading archives back with segment
reassembly.

Writing. A page becomes a ``response`` record whose block is an HTTP message in chunked
transfer framing. Of pages with equal payloads of at least ``least`` bytes the one with the
smallest id is the response; the others become ``revisit`` records that name it and its
payload digest and carry no payload. A block above ``segment`` bytes is cut: its first part
is the response record with ``WARC-Segment-Number: 1``, the rest are ``continuation``
records with the origin's id, and the last one gives the total length. Records are written
by Spark's text writer with the record terminator as line separator, so archives are plain
WARC files (gzip by default) on any file system that Spark writes, and a lost executor's files are
written again by the commit protocol. Chunk borders are laid so that the letters
``WARC/1.`` never stand whole inside a block.

Reading. Spark's text reader splits archives at ``WARC/1.``: large files that are not
compressed are shared among tasks, and a task holds one record at a time. Where a foreign
record holds those letters, its piece is shorter than its ``Content-Length`` says and takes up
the pieces that follow until the length is right (within a split). A record that stays short
or runs over is reported as not sound, and the pieces after its first are read on their own. Continuation records
are grouped by their origin's id and ordered by segment number; numbers must run from 1
without gaps and the lengths must add up to the stated total. Then the HTTP head is cut off
and the chunked framing decoded.

Scale: equal payloads are found by a partial aggregate over digests; the id of the response
is joined back by (digest, salt), so a payload that a third of all pages share spreads over
``SALTS`` tasks. No step collects the pages of one payload. Payload bytes move once, to
their archive. A page's segments meet in one cell, so a payload is bounded by 2 GB as the
page's own cell is.

Defined cases: a NULL html is an empty payload; NULL page ids come last when the smallest
is sought and are written without an id; pages that repeat an id are records each, and of
equal payloads with the same id one record is the response; a NULL url becomes ``about:blank``;
control characters and blanks in urls are percent-encoded; an empty table gives an
empty archive; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import written

SEGMENT = 1 << 20
CHUNK = 1 << 16
SALTS = 32
END = "\r\n\r\n"
# The reader's separator. No beginning of it is also its end, so a reader that meets half of it at
# a buffer's border can't lose a record (with the line breaks in front, Hadoop's does).
_MARK = "WARC/1."
_CELL = 1 << 31
_DATE = "2000-01-01T00:00:00Z"
_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 40 hex digits as 4 numbers of 40 bits."""
    hexed = F.sha1(data)
    part = lambda i: F.lpad(F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 32), 8, "0")
    return F.translate(F.concat(*[part(i) for i in range(4)]), _DIGITS, _B32)


def _raw(text: Column) -> Column:
    """Bytes as a string column without checks: what the text writer writes as it is."""
    return text.cast("string")


def _length(data: Column) -> Column:
    return F.octet_length(data).cast("long")


def _pieces(data: Column, size: int) -> Column:
    """The bytes in pieces of ``size``; none for no bytes."""
    last = F.floor((F.octet_length(data) - 1) / size)
    return F.when(F.octet_length(data) > 0, F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: F.substring(data, (i * size + 1).cast("int"), F.lit(size)))).otherwise(F.array().cast("array<binary>"))


def _framed(html: Column, chunk: int) -> Column:
    """Chunked transfer framing; ``WARC/1.`` is always cut in two."""
    parts = F.split(html, r"(?<=WARC)(?=/1\.)")
    chunks = F.flatten(F.transform(parts, lambda p: _pieces(p.cast("binary"), chunk)))
    framed = F.transform(chunks, lambda c: F.concat(F.lower(F.hex(_length(c))), F.lit("\r\n"), _raw(c), F.lit("\r\n")))
    return F.concat(F.array_join(framed, ""), F.lit("0\r\n\r\n"))


def _fields(*pairs: tuple[str, Column]) -> Column:
    """Header lines; a field whose value is NULL is left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit("")) for name, value in pairs])


def classified(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> DataFrame:
    """(key, copy, page_id, url, html, digest, bytes, first_key, first_page): one row per
    page; the last two are NULL for responses. ``key`` names rows that are equal in id, url and
    payload, ``copy`` numbers them; of copies that refer to an earlier record html is NULL."""
    url, html = F.col(url_col), F.coalesce(F.col(html_col), F.lit(""))
    bare = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), html.alias("html"))
    named = bare.withColumns({"digest": base32_sha1(F.col("html").cast("binary")), "bytes": _length(F.col("html"))})
    rows = named.withColumn("key", F.md5(F.concat_ws("\x00", *[
        F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in ("page_id", "url", "digest", "bytes")])))
    order = F.struct(F.col("page_id").isNull(), "page_id", "key")
    first = rows.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(
        F.count(F.lit(1)).alias("n"), F.min_by(F.struct("key", "page_id"), order).alias("first")).where("n > 1")
    each = first.select("digest", "bytes", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    keys = rows.groupBy("key").agg(F.first("digest").alias("digest"), F.first("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    found = keys.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(each, ["digest", "bytes", "salt"], "left")
    # payload bytes move here, once: equal rows meet by key and the kinds join them on it
    pages_once = rows.groupBy("key").agg(*[F.first(c).alias(c) for c in ("page_id", "url", "html", "digest", "bytes")])
    both = pages_once.join(found.select("key", "n", "first"), "key")
    copies = both.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    revisit = F.col("first").isNotNull() & ((F.col("first.key") != F.col("key")) | (F.col("copy") > 1))
    return copies.select("key", "copy", "page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "digest", "bytes", F.when(revisit, F.col("first.key")).alias("first_key"), F.when(revisit, F.col("first.page_id")).alias("first_page"))


def _record_id(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("/", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _uri(url: Column) -> Column:
    """The url without white space and control characters."""
    bad = F.transform(F.split(F.coalesce(url, F.lit("about:blank")), ""), lambda c: F.when(c.rlike(r"[\x00-\x20\x7f]"), F.concat(F.lit("%"), F.lpad(F.hex(c), 2, "0"))).otherwise(c))
    return F.when(url.rlike(r"[\x00-\x20\x7f]"), F.array_join(bad, "")).otherwise(F.coalesce(url, F.lit("about:blank")))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0, segment: int = SEGMENT, chunk: int = CHUNK, compression: str = "gzip") -> None:
    """Writes ``pages`` as WARC archives below ``path``; an archive is a partition of the one
    shuffle that moves the payloads, so its size follows Spark's advisory partition size."""
    rows = classified(pages, id_col, url_col, html_col, least)
    response = F.col("first_key").isNull()
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n")
    chunked = F.lit("Transfer-Encoding: chunked\r\n\r\n")
    block = F.when(response, F.concat(http, chunked, _framed(F.col("html"), chunk))).otherwise(F.concat(http, F.lit("\r\n")))
    parts = rows.withColumn("block", block.cast("binary")).withColumn("whole", _length(F.col("block"))).drop("html").select("*", F.posexplode(_pieces(F.col("block"), segment)).alias("seg", "part"))
    cut, last = F.col("whole") > segment, (F.col("seg") + 1) * segment >= F.col("whole")
    follows = F.col("seg") > 0
    origin = _record_id(F.col("key"), F.col("copy").cast("string"))
    head = _fields(
        ("WARC-Type", F.when(follows, "continuation").when(response, "response").otherwise("revisit")),
        ("WARC-Record-ID", F.when(follows, _record_id(F.col("key"), F.col("copy").cast("string"), F.col("seg").cast("string"))).otherwise(origin)),
        ("WARC-Date", F.lit(_DATE)),
        ("WARC-Target-URI", _uri(F.col("url"))),
        ("WARC-Page-ID", F.when(~follows, F.url_encode(F.col("page_id").cast("string")))),
        ("WARC-Payload-Digest", F.when(~follows, F.concat(F.lit("sha1:"), F.col("digest")))),
        ("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("part")))),
        ("WARC-Refers-To", F.when(~response, _record_id(F.col("first_key"), F.lit("1")))),
        ("WARC-Profile", F.when(~response, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Segment-Number", F.when(cut, F.col("seg") + 1)),
        ("WARC-Segment-Origin-ID", F.when(follows, origin)),
        ("WARC-Segment-Total-Length", F.when(cut & last, F.col("whole"))),
        ("Content-Type", F.when(~follows, "application/http;msgtype=response")),
        ("Content-Length", _length(F.col("part"))),
    )
    lines = parts.select(F.concat(F.lit("WARC/1.1\r\n"), head, F.lit("\r\n"), _raw(F.col("part"))).alias("value"))
    lines.write.option("lineSep", END).option("compression", compression).text(path)


_TEXTS = ("record_id", "record_type", "page_id", "url", "refers_to", "origin", "stated_digest")


def _parse(piece: bytes) -> tuple[dict, bytes, int]:
    """(header fields, block, fit) of a piece after its mark. fit: 0 if the block has the stated
    length and only line ends follow, -1 if it is short, 1 if there is more."""
    at = piece.find(b"\r\n\r\n")
    if at < 0:
        return {}, b"", -1
    fields = {k.strip().lower(): v.strip().decode("utf-8", "replace") for k, _, v in (x.partition(b":") for x in piece[:at].split(b"\r\n")[1:])}
    size = fields.get(b"content-length", "")
    if not size.isdigit():
        return fields, piece[at + 4:], 1
    end = at + 4 + int(size)
    return fields, piece[at + 4:end], -1 if len(piece) < end else 1 if piece[end:].strip(b"\r\n") else 0


def _joined(pieces):
    """(fields, block, sound) of every record in a split's pieces."""
    held: list[bytes] = []  # the pieces of a record that is still short
    todo: list[bytes] = []
    source = iter(pieces)
    while True:
        piece = todo.pop() if todo else next(source, None)
        if piece is not None:
            fields, block, fit = _parse(_MARK.encode().join([*held, piece]))
            if fit < 0 and sum(map(len, held)) + len(piece) < _CELL:
                held.append(piece)
                continue
            if fit == 0 or not held:
                yield fields, block, fit == 0
                held = []
                continue
            todo.append(piece)
        if not held:
            return
        fields, block, _ = _parse(held[0])
        if fields:
            yield fields, block, False
        todo += reversed(held[1:])
        held = []


def dechunked(block: bytes) -> bytes | None:
    """The payload of an HTTP message, chunked or not; None where the framing is broken."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        return None
    if not re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head):
        return body
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].partition(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            return None
        n, at = int(size, 16), end + 2
        if n == 0:
            return b"".join(out)
        if body[at + n:at + n + 2] != b"\r\n":
            return None
        out.append(body[at:at + n])
        at += n + 2


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _fields_type(block: bool, payload: bool) -> T.StructType:
    kinds = [(c, T.StringType()) for c in _TEXTS] + [("seg", T.LongType()), ("total", T.LongType()), ("sound", T.BooleanType()), ("bytes", T.LongType()), ("digest", T.StringType())]
    kinds += [("block", T.BinaryType())] * block + [("payload", T.BinaryType())] * payload
    return T.StructType([T.StructField(n, t) for n, t in kinds])


_ARROW = {T.StringType: pa.string(), T.LongType: pa.int64(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary()}


def _batch(rows: list, kind: T.StructType):
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], _ARROW[type(f.dataType)]) for f in kind], names=kind.names)


def _decode(row: dict, block: bytes) -> None:
    """Size, digest and bytes of the payload of a whole response block."""
    data = dechunked(block)
    found = _base32(hashlib.sha1(data).digest()) if data is not None else None
    row |= {"bytes": None if data is None else len(data), "digest": found, "payload": data,
            "sound": row["sound"] and data is not None and row["stated_digest"] in (None, found)}


def records(spark: SparkSession, path: str, blocks: bool = True, payload: bool = False) -> DataFrame:
    """Every record of the archives: header columns, ``seg`` and ``total`` of segments,
    ``sound`` (the block is as long as stated, agrees with its digest and, of an uncut
    response, decodes to the stated payload digest), and of uncut responses ``bytes`` and
    ``digest`` of the payload. ``block`` has the bytes of every record, or without ``blocks`` of
    segments only; ``payload`` adds decoded payloads."""
    lines = spark.read.option("lineSep", _MARK).text(path).select(F.col("value").cast("binary").alias("piece"))
    kind = _fields_type(True, payload)

    def row(fields, block, fits):
        get = lambda k: fields.get(k.encode())
        number = lambda k: int(get(k)) if (get(k) or "").isdigit() else None
        stated = get("warc-block-digest")
        values = (get("warc-record-id"), get("warc-type"), get("warc-page-id"), get("warc-target-uri"), get("warc-refers-to"), get("warc-segment-origin-id"),
                  (get("warc-payload-digest") or "").removeprefix("sha1:") or None)
        out = dict(zip(_TEXTS, values), seg=number("warc-segment-number"), total=number("warc-segment-total-length"), bytes=None, digest=None, payload=None)
        out["sound"] = fits and (not stated or stated.removeprefix("sha1:") == _base32(hashlib.sha1(block).digest()))
        if out["seg"] is None and out["record_type"] == "response":
            _decode(out, block)
        out["block"] = block if blocks or out["seg"] is not None else None
        return out

    def run(batches):
        pieces = (value.as_py() for b in batches for value in b.column(0))
        out, size = [], 0
        for fields, block, fits in _joined(p for p in pieces if p):  # nothing stands before the first mark
            out.append(row(fields, block, fits))
            size += len(block)
            if size > 4 << 20 or len(out) >= 4096:
                yield _batch(out, kind)
                out, size = [], 0
        yield _batch(out, kind)

    return lines.mapInArrow(run, kind)


def reassembled(found: DataFrame) -> DataFrame:
    """The segmented records of ``found``, one row per origin: ``block`` joined by segment
    number, and ``sound`` if the numbers run from 1 without gaps, the lengths add up to the
    stated total and every part is sound."""
    part = F.struct("seg", "block", "total", "sound", *_TEXTS)
    groups = found.where("seg IS NOT NULL").groupBy(F.coalesce("origin", "record_id").alias("first")).agg(F.sort_array(F.collect_list(part)).alias("parts"))
    parts = F.col("parts")
    length = F.aggregate(parts, F.lit(0).cast("long"), lambda s, p: s + _length(p["block"]))
    in_order = F.transform(parts, lambda p: p["seg"]) == F.sequence(F.lit(1).cast("long"), F.size(parts).cast("long"))
    sound = in_order & (F.element_at(parts, -1)["total"] == length) & F.forall(parts, lambda p: p["sound"])
    head = F.get(parts, F.lit(0))
    block = F.array_join(F.transform(parts, lambda p: _raw(p["block"])), "").cast("binary")
    return groups.select(*[head[c].alias(c) for c in _TEXTS], F.coalesce(sound, F.lit(False)).alias("sound"), block.alias("block"))


def read(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """(record_id, record_type, page_id, url, refers_to, refers_to_page, complete,
    payload_bytes, payload_digest[, payload]) of the archives' response and revisit records.
    Size and digest are those of the decoded payload; a revisit has its response's (its
    payload stays NULL, ``refers_to`` names the record that holds it)."""
    kind = T.StructType([T.StructField(c, T.StringType()) for c in _TEXTS] + [f for f in _fields_type(False, payload) if f.name in ("sound", "bytes", "digest", "payload")])

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = {n: b.column(j)[i].as_py() for j, n in enumerate(b.schema.names) if n != "block"} | {"bytes": None, "digest": None, "payload": None}
                if row["record_type"] == "response":
                    _decode(row, b.column(b.schema.names.index("block"))[i].as_buffer().to_pybytes())
                yield _batch([row], kind)

    # parsed once: the archives' bytes are not read again for the segments or the revisits
    found = written(records(spark, path, blocks=False, payload=payload), "warc-records")
    joined = reassembled(found).mapInArrow(run, kind)
    whole = found.where("seg IS NULL AND record_type IN ('response', 'revisit')").select(*kind.names)
    rows = whole.unionAll(joined.where("record_type IN ('response', 'revisit')")).withColumnRenamed("sound", "complete")
    narrow = rows.drop("payload")
    named = narrow.where("refers_to IS NOT NULL").select(F.col("refers_to").alias("record_id")).distinct()
    origin = narrow.where("record_type = 'response'").join(named, "record_id", "left_semi").select(
        F.col("record_id").alias("refers_to"), F.col("bytes").alias("_bytes"), F.col("digest").alias("_digest"), F.col("page_id").alias("refers_to_page"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int"))
    out = salted.join(origin, ["refers_to", "_salt"], "left")
    revisit = F.col("record_type") == "revisit"
    agrees = ~revisit | F.coalesce(F.col("stated_digest") == F.col("_digest"), F.lit(False))
    return out.select(
        "record_id", "record_type", F.url_decode("page_id").alias("page_id"), "url", "refers_to", F.url_decode("refers_to_page").alias("refers_to_page"),
        (F.col("complete") & agrees).alias("complete"), F.when(revisit, F.col("_bytes")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("_digest")).otherwise(F.col("digest")).alias("payload_digest"), *(["payload"] if payload else []))
