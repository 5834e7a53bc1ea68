"""Archives, hard negatives and conversation repair against brute-force versions, exact round
trips and the defined edge cases."""

import base64
import gzip
import hashlib
import itertools
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import negatives, repair, warc
from skein.llm.common import shared_path

# ------------------------------------------------------------------ WARC

PAGES = "page_id long, url string, html string, record string, digest string, key string"
HTML = [
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2", "<p>one</p>"),
    (3, None, None),
    (4, "http://a/4", ""),
    (5, "http://a/x y\r\nWARC-Type: evil", "WARC/1.1\r\nWARC-Type: response\r\n\r\nWARC/1.0 WARC/1.WARC/1.1"),
    (6, "http://a/6", "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n"),
    (7, "http://a/7", "é日本🙂" * 700),
    (8, "http://a/8", "é日本🙂" * 700),
    (9, "http://a/9", "0\r\n\r\n"),
    (9, "http://a/9", "0\r\n\r\n"),
    (9, "http://a/9b", "<b>"),
    (None, "http://a/n", "<p>one</p>"),
    (None, None, "only here"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "r", "d", "k") for r in HTML], PAGES)


def archive_bytes(path):
    out = b""
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            data = open(os.path.join(path, name), "rb").read()
            out += gzip.decompress(data) if name.endswith(".gz") else data
    return out


def plain_records(data):
    """An independent reader: headers and Content-Length only."""
    at, out = 0, []
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        out.append((fields, data[end + 4:end + 4 + n]))
        at = end + 4 + n
        assert data[at:at + 4] == b"\r\n\r\n"
        at += 4
    return out


@pytest.mark.parametrize("segment,chunk,compression", [(1 << 20, 1 << 16, "gzip"), (97, 13, "none")])
def test_warc_round_trip(spark, pages, segment, chunk, compression):
    path = shared_path(spark, "test-warc")
    warc.write(pages, path, segment=segment, chunk=chunk, compression=compression)
    raw = plain_records(archive_bytes(path))
    assert len({f["WARC-Record-ID"] for f, _ in raw}) == len(raw)
    assert all(len(b) <= segment for _, b in raw)
    assert all(f["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode() for f, b in raw)
    assert ({f["WARC-Type"] for f, _ in raw} >= {"continuation"}) == (segment < 1000)

    got = warc.read(spark, path, payload=True).collect()
    assert len(got) == len(HTML) and all(r["complete"] for r in got)
    want = []
    for i, (pid, _, html) in enumerate(HTML):
        data = (html or "").encode()
        same = [(p is None, p, j) for j, (p, _, h) in enumerate(HTML) if (h or "").encode() == data]
        first = min(same, key=lambda x: (x[0], x[1] or 0, x[2]))
        kind = "response" if first[2] == i else "revisit"
        refers = str(first[1]) if kind == "revisit" and first[1] is not None else None
        want.append((str(pid) if pid is not None else None, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, refers))
    have = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to_page"]) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    assert all(bytes(r["payload"]) in {(h or "").encode() for _, _, h in HTML} for r in got if r["record_type"] == "response")
    assert {r["url"] for r in got if r["page_id"] == "5"} == {"http://a/x%20y%0D%0AWARC-Type:%20evil"}


def test_warc_least_bytes_and_empty_table(spark, pages):
    path = shared_path(spark, "test-warc")
    warc.write(pages, path, least=8)
    kinds = {r["page_id"]: r["record_type"] for r in warc.read(spark, path).collect() if r["page_id"] in ("2", "3", "4")}
    assert kinds == {"2": "revisit", "3": "response", "4": "response"}
    path = shared_path(spark, "test-warc")
    warc.write(pages.where("false"), path)
    assert warc.read(spark, path).collect() == []


def record(kind, rid, block, **fields):
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{rid}>", *[f"{k.replace('_', '-')}: {v}" for k, v in fields.items()], f"Content-Length: {len(block)}"]
    return b"WARC/1.0\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_warc_reads_foreign_archives(spark):
    """Segments out of order and apart, a block with the record mark inside, a missing segment, a
    wrong total length, broken chunk framing, a chunk extension and an unknown record type."""
    http = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: Chunked\r\n\r\n"
    plain = b"HTTP/1.1 200 OK\r\n\r\n"
    whole = http + b"4;ext=1\r\nabcd\r\n2\r\nef\r\n0\r\n\r\n"
    cut = [whole[:20], whole[20:50], whole[50:]]

    def segments(name, parts, total):
        first = record("response", name, parts[0], WARC_Segment_Number=1)
        more = [record("continuation", f"{name}-{i}", p, WARC_Segment_Number=i, WARC_Segment_Origin_ID=f"<{name}>", **({"WARC_Segment_Total_Length": total} if i == 3 else {}))
                for i, p in enumerate(parts[1:], 2)]
        return [first, *more]

    good, bad_total, gap = segments("good", cut, len(whole)), segments("total", cut, len(whole) + 1), segments("gap", cut, len(whole))
    mark = plain + b"x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 1\r\n\r\ny"
    data = b"".join([
        record("warcinfo", "info", b"software: x\r\n"), good[2], bad_total[0], good[0], record("response", "mark", mark), gap[0], gap[2],
        good[1], bad_total[2], bad_total[1], record("response", "broken", http + b"zz\r\nabc\r\n0\r\n\r\n"), record("response", "last", plain + b"end"),
    ])
    path = shared_path(spark, "test-warc")
    spark.createDataFrame([(data.decode("latin-1"),)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    got = {r["record_id"].strip("<>"): (r["complete"], bytes(r["payload"]) if r["payload"] is not None else None) for r in warc.read(spark, path, payload=True).collect()}
    assert got["good"] == (True, b"abcdef")
    assert got["mark"] == (True, mark[len(plain):])
    assert got["last"] == (True, b"end")
    assert not got["total"][0] and not got["gap"][0] and not got["broken"][0]
    assert set(got) == {"good", "mark", "last", "total", "gap", "broken"}


def test_warc_pieces_of_damaged_archives():
    """A short record takes nothing away from those behind it, whatever length it claims."""
    good = lambda n: record("response", n, b"HTTP/1.1 200 OK\r\n\r\n" + n.encode())
    for claim in (b"70", b"9" * 30, b"5", b"x"):
        short = good("short").replace(b"Content-Length: 24", b"Content-Length: " + claim)
        data = good("a") + short + good("b") + good("c")
        found = list(warc._joined(p for p in data.split(b"WARC/1.") if p))
        assert [f[b"warc-record-id"] for f, _, ok in found if ok] == ["<a>", "<b>", "<c>"], claim
        assert [f[b"warc-record-id"] for f, _, ok in found if not ok] == ["<short>"]


def test_warc_record_borders_at_every_buffer_offset(spark):
    """Many records of all lengths: the text reader's 64 KB borders fall at every place of a
    record's end."""
    rows = [(i, f"u{i}", "x" * (i % 211) + ("\r\n\r\n" * (i % 3))) for i in range(9000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    path = shared_path(spark, "test-warc")
    warc.write(df, path)
    got = warc.read(spark, path).where("complete").select(F.col("page_id").cast("long"), "payload_bytes")
    assert sorted(map(tuple, got.collect())) == [(i, len(h)) for i, _, h in rows]


# ------------------------------------------------------------------ hard negatives

VEC = "vec_id long, embedding array<float>, label int, anchor int, score double, r string"


def brute_negatives(rows, anchors, scale=256.0, n_pos=5, n_neg=10):
    part = [(i, lab, [int(np.floor(float(np.float32(x)) * scale)) for x in v]) for i, v, lab in rows
            if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, lab, v in sorted({(i, lab, tuple(v)) for i, lab, v in part if i in anchors}):
        score = [(-dot(v, w), j, l) for j, l, w in part if j != i]
        for s, p, _ in sorted(x for x in score if x[2] == lab)[:n_pos]:
            fit = sorted((t, j) for t, j, l in score if l != lab and 30 * -s <= 100 * -t <= 90 * -s)
            out += [(i, p, n, j, -s, -t) for n, (t, j) in enumerate(fit[:n_neg], 1)]
    return sorted(out)


def vectors(seed, n, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    rows = [(int(i), [float(x) for x in np.float32(centres[i % 5] + 0.2 * rng.normal(size=dim))], int(rng.integers(0, 4))) for i in range(n)]
    rows += rows[10:14]  # rows that repeat as they are
    rows += [(i + n, rows[20][1], int(i % 3)) for i in range(12)]  # one vector under many ids: ties
    rows += [(None, rows[0][1], 1), (n + 50, None, 1), (n + 51, [1.0, None] + [0.0] * (dim - 2), 1), (n + 52, [float("nan")] * dim, 1),
             (n + 53, [float("inf")] * dim, 2), (n + 54, rows[0][1], None), (n + 55, [], 1), (n + 56, rows[3][1][:3], 2)]
    return rows


@pytest.mark.parametrize("blocks", [(512, 16384), (4, 40)])
def test_negatives_equal_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", blocks[0])
    monkeypatch.setattr(negatives, "CANDIDATE_BLOCK", blocks[1])
    rows = vectors(3, 200)
    df = spark.createDataFrame([(*r, 7, 0.5, "r") for r in rows], VEC)
    got = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(rows, {r[0] for r in rows if r[0] is not None and r[0] % 10 == 0})
    assert want and sorted(tuple(r) for r in got.collect()) == want
    assert negatives.hard_negatives(df.where("false"), F.col("vec_id") % 10 == 0).collect() == []
    labelled = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, label=F.concat(F.lit("l"), F.col("label").cast("string")))
    assert sorted(tuple(r) for r in labelled.collect()) == want


def test_negatives_tree_bounds_spare_scores(monkeypatch):
    """Bounds are true (same picks as full scoring) and spare most scores where anchors are close."""
    monkeypatch.setattr(negatives, "_SLICE", 256)
    rng = np.random.default_rng(5)
    base = rng.integers(-200, 200, size=16)
    anchors = base + rng.integers(-3, 4, size=(30, 16))
    cands = rng.integers(-200, 200, size=(4000, 16))
    ids = rng.permutation(4000)
    windows = [[negatives._Best(20000, 60000, 10), negatives._Best(-5000, -1000, 3)] for _ in anchors]
    scored = negatives.search(anchors, windows, cands, ids, lambda j: ids % 3 != j % 3)
    for j, a in enumerate(anchors):
        s = cands @ a
        for w in windows[j]:
            ok = (ids % 3 != j % 3) & (s >= w.lo) & (s <= w.hi)
            want = sorted(zip(-s[ok], ids[ok]))[: w.k]
            assert [(-x, y) for x, y in want] == list(zip(w.score, w.id))
    assert scored < 0.5 * len(anchors) * len(cands)


# ------------------------------------------------------------------ conversation repair


def faults_of(rows):
    """Per row of a conversation in order: its fault."""
    seen, out = set(), []
    for role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("sound" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Every list of edits with at most two inserts at a place, cheapest and then least."""
    faults, best = faults_of(rows), None
    inserts = ["", "u", "a", "ua", "au"]
    actions = []
    for (role, text), f in zip(rows, faults):
        stay = [] if f in ("blank", "duplicate") else [("K", role[:1] or "x", (f == "truncated"), (role, text))] + [
            ("R", x[0], 2 + (f == "truncated"), (x, text)) for x in ("user", "assistant")]
        actions.append([("D", "", 3, None)] + stay)
    for ins in itertools.product(inserts, repeat=len(rows) + 1):
        for acts in itertools.product(*actions):
            letters = "".join(i + a[1] for i, a in zip(ins, acts)) + ins[-1]
            if not re.fullmatch("(s?(ua)+)?", letters):
                continue
            cost = 2 * sum(map(len, ins)) + sum(a[2] for a in acts)
            audit = "".join("I" * len(i) + a[0] for i, a in zip(ins, acts)) + "I" * len(ins[-1])
            if best is None or (cost, audit) < best[:2]:
                made = [[("user" if x == "u" else "assistant", "") for x in i] + ([a[3]] if a[3] else []) for i, a in zip(ins, acts)]
                best = (cost, audit, sum(made, []) + [("user" if x == "u" else "assistant", "") for x in ins[-1]])
    return best


def quick_repair(rows):
    """Least (cost, audit) by recursion over rows and grammar states; for long conversations."""
    faults = faults_of(rows)
    step = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    after = {q: (0, "", "") if q in "0a" else None for q in "0sua"}

    def inserted(found):
        for _ in range(4):
            for (q, x), to in step.items():
                if x != "s" and found[to] is not None:
                    new = (found[to][0] + 2, "I" + found[to][1], x.upper() + found[to][2])
                    if found[q] is None or new < found[q]:
                        found[q] = new
        return found

    after = inserted(after)
    for (role, _), f in zip(reversed(rows), reversed(faults)):
        now = {}
        for q in "0sua":
            ways = [(after[q][0] + 3, "D" + after[q][1], "-" + after[q][2])] if after[q] else []
            if f not in ("blank", "duplicate"):
                more = f == "truncated"
                for x, sign, cost in ((role[:1], "K", 0), ("u", "R", 2), ("a", "R", 2)):
                    to = step.get((q, x))
                    if to and after[to]:
                        ways.append((after[to][0] + cost + more, sign + after[to][1], ("k" if sign == "K" else x) + after[to][2]))
            now[q] = min(ways) if ways else None
        after = inserted(now)
    cost, audit, script = after["0"]
    out, left = [], iter(rows)
    for x in script:
        if x in "UA":
            out.append(("user" if x == "U" else "assistant", ""))
        else:
            role, text = next(left)
            if x != "-":
                out.append((role if x == "k" else {"u": "user", "a": "assistant"}[x], text))
    return cost, audit, out


def expected(rows):
    """conv -> (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) by turn, role, digest."""
    by_conv = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        by_conv.setdefault(conv, []).append((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest(), text))
    out = {}
    for conv, items in by_conv.items():
        items.sort()
        pairs = [(x[2], x[4]) for x in items]
        turns = {x[1] for x in items if x[0]}
        f = faults_of(pairs)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        cost, audit, made = plain_repair(pairs) if len(pairs) <= 3 else quick_repair(pairs)
        if len(pairs) <= 4:
            assert quick_repair(pairs) == (cost, audit, made)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, f.count("blank"), f.count("duplicate"), f.count("truncated"), illegal, cost, audit, sha)
    return out


def repaired(df):
    report, messages = repair.repair(df)
    found = report.alias("r").join(repair.digests(messages).withColumnRenamed("conv", "c2"), F.col("r.conv").eqNullSafe(F.col("c2")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return {r["conv"]: (*[r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")], r["repaired_sha256"] or nothing) for r in found.collect()}


CONV = "conv_id long, turn long, role string, text string, place long, letter string, chunk int"


def test_repair_equals_exhaustive_search(spark):
    rnd, rows = random.Random(11), []
    texts = ["ok.", "ok.", "cut off", "", " \t\n", "why? ", "é日本", None, "x!\x0b", "a.\x1c"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "agent"]
    for conv in range(150):
        for _ in range(rnd.randint(1, 4)):
            rows.append((conv, rnd.choice([None, 0, 1, 2, 3, 5]), rnd.choice(roles), rnd.choice(texts)))
    rows += [(None, 1, "user", "hi."), (None, 2, "assistant", "yes."), (1000, None, "user", "same."), (1000, None, "user", "same.")]
    df = spark.createDataFrame([(*r, 1, "l", 2) for r in rows], CONV)
    assert repaired(df) == expected(rows)
    assert repaired(df.where("false")) == {}


def test_repair_of_long_conversations_in_chunks(spark):
    """A third of all rows in one conversation, over several chunks, with many repeats."""
    rnd, rows = random.Random(4), []
    for turn in range(3000):
        rows.append((1, turn, rnd.choice(["user", "assistant", "assistant", "system", "tool"]), rnd.choice([f"t{turn}.", f"cut {turn}", "same.", ""])))
    rows += [(2, None, "user", "copy.")] * 2000
    rows += [(c, t, ["user", "assistant"][t % 2], f"{c} {t}.") for c in range(3, 1000) for t in range(4)]
    df = spark.createDataFrame([(*r, 1, "l", 2) for r in rows], CONV).repartition(6)
    want = expected([r for r in rows if r[0] < 40])
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")  # else Spark joins these few rows into one chunk
    try:
        assert repair.chunks(df).where("conv = 1").count() > 1
        got = repaired(df)
    finally:
        spark.conf.set(merge, "true")
    assert len(got) == 999 and {c: got[c] for c in want} == want


def test_damage_by_rule(spark):
    rows = [(c, t if t < 9 else None, r, x) for c in range(60) for t, (r, x) in enumerate([("system", "a.b!c? d"), ("assistant", None)] * 5)]
    got = repair.damaged(spark.createDataFrame([(*r, 1, "l", 2) for r in rows], CONV))
    want = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        x = " " if x is None else x
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        want += [(c, t, "user" if kind == 4 else r, x)] * {0: 0, 3: 2}.get(kind, 1)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_clashing_columns_pass_through(spark):
    """Columns called like the operators' own keep their values; new ones get another name."""
    from skein.llm import langid, licenses, line_dedup

    names = ["doc_id", "text", "lang", "source", "_id", "_bad", "_kept", "lines_removed", "_w", "_h", "dice", "license", "_lang_pred", "row", "bad", "kept", "same"]
    rows = [(i, f"shared line\nown {i}", "en", f"s{i}", *[f"{c}{i}" for c in names[4:]]) for i in range(4)]
    docs = spark.createDataFrame(rows, ", ".join(f"{c} {'long' if c == 'doc_id' else 'string'}" for c in names))
    clean = line_dedup.remove_boilerplate(docs, min_sites=3)
    assert clean.columns == [*names, "lines_removed_"]
    for r in clean.collect():
        i = r["doc_id"]
        assert tuple(r)[2:-1] == rows[i][2:] and r["lines_removed_"] == (i > 0)
        assert r["text"] == (f"shared line\nown {i}" if i == 0 else f"own {i}")
    found = licenses.scan(docs)
    assert found.columns == [*names, "license_", "dice_", "license_pieces"]
    assert sorted(tuple(r)[:len(names)] for r in found.collect()) == rows
    told = langid.label_rows(docs, langid.train(docs))
    assert told.columns == [*names, "_lang_pred_", "_lang_score"]
    assert sorted(tuple(r)[:len(names)] for r in told.collect()) == rows


def test_line_dedup_without_ids(spark):
    """Documents without an id, or with one id, are cleaned of their own lines, each in a group of its own."""
    from skein.llm import line_dedup

    rows = [(None, f"shared\nown {i}", f"s{i}") for i in range(6)] + [(5, f"shared\nother {i}", f"s{i}") for i in range(6)] + [(1, "shared", "x")]
    got = line_dedup.remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_sites=3)
    want = [(None, f"own {i}", 1) for i in range(6)] + [(5, f"other {i}", 1) for i in range(6)] + [(1, "shared", 0)]
    assert sorted(((r["doc_id"], r["text"], r["lines_removed"]) for r in got.collect()), key=str) == sorted(want, key=str)
