"""Every operator against a brute-force version, an exact round trip or held-out accuracy,
and on the defined edge cases: NULLs in any column, empty and long texts, ties, repeated
rows, empty tables and extra columns with clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skein.llm import chat, components, langid, licenses, line_dedup, mixing, mph, sentencepieces, simhash, syncmers, token_files, topk

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, word string, rank int, mix_size int"
LONG = " ".join(f"w{i % 977}" for i in range(30000))
EDGE = [
    (1, "the cat sat on the mat today", "en", "a"),
    (2, "the cat sat on the mat today", "en", "b"),
    (3, "THE cat sat on\tthe mat\n today", "en", None),
    (4, None, None, None),
    (5, "", "en", "a"),
    (6, "  \n\t ", None, "b"),
    (7, LONG, "en", "a"),
    (8, LONG + " end", "en", "b"),
    (9, "x", None, "c"),
    (9, "x", None, "c"),
    (None, "no id here \\ <|endoftext|> don't", "en", "c"),
    (12, "émile ñandú 日本語 Ünï ﬁ ̈     ok \x1c \x85 z", "es", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, len(r[1] or ""), "fp", "word", 1, 2) for r in EDGE]
    return spark.createDataFrame(rows, DOCS).cache()


def empty(docs):
    return docs.where("false")


def tokens(text):
    out, word = [], b""
    for b in (text or "").encode():
        if b in b" \t\n\x0b\x0c\r":
            out, word = out + [word] if word else out, b""
        else:
            word += bytes([b + 32]) if 65 <= b <= 90 else bytes([b])
    return out + [word] if word else out


def brute_simhash(text, k=3):
    w = tokens(text)
    grams = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, radius=2):
    low = list(ids)
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            for j in range(len(ids)):
                if bin(fps[i] ^ fps[j]).count("1") <= radius:
                    best = min((x for x in (low[i], low[j]) if x is not None), default=None)
                    if low[i] != best or low[j] != best:
                        low[i] = low[j] = best
                        changed = True
    return low


# --- 4 SimHash

def test_simhash_matches_brute_force():
    for text in [r[1] for r in EDGE] + ["a b", "a b c", "A B C", "a a a a a"]:
        assert simhash.simhash(text) == brute_simhash(text if text is None or len(text) < 5000 else text)


def test_covering_masks_meet_every_pair_within_radius():
    masks = [m & (2**64 - 1) for m in simhash.covering_masks(2)]
    assert len(masks) == 7
    for i in range(64):
        for j in range(i + 1):
            assert any(not (m >> i & 1) and not (m >> j & 1) for m in masks)


@pytest.mark.parametrize("small_bucket", [64, 2])
def test_links_and_components(spark, small_bucket):
    rnd = random.Random(5)
    fps = set()
    for _ in range(6):
        x = rnd.getrandbits(64)
        for _ in range(25):  # chains of near fingerprints and strangers
            fps.add(x)
            for _ in range(rnd.choice([1, 2, 2, 3])):
                x ^= 1 << rnd.randrange(64)
    fps = sorted(fps)
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), small_bucket=small_bucket)
    got = {r["node"]: r["root"] for r in components.connected_components(edges).collect()}
    want = brute_components(signed, fps)
    assert [got.get(f, f) for f in signed] == want


def test_near_duplicates_edge_rows(docs):
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=str)
    ids, fps = [r[0] for r in EDGE], [simhash.simhash(r[1]) for r in EDGE]
    assert got == sorted(zip(ids, brute_components(ids, fps)), key=str)
    assert dict(got)[6] == 4 and dict(got)[3] == 1
    assert simhash.near_duplicates(empty(docs)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (201, 200)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}


# --- 1 SentencePiece

@pytest.fixture(scope="module")
def model():
    P = pytest.importorskip("public_tokenizers")
    return sentencepieces.load(P.path("piece_bpe_32k.model"))


TEXTS = ["", "  a  b   c    d     e\n\n\t x", "▁▁x ▁", "<0x0A> <s> 日本語テキスト 𝔘𝔫𝔦 \x00 ́", "a" * 300, "llllll rrrrr", "http://foo.bar/baz?x=1&y=22222", "  ", " "] + [r[1] for r in EDGE if r[1] and len(r[1]) < 1000]


def unigram_of(model):
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto()
    spec.ParseFromString(model)
    spec.trainer_spec.model_type = 1
    for p in spec.pieces:
        p.score = max(p.score, -40000.0)
    return spec.SerializeToString()


@pytest.mark.parametrize("unigram", [False, True])
def test_pieces_match_the_library(model, unigram):
    import sentencepiece

    raw = unigram_of(model) if unigram else model
    sp, own = sentencepiece.SentencePieceProcessor(model_proto=raw), sentencepieces.Pieces(raw)
    rnd = random.Random(1)
    texts = TEXTS + ["".join(rnd.choice("abcdelnrst .,'éñ0\n") for _ in range(rnd.randrange(60))) for _ in range(400)]
    for t in texts:
        words = own.words(own.normalize(t)) if t else []
        ids = dict(zip(sorted(set(words)), own.encode(sorted(set(words)))))
        got = np.frombuffer(b"".join(ids[w] for w in words), dtype="<i4").tolist()
        if unigram:  # paths of equal score may differ: compare scores
            cost = lambda x: sum(sp.get_score(i) if not sp.is_byte(i) else 0 for i in x)
            assert cost(got) == pytest.approx(cost(sp.encode(t)), rel=1e-6) and sp.decode(got) == sp.decode(sp.encode(t))
        else:
            assert got == sp.encode(t)
        assert own.decode(got) == sp.decode(got)


def test_sentencepiece_round_trip(docs, model):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    out = sentencepieces.decode(sentencepieces.encode(docs, model), model).collect()
    want = Counter((r[0], None if r[1] is None else tuple(sp.encode(r[1])), r[1]) for r in EDGE)
    assert Counter((r["doc_id"], None if r["ids"] is None else tuple(r["ids"]), r["text"]) for r in out) == want
    assert all(r["n_tokens"] == len(r["ids"] or []) for r in out)
    one_pass = sentencepieces.round_trip(docs, model).collect()
    assert sorted(map(repr, one_pass)) == sorted(map(repr, out))
    assert sentencepieces.encode(empty(docs), model).count() == 0


# --- 2 token files

def test_mph_is_minimal_and_perfect():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 2, 5000):
        keys = np.unique(rnd.integers(-(2**63), 2**63 - 1, n, dtype=np.int64))
        assert sorted(mph.slots(mph.build(keys), keys).tolist()) == list(range(len(keys)))
    with pytest.raises(ValueError):
        mph.build(np.array([7, 7]))


def test_token_files(docs, spark, tmp_path):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    path = str(tmp_path / "t")
    token_files.write(docs, path, P.path("word_bpe_49k.json"), block_ids=50)
    got = sorted([tuple(r) for r in token_files.read(spark, path).collect()], key=lambda r: r[1])
    place, want = 0, []
    ranked = sorted(EDGE, key=lambda r: (r[0] is not None, r[0] or 0))
    for key, text, *_ in ranked:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((key, place, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        place += len(ids)
    assert got == want
    found = {r["doc_id"]: (r["index_start"], r["index_tokens"]) for r in token_files.starts(spark, path, token_files.lookup(docs, path)).collect()}
    first = {}
    for key, start, n, _ in want:
        if key is not None:
            first[key] = (first[key][0], first[key][1] + n) if key in first else (start, n)
    assert found == first
    strangers = spark.createDataFrame([(k,) for k in (1000, -5, None)], "doc_id long")
    assert token_files.lookup(strangers, path).count() == 0
    none = str(tmp_path / "none")
    token_files.write(empty(docs), none, P.path("word_bpe_49k.json"))
    assert token_files.read(spark, none).count() == 0 and token_files.lookup(docs, none).count() == 0
    assert token_files.fetch(docs, none).count() == 0


def test_token_files_fetch_by_key(docs, spark, tmp_path):
    """Keyed access returns every stored document of a key, also where one key's documents
    fill several blocks and parts, and nothing for strangers."""
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = [(77 if i % 3 == 0 else i, f"text {i} " * (i % 9)) for i in range(200)] + [(77, None), (77, "")] + [(None, f"none {i}") for i in range(9)]
    many = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string")).repartition(5)
    path = str(tmp_path / "many")
    token_files.write(many, path, P.path("word_bpe_49k.json"), block_ids=40)
    scanned = [tuple(r) for r in token_files.read(spark, path).collect()]
    order = lambda r: r[1]  # noqa: E731 - starts are distinct
    got = token_files.fetch(many, path).collect()
    assert sorted((tuple(r)[:4] for r in got), key=order) == sorted((r for r in scanned if r[0] is not None), key=order)
    assert sorted(map(tuple, token_files.read(spark, path, without_id=True).collect()), key=order) == sorted((r for r in scanned if r[0] is None), key=order)
    assert spark.read.parquet(f"{path}/blocks").where("goes_on AND first_id = 77").count() > 3
    texts: dict = {}
    for key, text in [(r[0], r[1]) for r in EDGE] + rows:
        texts.setdefault(key, []).append(tok.encode(text or "", add_special_tokens=False).ids + [1])
    for key in (77, 9, 12, 8, 4):
        assert sorted(r["ids"] for r in got if r["doc_id"] == key) == sorted(texts[key])
    asked = spark.createDataFrame([(12,), (12,), (9,), (1000,), (-5,), (None,)], "k long")
    assert sorted(r["doc_id"] for r in token_files.fetch(asked, path, id_col="k", ids=False).collect()) == [9, 9, 12]


def test_token_words_match_the_library():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    raw = open(P.path("word_bpe_49k.json"), "rb").read()
    tok, own = Tokenizer.from_str(raw.decode()), token_files._Words(raw, "<u2")
    rnd = random.Random(3)
    odd = ["don't", "DON'T.", "we'll...", "3.14", "v2.", "É.", "e\u0301.", "e\u0301", "İstanbul", "ΣΑΣ", "\u212a", "ﬁn", "한국어", "\u1112\u1161\u11ab", "<|endoftext|>", "<|ENDOFTEXT|>", "x<|startoftext|>Y.", "...", "a.b", "x\u0130.", "\x1c", "A\u00a0B", "\x85", "$$$", "'s", "ſ", "aá."]
    words = odd + ["".join(rnd.choice("abcXYZé0.,;:'!-<|ñ") for _ in range(rnd.randrange(1, 12))) for _ in range(4000)]
    listed = sorted({w.encode() for w in words})
    got = [np.frombuffer(x, dtype="<u2").tolist() for x in own.encode(listed)]
    assert got == [e.ids for e in tok.encode_batch([w.decode() for w in listed], add_special_tokens=False)]


# --- 3 licences

def brute_license(text, threshold=0.8):
    import re

    pieces = text.split("\n") + [b for b in re.split("\n[ \t\r]*\n", text) if "\n" in b] + ([text] if "\n" in text else [])
    hits, n = [], 0
    for p in pieces:
        a = set(licenses.bigrams(p))
        scored = [(2 * len(a & set(t)) / (len(a) + len(t)), name) for name, t in licenses._prepared(licenses.TEMPLATES)] if a else []
        good = [s for s in scored if s[0] >= threshold]
        hits, n = hits + good, n + bool(good)
    best = max((s for s, _ in hits), default=None)
    return (min(name for s, name in hits if s == best) if hits else None, best, n)


def test_license_scan(spark, docs):
    mit = licenses.TEMPLATES["MIT"][2]
    texts = [None, "", "one", "prose here\nReleased under the MIT License.\nmore prose", mit, mit.replace("Software", "Program"), "a\n\n" + mit.replace(". ", ".\n") + "\n\nb", "Licensed under CC BY-NC 4.0.", "licensed UNDER cc by 4.0 !", " ".join(mit.split()[:30]), (mit + "\n") * 3, LONG]
    got = licenses.scan(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, name string")).collect()
    for r in got:
        want = brute_license(texts[r["doc_id"]]) if texts[r["doc_id"]] else (None, None, 0)
        assert (r["license"], r["license_pieces"]) == (want[0], want[2]) and r["dice"] == (pytest.approx(want[1]) if want[1] else None)
    assert [r["license"] for r in sorted(got, key=lambda r: r["doc_id"])][3:8] == ["MIT", "MIT", "MIT", "MIT", "CC-BY-NC-4.0"]
    assert licenses.scan(empty(docs)).count() == 0
    assert licenses.scan(docs, templates={}).where("license IS NOT NULL").count() == 0


def test_licenses_inside_lines_and_over_paragraphs(spark):
    rnd = random.Random(3)
    prose = lambda n: " ".join(rnd.choice("river under the stone by a lamp of this house and copies without notice".split()) for _ in range(n))
    apache, mit, bsd = licenses.TEMPLATES["Apache-2.0"][1], licenses.FULL_TEXTS["MIT"][0], licenses.FULL_TEXTS["BSD-2-Clause"][0]
    apart = lambda t: re.sub(r" (?=http|Unless|[123]\. |THE SOFTWARE IS|THIS SOFTWARE IS|The above)", "\n\n", t)
    around = lambda t: prose(900) + "\n\n" + t + "\n\n" + prose(900)
    cases = {
        "Apache-2.0": [around(apart(apache)), apart(apache), prose(40) + " " + apache + " " + prose(40)],
        "MIT": [mit, around(apart(mit)), prose(5) + " Released under the MIT License. Copyright 2020 " + prose(30)],
        "BSD-2-Clause": [bsd, around(apart(bsd)), around(bsd)],
        "BSD-3-Clause": [around(apart(licenses.FULL_TEXTS["BSD-3-Clause"][0]))],
        "ISC": [around(apart(licenses.FULL_TEXTS["ISC"][0]))],
        "GPL-3.0": [prose(9) + " " + licenses.TEMPLATES["GPL-3.0"][1] + " " + prose(20)],
        "CC-BY-SA-4.0": [prose(20) + " " + licenses.TEMPLATES["CC-BY-SA-4.0"][0] + " " + prose(20)],
        None: [prose(3000), around(" ".join(mit.split()[:25])), "MIT license " * 500],
    }
    rows = [(i, t, name) for i, (name, t) in enumerate((name, t) for name, ts in cases.items() for t in ts)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id int, text string, want string")).collect()
    assert [(r["doc_id"], r["license"]) for r in got if r["license"] != r["want"]] == []
    assert all(r["dice"] >= 0.8 for r in got if r["want"])


# --- 5 language ID

VOCAB = {"aa": "the and of with from that which would there".split(), "bb": "der und nicht sich einem werden zwischen über".split(), "cc": "это который было только через между".split()}


def speech(lang, n, rnd):
    return " ".join(rnd.choice(VOCAB[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def lid(spark):
    rnd = random.Random(2)
    rows = [(i, speech(lang, rnd.randrange(5, 60), rnd), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 120)]
    rows += [(1000, None, "aa"), (1001, "the", None), (1002, "", "bb")]
    return langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_language_id_labels_spans(spark, lid, docs):
    rnd = random.Random(9)
    mixed = speech("aa", 40, rnd) + " 12 -- " + speech("bb", 30, rnd) + ". " + speech("cc", 5, rnd)
    rows = [(i, speech(lang, 20, rnd)) for i, lang in enumerate(["aa", "bb", "cc"] * 5)] + [(90, mixed), (91, None), (92, ""), (93, "123 ... !?"), (94, "日本語"), (None, "the and")]
    got = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string"), lid).collect()}
    assert [got[i]["lang_pred"] for i in range(15)] == ["aa", "bb", "cc"] * 5
    assert [s["lang"] for s in got[90]["spans"]] == ["aa", "bb", "cc"] and [s["first_word"] for s in got[90]["spans"]] == [0, 42, 72]
    assert sum(s["words"] for s in got[90]["spans"]) == len(mixed.split()) and 0 < got[90]["score"] < 1
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0) for i in (91, 92, 93))
    assert got[94]["lang_pred"] in lid.languages and got[94]["score"] == 0.0
    assert got[None]["lang_pred"] == "aa"
    assert langid.identify(docs, lid).count() == len(EDGE) and langid.identify(empty(docs), lid).count() == 0
    unlearnt = langid.identify(docs, langid.train(empty(docs))).select("lang_pred").distinct().collect()
    assert [r[0] for r in unlearnt] == ["und"]


def test_language_of_few_texts_copied_often_is_learnt(spark):
    # one text copied 20,000 times: by row counts a share of 1/5 is drawn, and the hash of
    # this text lies above; of 50 texts copied 400 times some would be missed
    rnd = random.Random(5)
    once = next(t for t in (speech("cc", 30, rnd) for _ in range(99)) if xxhash.xxh64_intdigest(t.encode(), 42) % 2**31 > 2**30)
    rows = [(speech(lang, 30, rnd), lang, 1) for lang in ("aa", "bb") for _ in range(100)]
    rows += [(once, "cc", 20000)] + [(speech("bb", 30, rnd), "dd", 400) for _ in range(50)]
    copied = spark.createDataFrame(rows, "text string, lang string, n int").select("text", "lang", F.explode(F.array_repeat(F.lit(1), F.col("n")))).drop("col")
    model = langid.train(copied)
    assert model.languages == ["aa", "bb", "cc", "dd"] and model.allowed.any(axis=0).all()
    single = langid.train(spark.createDataFrame(rows, "text string, lang string, n int"))
    assert np.array_equal(model.weights, single.weights)  # copies count once
    got = langid.identify(spark.createDataFrame([(1, once), (2, speech("cc", 9, rnd))], "doc_id long, text string"), model).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("cc", 1.0)] * 2


def test_word_labels_are_the_best_path():
    rnd = np.random.default_rng(4)
    for _ in range(60):
        lens = rnd.integers(1, 9, 5)
        s = rnd.normal(size=(lens.sum(), 3)) * rnd.choice([0.5, 3])
        ends = np.r_[0, np.cumsum(lens)]
        got = langid.label_words(s, ends, 1.5)
        for lo, hi in zip(ends, ends[1:]):
            value = lambda p: sum(s[lo + i, x] for i, x in enumerate(p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:]))
            best = {(g,): value((g,)) for g in range(3)}
            for _ in range(hi - lo - 1):
                best = {p + (g,): 0 for p in best for g in range(3)}
            assert value(tuple(got[lo:hi])) == pytest.approx(max(map(value, best)))


# --- 6 mixing

def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    capped, total = set(), 1.5 * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(2 * sizes[s] for s in capped)
        t = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = {s for s in rest if t[s] > 2 * sizes[s]}
        if not over:
            return {**{s: 2.0 * sizes[s] for s in capped}, **t}
        capped |= over


def assert_full(out):
    """No source is above its target, and no copy that was left out fits into what is missing."""
    taken = Counter()
    for r in out:
        taken[r["source"]] += r["mix_size"] * r["mix_copies"]
    for r in out:
        missing = r["mix_target"] - taken[r["source"]]
        assert missing >= -1e-6
        assert r["mix_size"] == 0 or r["mix_copies"] == 2 or r["mix_size"] > missing + 1e-6, (r["source"], missing, r["mix_size"])


def test_mixing_takes_part_of_a_group_of_equal_rows(spark):
    """1,500 equal rows in one source, and sources of a few rows with many repeats."""
    rows = [(7, "one two three", "same", 1)] * 1500 + [(i, "w " * (1 + i % 90), "other", 2) for i in range(400)]
    rows += [(i % 3, "x " * (2 + i % 3), None, 3) for i in range(200)] + [(None, None, "void", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_cell int").withColumns({"mix_source": F.lit("s"), "mix_cuts": F.lit(1), "row": F.lit(2)})
    out = mixing.copies(df, mixing.balance(df))
    assert out.columns[:7] == df.columns and out.count() == len(rows)
    got = out.collect()
    assert_full(got)
    same = {r["mix_target"] - sum(x["mix_size"] * x["mix_copies"] for x in got if x["source"] == "same") for r in got if r["source"] == "same"}
    assert len(same) == 1 and 0 <= same.pop() < 3
    again = mixing.copies(df.repartition(3), mixing.balance(df.repartition(3))).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    clash = mixing.copies(df.withColumn("mix_size", F.lit("mine")), mixing.balance(df))
    assert clash.where("mix_size = 'mine' AND mix_size_ IS NOT NULL").count() == len(rows)


def test_mixing_raises_without_convergence(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_ROUNDS", 1)
    df = spark.createDataFrame([(i, "w " * (1 + i % 40), "ab"[i % 2]) for i in range(50)], "doc_id long, text string, source string")
    with pytest.raises(RuntimeError, match="converge"):
        mixing.balance(df)


def test_mixing_meets_targets(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(["w"] * rnd.choice([1, 5, 40, 300])), rnd.choice(["b", "a", "é", "Z", None, "hot", "hot", "hot"])) for i in range(3000)]
    rows += [(9001, "a a", "tiny"), (9002, None, "void"), (9003, "", "a"), (9003, "", "a"), (None, "x y", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("target", F.lit("clash"))
    out = mixing.copies(df, mixing.balance(df)).collect()
    again = mixing.copies(df, mixing.balance(df.repartition(5))).collect()
    key = lambda r: (str(r["doc_id"]), r["mix_copies"], r["mix_target"])
    assert sorted(map(key, out)) == sorted(map(key, again)) and len(out) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in out:
        size = len((r["text"] or "").split())
        assert r["mix_size"] == size and r["mix_copies"] in (0, 1, 2)
        sizes[r["source"]] += size
        taken[r["source"]] += size * r["mix_copies"]
    want = brute_targets(sizes)
    for r in out:
        assert r["mix_target"] == pytest.approx(want[r["source"]]) and r["mix_source_size"] == sizes[r["source"]]
    assert_full(out)
    none = df.where("false")
    assert mixing.copies(none, mixing.balance(none)).count() == 0


# --- 7 top k

def brute_top(vecs, k=5):
    ints = [(i, [int(np.floor(256.0 * x)) for x in v]) for i, v in vecs if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, qv in ints:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(qv, cv)), c) for c, cv in ints if c != q)  # every row counts
            out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("blocks", [(1024, 16384), (2, 30)])
def test_top_k(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", blocks[1])
    rnd = np.random.default_rng(7)
    vecs = [(i, [float(x) for x in rnd.normal(size=8).astype(np.float32)]) for i in range(200)]
    vecs += [(i, [0.5] * 8) for i in range(300, 340)] + [(400, [0.0] * 8), (401, None), (402, [1.0, None]), (403, [float("nan")] * 8), (404, [float("inf")]), (405, []), (406, [1.0]), (None, [1.0] * 8), (450, [1e9] * 8), (320, [0.5] * 8)]
    df = spark.createDataFrame([(i, v, "x") for i, v in vecs], "vec_id long, embedding array<float>, score string")
    exact = [(r["vec_id"], None if r["embedding"] is None else list(r["embedding"])) for r in df.collect()]
    got = {tuple(r) for r in topk.top_k(df.where("vec_id % 50 = 0"), df).collect()}
    assert got == brute_top(exact)
    assert topk.top_k(empty(df), df).count() == 0 and topk.top_k(empty(df), empty(df)).count() == 0


def test_top_k_scores_beyond_a_long(spark):
    df = spark.createDataFrame([(0, [1e30, 1.0]), (1, [1e30, 1.0]), (2, [-1e30])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df.where("vec_id = 0"), df).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63))]


def test_top_k_counts_repeated_rows(spark):
    df = spark.createDataFrame([(0, [1.0])] * 2 + [(3, [0.5])] * 4 + [(4, [0.25])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.top_k(df.where("vec_id = 0"), df).collect())
    assert got == [(0, 1, 3, 32768), (0, 2, 3, 32768), (0, 3, 3, 32768), (0, 4, 3, 32768), (0, 5, 4, 16384)]


# --- 8 syncmers

def test_syncmers_are_closed_and_context_free():
    rnd = random.Random(6)
    text = "".join(rnd.choice("abcdé ") for _ in range(400))
    codes = syncmers._codes(text)
    at, h = syncmers.anchors(codes)
    inner = syncmers._rolled(codes.astype(np.uint64), syncmers.S)
    w = syncmers.K - syncmers.S + 1
    assert at.tolist() == [i for i in range(len(codes) - syncmers.K + 1) if min(inner[i:i + w]) in (inner[i], inner[i + w - 1])]
    at2, h2 = syncmers.anchors(codes[100:300])
    inside = (at >= 100) & (at <= 300 - syncmers.K)
    assert (at[inside] - 100).tolist() == at2.tolist() and h[inside].tolist() == h2.tolist()


def test_edited_fingerprints(docs, spark):
    ranked = sorted(EDGE, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    sketch = lambda t: syncmers._smallest(syncmers.anchors(syncmers._codes(t))[1], syncmers.SKETCH)
    want = []
    for i, (key, text, *_) in enumerate(ranked):
        text, nxt = text or "", ranked[(i + 1) % len(ranked)][1] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + nxt[:q]
        a, b, c = sketch(text), sketch(edited), sketch(nxt)
        want.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), syncmers.to_hex(a), syncmers.to_hex(b), syncmers.likeness(a, b), syncmers.likeness(a, c)))
    got = syncmers.edited_fingerprints(docs.repartition(3)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert syncmers.edited_fingerprints(empty(docs)).count() == 0
    one = syncmers.edited_fingerprints(docs.where("doc_id = 1")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    prints = {r["doc_id"]: r["fingerprint"] for r in syncmers.fingerprints(docs).collect()}
    assert prints[1] == prints[2] and prints[4] == prints[5] == ""


def test_long_texts_keep_all_anchors(spark):
    rnd = random.Random(11)
    prose = lambda n: "".join(rnd.choice("abcdefghij ") for _ in range(n))
    shared = prose(300)
    texts = [prose(30000) + shared + prose(9000), prose(5000) + shared + prose(40000), prose(200)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def whole(t):
        return set((syncmers.anchors(syncmers._codes(t))[1] >> np.uint64(32)).tolist())

    for r in syncmers.edited_fingerprints(frame).collect():
        t, nxt = texts[r["doc_id"]], texts[(r["doc_id"] + 1) % 3]
        q = len(t) // 4
        a, b, c = whole(t), whole(t[: len(t) - q] + nxt[:q]), whole(nxt)
        assert r["fingerprint"] == "".join(f"{x:08x}" for x in sorted(a))
        assert r["near_edited"] == pytest.approx(len(a & b) / len(a | b)) and r["near_next"] == pytest.approx(len(a & c) / len(a | c))
        assert r["near_next"] > 0 or r["doc_id"] != 0
    found = {r["doc_id"]: (np.array(r["positions"]), np.array(r["hashes"])) for r in syncmers.fingerprints(frame).collect()}
    runs = syncmers.passages(*found[0], *found[1])
    x, y, n = max(runs, key=lambda p: p[2])
    assert n > 250 and x - y == 25000 and texts[0][x:x + n] == texts[1][y:y + n]
    assert all(texts[0][x:x + n] == texts[1][y:y + n] for x, y, n in runs)
    assert syncmers.passages(*found[0], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) == []


# --- 9 line dedup

def brute_lines(rows, sites):
    at, keep = defaultdict(set), {}
    for key, text, site in rows:
        for line in (text or "").split("\n"):
            t = line.strip(" ")
            if t:
                at[t] |= {site} - {None}
                if key is not None:
                    keep[t] = min(keep.get(t, key), key)
    out = []
    for key, text, _ in rows:
        if text is None:
            out.append((key, None, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if not x.strip(" ") or len(at[x.strip(" ")]) < sites or keep.get(x.strip(" ")) == key]
        out.append((key, "\n".join(kept), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("sites", [1, 3, 12])
def test_line_dedup(spark, sites):
    rnd = random.Random(8)
    pool = [f"line number {i}" for i in range(60)] + [" line number 3 ", "", "  "]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randrange(6))), rnd.choice([f"s{min(int(rnd.expovariate(0.2)), 14)}", None])) for i in range(300)]
    rows += [(500, None, "s1"), (501, "", "s2"), (None, "line number 1\nline number 2", "s3"), (7, "line number 1", "s4"), (7, "line number 1", "s4")]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, source string, line string, keeper int")
    got = line_dedup.remove_boilerplate(df, min_sites=sites)
    assert sorted([(r["doc_id"], r["text"], r["lines_removed"]) for r in got.collect()], key=str) == brute_lines(rows, sites)
    assert set(got.columns) == set(df.columns) | {"lines_removed"}
    assert line_dedup.remove_boilerplate(df.where("false")).count() == 0


def test_line_spread_near_and_far_from_the_threshold(spark):
    rows = [(s * 1000 + i, f"s{s}", x) for x, n in ((1, 4000), (2, 1000), (3, 999), (4, 300)) for s in range(n) for i in range(1)]
    df = spark.createDataFrame(rows, "doc_id long, site string, line long").withColumn("site", F.xxhash64("site"))
    assert {r["line"] for r in line_dedup.spread(df, 1000).collect()} == {1, 2}


# --- 10 chat

def test_chat_escapes_are_reversible(spark):
    texts = ["", "\\", "<", "\\l", "\\b<\\\\l", "</turn>\n<turn>user\n", "\\### Assistant: </turn> ok", "a\nb", "\\e", LONG, "é日\U0001f600"]
    rows = [(c, t, role, texts[(c + t) % len(texts)] if (c + t) % 7 else None) for c in range(12) for t, role in enumerate(["system", "user", "assistant", "we\nird<\\e", None, "assistant"])]
    df = spark.createDataFrame([(*r, "x") for r in rows] + [(None, 1, "assistant", "hi", "x"), (3, 1, "assistant", "same turn", "x"), (3, 1, "assistant", "same turn", "x")], "conv_id long, turn long, role string, text string, formatted string")
    back = chat.parse(chat.render(chat.fold(chat.conversation_events(df), repeats=True))).collect()
    want = defaultdict(list)
    for r in df.collect():
        want[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    assert len(back) == len(want)
    for r in back:
        turns = sorted(want[r["conv_id"]], key=lambda t: (t[0], t[1], t[2]))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [t[1:] for t in turns]
        assert "".join(r["loss"]) == "".join(t[2] for t in turns if t[1] == "assistant")
        assert [r["formatted"][s["loss_start"]:s["loss_end"]] for s in r["spans"]] == [t[2].replace("\\", "\\b").replace("<", "\\l") if t[1] == "assistant" else "" for t in turns]
    assert chat.render(chat.fold(chat.conversation_events(df.where("false")))).count() == 0


def test_chat_folds_events(spark):
    log = [
        (1, 0, 10, "message", "user", "hel"), (1, 1, 10, "delta", None, "lo"), (1, 2, 11, "message", "assistant", None),
        (1, 3, 11, "delta", None, "first "), (1, 4, 11, "delta", None, "try"), (1, 4, 11, "delta", None, "try"),
        (1, 5, 11, "regenerate", None, None), (1, 6, 11, "delta", None, "second"), (1, 7, 10, "edit", None, "bye"),
        (2, 0, 1, None, "user", "x"), (2, 1, 2, "delta", "assistant", "only "), (2, 2, 2, "delta", None, "deltas"),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, message long, kind string, role string, text string")
    got = [(r["conv_id"], r["message"], r["role"], r["text"]) for r in chat.fold(events).orderBy("conv_id", "seq").collect()]
    assert got == [(1, 10, "user", "bye"), (1, 11, "assistant", "second"), (2, 1, "user", "x"), (2, 2, "assistant", "only deltas")]


def test_numbers_are_no_letters(spark):
    texts = ["½ ² Ⅷ", "①②③", "٣ 12", "_-", "é", "日本"]
    df = spark.createDataFrame([(i, x, None) for i, x in enumerate(texts)] + [(100 + i, "the house and the tree stand here", "en") for i in range(40)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["_lang_pred"] for r in langid.label_rows(df, langid.train(df)).collect()}
    assert [got[i] == "und" for i in range(6)] == [True, True, True, True, False, False]
