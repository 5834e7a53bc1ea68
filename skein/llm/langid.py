"""Language identification: script ranges, per-word scores and a Viterbi pass over words.

``train`` counts hashed character n-grams of the words of labelled texts and gives every
n-gram a log probability per language; it also notes which languages use which script.
``identify`` scores every word under every language, leaves only the languages of the
word's script in the running, and finds the best labelling of the whole word sequence when
each change of language costs ``penalty``. Runs of equal labels are the spans; the
document's language is the one with most letters, its score their share of all letters
(letters in a script that no training text has count for no language).

A document whose words never favour other languages by more than one change costs keeps
its best single language: that is the Viterbi optimum, proved by the largest subsequence
sum, so only mixed documents run the step-by-step recursion, many documents abreast.

Training reads at most about ``per_language`` distinct labelled texts of each language
(chosen by a hash of the text, each text once however often it is copied); a language with
fewer distinct texts is learnt from all of them. Everything else covers all rows and whole
texts. The model is a table of 2^16 n-gram classes by languages, the one thing that is
broadcast.

Defined cases: NULL text or a text without letters is ``und`` with score 0 and no spans; a
text whose letters all are of unknown scripts gets the language most frequent in training
with score 0; without any labelled text everything is ``und``; equal shares go to the
higher total score, then to the language first in code-point order. Repeated rows are
labelled alike; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import free

CLASSES = 1 << 16
ORDERS = (1, 2, 3, 4)
PER_LANGUAGE = 4000
SLICE = 1 << 20  # bytes of text scored together
_NOT_LETTERS = re.compile(r"[\W\d_]+")  # leaves fractions, circled and Roman numbers, which are no letters either
UND = "und"

# First code point of each range and its script; ranges run to the next line.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"),
    (0x0780, "Thaana"), (0x07C0, "Nko"), (0x08A0, "Arabic"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"),
    (0x13A0, "Cherokee"), (0x1400, "Canadian"), (0x1780, "Khmer"), (0x1800, "Mongolian"),
    (0x18B0, "Canadian"), (0x1900, "Other"), (0x1C80, "Cyrillic"), (0x1C90, "Georgian"),
    (0x1CC0, "Other"), (0x1D00, "Latin"), (0x1F00, "Greek"), (0x2000, "Latin"),
    (0x2C60, "Latin"), (0x2C80, "Other"), (0x2D00, "Georgian"), (0x2D30, "Other"),
    (0x2DE0, "Cyrillic"), (0x2E00, "Other"), (0x2E80, "Han"), (0x3040, "Kana"),
    (0x3100, "Bopomofo"), (0x3130, "Hangul"), (0x3190, "Han"), (0x31F0, "Kana"),
    (0x3200, "Other"), (0x3400, "Han"), (0xA000, "Yi"), (0xA4D0, "Other"),
    (0xA640, "Cyrillic"), (0xA6A0, "Other"), (0xA720, "Latin"), (0xA800, "Other"),
    (0xAC00, "Hangul"), (0xD800, "Other"), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB13, "Armenian"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"),
    (0xFE70, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"),
    (0xFFE0, "Other"), (0x20000, "Han"), (0x323B0, "Other"),
)
_NAMES = sorted({name for _, name in SCRIPTS})
_FROM = np.array([lo for lo, _ in SCRIPTS])
_SCRIPT = np.array([_NAMES.index(name) for _, name in SCRIPTS])


@dataclass
class Model:
    languages: list = field(default_factory=list)
    weights: np.ndarray | None = None  # n-gram class x language: log probability, centred
    allowed: np.ndarray | None = None  # script x language
    common: int = 0  # most frequent language in training


def _ngrams(words: list[str]):
    """For each n: (word number, class) of every n-gram of the marked words; then letters
    and script of each word. ``words`` hold letters only."""
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    codes = np.frombuffer("".join(["\x02" + w + "\x03" for w in words]).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    of = np.repeat(np.arange(len(words)), lens + 2)
    grams = []
    for n in ORDERS:
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            h = (h + codes[i:i + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        inside = of[:len(h)] == of[n - 1:]
        grams.append((of[:len(h)][inside], (h[inside] % np.uint64(CLASSES)).astype(np.int64)))
    first = codes[np.cumsum(lens + 2) - lens - 1].astype(np.int64)
    return grams, lens, _SCRIPT[np.searchsorted(_FROM, first, side="right") - 1]


def _distinct(texts: list):
    """(letters-only words, word numbers of all words, first word of each text; -1 for a
    word without letters). Words are separated by white space."""
    number, letters, runs, ends, strip = {}, [], [], [0], _NOT_LETTERS.sub
    seen: dict = {}
    for t in texts:
        words = t.lower().split() if t else []
        for w in words:
            if w not in seen:
                bare = strip("", w)
                if bare and not bare.isalpha():  # letters are what Unicode calls so (category L)
                    bare = "".join(filter(str.isalpha, bare))
                if not bare:
                    seen[w] = -1
                else:
                    seen[w] = number.setdefault(bare, len(number))
                    if len(number) > len(letters):
                        letters.append(bare)
        runs += [seen[w] for w in words]
        ends.append(len(runs))
    return letters, np.array(runs, dtype=np.int64), np.array(ends, dtype=np.int64)


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Fit on rows with a label; rows with a NULL label or text are left out."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    keyed = rows.select("lang", F.xxhash64("text").alias("h")).distinct()
    sizes = {r["lang"]: r["n"] for r in keyed.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model()
    share = F.element_at(F.create_map(*[F.lit(x) for lang in languages for x in (lang, int(min(1.0, per_language / sizes[lang]) * 2**31))]), F.col("lang"))
    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(2**31)) < share).select("text", "lang").distinct()

    def count(batches):
        grams = np.zeros((len(languages), CLASSES), dtype=np.int64)
        scripts = np.zeros((len(languages), len(_NAMES)), dtype=np.int64)
        for b in batches:
            langs = b.column(1).to_pylist()
            for g, lang in enumerate(languages):
                texts = [t.as_py() for t, one in zip(b.column(0), langs) if one == lang]
                words, runs, _ = _distinct(texts)
                if not words:
                    continue
                times = np.bincount(runs[runs >= 0], minlength=len(words))
                found, lens, script = _ngrams(words)
                for of, cls in found:
                    grams[g] += np.bincount(cls, weights=times[of], minlength=CLASSES).astype(np.int64)
                scripts[g] += np.bincount(script, weights=times * lens, minlength=len(_NAMES)).astype(np.int64)
        both = np.concatenate([grams, scripts], axis=1)
        g, cls = np.nonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(cls), pa.array(both[g, cls])], names=["g", "cls", "n"])

    counts = sample.mapInArrow(count, "g long, cls long, n long").groupBy("g", "cls").agg(F.sum("n").alias("n")).toArrow()
    both = np.zeros((len(languages), CLASSES + len(_NAMES)))
    both[counts.column("g").to_numpy(), counts.column("cls").to_numpy()] = counts.column("n").to_numpy()
    grams, scripts = both[:, :CLASSES], both[:, CLASSES:]
    logs = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * CLASSES))
    weights = (logs - logs.mean(axis=0, keepdims=True)).T
    weights[grams.sum(axis=0) < 3] = 0  # a class hardly met says nothing
    return Model(languages, weights.astype(np.float32), (scripts >= 0.01 * np.maximum(scripts.sum(axis=1, keepdims=True), 1)).T, int(scripts.sum(axis=1).argmax()))


def _scores(model: Model, words: list, weight: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word x language scores, letters, whether any language uses the word's script)."""
    found, lens, script = _ngrams(words)
    s = np.zeros((len(words), len(model.languages)))
    for of, cls in found:
        for g in range(s.shape[1]):
            s[:, g] += np.bincount(of, weights=model.weights[cls, g], minlength=len(words))
    s *= weight
    allowed = model.allowed[script]
    known = allowed.any(axis=1)
    s[known[:, None] & ~allowed] = -50.0
    s[~known] = 0
    return s, lens, known


def _viterbi(s: np.ndarray, starts: np.ndarray, ends: np.ndarray, penalty: float) -> np.ndarray:
    """Best labels of the word sequences s[starts[i]:ends[i]], all sequences step by step."""
    order = np.argsort(starts - ends, kind="stable")  # longest first
    starts, lens = starts[order], (ends - starts)[order]
    labels = np.zeros(len(s), dtype=np.int64)
    best = np.zeros(len(s), dtype=np.int64)
    moved = np.zeros(s.shape, dtype=bool)
    score = s[starts].copy()
    alive = [len(lens)] + [0] * int(lens[0])
    for t in range(1, int(lens[0])):
        n = int(np.searchsorted(-lens, -t, side="left"))  # sequences longer than t
        alive[t] = n
        at, prev = starts[:n] + t, score[:n]
        top = prev.argmax(axis=1)
        change = prev[np.arange(n), top][:, None] - penalty
        moved[at], best[at] = prev < change, top
        score[:n] = np.maximum(prev, change) + s[at]
    now = score.argmax(axis=1)
    for t in range(int(lens[0]) - 1, -1, -1):
        n = alive[t]
        at = starts[:n] + t
        labels[at] = now[:n]
        if t:
            now[:n] = np.where(moved[at, now[:n]], best[at], now[:n])
    return labels


def label_words(s: np.ndarray, ends: np.ndarray, penalty: float) -> np.ndarray:
    """Label of every word; sequence i is s[ends[i]:ends[i + 1]], none of them empty."""
    starts, stops = ends[:-1], ends[1:]
    one = np.add.reduceat(s, starts, axis=0).argmax(axis=1)
    labels = np.repeat(one, stops - starts)
    if s.shape[1] == 1:
        return labels
    rest = s.copy()
    rest[np.arange(len(s)), labels] = -np.inf
    gain = rest.max(axis=1) - s[np.arange(len(s)), labels]
    total = np.cumsum(gain)
    apart = np.repeat(np.arange(len(starts)), stops - starts) * (2 * np.abs(total).max() + 1)
    low = np.minimum.accumulate(np.r_[0.0, total[:-1]] - apart)  # each sequence lies below those before it
    mixed = np.maximum.reduceat(total - apart - low, starts) > penalty
    if mixed.any():
        found = _viterbi(s, starts[mixed], stops[mixed], penalty)
        redo = np.repeat(mixed, stops - starts)
        labels[redo] = found[redo]
    return labels


def label_texts(model: Model, texts: list, penalty: float, weight: float) -> list[tuple]:
    """(language, score, spans) of each text; a span is (first word, words, language)."""
    words, runs, ends = _distinct(texts)
    if not model.languages or not words:
        return [(UND, 0.0, [])] * len(texts)
    s, lens, known = _scores(model, words, weight)
    has = runs >= 0
    counts = np.add.reduceat(np.r_[has, False].astype(np.int64), np.minimum(ends[:-1], len(runs))) * (ends[1:] > ends[:-1])
    place = np.flatnonzero(has)
    used = runs[place]
    full = counts > 0
    bounds = np.r_[0, np.cumsum(counts[full])]
    labels = label_words(s[used], bounds, penalty)
    out, d = [], 0
    for i in range(len(texts)):
        if not full[i]:
            out.append((UND, 0.0, []))
            continue
        lo, hi = bounds[d], bounds[d + 1]
        d += 1
        w, lab = used[lo:hi], labels[lo:hi]
        share = np.bincount(lab, weights=lens[w] * known[w], minlength=len(model.languages))
        total = lens[w].sum()
        if share.max() == 0:
            out.append((model.languages[model.common], 0.0, []))
            continue
        tied = np.flatnonzero(share == share.max())
        top = tied[s[w][:, tied].sum(axis=0).argmax()]
        first = np.flatnonzero(np.r_[True, lab[1:] != lab[:-1]])
        where = place[lo:hi][first] - ends[i]
        size = np.diff(np.r_[where, ends[i + 1] - ends[i]])
        out.append((model.languages[top], float(share[top] / total), [{"first_word": int(a), "words": int(n), "lang": model.languages[g]} for a, n, g in zip(where, size, lab[first])]))
    return out


_SPANS = "array<struct<first_word:bigint,words:bigint,lang:string>>"


def _slices(texts):
    """Row ranges of about ``SLICE`` bytes of text."""
    lo, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t.as_buffer()) if t.is_valid else 0
        if n >= SLICE or i == len(texts) - 1:
            yield lo, i + 1
            lo, n = i + 1, 0


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", penalty: float = 8.0, weight: float = 0.25) -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("first_word", pa.int64()), ("words", pa.int64()), ("lang", pa.string())]))

    def run(batches):
        for b in batches:
            for lo, hi in _slices(b.column(1)):
                found = list(zip(*label_texts(shared.value, b.column(1)[lo:hi].to_pylist(), penalty, weight)))
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], pa.array(found[0], pa.string()), pa.array(found[1], pa.float64()), pa.array(found[2], kind)], names=["doc_id", "lang_pred", "score", "spans"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, spans {_SPANS}")


def label_rows(docs: DataFrame, model: Model, text_col: str = "text", penalty: float = 8.0, weight: float = 0.25) -> DataFrame:
    """``docs`` with two columns added to every row, ``_lang_pred`` and ``_lang_score``
    (underscores are appended to names that ``docs`` has)."""
    names = [free(docs.columns, "_lang_pred"), free(docs.columns, "_lang_score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            for lo, hi in _slices(b.column(at)):
                found = label_texts(shared.value, b.column(at)[lo:hi].to_pylist(), penalty, weight)
                new = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([*b.slice(lo, hi - lo).columns, *new], names=[*b.schema.names, *names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]))


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
