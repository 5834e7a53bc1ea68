"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is normalised by the model (spaces become the mark, one mark in front) and cut into
marked words. New distinct words are sorted, which lays them out as a trie in depth-first
order: the forward table of the characters a word shares with the one before it is kept,
and only the rest is computed. Pieces that end at a character come from one step in the
tree of the vocabulary, whose node is kept beside the table. The table holds the last piece
of every prefix:

* unigram models: the start that gives the highest sum of piece scores (ties: the longer
  last piece), as in the library;
* BPE models: the segmentation that the merges leave. It is the one path whose first piece
  is a fixed point of the merges and whose neighbouring pieces are compatible, that is, at
  no earlier step would the merges have joined across their boundary. So every prefix has
  one live last piece and the search is a Viterbi pass whose transitions are 0 or
  impossible. Words with pieces of equal score, where order of merging is by place, are
  merged directly.

Characters outside the vocabulary become byte pieces; a model without byte pieces gives the
unknown id for each (the library gives one for a run of them).

Cutting into words is exact because no piece has a character before a mark; a model that
has one is encoded text by text. Inside a long word the search also starts afresh wherever
no piece has the two neighbouring characters side by side. Known words are kept per task up to fixed bounds
(``wordcache``), texts pass in slices, and no row leaves its partition.

Defined cases: NULL text has NULL ids and decodes to NULL; the empty text has no ids;
decoding gives the normalised text back, the mark character itself becoming a space; rows
are independent, so repeated rows get equal ids; an empty table gives an empty result.
Other columns are ignored; extra ones may be carried by name.
"""

from __future__ import annotations

import gc
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.wordcache import WordIds

MARK = "▁"
SLICE = 1 << 20  # bytes of text encoded together
_BYTE, _NORMAL, _USER = 6, 1, 4  # piece types of the model format
_UNIGRAM = 1
LONG = 24  # characters of a word that is cut into atoms
FITS, MEMOS = 400_000, 500_000  # remembered per Python worker: pairs of pieces; steps between nodes


class Pieces:
    """Vocabulary of a serialised model and the forward pass over its pieces."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        self.normalize = sentencepiece.SentencePieceProcessor(model_proto=model).normalize
        self.unigram = spec.trainer_spec.model_type == _UNIGRAM
        self.prefix = spec.normalizer_spec.add_dummy_prefix
        listed = list(enumerate(spec.pieces))
        self.id = {p.piece: i for i, p in listed if p.type in (_NORMAL, _USER)}
        self.score = {p.piece: p.score for _, p in listed if p.type in (_NORMAL, _USER)}
        self.piece = [p.piece for _, p in listed]
        self.byte = {int(p.piece[1:-1], 16): i for i, p in listed if p.type == _BYTE}
        self.unk = next((i for i, p in listed if p.type == 2), 0)
        self.unknown_score = min(self.score.values(), default=0.0) - 10.0
        by_byte = {i: bytes([b]) for b, i in self.byte.items()}
        shown = {i: p.replace(MARK, " ").encode() for p, i in self.id.items()}
        self.surface = [by_byte.get(i, shown.get(i, b" \xe2\x81\x87 " if i == self.unk else b"")) for i, _ in listed]
        apart = "".join(c for c in "\n\t\r" if not any(c in p for p in self.id))
        crossing = any(MARK in p.lstrip(MARK) for p in self.id)
        self.words = re.compile(f"[{apart}]|{MARK}*[^{MARK}{apart}]+|{MARK}+" if apart else f"{MARK}*[^{MARK}]+|{MARK}+").findall if not crossing else (lambda t: [t] if t else [])
        scores = sorted(s for p, s in self.score.items() if len(p) > 1)
        equal = {a for a, b in zip(scores, scores[1:]) if a == b}
        tied = sorted((p for p, s in self.score.items() if len(p) > 1 and s in equal), key=len)
        self.tied = re.compile("|".join(map(re.escape, tied))).search if tied and not self.unigram else (lambda w: None)
        self.inside = {pair for p in self.id for pair in zip(p, p[1:])}  # characters that some piece has side by side
        self.none = len(listed)  # stands for a character that is no piece
        self.length = [len(p.piece) for _, p in listed] + [1]
        self.scores = [p.score for _, p in listed] + [self.unknown_score]
        self.when = [s if n > 1 else np.inf for s, n in zip(self.scores, self.length)]
        cuts = ((k, p[:i], p[i:]) for p, k in self.id.items() for i in range(1, len(p)))
        self.joins = {self.id[a] * (self.none + 1) + self.id[b]: self.scores[k] for k, a, b in cuts if a in self.id and b in self.id}
        self.halves: dict = {}  # id -> ids (left, right) of the piece's last merge; None: one character; False: not a fixed point
        self.fits: dict = {}  # id * (none + 1) + next id -> compatible
        self._grow_tree()

    def _grow_tree(self) -> None:
        """The pieces as a tree of characters with a link from every node to the longest
        proper end of its string that is in the tree."""
        self.go, self.fail, self.at, self.memos = [{}], [0], [None], 0
        for piece, k in self.id.items():
            node = 0
            for c in piece:
                after = self.go[node].get(c)
                if after is None:
                    after = self.go[node][c] = len(self.go)
                    self.go.append({}), self.fail.append(0), self.at.append(None)
                node = after
            self.at[node] = k
        level = list(self.go[0].values())
        while level:
            below = []
            for node in level:
                for c, after in self.go[node].items():
                    f = self.fail[node]
                    while f and c not in self.go[f]:
                        f = self.fail[f]
                    self.fail[after] = self.go[f].get(c, 0)
                    below.append(after)
            level = below
        self.out: list = [None] * len(self.go)  # node -> pieces that end there, found when first asked for

    def _step(self, node: int, c: str) -> int:
        """The node after ``c`` where the tree has none below ``node``."""
        if c not in self.go[0]:
            return 0
        f = node
        while f and c not in self.go[f]:
            f = self.fail[f]
        after = self.go[f].get(c, 0)
        if self.memos < MEMOS:
            self.memos += 1
            self.go[node][c] = after
        return after

    def _outs(self, node: int) -> tuple:
        """(id, length) of the pieces that end at ``node``, the longest first; a BPE model
        wants fixed points of two or more characters."""
        found, f = [], node
        while f:
            k = self.at[f]
            if k is not None and (self.unigram or (self.length[k] > 1 and self._halves(k) is not False)):
                found.append((k, self.length[k]))
            f = self.fail[f]
        self.out[node] = tuple(found)
        return self.out[node]

    def merge(self, word: str) -> tuple[list, tuple | None]:
        """Pieces after all merges, best score first and leftmost among equals; the last merge."""
        parts, last = list(word), None
        while True:
            best = max(((self.score.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(-np.inf, 0))
            if best[0] == -np.inf:
                return parts, last
            i = -best[1]
            last = (parts[i], parts[i + 1])
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def _halves(self, k: int):
        got = self.halves.get(k, 0)
        if got == 0:
            got = None
            if self.length[k] > 1:
                parts, last = self.merge(self.piece[k])
                got = (self.id[last[0]], self.id[last[1]]) if len(parts) == 1 else False
            self.halves[k] = got
        return got

    def _fit(self, a: int, b: int) -> bool:
        """Whether merging the characters of pieces ``a`` and ``b`` leaves exactly these two:
        going back in time, the later formed of both edges is undone until both are single
        characters."""
        joins, when, base = self.joins, self.when, self.none + 1
        before = -np.inf  # merges across the boundary must come after the step just undone
        strict = True
        while True:
            joined = joins.get(a * base + b)
            if joined is not None and (joined > before or (not strict and joined == before)):
                return False
            x, y = when[a], when[b]
            if x < y:  # of equal scores the right one merged last
                before, strict, a = x, True, self._halves(a)[1]
            elif y < np.inf:
                before, strict, b = y, False, self._halves(b)[0]
            else:
                return True

    def _remember(self, a: int, b: int) -> bool:
        if len(self.fits) > FITS:
            self.fits.clear()
        self.fits[a * (self.none + 1) + b] = good = self._fit(a, b)
        return good

    def segment(self, words: list) -> list[bytes]:
        """Ids of each of the sorted ``words`` as 32-bit integers. ``ends[i]`` is the last piece of the first i
        characters and ``path[i]`` the node reached there; both are kept for the characters
        shared with the word before."""
        out, before, ends, path, total = [], "", [self.none], [0], [0.0]
        extend = self._best_ends if self.unigram else self._live_ends
        length, none = self.length, self.none
        for w in words:
            if self.tied(w):
                out.append(array("i", self._ids(self.merge(w)[0])).tobytes())
                continue
            shared = 0
            for x, y in zip(before, w):
                if x != y:
                    break
                shared += 1
            del ends[shared + 1:], path[shared + 1:], total[shared + 1:]
            extend(w, ends, path, total)
            before, ids, i = w, [], len(w)
            while i > 0:
                k = ends[i]
                if k == none:
                    ids += self._spelled(w[i - 1])[::-1]
                else:
                    ids.append(k)
                i -= length[k]
            ids.reverse()
            out.append(array("i", ids).tobytes())
        return out

    def _live_ends(self, w: str, ends: list, path: list, _total: list) -> None:
        """Extend the forward table over the rest of ``w``: the one live last piece of each prefix."""
        go, out, fits, single, base = self.go, self.out, self.fits, self.id, self.none + 1
        i = len(ends) - 1
        node = path[i]
        for c in w[i:] if i else w:
            i += 1
            after = go[node].get(c)
            node = self._step(node, c) if after is None else after
            found = out[node]
            for k, n in self._outs(node) if found is None else found:  # the longest first
                if n == i:
                    break
                a = ends[i - n]
                good = fits.get(a * base + k)
                if self._remember(a, k) if good is None else good:
                    break
            else:
                k = single.get(c, base - 1)
            ends.append(k)
            path.append(node)

    def _best_ends(self, w: str, ends: list, path: list, total: list) -> None:
        """Extend the forward table over the rest of ``w``: the best last piece of each prefix."""
        node = path[-1]
        for i in range(len(ends), len(w) + 1):
            c = w[i - 1]
            after = self.go[node].get(c)
            node = self._step(node, c) if after is None else after
            found = self.out[node]
            best, live = (-np.inf, self.none) if c in self.id else (total[i - 1] + self.unknown_score, self.none)
            for k, n in self._outs(node) if found is None else found:
                s = total[i - n] + self.scores[k]
                if s > best or (s == best and live == self.none):
                    best, live = s, k
            ends.append(live)
            path.append(node)
            total.append(best)

    def atoms(self, word: str) -> list[str]:
        """``word`` cut wherever no piece has the two characters side by side."""
        cuts = [i for i, pair in enumerate(zip(word, word[1:]), 1) if pair not in self.inside]
        return [word[i:j] for i, j in zip([0, *cuts], [*cuts, len(word)])] if cuts else [word]

    def encode(self, words: list) -> list[bytes]:
        """Ids of each word as 32-bit integers. The atoms of long words are segmented apart,
        each distinct one once; short words share enough with their neighbours."""
        long = {w: self.atoms(w) for w in words if len(w) > LONG}
        distinct = sorted({w for w in words if w not in long}.union(*long.values())) if long else sorted(words)
        ids = dict(zip(distinct, self.segment(distinct)))
        return [b"".join([ids[a] for a in long[w]]) if w in long else ids[w] for w in words]

    def _spelled(self, c: str) -> list:
        """Ids of a character that is no piece."""
        return [self.byte[x] for x in c.encode()] if self.byte else [self.unk]

    def _ids(self, parts: list) -> list:
        ids: list = []
        for p in parts:
            k = self.id.get(p)
            ids += self._spelled(p) if k is None else [k]
        return ids

    def decode(self, ids: list) -> str:
        raw = b"".join(map(self.surface.__getitem__, ids))
        text = raw.decode("utf-8", errors="replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_LOADED: dict = {}


def _pieces(model: bytes) -> tuple[Pieces, WordIds]:
    """The model and the words met so far, once per Python worker."""
    if model not in _LOADED:
        _LOADED.clear()
        pieces = Pieces(model)
        gc.freeze()  # the model's tables stay as long as the worker
        _LOADED[model] = pieces, WordIds(pieces.encode)
    return _LOADED[model]


def load(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _encoded(texts: list, pieces: Pieces, store: WordIds) -> pa.ListArray:
    words = [pieces.words(pieces.normalize(t)) if t else [] for t in texts]
    store.learn(set().union(*words))
    raw = [store.ids(ws) for ws in words]
    ends = np.cumsum([0] + [len(r) // 4 for r in raw]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(raw), dtype="<i4"))
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array([t is None for t in texts], pa.bool_()))


def _decoded(ids: pa.ListArray, pieces: Pieces) -> pa.Array:
    values, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    return pa.array([pieces.decode(values[i:j].tolist()) if ok.as_py() else None for i, j, ok in zip(ends, ends[1:], ids.is_valid())], pa.string())


def _slices(texts):
    lo, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t.as_buffer()) if t.is_valid else 0
        if n >= SLICE or i == len(texts) - 1:
            yield lo, i + 1
            lo, n = i + 1, 0


def _map(docs: DataFrame, model: bytes, id_col: str, text_col: str, back: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one model file
    names = ["doc_id", "ids", "text"] if back else ["doc_id", "ids"]

    def run(batches):
        pieces, store = _pieces(shared.value)
        for b in batches:
            for lo, hi in _slices(b.column(1)):
                ids = _encoded(b.column(1)[lo:hi].to_pylist(), pieces, store)
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], ids, *([_decoded(ids, pieces)] if back else [])], names=names)

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, ids array<int>" + ", text string" * back)


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of every whole text."""
    return _map(docs, model, id_col, text_col, False)


def _sized(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).alias("n_tokens"), "text")


def round_trip(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, n_tokens, text): ``encode`` and ``decode`` in one pass over the rows, so
    one Python worker a task holds the model; ``text`` is decoded from the ids."""
    return _sized(_map(docs, model, id_col, text_col, True))


def decode(encoded: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, n_tokens, text): the texts that the ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        pieces, _ = _pieces(shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                yield pa.RecordBatch.from_arrays([*part.columns, _decoded(part.column(1), pieces)], names=["doc_id", "ids", "text"])

    narrow = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    back = narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string")
    return _sized(back)
