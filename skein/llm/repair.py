"""Conversation structure repair: generalised LR repair over the role grammar.

A conversation should read ``talk -> (nothing) | s pairs | pairs`` with
``pairs -> u a | u a pairs`` over the first letters of its roles. Every row may be kept
(0), rerolled to user or assistant (2) or deleted (3); blank rows and rows whose role and
text came before must be deleted; a truncated row that stays adds 1; an empty user or
assistant message may be inserted anywhere (2). Of the cheapest edit lists the one whose
initials (D, I, K, R in order) are least in ASCII is chosen.

The parser reads a conversation from its last row to its first with the LR tables of the
mirrored grammar. Its frontier is a graph-structured stack: one node per stack top, holding
the cheapest (cost, edits) that leads there. Two ways to the same top merge into the lesser
one. Edits are written in front of those already found, so a common continuation never
changes which of two is less, and merging loses no optimum. (Read forwards, merging would
compare unfinished edit lists, and a list that is the beginning of another may lose later.)

Scale: no conversation has to fit one task until its own result cells.
1. equal rows are counted first, so repeats never pile up on a task;
2. rows are range-partitioned by (conversation, turn, role, text digest) and numbered: a
   long conversation lies in several chunks;
3. repeats are found by a partial aggregate (first place of each role and text) joined back
   on the unique place;
4. every chunk is parsed on its own from every stack top that may stand to its right;
   equal chunks are parsed once a task;
5. a fold over a conversation's few chunk tables picks the cheapest list, and each chunk
   renders its own rows.
The edit list of a conversation and a chunk's rows are single cells, so at most 2 GB each.

Defined cases: a NULL role or text is one space, so a NULL text is blank; a row whose
role is NULL, empty or starts otherwise can't be kept as it is; NULL turns come first; rows of one turn are taken by role and then by a
digest of the text; NULL conversations are one conversation; a conversation id may be of
any type; rows equal in all four columns are repeats; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import stored, written

SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
# Letters of an edit list; H and I insert, R and S reroll, so that equal initials compare equal.
LETTERS = {"D": "D", "H": "I", "I": "I", "K": "K", "R": "R", "S": "R"}

# LR tables of the mirrored grammar: pairs -> pairs a u | a u; talk -> pairs | pairs s.
_SHIFT = {(0, "a"): 1, (1, "u"): 5, (2, "a"): 3, (3, "u"): 6, (2, "s"): 4}
_REDUCE = {5: 2, 6: 3}  # state -> symbols that one ``pairs`` replaces
_GOTO = {0: 2}
TOPS = (0, 1, 2, 3, 4)
_ACCEPT = (0, 2, 4)
_STACKS = {0: (0,), 1: (0, 1), 2: (0, 2), 3: (0, 2, 3), 4: (0, 2, 4)}


@lru_cache(None)
def _push(top: int, letter: str) -> int | None:
    """The stack top after one more role and all reductions that are due; None: an error."""
    to = _SHIFT.get((top, letter))
    if to is None:
        return None
    stack = [*_STACKS[top], to]
    while stack[-1] in _REDUCE:
        del stack[-_REDUCE[stack[-1]]:]
        stack.append(_GOTO[stack[-1]])
    return stack[-1]


def _less(a, b) -> bool:
    """Whether edit list ``a`` is less; lists are (letter, rest) and share their tails."""
    while a is not b:
        if a is None or b is None:
            return a is None
        if a[0] != b[0]:
            return a[0] < b[0]
        a, b = a[1], b[1]
    return False


def _merge(frontier: dict, top: int | None, cost: int, edits) -> bool:
    if top is None:
        return False
    old = frontier.get(top)
    if old is None or cost < old[0] or (cost == old[0] and _less(edits, old[1])):
        frontier[top] = (cost, edits)
        return True
    return False


def _with_inserts(frontier: dict) -> dict:
    todo = list(frontier)
    while todo:
        top = todo.pop()
        cost, edits = frontier[top]
        for letter, sign in (("u", "I"), ("a", "H")):
            to = _push(top, letter)
            if _merge(frontier, to, cost + INSERT, (sign, edits)):
                todo.append(to)
    return frontier


def _read(frontier: dict, role: str, flag: str) -> dict:
    """One row further to the left. ``flag``: ``-`` sound, ``~`` truncated, ``!`` must go."""
    new: dict = {}
    for top, (cost, edits) in frontier.items():
        _merge(new, top, cost + DELETE, ("D", edits))
        if flag == "!":
            continue
        more = TRUNCATED if flag == "~" else 0
        _merge(new, _push(top, role), cost + KEEP + more, ("K", edits))
        for letter, sign in (("u", "R"), ("a", "S")):
            if letter != role:
                _merge(new, _push(top, letter), cost + REROLE + more, (sign, edits))
    return _with_inserts(new)


def _spelled(edits) -> str:
    out = []
    while edits is not None:
        out.append(edits[0])
        edits = edits[1]
    return "".join(out)


def _parsed(codes: str) -> tuple:
    """((entry top, exit top, cost, edits)) of a chunk for every entry top."""
    return _remembered(codes) if len(codes) <= 64 else _tables(codes)


@lru_cache(8192)
def _remembered(codes: str) -> tuple:
    return _tables(codes)


def _tables(codes: str) -> tuple:
    out = []
    for entry in TOPS:
        frontier = {entry: (0, None)}
        for i in range(len(codes) - 2, -1, -2):
            frontier = _read(frontier, codes[i], codes[i + 1])
        out += [(entry, top, cost, _spelled(edits)) for top, (cost, edits) in sorted(frontier.items())]
    return tuple(out)


def _fold(found: dict, table) -> dict:
    """The frontier left of a chunk, from the one at its right and the chunk's table."""
    new: dict = {}
    for step in table:
        entry, top, cost, edits = step["entry"], step["top"], step["cost"], step["edits"]
        if entry in found:
            c, parts = found[entry]
            both = (c + cost, edits + "".join(parts))
            old = new.get(top)
            if old is None or both < (old[0], "".join(old[1])):
                new[top] = (c + cost, [edits, *parts])
    return new


_END = {top: (cost, [_spelled(edits)]) for top, (cost, edits) in _with_inserts({0: (0, None)}).items()}
_TABLE = T.ArrayType(T.StructType([
    T.StructField("entry", T.IntegerType()), T.StructField("top", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("edits", T.StringType())]))


@F.pandas_udf(_TABLE)
def _chunk_table(codes: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(("entry", "top", "cost", "edits"), s)) for s in _parsed(c)] for c in codes])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _row_edits(edits: pd.Series, copies: pd.Series) -> pd.Series:
    """A chunk's edit list cut by rows: the inserts before a row, and its copies' edits;
    what is left belongs to the last row."""

    def cut(s, counts):
        ends = [m.end() for m in re.finditer("[DKRS]", s)]
        at, place, out = 0, 0, []
        for n in counts:
            place += int(n)
            out.append(s[at:ends[place - 1]])
            at = ends[place - 1]
        out[-1] += s[at:]
        return out

    return pd.Series([cut(s, n) for s, n in zip(edits, copies)])


def _chosen(batches):
    """Per chunk its part of the conversation's best edit list. Rows come by conversation,
    last chunk first; only the frontier of the conversation at hand is held."""
    at, found, places = None, None, []

    def done():
        best = min((found[t][0], "".join(found[t][1]), t) for t in found if t in _ACCEPT)
        parts = found[best[2]][1]
        parts = [*parts[:-2], parts[-2] + parts[-1]]  # inserts after the last row go with it
        return [(conv, chunk, best[0], p) for (conv, chunk), p in zip(reversed(places), parts)]

    names, kinds = ["conv", "chunk", "cost", "part"], None
    for b in batches:
        kinds = kinds or [b.schema.field(0).type, pa.int32(), pa.int64(), pa.string()]
        out = []
        for none, conv, chunk, table in zip(*[b.column(i).to_pylist() for i in (1, 0, 2, 3)]):
            if places and (none, conv) != at:
                out += done()
                places = []
            if not places:
                at, found = (none, conv), dict(_END)
            found = _fold(found, table)
            places.append((conv, chunk))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)
    if places:
        out = done()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)


def _letter(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("x")


def chunks(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows by (conv, chunk) in order, each with its letter, fault and copies; written
    once, since every later step reads it."""
    text = F.coalesce(F.col(text_col), F.lit(" "))
    each = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), text.alias("text"))
    counted = each.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    order = ["conv", "turn", "role", "digest"]
    placed = stored(
        counted.withColumn("digest", F.sha2("text", 256)).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns({"chunk": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    )
    first = placed.groupBy("conv", "role", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    bare = F.rtrim("text", F.lit(SPACE))
    fault = (
        F.when(bare == "", "blank").when(F.col("first").isNull(), "duplicate")
        .when(F.substring(bare, -1, 1).isin(".", "!", "?"), "sound").otherwise("truncated")
    )
    flagged = placed.join(first, "place", "left").select("*", fault.alias("fault"), _letter(F.col("role")).alias("letter"))
    row = F.struct("place", "turn", "role", "text", "letter", "fault", "copies")
    return written(flagged.groupBy("conv", "chunk").agg(F.sort_array(F.collect_list(row)).alias("rows")), "repair-chunks")


def _codes(rows: Column) -> Column:
    """Two signs a row copy: the role's letter and the flag."""

    def code(r):
        gone = r["fault"].isin("blank", "duplicate")
        flag = F.when(gone, "!").when(r["fault"] == "truncated", "~").otherwise("-")
        return F.concat(r["letter"], flag, F.repeat(F.concat(r["letter"], F.lit("!")), (r["copies"] - 1).cast("int")))

    return F.array_join(F.transform(rows, code), "")


def _report(table: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal) of conversations with rows."""
    rows, illegal = F.col("rows"), F.lit(0).cast("long")
    pairs = F.zip_with(rows, F.slice(rows, F.lit(2), F.size(rows)), lambda a, b: F.when(b.isNull(), 0).otherwise(_bad_pair(a["letter"], b["letter"])))
    inner = F.aggregate(pairs, illegal, lambda s, x: s + x) + F.aggregate(rows, illegal, lambda s, r: s + r["copies"] - 1)

    def faults(kind):
        own = lambda r: F.when(r["fault"] == kind, r["copies"]).otherwise(0)
        more = lambda r: F.when(r["fault"].isin("truncated", "sound"), r["copies"] - 1).otherwise(0)
        return F.aggregate(rows, F.lit(0).cast("long"), lambda s, r: s + own(r) + (more(r) if kind == "duplicate" else F.lit(0)))

    ends = F.struct("chunk", F.get(rows, F.lit(0))["letter"].alias("a"), F.element_at(rows, -1)["letter"].alias("b"))
    by_chunk = table.select("conv", inner.alias("inner"), ends.alias("ends"), *[faults(k).alias(k) for k in ("blank", "duplicate", "truncated")])
    sums = by_chunk.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "inner")], F.sort_array(F.collect_list("ends")).alias("ends"))
    e = F.col("ends")
    across = F.zip_with(e, F.slice(e, F.lit(2), F.size(e)), lambda a, b: F.when(b.isNull(), 0).otherwise(_bad_pair(a["b"], b["a"])))
    turns = table.select("conv", F.explode(F.array_distinct(F.transform("rows", lambda r: r["turn"]))).alias("turn"))
    seen = turns.groupBy("conv").agg(F.max("turn").alias("hi"), F.min("turn").alias("lo"), F.count_distinct("turn").alias("n"))
    gaps = F.when(F.col("n") > 0, F.col("hi") - F.col("lo") + 1 - F.col("n")).otherwise(0).cast("long")
    return (
        sums.withColumn("illegal", F.col("inner") + F.aggregate(across, F.lit(0).cast("long"), lambda s, x: s + x)).alias("x")
        .join(seen.select(F.col("conv").alias("c2"), gaps.alias("gaps")), F.col("x.conv").eqNullSafe(F.col("c2")))
        .select("conv", "gaps", "blank", "duplicate", "truncated", "illegal")
    )


def _bad_pair(a: Column, b: Column) -> Column:
    return F.when(F.concat(a, b).isin("su", "ua", "au"), 0).otherwise(1)


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(report, messages). report: one row per conversation with rows: ``conv``, ``gaps``,
    ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``. messages: per
    conversation and chunk the repaired messages in order (``conv``, ``chunk``,
    ``messages`` array of role and text); chunks ascend."""
    table = chunks(rows, conv_col, turn_col, role_col, text_col)
    conv_type = table.schema["conv"].dataType.simpleString()
    parsed = table.select("conv", F.col("conv").isNull().alias("none"), "chunk", _chunk_table(_codes(F.col("rows"))).alias("steps"))
    by_conv = parsed.repartition("conv").sortWithinPartitions("none", "conv", F.col("chunk").desc())
    parts = written(by_conv.mapInArrow(_chosen, f"conv {conv_type}, chunk int, cost bigint, part string"), "repair-parts")
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "part"))), lambda p: p["part"]), "")
    audits = parts.groupBy("conv").agg(F.max("cost").alias("cost"), F.translate(whole, "HS", "IR").alias("audit"))
    report = _report(table).alias("r").join(audits.withColumnRenamed("conv", "c3"), F.col("r.conv").eqNullSafe(F.col("c3"))).drop("c3")

    edited = table.alias("t").join(parts.alias("p"), (F.col("t.chunk") == F.col("p.chunk")) & F.col("t.conv").eqNullSafe(F.col("p.conv")))
    cut = edited.select("t.conv", "t.chunk", "rows", _row_edits("part", F.transform("rows", lambda r: r["copies"])).alias("edits"))

    def lines(row, edits):
        made = F.transform(
            F.filter(F.split(edits, ""), lambda s: ~s.isin("", "D")),
            lambda s: F.struct(
                F.when(s.isin("H", "S"), "assistant").when(s.isin("I", "R"), "user").otherwise(row["role"]).alias("role"),
                F.when(s.isin("H", "I"), "").otherwise(row["text"]).alias("text")))
        return made

    messages = cut.select("conv", "chunk", F.flatten(F.zip_with("rows", "edits", lines)).alias("messages"))
    return report, messages


def digests(messages: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): of all ``role:text`` lines of a conversation, newline-joined.
    A task reads a conversation's chunks in order and holds one at a time."""
    import hashlib

    kind = messages.schema["conv"].dataType.simpleString()
    lines = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    texts = messages.where(F.size("messages") > 0).select("conv", F.col("conv").isNull().alias("none"), "chunk", lines.alias("lines"))
    ordered = texts.repartition("conv").sortWithinPartitions("none", "conv", "chunk")

    def run(batches):
        at, sha, conv_type = None, None, None
        for b in batches:
            conv_type, out = b.schema.field(0).type, []
            for conv, none, lines in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3)):
                if sha is not None and (none, conv) == at:
                    sha.update(b"\n")
                else:
                    out += [(at[1], sha.hexdigest())] if sha is not None else []
                    at, sha = (none, conv), hashlib.sha256()
                sha.update(lines.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], conv_type), pa.array([r[1] for r in out], pa.string())], names=["conv", "repaired_sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at[1]], conv_type), pa.array([sha.hexdigest()])], names=["conv", "repaired_sha256"])

    return ordered.mapInArrow(run, f"conv {kind}, repaired_sha256 string")


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows after the fixed damage: by crc32 of ``conv:turn`` mod 20, 0 drops a row, 1
    empties its text, 2 removes ``.!?``, 3 repeats it and 4 makes its role ``user``."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col)]
    kind = F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1])) % 20
    role, text = F.coalesce(F.col(role_col), F.lit(" ")), F.coalesce(F.col(text_col), F.lit(" "))
    made = rows.select(
        F.col(conv_col), F.col(turn_col),
        F.when(kind == 4, "user").otherwise(role).alias(role_col),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias(text_col),
        F.explode(F.array_repeat(F.lit(1), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))).alias("_copy"))
    return made.select(conv_col, turn_col, role_col, text_col)
