"""Next document by ranges of ids: rows without an id, copies, ids beyond 2**53; positional matches."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import syncmers


def _rows(kind):
    rnd = random.Random(kind)
    text = lambda: "".join(rnd.choice("abcdef \n") for _ in range(rnd.randrange(60)))
    if kind == "plain":
        return [(2**60 + 3 * i, text()) for i in range(400)]
    if kind == "no id":
        return [(i if rnd.random() < 0.6 else None, text()) for i in range(900)]
    return [(i, text()) for i in range(300)] + [(None, "the same text in every copy")] * 300 + [(7, "again")] * 200


@pytest.mark.parametrize("kind", ["plain", "no id", "copies"])
def test_every_row_meets_its_successor(spark, kind):
    data = _rows(kind)
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    dealt = syncmers.with_next(docs, "doc_id", "text", 6)
    placed = dealt.withColumn("task", F.spark_partition_id()).collect()
    by_range = {}
    for r in placed:
        by_range.setdefault(r["range"], []).append(r)
    assert len(by_range) > 6
    own, lines = [], []
    for n in sorted(by_range):
        part = by_range[n]
        assert [r["copy"] for r in part] == [False] * (len(part) - 1) + [True]  # streamed in this order
        own += [(r["doc_id"], r["text"]) for r in part[:-1]]
        lines.append(part)
    assert sorted(own, key=repr) == sorted(data, key=repr)
    ids = [-1 if i is None else i for i, _ in own]
    assert ids == sorted(ids)
    for part, after in zip(lines, lines[1:] + lines[:1]):
        assert (part[-1]["doc_id"], part[-1]["text"]) == (after[0]["doc_id"], after[0]["text"])
    assert max(len(p) for p in lines) < len(data) / 4  # no range holds all rows of an id


def test_kept_chars_by_position(spark):
    rnd = random.Random(3)
    prose = lambda n: "".join(rnd.choice("abcdefghijklmnop ") for _ in range(n))
    docs = spark.createDataFrame([(1, prose(4000)), (2, prose(4000)), (3, "x"), (4, None), (5, "one line\n" * 2000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in syncmers.edited_fingerprints(docs, positions=True).collect()}
    assert 2900 < got[1]["kept_chars"] <= 3000 + syncmers.K and got[3]["kept_chars"] == got[4]["kept_chars"] == 0
    assert 0 <= got[5]["kept_chars"] <= 18000
    at, h = np.array([0, 4, 9]), np.array([5, 6, 5])
    assert [x.tolist() for x in syncmers.once(at, h)] == [[4], [6]]
    assert syncmers.covered([(0, 0, 10), (5, 9, 10), (40, 3, 2)]) == 17
