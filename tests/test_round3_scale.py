"""Rounding without decimal numbers, totals of many limbs in plain arithmetic, compressed raw files."""

import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from skein.operators import running as R
from skein.plans import queries as Q
from skein.sources import io


def test_rounding_equals_decimal_rounding(spark):
    rnd = random.Random(1)
    values = [rnd.uniform(-1, 1) * 10 ** rnd.randint(-8, 16) for _ in range(4000)]
    values += [rnd.randint(-10**7, 10**7) / 100000 + d for _ in range(4000) for d in (0.0, -1e-9, 1e-9)]  # ties in five digits
    values += [0.0, -0.0, -1e-9, -2e-5, -5e-5, 5e-5, None, math.nan, math.inf, -math.inf, 1e300, 12345.00005, 2.5e5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", Q.r4up("x").alias("a"), F.round(F.col("x") + 1e-9, 4).alias("b")).collect()
    assert all(repr(r["a"]) == repr(r["b"]) for r in rows)
    assert "rint" in str(Q.r4up("x"))


def test_totals_of_a_dozen_limbs_are_plain_arithmetic(spark):
    text = str(R.Limbs(-7, 4).total({n: f"p{n}" for n in R.Limbs(-7, 4).names()}))
    assert "aggregate" not in text and "lambda" not in text
    rnd = random.Random(2)
    rows = [(i % 3, i, rnd.choice([1, -1]) * rnd.randint(1, 60) * 2.0 ** rnd.choice([-100, 0, 100])) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, t int, x double")
    got = {r["t"]: r["s"] for r in R.running(df, "k", ["t"], [R.cum_sum("s", "x")]).collect()}
    total = {}
    for k, t, x in rows:
        total[k] = total.get(k, Fraction(0)) + Fraction(x)
        assert abs(Fraction(got[t]) - total[k]) <= abs(total[k]) * Fraction(1, 2**51), t


def test_compressed_json_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(io, "COMPRESSED_ROWS", 30)
    path = str(tmp_path / "raw")
    io.write_json(spark.range(100).coalesce(1), path, "gzip")
    files = [f.name for f in (tmp_path / "raw").iterdir() if f.name.startswith("part-")]
    assert len(files) == 4 and all(f.endswith(".json.gz") for f in files)
    assert sorted(r["id"] for r in io.read_json(spark, path, "id bigint", False).collect()) == list(range(100))
