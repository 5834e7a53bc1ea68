"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.session import ensure_checkpoint_dir

# Class of the characters that make up words: everything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder: lineage ends there, so a lost
    executor costs a re-read and not a recomputation, and every reader sees the same rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Like ``stored`` for wide rows: compressed columns, so later readers can prune."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(columns, name: str) -> str:
    """``name``, with underscores appended until no column has it."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def aside(docs: DataFrame, taken) -> tuple[DataFrame, dict]:
    """``docs`` with the columns that are called like one of the names ``taken`` renamed, and
    the present name of every column of ``docs``."""
    names, used = {}, {*docs.columns, *taken}
    for c in docs.columns:
        names[c] = free(used, c) if c.lower() in taken else c
        used.add(names[c])
    return docs.withColumnsRenamed({c: n for c, n in names.items() if c != n}), names


def word_count(text: Column) -> Column:
    """Number of ``WORD`` runs; 0 for NULL."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.filter(F.split(spaced, " "), lambda w: w != "")).cast("long")
