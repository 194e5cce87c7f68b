"""Interaction of five document filters, by direct relational replay.

Filters (a document fails where the condition holds; words are maximal runs outside [\\x20\\x09-\\x0D]):

- A: fewer than 100 words
- B: 100 * distinct words < 80 * words
- C: 100 * [A-Z] characters > 10 * code points
- D: holds any of #$%&*|
- E: identical to the text of any smaller doc_id, in the whole table

Every document's flags meet the 120 orders of the filters, a broadcast table of fixed size; each
meeting is exploded into its five steps, the first failure of the order is worked out, and the
steps are summed by condition, in each task before anything is shuffled: what is shuffled is at most 600
rows for each part and task, so that a part that holds most documents is no hot key.

Defined results: a null text counts as empty, a null lang is the part of the empty string; identity
is that of SHA-256 and length. Rows that repeat a doc_id are documents of their own, and not each
other's copies; a null doc_id is neither smaller nor larger than another. Of repeated labels of one id any 1 counts;
labels of null ids are not used. An empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import arrow_type, ship, written

FILTERS = "ABCDE"
TASK_DOCS = 50_000  # narrow rows that one task multiplies by 600
MANY_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 100, 80, 10
UPPER, MARKS = bytes(range(65, 91)), b"#$%&*|"
COPY = 1 << FILTERS.index("E")


def fails(raw: bytes) -> int:
    """The bits of the filters A to D that a text fails; A's is the lowest."""
    words = raw.split()  # of bytes: at [\x20\x09-\x0D]
    n = len(words)
    points = len(raw) if raw.isascii() else len(raw.decode("utf-8", "replace"))
    upper = len(raw) - len(raw.translate(None, UPPER))
    marks = len(raw) - len(raw.translate(None, MARKS))
    found = (n < MANY_WORDS, 100 * len(set(words)) < DISTINCT_PERCENT * n, 100 * upper > UPPER_PERCENT * points, marks > 0)
    return sum(1 << i for i, x in enumerate(found) if x)


def features(docs: DataFrame) -> DataFrame:
    """doc_id, part, flags (without E), sha, n_bytes of every row."""
    schema = pa.schema([("doc_id", arrow_type(docs, "doc_id")), ("part", pa.string()), ("flags", pa.int32()), ("sha", pa.binary()), ("n_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flags, sha, size = [], [], []
            for x in b.column("text"):
                raw = x.as_buffer().to_pybytes() if x.is_valid else b""
                flags.append(fails(raw))
                sha.append(hashlib.sha256(raw).digest())
                size.append(len(raw))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), pa.array(flags, pa.int32()), pa.array(sha, pa.binary()), pa.array(size, pa.int64())], schema=schema)

    d = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, part string, flags int, sha binary, n_bytes long")


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, flags (all five), good, toxic of every row.

    Both lookups are written tables of one row a key, so that Spark may split hot texts among tasks."""
    f = written(features(docs), "features")
    first = written(f.groupBy("sha", "n_bytes").agg(F.min("doc_id").alias("first_id")), "first-copies")
    marks = written(labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")), "marks")
    tasks = f.count() // TASK_DOCS + 1
    f = f.join(first, ["sha", "n_bytes"], "left").withColumn("flags", F.col("flags") + F.when(F.col("first_id") < F.col("doc_id"), COPY).otherwise(0))
    f = f.join(marks, "doc_id", "left").select("part", "flags", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    return f.repartition(tasks)


def orders(docs: DataFrame) -> DataFrame:
    """The 120 orders: filter_order, and the bits of its filters, bit1 to bit5."""
    rows = [("".join(p), *(1 << FILTERS.index(x) for x in p)) for p in permutations(FILTERS)]
    return docs.sparkSession.createDataFrame(rows, "filter_order string, " + ", ".join(f"bit{i} int" for i in range(1, 6)))


def replayed(flags: DataFrame) -> DataFrame:
    """The counts of every part, order and step, from part, flags, good and toxic of each document."""
    met = flags.crossJoin(F.broadcast(orders(flags)))
    fails_at: Column = F.lit(6)
    for i in range(5, 0, -1):
        fails_at = F.when(F.col("flags").bitwiseAND(F.col(f"bit{i}")) != 0, i).otherwise(fails_at)
    met = met.withColumn("first", fails_at)
    steps = met.select("part", "filter_order", "flags", "good", "toxic", "first", F.expr("stack(5, " + ", ".join(f"{i}, bit{i}" for i in range(1, 6)) + ") AS (step, bit)"))
    removed, fails_it = F.col("first") == F.col("step"), F.col("flags").bitwiseAND(F.col("bit")) != 0

    def count(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    counts = steps.groupBy("part", "filter_order", "step", "bit").agg(
        count(F.col("first") > F.col("step")).alias("kept"), count(removed).alias("removed"), count(fails_it & (F.col("first") < F.col("step"))).alias("redundant"), count(F.col("flags") == F.col("bit")).alias("unique_fails"),
        count(removed & (F.col("good") == 1)).alias("good_lost"), count(removed & (F.col("toxic") == 1)).alias("toxic_lost"),
    )
    return counts


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    ship(docs.sparkSession)
    counts = written(replayed(flagged(docs, labels)), "replay")
    shares = counts.groupBy("part", "bit").agg(F.sum("removed").alias("shapley"))
    return counts.join(shares, ["part", "bit"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
