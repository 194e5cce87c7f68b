"""Snapshots: first and last change, upsert, differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def changes(df: DataFrame, key: str, order: list[str], record: Column) -> DataFrame:
    """Rows whose record differs from the key's previous one, or is its first."""
    w = Window.partitionBy(key).orderBy(*order)
    d = df.withColumn("_now", record)
    d = d.withColumn("_before", F.lag("_now").over(w)).withColumn("_rank", F.row_number().over(w))
    return d.filter((F.col("_rank") == 1) | ~F.col("_now").eqNullSafe(F.col("_before"))).drop("_now", "_before", "_rank")


def created_and_modified(df: DataFrame, key: str, date: str, order: list[str], record: Column) -> DataFrame:
    """W1-W3 in one pass: key, created, last_modified, n_changes."""
    w = Window.partitionBy(key).orderBy(*order)
    d = df.select(key, date, record.alias("now"), F.lag(F.struct(record.alias("r"))).over(w).alias("before"))
    changed = F.col("before").isNull() | ~F.col("now").eqNullSafe(F.col("before.r"))
    return d.groupBy(key).agg(F.min(date).alias("created"), F.max(F.when(changed, F.col(date))).alias("last_modified"), F.count_if(changed).alias("n_changes"))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """O1: records of new replace those of old with the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def compared(old: DataFrame, new: DataFrame, key: str, value: Column) -> DataFrame:
    """O3: key and status (added, removed, changed, same) of every key."""
    a = old.select(key, F.struct(value.alias("v")).alias("old"))
    b = new.select(key, F.struct(value.alias("v")).alias("new"))
    status = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old").eqNullSafe(F.col("new")), "same").otherwise("changed")
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def multiset_difference(old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose counts differ, with both counts. Aggregates first, so that what
    is shuffled is one row per distinct value and task."""
    both = old.select(*columns, F.lit(1).alias("o"), F.lit(0).alias("n")).unionByName(new.select(*columns, F.lit(0).alias("o"), F.lit(1).alias("n")))
    return both.groupBy(*columns).agg(F.sum("o").alias("n_old"), F.sum("n").alias("n_new")).filter("n_old <> n_new")


def collapse_adjacent(df: DataFrame, partition: str, order: list[str], value: str) -> DataFrame:
    """Of neighbouring rows with one value only the first stays."""
    return changes(df, partition, order, F.col(value))


def chunked(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """K6, K7: a `chunk` number for each run of `size` rows in order, without sorting in one task.

    Rows are dealt out by ranges; each range's first rank is the sum of those before."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id())
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_id").alias("_low"))  # one row for each partition
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("_part", "_low", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_first"))
    rank = F.col("_id") - F.col("_low") + F.col("_first")
    return ranged.join(F.broadcast(first), "_part").withColumn("chunk", F.floor(rank / size).cast("long")).drop("_part", "_id", "_low", "_first")


def first_seen(df: DataFrame, value: str, order: str) -> DataFrame:
    """Distinct values with the place where each came first."""
    return df.groupBy(value).agg(F.min(order).alias("first_seen"))


def stable_sample(df: DataFrame, key: str, n: int, seed: int = 0, but: DataFrame | None = None) -> DataFrame:
    """N rows in the order of a seeded digest of the key, the same rows on every run; of
    those only that are not among `but`, which has the key."""
    rest = df if but is None else df.join(but.select(key).distinct(), key, "left_anti")
    return rest.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), key).limit(n)


def sample_with_replacement(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """Draw and the n rows drawn, some of them more than once: draw k takes the row whose
    rank in the key's order is the first 8 hex digits of a digest of seed and k, modulo the rows."""
    ranked = chunked(df, [key], 1).withColumnRenamed("chunk", "_rank")
    many = df.count()  # a job
    draws = df.sparkSession.range(n if many else 0).withColumnRenamed("id", "draw")
    hashed = F.conv(F.left(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("draw").cast("string")).cast("binary")), F.lit(8)), 16, 10).cast("long")
    draws = draws.select("draw", (hashed % max(1, many)).alias("_rank"))
    return draws.join(ranked, "_rank").drop("_rank")
