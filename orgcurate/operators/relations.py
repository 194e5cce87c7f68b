"""Relationship edges: inverses, contradictions, repair and propagation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written

# The inverse of each relationship, and pairs that exclude each other.
INVERSE = {"Parent": "Child", "Child": "Parent", "Related": "Related", "Successor": "Predecessor", "Predecessor": "Successor"}
EXCLUSIVE = [("Parent", "Child"), ("Successor", "Predecessor")]


def inverse(kind: Column) -> Column:
    return reduce(lambda acc, kv: F.when(kind == kv[0], kv[1]).otherwise(acc), INVERSE.items(), F.lit("Error"))


def both_directions(edges: DataFrame) -> DataFrame:
    """Every edge and its inverse; types ending in -np or -ns have no inverse."""
    bare = F.regexp_replace("type", "-n[ps]$", "")
    forward = F.struct(F.col("record"), F.col("related"), bare.alias("type"), F.lit("given").alias("origin"))
    back = F.struct(F.col("related").alias("record"), F.col("record").alias("related"), inverse(bare).alias("type"), F.lit("inverse").alias("origin"))
    return edges.select(F.explode(F.when(F.col("type").rlike("-n[ps]$"), F.array(forward)).otherwise(F.array(forward, back))).alias("e")).select("e.*")


def contradictions(edges: DataFrame) -> DataFrame:
    """(record, related) whose types exclude each other; edges without an id are skipped."""
    ids = edges.filter((F.coalesce(F.col("record").cast("string"), F.lit("")) != "") & (F.coalesce(F.col("related").cast("string"), F.lit("")) != ""))
    has = {t: F.max(F.col("type") == t).alias(f"_{t}") for pair in EXCLUSIVE for t in pair}
    g = ids.groupBy("record", "related").agg(*has.values(), F.count("*").alias("n_edges"))
    both = reduce(lambda a, b: a | b, [F.col(f"_{x}") & F.col(f"_{y}") for x, y in EXCLUSIVE])
    return g.filter(both).select("record", "related", "n_edges")


def marked(edges: DataFrame) -> DataFrame:
    """All edges; those whose record and related record have types that exclude each other are of type
    Error. Only the contradictory pairs, one row each, are joined back."""
    bad = contradictions(edges).select("record", "related", F.lit(True).alias("_bad"))
    return edges.join(bad, ["record", "related"], "left").withColumn("type", F.when(F.col("_bad"), "Error").otherwise(F.col("type"))).select(*edges.columns)


def with_inverse(edges: DataFrame) -> DataFrame:
    """Edges whose inverse is there too."""
    other = edges.select(F.col("related").alias("record"), F.col("record").alias("related"), inverse(F.col("type")).alias("type"))
    return edges.join(other, ["record", "related", "type"], "left_semi")


def without_inactive(edges: DataFrame, status: DataFrame) -> DataFrame:
    """Drops edges to inactive records, but for predecessors. status: record, status."""
    gone = status.filter("status <> 'active'").select(F.col("record").alias("related"))
    return edges.filter(F.lower("type") != "predecessor").join(gone, "related", "left_anti").unionByName(edges.filter(F.lower("type") == "predecessor").select("related", *(c for c in edges.columns if c != "related"))).select(edges.columns)


def relabelled(edges: DataFrame, names: DataFrame) -> DataFrame:
    """Labels of related records follow their new names. names: record, name."""
    new = names.select(F.col("record").alias("related"), F.col("name").alias("_name"))
    changed = F.col("_name").isNotNull() & ~F.col("_name").eqNullSafe(F.col("label"))
    return edges.join(new, "related", "left").withColumn("changed", changed).withColumn("label", F.coalesce("_name", "label")).drop("_name")


def applied(edges: DataFrame, updates: DataFrame) -> DataFrame:
    """Deletes first, then adds that are not there yet. updates: record, related, type, op."""
    key = ["record", "related", "type"]
    left = edges.select(key).join(updates.filter("op = 'delete'").select(key), key, "left_anti")
    return left.unionByName(updates.filter("op = 'add'").select(key)).distinct()


def without_missing(edges: DataFrame, records: DataFrame) -> DataFrame:
    """Edges whose both ends exist."""
    known = records.select("record").distinct()
    return edges.join(known, "record", "left_semi").join(known.withColumnRenamed("record", "related"), "related", "left_semi").select(edges.columns)


def parents(hierarchy: DataFrame) -> DataFrame:
    """Node and root by pointer doubling over (node, parent); log2(depth) joins, each round
    written, so that plans do not grow. This runs jobs.

    Rounds go on until no root changes; nodes below a cycle have no root, so they end when
    every chain without one has been followed, by the number of rows."""
    d = written(hierarchy.select("node", F.coalesce("parent", "node").alias("root"), F.lit(True).alias("moved")), "parents")
    for _ in range(d.count().bit_length() + 1):
        up = d.select(F.col("node").alias("root"), F.col("root").alias("up"))
        # A node whose root did not move has the last one, so that the many nodes of a large tree do not meet again and again at its root.
        new = d.filter("moved").join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"), F.coalesce(F.col("up") != F.col("root"), F.lit(False)).alias("moved"))
        d = written(d.filter("NOT moved").unionByName(new), "parents")
        if d.filter("moved").isEmpty():
            break
    return d.select("node", "root")


def sticky(df: DataFrame, partition: list[str], order: str, column: str) -> Column:
    return F.last(column, ignorenulls=True).over(Window.partitionBy(*partition).orderBy(order))
