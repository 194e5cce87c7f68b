"""Rows dealt to many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by its keys to as many tasks as a shuffle has, so that no task holds more than its
    share of what is made of the rows. The number is explicit, since adaptive execution would merge
    narrow rows into a few tasks again, however much each of them becomes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
