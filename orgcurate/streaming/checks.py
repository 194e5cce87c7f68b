"""Row-local checks and stream-static joins on streaming tables.

The batch operators take them as they are, since they are plain transformations; what
needs state (history, set operations) stays batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import host_of
from ..operators import duplicates, fields


def edge_findings(stream: DataFrame, record: str, value: str) -> DataFrame:
    return fields.edge_characters(fields.unpivoted(stream, record, {value: F.col(value)}))


def known_sites(stream: DataFrame, registry: DataFrame, url: str = "url", order: str = "page_id") -> DataFrame:
    """Submitted pages whose host the static registry has."""
    static = registry.select(host_of(F.col(url)).alias("host"), F.col(order).alias("at"), F.col(order))
    return duplicates.same_key(stream.withColumn("host", host_of(F.col(url))), static, "host", "at")


def changes_per_window(stream: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events of each key in tumbling windows, with late rows up to a watermark."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("n")).select("w.start", "w.end", key, "n")
