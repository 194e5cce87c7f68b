"""A table of places that grows as ids are looked up, and first hits by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text


def merged(cache: DataFrame, answers: DataFrame, key: str, details: str, order: str) -> DataFrame:
    """The cache after new answers: key, details, error, order, one row for each key.

    What is known stays: the first details of a key by order hold. An error stands only until
    details come, and then the newest error. Rows of null keys are not kept; ties go to the smallest value."""
    columns = [key, details, "error", order]
    both = cache.select(columns).unionByName(answers.select(columns)).filter(F.col(key).isNotNull())
    good = F.min(F.when(F.col(details).isNotNull(), F.struct(order, details))).alias("good")
    bad = F.max(F.when(F.col(details).isNull(), F.struct(order, "error"))).alias("bad")
    d = both.groupBy(key).agg(good, bad)
    has = F.col("good").isNotNull()
    return d.select(key, F.col(f"good.{details}").alias(details), F.when(~has, F.col("bad.error")).alias("error"), F.when(has, F.col(f"good.{order}")).otherwise(F.col(f"bad.{order}")).alias(order))


def to_ask(wanted: DataFrame, cache: DataFrame, key: str, details: str) -> DataFrame:
    """Distinct wanted keys that the cache lacks or has only an error for."""
    known = cache.filter(F.col(details).isNotNull()).select(key)
    return wanted.select(key).filter(F.col(key).isNotNull()).distinct().join(known, key, "left_anti")


def first_hits(wanted: DataFrame, places: DataFrame, name: str) -> DataFrame:
    """wanted with best_match, `name | Geonames ID: [ id](https://www.geonames.org/id)`, of the first place of
    that normalised name: the one of highest rank, then of the smallest id; null where there is none.
    places: place_id, place_name, rank. Names are looked up once each."""
    hit = places.filter("place_name is not null and place_id is not null").groupBy(text.normalize_text(F.col("place_name")).alias("_key")).agg(F.min(F.struct((-F.col("rank")).alias("r"), "place_id", "place_name")).alias("hit"))
    asked = wanted.select(name).filter(F.col(name).isNotNull()).distinct().withColumn("_key", text.normalize_text(F.col(name)))
    place = F.col("hit.place_id").cast("string")
    answers = asked.join(hit, "_key").select(name, F.concat("hit.place_name", F.lit(" | Geonames ID: [ "), place, F.lit("](https://www.geonames.org/"), place, F.lit(")")).alias("best_match"))
    return wanted.join(answers, name, "left")
