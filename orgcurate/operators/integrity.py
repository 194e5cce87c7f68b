"""Whether requested changes reached the records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def new_record_gaps(requested: DataFrame, stored: DataFrame) -> DataFrame:
    """(record, field, value, type): missing from the record, or under another field.

    requested and stored: record, field, value. Only records that exist are judged."""
    has = stored.groupBy("record").agg(F.collect_set(F.struct("field", "value")).alias("pairs"), F.collect_set("value").alias("values"))
    d = requested.join(has, "record")
    same = F.array_contains("pairs", F.struct(F.col("field"), F.col("value")))
    kind = F.when(~F.array_contains("values", F.col("value")), "missing").when(~same, "transposed")
    return d.select("record", "field", "value", kind.alias("type")).filter("type is not null")


def update_gaps(requested: DataFrame, stored: DataFrame) -> DataFrame:
    """Requested (record, field, op, value) that the records do not show: added or
    replacing values that are missing, deleted ones that are still there, and requests for
    records that do not exist. A delete of the empty value is one of the whole field, and so is
    a replacement by the word delete."""
    clears = (F.col("op") == "replace") & (F.lower("value") == "delete")
    requested = requested.withColumns({"op": F.when(clears, "delete").otherwise(F.col("op")), "value": F.when(clears, "").otherwise(F.col("value"))})
    some = stored.select("record", "field", F.lit("").alias("value"))  # a field that has any value
    flag = stored.select("record", "field", "value").unionByName(some).distinct().withColumn("there", F.lit(True))
    known = stored.select("record").distinct().withColumn("known", F.lit(True))
    d = requested.join(flag, ["record", "field", "value"], "left").join(known, "record", "left")
    status = F.when(F.col("known").isNull(), "no record").when(F.col("op").isin("add", "replace") & F.col("there").isNull(), "missing").when((F.col("op") == "delete") & F.col("there"), "still present")
    return d.select("record", "field", "op", "value", status.alias("status")).filter("status is not null")


def folded(start: Column, ops: Column) -> Column:
    """A list of values after its operations in order. ops: array of (op, value); a
    delete of a value that is not there is an error and changes nothing."""
    kind = "array<string>"
    seed = F.struct(F.coalesce(start, F.array().cast(kind)).alias("list"), F.array().cast(kind).alias("errors"))

    def step(acc: Column, u: Column) -> Column:
        have, one = acc["list"], F.array(u["value"])
        there = F.array_contains(have, u["value"])
        new = F.when(u["op"] == "add", F.when(there, have).otherwise(F.concat(have, one))).when(u["op"] == "delete", F.when(u["value"] == "", F.array().cast(kind)).otherwise(F.array_remove(have, u["value"]))).when(u["op"] == "replace", one).otherwise(have)
        wrong = (u["op"] == "delete") & (u["value"] != "") & ~there | ~u["op"].isin("add", "delete", "replace")
        return F.struct(new.alias("list"), F.when(wrong, F.concat(acc["errors"], F.array(F.concat(u["op"], F.lit(" "), u["value"])))).otherwise(acc["errors"]).alias("errors"))

    return F.aggregate(ops, seed, step)


def found(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """J1, J18, J25."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def not_found(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """J24, O10."""
    return df.join(ids.select(key).distinct(), key, "left_anti")


def place_report(df: DataFrame, places: DataFrame, key: str) -> DataFrame:
    """Rows whose place id is unknown, or whose city or country differs from the place's.

    df: record, key, city, country. places: key, name, country_name."""
    d = df.join(places.select(key, F.col("name").alias("place_city"), F.col("country_name").alias("place_country"), F.lit(True).alias("known")), key, "left")
    differs = ~F.col("city").eqNullSafe(F.col("place_city")) | ~F.col("country").eqNullSafe(F.col("place_country"))
    issue = F.when(F.col("known").isNull(), "invalid id").when(differs, "mismatch")
    return d.select("record", key, "city", "country", "place_city", "place_country", issue.alias("issue")).filter("issue is not null")
