"""Duplicate searches between records.

Every search is an equi join on a computed key; names are searched by `names.similar_names`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .names import similar_names  # noqa: F401  also a public name of this module
from .pairing import paired


def last_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Of the rows with a key, the one that comes last in order."""
    fields = [c for c in df.columns if c != key]
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*fields), F.col(order)).alias("last")).select(key, "last.*")


def same_key(submitted: DataFrame, registry: DataFrame, key: str, order: str) -> DataFrame:
    """Submitted rows whose key the registry has; the registry's last record per key.

    Columns of the registry come with the prefix `registry_`."""
    last = last_per_key(registry, key, order)
    renamed = last.select(key, *(F.col(c).alias(f"registry_{c}") for c in last.columns if c != key))
    return submitted.filter(F.col(key).isNotNull()).join(renamed, key)


def overlapping_ids(submitted: DataFrame, registry: DataFrame, record: str, value: str) -> DataFrame:
    """(record, other record, common id) of different records, one row per common id."""
    a = submitted.select(F.col(record).alias("record"), F.col(value).alias("common_id")).distinct()
    b = registry.select(F.col(record).alias("other"), F.col(value).alias("common_id")).distinct()
    return a.join(b, "common_id").filter(F.col("record") != F.col("other")).select("record", "other", "common_id")


def overlap_members(submitted: DataFrame, registry: DataFrame, record: str, value: str) -> DataFrame:
    """J5 as membership: of every id that a submitted and another registered record have, each record
    once: common_id, record, submitted, registered, class_id (the least of the id's records),
    n_submitted, n_registered.

    It says what `overlapping_ids` says, without a row for each pair. Null ids and records have no part."""
    side = lambda d, s: d.select(F.col(value).alias("common_id"), F.col(record).alias("record"), F.lit(s).alias("submitted"), F.lit(not s).alias("registered"))
    m = side(submitted, True).unionByName(side(registry, False)).filter("common_id is not null and record is not null")
    m = m.groupBy("common_id", "record").agg(F.bool_or("submitted").alias("submitted"), F.bool_or("registered").alias("registered"))
    n = m.groupBy("common_id").agg(F.min("record").alias("class_id"), F.count_if("submitted").alias("n_submitted"), F.count_if("registered").alias("n_registered"), F.count("*").alias("n"))
    return m.join(n.filter("n_submitted > 0 and n_registered > 0 and n > 1").drop("n"), "common_id").select("common_id", "record", "submitted", "registered", "class_id", "n_submitted", "n_registered")


def within(df: DataFrame, key: str, order: str) -> DataFrame:
    """J7, URL branch: (key, first, second): every later row with the first row of its key.

    Membership under the first row says the same as all pairs of a group, whose number
    would grow with the group's square; the first rows come from a partial aggregate."""
    rows = df.filter(F.col(key).isNotNull())
    first = rows.groupBy(key).agg(F.min(order).alias("first"))
    return rows.select(key, F.col(order).alias("second")).join(first, key).filter(F.col("second") > F.col("first")).select(key, "first", "second")


def in_release(records: DataFrame, threshold: int = 85, countries: bool = False) -> DataFrame:
    """First, second, match_type, name1, name2, score of records of one release that
    share a host or have similar names.

    records: position, host, names (array as given, perhaps with language tags), country if
    `countries`, which leaves out pairs whose countries are known and differ. Of the records
    with the same two names the first pair is reported, so that equal names give one row, not
    the square of their number; of a host each later record with the first one.
    """
    country = F.col("country") if countries else F.lit(None).cast("string")
    n = records.select("position", country.alias("country"), F.explode("names").alias("raw"))
    n = n.withColumn("name", text.normalize_text(text.clean_name(F.col("raw")))).filter((text.clean_name(F.col("raw")) != "") & F.col("name").isNotNull()).distinct()
    first = n.groupBy("raw", "name", "country").agg(F.min("position").alias("first"))
    later = n.join(first, (n["raw"] == first["raw"]) & n["country"].eqNullSafe(first["country"]) & (n["position"] > first["first"]), "left_semi")
    second = later.groupBy("raw", F.col("country").alias("c")).agg(F.min("position").alias("second")).withColumnRenamed("raw", "r")
    named = first.join(second, (first["raw"] == second["r"]) & first["country"].eqNullSafe(second["c"]), "left").drop("r", "c")
    near = similar_names(named, None, "name", threshold).select("name_a", "name_b", "score")
    near = near.unionByName(named.select(F.col("name").alias("name_a"), F.col("name").alias("name_b"), F.lit(100).alias("score")).distinct())
    side = lambda k: named.select(*(F.col(c).alias(f"{c}{k}") for c in ("raw", "country", "first", "second")), F.col("name").alias(f"name_{'ab'[k - 1]}"))
    d = near.join(side(1), "name_a").join(side(2), "name_b")
    d = d.filter((F.col("name_a") != F.col("name_b")) | (F.col("raw1") <= F.col("raw2")))
    if countries:
        d = d.filter((F.col("country1") == F.col("country2")) | F.col("country1").isNull() | F.col("country2").isNull())
    low, apart = F.least("first1", "first2"), F.col("first1") != F.col("first2")
    d = d.select("score", F.least("raw1", "raw2").alias("name1"), F.greatest("raw1", "raw2").alias("name2"), F.struct(low.alias("first"), F.when(apart, F.greatest("first1", "first2")).otherwise(F.least("second1", "second2")).alias("second")).alias("at"))
    d = d.filter("at.second is not null").groupBy("name1", "name2").agg(F.min("at").alias("at"), F.first("score").alias("score"))
    kind = F.when(F.col("score") == 100, "name_exact").otherwise("name_fuzzy")
    names = d.select("at.first", "at.second", kind.alias("match_type"), "name1", "name2", "score")
    none = F.lit(None).cast("string")
    hosts = within(records.select("host", "position"), "host", "position").select("first", "second", F.lit("url").alias("match_type"), none.alias("name1"), none.alias("name2"), F.lit(100).alias("score"))
    return names.unionByName(hosts)


def in_production(submitted: DataFrame, registry: DataFrame, threshold: int = 85) -> DataFrame:
    """Record, input_name, matched, matched_name, score: submitted names and the records
    of the same country with a similar name, each by its best name, the first of equals.

    submitted and registry: record, country, name (as given). No country, no match."""
    def sided(df: DataFrame) -> DataFrame:
        d = df.filter("country is not null").select("record", F.col("country").alias("block"), F.col("name").alias("raw"), text.normalize_text(text.clean_name(F.col("name"))).alias("name"))
        return d.filter(text.clean_name(F.col("raw")) != "").distinct()

    a, b = sided(submitted), sided(registry)
    near = similar_names(a, b, "name", threshold)
    # A submitted name is a class with the countries that it has; the best name of each record is
    # sought once for each class, so that what is shuffled does not grow with the number of pairs.
    a = a.groupBy("record", F.col("raw").alias("input_name"), F.col("name").alias("name_a")).agg(F.array_sort(F.collect_set("block")).alias("blocks"))
    classes = a.select("name_a", "blocks").distinct().select("name_a", "blocks", F.explode("blocks").alias("block")).join(near, ["name_a", "block"])
    known = b.select(F.col("record").alias("matched"), "block", F.col("raw").alias("matched_name"), F.col("name").alias("name_b"))
    best = F.min_by(F.struct("matched_name", "score"), F.struct(-F.col("score"), F.col("matched_name"))).alias("best")
    best = classes.join(known, ["name_b", "block"]).groupBy("name_a", "blocks", "matched").agg(best)
    key, same = F.struct("name_a", "blocks"), a.select("name_a", "blocks").distinct()
    near = same.select(key.alias("of_matched"), key.alias("of_input"))
    best = best.select(key.alias("of_matched"), "matched", "best.matched_name", "best.score")
    return paired(near, best, a.select(key.alias("of_input"), "record", "input_name"), "of_matched", "of_input").select("record", "input_name", "matched", "matched_name", "score")


def both_orders(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Every pair in either order, as the first schema's reports give them."""
    rest = [c for c in pairs.columns if c not in (a, b)]
    return pairs.select(a, b, *rest).unionByName(pairs.select(F.col(b).alias(a), F.col(a).alias(b), *rest))


def first_per_unordered_pair(df: DataFrame, a: str, b: str, *order: str) -> DataFrame:
    """Of the rows with the same unordered pair, the first."""
    fields = F.struct(*(F.col(c) for c in df.columns))
    return df.groupBy(F.least(a, b).alias("_a"), F.greatest(a, b).alias("_b")).agg(F.min_by(fields, F.struct(*order)).alias("_row")).select("_row.*")


# Values that many fields share.
COMMON_VALUES = ["related", "parent", "child", "predecessor", "successor"]


def ignored(value: Column, a: Column, b: Column, fmt: str = "json") -> Column:
    """A5: whether a value that two fields share says nothing. Fields are paths in JSON and
    column names in CSV."""
    two = lambda part: F.contains(a, F.lit(part)) & F.contains(b, F.lit(part))
    either = lambda x, y: F.contains(a, F.lit(x)) & F.contains(b, F.lit(y)) | F.contains(b, F.lit(x)) & F.contains(a, F.lit(y))
    shape = r"external_ids_(\d+)" if fmt == "json" else r"external_ids\.type\.(\w+)\."
    same = (F.regexp_extract(a, shape, 1) != "") & (F.regexp_extract(a, shape, 1) == F.regexp_extract(b, shape, 1))
    out = F.coalesce(value, F.lit("")).isin("", "null") | same & either("preferred", "all")
    if fmt == "csv":
        display, label = "names.types.ror_display", "names.types.label"
        return out | (a == display) & (b == label) | (a == label) & (b == display)
    types = two("types_") & (two("names_") | two("relationships_"))
    kinds = a.rlike(r"relationships_\d+_type$") & b.rlike(r"relationships_\d+_type$")
    return out | two("admin") | a.endswith("_lang") & b.endswith("_lang") | types | kinds | value.isin(COMMON_VALUES)


def first_repeated(eav: DataFrame) -> DataFrame:
    """(record, field, value, first_field): later fields of a record with the value of an
    earlier one, and that one, under the older check's rules. eav: record, position, path, value."""
    d = eav.filter("value <> ''")
    w = Window.partitionBy("record", "value").orderBy("position")  # a record's own fields
    d = d.withColumn("first_field", F.first("path").over(w)).withColumn("rank", F.row_number().over(w)).filter("rank > 1")
    a, b = F.col("path"), F.col("first_field")
    two = lambda part: F.contains(a, F.lit(part)) & F.contains(b, F.lit(part))
    either = F.contains(a, F.lit("preferred")) & F.contains(b, F.lit("all")) | F.contains(b, F.lit("preferred")) & F.contains(a, F.lit("all"))
    place = lambda c: F.regexp_extract(c, r"external_ids_(\d+)", 1)
    ids = (place(a) != "") & (place(a) == place(b)) & either
    skip = a.startswith("admin_") | b.startswith("admin_") | ids | a.endswith("_lang") & b.endswith("_lang") | two("relationships_") & two("_type") | two("names_") & two("types_")
    return d.filter(~skip).select("record", F.col("path").alias("field"), "value", "first_field")


def repeated_values(eav: DataFrame, record: str, field: str, value: str, fmt: str | None = None) -> DataFrame:
    """A5: (record, value, field1, field2) of every two fields of a record with one value; with
    a format, without those that its rules ignore. The rows are a record's own fields, whose
    number does not grow with the table."""
    a = eav.filter(F.col(value).isNotNull() & (F.col(value) != "")).select(record, value, F.col(field).alias("field1"))
    d = a.join(a.withColumnRenamed("field1", "field2"), [record, value]).filter(F.col("field1") < F.col("field2"))
    return d if fmt is None else d.filter(~ignored(F.col(value), F.col("field1"), F.col("field2"), fmt))
