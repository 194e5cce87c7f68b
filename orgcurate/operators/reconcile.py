"""Reconciliation of a dump in schema v1 with one in schema v2."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# External id types that are compared, by their names in schema v1.
EXTERNAL = ["ISNI", "FundRef", "Wikidata"]
TEXTS = "array<string>"


def _texts(values: Column) -> Column:
    """As sorted texts without nulls; null as empty."""
    return F.coalesce(F.array_sort(F.filter(values.cast(TEXTS), lambda x: x.isNotNull())), F.array().cast(TEXTS))


def _has(df: DataFrame, column: str, values: Column) -> Column:
    return _texts(values) if column in df.columns else F.array().cast(TEXTS)


def simplified_v1(df: DataFrame) -> dict[str, Column]:
    """Key to values of a v1 record; columns that the table lacks count as empty."""
    c = F.col
    out = {
        "status": lambda: c("status"), "types": lambda: F.transform("types", F.lower), "established": lambda: F.array("established"),
        "names.types.ror_display": lambda: F.array("name"), "names.types.alias": lambda: c("aliases"), "names.types.acronym": lambda: c("acronyms"),
        "names.types.label": lambda: F.array_append(F.transform(F.coalesce("labels", F.array()), lambda x: x["label"]) if "labels" in df.columns else F.array(), c("name")),
        "links.type.wikipedia": lambda: F.array(F.nullif("wikipedia_url", F.lit(""))), "links.type.website": lambda: c("links"),
    }
    of = {"names.types.ror_display": "name", "names.types.alias": "aliases", "names.types.acronym": "acronyms", "names.types.label": "name", "links.type.wikipedia": "wikipedia_url", "links.type.website": "links"}
    found = {k: (F.array(v()) if k == "status" else v()) if of.get(k, k) in df.columns else F.array() for k, v in out.items()}
    found["locations.geonames_id"] = F.transform("addresses", lambda a: a["geonames_city"]["id"]) if "addresses" in df.columns else F.array()
    for t in EXTERNAL:
        entry = F.try_element_at("external_ids", F.lit(t)) if "external_ids" in df.columns else None
        found[f"external_ids.type.{t.lower()}.preferred"] = F.array() if entry is None else F.array(entry["preferred"])
        found[f"external_ids.type.{t.lower()}.all"] = F.array() if entry is None else entry["all"]
    return {k: _texts(v) for k, v in found.items()}


def simplified_v2(df: DataFrame) -> dict[str, Column]:
    """The same keys of a v2 record."""
    of = lambda column, keep, value: F.transform(F.filter(column, keep), value) if column in df.columns else F.array()
    typed = lambda t: lambda x: x["type"] == t
    named = lambda t: lambda n: F.array_contains(n["types"], t)
    found = {"status": F.array("status"), "types": F.col("types") if "types" in df.columns else F.array(), "established": F.array("established")}
    for t in ("ror_display", "alias", "acronym", "label"):
        found[f"names.types.{t}"] = of("names", named(t), lambda n: n["value"])
    for t in ("wikipedia", "website"):
        found[f"links.type.{t}"] = of("links", typed(t), lambda x: x["value"])
    found["locations.geonames_id"] = of("locations", lambda x: F.lit(True), lambda x: x["geonames_id"])
    for t in map(str.lower, EXTERNAL):
        found[f"external_ids.type.{t}.preferred"] = of("external_ids", typed(t), lambda x: x["preferred"])
        all_of = of("external_ids", typed(t), lambda x: x["all"])
        found[f"external_ids.type.{t}.all"] = F.flatten(all_of) if "external_ids" in df.columns else F.array()
    return {k: _texts(v) for k, v in found.items()}


def reconciled(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Id, outcome (equal, different, only_v1, only_v2), all_values_equal, mismatched_keys, mismatched_values of every record.

    Values of a key are compared without order, with repetition; all values together without their keys. One join on id."""
    a, b = simplified_v1(v1), simplified_v2(v2)
    pair = lambda s: F.array(*(F.named_struct(F.lit("key"), F.lit(k), F.lit("values"), s[k]) for k in a))
    both = v1.select("id", pair(a).alias("a")).join(v2.select("id", pair(b).alias("b")), "id", "full_outer")
    off = F.filter(F.arrays_zip("a", "b"), lambda z: ~z["a"]["values"].eqNullSafe(z["b"]["values"]))
    every = lambda c: F.array_sort(F.filter(F.flatten(F.transform(c, lambda x: x["values"])), lambda v: v != ""))
    there = F.col("a").isNotNull() & F.col("b").isNotNull()
    said = lambda v: F.concat(F.lit("["), F.array_join(v, ", "), F.lit("]"))
    d = both.withColumn("off", F.when(there, off))
    outcome = F.when(F.col("b").isNull(), "only_v1").when(F.col("a").isNull(), "only_v2").when(F.size("off") == 0, "equal").otherwise("different")
    return d.select(
        "id", outcome.alias("outcome"), F.when(there, every("a").eqNullSafe(every("b"))).alias("all_values_equal"), F.array_join(F.transform("off", lambda z: z["a"]["key"]), "; ").alias("mismatched_keys"),
        F.array_join(F.transform("off", lambda z: F.concat(z["a"]["key"], F.lit(": "), said(z["a"]["values"]), F.lit(" != "), said(z["b"]["values"]))), "; ").alias("mismatched_values"),
    )
