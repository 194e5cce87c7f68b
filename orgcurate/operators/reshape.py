"""Flattening, wide tables and the crosswalk between schema versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text


def leaves(df: DataFrame, record: str, position: bool = False) -> DataFrame:
    """(record, path, value) of every scalar, however deep; list places are parts of the
    path; with `position` also the scalar's place in the record. The schema gives the plan: one
    expression for each nested column, one explode."""

    def of(c: Column, kind: T.DataType, path: Column) -> Column:
        if isinstance(kind, T.StructType):
            return F.flatten(F.array(*(of(c[f.name], f.dataType, F.concat(path, F.lit("_" + f.name))) for f in kind)))
        if isinstance(kind, T.ArrayType):
            return F.flatten(F.transform(F.coalesce(c, F.array().cast(kind)), lambda x, i: of(x, kind.elementType, F.concat(path, F.lit("_"), i.cast("string")))))
        return F.array(F.struct(path.alias("path"), c.cast("string").alias("value")))

    parts = [of(F.col(f"`{f.name}`"), f.dataType, F.lit(f.name)) for f in df.schema if f.name != record]
    rows = df.select(F.col(record).alias("record"), F.posexplode(F.flatten(F.array(*parts))).alias("position", "p"))
    return rows.select("record", *(["position"] if position else []), "p.*").filter("value is not null")


def inverted(eav: DataFrame) -> DataFrame:
    """(record, value, fields) with the sorted fields that have a value."""
    return eav.filter("value is not null and value <> ''").groupBy("record", "value").agg(F.array_join(F.array_sort(F.collect_set("path")), ",").alias("fields"))


def display_name(names: Column, kind: str = "ror_display") -> Column:
    """P5: the first name of that type, else empty."""
    return F.coalesce(F.get(F.filter(names, lambda n: F.array_contains(n["types"], kind)), F.lit(0))["value"], F.lit(""))


def first_link(links: Column, kind: str = "website") -> Column:
    return F.get(F.filter(links, lambda x: x["type"] == kind), F.lit(0))["value"]


def grouped_text(entries: Column, key: str = "key", value: str = "value") -> Column:
    """`key: a, b; key2: c` with keys in the order in which they come first."""
    keys = F.array_distinct(F.transform(entries, lambda e: e[key]))
    line = lambda k: F.concat(k, F.lit(": "), F.array_join(F.transform(F.filter(entries, lambda e: e[key] == k), lambda e: e[value]), ", "))
    return F.array_join(F.transform(keys, line), "; ")


def all_names(df: DataFrame, record: str, names: str = "names") -> DataFrame:
    """One row for each record, name and type."""
    d = df.select(F.col(record).alias("record"), F.explode(names).alias("n"))
    return d.select("record", F.col("n.value").alias("name"), F.explode("n.types").alias("type"))


# The fields that checks read from a record or a curation row, in order.
EXTRACTED = [
    "id", "status", "types", "names.types.ror_display", "names.types.acronym", "names.types.alias", "names.types.label", "links.type.website", "links.type.wikipedia",
    "established", "external_ids.type.isni.all", "external_ids.type.isni.preferred", "external_ids.type.wikidata.all", "external_ids.type.wikidata.preferred",
    "external_ids.type.fundref.all", "external_ids.type.fundref.preferred", "locations.geonames_id", "domains",
]
# The external ids of the two schemas, and the date columns' schema versions.
V1_ID_NAMES = {"fundref": "FundRef", "grid": "GRID", "isni": "ISNI", "wikidata": "Wikidata"}
VERSIONS = ("1.0", "2.0")
NONE = "array<string>"


def name_values(kind: str) -> Column:
    return F.transform(F.filter("names", lambda n: F.array_contains(n["types"], kind)), lambda n: n["value"])


def link_values(kind: str) -> Column:
    return F.transform(F.filter("links", lambda x: x["type"] == kind), lambda x: x["value"])


def external(kind: str) -> Column:
    return F.filter("external_ids", lambda e: e["type"] == kind)


def id_values(kind: str, part: str) -> Column:
    if part == "all":
        return F.flatten(F.transform(external(kind), lambda e: F.coalesce(e["all"], F.array().cast(NONE))))
    return F.filter(F.transform(external(kind), lambda e: e["preferred"]), lambda v: F.coalesce(v, F.lit("")) != "")


def one_or_none(x: Column) -> Column:
    return F.when(F.coalesce(x, F.lit("")) != "", F.array(x)).otherwise(F.array().cast(NONE))


def extracted(df: DataFrame) -> DataFrame:
    """P1, JSON side: the EXTRACTED fields of each record as lists of strings; lists that a
    record lacks are empty."""
    of = {
        "id": F.array(F.coalesce("id", F.lit(""))), "status": one_or_none(F.col("status")), "types": F.col("types"), "established": F.when(F.col("established").isNotNull(), F.array(F.col("established").cast("string"))), "domains": F.col("domains"),
        "locations.geonames_id": F.filter(F.transform("locations", lambda x: x["geonames_id"].cast("string")), lambda v: v.isNotNull()),
    } | {f"names.types.{k}": name_values(k) for k in ("ror_display", "acronym", "alias", "label")} | {f"links.type.{k}": link_values(k) for k in ("website", "wikipedia")}
    of |= {f"external_ids.type.{k}.{p}": id_values(k, p) for k in ("isni", "wikidata", "fundref") for p in ("all", "preferred")}
    return df.select(*(F.coalesce(of[c], F.array().cast(NONE)).alias(c) for c in EXTRACTED))


def extracted_csv(df: DataFrame) -> DataFrame:
    """P1, CSV side: cells cut at semicolons, but for the id, the status and the year."""
    def cell(c: str) -> Column:
        x = text.strip(F.coalesce(F.col(f"`{c}`"), F.lit(""))) if c in df.columns else F.lit("")
        parts = F.array(x) if c in ("id", "status", "established") else F.transform(F.split(x, ";"), text.strip)
        return F.filter(parts, lambda v: v != "").alias(c)

    return df.select(*map(cell, EXTRACTED))


def simplified(df: DataFrame) -> DataFrame:
    """Record, field, values and `all`, the distinct values of every field; Wikipedia
    addresses are normalised."""
    e = extracted(df)
    values = lambda c: F.transform(F.col(f"`{c}`"), text.normalize_wikipedia) if c == "links.type.wikipedia" else F.col(f"`{c}`")
    rest = [c for c in EXTRACTED if c != "id"]
    pairs = [F.struct(F.lit(c).alias("field"), values(c).alias("values")) for c in rest]
    every = F.struct(F.lit("all").alias("field"), F.array_distinct(F.flatten(F.array(*map(values, rest)))).alias("values"))
    return e.select(F.get("id", F.lit(0)).alias("record"), F.explode(F.array(*pairs, every)).alias("p")).select("record", "p.*")


def by_language(names: Column, value: str = "value", lang: str = "lang") -> Column:
    """`code: a, b; code2: c`; names without a language come under no_lang_code."""
    return grouped_text(F.transform(names, lambda n: F.struct(F.when(F.coalesce(n[lang], F.lit("")) != "", n[lang]).otherwise("no_lang_code").alias("key"), n[value].alias("value"))))


def by_type(relationships: Column) -> Column:
    return grouped_text(F.transform(relationships, lambda r: F.struct(r["type"].alias("key"), r["id"].alias("value"))))


def joined_or_null(values: Column, mark: str) -> Column:
    return F.when(F.size(values) > 0, F.array_join(values, mark))


# The place columns of the wide table, in order.
PLACE_COLUMNS = ["continent_code", "continent_name", "country_code", "country_name", "country_subdivision_code", "country_subdivision_name", "lat", "lng", "name"]


def wide_v2(df: DataFrame) -> DataFrame:
    """One row of 35 columns for each record of the second schema."""
    admin = [F.col(f"admin.{a}.{b}").alias(f"admin.{a}.{b}") for a in ("created", "last_modified") for b in ("date", "schema_version")]
    ids = [c.alias(f"external_ids.type.{k}.{p}") for k in V1_ID_NAMES for p, c in (("all", F.nullif(F.array_join(id_values(k, "all"), ";"), F.lit(""))), ("preferred", F.get(external(k), F.lit(0))["preferred"]))]
    place = F.get("locations", F.lit(0))
    places = [place["geonames_id"].alias("locations.geonames_id"), *(place["geonames_details"][c].alias(f"locations.geonames_details.{c}") for c in PLACE_COLUMNS)]
    of = lambda kind: F.filter("names", lambda n: F.array_contains(n["types"], kind))
    display = F.get(of("ror_display"), F.lit(0))
    return df.select(
        "id", *admin, joined_or_null(F.col("domains"), ";").alias("domains"), "established", *ids,
        *(F.array_join(link_values(k), ";").alias(f"links.type.{k}") for k in ("website", "wikipedia")), *places,
        *(by_language(of(k)).alias(f"names.types.{k}") for k in ("acronym", "alias", "label")), display["value"].alias("names.types.ror_display"),
        F.when(F.coalesce(display["lang"], F.lit("")) != "", display["lang"]).otherwise("no_lang_code").alias("ror_display_lang"),
        by_type(F.col("relationships")).alias("relationships"), "status", joined_or_null(F.col("types"), "; ").alias("types"),
    )


def wide_v1(df: DataFrame) -> DataFrame:
    """One row of 29 columns for each record of the first schema. Where the older script
    writes the first subdivision's values into the second's columns (B6), these hold their own,
    null, since the record has none."""
    place = F.get("addresses", F.lit(0))
    city = place["geonames_city"]
    none = F.lit(None).cast("string")
    kind = lambda k: F.col("external_ids")[k]
    ids = [c.alias(f"external_ids.{k}.{p}") for k in ("GRID", "ISNI", "FundRef", "Wikidata") for p, c in (("preferred", kind(k)["preferred"]), ("all", F.array_join(kind(k)["all"], ";")))]
    return df.select(
        "id", "name", joined_or_null(F.col("types"), "; ").alias("types"), "status", F.get("links", F.lit(0)).alias("links"), joined_or_null(F.col("aliases"), "; ").alias("aliases"),
        by_language(F.col("labels"), "label", "iso639").alias("labels"), joined_or_null(F.col("acronyms"), "; ").alias("acronyms"), "wikipedia_url", "established",
        place["lat"].alias("addresses[0].lat"), place["lng"].alias("addresses[0].lng"), city["city"].alias("addresses[0].geonames_city.name"), city["id"].alias("addresses[0].geonames_city.id"),
        city["geonames_admin1"]["name"].alias("addresses[0].geonames_city.geonames_admin1.name"), city["geonames_admin1"]["code"].alias("addresses[0].geonames_city.geonames_admin1.code"),
        none.alias("addresses[0].geonames_city.geonames_admin2.name"), none.alias("addresses[0].geonames_city.geonames_admin2.code"),
        F.col("country.country_code").alias("country.country_code"), F.col("country.country_name").alias("country.country_name"), *ids, by_type(F.col("relationships")).alias("relationships"),
    )


def to_v2(df: DataFrame, date: str | None = None) -> DataFrame:
    """P10: records of the first schema as the second one has them, lists sorted.

    Read are id, name, status, aliases, acronyms, labels, links, wikipedia_url, established and
    relationships, and where df has them types, external_ids, addresses and country. date is
    that of the file, for admin."""
    none = F.lit(None).cast("string")
    one = lambda v, kinds, lang=none: F.struct(v.alias("value"), F.array(*map(F.lit, kinds)).alias("types"), lang.alias("lang"))
    names = F.concat(F.array(one(F.col("name"), ["ror_display", "label"])), F.transform("aliases", lambda a: one(a, ["alias"])), F.transform("acronyms", lambda a: one(a, ["acronym"])), F.transform("labels", lambda x: one(x["label"], ["label"], x["iso639"])))
    link = lambda v, kind: F.struct(F.lit(kind).alias("type"), v.alias("value"))
    filled = F.filter("links", lambda v: F.coalesce(v, F.lit("")) != "")
    links = F.concat(F.transform(filled, lambda v: link(v, "website")), F.when(F.coalesce("wikipedia_url", F.lit("")) != "", F.array(link(F.col("wikipedia_url"), "wikipedia"))).otherwise(F.array().cast("array<struct<type:string,value:string>>")))
    has = lambda *cs: all(c in df.columns for c in cs)
    more = []
    if has("types"):
        more.append(F.array_sort(F.transform("types", F.lower)).alias("types"))
    if has("external_ids"):
        entry = lambda k, name: F.struct(F.lit(k).alias("type"), F.coalesce(F.col("external_ids")[name]["all"], F.array().cast(NONE)).alias("all"), F.col("external_ids")[name]["preferred"].alias("preferred"))
        filled_ids = F.filter(F.array(*(entry(k, name) for k, name in sorted(V1_ID_NAMES.items()))), lambda e: (F.size(e["all"]) > 0) | (F.coalesce(e["preferred"], F.lit("")) != ""))
        more.append(filled_ids.alias("external_ids"))
    if has("addresses", "country"):
        admin1 = lambda a: a["geonames_city"]["geonames_admin1"]
        details = lambda a: F.struct(none.alias("continent_code"), none.alias("continent_name"), F.col("country.country_code").alias("country_code"), F.col("country.country_name").alias("country_name"), F.regexp_replace(admin1(a)["code"], r"^[^.]*\.([^.]*).*$", "$1").alias("country_subdivision_code"), admin1(a)["name"].alias("country_subdivision_name"), a["lat"].alias("lat"), a["lng"].alias("lng"), a["geonames_city"]["city"].alias("name"))
        more.append(F.transform("addresses", lambda a: F.struct(a["geonames_city"]["id"].alias("geonames_id"), details(a).alias("geonames_details"))).alias("locations"))
    if date:
        at = lambda v: F.struct(F.lit(date).alias("date"), F.lit(v).alias("schema_version"))
        more += [F.struct(at(VERSIONS[0]).alias("created"), at(VERSIONS[1]).alias("last_modified")).alias("admin"), F.array().cast(NONE).alias("domains")]
    return df.select(
        "id", F.lower("status").alias("status"),
        F.transform(F.array_sort(F.transform(names, lambda n: F.struct(n["value"].alias("k"), n.alias("n")))), lambda x: x["n"]).alias("names"),
        F.array_sort(links).alias("links"), "established",
        F.array_sort(F.transform("relationships", lambda r: F.struct(r["id"].alias("id"), r["label"].alias("label"), F.lower(r["type"]).alias("type")))).alias("relationships"), *more,
    )


# The kinds of organizations that the first schema knows.
V1_TYPES = ["Archive", "Company", "Education", "Facility", "Government", "Healthcare", "Nonprofit", "Other"]


def to_v1(df: DataFrame) -> DataFrame:
    """The way back, as far as df has the fields; labels that are also the display name and
    types that the first schema lacks are left out, and of several places the first stays."""
    of = lambda kind: F.filter("names", lambda n: F.array_contains(n["types"], kind) & ~F.array_contains(n["types"], "ror_display"))
    more = []
    if "types" in df.columns:
        more.append(F.filter(F.transform("types", F.initcap), lambda t: t.isin(V1_TYPES)).alias("types"))
    if "external_ids" in df.columns:
        known = F.filter("external_ids", lambda e: e["type"].isin(list(V1_ID_NAMES)) & ((F.size(e["all"]) > 0) | (F.coalesce(e["preferred"], F.lit("")) != "")))
        renamed = lambda k: reduce(lambda acc, kv: F.when(k == kv[0], kv[1]).otherwise(acc), V1_ID_NAMES.items(), F.lit(None).cast("string"))
        first_only = lambda e: F.when(e["type"] == "grid", F.slice(e["all"], 1, 1)).otherwise(e["all"])
        more.append(F.map_from_entries(F.transform(known, lambda e: F.struct(renamed(e["type"]).alias("k"), F.struct(e["preferred"].alias("preferred"), first_only(e).alias("all")).alias("v")))).alias("external_ids"))
    if "locations" in df.columns:
        place = F.get("locations", F.lit(0))
        d = place["geonames_details"]
        admin1 = F.struct(d["country_subdivision_name"].alias("name"), F.when(F.coalesce(d["country_subdivision_code"], F.lit("")) != "", F.concat_ws(".", d["country_code"], d["country_subdivision_code"])).alias("code"))
        city = F.struct(place["geonames_id"].alias("id"), d["name"].alias("city"), admin1.alias("geonames_admin1"))
        more += [F.array(F.struct(d["lat"].alias("lat"), d["lng"].alias("lng"), city.alias("geonames_city"))).alias("addresses"), F.struct(d["country_code"].alias("country_code"), d["country_name"].alias("country_name")).alias("country")]
    return df.select(
        "id", display_name(F.col("names")).alias("name"), "status",
        F.transform(of("alias"), lambda n: n["value"]).alias("aliases"),
        F.transform(of("acronym"), lambda n: n["value"]).alias("acronyms"),
        F.transform(of("label"), lambda n: F.struct(n["value"].alias("label"), n["lang"].alias("iso639"))).alias("labels"),
        F.transform(F.filter("links", lambda x: x["type"] == "website"), lambda x: x["value"]).alias("links"),
        first_link(F.col("links"), "wikipedia").alias("wikipedia_url"), "established",
        F.transform("relationships", lambda r: F.struct(r["id"].alias("id"), r["label"].alias("label"), F.initcap(r["type"]).alias("type"))).alias("relationships"), *more,
    )


def with_last_modified(df: DataFrame, date: str, version: str | None = None) -> DataFrame:
    """Admin.last_modified set; the schema version too where given."""
    admin = F.col("admin").withField("last_modified.date", F.lit(date))
    return df.withColumn("admin", admin.withField("last_modified.schema_version", F.lit(version)) if version else admin)


def details_differ(old: Column, new: Column, required: list[str]) -> Column:
    """Whether JSON details have to be written anew: a key of the old ones has another value or
    another type of value in the new ones (1, 1.0 and "1" differ, null and absent do not), or the old
    ones lack a required key, null or not. Text that is no JSON object has no keys.
    After an inner join Spark may make it the condition of a sort-merge join, which fails: take a left join."""
    keyed = lambda x: F.coalesce(F.from_json(x, "map<string, variant>"), F.create_map().cast("map<string, variant>"))
    whole = lambda v: F.when(F.schema_of_variant(v) == "BIGINT", " whole").otherwise("")  # noqa: E731  1.0 is written as 1
    told = lambda m, k: F.nullif(F.concat(F.to_json(F.try_element_at(m, k)), whole(F.try_element_at(m, k))), F.lit("null"))
    lacks = reduce(lambda a, b: a | b, [~F.map_contains_key(keyed(old), k) for k in required], F.lit(False))
    return lacks | F.exists(F.map_keys(keyed(old)), lambda k: ~told(keyed(old), k).eqNullSafe(told(keyed(new), k)))


def address_changes(df: DataFrame, places: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Records whose place differs in any field from the dimension table."""
    new = places.select(key, F.struct(*fields).alias("_new"))
    differs = reduce(lambda a, b: a | b, [~F.col(f).eqNullSafe(F.col(f"_new.{f}")) for f in fields])
    return df.join(new, key).filter(differs)
