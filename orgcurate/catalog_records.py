"""Further registered queries: whole records of both schemas, reports on pairs of records,
issues, and the text functions, with their DuckDB SQL. Importing it adds them to the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .catalog import line_edges, query, read
from .functions import grammar, issues, text, vectorised
from .operators import duplicates, fields, history, languages, relations, releases, reshape
from .sources import files
from .sources.dealing import dealt


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and nations, dealt to many tasks: the table is small in bytes, and so read by few, next to what is made of it."""
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return dealt(read(spark, sf_dir, "customer"), "c_custkey").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows


def v2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole record of the second schema for each customer."""
    k = "cast(c_custkey as string)"
    return customers(spark, sf_dir).selectExpr(
        f"{k} AS id",
        "if(c_custkey % 3 = 0, 'inactive', 'active') AS status",
        "if(c_custkey % 4 = 0, array('funder', lower(c_mktsegment)), array(lower(c_mktsegment))) AS types",
        "if(c_custkey % 9 = 0, null, c_nationkey + 1900) AS established",
        f"if(c_custkey % 5 = 0, cast(array() as array<string>), array(concat('d', {k}, '.org'), 'x.org')) AS domains",
        "array(named_struct('value', c_name, 'types', array('ror_display', 'label'), 'lang', 'en'), named_struct('value', c_mktsegment, 'types', array('alias'), 'lang', if(c_custkey % 2 = 0, 'fr', null)), named_struct('value', substr(c_mktsegment, 1, 2), 'types', array('acronym'), 'lang', null), named_struct('value', n_name, 'types', array('label'), 'lang', 'en')) AS names",
        f"concat(array(named_struct('type', 'website', 'value', concat('https://x.org/', {k}))), if(c_custkey % 2 = 0, array(named_struct('type', 'wikipedia', 'value', concat('https://en.wikipedia.org/wiki/', n_name))), array())) AS links",
        f"if(c_custkey % 7 = 0, array(), array(named_struct('type', 'isni', 'all', array({k}, '0'), 'preferred', if(c_custkey % 3 = 0, {k}, null)), named_struct('type', 'fundref', 'all', array({k}), 'preferred', null))) AS external_ids",
        f"array(named_struct('geonames_id', cast(c_nationkey as bigint), 'geonames_details', named_struct('continent_code', 'C', 'continent_name', 'Cont', 'country_code', concat('N', cast(n_regionkey as string)), 'country_name', n_name, 'country_subdivision_code', 'S', 'country_subdivision_name', 'Sub', 'lat', cast(n_regionkey as double), 'lng', cast(c_nationkey as double), 'name', concat('City ', {k})))) AS locations",
        f"array(named_struct('id', concat({k}, 'a'), 'label', n_name, 'type', 'parent'), named_struct('id', concat({k}, 'b'), 'label', n_name, 'type', 'child'), named_struct('id', concat({k}, 'c'), 'label', n_name, 'type', 'parent')) AS relationships",
        "named_struct('created', named_struct('date', '2020-01-01', 'schema_version', '1.0'), 'last_modified', named_struct('date', '2021-02-03', 'schema_version', '2.0')) AS admin",
    )


def v1_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole record of the first schema for each customer."""
    k = "cast(c_custkey as string)"
    return customers(spark, sf_dir).selectExpr(
        f"{k} AS id", "c_name AS name", "'active' AS status", "array('Education', 'Other') AS types", "c_nationkey + 1900 AS established", "array(c_mktsegment) AS aliases",
        "array(substr(c_mktsegment, 1, 2)) AS acronyms", "array(named_struct('label', n_name, 'iso639', if(c_custkey % 2 = 0, 'en', null))) AS labels", f"array(concat('https://x.org/', {k})) AS links",
        "if(c_custkey % 2 = 0, concat('https://en.wikipedia.org/wiki/', n_name), null) AS wikipedia_url", "named_struct('country_code', concat('N', cast(n_regionkey as string)), 'country_name', n_name) AS country",
        f"array(named_struct('id', {k}, 'label', n_name, 'type', 'Parent'), named_struct('id', 'z', 'label', n_name, 'type', 'Child')) AS relationships",
        f"map('GRID', named_struct('preferred', concat('grid.', {k}), 'all', array(concat('grid.', {k}))), 'ISNI', named_struct('preferred', null, 'all', array('i', {k}))) AS external_ids",
        f"array(named_struct('lat', cast(n_regionkey as double), 'lng', cast(c_nationkey as double), 'geonames_city', named_struct('id', cast(c_nationkey as bigint), 'city', concat('City ', {k}), 'geonames_admin1', named_struct('name', 'Sub', 'code', 'N.S')))) AS addresses",
    )


def underscored(df: DataFrame) -> DataFrame:
    """Column names that SQL can compare without quotes, and array columns as text."""
    return df.select(*(F.col(f"`{f.name}`").cast("string").alias(f.name.replace(".", "_").replace("[0]", "")) if not f.dataType.typeName() == "array" else F.array_join(f"`{f.name}`", "|").alias(f.name.replace(".", "_")) for f in df.schema))


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 3 = 0 THEN 'inactive' ELSE 'active' END AS status, CASE WHEN c_custkey % 4 = 0 THEN 'funder|' ELSE '' END || lower(c_mktsegment) AS types,
        c_name AS names_types_ror_display, substr(c_mktsegment, 1, 2) AS names_types_acronym, c_mktsegment AS names_types_alias, c_name || '|' || n_name AS names_types_label, 'https://x.org/' || c_custkey AS links_type_website,
        CASE WHEN c_custkey % 2 = 0 THEN 'https://en.wikipedia.org/wiki/' || n_name ELSE '' END AS links_type_wikipedia, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE CAST(c_nationkey + 1900 AS VARCHAR) END AS established,
        CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_custkey || '|0' END AS external_ids_type_isni_all, CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE '' END AS external_ids_type_isni_preferred,
        '' AS external_ids_type_wikidata_all, '' AS external_ids_type_wikidata_preferred, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS external_ids_type_fundref_all, '' AS external_ids_type_fundref_preferred,
        CAST(c_nationkey AS VARCHAR) AS locations_geonames_id, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'd' || c_custkey || '.org|x.org' END AS domains FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def extract_fields(spark, sf_dir):  # P1
    return underscored(reshape.extracted(v2_records(spark, sf_dir)))


@query("""
    SELECT p_partkey, p_brand || '|' || p_type AS alias, 'x' || p_partkey AS id, '1999;2000' AS year FROM part""")
def extract_fields_csv(spark, sf_dir):  # P1
    p = read(spark, sf_dir, "part").select(F.concat(F.lit(" x"), "p_partkey", F.lit(" ")).alias("id"), F.concat("p_brand", F.lit(" ;; "), "p_type", F.lit("; ")).alias("names.types.alias"), F.lit("1999;2000").alias("established"))
    e = reshape.extracted_csv(p)
    return e.select(F.substring(F.get("id", F.lit(0)), 2, 20).cast("int").alias("p_partkey"), F.array_join("`names.types.alias`", "|").alias("alias"), F.array_join("id", "|").alias("id"), F.array_join("established", "|").alias("year"))


@query("""
    WITH c AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT CAST(c_custkey AS VARCHAR) AS record, 'names.types.label' AS field, c_name || '|' || n_name AS vals FROM c
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'links.type.wikipedia', CASE WHEN c_custkey % 2 = 0 THEN 'https://en.wikipedia.org/wiki/' || replace(n_name, ' ', '%20') ELSE '' END FROM c
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'all', array_to_string(list_sort(list_distinct(list_filter([CASE WHEN c_custkey % 3 = 0 THEN 'inactive' ELSE 'active' END, CASE WHEN c_custkey % 4 = 0 THEN 'funder' END, lower(c_mktsegment), c_name, substr(c_mktsegment, 1, 2), c_mktsegment, n_name, 'https://x.org/' || c_custkey,
        CASE WHEN c_custkey % 2 = 0 THEN 'https://en.wikipedia.org/wiki/' || replace(n_name, ' ', '%20') END, CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_nationkey + 1900 AS VARCHAR) END, CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey AS VARCHAR) END, CASE WHEN c_custkey % 7 <> 0 THEN '0' END,
        CAST(c_nationkey AS VARCHAR), CASE WHEN c_custkey % 5 <> 0 THEN 'd' || c_custkey || '.org' END, CASE WHEN c_custkey % 5 <> 0 THEN 'x.org' END], lambda v: v IS NOT NULL))), '|') FROM c""")
def simplify_json(spark, sf_dir):  # P3 X4
    d = reshape.simplified(v2_records(spark, sf_dir)).filter("field in ('names.types.label', 'links.type.wikipedia', 'all')")
    return d.select("record", "field", F.array_join(F.when(F.col("field") == "all", F.array_sort("values")).otherwise(F.col("values")), "|").alias("vals"))


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS id, '2020-01-01' AS admin_created_date, '1.0' AS admin_created_schema_version, '2021-02-03' AS admin_last_modified_date, '2.0' AS admin_last_modified_schema_version,
        CASE WHEN c_custkey % 5 <> 0 THEN 'd' || c_custkey || '.org;x.org' END AS domains, CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_nationkey + 1900 AS VARCHAR) END AS established,
        CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS external_ids_type_fundref_all, CAST(NULL AS VARCHAR) AS external_ids_type_fundref_preferred, CAST(NULL AS VARCHAR) AS external_ids_type_grid_all, CAST(NULL AS VARCHAR) AS external_ids_type_grid_preferred,
        CASE WHEN c_custkey % 7 <> 0 THEN c_custkey || ';0' END AS external_ids_type_isni_all, CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) END AS external_ids_type_isni_preferred,
        CAST(NULL AS VARCHAR) AS external_ids_type_wikidata_all, CAST(NULL AS VARCHAR) AS external_ids_type_wikidata_preferred, 'https://x.org/' || c_custkey AS links_type_website, CASE WHEN c_custkey % 2 = 0 THEN 'https://en.wikipedia.org/wiki/' || n_name ELSE '' END AS links_type_wikipedia,
        CAST(c_nationkey AS VARCHAR) AS locations_geonames_id, 'C' AS locations_geonames_details_continent_code, 'Cont' AS locations_geonames_details_continent_name, 'N' || n_regionkey AS locations_geonames_details_country_code, n_name AS locations_geonames_details_country_name,
        'S' AS locations_geonames_details_country_subdivision_code, 'Sub' AS locations_geonames_details_country_subdivision_name, n_regionkey || '.0' AS locations_geonames_details_lat, c_nationkey || '.0' AS locations_geonames_details_lng, 'City ' || c_custkey AS locations_geonames_details_name,
        'no_lang_code: ' || substr(c_mktsegment, 1, 2) AS names_types_acronym, CASE WHEN c_custkey % 2 = 0 THEN 'fr: ' ELSE 'no_lang_code: ' END || c_mktsegment AS names_types_alias, 'en: ' || c_name || ', ' || n_name AS names_types_label, c_name AS names_types_ror_display, 'en' AS ror_display_lang,
        'parent: ' || c_custkey || 'a, ' || c_custkey || 'c; child: ' || c_custkey || 'b' AS relationships, CASE WHEN c_custkey % 3 = 0 THEN 'inactive' ELSE 'active' END AS status, CASE WHEN c_custkey % 4 = 0 THEN 'funder; ' ELSE '' END || lower(c_mktsegment) AS types
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def wide_csv_v2(spark, sf_dir):  # P7: all 35 columns
    return underscored(reshape.wide_v2(v2_records(spark, sf_dir)))


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, 'Education; Other' AS types, 'active' AS status, 'https://x.org/' || c_custkey AS links, c_mktsegment AS aliases, CASE WHEN c_custkey % 2 = 0 THEN 'en: ' ELSE 'no_lang_code: ' END || n_name AS labels, substr(c_mktsegment, 1, 2) AS acronyms,
        CASE WHEN c_custkey % 2 = 0 THEN 'https://en.wikipedia.org/wiki/' || n_name END AS wikipedia_url, CAST(c_nationkey + 1900 AS VARCHAR) AS established, n_regionkey || '.0' AS addresses_lat, c_nationkey || '.0' AS addresses_lng, 'City ' || c_custkey AS addresses_geonames_city_name, CAST(c_nationkey AS VARCHAR) AS addresses_geonames_city_id,
        'Sub' AS addresses_geonames_city_geonames_admin1_name, 'N.S' AS addresses_geonames_city_geonames_admin1_code, CAST(NULL AS VARCHAR) AS addresses_geonames_city_geonames_admin2_name, CAST(NULL AS VARCHAR) AS addresses_geonames_city_geonames_admin2_code, 'N' || n_regionkey AS country_country_code, n_name AS country_country_name,
        'grid.' || c_custkey AS external_ids_GRID_preferred, 'grid.' || c_custkey AS external_ids_GRID_all, CAST(NULL AS VARCHAR) AS external_ids_ISNI_preferred, 'i;' || c_custkey AS external_ids_ISNI_all, CAST(NULL AS VARCHAR) AS external_ids_FundRef_preferred, CAST(NULL AS VARCHAR) AS external_ids_FundRef_all,
        CAST(NULL AS VARCHAR) AS external_ids_Wikidata_preferred, CAST(NULL AS VARCHAR) AS external_ids_Wikidata_all, 'Parent: ' || c_custkey || '; Child: z' AS relationships FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def wide_csv_v1(spark, sf_dir):  # P8: all 29 columns
    return underscored(reshape.wide_v1(v1_whole(spark, sf_dir)))


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS id, 'education|other' AS types, 'grid:grid.' || c_custkey || '/grid.' || c_custkey || '|isni:i,' || c_custkey || '/' AS ids, c_nationkey || ':N' || n_regionkey || ':' || n_name || ':S:Sub:City ' || c_custkey AS place, '2024-01-01 1.0 2.0' AS dates
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def crosswalk_v1_v2_places(spark, sf_dir):  # P10: types, external ids, places, admin
    d = reshape.to_v2(v1_whole(spark, sf_dir), "2024-01-01")
    ids = F.transform("external_ids", lambda e: F.concat(e["type"], F.lit(":"), F.array_join(e["all"], ","), F.lit("/"), F.coalesce(e["preferred"], F.lit(""))))
    x = F.get("locations", F.lit(0))
    place = F.concat_ws(":", x["geonames_id"].cast("string"), *(x["geonames_details"][c] for c in ("country_code", "country_name", "country_subdivision_code", "country_subdivision_name", "name")))
    return d.select("id", F.array_join("types", "|").alias("types"), F.array_join(ids, "|").alias("ids"), place.alias("place"), F.concat_ws(" ", "admin.created.date", "admin.created.schema_version", "admin.last_modified.schema_version").alias("dates"))


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS id, '' AS types, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'ISNI=' || c_custkey || ',0/' || CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE '' END || '|FundRef=' || c_custkey || '/' END AS ids,
        'N' || n_regionkey || ' ' || n_name AS country, c_nationkey || ' City ' || c_custkey || ' Sub N' || n_regionkey || '.S' AS place FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def crosswalk_v2_v1_places(spark, sf_dir):  # P11: types (none of these is one of the first schema), external ids, places
    d = reshape.to_v1(v2_records(spark, sf_dir))
    entry = lambda k: F.when(F.col("external_ids")[k].isNotNull(), F.concat(F.lit(k + "="), F.array_join(F.col("external_ids")[k]["all"], ","), F.lit("/"), F.coalesce(F.col("external_ids")[k]["preferred"], F.lit(""))))
    a = F.get("addresses", F.lit(0))["geonames_city"]
    return d.select("id", F.array_join("types", "|").alias("types"), F.concat_ws("|", entry("ISNI"), entry("FundRef")).alias("ids"), F.concat_ws(" ", "country.country_code", "country.country_name").alias("country"), F.concat_ws(" ", a["id"].cast("string"), a["city"], a["geonames_admin1"]["name"], a["geonames_admin1"]["code"]).alias("place"))


LCS = """
    t AS (
        SELECT name_a, name_b, 0 AS i, list_transform(range(0, length(name_b) + 1), lambda z: CAST(0 AS BIGINT)) AS v FROM c
        UNION ALL
        SELECT name_a, name_b, i + 1, list_reduce(range(1, length(name_b) + 1), lambda acc, j: list_append(acc, CASE WHEN substr(name_b, j, 1) = substr(name_a, i + 1, 1) THEN v[j] + 1 ELSE greatest(v[j + 1], acc[len(acc)]) END), CAST([0] AS BIGINT[])) FROM t WHERE i < length(name_a)),
    s AS (SELECT name_a, name_b, CAST(round_even(200.0 * v[len(v)] / (length(name_a) + length(name_b)), 0) AS INT) AS score FROM t WHERE i = length(name_a))"""
TAGGED = "CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) || '*en' ELSE p_name END"


def part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.upper("p_name"), F.lit("*en"))).otherwise(F.col("p_name"))
    host = F.when(F.col("p_partkey") % 100 == 0, F.lit("shared.org")).otherwise(F.concat(F.lit("h"), F.col("p_partkey").cast("string")))
    country = F.when(F.col("p_partkey") % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("c"), (F.col("p_partkey") % 4).cast("string")))
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("position"), host.alias("host"), F.array(raw).alias("names"), country.alias("country"))


def release_pairs(country: str, rule: str, score: int) -> str:
    return f"""
    WITH RECURSIVE n AS (SELECT p_partkey AS pos, {TAGGED} AS raw, lower(p_name) AS name, {country} AS country FROM part),
    f AS (SELECT raw, name, country, list_sort(list(pos)) AS spots FROM n GROUP BY raw, name, country),
    d AS (SELECT DISTINCT name FROM f),
    c AS (SELECT a.name AS name_a, b.name AS name_b FROM d a JOIN d b ON a.name < b.name AND levenshtein(a.name, b.name) <= 0.155 * (length(a.name) + length(b.name))), {LCS},
    p AS (SELECT * FROM s WHERE score >= {score} UNION ALL SELECT name, name, 100 FROM d),
    x AS (SELECT least(a.raw, b.raw) AS name1, greatest(a.raw, b.raw) AS name2, score, a.spots[1] AS f1, b.spots[1] AS f2, a.spots[2] AS s1, b.spots[2] AS s2 FROM p JOIN f a ON a.name = name_a JOIN f b ON b.name = name_b WHERE (name_a <> name_b OR a.raw <= b.raw) AND {rule}),
    y AS (SELECT name1, name2, score, least(f1, f2) AS first, CASE WHEN f1 <> f2 THEN greatest(f1, f2) ELSE least(s1, s2) END AS second FROM x),
    z AS (SELECT name1, name2, any_value(score) AS score, min([first, second]) AS pair FROM y WHERE second IS NOT NULL GROUP BY name1, name2)
    SELECT CAST(pair[1] AS BIGINT) AS first, CAST(pair[2] AS BIGINT) AS second, CASE WHEN score = 100 THEN 'name_exact' ELSE 'name_fuzzy' END AS match_type, name1, name2, score FROM z"""


@query(release_pairs("NULL", "true", 85) + """
    UNION ALL SELECT 0, p_partkey, 'url', NULL, NULL, 100 FROM part WHERE p_partkey % 100 = 0 AND p_partkey > 0""")
def in_release_records(spark, sf_dir):  # J7 W5: records, exact names, the URL branch
    return duplicates.in_release(part_records(spark, sf_dir))


@query(release_pairs("CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'c' || p_partkey % 4 END", "(a.country = b.country OR a.country IS NULL OR b.country IS NULL)", 90))
def in_release_countries(spark, sf_dir):  # J9: threshold 90, countries that are known and differ are no pair
    return duplicates.in_release(part_records(spark, sf_dir).withColumn("host", F.lit(None).cast("string")), 90, True)


@query(f"""
    WITH RECURSIVE d AS (SELECT DISTINCT lower(p_name) AS name FROM part),
    c AS (SELECT a.name AS name_a, b.name AS name_b FROM d a JOIN d b ON a.name < b.name AND levenshtein(a.name, b.name) <= 0.155 * (length(a.name) + length(b.name))), {LCS}
    SELECT name_a, name_b, score FROM s WHERE score >= 85 UNION ALL SELECT name_b, name_a, score FROM s WHERE score >= 85""")
def in_release_both_orders(spark, sf_dir):  # J10
    return duplicates.both_orders(duplicates.similar_names(read(spark, sf_dir, "part").select(F.lower("p_name").alias("name")), None, "name", 85), "name_a", "name_b")


@query(f"""
    WITH RECURSIVE n AS (SELECT p_partkey, {TAGGED} AS raw, lower(p_name) AS name, p_brand FROM part),
    c AS (SELECT DISTINCT a.name AS name_a, b.name AS name_b FROM n a JOIN n b ON a.p_brand = b.p_brand AND a.p_partkey % 2 = 0 AND b.p_partkey % 2 = 1 AND levenshtein(a.name, b.name) <= 0.155 * (length(a.name) + length(b.name))), {LCS}
    SELECT a.p_partkey AS record, a.raw AS input_name, b.p_partkey AS matched, b.raw AS matched_name, score FROM s JOIN n a ON a.name = name_a JOIN n b ON b.name = name_b AND a.p_brand = b.p_brand WHERE score >= 85 AND a.p_partkey % 2 = 0 AND b.p_partkey % 2 = 1""")
def prod_dup_record(spark, sf_dir):  # J8: with record and country
    raw = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.upper("p_name"), F.lit("*en"))).otherwise(F.col("p_name"))
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("record"), F.col("p_brand").alias("country"), raw.alias("name"))
    return duplicates.in_production(p.filter("record % 2 = 0"), p.filter("record % 2 = 1"))


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 3 = 0 THEN 'es' ELSE 'en' END || '|' || CASE WHEN c_custkey % 5 = 0 THEN 'de' WHEN c_custkey % 2 = 0 THEN 'fr' ELSE '-' END || '|-|en' AS langs FROM customer""")
def label_languages(spark, sf_dir):  # J17: the last of two given languages wins
    d = v2_records(spark, sf_dir)
    given = d.filter("cast(id as int) % 3 = 0").selectExpr("id", "names[0].value AS name", "explode(array(struct(1 AS position, 'pt' AS lang), struct(2 AS position, 'es' AS lang))) AS g").select("id", "name", "g.lang", "g.position")
    given = given.unionByName(d.filter("cast(id as int) % 5 = 0").selectExpr("id", "names[1].value AS name", "'de' AS lang", "1 AS position"))
    return languages.relabelled_names(d, given).select("id", F.array_join(F.transform("names", lambda n: F.coalesce(n["lang"], F.lit("-"))), "|").alias("langs"))


def paths(spark: SparkSession, sf_dir: str, position: bool = False) -> DataFrame:
    return reshape.leaves(v2_records(spark, sf_dir).drop("admin", "locations", "domains"), "id", position)


# What repeats within these records: the label's language, an isni under all and preferred, and the id in two lists of external ids.
@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS record, CAST(c_custkey AS VARCHAR) AS value, unnest(CASE WHEN c_custkey % 3 = 0 THEN ['external_ids_0_all_0', 'external_ids_0_preferred'] ELSE ['external_ids_0_all_0'] END) AS field1, 'external_ids_1_all_0' AS field2 FROM customer WHERE c_custkey % 7 <> 0
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), n_name, x[1], x[2] FROM customer JOIN nation ON c_nationkey = n_nationkey, unnest([['names_3_value', 'relationships_0_label'], ['names_3_value', 'relationships_1_label'], ['names_3_value', 'relationships_2_label'], ['relationships_0_label', 'relationships_1_label'], ['relationships_0_label', 'relationships_2_label'], ['relationships_1_label', 'relationships_2_label']]) AS u(x)""")
def duplicate_values_ignored(spark, sf_dir):  # A5 with the rules of what to ignore
    return duplicates.repeated_values(paths(spark, sf_dir).withColumnRenamed("path", "field"), "record", "field", "value", "json").select("record", "value", "field1", "field2")


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS record, 'external_ids_1_all_0' AS field, CAST(c_custkey AS VARCHAR) AS value, 'external_ids_0_all_0' AS first_field FROM customer WHERE c_custkey % 7 <> 0
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), unnest(['relationships_0_label', 'relationships_1_label', 'relationships_2_label']), n_name, 'names_3_value' FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def first_repeated_values(spark, sf_dir):  # A6
    return duplicates.first_repeated(paths(spark, sf_dir, True))


@query("""
    WITH w AS (SELECT CAST(l_suppkey AS VARCHAR) AS affiliation, CAST(l_partkey AS VARCHAR) AS work, CAST(l_orderkey % 100 AS VARCHAR) AS author FROM lineitem)
    SELECT affiliation, array_to_string(list_sort(list(DISTINCT work))[1:10], '; ') AS works, count(DISTINCT work) AS n_works, count(DISTINCT author) AS n_authors FROM w GROUP BY affiliation""")
def affiliation_usage(spark, sf_dir):  # A9
    return languages.usage(read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("affiliation"), F.col("l_partkey").cast("string").alias("work"), (F.col("l_orderkey") % 100).cast("string").alias("author")))


@query("""
    SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'invalid format' WHEN 2 THEN 'incompatible change type' WHEN 3 THEN 'invalid change type|invalid field name' WHEN 4 THEN 'incompatible change type' ELSE 'incompatible change type' END AS errors FROM part""")
def v1_update_errors(spark, sf_dir):  # F19
    cells = ["change.name==x;add.aliases==y;", "add aliases", "add.name==x", "put.title==x", "replace.status==x;delete.links==a", "change.links==x"]
    cell = F.element_at(F.array(*map(F.lit, cells)), (F.col("p_partkey") % 6).cast("int") + 1)
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(fields.v1_update_errors(cell), "|").alias("errors"))


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, 'ISNI' AS field, v AS value FROM customer, unnest(['i', CAST(c_custkey AS VARCHAR)]) AS u(v)""")
def v1_id_errors(spark, sf_dir):  # F20
    return fields.v1_id_errors(v1_whole(spark, sf_dir).select("id", "name", "external_ids"))


@query("""
    SELECT p_partkey, [NULL, 'id contains white space', 'id has another address', 'id has the wrong shape', NULL][p_partkey % 5 + 1] AS id_error, [NULL, 'several tag marks', 'empty language tag', 'language code is not two letters', 'unknown language code', NULL][p_partkey % 6 + 1] AS name_error,
        ['no language tag', NULL, 'unknown language code'][p_partkey % 3 + 1] AS tag_error, [NULL, 'type not allowed'][p_partkey % 2 + 1] AS type_error, ['acronym not upper case', NULL][p_partkey % 2 + 1] AS acronym_error, ['city is empty', NULL][p_partkey % 2 + 1] AS empty_error, [NULL, 'id contains white space', 'id has another address', 'id has the wrong shape', 'city is empty'][p_partkey % 5 + 1] AS first_error FROM part""")
def field_checks(spark, sf_dir):  # F2 F3 F4 F7 F8 F11 F12
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("p_partkey") % len(values)).cast("int") + 1)
    ids = of(["https://reg.org/012345678", "https://reg.org/01234 5678", "http://x.org/012345678", "https://reg.org/112345678", ""])
    names = of(["A*en", "A*en*fr", "A*", "A*eng", "A*qq", "A"])
    id_error = fields.id_error(ids, "https://reg.org/")
    city = F.when(F.col("p_partkey") % 5 == 4, "").otherwise("x")
    return read(spark, sf_dir, "part").select(
        "p_partkey", id_error.alias("id_error"), fields.name_format_error(names).alias("name_error"), fields.name_error(of(["A", "A*en", "A*qq"])).alias("tag_error"), fields.type_error(of(["Education (x)", "club"])).alias("type_error"),
        fields.acronym_error(of(["ab*en", "AB 1*en"])).alias("acronym_error"), fields.empty_error(of([" ", "x"]), "city").alias("empty_error"), fields.first_error(id_error, fields.empty_error(city, "city")).alias("first_error"),
    )


@query("""
    SELECT o_orderkey AS number FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' AND o_orderkey % 5 <> 0 AND o_orderkey >= 100 ORDER BY number""")
def issues_wanted(spark, sf_dir):  # S19 T8
    labels = F.when(F.col("o_orderkey") % 5 == 0, F.array("o_orderpriority", F.lit("done"))).otherwise(F.array("o_orderpriority"))
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("number"), F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"), labels.alias("labels"))
    return issues.wanted(o, "1-URGENT", "done", 100)


@query("SELECT p_partkey AS number, p_name AS title FROM part WHERE contains(lower(p_name), 'al') AND p_partkey BETWEEN 20 AND 900")
def issues_selected(spark, sf_dir):  # S20
    return issues.selected(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("number"), F.col("p_name").alias("title")), "AL", 20, 900)


@query(r"""
    SELECT c_custkey, 'a b ' || c_mktsegment AS spaces, 'https://en.wikipedia.org/wiki/' || replace(n_name, ' ', '%20') || '%C3%A9' AS wiki, 'https://en.wikipedia.org/wiki/' || replace(n_name, ' ', '%20') || '%C3%A9' AS tail, c_name AS clean, lower(replace(n_name, '-', ' ')) AS words, 'h' || c_custkey || '.org' AS host,
        'A' || chr(10) || 'b' AS printable, lower(replace(n_name, ' ', '')) AS key, 'https://doi.org/10.13039/50110000' || c_custkey AS funder, 'https://isni.org/isni/0000000' || c_custkey AS isni, repeat('x', 97) || '...' AS short, CAST(c_custkey AS INT) AS minor, DATE '2024-01-05' AS day FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def text_functions(spark, sf_dir):  # X3 X4 X5 X6 X11 X12 X14 X17 X25 X26 X27 X31
    k, n = F.col("c_custkey").cast("string"), F.col("n_name")
    url = F.concat(F.lit("https://en.wikipedia.org/wiki/"), n, F.lit("é"))
    return customers(spark, sf_dir).select(
        "c_custkey", text.normalize_whitespace(F.concat(F.lit(" a \t b\n "), "c_mktsegment", F.lit(" "))).alias("spaces"), text.normalize_wikipedia(F.regexp_replace(url, "https", "http")).alias("wiki"), text.quote_tail(url).alias("tail"),
        text.clean_name(F.concat("c_name", F.lit(" *en"))).alias("clean"), text.hyphens_to_spaces(n).alias("words"), text.normalize_host(F.concat(F.lit("WWW.h"), k, F.lit(".ORG:80/x"))).alias("host"), text.make_printable(F.lit("A​\u0007\nb")).alias("printable"),
        text.compare_key(n).alias("key"), text.funder_link(F.concat(F.lit("10.13039/50110000"), k)).alias("funder"), text.isni_link(F.concat(F.lit("0000 000"), k)).alias("isni"), text.truncated(F.repeat(F.lit("x"), 101)).alias("short"),
        text.version(F.concat(F.lit("v1."), k, F.lit("-2024"))).getField("minor").alias("minor"), text.release_date(F.concat(F.lit("v1."), k, F.lit("-2024-01-05-data.zip"))).alias("day"),
    )


@query("""
    SELECT c_custkey, array_to_string(list_transform(list_sort(list_distinct([{'k': -length(c_name), 'v': c_name}, {'k': -length(n_name), 'v': n_name}, {'k': -length(c_mktsegment), 'v': c_mktsegment}, {'k': -length(n_name), 'v': n_name}])), lambda x: x.v), '|') AS names FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def longest_names(spark, sf_dir):  # T5
    return customers(spark, sf_dir).select("c_custkey", F.array_join(languages.longest_first(F.array("c_name", "n_name", "c_mktsegment", "n_name")), "|").alias("names"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') ORDER BY md5('7:' || o_orderkey), o_orderkey LIMIT 500")
def sample_rest(spark, sf_dir):  # T7: of those not processed; the limit is the operator
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return history.stable_sample(o.drop("o_orderstatus"), "o_orderkey", 500, 7, o.filter("o_orderstatus = 'F'"))


@query("""
    WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rank, count(*) OVER () AS many FROM orders), d AS (SELECT CAST(draw AS BIGINT) AS draw, CAST('0x' || left(md5('3:' || draw), 8) AS BIGINT) AS h FROM range(500) t(draw))
    SELECT draw, o_orderkey FROM d JOIN r ON h % many = rank""")
def sample_with_replacement(spark, sf_dir):  # T6: the number of draws is the operator
    return history.sample_with_replacement(read(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 500, 3)


@query("""
    WITH e AS (SELECT CAST(c_custkey AS VARCHAR) AS record, unnest([{'f': 'name', 'v': c_name}, {'f': 'place', 'v': n_name}, {'f': 'seat', 'v': n_name}]) AS p FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT record, p.v AS value, string_agg(p.f, ',' ORDER BY p.f) AS fields FROM e GROUP BY record, p.v""")
def inverted_index(spark, sf_dir):  # P4
    d = customers(spark, sf_dir).select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("n_name").alias("place"), F.col("n_name").alias("seat"))
    return reshape.inverted(reshape.leaves(d, "id"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_custkey = 7")
def reverse_lookup(spark, sf_dir):  # J2
    return releases.reachable_from(v2_records(spark, sf_dir), "7a").select("id")


@query("""
    WITH e AS (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem) SELECT arg_min(a, (a, b)) AS a, arg_min(b, (a, b)) AS b FROM e GROUP BY least(a, b), greatest(a, b)""")
def first_pairs(spark, sf_dir):  # W5
    return duplicates.first_per_unordered_pair(line_edges(spark, sf_dir).select(F.col("record").alias("a"), F.col("related").alias("b")).distinct(), "a", "b", "a", "b")


@query("""
    WITH k AS (SELECT p_partkey AS id FROM part WHERE p_partkey % 3 <> 0) SELECT l_partkey AS record, l_suppkey AS related, count(*) AS n FROM lineitem WHERE l_partkey IN (SELECT id FROM k) AND l_suppkey IN (SELECT id FROM k) GROUP BY ALL""")
def edges_without_missing(spark, sf_dir):  # O12
    known = read(spark, sf_dir, "part").filter("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("record"))
    return relations.without_missing(line_edges(spark, sf_dir), known).groupBy("record", "related").agg(F.count("*").alias("n"))


@query("""
    WITH RECURSIVE h AS (SELECT p_partkey AS node, CASE WHEN p_partkey % 500 <> 0 AND p_partkey > 1 THEN p_partkey - 1 END AS parent FROM part),
    r AS (SELECT node, node AS root FROM h WHERE parent IS NULL UNION ALL SELECT h.node, r.root FROM h JOIN r ON h.parent = r.node) SELECT node, root FROM r""")
def hierarchy_roots(spark, sf_dir):  # X28: chains of up to 500 nodes
    h = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"), F.when((F.col("p_partkey") % 500 != 0) & (F.col("p_partkey") > 1), F.col("p_partkey") - 1).alias("parent"))
    return relations.parents(h)


@query("""
    SELECT o_custkey, array_to_string(list_transform(list_reverse_sort(list({'s': o_totalprice, 'v': o_orderkey}))[1:5], lambda x: x.v), '|') AS best FROM orders GROUP BY o_custkey""")
def top_five(spark, sf_dir):  # T3 T4
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), F.desc("o_orderkey"))  # cut to five by each task before it is sorted together
    first = read(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderkey", F.row_number().over(w).alias("rank")).filter("rank <= 5")
    g = first.groupBy("o_custkey").agg(F.collect_list(F.struct("o_totalprice", "o_orderkey")).alias("v"))
    return g.select("o_custkey", F.array_join(F.transform(languages.top(F.col("v"), 5), lambda x: x["o_orderkey"].cast("string")), "|").alias("best"))


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 2 = 0 THEN '2019-01-01' ELSE '2020-01-01' END AS created, '2030-01-01 2.1' AS modified, array_to_string(list_sort(CASE WHEN c_custkey % 7 <> 0 OR c_custkey % 4 = 0 THEN ['funder', lower(c_mktsegment)] ELSE [lower(c_mktsegment)] END), '|') AS types, CASE WHEN c_nationkey = 3 THEN 99 ELSE c_nationkey END AS place FROM customer""")
def record_mutations(spark, sf_dir):  # P13 P14 P16
    d = v2_records(spark, sf_dir)
    dates = d.filter("cast(id as int) % 2 = 0").select("id", F.lit("2019-01-01").alias("created"), F.lit(None).cast("string").alias("last_modified"))
    d = reshape.with_last_modified(releases.with_dates(releases.with_places_renumbered(releases.with_funder_type(d), {3: 99}), dates), "2030-01-01", "2.1")
    types = F.array_sort("types")
    return d.select("id", F.col("admin.created.date").alias("created"), F.concat_ws(" ", "admin.last_modified.date", "admin.last_modified.schema_version").alias("modified"), F.array_join(types, "|").alias("types"), F.get("locations", F.lit(0))["geonames_id"].cast("int").alias("place"))


@query("SELECT c_custkey, c_nationkey, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2")
def address_refresh(spark, sf_dir):  # P15: places of one region have a new name
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.when(F.col("n_regionkey") == 2, F.lower("n_name")).otherwise(F.col("n_name")).alias("country"))
    c = customers(spark, sf_dir).select("c_custkey", "c_nationkey", F.col("n_name").alias("country"))
    return reshape.address_changes(c, n, "c_nationkey", ["country"]).select("c_custkey", "c_nationkey", "country")


@query("""
    SELECT p_partkey, 'https://reg.org/0' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') || '11' AS ids, 'https://reg.org/0' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') || '11:Parent' AS edges, 'Related organizations: https://reg.org/0' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') || '11 (parent)' || chr(10) || 'Organization type: ' || p_type AS kept, p_type AS kind FROM part""")
def issue_ids(spark, sf_dir):  # J22 O11 X20
    i = F.concat(F.lit("https://reg.org/0"), F.lpad(F.col("p_partkey").cast("string"), 6, "0"), F.lit("11"))
    body = F.concat(F.lit("Related organizations: "), i, F.lit(" (parent)\nOrganization type: "), "p_type")
    d = read(spark, sf_dir, "part").select("p_partkey", body.alias("b"))
    edges = F.transform(issues.related(F.col("b")), lambda r: F.concat_ws(":", r["related"], r["type"]))
    invented = F.concat(F.col("b"), F.lit("\nhttps://reg.org/0zzzzzz99"))
    return d.select("p_partkey", F.array_join(issues.record_ids(F.col("b")), "|").alias("ids"), F.array_join(edges, "|").alias("edges"), issues.without_invented(F.col("b"), invented).alias("kept"), issues.organization_type(F.col("b")).alias("kind"))


@query("""
    SELECT p_partkey, 'names.alias:add==' || p_brand || ';status:replace==x' AS from_issue, 'names.alias.add==' || p_brand || ';' || p_type || ' | status.replace==x' AS merged FROM part""")
def issue_updates(spark, sf_dir):  # G5 G6
    p = read(spark, sf_dir, "part")
    given = F.concat(F.lit("names.alias.add=="), "p_brand", F.lit(" | status.replace==x | note"))
    encoded = F.concat(F.lit("names.alias.add=="), "p_brand", F.lit(" | status.replace==x | names.alias.add=="), "p_type", F.lit(" | names.alias.add=="), "p_brand")
    return p.select("p_partkey", grammar.from_issue(given).alias("from_issue"), grammar.merged_updates(encoded).alias("merged"))


@query("SELECT o_custkey AS record, string_agg(o_orderstatus, '|' ORDER BY o_orderkey) AS changes FROM orders GROUP BY o_custkey")
def updates_by_record(spark, sf_dir):  # A13
    u = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("record"), F.col("o_orderkey").alias("position"), F.lit("status").alias("field"), F.lit("replace").alias("op"), F.col("o_orderstatus").alias("value"))
    return releases.updates_by_record(u).select("record", F.array_join(F.transform("changes", lambda c: c["value"]), "|").alias("changes"))


@query("""
    WITH w AS (SELECT DISTINCT p_name, string_split(lower(p_name), ' ') AS a FROM part)
    SELECT p_name, array_to_string(list_distinct_ordered, '|') AS found FROM (SELECT p_name, list_filter([upper(array_to_string(list_transform(a, lambda x: left(x, 1)), '')), upper(array_to_string(list_transform(a, lambda x: left(x, 2)), '')), upper(array_to_string(list_transform(a, lambda x: left(x, 3)), '')), ''], lambda x: true) AS list_distinct_ordered FROM w)""")
def acronym_candidates(spark, sf_dir):  # X24
    return read(spark, sf_dir, "part").select("p_name").distinct().select("p_name", F.array_join(languages.initials(F.lower("p_name")), "|").alias("found"))


@query("""
    SELECT '0 counts' AS part, '0' AS place, '- **Total organizations**: ' || (SELECT count(*) FROM supplier WHERE s_suppkey % 5 <> 0) + (SELECT count(*) FROM supplier WHERE s_suppkey % 5 = 0) AS line UNION ALL SELECT '0 counts', '1', '- **Records added**: ' || (SELECT count(*) FROM supplier WHERE s_suppkey % 5 = 0)
    UNION ALL SELECT '0 counts', '2', '- **Records updated**: ' || (SELECT count(*) FROM supplier WHERE s_suppkey % 5 = 1) UNION ALL SELECT '1 added', CAST(s_suppkey AS VARCHAR), s_suppkey || '|' || s_name FROM supplier WHERE s_suppkey % 5 = 0 UNION ALL SELECT '2 updated', CAST(s_suppkey AS VARCHAR), s_suppkey || '|' || s_name FROM supplier WHERE s_suppkey % 5 = 1""")
def release_notes(spark, sf_dir):  # K9
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return files.release_notes(s.filter("id % 5 = 0"), s.filter("id % 5 = 1"), s.filter("id % 5 <> 0"))


@query("SELECT 'v' || (p_partkey // 100) || '.' || (p_partkey % 100) || '-x.zip' AS name FROM part ORDER BY p_partkey // 100 DESC, p_partkey % 100 DESC LIMIT 1")
def newest_release(spark, sf_dir):  # S6 T2 X31: the newest is one row
    return files.latest_release(read(spark, sf_dir, "part").select(F.concat(F.lit("v"), F.floor(F.col("p_partkey") / 100).cast("string"), F.lit("."), (F.col("p_partkey") % 100).cast("string"), F.lit("-x.zip")).alias("name")))


@query("""
    WITH p AS (SELECT DISTINCT p_brand || ' ' || split_part(p_name, ' ', 1) AS name, string_split(p_brand || ' ' || split_part(p_name, ' ', 1), ' ') AS w FROM part) SELECT name, w[1] || ' ' || w[2] || '|' || w[2] || ' ' || w[1] AS orders FROM p""")
def name_orders(spark, sf_dir):  # X10
    d = read(spark, sf_dir, "part").select(F.concat_ws(" ", "p_brand", F.substring_index("p_name", " ", 1)).alias("name")).distinct()
    return d.select("name", F.array_join(vectorised.name_orders("name"), "|").alias("orders"))


@query(r"""
    SELECT page_id, 2 + row_number() OVER (ORDER BY page_id) - 1 AS row_number FROM pages""")
def line_numbers(spark, sf_dir):  # W6
    return files.with_line_numbers(read(spark, sf_dir, "pages").select("page_id").repartitionByRange("page_id").sortWithinPartitions("page_id"))
