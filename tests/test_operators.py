"""Operators on small literals, files and the validator registry."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from orgcurate.operators import duplicates, fields, history, integrity, relations, reshape
from orgcurate.plans import validators
from orgcurate.schema import CURATION, V2
from orgcurate.sources import files
from orgcurate.streaming import checks


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


RECORD = {
    "id": "https://reg.org/012345678", "status": "active", "types": ["education"], "established": 1990, "domains": ["lakeside.example"],
    "names": [{"value": "Lakeside Institute", "types": ["ror_display", "label"], "lang": "en"}, {"value": "LI", "types": ["acronym"], "lang": None}],
    "links": [{"type": "website", "value": "https://www.lakeside.example/x"}], "external_ids": [{"type": "wikidata", "all": ["Q1234"], "preferred": None}],
    "locations": [{"geonames_id": 1, "geonames_details": {"name": "Town", "country_name": "Land", "country_code": "LD"}}], "relationships": [],
    "admin": {"created": {"date": "2020-01-01", "schema_version": "1.0"}, "last_modified": {"date": "2020-01-01", "schema_version": "1.0"}},
}


def curation(spark, *changes):
    base = dict.fromkeys(CURATION, "") | {"names.types.ror_display": "Lakeside Institute*en", "status": "active", "types": "education", "links.type.website": "https://lakeside.example", "locations.geonames_id": "1", "city": "Town", "country": "Land", "external_ids.type.wikidata.all": "Q1234", "established": "2000", "domains": "lakeside.example"}
    return spark.createDataFrame([tuple((base | c)[k] for k in CURATION) for c in changes], ", ".join(f"`{k}` string" for k in CURATION))


@pytest.fixture
def dump(spark, tmp_path):
    other = RECORD | {"id": "https://reg.org/099999999"}
    (tmp_path / "dump.json").write_text(json.dumps([RECORD, other]))
    return files.records(spark, str(tmp_path / "dump.json"))


def test_csv_keeps_quoted_newlines_and_empty_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n,"a ""b""\nc"\nx,\n')
    assert rows(files.curation_csv(spark, str(tmp_path / "a.csv"))) == [("", 'a "b"\nc'), ("x", "")]


def test_zip_prefers_the_second_schema(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "v1.0-2024-05-06.zip", "w") as z:
        z.writestr("a.json", "[]")
        z.writestr("b_schema_v2.json", json.dumps([RECORD]))
    got = files.snapshots(spark, str(tmp_path / "*.zip")).select("id", "release_date", "names").collect()
    assert got[0].id == RECORD["id"] and str(got[0].release_date) == "2024-05-06" and got[0].names[1].value == "LI"


def test_report_is_not_written_without_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "a string")
    assert not files.write_report(empty, ["a"], str(tmp_path / "r")) and not (tmp_path / "r").exists()


def test_funders(spark, tmp_path):
    (tmp_path / "r.rdf").write_text('<r><skos:Concept rdf:about="http://f/1"><skosxl:prefLabel><skosxl:Label><skosxl:literalForm>A</skosxl:literalForm></skosxl:Label></skosxl:prefLabel><skosxl:altLabel><skosxl:Label><skosxl:literalForm>B</skosxl:literalForm></skosxl:Label></skosxl:altLabel><skosxl:altLabel><skosxl:Label><skosxl:literalForm>C</skosxl:literalForm></skosxl:Label></skosxl:altLabel></skos:Concept></r>')
    got = files.funder_concepts(spark, str(tmp_path / "r.rdf")).collect()
    assert (got[0].name, got[0].aliases) == ("A", "B; C")


def test_latest_release(spark):
    names = spark.createDataFrame([("v1.9-x.zip",), ("v1.10-x.zip",), ("readme",)], "name string")
    assert files.latest_release(names).first().name == "v1.10-x.zip"


def test_valid_row_has_no_findings(spark, dump):
    ctx = validators.Context(csv=curation(spark, {}))
    for name in ("validate_fields", "input_file_structure", "unprintable-chars"):
        assert validators.plan_all(ctx, [name])[f"csv_{name}"].collect() == []


def test_invalid_row(spark):
    ctx = validators.Context(csv=curation(spark, {"status": "pending", "established": "99", "links.type.website": "example.org", "external_ids.type.wikidata.all": "q1", "names.types.ror_display": "No Tag"}))
    got = {r.field for r in validators.plan_all(ctx, ["validate_fields"])["csv_validate_fields"].collect()}
    assert got == {"status", "established", "links.type.website", "external_ids.type.wikidata.all", "names.types.ror_display"}


def test_registry_searches(spark, dump):
    ctx = validators.Context(csv=curation(spark, {}), json=dump.limit(1), registry=dump.withColumn("id", F.concat(F.lit("r"), "id")), places=spark.createDataFrame([("1", "Other", "Land", "LD")], "geonames_id string, name string, country_name string, country_code string"))
    plans = validators.plan_all(ctx)
    assert len(plans["csv_duplicate-urls"].collect()) == 1 and len(plans["csv_duplicate-domains"].collect()) == 1
    assert len(plans["csv_duplicate-external-ids"].collect()) == 2
    assert [r.issue for r in plans["csv_address-validation"].collect()] == ["mismatch"]
    assert {(r.record, r.input_name, r.matched_name, r.score) for r in plans["csv_production-duplicates"].collect()} == {("row 2", "Lakeside Institute*en", "Lakeside Institute", 100)}
    assert plans["csv_production-duplicates"].count() == 2  # the registry has two such records
    assert set(plans) >= {"json_validate_fields", "new-record-integrity", "update-record-integrity"}


def test_named_validator_without_inputs_raises(spark):
    with pytest.raises(validators.ConfigurationError):
        validators.plan_all(validators.Context(csv=curation(spark, {})), ["new-record-integrity"])


def test_update_integrity(spark, dump):
    csv = curation(spark, {"id": RECORD["id"], "names.types.acronym": "add==LI;XX", "domains": "delete==lakeside.example"})
    csv = csv.select("id", "`names.types.acronym`", "domains")
    got = rows(validators.plan_all(validators.Context(csv=csv, json=dump.limit(1)), ["update-record-integrity"])["update-record-integrity"])
    assert [(g[1], g[4]) for g in got] == [("domains", "still present"), ("names.types.acronym", "missing")]


def test_clearing_a_field_and_external_ids(spark, dump):
    csv = curation(spark, {"id": RECORD["id"], "domains": "delete", "links.type.website": "replace==delete", "external_ids.type.wikidata.all": "add==Q1234;add==Q9", "locations.geonames_id": "replace==1"})
    csv = csv.select("id", "domains", *(f"`{c}`" for c in ("links.type.website", "external_ids.type.wikidata.all", "locations.geonames_id")))
    got = rows(validators.plan_all(validators.Context(csv=csv, json=dump.limit(1)), ["update-record-integrity"])["update-record-integrity"], "field")
    assert [(g[1], g[3], g[4]) for g in got] == [("domains", "", "still present"), ("external_ids.type.wikidata.all", "Q9", "missing"), ("links.type.website", "", "still present")]


def test_in_release_reports_equal_names_once(spark):
    d = spark.createDataFrame([(k, f"h{k}", [n]) for k, n in enumerate(["Alpha Lab", "Alpha Lab", "Alpha Lab", "Alpha Labs", "ALPHA LAB*en"])], "position int, host string, names array<string>")
    got = rows(duplicates.in_release(d).select("name1", "name2", "first", "second", "match_type"))
    assert got == [("ALPHA LAB*en", "Alpha Lab", 0, 4, "name_exact"), ("ALPHA LAB*en", "Alpha Labs", 3, 4, "name_fuzzy"), ("Alpha Lab", "Alpha Lab", 0, 1, "name_exact"), ("Alpha Lab", "Alpha Labs", 0, 3, "name_fuzzy")]


def test_encodings(spark, tmp_path):
    for name, raw in {"a": "é".encode(), "b": "é€".encode("windows-1252"), "c": b"\xff\xfea\x00", "d": b"\x81", "e": b"\xef\xbb\xbfid"}.items():
        (tmp_path / name).write_bytes(raw)
    got = {r.file[-1]: r.encoding for r in files.encodings(spark, str(tmp_path)).collect()}
    assert got == {"a": "utf-8", "b": "windows-1252", "c": "utf-16", "d": "latin-1", "e": "utf-8-sig"}


def test_zip_of_a_dump(spark, dump, tmp_path):
    records = dump.drop("file")
    files.write_zip(records, reshape.wide_v2(records), str(tmp_path / "v1.zip"), "v1")
    with zipfile.ZipFile(tmp_path / "v1.zip") as z:
        assert [r["id"] for r in json.loads(z.read("v1.json"))] == [RECORD["id"], "https://reg.org/099999999"]
        lines = z.read("v1.csv").decode().splitlines()
    assert len(lines) == 3 and len(lines[0].split(",")) == 35 and "en: Lakeside Institute" in lines[1]


def test_chunks_as_csv(spark, tmp_path):
    files.write_chunks(history.chunked(spark.range(25), ["id"], 10), str(tmp_path / "c"), fmt="csv")
    assert sorted(p.name for p in (tmp_path / "c").iterdir() if p.is_dir()) == ["chunk=000", "chunk=001", "chunk=002"]


def test_missing_columns_are_the_only_finding(spark):
    df = spark.createDataFrame([("",)], "id string")
    got = validators.plan_all(validators.Context(csv=df), ["input_file_structure"])["csv_input_file_structure"].collect()
    assert {r.message for r in got} == {"missing column"}


def test_update_file_detection(spark):
    assert fields.is_update_file(spark.createDataFrame([("",), ("x",)], "id string"))
    assert not fields.is_update_file(spark.createDataFrame([("",), (" ",)], "id string"))


def test_reappearance_does_not_count_as_change(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "x"), ("a", 4, "y"), ("b", 2, None)], "id string, d int, r string")
    assert rows(history.created_and_modified(df, "id", "d", ["d"], F.col("r"))) == [("a", 1, 4, 2), ("b", 2, 2, 1)]


def test_chunks_follow_the_order(spark):
    got = rows(history.chunked(spark.range(1000).repartition(7), ["id"], 300))
    assert [c for _, c in got] == [i // 300 for i in range(1000)]


def test_relations(spark):
    e = spark.createDataFrame([("a", "b", "Parent"), ("b", "a", "Child"), ("c", "d", "Successor-ns"), ("c", "d", "Odd")], "record string, related string, type string")
    assert ("d", "c", "Error", "inverse") in rows(relations.both_directions(e)) and ("d", "c", "Predecessor", "inverse") not in rows(relations.both_directions(e))
    assert len(rows(relations.with_inverse(e))) == 2
    both = spark.createDataFrame([("a", "b", "Parent"), ("a", "b", "Child"), (None, "b", "Child")], "record string, related string, type string")
    assert rows(relations.contradictions(both)) == [("a", "b", 2)]
    tree = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "c")], "node string, parent string")
    assert rows(relations.parents(tree)) == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "a")]


def test_parents_of_deep_chains_and_cycles(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(150)], "node int, parent int")
    assert {r.root for r in relations.parents(chain).collect()} == {0}
    assert relations.parents(spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "node int, parent int")).count() == 3


def test_shuffled_partitions_change_nothing(spark):
    n = spark.createDataFrame([(x,) for x in ["cold anvil", "old anvil", "cold anvils", "warm pipe", "worm pipe"]], "name string")
    a = rows(duplicates.similar_names(n, None, "name"))
    assert a == rows(duplicates.similar_names(n.repartition(5), None, "name")) and len(a) == 4


def test_fold_reports_deletes_of_absent_values(spark):
    d = spark.sql("select array('a', 'b') l, array(struct('delete' op, 'x' value), struct('add' op, 'c' value), struct('delete' op, 'a' value)) o")
    r = d.select(integrity.folded(F.col("l"), F.col("o")).alias("r")).first().r
    assert (r["list"], r.errors) == (["b", "c"], ["delete x"])


def test_display_name_and_leaves(spark, dump):
    one = dump.limit(1).drop("file")
    assert one.select(reshape.display_name(F.col("names")).alias("n")).first().n == "Lakeside Institute"
    paths = {r.path for r in reshape.leaves(one, "id").collect()}
    assert {"names_0_value", "names_1_types_0", "admin_created_date", "locations_0_geonames_details_name"} <= paths


def test_streaming_checks(spark, tmp_path):
    spark.createDataFrame([(1, "https://a.org/x"), (2, "https://b.org")], "page_id long, url string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("page_id long, url string").parquet(str(tmp_path / "in"))
    static = spark.createDataFrame([(7, "http://www.a.org")], "page_id long, url string")
    q = checks.known_sites(stream, static).writeStream.format("memory").queryName("sites").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(60)
    assert [(r.page_id, r.registry_page_id) for r in spark.sql("select * from sites").collect()] == [(1, 7)]


def test_schema_is_what_the_reader_uses(dump):
    assert len(V2) and {"id", "names", "admin"} <= set(dump.columns)
