"""Both funder registries, and the table of places."""

from orgcurate.operators import languages, places, relations
from orgcurate.sources import rdf

LABEL = "<skosxl:Label><skosxl:literalForm>{}</skosxl:literalForm></skosxl:Label>"
ONE = f"""<r xmlns:x="y">
<skos:Concept rdf:about="f/1"><skosxl:prefLabel>{LABEL.format("First")}</skosxl:prefLabel>
<skosxl:altLabel>{LABEL.format("F")}<fref:usageFlag rdf:resource="http://data.crossref.org/fundingdata/vocabulary/acronym"/></skosxl:altLabel>
<skosxl:altLabel>{LABEL.format("Fst")}<fref:usageFlag rdf:resource="http://data.crossref.org/fundingdata/vocabulary/abbrevName"/></skosxl:altLabel>
<skosxl:altLabel>{LABEL.format("Premier")}</skosxl:altLabel><skosxl:altLabel>{LABEL.format("Erste")}</skosxl:altLabel>
<svf:fundingBodyType>gov</svf:fundingBodyType><svf:fundingBodySubType>National</svf:fundingBodySubType><svf:taxId>7</svf:taxId><svf:region>Europe</svf:region>
<svf:country rdf:resource="g/1"/><svf:state rdf:resource="g/2"/><schema:address><schema:postalAddress><schema:addressCountry>fra</schema:addressCountry></schema:postalAddress></schema:address>
<skos:narrower rdf:resource="f/2"/><skos:narrower rdf:resource="f/3"/><svf:continuationOf rdf:resource="f/8"/><dct:created>2020</dct:created><dct:modified>2021</dct:modified></skos:Concept>
<skos:Concept rdf:about="f/2"><skosxl:prefLabel>{LABEL.format("Second")}</skosxl:prefLabel><fref:status rdf:resource="http://data.crossref.org/fundingdata/vocabulary/Deprecated"/><skos:broader rdf:resource="f/1"/><dct:isReplacedBy rdf:resource="f/1"/><svf:renamedAs rdf:resource="f/9"/></skos:Concept>
<skos:Concept rdf:about="f/3"><skosxl:prefLabel>{LABEL.format("Third")}</skosxl:prefLabel></skos:Concept></r>"""
OTHER = f"""<r><skos:Concept rdf:about="e/1"><skosxl:prefLabel>{LABEL.format("Own")}</skosxl:prefLabel>
<rdf:type rdf:resource="http://data.elsevier.com/vocabulary/SciValFunders/FBstatus/Active"/><rdf:type rdf:resource="http://data.elsevier.com/vocabulary/SciValFunders/FBstatus/Merged"/>
<skosxl:altLabel>{LABEL.format("O")}<emst:usageFlag rdf:resource="http://x/Acronym"/></skosxl:altLabel><fundingBodyType>pri</fundingBodyType><taxId>9</taxId><country rdf:resource="g/5"/><affilWith rdf:resource="e/2"/><renamedAs rdf:resource="e/3"/>
<skos:broader rdf:resource="e/2"/></skos:Concept>
<skos:Concept rdf:about="e/2"><skosxl:prefLabel>{LABEL.format("Loop")}</skosxl:prefLabel><skos:broader rdf:resource="e/1"/></skos:Concept></r>"""


def test_both_registries_have_21_columns(spark, tmp_path):
    (tmp_path / "a.rdf").write_text(ONE)
    (tmp_path / "b.rdf").write_text(OTHER)
    a, b = (rdf.funders(spark, str(tmp_path / f"{x}.rdf")) for x in "ab")
    assert a.columns == b.columns == rdf.FUNDER_COLUMNS and len(a.columns) == 21
    first, second, _ = a.orderBy("funder_id").collect()
    assert tuple(first) == ("f/1", "First", "Active", "Premier; Erste", "F", "Fst", "gov", "National", "7", "Europe", "fra", "g/1", "g/2", None, "f/2; f/3", None, "f/8", None, None, "2020", "2021")
    assert (second.status, second.replaced_by, second.renamed_as, second.aliases) == ("Deprecated", "f/1", "f/9", None)
    own = b.orderBy("funder_id").first()
    assert (own.status, own.acronyms, own.funding_type, own.tax_id, own.country_geonames_id, own.affiliated_with, own.renamed_as) == ("Active;Merged", "O", "pri", "9", "g/5", "e/2", "e/3")
    assert {tuple(x) for x in rdf.roots(a).collect()} == {("f/1", "f/1"), ("f/2", "f/1"), ("f/3", "f/1")}
    assert {tuple(x) for x in rdf.roots(b).collect()} == {("e/1", None), ("e/2", None)}


def test_places_are_asked_for_once(spark):
    kind = "id long, details string, error string, at int"
    cache = places.merged(spark.createDataFrame([], kind), spark.createDataFrame([(1, "Rome", None, 1), (2, None, "timeout", 1), (None, "x", None, 1)], kind), "id", "details", "at")
    cache = places.merged(cache, spark.createDataFrame([(1, "Roma", None, 2), (2, None, "refused", 2), (3, None, "gone", 2)], kind), "id", "details", "at")
    assert {tuple(x) for x in cache.collect()} == {(1, "Rome", None, 1), (2, None, "refused", 2), (3, None, "gone", 2)}
    cache = places.merged(cache, spark.createDataFrame([(2, "Oslo", None, 3)], kind), "id", "details", "at")
    assert {x.id for x in places.to_ask(spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 4, None)], "id long"), cache, "id", "details").collect()} == {3, 4}


def test_first_hits(spark):
    p = spark.createDataFrame([(5, "São Paulo", 2.0), (4, "São Paulo", 9.0), (3, "são paulo", 9.0), (9, None, 1.0)], "place_id long, place_name string, rank double")
    got = places.first_hits(spark.createDataFrame([("SÃO PAULO",), ("nowhere",), (None,)], "city string"), p, "city").collect()
    assert {x.city: x.best_match for x in got} == {"SÃO PAULO": "são paulo | Geonames ID: [ 3](https://www.geonames.org/3)", "nowhere": None, None: None}


def test_rows_are_marked(spark):
    e = spark.createDataFrame([("a", "b", "Parent"), ("a", "b", "Child"), ("a", "b", "Related"), ("b", "a", "Parent"), ("", "b", "Parent"), ("", "b", "Child")], "record string, related string, type string")
    assert sorted(x.type for x in relations.marked(e).collect()) == ["Child", "Error", "Error", "Error", "Parent", "Parent"]
    d = spark.createDataFrame([(1, "x", "en", ["en"], ["en"]), (2, "x", "en", ["en"], None), (3, "x", "fr", None, None), (4, "x", "it", None, None), (5, "y", None, None, None)], "i int, p string, l string, a array<string>, b array<string>")
    common = spark.createDataFrame([("x", ["fr"])], "place string, langs array<string>")
    assert {x.i: x.outlier for x in languages.marked_outliers(d, "p", "l", "a", "b", common, 0.9).collect()} == {1: False, 2: True, 3: False, 4: True, 5: True}
