"""Reconciliation of dumps, folding and acronyms against small tables."""

from pyspark.sql import functions as F

from orgcurate.functions import text
from orgcurate.operators import languages, reconcile

V1 = """id string, name string, status string, types array<string>, established int, aliases array<string>, acronyms array<string>, links array<string>, wikipedia_url string,
labels array<struct<label:string,iso639:string>>, addresses array<struct<geonames_city:struct<id:int>>>, external_ids map<string,struct<preferred:string,all:array<string>>>"""
V2 = """id string, status string, types array<string>, established int, names array<struct<value:string,types:array<string>,lang:string>>, links array<struct<type:string,value:string>>,
locations array<struct<geonames_id:int>>, external_ids array<struct<type:string,all:array<string>,preferred:string>>"""


def test_the_four_outcomes(spark):
    old = ("A", "active", ["Education"], 1990, ["B", "B"], [], ["w"], "", [("L", "en")], [((7,),)], {"ISNI": ("1", ["1", "2"]), "GRID": ("g", ["g"])})
    new = ("active", ["education"], 1990, [("A", ["ror_display", "label"], None), ("B", ["alias"], None), ("B", ["alias"], None), ("L", ["label"], "en")], [("website", "w")], [(7,)], [("isni", ["2", "1"], "1")])
    once = (*new[:3], new[3][:1] + new[3][2:], *new[4:])
    moved = (*new[:3], [*new[3][:3], ("L", ["acronym"], None)], *new[4:])
    bare = ("gone", None, None, None, None, None, None)
    v1 = spark.createDataFrame([(i, *old) for i in ("same", "once", "moved", "bare", "only1")] + [("null", *[None] * 11)], V1)
    v2 = spark.createDataFrame([("same", *new), ("once", *once), ("moved", *moved), ("bare", *bare), ("only2", *new), ("null", *[None] * 7)], V2)
    got = {r.id: r for r in reconcile.reconciled(v1, v2).collect()}
    assert {i: r.outcome for i, r in got.items()} == {"same": "equal", "once": "different", "moved": "different", "bare": "different", "only1": "only_v1", "only2": "only_v2", "null": "equal"}
    assert (got["same"].all_values_equal, got["only1"].all_values_equal, got["only1"].mismatched_keys) == (True, None, None)
    assert got["once"].mismatched_values == "names.types.alias: [B, B] != [B]" and got["once"].all_values_equal is False
    assert got["moved"].mismatched_keys == "names.types.acronym; names.types.label" and got["moved"].all_values_equal  # the same values under other keys
    assert got["bare"].mismatched_keys.split("; ")[0] == "status" and "external_ids.type.isni.all" in got["bare"].mismatched_keys


def test_folding(spark):
    d = spark.createDataFrame([("Ærøskøbing Żółć Straße İß ñÑ 日本 Ω",), (None,)], "x string")
    assert [r.y for r in d.select(text.folded(F.col("x")).alias("y")).collect()] == ["AEroskobing Zolc Strasse Iss nN 日本 Ω", None]


def test_last_name_with_a_language_gives_that_of_an_acronym(spark):
    kind = "id string, types array<string>, names array<struct<value:string,types:array<string>,lang:string>>"
    names = [("Université de Été", ["label"], "fr"), ("Urban Depot East", ["alias"], "en"), ("No language UDE", ["alias"], None), ("UDE", ["acronym"], None), ("ud", ["acronym"], ""), ("UNI", ["acronym"], None), ("XX", ["acronym"], None), ("UDX", ["acronym"], "de")]
    d = spark.createDataFrame([("a", ["education"], names), ("b", ["company"], names), ("c", None, None)], kind)
    assert {r.acronym: (r.name, r.lang) for r in languages.acronym_languages(d).collect()} == {"UDE": ("Urban Depot East", "en"), "ud": ("Urban Depot East", "en"), "UNI": ("Université de Été", "fr"), "XX": (None, None)}
