"""Rows of edge files, details as JSON, shared ids as membership and rows of requests, on small literals."""

from pyspark.sql import functions as F

from orgcurate.functions import issues
from orgcurate.operators import duplicates, releases, reshape


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_edge_rows_need_active_records(spark):
    i = "https://reg.org/0aaaaaaa"
    e = spark.createDataFrame(
        [(1, i + "1", i + "2", "Parent", "production"), (2, i + "1", i + "3", "Parent", "RELEASE"), (3, i + "1", i + "3", "Predecessor", ""), (4, i + "1", i + "3", "DELETE", None), (5, "0aaaaaaa1", i + "2", "Child", "x"), (6, i + "1", None, "delete", "x"), (7, i + "1", i + "9", None, "x")],
        "n int, record string, related string, type string, location string",
    )
    release = spark.createDataFrame([("0aaaaaaa3", "withdrawn")], "record string, status string")
    registry = spark.createDataFrame([("0aaaaaaa2", "active"), ("0aaaaaaa3", "active"), (None, "active")], "record string, status string")
    got = rows(releases.edge_rows(e, release, registry).select("n", "type", "location", "problem"))
    off = "related record is not active"
    assert got == rows(spark.createDataFrame(
        [(1, "parent", "Production", None), (2, "parent", "Release", off), (3, "predecessor", "", None), (4, "delete", None, None), (5, "child", "X", "record id has a wrong shape"), (6, "delete", "X", "related id has a wrong shape"), (7, None, "X", off)],
        "n int, type string, location string, problem string",
    ))
    assert releases.edge_rows(e.limit(0), release, registry).count() == 0


def test_details_by_value_type_and_absent_keys(spark):
    cases = [
        ('{"a": 1, "b": "x"}', '{"b": "x", "a": 1}', False), ('{"a": 1, "b": 2}', '{"a": "1", "b": 2}', True), ('{"a": 1, "b": 2}', '{"a": 1.0, "b": 2}', True),
        ('{"a": null}', "{}", False), ('{"b": 1}', '{"a": 1, "b": 1}', True), ('{"a": 1}', '{"a": 1, "c": 2}', False), ('{"a": {"y": 1, "x": 2}}', '{"a": {"x": 2, "y": 1}}', False),
        ('{"a": [1, 2]}', '{"a": [2, 1]}', True), (None, '{"a": 1}', True), ("{broken", '{"a": 1}', True), ('{"a": 1}', None, True),
    ]
    d = spark.createDataFrame(cases, "old string, new string, want boolean")
    wrong = d.withColumn("got", reshape.details_differ(F.col("old"), F.col("new"), ["a"])).filter("not got <=> want").collect()
    assert not wrong


def test_overlap_members_say_what_pairs_say(spark):
    a = spark.createDataFrame([(1, "x"), (2, "x"), (2, "x"), (3, "y"), (4, "z"), (5, None), (None, "x")], "r int, v string")
    b = spark.createDataFrame([(2, "x"), (9, "x"), (3, "y"), (7, "w")], "r int, v string")
    m = rows(duplicates.overlap_members(a, b, "r", "v"))
    assert m == [("x", 1, True, False, 1, 2, 2), ("x", 2, True, True, 1, 2, 2), ("x", 9, False, True, 1, 2, 2)]
    pairs = {(p, q, v) for v, p, s, *_ in m if s for w, q, _, t, *_ in m if t and v == w and p != q}
    assert pairs == {tuple(r) for r in duplicates.overlapping_ids(a, b, "r", "v").collect()}
    assert duplicates.overlap_members(a.limit(0), b, "r", "v").count() == 0


def test_record_rows_are_supplemented(spark):
    labels = {"shown": ["Name:", "Title:"], "types": ["Type:"], "status": ["Status:"], "links.type.wikipedia": ["Wiki:"], "names.types.label": ["Labels:"], "external_ids.type.fundref.all": ["Funder:"]}
    body = "Name:\nTitle: Foo\nType: Education (any)\nStatus:\nWiki: https://en.wikipedia.org/wiki/A b\nLabels: Le Foo*fr\nFunder: 5\n"
    d = spark.createDataFrame([(1, body), (2, "Type: Funder\nFunder: 6\nStatus: withdrawn\nName: Bar\n"), (3, None), (4, "Funder: 1\n")], "n int, body string")
    out = issues.record_rows(d, "body", labels, "shown").select("n", "shown", "types", "status", "`links.type.wikipedia`", "`names.types.label`")
    assert rows(out) == [(1, "Foo", "education; funder", "active", "https://en.wikipedia.org/wiki/A%20b", "Foo; Le Foo*fr"), (2, "Bar", "funder", "withdrawn", "", "Bar"), (3, "", "", "active", "", ""), (4, "", "funder", "active", "", "")]
