"""Versions of a table: what fails leaves the old one readable."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from orgcurate.sources import versions


@pytest.fixture
def place(tmp_path):
    return f"file://{tmp_path}/table"


def people(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, name string, tags array<string>")


def read(spark, place, v=None):
    return {r.id: r.name for r in versions.read_version(spark, place, v).collect()}


def test_updates_make_new_versions(spark, place):
    assert versions.write_version(people(spark, ("a", "A", ["x"]), ("b", None, None)), place) == 1
    assert versions.update(spark, place, people(spark, ("b", "B", []), ("c", "C", None)), "id") == 2
    assert read(spark, place, 1) == {"a": "A", "b": None} and read(spark, place) == {"a": "A", "b": "B", "c": "C"}
    assert versions.write_version(people(spark, ("z", "Z", None)), place, fmt="json") == 3 and read(spark, place) == {"z": "Z"}
    with pytest.raises(ValueError):
        versions.read_version(spark, place, 7)


def test_a_failed_write_changes_nothing(spark, place):
    versions.write_version(people(spark, ("a", "A", None)), place)
    broken = people(spark, ("b", "B", None)).withColumn("name", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        versions.write_version(broken, place)
    assert versions.versions(spark, place) == [1] and read(spark, place) == {"a": "A"}
    assert versions.write_version(people(spark, ("b", "B", None)), place) == 2


def test_of_two_writers_one_must_try_again(spark, place):
    versions.write_version(people(spark, ("a", "A", None)), place)
    versions.write_version(people(spark, ("b", "B", None)), place, based_on=1)
    with pytest.raises(versions.Conflict):
        versions.write_version(people(spark, ("c", "C", None)), place, based_on=1)
    assert read(spark, place) == {"b": "B"}


def test_old_versions_may_go(spark, place):
    for n in "abc":
        versions.write_version(people(spark, (n, n, None)), place)
    assert versions.forget(spark, place, 2) == [1] and versions.versions(spark, place) == [2, 3] and read(spark, place, 2) == {"b": "b"}


def test_one_file_for_each_record(spark, tmp_path):
    out = tmp_path / uuid.uuid4().hex
    rows = people(spark, ("https://ror.org/0aa", "A", ["x"]), ("https://ror.org/0bb/", "B", None), (None, "C", None))
    for _ in range(2):
        assert versions.write_each(rows, f"file://{out}", "id") == 2
    assert sorted(p.name for p in out.iterdir()) == ["0aa.json", "0bb.json"] and json.loads((out / "0aa.json").read_text())["tags"] == ["x"]
    assert versions.write_each(rows.limit(0), f"file://{out}", "id") == 0
