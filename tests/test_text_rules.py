"""Vectorised functions and issue texts."""

import random

import pytest
from pyspark.sql import functions as F

from orgcurate.functions import issues, vectorised


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_common_length_equals_the_table():
    r = random.Random(1)
    for _ in range(300):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(12))) for _ in range(2))
        assert vectorised.common_length(a, b) == lcs(a, b)


def test_vectorised_functions(spark):
    d = spark.createDataFrame([("ﬁne​  Ünit", "b a", "abc"), (None, None, None), ("", "", "")], "a string, b string, c string").coalesce(1)
    got = d.select(vectorised.normalize_name("a").alias("n"), vectorised.ascii_folded("a").alias("f"), vectorised.name_orders("b").alias("o"), vectorised.partial_ratio("c", F.lit("xabcx")).alias("p"), vectorised.token_set_ratio("b", F.lit("a b c")).alias("t")).collect()
    assert tuple(got[0]) == ("fine Ünit", "fine  Unit", ["b a", "a b"], 100, 100)
    assert tuple(got[1]) == (None, None, None, None, None) and got[2].p == 0


BODY = "Name: Test  University\nCity:\nRelated organizations: https://reg.org/012345678 (parent), x https://reg.org/098765432 (child)\n\n\n\n# Notes\nsee https://reg.org/012345678\n# End\n"


@pytest.mark.parametrize(
    ("f", "want"),
    [
        (lambda b: issues.field(b, "Name"), "Test  University"), (lambda b: issues.section(b, "Notes"), "see https://reg.org/012345678"),
        (issues.record_ids, ["https://reg.org/012345678", "https://reg.org/098765432"]),
        (lambda b: F.transform(issues.related(b), lambda x: F.concat_ws(" ", x["related"], x["type"])), ["https://reg.org/012345678 Parent", "https://reg.org/098765432 Child"]),
        (lambda b: issues.without_invented(b, F.lit("a https://reg.org/012345678 b https://reg.org/000000000")), "a https://reg.org/012345678 b"),
        (lambda b: F.contains(issues.cleaned(b), F.lit("City")), False),
        (lambda b: issues.new_record(b, {"name": "Name"})[0], "Test University"),
    ],
)
def test_issue_text(spark, f, want):
    assert spark.createDataFrame([(BODY,)], "b string").select(f(F.col("b")).alias("v")).first().v == want
