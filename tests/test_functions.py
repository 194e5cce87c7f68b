"""Literal cases and small Python models of the text functions and the grammar."""

import random
from urllib.parse import quote, unquote

import pytest
from pyspark.sql import functions as F

from orgcurate.functions import grammar, similarity, text


def values(spark, f, *rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"c{k} string" for k in range(len(rows[0]))))
    return [r.v for r in df.select("i", f(*(F.col(f"c{k}") for k in range(len(rows[0])))).alias("v")).orderBy("i").collect()]


def test_normalize_url(spark):
    got = values(spark, text.normalize_url, ("https://WWW.Example.org:80/a?b#c",), ("http://a_b.org",), ("not a url",), ("",), ("https://bücher.de/x",), (None,))
    assert got == ["//example.org:80", "//a_b.org", None, None, "//bücher.de", None]


def test_normalize_domain(spark):
    assert values(spark, text.normalize_domain, (" WWW.A.org. ",), ("",), (".",), ("a.b",)) == ["a.org", None, None, "a.b"]


def test_strip_takes_unicode_space(spark):
    assert values(spark, text.strip, ("   a b　",), ("\x1c\tx\n",)) == ["a b", "x"]


def test_quote_and_unquote(spark):
    r = random.Random(1)
    some = ["".join(r.choice("ab%/+ ~*é_-.2") for _ in range(12)) for _ in range(200)]
    assert values(spark, text.quote, *[(s,) for s in some]) == [quote(s) for s in some]
    plain = [s.replace("%", "") for s in some]
    assert values(spark, text.unquote, *[(quote(s),) for s in plain]) == [unquote(quote(s)) for s in plain]


def test_wikipedia(spark):
    assert values(spark, text.normalize_wikipedia, ("http://en.wikipedia.org/wiki/École",), ("https://en.wikipedia.org/wiki/%C3%89cole",)) == ["https://en.wikipedia.org/wiki/%C3%89cole"] * 2


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_ratio_is_indel_based(spark):
    r = random.Random(2)
    pairs = [("university", "universitet"), ("", ""), ("a", ""), ("abc", "abc"), *[("".join(r.choice("abc ") for _ in range(r.randrange(9))), "".join(r.choice("abc ") for _ in range(r.randrange(9)))) for _ in range(150)]]
    got = values(spark, similarity.ratio, *pairs)
    assert got == [100 if not a and not b else round(200 * lcs(a, b) / (len(a) + len(b))) for a, b in pairs]
    assert got[0] == 86


def test_prefilter_loses_no_pair(spark):
    r = random.Random(3)
    pairs = []
    for _ in range(300):
        a = "".join(r.choice("abcdef") for _ in range(r.randrange(1, 20)))
        b = list(a)
        for _ in range(r.randrange(4)):
            b.insert(r.randrange(len(b) + 1), r.choice("xyz"))
        pairs.append((a, "".join(b)))
    may = values(spark, lambda a, b: similarity.may_reach(a, b, 85), *pairs)
    assert all(m for m, (a, b) in zip(may, pairs, strict=True) if round(200 * lcs(a, b) / (len(a) + len(b))) >= 85)


CASES = ["add==a;b", "a;b", "x;add==a", "add==a;delete==b", "ADD==a", "delete", "delete==", "replace==a==b", ""]


@pytest.mark.parametrize(
    ("parser", "want"),
    [
        (grammar.parse_bare_replace, ["add=a|replace=b", "replace=a|replace=b", "replace=x|add=a", "add=a|delete=b", "replace=ADD==a", "delete=", "delete=", "replace=a==b", ""]),
        (grammar.parse_sticky, ["add=a|add=b", "replace=a|replace=b", "replace=x|add=a", "add=a|delete=b", "replace=ADD==a", "delete=", "delete=", "replace=a==b", ""]),
        (grammar.parse_spans, ["add=a|add=b", "replace=a|replace=b", "add=a", "add=a|delete=b", "add=a", "delete=", "", "replace=a==b", ""]),
    ],
)
def test_parsers_differ_on_purpose(spark, parser, want):
    assert values(spark, lambda c: grammar.spelt(parser(c)), *[(c,) for c in CASES]) == want


def test_version_order(spark):
    got = values(spark, lambda c: text.version(c), ("v1.10-2024.zip",), ("v1.9.zip",), ("none",))
    assert got[0] > got[1] and got[2].major is None


def test_truncated(spark):
    assert values(spark, text.truncated, ("x" * 120,), ("y" * 100,)) == ["x" * 97 + "...", "y" * 100]


def test_merged_updates(spark):
    got = values(spark, grammar.merged_updates, ("names.add==a | status.replace==x | names.add==b|names.add==a",), ("no update",), (None,))
    assert got == ["names.add==a;b | status.replace==x", "", None]
