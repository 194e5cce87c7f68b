"""The rules of op10's contract, each with its word."""

from orgcurate.llm import urls


def test_each_rule_gives_the_verdict_of_the_contract(spark):
    want = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
    table = spark.createDataFrame([(i, f"http://a.{rule}1") for i, (_, rule) in enumerate(want)], "page_id long, url string")
    got = {r.page_id: (r.verdict, r.rule) for r in urls.judged(table).collect()}
    assert [got[i] for i in range(len(want))] == want
