"""Reports on keys that only larger tables have, and steps whose cost grows with copies."""

import collections

import duckdb

import __spark_entry__  # noqa: F401  it fills the catalog
from orgcurate import catalog, catalog_records
from orgcurate.operators import detection, duplicates, releases

SMALL = "/root/testdata/sf0.001"


def customer_tables(spark, folder, keys):
    """Customer and nation with the given (key, nation) rows."""
    spark.createDataFrame([(k, f"Customer#{k}", n, 1.0, "FURNITURE") for k, n in keys], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(f"{folder}/customer.parquet")
    spark.read.parquet(f"{SMALL}/nation.parquet").coalesce(1).write.parquet(f"{folder}/nation.parquet")
    con = duckdb.connect()
    for name in ("customer", "nation"):
        con.sql(f"create view {name} as select * from '{folder}/{name}.parquet/*.parquet'")
    return con


def equal_to_sql(spark, con, folder, name):
    df = catalog.QUERIES[name](spark, str(folder))
    cols = sorted(df.columns)
    got = collections.Counter(repr(tuple(r)) for r in df.select(*cols).collect())
    return got == collections.Counter(repr(r) for r in con.sql(f"select {', '.join(cols)} from ({catalog.SQL[name]})").fetchall())


def test_keys_that_equal_years(spark, tmp_path):
    con = customer_tables(spark, tmp_path, [(1800, 0), (1904, 4), (1911, 11), (21, 21)])
    assert equal_to_sql(spark, con, tmp_path, "report_new_record_integrity")


def test_customers_are_dealt_before_they_are_multiplied(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = catalog_records.customers(spark, SMALL)
    assert d.rdd.getNumPartitions() == parts > spark.read.parquet(f"{SMALL}/customer.parquet").rdd.getNumPartitions()


def test_production_matches_are_chosen_before_records_are_paired(spark):
    columns = "record string, country string, name string"
    own = spark.createDataFrame([("a", "x", "alpha house"), ("a", "y", "alpha house"), ("b", "x", "alpha house"), ("c", "x", "Alpha House*en"), ("c", "x", "beta inn"), ("d", None, "alpha house")], columns)
    known = spark.createDataFrame([("m", "x", "alpha house"), ("m", "y", "alpha houses"), ("n", "y", "alpha houses"), ("n", "x", "zzzz"), ("o", "x", "beta inns"), ("o", "x", "beta inn*de")], columns)
    df = duplicates.in_production(own, known)
    a, b = "alpha house", "alpha houses"
    want = [("a", a, "m", a, 100), ("a", a, "n", b, 96), ("b", a, "m", a, 100), ("c", "Alpha House*en", "m", a, 100), ("c", "beta inn", "o", "beta inn*de", 100)]
    assert sorted(tuple(r) for r in df.collect()) == sorted(want)
    grouped = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in line and "min_by" in line]
    assert grouped and not any("input_name" in line for line in grouped)


def test_detectors_learn_from_all_texts(spark, monkeypatch):
    plans = []
    learnt = detection.learnt

    def seen(labelled, *args):
        plans.append(labelled._jdf.queryExecution().optimizedPlan().toString())
        return learnt(labelled, *args)

    monkeypatch.setattr(detection, "learnt", seen)
    catalog.QUERIES["tagged_names"](spark, SMALL)
    assert len(plans) == 1 and "Limit" not in plans[0]


def test_funders_are_matched_by_classes(spark):
    r = spark.createDataFrame([("r1", "test fund", ["other name"]), ("r2", "test fund", ["other name"]), ("r2", "alpha society", ["beta"]), ("r3", None, ["beta"])], "record string, name string, aliases array<string>")
    f = spark.createDataFrame([("f1", "test fund"), ("f2", "beta"), ("f2", "test funds"), ("f3", None), ("f4", "beta")], "funder string, name string")
    df = releases.funder_matches(r, f)
    want = [("r1", "f1", "name"), ("r1", "f2", "similar"), ("r2", "f1", "name"), ("r2", "f2", "alias"), ("r2", "f4", "alias"), ("r3", "f2", "alias"), ("r3", "f4", "alias")]
    assert sorted(tuple(x) for x in df.collect()) == want
    grouped = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in line and "min_by" in line]
    assert len(grouped) == 1 and "record" not in grouped[0] and "funder" not in grouped[0]


def test_members_of_classes_are_paired_in_chunks(spark, monkeypatch):
    from orgcurate.operators import pairing

    left = [("a", i) for i in range(40)] + [("b", 40), ("c", 41), ("a", 3), ("a", None)]
    right = [("x", f"m{i}") for i in range(50)] + [("y", "n"), ("z", "o"), ("x", "m3")]
    near = [("a", "x", 1), ("a", "y", 2), ("b", "x", 3), ("q", "x", 4), ("c", "w", 5)]
    monkeypatch.setattr(pairing, "CHUNK", 8)
    monkeypatch.setattr(pairing, "PART", 8)
    tables = [spark.createDataFrame(t, s) for t, s in ((near, "l string, r string, kind int"), (left, "l string, id int"), (right, "r string, name string"))]
    df = pairing.paired(*tables, "l", "r")
    want = collections.Counter((i, k, n) for a, b, k in near for x, i in left for y, n in right if x == a and y == b)
    assert df.columns == ["id", "kind", "name"] and collections.Counter(map(tuple, df.collect())) == want
    assert df.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))  # however few bytes the classes have


def test_pairs_of_funders_are_made_in_many_tasks(spark):
    r = spark.range(3000).selectExpr("id as record", "'test fund' as name", "cast(array() as array<string>) as aliases")
    f = spark.range(3000).selectExpr("id as funder", "'test fund' as name")
    df = releases.funder_matches(r, f)
    assert df.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert df.count() == 3000 * 3000 and df.distinct().count() == 3000 * 3000


def test_names_are_scored_without_a_row_for_each_trigram(spark):
    texts = spark.createDataFrame([("en", "the house of the north 𝒜b"), ("fr", "la maison du nord é"), ("de", None), (None, "x")], "lang string, text string")
    model = detection.learnt(texts, "text", "lang")
    names = ["the house", "la maison é", "", "12 -", None, "𝒜b", "Ωμέγα", "the house", "zzzz"]
    df = detection.detected(spark.createDataFrame([(n,) for n in names], "name string"), "name", model)
    assert "Generate" not in df._jdf.queryExecution().optimizedPlan().toString()
    got = {r.name: ([x.lang for x in r.by_grams], [(x.lang, x.score) for x in r.by_signs]) for r in df.collect()}
    assert len(got) == len(set(names)) - 1 and [got["the house"][0][0], got["la maison é"][0][0]] == ["en", "fr"]
    assert got[""] == got["12 -"] == ([], []) and got["zzzz"][1] == [] and got["Ωμέγα"] == (["el"], [("el", 1.0)])
    assert got["the house"][1] == [("en", 1.0)] and got["la maison é"][1] == [("fr", 1.0)] and got["𝒜b"][1] == [("en", 1.0)]


def test_trigrams_of_slices(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(detection, "LETTERS", 7)
    texts = [" the 𝒜b ", "  ", " é ", "", " x yz ", " ab "]
    want = collections.Counter(t[k : k + 3] for t in texts for k in range(len(t) - 2))
    batch = pa.RecordBatch.from_pydict({"lang": pa.array(["a", "b"] * 3), "x": pa.array(texts)}).slice(0)
    got = collections.Counter()
    for b in detection.counted(iter([batch])):
        for lang, token, n in zip(*(b.column(c).to_pylist() for c in ("lang", "token", "n")), strict=True):
            got[token] += n
            assert any(token in t for t in texts["ab".index(lang) :: 2])
    assert got == want and list(detection.slices(pa.array(texts))) != [(0, len(texts))]
