"""Operators 11 to 13 against brute force, with odd rows."""

import collections
import datetime
import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orgcurate.llm import concurrency, exact_dedup, filter_audit

SPACES = " \t\n\x0b\x0c\r"
DAY = datetime.datetime(2024, 1, 1)
SALE, LINE, CLIENT = "sale_id long, client_id long, total double, sold_at timestamp_ntz, n_open int, epoch string", "sale_id long, shipped_at timestamp_ntz, chunk int", "client_id long, nation_id int, seen string"


def counted(rows):
    return collections.Counter(map(tuple, rows))


def swept(sales, lines, clients):
    """A plain sweep."""
    last, home = {}, {}
    for i, at in lines:
        if i is not None and at is not None:
            last[i] = max(last.get(i, at), at)
    for i, n in clients:
        if i is not None and n is not None:
            home[i] = min(home.get(i, n), n)
    seconds = lambda t: (t - datetime.datetime(1970, 1, 1)) // datetime.timedelta(minutes=1) * 60
    change = collections.defaultdict(lambda: [0, 0])
    for i, c, total, at in sales:
        if at is None:
            continue
        a, b = seconds(at), seconds(last[i]) + 7 * 86400 if i in last else None
        if b is not None and b <= a:
            continue
        cents = int(np.floor(100 * total + 0.5)) if total is not None and abs(total) < 9e13 else 0
        for n in (home.get(c, -1), -2):
            for t, sign in ((a, 1), (b, -1)):
                if t is not None:
                    change[n, t][0] += sign
                    change[n, t][1] += sign * cents
    out = []
    for n in {k[0] for k in change}:
        at = sorted(t for m, t in change if m == n and change[m, t] != [0, 0])
        run, cents, high, rows = 0, 0, 0, []
        for k, t in enumerate(at):
            run, cents = run + change[n, t][0], cents + change[n, t][1]
            high = max(high, run)
            rows.append([n, t, at[k + 1] if k + 1 < len(at) else None, run, cents, high])
        out += [(*r, r[3] == high) for r in rows]
    return counted(out)


def minutes(r, most):
    return DAY + datetime.timedelta(seconds=r.randrange(most))


@pytest.mark.parametrize("chunk_s", [60, 3600, 86_400])
def test_concurrency_equals_a_plain_sweep(spark, chunk_s):
    r = random.Random(chunk_s)
    sales = [(r.choice([None, *range(60)]), r.choice([None, 7, 7, 7, *range(12)]), r.choice([None, float("nan"), float("inf"), 1e300, -0.005, 1.005, 99.99]), r.choice([None, minutes(r, 90_000), minutes(r, 20 * 86400)])) for _ in range(250)]
    sales += sales[:20] + [(900, 1, 5.0, datetime.datetime(1969, 12, 31, 23, 59, 30)), (901, 1, 5.0, datetime.datetime(2300, 1, 1)), (None, None, None, None)]
    lines = [(r.choice([None, *range(70)]), r.choice([None, minutes(r, 9 * 86400) - datetime.timedelta(days=7)])) for _ in range(200)]
    clients = [(i, r.choice([None, 1, 2, 3])) for i in range(10)] + [(None, 4), (3, 2), (3, 1)]
    got = concurrency.peaks(spark.createDataFrame([(*s, 1, "x") for s in sales], SALE), spark.createDataFrame([(*x, 1) for x in lines], LINE), spark.createDataFrame([(*c, "y") for c in clients], CLIENT), chunk_s)
    assert counted(got.select("nation_id", "from_s", "to_s", "n_open", "open_cents", "high_open", "is_peak").collect()) == swept(sales, lines, clients)


def test_concurrency_of_empty_tables(spark):
    none = [spark.createDataFrame([], s) for s in (SALE, LINE, CLIENT)]
    assert concurrency.peaks(*none).collect() == []
    one = spark.createDataFrame([(1, 1, None, DAY, 1, "x")], SALE)
    assert [tuple(x) for x in concurrency.peaks(one, *none[1:]).orderBy("nation_id").collect()] == [(n, 1704067200, None, 1, 0, 1, True) for n in (-2, -1)]


def test_centred_tree_equals_counting():
    r = np.random.default_rng(3)
    for k in (1, 2, 3, 7, 8, 100, 1441):
        first = r.integers(1, k + 1, 300)
        last = np.minimum(k, first + r.integers(0, k, 300))
        weight = r.integers(-5, 6, 300)
        ranks = np.arange(1, k + 1)
        inside = (first <= ranks[:, None]) & (ranks[:, None] <= last)
        n, w = concurrency.CentredTree(k, first, last, [np.ones(300, np.int64), weight]).stab(ranks)
        assert (n == inside.sum(1)).all() and (w == inside @ weight).all()


def copies():
    r = random.Random(4)
    texts = [None, "", SPACES, "a b", "ab", "a\tb ", "a b", "é" * 200, "x" * 100_000, " ".join("word" for _ in range(5000)), "a\x00b", "A b"]
    rows = [(i, r.choice(texts)) for i in range(300)] + [(1000 + i, "hot copy" + " " * (i % 3)) for i in range(200)] + [(5, "a b"), (5, "a b"), (None, "ab  "), (None, "none else")] + [(2000 + i, f"own text {i}") for i in range(50)]
    return rows


def deduplicated(rows):
    group = collections.defaultdict(list)
    norm = lambda t: (t or "").translate({ord(c): None for c in SPACES})
    for i, t in rows:
        group[norm(t)].append((-len(t or ""), i is None, i))
    best = {t: min(g, key=lambda x: (x[0], x[1], x[2] or 0))[2] for t, g in group.items()}
    return counted((i, best[norm(t)], len(group[norm(t)]), i == best[norm(t)], hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows)


@pytest.mark.parametrize("of", [exact_dedup.fingerprint, lambda raw: (len(raw) & 3) << 62 | 5, lambda raw: 1])
def test_exact_dedup_equals_brute_force_even_where_fingerprints_collide(spark, of):
    rows = copies()
    docs = spark.createDataFrame([(*x, 1, "y", "z") for x in rows], "doc_id long, text string, fp int, sha string, group_size string").repartition(5)
    assert counted(exact_dedup.deduplicated(docs, of).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == deduplicated(rows)


def test_exact_dedup_of_an_empty_table(spark):
    assert exact_dedup.deduplicated(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("bits", [0, 3, 11])
def test_quotient_filters_merge_without_loss(spark, bits):
    r = random.Random(bits)
    prints = [r.choice([0, -1, 1 << 62, -(1 << 63), r.getrandbits(63), -r.getrandbits(63), r.getrandbits(40)]) for _ in range(4000)]
    prints += prints[:1500]
    got = exact_dedup.repeated(spark.createDataFrame([(p,) for p in prints], "fp long").repartition(7), bits)
    assert counted(got.collect()) == counted((p, n) for p, n in collections.Counter(prints).items() if n > 1)
    u = np.unique(np.array(prints, np.int64).view(np.uint64))
    f = exact_dedup.Filter.of(0, 0, u, np.arange(1, len(u) + 1))
    again = exact_dedup.Filter.unpacked(0, 0, *f.packed())
    assert (again.prints() == u).all() and (again.counts == f.counts).all()


def audited(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = collections.Counter()
    for i, t, lang in rows:
        t = t or ""
        w = [x for x in "".join(" " if c in SPACES else c for c in t).split(" ") if x]
        fails = {f for f, x in zip("ABCDE", (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), any(c in "#$%&*|" for c in t), i is not None and first.get(t, i) < i), strict=True) if x}
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = False
            for k, f in enumerate(order, 1):
                key = (lang or "", order, k)
                hit = f in fails
                removed = hit and not gone
                for name, x in (("redundant", hit and gone), ("unique_fails", fails == {f}), ("removed", removed), ("good_lost", removed and i in good), ("toxic_lost", removed and i in toxic)):
                    out[*key, name] += x
                gone |= hit
                out[*key, "kept"] += not gone
                out[lang or "", f, "shapley"] += removed
    keys = {(lang or "", "".join(o), k) for _, _, lang in rows for o in itertools.permutations("ABCDE") for k in range(1, 6)}
    return counted((*k, *(out[*k, n] for n in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")), out[k[0], k[1][k[2] - 1], "shapley"]) for k in keys)


def test_filter_audit_equals_brute_force(spark):
    r = random.Random(5)
    pool = [None, "", "short", "A" * 30, "# mark", " ".join(f"w{i}" for i in range(150)), " ".join("same" for _ in range(150)), "X Y Z " * 60, " ".join(f"u{i}|" for i in range(120)), "é É " * 90, "tail " * 20_000]
    rows = [(r.choice([None, *range(80)]), r.choice(pool), r.choice([None, "", "en", "en", "de"])) for _ in range(150)]
    labels = [(r.choice([None, *range(80)]), r.choice([None, 0, 1]), r.choice([None, 0, 1])) for _ in range(60)]
    docs = spark.createDataFrame([(*x, 1, "y") for x in rows], "doc_id long, text string, lang string, flags int, part string")
    marks = spark.createDataFrame([(*x, "y") for x in labels], "doc_id long, quality int, toxic int, good string")
    got = filter_audit.audited(docs, marks).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert counted(got.collect()) == audited(rows, [x for x in labels if x[0] is not None])
    assert filter_audit.audited(docs.limit(0), marks).collect() == []
    assert filter_audit.audited(docs.filter(F.col("doc_id") == 3), marks.limit(0)).count() % 600 == 0
