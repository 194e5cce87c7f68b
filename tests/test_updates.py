"""Record updates against a plain fold, and language detection against plain scores."""

import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from orgcurate.operators import detection, updates

CODES = {"French": "fr", "German": "de"}
RECORD = "id string, name string, established int, aliases array<string>, labels array<struct<label:string,iso639:string>>, external_ids map<string,struct<preferred:string,all:array<string>>>, relationships array<struct<id:string,label:string,type:string>>"


def applied(records, ops):
    """ops: (id, position, op, field, value)."""
    out = {k: {**v, "errors": []} for k, v in records.items()}
    todo = collections.defaultdict(list)
    for i, p, op, f, v in ops:
        if i is not None:
            todo[i].append((p, op, f, v))
            if f == "relationships":
                todo[v].append((p, "mirror", f, i))
    for i, list_of in todo.items():
        if i not in out:
            if any(x[1] != "mirror" for x in list_of):
                out[i] = {"errors": ["no such record"]}
            continue
        r = out[i]
        for p, op, f, v in sorted(list_of):
            bad = None
            if f in ("name", "established"):
                r[f] = int(v) if f == "established" else v
            elif f == "aliases":
                if op == "add":
                    r[f] = [*r[f], v]
                elif op == "replace":
                    r[f] = [v]
                elif v in r[f]:
                    k = r[f].index(v)
                    r[f] = r[f][:k] + r[f][k + 1 :]
                else:
                    bad = v
            elif f == "labels":
                text, _, lang = v.partition("*")
                code = lang if lang in CODES.values() else CODES.get(lang)
                if op == "delete":
                    at = [k for k, x in enumerate(r[f]) if x[0] == v]
                    bad = None if at else v
                    r[f] = [x for k, x in enumerate(r[f]) if not at or k != at[-1]]
                elif code is None:
                    bad = v
                else:
                    r[f] = [*(r[f] if op == "add" else []), (text, code)]
            elif f == "relationships":
                at = [k for k, x in enumerate(r[f]) if v in x[0]]
                bad = v if not at and op != "mirror" else None
                r[f] = [x for k, x in enumerate(r[f]) if not at or k != at[-1]]
            elif f in updates.EXTERNAL:
                e = dict(r["external_ids"])
                plain = v.split("*")[0] if "preferred" in v else v
                if op == "add":
                    old = e.get(f)
                    e[f] = (plain, [plain]) if old is None else (plain if "preferred" in v else old[0], [*old[1], plain])
                elif op == "replace":
                    e[f] = (v, [v])
                elif f not in e or (len(e[f][1]) > 1 and v not in e[f][1]):
                    bad = v
                elif len(e[f][1]) > 1:
                    k = e[f][1].index(v)
                    rest = e[f][1][:k] + e[f][1][k + 1 :]
                    e[f] = (rest[0] if e[f][0] == v else e[f][0], rest)
                else:
                    del e[f]
                r["external_ids"] = e
            else:
                r["errors"].append(f"no such field {f}")
            if bad is not None:
                r["errors"].append(f"{op} {f} {bad}")
    return out


def plain(r):
    if r.aliases is None:
        return {"errors": r.errors}
    return {
        "name": r.name, "established": r.established, "aliases": r.aliases, "labels": [tuple(x) for x in r.labels], "external_ids": {k: (v.preferred, v["all"]) for k, v in r.external_ids.items()},
        "relationships": [tuple(x) for x in r.relationships], "errors": r.errors,
    }


def test_updates_equal_a_plain_fold(spark):
    r = random.Random(6)
    ids = [f"https://ror.org/{c}" for c in "abcdef"]
    records = {
        i: {"name": "n", "established": r.choice([None, 1990]), "aliases": [r.choice("xyz") for _ in range(r.randrange(4))], "labels": [(r.choice("pq"), "fr") for _ in range(r.randrange(3))],
            "external_ids": {k: (r.choice(["1", None]), ["1", "2"][: r.randrange(1, 3)]) for k in ["ISNI", "GRID", "Other"] if r.random() < 0.7}, "relationships": [(r.choice(ids), "l", "Parent") for _ in range(r.randrange(4))]}
        for i in ids
    }
    fields = ["name", "established", "aliases", "labels", "ISNI", "Wikidata", "relationships", "aliases", "labels", "ISNI", "odd"]
    ops = []
    for p in range(160):
        f = r.choice(fields)
        value = {"established": lambda: str(r.randrange(1900, 2000)), "labels": lambda: r.choice(["p", "q", "p*French", "q*de", "p*Klingon", "r*fr"]), "relationships": lambda: r.choice(ids), "ISNI": lambda: r.choice(["1", "2", "3", "3*preferred"]), "Wikidata": lambda: r.choice(["1", "2*preferred"])}.get(f, lambda: r.choice("xyzw"))()
        ops.append((r.choice([*ids, *ids, None, "https://ror.org/gone"]), p, r.choice(["add", "replace", "delete", "delete"]), f, value))
    d = spark.createDataFrame([(i, *(v[f] for f in ("name", "established", "aliases", "labels", "external_ids", "relationships"))) for i, v in records.items()], RECORD)
    for some in (ops, ops[::-1][:40], []):
        u = spark.createDataFrame([(i, k, *x) for k, (i, _, *x) in enumerate(some)], "id string, position int, op string, field string, value string").repartition(3)
        got = {x.id: plain(x) for x in updates.apply_updates(d, u, CODES).collect()}
        assert got == applied(records, [(i, k, *x) for k, (i, _, *x) in enumerate(some)])


def test_order_matters(spark):
    d = spark.createDataFrame([("a", ["x"])], "id string, aliases array<string>")
    after = lambda *ops: updates.apply_updates(d, spark.createDataFrame([("a", i, o, "aliases", v) for i, (o, v) in enumerate(ops)], "id string, position int, op string, field string, value string"), {}).first()
    assert after(("add", "y"), ("replace", "z")).aliases == ["z"] and after(("replace", "z"), ("add", "y")).aliases == ["z", "y"]
    assert after(("delete", "y"), ("add", "y")).errors == ["delete aliases y"]


TEXTS = [("de", "Der Hund und die Katze"), ("de", "Die Größe der Stadt und das Haus"), ("fr", "Le chien et la forêt"), ("fr", "La ville et le château"), ("en", "The dog and the cat"), ("en", "The house of the city"), (None, "none"), ("en", None)]


def test_detection_equals_plain_scores(spark):
    words = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    grams = lambda t: [s[i : i + 3] for s in [" " + " ".join(words(t)) + " "] for i in range(len(s) - 2)]
    signs = lambda t: {*words(t), *("letter " + c for c in "".join(words(t)) if not "a" <= c <= "z")}
    learnt = [(v, t) for v, t in TEXTS if v and t]
    langs = sorted({v for v, _ in learnt})
    many = {v: collections.Counter(g for w, t in learnt if w == v for g in grams(t)) for v in langs}
    kinds = len(set().union(*many.values()))
    docs = collections.Counter(v for v, _ in learnt)
    held = {v: collections.Counter(s for w, t in learnt if w == v for s in signs(t)) for v in langs}
    of = collections.defaultdict(list)
    for v in langs:
        for s, n in held[v].items():
            if n >= 0.5 * docs[v]:
                of[s].append(v)
    model = detection.learnt(spark.createDataFrame(TEXTS, "lang string, text string"), "text", "lang")
    names = ["Das Haus und der Hund", "La forêt", "the city", "1234", "", "Москва", "zzz qqq", "Ü", None]
    got = {r.name: r for r in detection.detected(spark.createDataFrame([(n,) for n in names], "name string"), "name", model).collect()}
    assert model.languages == langs and set(got) == {n for n in names if n is not None}
    for n in ("Das Haus und der Hund", "La forêt", "the city", "zzz qqq", "Ü"):
        log = {v: sum(math.log((many[v][g] + 1) / (sum(many[v].values()) + kinds + 1)) for g in grams(n)) for v in langs}
        share = {v: math.exp(log[v]) / sum(map(math.exp, log.values())) for v in langs}
        assert [x.lang for x in got[n].by_grams][:1] == [max(langs, key=lambda v: log[v])]
        assert all(x.score == pytest.approx(share[x.lang], abs=1e-2) for x in got[n].by_grams)
        score = {v: sum(1 / len(of[s]) for s in signs(n) if v in of[s]) for v in langs}
        assert {x.lang: round(x.score, 3) for x in got[n].by_signs} == {v: round(x / sum(score.values()), 3) for v, x in score.items() if x}
    assert [x.lang for x in got["Москва"].by_signs] == ["ru"] and got["1234"].by_grams == [] == got[""].by_signs


def rule(a, b, common):
    """As it is written in words."""
    if not a or not b:
        return None
    if a[0][0] == b[0][0]:
        return a[0][0]
    if common is None:
        return None
    both = [x for x, s in a for y, t in b if x == y and s + t >= 0.5 and (x == "en" or x in common)]
    return next(iter([*both, *(x for x, _ in a if x in common), *(x for x, _ in b if x in common)]), None)


def test_decision_rule(spark):
    r = random.Random(9)
    scores = lambda: sorted(((v, r.choice([0.1, 0.3, 0.5])) for v in r.sample(["en", "fr", "de", "es"], r.randrange(4))), key=lambda x: -x[1])
    rows = [(i, scores(), scores(), r.choice([None, [], ["fr"], ["de", "es"]])) for i in range(200)]
    kind = "array<struct<lang:string,score:double>>"
    d = spark.createDataFrame(rows, f"i int, a {kind}, b {kind}, c array<string>").select("i", detection.decided(F.col("a"), F.col("b"), F.col("c")).alias("x"))
    assert {x.i: x.x for x in d.collect()} == {i: rule(a, b, c) for i, a, b, c in rows}


def test_held_out_lines(spark):
    """Lines of the third of the documents that the model does not see."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = detection.learnt(d.filter("doc_id % 3 <> 1"), "text", "lang")
    lines = d.filter("doc_id % 3 = 1").select("lang", F.explode(F.split("text", "\\n")).alias("name")).distinct()
    n, tagged, right = lines.count(), *detection.tagged(lines, model).agg(F.count("*"), F.count_if(F.col("detected_language") == F.col("lang"))).first()
    assert tagged > 0.9 * n and right > 0.99 * tagged
    none = detection.learnt(d.limit(0), "text", "lang")
    assert detection.tagged(lines.limit(5), none).count() == 0
