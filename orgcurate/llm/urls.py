"""URL filter: rules on host and path first, then gradient-boosted trees on lexical features.

The trees are fitted on the driver from at most SAMPLE labelled URLs, with plain
arithmetic on their collected features, and scored as one column expression: the
whole table goes through built-in expressions only. The sample is that with the lowest
hashes of page_id and url, equal rows counting once; rows beyond a bound on the hash that
the table's size gives are left out by each task, so that few reach the driver.

Defined results: a null url or one without `://` has empty host and path, fits no
rule and is judged by the trees like any other; without labelled URLs of both kinds
nothing is blocked by the trees; repeated rows are judged each; only page_id and
url are read.
"""

from __future__ import annotations

import json
import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most so many labelled URLs, those with the lowest hash.
SAMPLE = 20_000
SPARE = 1.5  # the hash bound lets through that many times the sample
TREES, DEPTH, RATE, BINS, LEAST = 30, 3, 0.3, 32, 20
#: (verdict, host, path): fits its host and all subdomains if the path starts so; the longest wins.
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]
#: Words that name unwanted hosts, for labels where there are none of better origin.
SEEDS = ["ads", "adult", "bets", "casino", "pills", "spam"]
FEATURES = ["url_length", "host_length", "path_length", "depth", "digit_ratio", "hyphens", "subdomains", "name_length", "name_entropy", "parameters", "query_length", "suffix_rate"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.regexp_extract(u, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(the rule's text, its verdict) of the longest fitting rule, null where none fits."""
    text = verdict = None
    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, h + p) if text is None else text.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return (F.lit(None).cast("string"),) * 2 if text is None else (text, verdict)


def lexical(pages: DataFrame) -> DataFrame:
    """pages (page_id, url) with host, path and the features other than suffix_rate."""
    host, path = host_and_path(F.col("url"))
    d = pages.select("page_id", F.col("url"), host.alias("host"), path.alias("path")).withColumn("u", F.coalesce("url", F.lit("")))
    labels = F.split(F.regexp_replace("host", r":\d*$", ""), r"\.")
    d = d.withColumn("labels", labels).withColumn("suffix", F.element_at("labels", -1))
    d = d.withColumn("name", F.when(F.size("labels") > 2, F.element_at("labels", -3)).otherwise(F.element_at("labels", 1)))
    d = d.withColumn("letters", F.split("name", "")).withColumn("query", F.regexp_extract("u", r"(?s)\?([^#]*)", 1))
    n = F.greatest(F.length("name"), F.lit(1)).cast("double")
    entropy = F.aggregate(F.array_distinct("letters"), F.lit(0.0), lambda a, c: a - (F.size(F.filter("letters", lambda x: x == c)) / n) * F.log2(F.size(F.filter("letters", lambda x: x == c)) / n))
    count = lambda c, what: (F.length(c) - F.length(F.replace(F.col(c), F.lit(what), F.lit("")))).cast("double")
    return d.select(
        "page_id", "url", "host", "path", "suffix", "name",
        F.length("u").cast("double").alias("url_length"),
        F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        count("path", "/").alias("depth"),
        (F.length(F.regexp_replace("u", r"[^0-9]+", "")) / F.greatest(F.length("u"), F.lit(1))).alias("digit_ratio"),
        count("host", "-").alias("hyphens"),
        F.size("labels").cast("double").alias("subdomains"),
        F.length("name").cast("double").alias("name_length"),
        F.round(entropy, 6).alias("name_entropy"),
        F.when(F.length("query") > 0, count("query", "&") + 1).otherwise(0.0).alias("parameters"),
        F.length("query").cast("double").alias("query_length"),
    )


def seeded(d: DataFrame) -> DataFrame:
    """Labels from SEEDS: 1 where a hyphen-separated part of the host's name is one of them."""
    return d.withColumn("label", F.arrays_overlap(F.split("name", "-"), F.array(*map(F.lit, SEEDS))).cast("int"))


class Trees:
    """Gradient boosting for the logistic loss, on binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.base, self.trees = 0.0, []
        if not len(y) or y.min() == y.max():
            self.base = -20.0
            return
        self.base = math.log(y.mean() / (1 - y.mean()))
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        score = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree, step = self.grown(x, y - p, np.maximum(p * (1 - p), 1e-6), edges, np.arange(len(y)), DEPTH)
            self.trees.append(tree)
            score[step[0]] += step[1]

    def grown(self, x, g, h, edges, rows, depth):
        """(tree, (rows, their step)): a leaf is a number, else (feature, edge, at or below, above)."""
        leaf = round(float(RATE * g[rows].sum() / (h[rows].sum() + 1)), 6)
        best, cut = 1e-9, None
        if depth and len(rows) >= 2 * LEAST:
            whole = g[rows].sum() ** 2 / (h[rows].sum() + 1)
            for j, e in enumerate(edges):
                at = np.searchsorted(e, x[rows, j], side="left")
                gs, hs, ns = (np.cumsum(np.bincount(at, w, len(e) + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
                ok = (ns >= LEAST) & (len(rows) - ns >= LEAST)
                gain = np.where(ok, gs**2 / (hs + 1) + (g[rows].sum() - gs) ** 2 / (h[rows].sum() - hs + 1) - whole, -1)
                if len(gain) and gain.max() > best:
                    best, cut = float(gain.max()), (j, float(e[int(gain.argmax())]))
        if cut is None:
            return leaf, (rows, np.full(len(rows), leaf))
        low = x[rows, cut[0]] <= cut[1]
        (a, sa), (b, sb) = self.grown(x, g, h, edges, rows[low], depth - 1), self.grown(x, g, h, edges, rows[~low], depth - 1)
        return (*cut, a, b), (np.concatenate([sa[0], sb[0]]), np.concatenate([sa[1], sb[1]]))

    def column(self) -> Column:
        def of(t) -> Column:
            return F.lit(t) if isinstance(t, float) else F.when(F.col(FEATURES[t[0]]) <= t[1], of(t[2])).otherwise(of(t[3]))

        return reduce(lambda a, b: a + b, map(of, self.trees), F.lit(self.base))


def rates(rows: list) -> dict[str, float]:
    """Share of label 1 by host suffix in the labelled sample, smoothed."""
    total: dict[str, list[int]] = {}
    for r in rows:
        total.setdefault(r.suffix or "", []).append(r.label)
    return {s: round((sum(total[s]) + 1) / (len(total[s]) + 10), 6) for s in sorted(total)}


def rate_column(rate: dict[str, float]) -> Column:
    """The rate of the column `suffix`, from one constant map; 0.1 for suffixes it lacks."""
    return F.coalesce(F.from_json(F.lit(json.dumps(rate)), "map<string,double>")[F.col("suffix")], F.lit(0.1))


def sampled(given: DataFrame, sample: int) -> list:
    """The `sample` distinct labelled rows of lowest hash, or all if there are fewer."""
    d = given.filter("label is not null").withColumn("place", F.xxhash64("page_id", "url"))
    n = d.count()
    bound = min((1 << 63) - 1, -(1 << 63) + int(min(1.0, SPARE * sample / max(1, n)) * (1 << 64)))
    take = lambda part: part.distinct().orderBy("place", "page_id", "url").limit(sample).collect()
    rows = take(d.filter(F.col("place") <= bound))
    return rows if len(rows) == sample or n <= len(rows) else take(d)  # repeated rows may leave too few under the bound


def judged(pages: DataFrame, labelled: DataFrame | None = None, rules: list[tuple[str, str, str]] = RULES, sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every page. labelled: page_id, url, label
    (1: unwanted); if None, labels come from SEEDS."""
    pages = pages.select("page_id", "url")
    given = seeded(lexical(pages)) if labelled is None else lexical(labelled).join(labelled.select("page_id", "label"), "page_id")
    rows = sampled(given, sample)
    rate = rates(rows)
    x = np.array([[rate.get(r.suffix or "", 0.1) if f == "suffix_rate" else r[f] for f in FEATURES] for r in rows], float).reshape(len(rows), len(FEATURES))
    trees = Trees(x, np.array([r.label for r in rows], float))
    d = lexical(pages).withColumn("suffix_rate", rate_column(rate)).withColumn("score", F.round(1 / (1 + F.exp(-trees.column())), 6))
    text, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    return d.select("page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
