"""op6's model and threshold come from every labelled document, however many there are."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orgcurate.llm import quality

N = 60_000  # half of them good: more than 20,000 to learn from, more than 4,000 of either label for the threshold


@pytest.fixture(scope="module")
def made(spark):
    """Good and poor texts of twelve words, poor ones of a somewhat smaller vocabulary; documents and labels."""
    ids = spark.range(N).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    docs = ids.selectExpr("doc_id", "concat_ws(' ', transform(sequence(1, 12), j -> concat('w', pmod(xxhash64(doc_id, j), 90 + 10 * quality)))) AS text")
    return docs.localCheckpoint(), ids


def test_model_counts_every_trusted_document(made):
    docs, labels = made
    trusted = ((F.col("quality") == 1) & ~quality.for_threshold()).alias("trusted")
    rows = docs.join(labels, "doc_id").select(quality.features(quality.hashes(F.col("text"))).alias("f"), trusted).collect()
    assert sum(r.trusted for r in rows) > 20_000
    good, raw = (Counter(b for r in rows if r.trusted or every for b in r.f) for every in (False, True))
    share = lambda c, b: math.log((c[b] + 0.5) / (c.total() + 0.5 * quality.BUCKETS))
    for r in quality.model(docs, labels).collect():
        assert r.ratio == pytest.approx(share(good, r.bucket) - share(raw, r.bucket), abs=6e-5)


def test_threshold_has_the_fewest_mistakes_on_all_labelled_documents(made):
    docs, labels = made
    ratio = quality.embedded(quality.model(docs, labels))
    own = quality.verdict(quality.base(docs), ratio, 0.0).join(labels, "doc_id").filter(quality.for_threshold()).filter("not base_failed")
    pairs = sorted((r.score, r.quality) for r in own.select("score", "quality").collect())
    assert min(sum(q == v for _, q in pairs) for v in (0, 1)) > 4_000
    scores = sorted({s for s, _ in pairs})
    wrong = best = sum(q == 0 for _, q in pairs)
    want, at = scores[0], 0
    for a, b in zip(scores, scores[1:], strict=False):
        while at < len(pairs) and pairs[at][0] <= a:
            wrong += 1 if pairs[at][1] else -1
            at += 1
        if wrong < best:
            best, want = wrong, (a + b) / 2
    assert quality.fitted(docs, labels, ratio) == want
    few = labels.filter("doc_id < 300")  # of one label, and of both but few
    assert quality.fitted(docs, few.filter("quality = 1"), ratio) == quality.THRESHOLD != quality.fitted(docs, few, ratio)


def test_pipeline_keeps_what_the_threshold_of_all_labels_keeps(spark, made, tmp_path):
    docs, labels = made
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    ratio = quality.embedded(quality.model(docs, labels))
    apart = quality.verdict(quality.base(docs.filter(quality.for_threshold())), ratio, 0.0).filter("not base_failed")
    rows = apart.join(labels, "doc_id").select("doc_id", "score", "quality").collect()
    kept = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path)).select("doc_id").collect()}
    least, most = min(r.score for r in rows if r.doc_id in kept), max(r.score for r in rows if r.doc_id not in kept)
    assert least > most
    mistakes = lambda cut: sum((r.score >= cut) != r.quality for r in rows)
    assert mistakes(least) == min(mistakes(s) for s in {r.score for r in rows if abs(r.score - least) < 0.001})
