"""op1 learns from every labelled row, however many there are."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orgcurate.llm import toxicity

N = 1_500


@pytest.fixture(scope="module")
def made(spark):
    """Texts of three words, one of them known to one text only; every fifth is toxic by its first word. Two rows each, one with a greater text."""
    ids = spark.range(N).select(F.col("id").alias("doc_id"), (F.col("id") % 5 == 0).cast("int").alias("toxic"))
    name = "translate(lpad(doc_id, 5, '0'), '0123456789', 'abcdefghij')"
    docs = ids.selectExpr("doc_id", f"concat(if(toxic = 1, 'bad', 'good'), ' x', {name}, ' ', substr('abcdefghijklmnopqrstuvwxyz', 1 + doc_id % 7, 3)) AS text")
    return docs.unionByName(docs.withColumn("text", F.concat(F.lit("z "), "text"))).localCheckpoint(), ids


OWN = [i for i in range(N) if zlib.crc32(str(i).encode()) % 3 != 1]


def test_every_labelled_row_is_in_one_block(made):
    docs, labels = made
    blocks = toxicity.blocks_of(docs, toxicity.marks(labels), 200, toxicity.LETTERS)
    assert blocks > 5  # each id has two rows
    rows = toxicity.labelled_words(docs, toxicity.marks(labels), blocks).collect()
    assert sum(r.toxic for r in rows) == sum(i % 5 == 0 for i in OWN) and len(rows) == len(OWN)
    assert {r.block for r in rows} == set(range(blocks)) and {len(r.words) for r in rows} <= {12, 16}
    first = toxicity.labelled_texts(docs, labels, 200, blocks)
    assert len(first) == sum(r.block == 0 for r in rows) and all(x.startswith(("bad ", "good ")) for _, _, x in first)


def test_each_block_is_learnt_from(made):
    """With blocks of few rows the rows of the embedding of words that one text alone has move in all blocks but for what is set apart."""
    docs, labels = made
    before, after = toxicity.Model(), toxicity.learned(docs, labels, 200)
    moved = (before.embed != after.embed).any(1)
    rows = toxicity.labelled_words(docs, toxicity.marks(labels), 1).collect()
    names = {int(np.frombuffer(r.words, "<u2").reshape(-1, 2)[-2, 0]) for r in rows}  # the last word but one
    assert len(names) > 900 and sum(moved[list(names)]) > 500  # 200 rows could move no more than 200


def test_blocks_tell_toxic_texts_as_one_does(made):
    docs, labels = made
    for sample in (200, 10 * N):
        got = toxicity.scored(docs, labels, sample).collect()
        assert len(got) == 2 * N and all(r.predicted == (r.doc_id % 5 == 0) for r in got)
    some = docs.filter("text not like 'z%'").select("doc_id", "text")
    again = [{r.doc_id: r.score for r in toxicity.scored(some.repartition(n), labels.repartition(n), 200).collect()} for n in (2, 5)]
    assert max(abs(again[0][i] - again[1][i]) for i in again[0]) < 1e-6  # however the tables are dealt


def test_changes_are_averaged_over_the_blocks_that_made_them(spark, made):
    """One round over two blocks against the same by hand."""
    docs, labels = made
    table = toxicity.labelled_words(docs, toxicity.marks(labels), 2)
    part, start, model = range(0, 2), toxicity.Model().state(), toxicity.Model()
    assert toxicity.averaged(table, model, part)
    total, n = np.zeros_like(start), np.zeros(len(start))
    for k in (0, 1):
        rows = table.filter(F.col("block") == k).toArrow().to_batches()
        for _, texts, y in toxicity.by_block(iter(rows)):
            apart = len(y) // 5
            short, of = toxicity.pieces(texts[apart:], y[apart:])
            one = toxicity.Model()
            one.train(short, y[apart:][of], int((y[apart:] == 0).sum()), [k, 0], part)
            total += one.state() - start
            n += (one.state() != start).any(1)
    assert 0 < (n == 1).sum() and 0 < (n == 2).sum()
    assert np.allclose(model.state(), start + total / np.maximum(n, 1)[:, None], atol=1e-5)


def test_thresholds_count_every_row_set_apart(made):
    docs, labels = made
    table, model = toxicity.labelled_words(docs, toxicity.marks(labels), 4), toxicity.learned(docs, labels, 200)
    logit, lang, toxic, n = toxicity.apart_counts(table, model)
    sizes = [r["count"] for r in table.groupBy("block").count().collect()]
    assert n.sum() == sum(s // 5 for s in sizes) and (toxic <= n).all()
    order, flat = np.repeat(logit, n), np.concatenate([np.arange(k) < t for k, t in zip(n, toxic, strict=True)]).astype(float)
    assert toxicity.threshold(logit, toxic, n) == toxicity.threshold(order, flat, np.ones(len(flat)))


def test_rounding_leaves_no_negative_squares():
    m = toxicity.Model()
    m.means[0][...], m.squares[0][...] = 1e-12, -1e-11
    again = toxicity.Model()
    again.set_state(m.state())
    texts = [(np.array([k, 9]), np.array([70_000 + k, 70_009])) for k in range(8)]
    again.train(texts, np.arange(8) % 2, None, 1, range(1))
    assert np.isfinite(again.state()).all() and again.steps == 1


def test_no_task_gets_two_blocks(made):
    docs, labels = made
    rows = toxicity.labelled_words(docs, toxicity.marks(labels), 7).select("block", F.col("_metadata.file_name").alias("file")).distinct().collect()
    assert len({r.file for r in rows}) == len(rows) == 7
