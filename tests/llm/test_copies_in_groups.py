"""Near copies whose group is so large that its shingles are frequent."""

import random

import numpy as np
import pyarrow as pa

from orgcurate.llm import near_dedup


def test_copies_stay_together_in_a_large_group(spark):
    r = random.Random(7)
    word = lambda: f"w{r.randrange(10**9)}"
    original = [word() for _ in range(300)]
    texts = [" ".join(original)]
    for _ in range(80):  # each has five new words and is at 0.84 by counts to the original only
        copy = list(original)
        for at in r.sample(range(5, 295, 5), 5):
            copy[at] = word()
        texts.append(" ".join(copy))
    texts += [" ".join(word() for _ in range(100)) for _ in range(300)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    idf = near_dedup.inverse(near_dedup.frequencies(table))
    sets = [(h, n * idf[near_dedup.bucket(h)], n) for _, h, n in (near_dedup.shingles(*near_dedup.strings(pa.array([x], pa.large_string()))) for x in texts[:2])]
    assert near_dedup.similarity(sets[0][:2], sets[1][:2]) < 0.8 < near_dedup.similarity(*(s[::2] for s in sets))
    got = {x.doc_id: x.class_id for x in near_dedup.classes(table).collect()}
    assert got == {i: 0 if i <= 80 else i for i in range(len(texts))}


def test_samples_of_two_kinds_agree_as_often_as_each_similarity():
    r = np.random.default_rng(4)
    h = np.sort(r.integers(1, 1 << 62, 300).astype(np.uint64))
    row, both = np.repeat([0, 1], 200), np.concatenate([h[:200], h[100:]])
    kinds = [np.concatenate([w[:200], w[100:]]) for w in (np.where(np.arange(300) % 3 == 0, 9.0, 1.0) * np.linspace(1, 4, 300), np.ones(300))]
    s = near_dedup.samples_by(row, both, kinds, 2, 600)
    for k, w in enumerate(kinds):
        want = near_dedup.similarity((both[:200], w[:200]), (both[200:], w[200:]))
        assert abs((s[k][0] == s[k][1]).mean() - want) < 0.06
        assert (s[k] == near_dedup.samples(row, both, w, 2, 600)).all()
