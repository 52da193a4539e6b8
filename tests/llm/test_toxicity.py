import random
import zlib

import numpy as np
import pytest

from envstats.llm import toxicity

VILE = ["verminous", "gutterslug", "filthbag"]


@pytest.fixture(scope="module")
def corpus(make, spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 7))) for _ in range(300)]

    def one(i):
        t = [rnd.choice(words) for _ in range(rnd.randrange(10, 80))]
        bad = i % 8 == 0
        for _ in range(3 * bad):
            t[rnd.randrange(len(t))] = rnd.choice(VILE) + rnd.choice(["", "s", "er!"])
        return " ".join(t), int(bad)

    rows = [(i, *one(i)) for i in range(2400)]
    docs = make([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, 1, y, "x") for i, _, y in rows if i % 3 < 2],
                                   "doc_id long, quality int, toxic int, TOXIC string")
    return docs, labels, {i: y for i, _, y in rows}


def test_held_out_accuracy(corpus):
    docs, labels, truth = corpus
    out = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(out) == len(truth)
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in out if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held if truth[r.doc_id]]) > 0.95
    assert np.mean([r.predicted for r in held if not truth[r.doc_id]]) < 0.01


def test_held_out_labels_are_not_read(corpus, spark):
    docs, labels, _ = corpus
    flipped = labels.toDF("doc_id", "quality", "t", "x").selectExpr(
        "doc_id", "quality",
        "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - t, t) as toxic")
    a, b = (toxicity.fit(docs, x) for x in (labels, flipped))
    assert a.chosen == b.chosen and np.array_equal(a.weights, b.weights)


def test_non_negative_risk_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(2)
    pos = (rng.random((300, 40)) < 0.1).astype(np.float32)
    neg = (rng.random((1700, 40)) < 0.1).astype(np.float32)
    pos[:, 0], neg[:, 0] = 1, 0
    unlabelled = np.concatenate([pos[:150], neg[:1350]])
    w, b = toxicity.train_nnpu(pos[150:], unlabelled, 0.1)
    assert ((pos[:150] @ w + b) > 0).mean() > 0.95 and ((neg[1350:] @ w + b) > 0).mean() < 0.05


def test_grams_fold_and_stay_inside_a_text():
    doc, bucket = toxicity.grams(["Ab,  cD", "ab cd", "", "x"])
    one, two = (sorted(bucket[doc == i].tolist()) for i in (0, 1))
    assert one == two and len(one) == 4 + 3 and not (doc == 3).any()


def test_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(4, 0), (5, 1), (5, 0), (6, None), (None, 1), (7, 0)],
                                   "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    out = toxicity.score(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    blank = {r.score for r in out if r.doc_id in (1, 2, 3)}
    assert len(blank) == 1
    assert toxicity.reject(odd, model).columns == odd.columns
    none = labels.limit(0)
    assert toxicity.score(empty, toxicity.fit(empty, none)).count() == 0
    assert all(r.score == 0.5 for r in toxicity.score(odd, toxicity.fit(odd, none)).collect())
