import random
from collections import Counter

import numpy as np
import pytest

from envstats.llm import resample


@pytest.fixture(scope="module")
def corpus(make, spark):
    rnd = random.Random(9)
    good = [f"word{i}" for i in range(200)]

    def one(i):
        t = [rnd.choice(good) for _ in range(rnd.randrange(5, 60))]
        return " ".join(w + "###" for w in t) if i % 5 == 0 else " ".join(t)

    rows = [(i, one(i)) for i in range(2000)]
    labels = spark.createDataFrame([(i, int(i % 5 != 0), "x") for i, _ in rows if i % 3 == 0],
                                   "doc_id long, quality int, QUALITY string")
    return make(rows), labels, rows


def test_good_texts_are_kept(corpus):
    docs, labels, rows = corpus
    out = resample.resample(docs, labels).collect()
    kept = {r.doc_id: r.kept for r in out}
    assert len(out) == 2000 and sum(kept.values()) == np.ceil(2000 * np.mean(
        [i % 5 != 0 for i, _ in rows if i % 3 == 0]))
    assert np.mean([kept[i] for i, _ in rows if i % 5]) > 0.97
    assert np.mean([kept[i] for i, _ in rows if i % 5 == 0]) < 0.03
    again = {r.doc_id: r.draw for r in resample.resample(docs, labels).collect()}
    assert again == {r.doc_id: r.draw for r in out}


def test_counts_equal_brute_force(corpus):
    docs, labels, rows = corpus
    ratio = resample.fit(docs, labels)
    grams, raw, target = resample.NGrams(), Counter(), Counter()
    for i, t in rows:
        bucket, _ = grams([t])
        assert len(bucket) == 2 * len(t.split()) - 1
        raw.update(bucket.tolist())
        if i % 3 == 0 and i % 5:
            target.update(bucket.tolist())
    p = [np.array([c[b] + resample.SMOOTHING for b in range(resample.BUCKETS)]) for c in (target, raw)]
    want = np.log(p[0] / p[0].sum()) - np.log(p[1] / p[1].sum())
    assert np.allclose(ratio, want)


@pytest.mark.parametrize("k", [1, 2, 50, 999, 5000, 20_000])
def test_kth_largest(spark, k):
    values = [((i * 7919) % 4001) / 7 - 200 for i in range(15_000)] + [3.0] * 5000
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert resample.kth_largest(df, "v", k, enough=64) == sorted(values, reverse=True)[k - 1]


def test_gumbel_draws_follow_the_weights(make):
    ratio = np.zeros(resample.BUCKETS)
    draws = [r.draw for r in resample.weigh(make([(i, "") for i in range(4000)]), ratio).collect()]
    assert abs(np.mean(draws) - 0.5772) < 0.08 and abs(np.var(draws) - np.pi**2 / 6) < 0.2


def test_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(4, 1), (5, 1), (5, 0), (6, None), (None, 1)],
                                   "doc_id long, quality int")
    out = resample.resample(odd, labels).collect()
    assert len(out) == odd.count() and any(r.kept for r in out)
    assert {r.log_weight for r in out if r.doc_id in (1, 2, 3)} == {0.0}
    fives = [r for r in out if r.doc_id == 5]
    assert fives[0] == fives[1]
    assert resample.resample(empty, labels).count() == 0
    assert all(r.log_weight == 0 for r in resample.resample(odd, labels.limit(0), k=3).collect())
