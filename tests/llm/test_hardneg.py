import math

import numpy as np
import pytest

from envstats.llm import hardneg

SCHEMA = "vec_id long, embedding array<double>, label int, ID string, v string, score string"
ANCHOR = "id % 10 = 0"


def brute(rows, every=10, positives=5, negatives=10, low=30, high=90):
    kept = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * x) for x in v])
        kept[i] = min(kept.get(i, row), row)
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (la, va) in kept.items():
        if a % every:
            continue
        by = sorted((-score(va, v), i, la == lb) for i, (lb, v) in kept.items() if i != a)
        for s, p, _ in [x for x in by if x[2]][:positives]:
            hard = [(i, -n) for n, i, same in by if not same and low * -s <= 100 * -n <= high * -s]
            out += [(a, p, k + 1, i, -s, n) for k, (i, n) in enumerate(hard[:negatives])]
    return sorted(out)


def vectors(seed, n=400, dim=20, labels=4, hot=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    label = np.where(np.arange(n) % 3 == 0, 0, rng.integers(0, labels, n)) if hot else rng.integers(0, labels, n)
    x = centres[label] * 0.6 + rng.normal(size=(n, dim)) * 0.5
    return [(i, [float(np.float32(c)) for c in x[i]], int(label[i]), "x", "y", "z") for i in range(n)]


def result(spark, rows, **more):
    out = hardneg.mine(spark.createDataFrame(rows, SCHEMA), ANCHOR, **more)
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("seed,dim,hot", [(1, 20, False), (2, 64, True), (3, 1, False)])
def test_equals_brute_force(spark, seed, dim, hot):
    rows = vectors(seed, dim=dim, hot=hot)
    assert result(spark, rows) == brute(rows) != []


def test_many_blocks(spark, monkeypatch):
    rows = vectors(4, hot=True)
    monkeypatch.setattr(hardneg, "ROWS", 60)
    monkeypatch.setattr(hardneg, "ANCHORS", 11)
    assert result(spark, rows) == brute(rows)
    assert result(spark, rows, positives=2, negatives=3, low=-50, high=100) == brute(rows, 10, 2, 3, -50, 100)


def test_ties_repeats_and_bad_rows(spark):
    rows = [(i, [0.5, 0.25, 0.5 + (i % 2) / 4], i % 3, "", "", "") for i in range(60)]
    rows += [(10, [9.0, 9.0, 9.0], 2, "", "", ""), (11, None, 1, "", "", ""), (100, [0.5, None, 0.1], 1, "", "", ""),
             (110, [float("nan"), 0.0, 0.0], 1, "", "", ""), (120, [float("inf"), 0.0, 0.0], 1, "", "", ""),
             (None, [0.5, 0.5, 0.5], 1, "", "", ""), (130, [0.5, 0.5, 0.5], None, "", "", ""),
             (140, [], 0, "", "", ""), (150, [0.4], 1, "", "", ""), (61, [0.2, 0.1, 0.1, 7.0], 0, "", "", ""),
             (2**62, [-0.3, 0.0, 0.2], 2, "", "", ""), (-20, [0.9, 0.1, 0.0], 1, "", "", "")]
    got = result(spark, rows)
    assert got == brute(rows) and any(a == -20 for a, *_ in got)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8) * 2.0**18], i % 2, "", "", "") for i in range(80)]
    assert result(spark, rows) == brute(rows)


def test_bounds_hold_and_most_pairs_are_never_scored():
    rng = np.random.default_rng(6)
    walk = np.cumsum(rng.normal(size=(3000, 64)), 1) * 30     # neighbouring components are alike
    v = np.floor(walk).astype(np.int64)
    s = hardneg.summaries(v)
    exact, at, width = v[:20] @ v.T, 0, []
    for k in hardneg.SEGMENTS:
        mid, off = s[:20, at:at + k] @ s[:, at:at + k].T, s[:20, at + k:at + 2 * k] @ s[:, at + k:at + 2 * k].T
        assert (mid - off - 1 <= exact).all() and (exact <= mid + off + 1).all()
        width.append(off.mean())
        at += 2 * k
    assert width == sorted(width, reverse=True)     # each level is tighter
    best = hardneg.Best(np.full((20, 1), hardneg.NONE), np.full((20, 1), 2**62), 5)
    scored = hardneg.search(best, v[:20], s[:20], v, s, np.arange(3000),
                            lambda lo, hi: np.ones((20, hi - lo), bool))
    assert scored < 0.2 * 20 * 3000
    assert (best.score[:, 0] == -np.sort(-exact, 1)[:, :5]).all()


def test_empty(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, [1.0], 1, "", "", ""), (3, [1.0], 1, "", "", "")]) == []   # no anchor
    assert result(spark, [(10, [1.0], 1, "", "", "")]) == []                             # no positive
