import random
import re

import numpy as np
import pytest

from envstats.llm import neardup
from envstats.llm.components import components


def shingles(text):
    lower = {i: i + 32 for i in range(65, 91)}
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        r = root(i)
        if name is not None:
            least[r] = min(name, least.get(r, name))
    return sorted(((name, len(sets[i]), least.get(root(i)), name == least.get(root(i)))
                   for i, (name, _) in enumerate(rows)), key=str)


def run(df):
    return sorted(map(tuple, neardup.members(neardup.group(df)).collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(25):
        base = [rnd.choice(words) for _ in range(rnd.choice([40, 120, 300]))]
        chain = list(base)
        for _ in range(rnd.randrange(1, 14)):
            t = list(base) if rnd.random() < 0.5 else chain
            for _ in range(rnd.randrange(0, 5)):
                t[rnd.randrange(len(t))] = rnd.choice(words)
            chain = list(t)
            rows.append(" ".join(w.upper() if rnd.random() < 0.3 else w for w in t))
    rnd.shuffle(rows)
    return [(1000 - 3 * i, t) for i, t in enumerate(rows)]


def test_equals_brute_force(make, corpus):
    assert run(make(corpus)) == brute(corpus)


def test_odd_rows(odd, empty):
    pairs = [tuple(r) for r in odd.toDF(*"abcdefgh").select("a", "b").collect()]
    assert run(odd) == brute(pairs)
    assert run(empty) == []


def test_keep_one_leaves_one_of_each_group(make, corpus):
    rows = corpus + [(5000, None), (5001, ""), (5002, None), (6000, "same text"), (6000, "same text")]
    df = make(rows)
    out = neardup.keep_one(df)
    kept = sorted(r[0] for r in out.collect())
    assert out.columns == df.columns
    assert kept == sorted({r[0] for r in brute(rows) if r[3]} | {5000, 5001, 5002})


def test_odd_sketch_separates():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 4000, np.uint64)

    def bits(like, n=400):
        union = rng.permutation(pool)[:n]
        both = int(n * like)
        cut = both + (n - both) // 2
        a, b = np.sort(union[:cut]), np.sort(np.concatenate([union[:both], union[cut:]]))
        _, odd = neardup.sketch(np.concatenate([a, b]), np.array([0, len(a)]))
        x = odd[0] ^ odd[1]
        return sum(bin(int(v) & (2**64 - 1)).count("1") for v in x)

    assert max(bits(0.86) for _ in range(60)) <= neardup.MOST_BITS
    assert min(bits(0.3) for _ in range(60)) > neardup.MOST_BITS
    assert bits(1.0) == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (7, 7)]
    chain += [(1000, 1000 + i) for i in range(1, 30)]
    out = components(spark.createDataFrame(chain, "u long, v long"))
    got = {r.node: r.component for r in out.collect()}
    assert all(got[i] == 0 for i in range(41)) and got[300] == got[200] == 100
    assert all(got[1000 + i] == 1000 for i in range(30)) and out.count() == len(got)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_whole_sketch_never_drops_a_link(spark):
    """The bound holds for pairs at and above the threshold, and drops others."""
    rng = np.random.default_rng(3)
    rows = []
    for n, both in ((100, 93), (100, 92), (100, 80), (2000, 1840), (2000, 1500), (30, 28), (30, 20)):
        pool = rng.integers(0, 2**63, 2 * n, np.uint64)
        a, b = pool[:n], np.concatenate([pool[:both], pool[n:2 * n - both]])
        whole = neardup.parity(np.repeat([0, 1], n), np.concatenate([a, b]), 2)
        _, odd = neardup.sketch(np.concatenate([a, b]), np.array([0, n]))
        rows.append((n, both, *(x.tolist() for x in (*whole, *odd))))
    df = spark.createDataFrame(rows, "n long, both long, wa array<long>, wb array<long>, "
                                     "oa array<long>, ob array<long>")
    from pyspark.sql import functions as F
    x = df.select("n", "both", F.struct("n", F.col("wa").alias("whole"), F.col("oa").alias("odd")).alias("x"),
                  F.struct("n", F.col("wb").alias("whole"), F.col("ob").alias("odd")).alias("y"))
    got = {(r.n, r.both): r.ok for r in x.select("n", "both", neardup.may_link("x", "y").alias("ok")).collect()}
    for (n, both), ok in got.items():
        if 100 * both >= 85 * (2 * n - both):
            assert ok, (n, both)
    assert not got[100, 80] and not got[2000, 1500] and not got[30, 20]


def test_stage_links_from_080_on(make, corpus, spark):
    """The pipeline's stage against brute force at 0.8, on pairs between 0.8 and 0.85."""
    from envstats.llm import stages
    words = [f"v{i}" for i in range(10_000)]
    rows = list(corpus)
    for g in range(40):                       # one word of 50 changed: 41/51; two of 100: 86/106
        base = words[200 * g:200 * g + 50 * (1 + g % 2)]
        other = list(base)
        for k in range(1 + g % 2):
            other[20 + 40 * k] = f"changed{g}"
        rows += [(10_000 + 2 * g, " ".join(base)), (10_001 + 2 * g, " ".join(other))]
    sets = {i: shingles(t) for i, t in rows}
    alike = [100 * len(a & b) / len(a | b) for a, b in
             ((sets[10_000 + 2 * g], sets[10_001 + 2 * g]) for g in range(40))]
    assert all(80 <= x < 85 for x in alike)
    names = [i for i, _ in rows]
    parent = {i: i for i in names}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, i in enumerate(names):
        for j in names[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    out = stages.drop_near_copies(spark, make(rows), "")
    assert sorted(r[0] for r in out.collect()) == sorted(i for i in names if root(i) == i)


@pytest.mark.parametrize("like", [60, 80, 85, 95])
def test_bands_and_bits_follow_the_threshold(like):
    r = neardup.band_rows(like)
    assert (1 - (like / 100)**r)**(neardup.SAMPLES // r) < 1e-6
    assert neardup.most_bits(like) >= neardup.most_bits(like + 1)
    assert neardup.band_rows(85) == 6 and neardup.MOST_BITS == 96
