import random
import re
from collections import Counter

import numpy as np

from envstats.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, TEXT string, term string, n long"


def brute(rows, min_docs, top):
    """The whole rule over all kept terms of all pairs, in Python integers."""
    rows = [(t or "", la or "", s or "") for _, t, la, s, *_ in rows]
    out = []
    fold = {c: c + 32 for c in range(65, 91)}
    found = [(la, s, re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(fold))) for t, la, s in rows]
    for lang in {la for _, la, _ in rows}:
        docs = Counter(w for la, _, ws in found if la == lang for w in set(ws))
        kept = sorted(w for w, n in docs.items() if n >= min_docs)
        groups = {s: Counter() for _, la, s in rows if la == lang}
        for la, s, ws in found:
            if la == lang:
                groups[s].update(w for w in ws if docs[w] >= min_docs)
        whole = sum(groups.values(), Counter())

        def p(counts, w):
            return 1 + 10**9 * (counts[w] + 2) // (sum(counts.values()) + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)
        for s, counts in groups.items():
            pairs = [(h, sum(f(p(counts, w), p(groups[h], w)) for w in kept)) for h in groups if h != s]
            terms = [(w, f(p(counts, w), p(whole, w))) for w in kept
                     if counts[w] and p(counts, w) > p(whole, w)]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, w, v, i + 1) for i, (w, v) in enumerate(items[:most])]
    return sorted(out)


def corpus(seed, n=160, hot=True):
    rnd = random.Random(seed)
    words = [rnd.choice(["the", "Übung", "ÉTÉ", "don't", "x9y", "naïve", "a_b", "日本"]) for _ in range(5)] + [
        "".join(rnd.choice("abC") for _ in range(rnd.randrange(1, 4))) for _ in range(60)]
    rows = []
    for i in range(n):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 30)))
        source = "hot" if hot and i % 3 == 0 else f"s{rnd.randrange(6)}"
        rows.append((i, text, rnd.choice(["en", "en", "de", None, ""]), source, "t", "u", 1))
    return rows + [(1, None, "en", None, "", "", 0), (2, "", "fr", "s1", "", "", 0),
                   (3, "alone alone", "fr", "s2", "", "", 0), (3, "alone", "it", "s2", "", "", 0)]


def test_equals_brute_force(spark):
    for seed, least, top in ((1, 3, 4), (2, 10, 10), (3, 10**6, 10)):
        rows = corpus(seed)
        got = divergence.audit(spark.createDataFrame(rows, SCHEMA), min_docs=least, top_terms=top)
        assert sorted(map(tuple, got.collect())) == brute(rows, least, top)


def test_blocks_and_flushes_do_not_change_the_result(spark, monkeypatch):
    rows = corpus(5)
    whole = sorted(map(tuple, divergence.audit(spark.createDataFrame(rows, SCHEMA), min_docs=2).collect()))
    assert whole == brute(rows, 2, 10)
    monkeypatch.setattr(divergence, "BLOCK", 7)     # read on the driver: many blocks
    again = divergence.audit(spark.createDataFrame(rows, SCHEMA).repartition(9), min_docs=2)
    assert sorted(map(tuple, again.collect())) == whole


def test_scatter_in_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    pairs = sorted({(int(g), int(t)) for g, t in zip(rng.integers(0, 9, 400), rng.integers(0, 80, 400))})
    group, term = (np.array(x) for x in zip(*pairs))
    p, zero = rng.integers(1, 10**9, len(group)), rng.integers(1, 10**6, 9)
    once = [(g, h.tolist(), v.tolist()) for g, h, v in divergence.scatter(group, term, p, zero)]
    monkeypatch.setattr(divergence, "SCATTER", 5)
    assert once == [(g, h.tolist(), v.tolist()) for g, h, v in divergence.scatter(group, term, p, zero)]
    share = {x: q for x, q in zip(pairs, p.tolist())}

    def f(a, b):
        return (a - b) ** 2 // (a + b)
    z = zero.tolist()
    for g, peers, sums in once:
        for h, v in zip(peers, sums):
            both = [t for x, t in pairs if x == g and (h, t) in share]
            assert v == sum(f(share[g, t], share[h, t]) - f(share[g, t], z[h]) - f(z[g], share[h, t])
                            + f(z[g], z[h]) for t in both) and both


def test_shares_of_huge_counts_are_exact():
    for count, total, size in ((0, 1, 1), (10**15, 2 * 10**15, 10**6), (7, 10, 3), (10**14 + 1, 10**14 + 1, 1)):
        assert int(divergence.share(count, total, size)) == 1 + 10**9 * (count + 2) // (total + 2 * size)


def test_plan_exchanges_tokens_once(spark):
    rows = spark.createDataFrame(corpus(8), SCHEMA).toDF("i", "text", "lang", "source", "t", "u", "n")
    plan = divergence.kept_terms(rows.select("lang", "source", "text"), 2)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange hashpartitioning") == 1


def test_odd_rows(odd, empty):
    out = divergence.audit(odd.withColumn("source", odd["sig"]), min_docs=1).collect()
    assert {r.part for r in out} == {"term"} or not out
    assert divergence.audit(empty.withColumn("source", empty["sig"])).count() == 0
