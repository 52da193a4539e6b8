import hashlib
import random
import re
import time

import numpy as np
import pytest

from envstats.llm import boost, pii

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))
               for i, c in enumerate(digits[::-1])) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = (True, all(int(x) <= 255 for x in m.group().split(".")) if kind == 1 else 0,
                  12 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15)[kind]
            if ok:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_strict_spans_equal_the_plain_patterns():
    rnd = random.Random(3)
    for _ in range(5000):
        t = "".join(rnd.choice("a1.@+ -()2b%3c.0-9@") for _ in range(rnd.randrange(60)))
        assert pii.base_spans(t) == brute(t), t


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000,
                                  "+1" * 150_000, "a." * 150_000 + "@", "(at)" * 70_000])
def test_scans_are_linear(text):
    t0 = time.process_time()
    pii.proposals(text, pii.base_spans(text))
    assert time.process_time() - t0 < 10


@pytest.fixture(scope="module")
def corpus(make):
    rnd = random.Random(5)

    def card():
        d = "".join(str(rnd.randrange(10)) for _ in range(15))
        return next(d + str(c) for c in range(10) if luhn(d + str(c)))

    def one(i):
        kind = i % 6
        return ["plain words only, nothing else in here",
                f"write to user{i}@mail{i % 9}.example.com today",
                f"the host {rnd.randrange(256)}.{rnd.randrange(256)}.1.{rnd.randrange(256)} is up",
                f"paid by card {card()} in full",
                f"call +1 ({rnd.randrange(100, 999)}) 555-{rnd.randrange(1000, 9999)} now",
                f"order 4{rnd.randrange(10**14, 10**15 - 1)} of 999.{i}.3.4 shipped"][kind]

    return make([(i, one(i)) for i in range(1200)])


PLANTED = [("write to john.doe (at) example (dot) com today", "john.doe (at) example (dot) com", "email"),
           ("mail jane[at]post.example.org now", "jane[at]post.example.org", "email"),
           ("tel 030 1234 5678 from nine on", "030 1234 5678", "phone"),
           ("reach us, (555) 123-4567, until noon", "(555) 123-4567", "phone"),
           ("phone 555.123.4567 or come by", "555.123.4567", "phone"),
           ("card 4111.1111.1111.1111 was charged", "4111.1111.1111.1111", "card"),
           ("ask peter@müller.example.de first", "peter@müller.example.de", "email"),
           ("the box 10[.]20[.]30[.]40 answers", "10[.]20[.]30[.]40", "ip")]
PLAIN = ["they counted 12345678 grains", "order 4000000000000003 has left", "on 2017-05-21 14:30 it rained",
         "from 1990 - 2005 nothing happened", "the 21.05.2017 was a Sunday", "about 7 435 553 824 people",
         "version 10.2.33.4444 is out", "we meet (at) noon. Then we go", "octets 999.1.2.3 are none", "said @someone and root@host too",
         "isbn 9783161484100 and 1234567", "between 1000 2000 3000 4000 and more"]


def test_model_keeps_strict_spans_and_finds_other_forms(corpus, make):
    """Strict spans stay; planted spans in other forms are found with their kind, plain numbers are not."""
    docs = corpus.union(
        make([(10_000 + i, t) for i, (t, _, _) in enumerate(PLANTED)] + [(20_000 + i, t) for i, t in enumerate(PLAIN)]))
    model = pii.fit(docs)
    rows = pii.find(docs, model).collect()
    texts = {r[0]: r[1] for r in docs.toDF(*"abcdefgh").select("a", "b").collect()}
    added = {}
    for r in rows:
        got = sorted((s.start, pii.KINDS.index(s.kind), s.end) for s in r.spans if s.base)
        assert got == brute(texts[r.key])
        added[r.key] = [(texts[r.key][s.start:s.end], s.kind) for s in r.spans if not s.base]
    assert not any(added[i] for i in added if i < 10_000 or i >= 20_000)
    for i, (_, span, kind) in enumerate(PLANTED):
        assert added[10_000 + i] == [(span, kind)], model.cut


def test_few_held_out_rows_add_nothing(make):
    """Without enough support no kind has a cut."""
    model = pii.fit(make([(1, "call +1 (743) 555-3824 now"), (2, "tel 030 1234 5678"), (3, "12345678")]))
    assert all(c == np.inf for c in model.cut)


def test_copies_are_proposals_and_never_strict_forms_only():
    text = "they write to some.one@mail.example.org, pay by 4111 1111 1111 1111 and call +1 (743) 555-3824 here"
    seen = set()
    for span in pii.base_spans(text):
        for copy, own, y in pii.reformatted(text, span):
            assert own in pii.proposals(copy, []) and y in (0.0, 1.0)
            seen.add((own[1], y))
    assert {(0, 1.0), (2, 1.0), (3, 1.0), (3, 0.0)} <= seen


def test_trees_learn_and_scores_are_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0.5)).astype(float)
    model = boost.fit(x[:2000], y[:2000])
    score = model.score(x[2000:])
    assert ((score > 0) == (y[2000:] > 0)).mean() > 0.97
    s, p = boost.isotonic(score, y[2000:])
    assert (np.diff(s) > 0).all() and (np.diff(p) > 0).all() and p[0] < 0.05 and p[-1] > 0.95
    assert boost.fit(x, np.ones(4000)).score(x[:3]).min() > 5


def test_added_span_never_overlaps_and_is_redacted(make):
    trees = boost.Boosted(5.0, 3)
    model = pii.Model(trees, [0.0] * 4)                  # keeps every proposal that fits
    text = "mail a.b(at)mail.example.com or x@y.example.com, call (017) 555-7713 now"
    base = pii.base_spans(text)
    spans = sorted(base + model.keep(text, base))
    assert all(a[2] <= b[0] for a, b in zip(spans, spans[1:])) and len(spans) > len(base)
    out = pii.redact(make([(1, text), (2, None), (3, "")]), model)
    got = [r[1] for r in out.toDF(*"abcdefgh").select("a", "b").orderBy("a").collect()]
    assert got[1:] == [None, ""] and "@" not in got[0] and got[0].count("[EMAIL]") == 2
    assert out.columns == make([]).columns


def test_odd_rows(odd, empty):
    out = pii.digests(pii.find(odd, pii.fit(odd))).collect()
    assert len(out) == odd.count()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    nothing = hashlib.sha256(b"").hexdigest()
    assert by[1][0].base_sha256 == by[2][0].base_sha256 == nothing and by[1][0].spans == ""
    seven = next(r for r in by[7] if r.n_email)
    assert (seven.n_email, seven.n_phone, seven.n_card) == (1, 1, 0)
    assert seven.base_sha256 == hashlib.sha256(seven.spans.encode()).hexdigest()
    assert 2**62 + 1 in by
    assert pii.digests(pii.find(empty, pii.fit(empty))).count() == 0


def test_trees_of_a_table_equal_those_of_its_rows(spark):
    """Boosting and calibration as jobs: rows with counts, in any partitions, as one array."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 40, (600, 4)) / 4
    n = rng.integers(1, 9, 600)
    pos = rng.binomial(n, np.where((x[:, 0] > 3) & (x[:, 2] < 7), 0.9, 0.1))
    one = np.concatenate([np.repeat([[0.0], [1.0]], [a - b, b], 0) for a, b in zip(n, pos)])[:, 0]
    plain = boost.fit(np.repeat(x, n, 0), one, 6, 3)
    rows = spark.createDataFrame([(i % 2, bytearray(v.astype("<f8").tobytes()), int(a), int(b))
                                  for i, (v, a, b) in enumerate(zip(x, n, pos))],
                                 "kind int, x binary, n long, pos long")
    for parts in (1, 7):
        model = boost.fit_rows(rows.repartition(parts), 6, 3)
        assert model.score(x) == pytest.approx(plain.score(x), abs=1e-4)
        assert [t[1].tolist() for t in model.trees] == [t[1].tolist() for t in plain.trees]
    score = np.round(plain.score(x), 1)
    scored = spark.createDataFrame([(i % 2, float(s), int(a), int(b)) for i, (s, a, b) in enumerate(zip(score, n, pos))],
                                   "kind int, score double, n long, pos long")
    got = boost.isotonic_rows(scored.repartition(5))
    for kind in (0, 1):
        at = np.arange(600) % 2 == kind
        s, p = boost.isotonic(np.repeat(score[at], n[at]), np.concatenate(
            [np.repeat([0.0, 1.0], [a - b, b]) for a, b in zip(n[at], pos[at])]))
        assert [x[2] for x in got[kind]] == s.tolist()
        assert [x[0] / x[1] for x in got[kind]] == pytest.approx(p.tolist())


def test_every_proposal_counts(make, monkeypatch):
    """More than 20,000 proposals: trees and calibration see each of them once."""
    texts = [f"write to user{i}@mail{i % 9}.example.com or call +1 (743) 555-{1000 + i} now" for i in range(1500)]
    seen = []
    trees, steps = boost.fit_rows, boost.isotonic_rows
    monkeypatch.setattr(boost, "fit_rows", lambda rows, *a: seen.append(rows.groupBy().sum("n").first()[0])
                        or trees(rows, 2, 2))
    monkeypatch.setattr(boost, "isotonic_rows", lambda rows: seen.append(rows.groupBy().sum("n").first()[0])
                        or steps(rows))
    pii.fit(make(list(enumerate(texts))))
    want = sum(len(pii.proposals(t, pii.base_spans(t))) - sum(p not in set(pii.base_spans(t)) for p in pii.proposals(
        t, pii.base_spans(t))) + sum(len(pii.reformatted(t, p)) for p in pii.base_spans(t)) for t in texts)
    assert want > 20_000 and sum(seen) == want
