import itertools
import random
import zlib

import numpy as np
import pytest

from envstats.llm import langcrf

LETTERS = {"xx": "abcdefgh", "yy": "efghijkl", "zz": "ghijmnop"}


def word(rnd, lang):
    end = {"xx": "ab", "yy": "li", "zz": "op"}[lang]
    return "".join(rnd.choice(LETTERS[lang]) for _ in range(rnd.randrange(1, 6))) + rnd.choice(["", end])


@pytest.fixture(scope="module")
def corpus(spark):
    rnd, rows = random.Random(1), []
    for i in range(900):
        lang = rnd.choice(["xx", "xx", "yy", "zz"])
        n = rnd.choice([3, 10, 60, 400])
        rows.append((i, " ".join(word(rnd, lang).capitalize() if j % 9 == 0 else word(rnd, lang) for j in range(n)) + ".",
                     lang if i % 10 else None, "src", lang))
    return spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, LANG_PRED string"), {
        r[0]: r[4] for r in rows}


@pytest.fixture(scope="module")
def model(corpus):
    return langcrf.fit(corpus[0])


def test_held_out_accuracy(corpus, model):
    out = langcrf.predictions(langcrf.tag(corpus[0], model)).collect()
    assert len(out) == len(corpus[1]) and model.languages == ["xx", "yy", "zz"]
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    right = [r.lang_pred == corpus[1][r.doc_id] for r in out if r.held_out]
    assert len(right) > 150 and np.mean(right) > 0.97


def test_code_switched_words(model):
    rnd, hit, total = random.Random(2), 0, 0
    for _ in range(40):
        truth = [lang for lang in rnd.sample(sorted(LETTERS), 3) for _ in range(rnd.randrange(8, 20))]
        text = ", ".join(word(rnd, lang) for lang in truth)
        got = langcrf.Reader(model).rows([text], True)["runs"][0]
        at = {m.start(): t for m, t in zip(langcrf.WORD.finditer(text), truth)}
        for start, end, lang in got:
            assert text[start:end].strip(", ") == text[start:end]
            words = [t for s, t in at.items() if start <= s < end]
            hit, total = hit + words.count(lang), total + len(words)
        assert [a[1] < b[0] for a, b in zip(got, got[1:])].count(False) == 0
    assert total and hit / total > 0.9


def test_transitions_are_learned(model):
    assert (np.argmax(model.trans, 1) == np.arange(3)).all()


def test_held_out_and_unlabelled_rows_are_not_read(corpus, model):
    other = corpus[0].selectExpr(
        "doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 'zz top', text) as text",
        "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 'qq', lang) as lang", "LANG_PRED as source")
    again = langcrf.fit(other)
    assert again.languages == model.languages and np.array_equal(again.weights, model.weights)


def test_marginals_equal_all_paths():
    rng = np.random.default_rng(3)
    sizes = np.array([4, 1, 3, 5])
    scores, trans, start = rng.normal(size=(13, 3)) * 3, rng.normal(size=(3, 3)) * 2, rng.normal(size=3)
    at, want = 0, []
    for n in sizes:
        p = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            s = start[path[0]] + sum(scores[at + t, y] for t, y in enumerate(path)) + sum(
                trans[x, y] for x, y in zip(path, path[1:]))
            for t, y in enumerate(path):
                p[t, y] += np.exp(s)
        want.append(p / p.sum(1, keepdims=True))
        at += n
    for piece in (None, 1, 2, 3):
        assert np.allclose(langcrf.marginals(scores, sizes, trans, start, piece), np.concatenate(want))


def test_long_chains_in_pieces():
    rng = np.random.default_rng(4)
    sizes = np.array([700, 3, 64, 65, 128, 1])
    scores, trans, start = rng.normal(size=(sizes.sum(), 4)) * 5, rng.normal(size=(4, 4)) * 4, rng.normal(size=4)
    whole = langcrf.marginals(scores, sizes, trans, start, 1000)
    assert np.allclose(langcrf.marginals(scores, sizes, trans, start), whole)
    assert np.allclose(whole.sum(1), 1)


def test_grouping_of_texts_does_not_matter(corpus, model, monkeypatch):
    texts = [r.text for r in corpus[0].limit(50).collect()]
    whole = langcrf.Reader(model).rows(texts, True)
    monkeypatch.setattr(langcrf, "CELLS", 100)
    monkeypatch.setattr(langcrf, "CACHED", 10)
    parts = langcrf.Reader(model).rows(texts, True)
    assert np.allclose(whole.pop("score"), parts.pop("score"), atol=1e-6) and whole.equals(parts)


def test_odd_rows(odd, empty, model, spark):
    own = langcrf.fit(odd)
    assert own.languages == ["en"]
    for m in (own, model):
        out = langcrf.tag(odd, m).collect()
        assert len(out) == odd.count()
        for r in out:
            blank = r.key in (1, 2, 3) or (r.key is None and r.n_words == 0)
            assert (r.lang_pred == "und" and r.score == 0) == blank
    assert {r.key for r in out} == {r.doc_id for r in odd.select("doc_id").collect()}
    none = langcrf.fit(empty)
    assert langcrf.tag(empty, none).count() == 0
    assert {(r.lang_pred, r.score) for r in langcrf.tag(odd, none).collect()} == {("und", 0.0)}
    marks = spark.createDataFrame([(1, "² ½ 12 __ ...", "en"), (2, "\U0001F600 é", "en")],
                                  "doc_id long, text string, lang string")
    assert {r.key: r.lang_pred == "und" for r in langcrf.tag(marks, model).collect()} == {1: True, 2: False}
