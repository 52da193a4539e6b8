"""Language of words and texts (operator 11): a linear-chain conditional random field.

Every word of a text carries a hidden language.  Its features are the hashed
character n-grams of the marked word (those with a mark are the prefixes and
suffixes) and its membership in each language's lexicon; transitions between
the languages of neighbouring words are learned with them.  Forward-backward
gives each word's probability of each language, so a text that changes its
language in the middle of a line comes out as runs.

The labels are those of whole texts.  The training chains are therefore mixed:
runs of ``RUN`` words on average, each from a labelled text, follow each other,
so that the transitions learn how evidence must weigh to leave a language.

Marginals are exact for chains of any length.  Chains are cut into pieces of
``PIECE`` words; the product of each piece's matrices carries the messages
across it, and then all pieces of a batch run in lock step as numpy columns.

A text's language is the one with most letters by these probabilities, its score
that language's share of the letters.

Bounds of the fit (they do not touch which texts are predicted): about
``FIT_TEXTS`` texts in all, the same number of each language, by a hash of id
and text; ``WINDOWS`` windows of ``CHAIN`` words of each; the ``LANGUAGES`` most
frequent languages; words of over ``LONG_WORD`` characters are left out of the
fit.  Every text is predicted from all its words.

Defined results: null text, or text without a letter, is ``und`` with score 0;
so is everything if no text is labelled.  Rows without an id are not learned
from; repeated rows get equal results; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstats.llm import common

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
BUCKETS, GRAMS, AFFIX = 1 << 16, 4, 5       # hashed features; inner n-grams up to 4, affixes up to 5 with their mark
LEXICON, LEXICON_SHARE = 2_000, 0.8         # words of a language's lexicon, and least share of their uses in it
FIT_TEXTS, WINDOWS, LANGUAGES, LONG_WORD = 4_000, 3, 256, 64
CHAIN, CHAINS, RUN = 48, 3_000, 10          # words of a training chain, chains, words of a run on average
EPOCHS, BATCH, RATE, DECAY = 5, 64, 0.2, 1e-5
PIECE, FEW = 64, 16                         # words of a piece; most languages for which pieces pay
CELLS, CACHED = 1 << 22, 200_000            # probabilities held at once; words whose scores a task keeps


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every n-gram of the marked lower-case words."""
    marked = [f"\x02{w.lower()}\x03" for w in words]
    n = np.fromiter(map(len, marked), np.int64, len(marked))
    c = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4")
    of = np.repeat(np.arange(len(marked)), n)
    mark = c < 4
    out, h = [], np.zeros(len(c), np.uint32)
    for k in range(1, AFFIX + 1):
        m = max(0, len(c) - k + 1)
        h = h[:m] * np.uint32(0x01000193) + c[k - 1:k - 1 + m]
        ok = of[:m] == of[len(of) - m:]
        if k == 1:
            ok &= ~mark
        elif k > GRAMS:
            ok &= mark[:m] | mark[len(c) - m:]
        mixed = (h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D) + np.uint32(k)
        out.append((of[:m][ok], (mixed ^ mixed >> np.uint32(12))[ok] % np.uint32(BUCKETS)))
    return tuple(np.concatenate(x) for x in zip(*out))


def features(words: list[str], lexicon: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, feature, value), in the order of the words.  The n-grams of a
    word share a norm of 1; lexicon features follow the buckets."""
    of, feature = grams(words)
    value = 1 / np.sqrt(np.bincount(of, minlength=len(words)))[of]
    known = [(i, BUCKETS + l) for i, w in enumerate(words) for l in lexicon.get(w.lower(), ())]
    if known:
        i, l = np.array(known).T
        of, feature = np.append(of, i), np.append(feature.astype(np.int64), l)
        value = np.append(value, np.ones(len(i)))
    order = np.argsort(of, kind="stable")
    return of[order], feature[order].astype(np.int64), value[order]


def _emit(weights: np.ndarray, words: list[str], lexicon: dict) -> np.ndarray:
    """Scores of each word for each language."""
    if not words:
        return np.zeros((0, weights.shape[1]))
    of, feature, value = features(words, lexicon)
    first = np.searchsorted(of, np.arange(len(words)))      # every word has an n-gram
    return np.add.reduceat(weights[feature] * value[:, None], first, 0)


def _norm(x: np.ndarray) -> np.ndarray:
    return x / x.sum(-1, keepdims=True)


def _lock_step(e: np.ndarray, first: np.ndarray, size: np.ndarray):
    """Yields (t, active pieces, their words) with the pieces longest first."""
    order = np.argsort(-size, kind="stable")
    longest = -size[order]
    for t in range(int(size.max(initial=0))):
        on = order[:np.searchsorted(longest, -t)]
        yield t, on, first[on] + t


def marginals(scores: np.ndarray, sizes: np.ndarray, trans: np.ndarray, start: np.ndarray,
              piece: int | None = None) -> np.ndarray:
    """Probabilities of each word's languages.  ``scores``: the words of all chains,
    one after the other; ``sizes``: the chains' words (none empty)."""
    n, k = scores.shape
    if not n:
        return scores.copy()
    e = np.exp(scores - scores.max(1, keepdims=True))
    a, begin = np.exp(trans - trans.max()), np.exp(start - start.max())
    piece = piece or (PIECE if k <= FEW else int(sizes.max()))
    n_pieces = -(-sizes // piece)
    chain_of = np.repeat(np.arange(len(sizes)), n_pieces)
    top = np.cumsum(n_pieces) - n_pieces
    nth = np.arange(len(chain_of)) - top[chain_of]
    first = (np.cumsum(sizes) - sizes)[chain_of] + nth * piece
    size = np.minimum(piece, sizes[chain_of] - nth * piece)

    # the product of each piece's matrices, only where a chain has several pieces
    across = np.zeros((len(first), k, k)) if n_pieces.max() > 1 else None
    if across is not None:
        several = np.flatnonzero((n_pieces > 1)[chain_of])
        for t, on, at in _lock_step(e, first[several], size[several]):
            at_piece = several[on]
            step = np.eye(k)[None] if t == 0 else across[at_piece] @ a
            step = step * e[at][:, None, :]
            across[at_piece] = step / step.max((1, 2), keepdims=True)
    into, out = np.tile(begin, (len(first), 1)), np.ones((len(first), k))
    for i in range(1, int(n_pieces.max())):
        on = top[n_pieces > i] + i
        into[on] = _norm((into[on - 1][:, None, :] @ across[on - 1])[:, 0] @ a)
    for i in range(int(n_pieces.max()) - 1, 0, -1):
        on = top[n_pieces > i] + i
        out[on - 1] = _norm((across[on] @ out[on][:, :, None])[:, :, 0] @ a.T)

    p, message = np.empty_like(e), into
    for _, on, at in _lock_step(e, first, size):
        p[at] = _norm(message[on] * e[at])
        message[on] = p[at] @ a
    message = out
    last = size.max()
    order = np.argsort(-size, kind="stable")
    for t in range(int(last) - 1, -1, -1):
        on = order[:np.searchsorted(-size[order], -t)]
        at = first[on] + t
        here = message[on]
        p[at] = _norm(p[at] * here)
        message[on] = _norm((e[at] * here) @ a.T)
    return p


@dataclass
class Model:
    """Languages, feature weights, transitions, first-word scores and lexicon."""

    languages: list[str]
    weights: np.ndarray
    trans: np.ndarray
    start: np.ndarray
    lexicon: dict[str, list[int]] = field(default_factory=dict)

    def reader(self) -> "Reader":
        return Reader(self)


class Reader:
    """Applies a model to texts; keeps the scores of the words that it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.table = np.zeros((0, len(self.model.languages)))
        self.letters = np.zeros(0, np.int64)

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words and the words of each text."""
        if len(self.number) > CACHED:
            self.forget()
        number, new, ids, sizes = self.number, [], [], []
        for t in texts:
            found = WORD.findall(t)
            sizes.append(len(found))
            for w in set(found).difference(number):
                number[w] = len(number)
                new.append(w)
            ids += map(number.__getitem__, found)
        if new:
            m = self.model
            self.table = np.concatenate([self.table, _emit(m.weights, new, m.lexicon)])
            self.letters = np.append(self.letters, [sum(map(str.isalpha, w)) for w in new])
        return np.array(ids, np.int64), np.array(sizes, np.int64)

    def probabilities(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probabilities of each word, its letters, words of each text)."""
        ids, sizes = self._words(texts)
        m = self.model
        p = marginals(self.table[ids], sizes[sizes > 0], m.trans, m.start)
        return p, self.letters[ids], sizes

    def groups(self, texts: list[str]) -> Iterator[tuple[int, int]]:
        """Ranges of texts whose probabilities are held at once (a text of more
        words than that is a range of its own)."""
        start, cells = 0, 0
        for i, t in enumerate(texts):
            cells += (len(t) // 4 + 1) * len(self.model.languages)
            if cells >= CELLS:
                yield start, i + 1
                start, cells = i + 1, 0
        if start < len(texts):
            yield start, len(texts)

    def rows(self, texts: list[str], runs: bool) -> pd.DataFrame:
        """lang_pred, score, n_words, n_switches and, if asked, runs of each text."""
        langs = np.array([*self.model.languages, UNKNOWN], object)
        none = len(langs) - 1
        out = []
        for lo, hi in self.groups(texts) if none else [(0, len(texts))]:
            n = hi - lo
            pred, score = np.full(n, none), np.zeros(n)
            words, switches, spans = np.zeros(n, np.int64), np.zeros(n, np.int64), [[] for _ in range(n)]
            if none:
                p, letters, words = self.probabilities(texts[lo:hi])
                of = np.repeat(np.arange(n), words)
                mass = np.stack([np.bincount(of, letters * p[:, j], n) for j in range(none)], 1)
                total = np.bincount(of, letters, n)
                has = total > 0
                pred[has] = mass[has].argmax(1)
                score[has] = np.minimum(1.0, mass[has].max(1) / total[has])
                best = p.argmax(1)
                turn = np.flatnonzero((best[1:] != best[:-1]) & (of[1:] == of[:-1])) + 1
                switches = np.bincount(of[turn], minlength=n)
                if runs:
                    at = np.cumsum(words) - words
                    spans = [_runs(t, best[i:i + k], langs) for t, i, k in zip(texts[lo:hi], at, words)]
            got = pd.DataFrame({"lang_pred": langs[pred], "score": score, "n_words": words,
                                "n_switches": switches})
            if runs:
                got["runs"] = spans
            out.append(got)
        return pd.concat(out, ignore_index=True)


def _runs(text: str, best: np.ndarray, langs: np.ndarray) -> list[tuple]:
    """(start, end, language) of neighbouring words of one language; code points."""
    out: list[list] = []
    for m, j in zip(WORD.finditer(text), best):
        if out and out[-1][2] == langs[j]:
            out[-1][1] = m.end()
        else:
            out.append([m.start(), m.end(), langs[j]])
    return [tuple(x) for x in out]


def held_out(key, folds: int = 4, fold: int = 2):
    """Rows kept from learning: crc32 of the id as text, modulo ``folds``, is ``fold``."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Windows of words at places that a hash of the text names."""
    for b in batches:
        out = []
        for lang, text in zip(b["lang"], b["text"]):
            words = [w for w in WORD.findall(text) if len(w) <= LONG_WORD]
            room = max(1, len(words) - CHAIN + 1)
            at = {zlib.crc32(text.encode("utf-8", "surrogatepass"), i) % room for i in range(WINDOWS)}
            out += [(lang, " ".join(words[i:i + CHAIN])) for i in sorted(at) if words]
        yield pd.DataFrame(out, columns=["lang", "words"], dtype=object)


def _lexicon(texts: list[list[list[str]]]) -> dict[str, list[int]]:
    """Words of which at least three windows, and LEXICON_SHARE of the rates of
    use, belong to one language; at most LEXICON of each."""
    counts = [Counter(w.lower() for t in own for w in set(t)) for own in texts]
    out: dict[str, list[int]] = {}
    for j, mine in enumerate(counts):
        rate = {w: [c[w] / max(1, len(t)) for c, t in zip(counts, texts)] for w, n in mine.items() if n >= 3}
        own = [w for w, r in rate.items() if r[j] >= LEXICON_SHARE * sum(r)]
        for w in sorted(own, key=lambda w: (-mine[w], w))[:LEXICON]:
            out.setdefault(w, []).append(j)
    return out


def _chains(texts: list[list[list[str]]], share: np.ndarray, rng) -> tuple[list[list[str]], np.ndarray]:
    """Mixed chains of CHAIN words and the language of each word."""
    chains, labels = [], []
    for _ in range(CHAINS):
        words: list[str] = []
        langs: list[int] = []
        while len(words) < CHAIN:
            j = int(rng.choice(len(texts), p=share))
            source = texts[j][rng.integers(len(texts[j]))]
            run = int(rng.geometric(1 / RUN)) if rng.random() < 0.8 else CHAIN
            at = int(rng.integers(max(1, len(source) - run + 1)))
            words += source[at:at + run]
            langs += [j] * len(source[at:at + run])
        chains.append(words[:CHAIN])
        labels.append(langs[:CHAIN])
    return chains, np.array(labels)


def train(texts: list[list[list[str]]], share: np.ndarray, seed: int = 11) -> Model:
    """Weights by the gradient of the chains' log-likelihood (Adagrad); ``texts[j]``
    are the windows of language j, ``share`` the frequencies of the languages."""
    k, rng = len(texts), np.random.default_rng(seed)
    lexicon = _lexicon(texts)
    chains, labels = _chains(texts, share, rng)
    vocabulary = sorted({w for c in chains for w in c})
    number = {w: i for i, w in enumerate(vocabulary)}
    ids = np.array([[number[w] for w in c] for c in chains])
    of, feature, value = features(vocabulary, lexicon)
    first = np.searchsorted(of, np.arange(len(vocabulary) + 1))
    params = [np.zeros((BUCKETS + k, k)), np.zeros((k, k)), np.log(share)]
    sums = [np.full_like(x, 1e-6) for x in params]
    for _ in range(EPOCHS):
        order = rng.permutation(len(ids))
        for lo in range(0, len(order), BATCH):
            rows = order[lo:lo + BATCH]
            unique, inverse = np.unique(ids[rows], return_inverse=True)
            n = first[unique + 1] - first[unique]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[unique], n)
            w, trans, start = params
            table = np.add.reduceat(w[feature[at]] * value[at, None], np.cumsum(n) - n, 0)
            e = table[inverse.reshape(len(rows), CHAIN)]
            e = np.exp(e - e.max(2, keepdims=True))
            a = np.exp(trans - trans.max())
            alpha, beta = np.empty_like(e), np.ones_like(e)
            alpha[:, 0] = _norm(np.exp(start - start.max()) * e[:, 0])
            for t in range(1, CHAIN):
                alpha[:, t] = _norm((alpha[:, t - 1] @ a) * e[:, t])
                beta[:, -t - 1] = _norm((beta[:, -t] * e[:, -t]) @ a.T)
            p = _norm(alpha * beta)
            pair = alpha[:, :-1, :, None] * a * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
            pair /= pair.sum((2, 3), keepdims=True)
            truth = np.eye(k)[labels[rows]]
            miss = (truth - p).reshape(-1, k)
            by_word = np.stack([np.bincount(inverse.ravel(), miss[:, j], len(unique)) for j in range(k)], 1)
            by_feature = np.repeat(by_word, n, 0) * value[at, None]
            seen = np.einsum("bti,btj->ij", truth[:, :-1], truth[:, 1:])
            grads = [np.stack([np.bincount(feature[at], by_feature[:, j], len(w)) for j in range(k)], 1) - DECAY * w,
                     seen - pair.sum((0, 1)), (truth[:, 0] - p[:, 0]).sum(0)]
            for x, g, s in zip(params, grads, sums):
                s += g * g
                x += RATE * g / np.sqrt(s)
    return Model([], params[0].astype(np.float32), params[1], params[2], lexicon)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learn from the labelled rows of ``docs`` that are not held out."""
    rows = (common.pick(docs, key=key, text=text, lang=lang)
            .where("key is not null and text is not null and lang is not null")
            .where(~held_out(F.col("key"))))
    counts = (rows.groupBy("lang").agg(F.count("*").alias("n"))
              .orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect())
    none = Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    if not counts:
        return none
    each = max(50, FIT_TEXTS // len(counts))
    part = F.pmod(F.xxhash64("key", "text"), F.lit(2**32))
    chosen = F.lit(False)
    for r in counts:
        chosen |= (F.col("lang") == r["lang"]) & (part < int(2**32 * min(1.0, each / r["n"])))
    found = rows.where(chosen).select("lang", "text").mapInPandas(_windows, "lang string, words string").collect()
    of: dict[str, list[list[str]]] = {}
    for r in sorted(map(tuple, found)):
        of.setdefault(r[0], []).append(r[1].split(" "))
    languages = sorted(of)
    if not languages:
        return none
    n = {r["lang"]: r["n"] for r in counts}
    share = _norm(np.array([n[x] for x in languages], float)) / 2 + 0.5 / len(languages)
    model = train([of[x] for x in languages], share)
    model.languages = languages
    return model


def tag(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", runs: bool = True) -> DataFrame:
    """(key, lang_pred, score, n_words, n_switches) of every row and, unless left
    out, its ``runs`` of one language (start, end, lang).  No shuffle."""
    rows = common.pick(docs, key=key, text=text).select("key", common.text_of(F.col("text")).alias("text"))
    schema = "lang_pred string, score double, n_words long, n_switches long"
    if runs:
        schema += ", runs array<struct<start: int, end: int, lang: string>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = model.reader()
        for b in batches:
            if len(b):
                got = reader.rows(b["text"].tolist(), runs)
                got.insert(0, "key", b["key"].to_numpy())
                yield got

    return common.through_python(rows, run, schema)


def predictions(tagged: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_words, n_switches)."""
    return tagged.select(F.col("key").alias("doc_id"), held_out(F.col("key")).alias("held_out"),
                         "lang_pred", "score", "n_words", "n_switches")
