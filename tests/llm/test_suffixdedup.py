import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from envstats.llm import common, losertree, suffixdedup

from .conftest import LONG


def brute(rows):
    """(id, text) -> sorted (id, n_bytes, n_removed, n_spans, sha256)."""
    least = {}
    data = [(2**63 - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for p in range(len(b) - 49):
            w = b[p:p + 50]
            least[w] = min(i, least.get(w, i))
    out = []
    for (i, b), (name, _) in zip(data, rows):
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if least[b[p:p + 50]] < i:
                gone[p:p + 50] = True
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((name, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(df):
    return sorted(map(tuple, suffixdedup.digests(suffixdedup.remove(df)).collect()), key=str)


def test_equals_brute_force(make):
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 8))) for _ in range(60)]
    passages = [" ".join(rnd.choice(words) for _ in range(30)) for _ in range(6)]
    rows = []
    for i in range(120):
        t = " ".join(rnd.choice(words) for _ in range(rnd.randrange(60)))
        for _ in range(rnd.randrange(3)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p))
            t += " " + p[a:a + rnd.randrange(20, 200)] + rnd.choice(words)
        rows.append((i * 7 % 120, t))
    rows += [(500, rows[3][1]), (501, "z" * 400), (502, "z" * 300), (503, "z" * 300 + rows[5][1])]
    assert run(make(rows)) == brute(rows)


def test_odd_rows_and_a_long_text(odd, empty, make):
    pairs = [tuple(r) for r in odd.toDF(*"abcdefgh").select("a", "b").collect()]
    assert run(odd) == brute(pairs)
    pairs = [(9, LONG), (3, LONG[100_000:250_000]), (10, LONG), (None, LONG[:2000]), (10, "x" + LONG)]
    assert run(make(pairs)) == brute(pairs)
    assert run(empty) == []


def _hot_rows():
    """A third of the documents hold a prefix in contexts of their own; some contexts repeat."""
    rnd = random.Random(5)
    rows = []
    for i in range(240):
        body = "".join(rnd.choice("abcdefghij ") for _ in range(150))
        if i % 3 == 0:
            body += " https://archive.example.org/item/" + str(i % 90) * 9 + body[:40]
        rows.append((i * 11 % 240, body))
    return rows + [(900, "-" * 500), (901, "=" + "-" * 300), (902, rows[0][1] + rows[3][1])]


def test_hot_anchors_are_found_and_change_no_result(make, monkeypatch):
    rows = _hot_rows()
    monkeypatch.setattr(suffixdedup, "SAMPLE", 1)
    data = common.pick(make(rows), doc="doc_id", data="text").withColumn("data", F.encode("data", "utf-8"))
    monkeypatch.setattr(suffixdedup, "HOT", 10)
    hot, entries = suffixdedup._hot_anchors(data)
    assert 1 <= len(hot) <= 30 and entries > 1000
    assert run(make(rows)) == brute(rows)
    monkeypatch.setattr(suffixdedup, "HOT", 1)           # every anchor
    assert run(make(rows)) == brute(rows)


def test_many_exact_copies_keep_the_least_id(make):
    text = "the same notice stands in a third of all documents, word for word"
    rows = [(i, text if i % 3 else f"{i} is a text of its own, number {i * i} of the table, and long enough")
            for i in range(600, 0, -1)] + [(None, text), (700, text[:49])]
    assert run(make(rows)) == brute(rows)


def test_no_bucket_holds_a_hot_anchor_alone():
    rows = _hot_rows()
    chunk = suffixdedup.Chunk([(i, 0, t.encode()) for i, t in rows if i < 900])
    first, end, at, h = chunk.entries()
    names, n = np.unique(h, return_counts=True)
    hot = names[n >= 10]

    def largest(*entries):
        where, size = np.unique(suffixdedup._bucket(entries[3], 64), return_counts=True)
        return size.max() / np.median(size)

    mine = np.isin(h, hot)
    only = [x[mine] for x in (first, end, at, h)]
    apart = suffixdedup._apart(chunk, *only, hot)
    assert len(np.unique(suffixdedup._bucket(only[3], 64))) <= len(hot)
    assert len(np.unique(suffixdedup._bucket(apart[3], 64))) == 64 and largest(*apart) < 3
    assert (apart[1] - apart[0] == 1).all() and len(apart[0]) == (only[1] - only[0]).sum()


def test_pieces_of_a_long_text_find_all(make, monkeypatch):
    monkeypatch.setattr(suffixdedup, "CHUNK", 300)
    rows = [(i, LONG[k:k + 2500]) for i, k in enumerate((5000, 5100, 0, 2400))]
    docs = [(i, 0, t.encode()) for i, t in rows]
    whole = {(d, w) for d, _, b in docs for w in (b[p:p + 50] for p in range(len(b) - 49))}
    seen = set()
    for c in suffixdedup._chunks(iter(docs)):
        first, end, at, _ = c.entries()
        for f, e, a in zip(first, end, at):
            for p in range(f, e):
                seen.add((int(c.doc[c.piece[p]]), c.buf[p:p + 50].tobytes()))
                assert p <= a <= p + 50 - suffixdedup.ANCHOR
    assert seen == whole


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.lists(st.integers(0, 2), min_size=3, max_size=3), max_size=12),
                min_size=1, max_size=40))
def test_loser_trees_merge_and_keep_prefixes(runs):
    """Two lanes of up to 40 streams: the output is sorted, with true prefixes."""
    rows, lcp, begin, end = [], [], [], []
    for k, run_ in enumerate(runs):
        b, e = [], []
        for lane in range(2):
            keys = sorted(x for x in run_ if x[2] % 2 == lane)
            b.append(len(rows))
            for i, x in enumerate(keys):
                rows.append(x)
                prev = keys[i - 1] if i else None
                lcp.append(next((j for j in range(3) if x[j] != prev[j]), 3) if prev else 0)
            e.append(len(rows))
        begin.append(b)
        end.append(e)
    words = np.array(rows, np.uint64).reshape(-1, 3)
    row, shared = losertree.merge(words, np.arange(len(rows)), np.array(lcp, np.int64),
                                  np.array(begin), np.array(end))
    got = [rows[i] for i in row]
    want = [sorted(x for r in runs for x in r if x[2] % 2 == lane) for lane in range(2)]
    assert got == want[0] + want[1]
    for i, x in enumerate(got):
        first = i in (0, len(want[0]))
        assert shared[i] == (0 if first else next(
            (j for j in range(3) if x[j] != got[i - 1][j]), 3))


def test_front_coding_round_trip():
    chunk = suffixdedup.Chunk([(4, 0, LONG[:3000].encode()), (8, 7, LONG[500:2500].encode())])
    first, end, at, h = chunk.entries()
    rows = suffixdedup._one_run(chunk, first, end, at, h, 3)
    found = []
    for _, kind, block in rows:
        if kind == 0:
            _, key, right, left, doc, place = suffixdedup.decode_run(block)
            found += [(int(d), int(p), k[:r].tobytes(), k[56:56 + n].tobytes()[::-1])
                      for d, p, k, r, n in zip(doc, place, key, right, left)]
    texts = {4: (0, LONG[:3000].encode()), 8: (7, LONG[500:2500].encode())}
    for d, p, right, left in found:
        shift, text = texts[d]
        assert text[p - shift:].startswith(left + right)
