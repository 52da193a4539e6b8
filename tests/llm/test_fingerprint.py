import hashlib
import random
import re
import struct

import pytest
import xxhash

from pyspark.sql import functions as F

from envstats.llm import fingerprint


def vectors(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return fingerprint.with_vector(df, "t", "v").orderBy("i")


def plain_vector(text):
    """The vector in plain Python, from the parts of a text."""
    split = [p.strip(" \t\r\n") for p in re.split(r"(?<=[.!?\n])(?=[^.!?\n])", text)]
    split = [p for p in split if p]

    def h(p, seed):
        return xxhash.xxh64_intdigest(struct.pack("<i", seed), xxhash.xxh64_intdigest(p.encode(), 42))
    bits = [sum(h(p, s) >> i + 21 * k & 1 for p in split) for s in (0, 1) for i in range(21) for k in range(3)]
    words = [a | b << 31 for a, b in zip(bits[::2], bits[1::2])]
    return words + [sum(h(p, s) >> 2 for p in split) % 2**63 for s in range(2, 6)] + [len(split)]


def plain_likeness(a, b):
    def lanes(v):
        return [2 * (w >> k & 2**31 - 1) - v[-1] for w in v[:63] for k in (0, 31)]
    x, y = lanes(a), lanes(b)
    size = (sum(i * i for i in x) * sum(i * i for i in y)) ** 0.5
    return 1.0 if a == b else max(0.0, min(1.0, sum(i * j for i, j in zip(x, y)) / size)) if size else 0.0


@pytest.mark.parametrize("most", [fingerprint.PIECE, 7])
def test_vectors_and_likeness_equal_plain_python(spark, monkeypatch, most):
    """Also where the bits of a text are summed in pieces (of 7 parts)."""
    monkeypatch.setattr(fingerprint, "PIECE", most)
    rnd = random.Random(9)
    lines = [f"Line {i} of a text, é{i}." for i in range(40)]
    texts = ["", "a", " \n ", "One. Two! Three?\nFour", *("\n".join(rnd.choices(lines, k=k)) for k in (7, 8, 14, 30, 99))]
    got = [r.v for r in vectors(spark, texts).collect()]
    assert [list(v) for v in got] == [plain_vector(t) for t in texts]
    df = spark.createDataFrame([(x, y) for x in got for y in got], "a array<long>, b array<long>")
    found = [r[0] for r in df.select(fingerprint.likeness(F.col("a"), F.col("b"))).collect()]
    assert found == pytest.approx([plain_likeness(list(x), list(y)) for x in got for y in got])


def test_counters_hold_millions_of_parts(spark):
    """2.0 and 2.2 million copies of one line point the same way: likeness 1; the
    sum of both vectors is that of 4.2 million."""
    one = next(vectors(spark, ["a"]).toLocalIterator()).v
    assert list(one) == plain_vector("a")

    def copies(n):
        return [n * w if k < 63 else n * w % 2**63 for k, w in enumerate(one)]
    df = spark.createDataFrame([(copies(2_000_000), copies(2_200_000))], "a array<long>, b array<long>")
    r = df.select(fingerprint.likeness(F.col("a"), F.col("b")).alias("near"),
                  fingerprint.add(F.col("a"), F.col("b")).alias("sum")).first()
    assert r.near > 0.999999 and list(r.sum) == copies(4_200_000)
    assert plain_likeness(copies(2_000_000), copies(2_200_000)) == pytest.approx(r.near)


def test_order_does_not_matter_and_parts_can_be_moved(spark):
    parts = [f"Paragraph number {i} has words." for i in range(50)]
    mixed = random.Random(1).sample(parts, 50)
    a, b, c, d = (r.v for r in vectors(spark, [
        "\n".join(parts), "\n".join(mixed), "\n".join(parts[:30]), "\n".join(parts[30:])]).collect())
    assert a == b and c != d
    df = spark.createDataFrame([(a, c, d)], "a array<long>, c array<long>, d array<long>")
    r = df.select(fingerprint.add(F.col("c"), F.col("d")).alias("sum"),
                  fingerprint.remove(F.col("a"), F.col("d")).alias("rest")).first()
    assert list(r.sum) == list(a) and list(r.rest) == list(c)


def test_likeness(spark):
    parts = [f"Sentence number {i} of one text." for i in range(200)]
    other = [f"Quite another line {i}." for i in range(200)]
    rows = [r.v for r in vectors(spark, [" ".join(parts), " ".join(parts[:150] + other[:50]),
                                         " ".join(other), ""]).collect()]
    df = spark.createDataFrame([(x, y) for x in rows for y in rows], "a array<long>, b array<long>")
    got = [r[0] for r in df.select(fingerprint.likeness(F.col("a"), F.col("b"))).collect()]
    table = [got[i:i + 4] for i in range(0, 16, 4)]
    assert all(table[i][i] == 1.0 for i in range(4)) and 0.6 < table[0][1] < 0.9
    assert table[0][2] < 0.3 and table[0][3] == 0.0 and all(0 <= x <= 1 for x in got)


def brute(pairs):
    rows = sorted(set(pairs), key=lambda p: p[0])
    out = {}
    for k, (i, t) in enumerate(rows):
        nxt, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        out[i] = (len(t), hashlib.sha256((t[:len(t) - half] + nxt[:half]).encode()).hexdigest())
    return out


def test_next_document_and_edit(make):
    rnd = random.Random(3)
    pairs = [(i * 13 % 401, "".join(rnd.choice("abé😀 .\n") for _ in range(rnd.randrange(300))))
             for i in range(401)]
    out = fingerprint.digests(fingerprint.with_next(make(pairs))).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in out} == brute(pairs)
    by = {r.doc_id: r for r in out}
    for i, t in pairs:
        assert len(by[i].fingerprint) == 16 * 68
    one = fingerprint.digests(fingerprint.with_next(make([(5, "abcd. efgh.")]))).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert one[0].edited_sha256 == hashlib.sha256(b"abcd. abcd.").hexdigest()


def test_odd_rows(odd, empty):
    out = fingerprint.digests(fingerprint.with_next(odd)).collect()
    assert len(out) == odd.count()
    fives = [r for r in out if r.doc_id == 5]
    assert fives[0] == fives[1] and len({r.fingerprint for r in out if r.doc_id in (1, 2, 3)}) == 1
    assert {r.fingerprint for r in out if r.doc_id == 6} == {fives[0].fingerprint}
    assert sum(r.doc_id is None for r in out) == 2
    assert fingerprint.digests(fingerprint.with_next(empty)).count() == 0


def test_plan_is_native(make):
    df = fingerprint.digests(fingerprint.with_next(make([(1, "a"), (2, "b")])))
    plan = df._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Generate"))
