import random

import numpy as np

from envstats.llm import html, suffixarray


def ids(tokens):
    return bytearray(np.array(tokens, np.uint64).astype(">u8").tobytes())


def shared(x, y):
    return next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))


def test_order_prefixes_and_intervals_are_those_of_all_suffixes(spark):
    """Brute force over a run of one token, long repeats, few letters, streams inside others, large ids."""
    rng = random.Random(5)
    repeat = [2**63 + i for i in range(40)]
    streams = [[7] * 30, [7] * 21, [], repeat + [1] + repeat[:25], repeat + [2] + repeat[:25], repeat[3:], [9]]
    streams += [[rng.randint(0, 1) for _ in range(rng.randint(1, 40))] for _ in range(8)]
    streams += [[3, *s] for s in streams[:6]]
    rows = {7 * i - 50: s for i, s in enumerate(streams)}
    width = 6
    got = sorted((r.rank, r.stream, r.at, r.lcp, tuple(r.interval)) for r in suffixarray.intervals(
        spark.createDataFrame([(i, ids(s)) for i, s in rows.items()], "stream long, ids binary"), width).collect())
    want = sorted((s[at:], i, at) for i, s in rows.items() for at in range(len(s)))
    assert [(i, at) for _, i, at in want] == [x[1:3] for x in got]
    lcp = [0, *(shared(a[0], b[0]) for a, b in zip(want, want[1:]))]
    assert [x[3] for x in got] == lcp and max(lcp) > 4 * width
    begin = None
    for x, n in zip(got, lcp):
        begin = x[:2] if n < width else begin
        assert x[4] == begin


def test_arrays_of_groups_are_those_of_their_suffixes(spark, monkeypatch):
    """Brute force: small groups by one task, a large one by ranges."""
    rng = random.Random(6)
    long = [2**63 + i for i in range(40)]
    streams = [[7] * 30, [7] * 21, [], long + [1] + long[:25], long + [2] + long[:25], long[3:], [9]]
    streams += [[rng.randint(0, 1) for _ in range(rng.randint(1, 40))] for _ in range(12)]
    streams += [[5] + streams[7], streams[7][2:], [8, 8, 8, 4, 8, 8, 8]]
    monkeypatch.setattr(suffixarray, "BIN", 100)
    for whole in (150, 10_000):
        monkeypatch.setattr(suffixarray, "WHOLE", whole)
        sets, rows = {}, []
        for i, s in enumerate(streams):
            group = "big" if i < 7 else f"g{i % 3}"
            ids_ = [x * 8 + ("big", "g0", "g1", "g2").index(group) for x in s] if group != "big" else s
            ids_ = [x + (1 << 40) * ("big", "g0", "g1", "g2").index(group) for x in ids_]
            sets.setdefault(group, []).append((i, ids_))
            rows.append((group, i, ids(ids_)))
        table = spark.createDataFrame(rows, "host string, stream long, ids binary")
        got = {}
        for r in suffixarray.group_intervals(table, 3, "host").collect():
            got.setdefault(rows[r.stream][0], []).append((r.stream, r.at, r.lcp, r.rest, tuple(r.interval)))
        begins = {}
        for group, held in sets.items():
            want = sorted((s[at:], i, at) for i, s in held for at in range(len(s)))
            lcp = {w[1:]: shared(a, w[0]) for (a, *_), w in zip([([],), *want], want)}
            mine = {x[:2]: x for x in got[group]}
            assert {k: (x[3]) for k, x in mine.items()} == {(i, at): len(s) for s, i, at in want}
            assert {k for k, n in lcp.items() if n >= 3} == {k for k, x in mine.items() if x[2] >= 3}
            inside = {}
            for s, i, at in want:
                if lcp[i, at] < 3:
                    first = (i, at)
                inside.setdefault(mine[i, at][4], set()).add(first)
            assert all(len(x) == 1 for x in inside.values())
            assert len(inside) == len(set().union(*inside.values())) and not begins.keys() & inside.keys()
            begins |= inside


def test_one_task_and_ranges_agree(spark):
    rng = random.Random(7)
    streams = [[rng.randint(0, 2) for _ in range(rng.randint(0, 60))] for _ in range(10)] + [[1] * 50, [1] * 50]
    whole = suffixarray.array_of(np.arange(len(streams)) - 3, [bytes(ids(s)) for s in streams], 4)
    got = sorted((r["rank"], r.stream, r.at, r.lcp, r.rest, *r.interval) for r in suffixarray.intervals(
        spark.createDataFrame([(i - 3, ids(s)) for i, s in enumerate(streams)], "stream long, ids binary"), 4).collect())
    assert [tuple(map(int, r)) for r in whole[["rank", "stream", "at", "lcp", "rest", "first", "of"]].values] == got


def test_ids_of_hosts_differ():
    words = [{"text": "one two"}, {"text": "one"}]
    a, b = (np.frombuffer(html._ids(h, words), ">u8") for h in ("a.org", "b.org"))
    assert a[0] == a[2] != a[1] and not set(a) & set(b)
