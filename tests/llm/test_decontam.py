import random

import pytest

from envstats.llm import decontam


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, "A train leaves the old station at 40 km per hour and Alice Brown waits 3 hours "
                 "before the second train leaves the same station."),
             (2, "The quick brown fox jumps over the lazy dog while nine tired cats look on quietly."),
             (3, "short item of five words"), (4, "What is dark matter?"), (5, None), (6, "?!"),
             (7, "1 2 3 4 5 6 7 8 9 10 11 12")]
    return spark.createDataFrame([(i, t, "x", "y") for i, t in items],
                                 "item_id long, text string, key string, Item_ID string")


FILL = "some filler words that stand in no benchmark item at all and go on for a while"


def found(docs, benchmark):
    return {(r.doc_id, r.item_id): r for r in
            decontam.matches(decontam.find(docs, benchmark)).collect()}


def test_literal_and_reparameterised_items_are_found(make, benchmark):
    docs = make([
        (10, f"{FILL}. A train leaves the old station at 40 km per hour and Alice Brown waits 3 hours "
             f"before the second train leaves the same station. {FILL}"),
        (11, f"{FILL}. A train leaves the old station at 95 km per hour and Bob Smith waits 7 hours "
             "before the second train leaves the same station."),
        (12, "THE QUICK | BROWN FOX *** jumps, over the lazy dog while 9 tired cats look on quietly"),
        (13, f"{FILL} the quick brown fox jumps over {FILL}"),
        (14, f"{FILL} short item of five words {FILL}"), (15, FILL), (16, "Quiz: what is dark matter? Think."),
        (18, "What is matter? Dark is what?"), (17, "11 12 13 14 15 16 17 18 19 20 21 22")])
    got = found(docs, benchmark)
    assert set(got) == {(10, 1), (11, 1), (12, 2), (14, 3), (16, 4)}
    assert not got[10, 1].reparameterised and got[11, 1].reparameterised
    assert got[10, 1].coverage > 0.9 and got[14, 3].n_windows == 1


def test_inconsistent_slots_are_rejected(make, spark):
    bench = spark.createDataFrame([(1, "take 5 red balls and put 5 blue balls into box 5 then remove "
                                       "5 balls from the box")], "item_id long, text string")
    same = "take 8 red balls and put 8 blue balls into box 8 then remove 8 balls from the box"
    mixed = "take 8 red balls and put 6 blue balls into box 7 then remove 9 balls from the box"
    assert set(found(make([(1, same), (2, mixed)]), bench)) == {(1, 1)}


def test_random_texts_equal_brute_force(make, spark):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdefghi") for _ in range(rnd.randrange(2, 7))) for _ in range(80)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(8, 30)))) for i in range(40)]
    rows = []
    for d in range(200):
        t = [rnd.choice(words) for _ in range(30)]
        if d % 3 == 0:
            w = items[rnd.randrange(40)][1].split()
            a = rnd.randrange(len(w))
            t[10:10] = w[a:a + rnd.randrange(8, 31)]
        rows.append((d, " ".join(t)))
    bench = spark.createDataFrame(items, "item_id long, text string")

    def grams(t):
        w = t.split()
        return [tuple(w[i:i + 8]) for i in range(len(w) - 7)]

    want = {}
    for d, t in rows:
        have = set(grams(t))
        for i, s in items:
            g = grams(s)
            n = sum(x in have for x in g)
            if n / len(g) >= decontam.COVERAGE:
                want[d, i] = n
    assert {k: r.n_matched for k, r in found(make(rows), bench).items()} == want


def test_without_the_broadcast_filter_the_rows_are_the_same(make, benchmark, monkeypatch):
    docs = make([(12, "the quick brown fox jumps over the lazy dog while nine tired cats look on"),
                 (13, FILL)])
    want = found(docs, benchmark)
    monkeypatch.setattr(decontam, "fits_broadcast", lambda df: False)
    assert found(docs, benchmark) == want and want


def test_short_items_are_found_verbatim(make, spark):
    """Items of one to four units: an exact copy anywhere, no part of one."""
    items = [(1, "Photosynthesis"), (2, "dark matter"), (3, "E = mc2"), (4, "春天"), (5, "Who wrote it?"), (6, "...")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make([(1, f"{FILL} photosynthesis, {FILL}"), (2, "All dark; matter dark"), (3, "matter, DARK MATTER"),
                 (4, "so E = mc2 holds"), (5, "今天春天来了"), (6, "who wrote it"), (7, FILL), (8, "...")])
    assert set(found(docs, bench)) == {(1, 1), (2, 2), (3, 2), (4, 3), (5, 4), (6, 5)}


def test_repetitive_text_has_one_row(make, spark):
    """An item of one unit in a text that repeats it: many alignments, one place."""
    bench = spark.createDataFrame([(1, "again"), (2, "again and again and again and again and")], "item_id long, text string")
    got = found(make([(1, "again and " * 3000), (2, "again")]), bench)
    assert set(got) == {(1, 1), (1, 2), (2, 1)} and got[1, 1].n_matched == 1


def test_odd_rows(odd, empty, make, benchmark):
    assert found(odd, benchmark) == {} and found(empty, benchmark) == {}
    assert found(odd, benchmark.limit(0)) == {}
    bad = "the quick brown fox jumps over the lazy dog while nine tired cats look on quietly"
    df = odd.union(make([(7, bad), (None, bad), (9, bad), (9, bad)]))
    out = decontam.remove(df, benchmark)
    assert out.columns == df.columns and out.count() == odd.count()
    assert decontam.remove(empty, benchmark).count() == 0


def test_verbatim_copies_without_enough_literal_tokens_are_found(make, spark):
    """Names, numbers, and texts without spaces: exact copies match, others do not."""
    names = "Alice Brown Bob Smith Carol Jones Dave Miller Eve Stone"
    numbers = " ".join(map(str, range(1, 13)))
    han = "春天来了花园里开满了红色和黄色的花朵孩子们在草地上奔跑"
    code = "".join(f"k{i}q" for i in range(30))
    items = [(1, names), (2, numbers), (3, han), (4, code), (5, "Five Names Of One Town")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    other = "Frank Brown Gina Smith Henry Jones Ida Miller John Stone"
    docs = make([(1, f"{FILL}. {names} {FILL}"), (2, f"{FILL} {numbers}, {FILL}"),
                 (3, f"今天老师说{han}。大家都笑了"), (4, f"{FILL} ({code}) {FILL}"),
                 (5, f"we saw Five Names Of One Town Hall {FILL}"), (6, f"{FILL}. {other} {FILL}"),
                 (7, " ".join(map(str, range(21, 33)))), (8, "今天天气很好我们一起去公园散步吧"),
                 (9, names), (10, han)])
    got = found(docs, bench)
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (9, 1), (10, 3)}
    assert not any(r.reparameterised for r in got.values())


def test_one_other_value_discards_its_windows_only(make, spark):
    """A name that runs on, and one altered number in a long copy."""
    shared = ("in the first year {0} apples were sold at the market and later that summer the farmer "
              "counted {0} more while his daughter drove the old cart back home through the wide "
              "valley where nobody had seen such a harvest before and so {1} crates went to {2}")
    meets = "when {0} walks to the old mill she asks the miller for {0}"
    bench = spark.createDataFrame([(1, shared.format(40, 40, "the north")), (2, meets.format("Anna Lee"))],
                                  "item_id long, text string")
    docs = make([
        (1, f"{FILL}. {shared.format(40, 41, 'the north')} {FILL}"),      # one number altered
        (2, f"{FILL}. {shared.format(70, 71, 'the north')} {FILL}"),      # others, one of them odd
        (3, f"{FILL}. {meets.format('Anna Lee')} Next Chapter {FILL}"),   # the last name runs on
        (4, f"{FILL}. {meets.format('Ida Moor')} Next Chapter {FILL}"),
        (5, f"{FILL}. {meets.format('Anna Lee')}. {FILL}"), (6, FILL)])
    got = found(docs, bench)
    assert set(got) == {(1, 1), (2, 1), (3, 2), (4, 2), (5, 2)}
    assert got[2, 1].reparameterised and got[4, 2].reparameterised
    assert not got[3, 2].reparameterised and not got[5, 2].reparameterised
    assert got[2, 1].n_matched < got[2, 1].n_windows
