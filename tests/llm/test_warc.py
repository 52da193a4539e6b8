import hashlib
import random

import pytest
import zstandard

from envstats.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    def rows(items):
        return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in items],
                                     "page_id long, url string, html string, digest string, URL string")
    return rows


def brute(items):
    best = {}
    for i, _, h in items:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            best[b] = max(i, best.get(b, i))
    out = []
    for i, u, h in items:
        b = (h or "").encode()
        to = best.get(b) if i is not None and len(b) >= 1000 and i < best[b] else None
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if to is not None else "response",
                    to, u))
    return sorted(out, key=str)


def items():
    rnd = random.Random(6)
    words = "some words that make up the pages of this little archive éü".split()
    out = [(i, f"http://h{i % 5}.example.com/p?q={i} x", "".join(
        f"<p>{' '.join(rnd.choice(words) for _ in range(20))}</p>" for _ in range(12)))
        for i in range(300)]
    big, edge, small = "é" * 500, "e" * 1000, "s" * 999
    out += [(1000 + k, None, t) for k, t in enumerate([big, big, big, edge, edge, small, small])]
    out += [(2000, "http://a/\r\nb", None), (2001, "", ""), (None, "u", big), (None, None, None),
            (1002, "again", big), (2**62 + 1, "u", "y" * 3_000_000)]
    return out


def test_round_trip_equals_brute_force(pages):
    rows = items()
    assert sorted(map(tuple, warc.round_trip(pages(rows)).collect()), key=str) == brute(rows)


def test_payloads_come_back_and_archives_roll(pages, spark, tmp_path, monkeypatch):
    rows = items()
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    warc.write(pages(rows), f"file://{tmp_path}/a")
    back = {(r.page_id, r.url): r for r in warc.read_archives(spark, f"file://{tmp_path}/a").collect()}
    for i, u, h in rows:
        r = back[i, u]
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == (h or "").encode()
    assert not list((tmp_path / "a").glob("_*"))


def test_empty_table(pages):
    assert warc.round_trip(pages([])).count() == 0


def archive(records, dictionary=b"", level=3):
    coder = zstandard.ZstdCompressor(
        level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    return warc.leading_frame(dictionary) + b"".join(coder.compress(r) for r in records)


def a_record(payload=b"<p>hi</p>", **other):
    digest = hashlib.sha1(payload).hexdigest()
    return warc.record(other.get("page", 1), "http://a", payload, other.get("digest", digest),
                       other.get("refers"), other.get("length", len(payload)))


def test_dictionary_of_the_leading_frame_is_needed():
    rnd = random.Random(1)
    samples = [bytes(rnd.choice(b"abcdefgh <>/p") for _ in range(4000)) for _ in range(200)]
    held = warc.train(samples)
    assert held and warc.train(samples[:3]) == b""
    data = archive([a_record(s) for s in samples[:20]], held)
    assert [r["payload"] for r in warc.read_archive(data)] == samples[:20]
    other = warc.leading_frame(b"") + data[8 + len(held):]
    with pytest.raises(warc.ArchiveError):
        list(warc.read_archive(other))


@pytest.mark.parametrize("broken", [
    b"", b"junk that is no archive at all", archive([a_record()])[8:], archive([a_record()]) + b"tail",
    archive([a_record()])[:-3], archive([a_record(digest="0" * 40)]), archive([a_record(length=3)]),
    archive([a_record() + b"x"]), archive([a_record().replace(b"WARC-Date", b"WARC-Dat")]),
    archive([a_record().replace(b"WARC/1.1", b"WARC/9.9")]),
    archive([a_record().replace(b"response\r\nWARC-R", b"metadata\r\nWARC-R")]),
    archive([a_record().replace(b"urn:page:1", b"urn:other:1")])])
def test_broken_archives_raise(broken):
    with pytest.raises((warc.ArchiveError, ValueError)):
        list(warc.read_archive(broken))
