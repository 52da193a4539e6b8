"""Exact substring removal (operator 2): distributed merge of suffix runs.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id.  Instead of all suffixes, one per *anchor* is
sorted: the anchor of a window of ``LENGTH`` bytes is its ``ANCHOR``-byte gram
of least hash, which depends on the window's bytes alone, so equal windows
have equal anchors at equal offsets.  Neighbouring windows mostly share one;
an entry is an anchor with the windows that own it, i.e. the suffix at the
anchor (up to LENGTH bytes) and the bytes before it.

0. A text of LENGTH bytes or more that a smaller id has, too, goes whole; it
   takes no part in what follows (its windows all stand in the smaller one).
1. Tasks send the hashes of their anchors in sorted, delta-coded runs (one
   entry per run and hash, with its document, or a mark when several
   documents of the run have it).  Anchors of a single document are unique
   and end here - most of them.
2. For the others, tasks build runs of entries sorted by suffix, front-coded
   (common prefix with the entry before, then the rest), and exchange them by
   anchor hash.  An entry that repeats in the run is sent once, for the
   smallest document; the larger ones' windows are known to go.
   An anchor with many different contexts (a URL prefix, a rule of dashes) is *hot*:
   its entries are cut into single windows, which go to the bucket of the
   window's own hash, so that no bucket holds all contexts of one anchor.
3. Each bucket merges its runs with LCP loser trees (``losertree``).  A common
   prefix of ANCHOR bytes makes a group; inside it, windows with equal bytes
   are found by their hashes, and a window goes if its smallest document is
   smaller than its own.
4. Documents meet the ranges found for them.

Runs come from bounded chunks of text, buckets grow with the input and the number
of shuffle partitions, and a passage that a third of all documents share is one
entry per run.  Hot anchors are found in a hash sample of the documents; which
ones are found changes where windows are compared, never the result.  Matches never cross documents: windows are taken inside one text.

Defined results: null text is the empty text; a null id is larger than all
others; rows that share an id are apart (equal ids are not smaller) and get
their own results; an empty table gives an empty table; a text of any length
is processed whole, in overlapping pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envstats.llm import common, losertree

LENGTH = 50
ANCHOR = 24                     # bytes of an anchor: three words of a key
WINDOWS = LENGTH - ANCHOR + 1   # grams of a window
CHUNK = 6 << 20                 # bytes of text in one run
RIGHT, LEFT = 56, 32            # key bytes: suffix from the anchor, bytes before it (reversed)
SENT = 6                        # bytes of an anchor hash that are sent (a collision costs time only)
LANES = 2048                    # independent merges of a bucket
BUCKETS = 4                     # buckets per shuffle partition
BUCKET_ENTRIES = 500_000        # anchors of a bucket, as estimated; more buckets up to BUCKETS_MOST
BUCKETS_MOST = 4096             # (beyond it the shuffle partitions set their number)
SAMPLE = 64                     # one document in SAMPLE is looked at for hot anchors
HOT = 64                        # different contexts in the sample from which an anchor is hot
HOT_MOST = 1 << 14              # hot anchors at most: HOT grows with the sample
SALTS = 256                     # parts of a group of exact copies
PIECE = 200_000                 # document numbers in one row that only passes through
_LAST = 2**63 - 1               # stands for a null id
_MANY = -(2**63)                # several documents of a run have this anchor


# -- packing --------------------------------------------------------------------
def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block; integers by byte planes."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        out.append(f"{a.dtype.str}{len(a)}\n".encode())
        out.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def unpack(block: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(block), 0, []
    while at < len(data):
        end = data.index(b"\n", at)
        dtype, n = np.dtype(data[at:at + 3].decode()), int(data[at + 3:end])
        at = end + 1
        planes = np.frombuffer(data, np.uint8, n * dtype.itemsize, at).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(dtype).ravel())
        at += n * dtype.itemsize
    return out


# -- anchors ----------------------------------------------------------------------
class Chunk:
    """Texts (or pieces of long ones) laid end to end."""

    def __init__(self, pieces: list[tuple[int, int, bytes]]):
        """pieces: (document, position of the piece in it, bytes)."""
        n = np.array([len(p[2]) for p in pieces], np.int64)
        self.buf = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
        self.doc = np.array([p[0] for p in pieces], np.int64)
        self.shift = np.array([p[1] for p in pieces], np.int64) - (np.cumsum(n) - n)
        self.piece = np.repeat(np.arange(len(pieces), dtype=np.int32), n)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first window, end of windows, anchor, anchor hash) in the buffer."""
        size = len(self.buf)
        none = np.zeros(0, np.int64)
        if size < LENGTH:
            return none, none, none, none.astype(np.uint64)
        words = np.zeros(size - 7, np.uint64)
        for j in range(8):
            words <<= np.uint64(8)
            words |= self.buf[j:j + size - 7]
        grams = size - ANCHOR + 1
        h = np.zeros(grams, np.uint64)
        for j in range(0, ANCHOR, 8):                 # in place: a chunk's arrays are large
            h ^= h >> np.uint64(32)
            h ^= words[j:j + grams]
            h *= np.uint64(0x9E3779B97F4A7C15)
        del words
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        least = h >> np.uint64(32)
        least <<= np.uint64(32)
        least |= np.arange(grams, dtype=np.uint64)
        span = 1
        while span * 2 <= WINDOWS:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < WINDOWS:
            least = np.minimum(least[:len(least) - (WINDOWS - span)], least[WINDOWS - span:])
        least &= np.uint64(0xFFFFFFFF)
        anchor = least.view(np.int64)
        inside = self.piece[:len(anchor)] == self.piece[LENGTH - 1:]
        turn = np.append(True, (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1]))
        first = np.flatnonzero(turn)
        end = np.append(first[1:], len(anchor))
        ok = inside[first]
        first, end = first[ok], end[ok]
        return first, end, anchor[first], h[anchor[first]] >> np.uint64(64 - 8 * SENT)


def _chunks(docs: Iterator[tuple[int, int, bytes]]) -> Iterator[Chunk]:
    """Chunks of about CHUNK bytes; long texts in pieces that overlap by LENGTH - 1."""
    pieces, total = [], 0
    for doc, shift, data in docs:
        for at in range(0, max(1, len(data) - LENGTH + 1), CHUNK):
            piece = data[at:at + CHUNK + LENGTH - 1]
            pieces.append((doc, shift + at, piece))
            total += len(piece)
            if total >= CHUNK:
                yield Chunk(pieces)
                pieces, total = [], 0
    if pieces:
        yield Chunk(pieces)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["bucket", "kind", "block"])


# -- 0: hot anchors ------------------------------------------------------------------
def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(anchor hash, context hash) of the entries of each chunk, each once."""
    for chunk in _chunks((0, 0, t) for b in batches for t in b["data"]):
        first, end, at, h = chunk.entries()
        around = _byte_hash(chunk.buf, first, end - 1 + LENGTH)
        yield pd.DataFrame({"anchor": h.astype(np.int64),
                            "context": around.view(np.int64)}).drop_duplicates()


def _byte_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of short byte strings of ``buf``, a slice of them at a time."""
    out = np.zeros(len(start), np.uint64)
    for k in range(0, len(start), PIECE):
        i, n = start[k:k + PIECE], (end - start)[k:k + PIECE]
        h = n.astype(np.uint64)
        for j in range(int(n.max())):
            more = j < n
            h[more] = (h[more] ^ buf[i[more] + j]) * np.uint64(0x9E3779B97F4A7C15)
            h[more] ^= h[more] >> np.uint64(32)
        out[k:k + PIECE] = h
    return out


def _hot_anchors(rows: DataFrame) -> tuple[np.ndarray, int]:
    """(hashes of hot anchors, about the number of entries) from a sample of the
    texts; at most HOT_MOST hashes reach the driver."""
    part = F.pmod(F.xxhash64("doc", "data"), F.lit(SAMPLE))
    seen = (rows.where((F.octet_length("data") >= LENGTH) & (part == 0)).select("data")
            .mapInPandas(_contexts, "anchor long, context long").distinct()
            .groupBy("anchor").agg(F.count("*").alias("n")))
    seen = common.written(seen, "contexts")
    total = seen.agg(F.sum("n")).first()[0] or 0
    hot = seen.where(F.col("n") >= F.lit(max(HOT, total // HOT_MOST))).select("anchor").collect()
    return np.sort(np.array([r[0] for r in hot], np.int64)).astype(np.uint64), total * SAMPLE


# -- 1: anchors of more than one document --------------------------------------------
def _anchor_runs(buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs = ((d, s, t) for b in batches for d, s, t in zip(b["doc"], b["shift"], b["data"]))
        for chunk in _chunks(docs):
            _, _, at, h = chunk.entries()
            doc = chunk.doc[chunk.piece[at]]
            order = np.lexsort((doc, h))
            h, doc = h[order], doc[order]
            new = np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))[:len(h)]
            h, doc = h[new], doc[new]
            start = np.flatnonzero(np.append(True, h[1:] != h[:-1])[:len(h)])
            size = np.diff(np.append(start, len(h)))
            rows = _passing(doc[np.repeat(size > 1, size)], h[np.repeat(size > 1, size)], buckets, 1)
            h, doc = h[start], np.where(size > 1, _MANY, doc[start])
            where = _bucket(h, buckets)
            order = np.argsort(where, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(where[order])) + 1):
                if len(part):
                    rows.append((int(where[part[0]]), 0, pack(
                        np.diff(h[part], prepend=np.uint64(0)), doc[part])))
            yield _frame(rows)

    return run


def _passing(doc: np.ndarray, value: np.ndarray, buckets: int, kind: int) -> list[tuple]:
    """Rows that a bucket only hands on, spread over the buckets."""
    order = np.argsort(doc, kind="stable")
    doc, value = doc[order], value[order]
    return [(int(hash((int(doc[k]), int(value[k]))) % buckets), kind,
             pack(doc[k:k + PIECE], value[k:k + PIECE])) for k in range(0, len(doc), PIECE)]


def _by_document(doc: np.ndarray, value: np.ndarray, kind: int) -> pd.DataFrame:
    """(doc, kind, block): one row per document, its values as 8-byte integers
    (anchor hashes, kind 0, by the bytes that are sent)."""
    order = np.argsort(doc, kind="stable")
    doc, value = doc[order], value[order]
    start = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])[:len(doc)])
    data = value.view(np.uint8).reshape(-1, 8)[:, :8 if kind else SENT]
    return pd.DataFrame({"doc": doc[start].astype(np.int64), "kind": kind, "block": [
        data[i:j].tobytes() for i, j in zip(start, np.append(start[1:], len(doc)))]})


def _hashes(blocks: list[bytes]) -> np.ndarray:
    """Distinct anchor hashes of ``_by_document`` blocks."""
    data = np.frombuffer(b"".join(blocks), np.uint8).reshape(-1, SENT)
    wide = np.zeros((len(data), 8), np.uint8)
    wide[:, :SENT] = data
    return np.unique(wide.view(np.uint64).ravel())


def _shared_anchors(group: pd.DataFrame) -> pd.DataFrame:
    """Anchors of a bucket that more than one document has."""
    found = [_by_document(*unpack(b), 0) for b in group.loc[group["kind"] == 1, "block"]]
    runs = [unpack(b) for b in group.loc[group["kind"] == 0, "block"]]
    if runs:
        h = np.concatenate([np.cumsum(r[0], dtype=np.uint64) for r in runs])
        doc = np.concatenate([r[1] for r in runs])
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        start = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        end = np.append(start[1:], len(h))
        shared = np.repeat((doc[start] != doc[end - 1]) | (doc[start] == _MANY), end - start)
        found.append(_by_document(doc[shared & (doc != _MANY)], h[shared & (doc != _MANY)], 0))
    return pd.concat(found)


# -- 2: front-coded runs of entries -------------------------------------------------
_BEFORE = np.arange(LEFT)
_AFTER = np.arange(RIGHT)


def _keys(chunk: Chunk, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Key bytes: the suffix at the anchor, then the bytes before it, reversed;
    zero beyond their lengths."""
    padded = np.concatenate([np.zeros(LEFT, np.uint8), chunk.buf, np.zeros(RIGHT, np.uint8)])
    key = np.empty((len(at), RIGHT + LEFT), np.uint8)
    key[:, :RIGHT] = padded[at[:, None] + LEFT + _AFTER] * (_AFTER < right[:, None])
    key[:, RIGHT:] = padded[at[:, None] + LEFT - 1 - _BEFORE] * (_BEFORE < left[:, None])
    return key


def _entry_runs(buckets: int, hot: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted: dict[int, np.ndarray] = {}

        def docs() -> Iterator[tuple[int, int, bytes]]:
            for b in batches:
                for d, s, t, blocks in zip(b["doc"], b["shift"], b["data"], b["blocks"]):
                    if blocks is not None and len(blocks):
                        wanted[d] = _hashes(blocks)
                        yield d, s, t

        for chunk in _chunks(docs()):
            first, end, at, h = chunk.entries()
            piece = chunk.piece[at]
            cut = np.searchsorted(piece, np.arange(len(chunk.doc) + 1))
            keep = np.concatenate([np.zeros(0, bool), *(
                np.isin(h[i:j], wanted[d], kind="sort")
                for i, j, d in zip(cut[:-1], cut[1:], chunk.doc.tolist()))])
            last = chunk.doc[-1]
            wanted = {last: wanted[last]}
            yield _frame(_one_run(chunk, *_apart(
                chunk, first[keep], end[keep], at[keep], h[keep], hot), buckets))

    return run


def _apart(chunk: Chunk, first: np.ndarray, end: np.ndarray, at: np.ndarray, h: np.ndarray,
           hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """The entries, those of hot anchors as one entry per window with the window's hash."""
    is_hot = np.isin(h, hot)
    if not is_hot.any():
        return first, end, at, h
    f, count = first[is_hot], (end - first)[is_hot]
    window = np.repeat(f, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    own = _byte_hash(chunk.buf, window, window + LENGTH) >> np.uint64(64 - 8 * SENT)
    return tuple(np.concatenate([x[~is_hot], y]) for x, y in (
        (first, window), (end, window + 1), (at, np.repeat(at[is_hot], count)), (h, own)))


def _one_run(chunk: Chunk, first: np.ndarray, end: np.ndarray, at: np.ndarray, h: np.ndarray,
             buckets: int) -> list[tuple]:
    if not len(at):
        return []
    doc = chunk.doc[chunk.piece[at]]
    place = first + chunk.shift[chunk.piece[at]]         # position of the first window
    left, right = at - first, end - 1 + LENGTH - at
    count = end - first
    key = _keys(chunk, at, left, right)
    rank = np.unique(key.view(f"S{RIGHT + LEFT}").ravel(), return_inverse=True)[1]
    home = (_bucket(h, buckets) * LANES + (h % np.uint64(LANES)).astype(np.int64))
    order = np.lexsort((place, doc, right, left, rank, home))
    rank, home, doc, place, left, right, count = (
        x[order] for x in (rank, home, doc, place, left, right, count))
    key = key[order]
    new = np.append(True, (rank[1:] != rank[:-1]) | (left[1:] != left[:-1])
                    | (right[1:] != right[:-1]))
    leader = np.flatnonzero(new)[np.cumsum(new) - 1]
    # repeats in the run: of a larger document all windows go, of the same one
    # they share the fate of its first
    gone = ~new & (doc != doc[leader])
    same = ~new & (doc == doc[leader])
    rows = _passing(doc[gone], _code(place[gone], np.zeros(gone.sum(), np.int64), count[gone]),
                    buckets, 1)
    pairs = np.stack([place[leader[same]], place[same]], 1) if same.any() else None
    if pairs is not None:
        twice = np.repeat(doc[same], 2)
        rows += _passing(twice, pairs.ravel(), buckets, 2)
    pick = np.flatnonzero(new)
    key, home, doc, place, left, right = (x[pick] for x in (key, home, doc, place, left, right))
    equal = key[1:, :RIGHT] == key[:-1, :RIGHT]
    lcp = np.append(0, np.where(equal.all(1), RIGHT, equal.argmin(1)))
    lcp[np.append(True, home[1:] != home[:-1])] = 0
    lcp = np.minimum(lcp, right)
    stored = np.concatenate([(_AFTER >= lcp[:, None]) & (_AFTER < right[:, None]),
                             _BEFORE < left[:, None]], 1)
    where = home // LANES
    for part in np.split(np.arange(len(where)), np.flatnonzero(np.diff(where)) + 1):
        rows.append((int(where[part[0]]), 0, pack(
            (home[part] % LANES).astype(np.uint16), lcp[part].astype(np.uint8),
            right[part].astype(np.uint8), left[part].astype(np.uint8), doc[part], place[part],
            key[part][stored[part]])))
    return rows


def _code(place: np.ndarray, skip: np.ndarray, count: np.ndarray) -> np.ndarray:
    """One range of windows of an entry: its place, windows skipped, windows."""
    return place << 12 | skip << 6 | count


def decode_run(block: bytes) -> tuple[np.ndarray, ...]:
    """(lane, key bytes, right, left, doc, place) of a front-coded run."""
    lane, lcp, right, left, doc, place, data = unpack(block)
    lcp, right, left = (x.astype(np.int64) for x in (lcp, right, left))
    n = len(lane)
    key = np.zeros((n, RIGHT + LEFT), np.uint8)
    stored = np.concatenate([(_AFTER >= lcp[:, None]) & (_AFTER < right[:, None]),
                             _BEFORE < left[:, None]], 1)
    key[stored] = data
    rows = np.arange(n)
    for j in range(int(lcp.max(initial=0))):
        take = j < lcp
        source = np.maximum.accumulate(np.where(take, 0, rows))
        key[take, j] = key[source[take], j]
    return lane.astype(np.int64), key, right, left, doc, place


# -- 3: merging ---------------------------------------------------------------------
def _repeats(group: pd.DataFrame) -> pd.DataFrame:
    """Ranges of windows of a bucket that a smaller document has, too."""
    found = [pd.DataFrame({"doc": np.zeros(0, np.int64), "kind": np.zeros(0, np.int64),
                           "block": pd.Series([], dtype=object)})]
    for kind in (1, 2):
        for b in group.loc[group["kind"] == kind, "block"]:
            found.append(_by_document(*unpack(b), kind))
    runs = [decode_run(b) for b in group.loc[group["kind"] == 0, "block"]]
    if runs:
        lane, key, right, left, doc, place = (np.concatenate(x) for x in zip(*runs))
        words = key.view(">u8").astype(np.uint64)
        equal = words[1:] == words[:-1]
        lcp = np.append(0, np.where(equal.all(1), words.shape[1], equal.argmin(1)))
        sizes = np.array([len(r[0]) for r in runs])
        base = np.cumsum(sizes) - sizes
        begin = np.stack([b + np.searchsorted(r[0], np.arange(LANES)) for b, r in zip(base, runs)])
        end = np.stack([b + np.searchsorted(r[0], np.arange(LANES), "right")
                        for b, r in zip(base, runs)])
        lcp[begin[begin < end]] = 0
        row, shared = losertree.merge(words, np.arange(len(lane)), lcp, begin, end)
        start = np.flatnonzero(shared < ANCHOR // 8)      # groups of one anchor
        number = np.cumsum(shared < ANCHOR // 8) - 1
        low = np.minimum.reduceat(doc[row], start)
        high = np.maximum.reduceat(doc[row], start)
        open_ = np.flatnonzero((low != high)[number])
        if len(open_):
            row, number = row[open_], number[open_]
            found.append(_by_document(*_windows(
                key[row], right[row], left[row], doc[row], place[row], number), 1))
    return pd.concat(found)


def _windows(key: np.ndarray, right: np.ndarray, left: np.ndarray, doc: np.ndarray,
             place: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(doc, code) of the windows in groups that a smaller document has."""
    n = len(key)
    base = np.uint64(0x9E3779B97F4A7C15)
    ahead = np.zeros((LENGTH + 1, n), np.uint64)
    for j in range(LENGTH):
        ahead[j + 1] = (ahead[j] + key[:, j] + np.uint64(1)) * base
    behind = np.zeros((LEFT + 1, n), np.uint64)
    for j in range(int(left.max())):
        behind[j + 1] = (behind[j] + key[:, RIGHT + j] + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    least = LENGTH - right                                # smallest offset of the anchor
    count = left - least + 1
    entry = np.repeat(np.arange(n), count)
    offset = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count)
    offset = left[entry] - offset                         # windows in text order
    h = (ahead[LENGTH - offset, entry] ^ behind[offset, entry] * base
         ^ (offset.astype(np.uint64) << np.uint64(40)) + number[entry].astype(np.uint64))
    h = (h ^ h >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(29)
    order = np.argsort(h)
    first = np.append(True, h[order][1:] != h[order][:-1])
    least_doc = np.minimum.reduceat(doc[entry[order]], np.flatnonzero(first))
    gone = np.empty(len(h), bool)
    gone[order] = least_doc[np.cumsum(first) - 1] < doc[entry[order]]
    edge = np.append(True, entry[1:] != entry[:-1])
    on = np.flatnonzero(gone & (edge | ~np.append(False, gone[:-1])))
    off = np.flatnonzero(gone & np.append(edge[1:] | ~gone[1:], True))
    e = entry[on]
    return doc[e], _code(place[e], left[e] - offset[on], off - on + 1)


# -- 4: documents -------------------------------------------------------------------
def _ranges(kinds: list[int], blocks: list[bytes]) -> np.ndarray:
    """Sorted, merged (start, end) byte ranges of one id."""
    codes = np.frombuffer(b"".join(b for k, b in zip(kinds, blocks) if k == 1), np.int64)
    pairs = np.frombuffer(b"".join(b for k, b in zip(kinds, blocks) if k == 2), np.int64)
    place, skip, count = codes >> 12, codes >> 6 & 63, codes & 63
    if len(pairs) and len(codes):
        of, to = pairs[0::2], pairs[1::2]
        order = np.argsort(place, kind="stable")
        sorted_place = place[order]
        lo, hi = np.searchsorted(sorted_place, of), np.searchsorted(sorted_place, of, "right")
        n = hi - lo
        source = order[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        place = np.concatenate([place, np.repeat(to, n)])
        skip, count = (np.concatenate([x, x[source]]) for x in (skip, count))
    start = place + skip
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate((start + count - 1 + LENGTH)[order])
    new = np.append(True, start[1:] > end[:-1])[:len(start)]
    at = np.flatnonzero(new)
    return np.stack([start[at], np.append(end[at[1:] - 1], end[-1:])], 1) if len(at) else \
        np.zeros((0, 2), np.int64)


def _cut(data: bytes, shift: int, ranges: np.ndarray) -> tuple[int, int, bytes]:
    """(bytes removed, spans, bytes kept) of one text at ``shift`` of its id."""
    ranges = ranges[(ranges[:, 0] >= shift) & (ranges[:, 1] <= shift + len(data))] - shift
    kept, at = [], 0
    for i, j in ranges.tolist():
        kept.append(data[at:i])
        at = j
    kept.append(data[at:])
    return int((ranges[:, 1] - ranges[:, 0]).sum()), len(ranges), b"".join(kept)


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept) of every row; ``kept`` are the
    remaining bytes."""
    spark = docs.sparkSession
    rows = common.pick(docs, key=key, text=text)
    kind = rows.schema["key"].dataType
    rows = rows.select(F.coalesce(F.col("key").cast("long"), F.lit(_LAST)).alias("doc"),
                       F.col("key").isNull().alias("unnamed"),
                       common.text_of(F.col("text")).cast("binary").alias("data"))
    hot, entries = _hot_anchors(rows)
    buckets = max(BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions")),
                  min(BUCKETS_MOST, entries // BUCKET_ENTRIES))
    # rows of one id lie one after the other, with a byte between them
    order = Window.partitionBy("doc").orderBy(F.xxhash64("data"), "unnamed").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.withColumn("digest", F.md5("data"))
    long = rows.where(F.octet_length("data") >= LENGTH).select(
        "doc", "digest", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).alias("salt"))
    # the least id of a digest reaches its rows salt by salt: copies may be many
    salted = long.groupBy("digest", "salt").agg(F.min("doc").alias("least"), F.count("*").alias("n"))
    first = (salted.groupBy("digest").agg(F.min("least").alias("first"), F.sum("n").alias("n"))
             .where("n > 1").drop("n"))
    first = salted.select("digest", "salt").join(first, "digest")      # at most SALTS rows a digest
    copies = (long.join(first, ["digest", "salt"]).where("doc > first").groupBy("doc")
              .agg(F.collect_set("digest").alias("copied")))        # texts of one id: few
    placed = rows.withColumn("shift", F.coalesce(
        F.sum(F.octet_length("data").cast("long") + 1).over(order), F.lit(0)))
    placed = placed.join(copies.hint("merge"), "doc", "left").select(
        "doc", "unnamed", "data", "shift",
        F.coalesce(F.array_contains("copied", F.col("digest")), F.lit(False)).alias("whole"))
    live = placed.where(~F.col("whole"))
    runs = "bucket long, kind long, block binary"
    anchors = (live.select("doc", "shift", "data")
               .mapInPandas(_anchor_runs(buckets), runs)
               .groupBy("bucket").applyInPandas(_shared_anchors, "doc long, kind long, block binary")
               .groupBy("doc").agg(F.collect_list("block").alias("blocks")))
    entries = live.join(anchors.hint("merge"), "doc").select("doc", "shift", "data", "blocks")
    ranges = (entries.mapInPandas(_entry_runs(buckets, hot), runs)
              .groupBy("bucket").applyInPandas(_repeats, "doc long, kind long, block binary")
              .groupBy("doc").agg(F.collect_list("kind").alias("kinds"),
                                  F.collect_list("block").alias("blocks")))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, unnamed, data, shift, whole, kinds, blocks in zip(
                    b["doc"], b["unnamed"], b["data"], b["shift"], b["whole"], b["kinds"],
                    b["blocks"]):
                r = np.zeros((0, 2), np.int64) if blocks is None else _ranges(kinds, blocks)
                if whole:
                    r = np.array([[shift, shift + len(data)]])
                out.append((None if unnamed else str(doc), len(data), *_cut(data, shift, r)))
            yield pd.DataFrame(out, columns=["key", "n_bytes", "n_removed", "n_spans", "kept"])

    return placed.join(ranges.hint("merge"), "doc", "left").select(
        "doc", "unnamed", "data", "shift", "whole", "kinds", "blocks").mapInPandas(
        cut, "key string, n_bytes long, n_removed long, n_spans long, kept binary").withColumn(
        "key", F.col("key").cast(kind))


def digests(removed: DataFrame) -> DataFrame:
    """The query's columns: the kept bytes as SHA-256."""
    return removed.select(F.col("key").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                          F.sha2("kept", 256).alias("kept_sha256"))
