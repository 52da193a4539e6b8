"""Byte-level BPE encoding and decoding (operator 6).

A text is split by the tokenizer's pattern and each match is merged on its
own.  A segment tree over the byte positions of a match stores, in each
node, the leftmost minimum of ``rank * size + position`` over the pairs that
start in its range; the root names the next merge.  A merge joins a live
position with its live right neighbour and updates three leaves (the merged
pair, the dead neighbour, the pair of the left neighbour), each in
``log2(size)`` steps.

Short matches (most words) run in lock step: the trees of all matches of one
size class are columns of one array, and each step merges once in every
column that still has a pair.  Long matches run one at a time in lists with
the same tree, so a match of n bytes costs O(n log n) however long it is.

Defined results: null text is the empty text (no tokens, empty bytes);
repeated rows give repeated results; an empty table gives an empty table;
texts are taken whole; bytes of the decoded ids always equal the UTF-8 bytes
of the text (every single byte must have a rank, which is checked).
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstats.llm import common

NONE = np.int32(2**31 - 1)      # no pair starts here
SHORT = 64                      # matches up to this many bytes run in lock step
CACHED = 200_000                # matches kept per worker between batches (memory bound)
CHUNK_CHARS = 1_500_000         # texts are encoded in groups of about this many characters
PAIR_SLOTS = 1 << 21            # slots of the pair table, filled to about a sixth

# Letters that the standard library's expressions and \p{L} agree on; texts
# made only of these, digits, punctuation and plain white space take the
# faster engine with the same result.
_LATIN = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(rf"[\t-\r\x20-\x7e{_LATIN}]*")


def load_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a ``base64 rank`` file."""
    with open(path, "rb") as f:
        rows = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * (max(int(r) for _, r in rows) + 1)
    for token, rank in rows:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class Encoder:
    """Encodes and decodes by a list of token bytes in rank order."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens) if t}
        missing = [b for b in range(256) if bytes([b]) not in self.rank]
        if missing:
            raise ValueError(f"bytes without a rank: {missing[:5]}")
        self.byte_ids = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        self.pattern = regex.compile(pattern)
        plain = (pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s0-9{_LATIN}]")
                 .replace(r"\p{L}", f"[{_LATIN}]").replace(r"\p{N}", "[0-9]"))
        self.plain = re.compile(plain) if r"\p" not in plain else None
        self.cache: dict[str, bytes] = {}
        self.pair_rank: dict[int, int] = {}     # filled when the first long match comes
        self._pair_table()

    def _pair_table(self) -> None:
        """Open-addressing table (id, id) -> rank of the joined bytes."""
        pairs = [(self.rank[t[:i]], self.rank[t[i:]], r) for t, r in self.rank.items()
                 for i in range(1, len(t)) if t[:i] in self.rank and t[i:] in self.rank]
        p = np.array(pairs or [(0, 0, 0)], np.int64)
        if not pairs:
            p = p[:0]
        keys = p[:, 0] << 32 | p[:, 1]
        self.slot_key = np.full(PAIR_SLOTS, -1, np.int64)
        self.slot_rank = np.full(PAIR_SLOTS, NONE, np.int32)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.slot_key[at[left]] < 0
            self.slot_key[at[left[free]]] = keys[left[free]]
            placed = self.slot_key[at[left]] == keys[left]
            self.slot_rank[at[left[placed]]] = p[left[placed], 2]
            left = left[~placed]
            at[left] = (at[left] + 1) % PAIR_SLOTS

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - PAIR_SLOTS.bit_length() + 1)).astype(np.int64)

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of neighbouring ids, NONE where they do not merge."""
        keys = a.astype(np.int64) << 32 | b
        at = self._slot(keys)
        out, found = self.slot_rank[at], self.slot_key[at]
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        out[(found != keys)] = NONE
        while len(open_):
            at[open_] = (at[open_] + 1) % PAIR_SLOTS
            found = self.slot_key[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.slot_rank[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    # -- merging ------------------------------------------------------------
    def _merge_long(self, piece: bytes) -> list[int]:
        """One match of any length: a segment tree in a list."""
        n = len(piece)
        size = 1 << (n - 1).bit_length()
        tok = [int(x) for x in self.byte_ids[np.frombuffer(piece, np.uint8)]]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        if not self.pair_rank:
            held = self.slot_key >= 0
            self.pair_rank = dict(zip(self.slot_key[held].tolist(), self.slot_rank[held].tolist()))
        rank, none = self.pair_rank.get, 1 << 62
        tree = [none] * (2 * size)
        for i in range(n - 1):
            r = rank(tok[i] << 32 | tok[i + 1])
            if r is not None:
                tree[size + i] = r * size + i
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i: int, value: int) -> None:
            node = size + i
            tree[node] = value
            while node > 1:
                node >>= 1
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low

        while tree[1] < none:
            merged, i = divmod(tree[1], size)
            dead = nxt[i]
            tok[i], nxt[i] = merged, nxt[dead]
            tok[dead] = -1
            if nxt[i] < n:
                prv[nxt[i]] = i
                r = rank(merged << 32 | tok[nxt[i]])
            else:
                r = None
            put(dead, none)
            put(i, none if r is None else r * size + i)
            if prv[i] >= 0:
                r = rank(tok[prv[i]] << 32 | merged)
                put(prv[i], none if r is None else r * size + prv[i])
        return [t for t in tok if t >= 0]

    def _merge_short(self, pieces: list[bytes], size: int) -> list[bytes]:
        """All matches of one size class in lock step, one tree per column."""
        n = len(pieces)
        length = np.fromiter(map(len, pieces), np.int64, n)
        raw = np.frombuffer(b"".join(p.ljust(size + 1, b"\0") for p in pieces), np.uint8)
        tok = np.ascontiguousarray(self.byte_ids[raw.reshape(n, size + 1)].T)
        live = np.arange(size + 1)[:, None] < length
        nxt = np.repeat(np.arange(1, size + 2, dtype=np.int64)[:, None], n, 1)
        prv = np.repeat(np.arange(-1, size, dtype=np.int64)[:, None], n, 1)
        tree = np.full((2 * size, n), NONE, np.int32)
        for i in range(size - 1):
            has = np.flatnonzero(live[i + 1])
            r = self.ranks_of(tok[i, has], tok[i + 1, has])
            tree[size + i, has] = np.where(r == NONE, NONE, r * np.int32(size) + np.int32(i))
        for node in range(size - 1, 0, -1):
            np.minimum(tree[2 * node], tree[2 * node + 1], out=tree[node])

        def put(i: np.ndarray, lane: np.ndarray, value: np.ndarray) -> None:
            node = i + size
            tree[node, lane] = value
            for _ in range(size.bit_length() - 1):
                node >>= 1
                tree[node, lane] = np.minimum(tree[2 * node, lane], tree[2 * node + 1, lane])

        def pair(a: np.ndarray, b: np.ndarray, lane: np.ndarray) -> np.ndarray:
            r = self.ranks_of(tok[a, lane], tok[b, lane])
            return np.where(r == NONE, NONE, r * np.int32(size) + a.astype(np.int32))

        lane = np.flatnonzero(tree[1] != NONE)
        while len(lane):
            root = tree[1, lane]
            i = (root % size).astype(np.int64)
            dead = nxt[i, lane]
            after = nxt[dead, lane]
            tok[i, lane] = root // size
            live[dead, lane] = False
            nxt[i, lane] = after
            put(dead, lane, np.full(len(lane), NONE, np.int32))
            inside = after < length[lane]
            value = np.full(len(lane), NONE, np.int32)
            prv[after[inside], lane[inside]] = i[inside]
            value[inside] = pair(i[inside], after[inside], lane[inside])
            put(i, lane, value)
            left = prv[i, lane]
            has = left >= 0
            put(left[has], lane[has], pair(left[has], i[has], lane[has]))
            lane = lane[tree[1, lane] != NONE]
        ids = tok.T[live.T].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(0)) * 4
        return [ids[a:b] for a, b in itertools.pairwise([0, *ends.tolist()])]

    def _learn(self, pieces: set[str]) -> None:
        """Encode matches that the cache does not hold."""
        by_size: dict[int, list[str]] = {}
        for p in pieces:
            b = p.encode()
            whole = self.rank.get(b)
            if whole is not None:
                self.cache[p] = whole.to_bytes(4, "little")
            elif len(b) > SHORT:
                self.cache[p] = np.array(self._merge_long(b), "<u4").tobytes()
            else:
                by_size.setdefault(1 << max(1, (len(b) - 1).bit_length()), []).append(p)
        for size, group in by_size.items():
            for k in range(0, len(group), 50_000):
                part = group[k:k + 50_000]
                self.cache.update(zip(part, self._merge_short([p.encode() for p in part], size)))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        found = [(self.plain if self.plain and _PLAIN.fullmatch(t) else self.pattern).findall(t)
                 for t in texts]
        if len(self.cache) > CACHED:
            self.cache.clear()
        self._learn(set(itertools.chain.from_iterable(found)) - self.cache.keys())
        ids = self.cache.__getitem__
        return [b"".join(map(ids, pieces)) for pieces in found]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_ENCODERS: dict[str, Encoder] = {}


def encoder(tokens: list[bytes], pattern: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = hashlib.sha256(b"\0".join(tokens) + pattern.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokens, pattern)
    return _ENCODERS[key]


def chunks(texts: list[str], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``most`` characters together."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode(df: DataFrame, tokens: list[bytes], pattern: str, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """(key, ids, decoded): ids as little-endian 32-bit binary and the bytes
    decoded from them, one row per input row.  No shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(tokens)   # the vocabulary: fixed size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(shared.value, pattern)
        for b in batches:
            texts = b["text"].tolist()
            for lo, hi in chunks(texts):
                ids = enc.encode_batch(texts[lo:hi])
                yield pd.DataFrame({"key": b["key"].iloc[lo:hi], "ids": ids,
                                    "decoded": [enc.decode(x) for x in ids]})
        enc.cache.clear()        # the worker process goes on to other stages

    rows = common.pick(df, key=key, text=text).withColumn("text", common.text_of(F.col("text")))
    return common.through_python(rows, run, "ids binary, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """Token count and SHA-256 of the ids and of the decoded bytes."""
    return encoded.select(
        F.col("key").alias("doc_id"),
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
