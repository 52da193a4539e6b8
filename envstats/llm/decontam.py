"""Benchmark decontamination (operator 4): template canonicalisation.

Texts become templates: white-space tokens lose their outer punctuation and
case, and numbers, units after a number, quantities ("5km") and names
(capitalised words inside a sentence; neighbouring ones are one name) become
typed placeholders whose values are the window's slots.  Windows of
``WINDOW`` template tokens of the documents are hash-joined with those of the
benchmark.  Matches of one (document, item) pair with one offset form an
alignment.  Each value of the item should always meet the same value in the
document, so a question with other numbers or names is found, and texts that
merely share a template are not: the value that meets it most often counts,
and a window with another one is left out, unless all its values are the
item's own.  A document contains an item when the windows left cover at least
``COVERAGE`` of the item's.  A name at the end of an item may run on into the
document, so its value is not compared.

An item shorter than ``WINDOW`` is one window of its own length.  Templates of
fewer than ``MIN_TOKENS`` tokens, and windows with fewer literal tokens than
placeholders, cannot identify a passage with other values.  So every item has
windows of a second kind, too: the same number of plain units, i.e. tokens
without outer punctuation and case, none masked and no names put together; a
token in a script without spaces, or longer than ``LONG`` characters, counts
as one unit per letter or digit.  These are joined exactly, however short the
item, and the kind that covers more of the item counts.  Only an item without
any letter or digit matches nothing.

The documents' windows are computed in their scan.  While the benchmark's
window hashes fit the checked broadcast budget, windows without a partner
are left out there; beyond it all windows go to the join.  The rows are the
same either way, and no step gathers the windows of an item or hash.

Defined results: null text is the empty text and matches nothing; rows with
equal id and different texts are judged apart, equal rows together; an empty
table on either side gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstats.llm import common
from envstats.operators.joins import fits_broadcast, sized_broadcast

WINDOW = 8          # template tokens of a window
MIN_TOKENS = 5      # template windows from this length on (plain ones from 1 on)
LONG = 40           # characters of a token above which it is read by character
COVERAGE = 0.5      # share of an item's windows that marks a document
CACHED = 400_000    # tokens kept per worker (memory bound)
CHUNK_CHARS = 1_500_000

# Units that follow a number, and number words.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t ton tons lb lbs "
    "oz pound pounds ml cl l liter liters litre litres gal gallon gallons s sec secs second seconds "
    "min mins minute minutes h hr hrs hour hours day days week weeks month months year years hz khz "
    "mhz ghz w kw mw kwh v kv a ma ohm n j kj cal kcal pa kpa bar k c f °c °f % percent usd eur gbp "
    "dollar dollars cent cents euro euros kb mb gb tb bit bits byte bytes mph kph meter meters metre "
    "metres gram grams kilogram kilograms kilometer kilometers kilometre kilometres degree degrees"
    .split())
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million billion".split())

_CORE = re.compile(r"[^\W_](?:.*[^\W_%])?%?", re.S)
_NUMBER = re.compile(r"[0-9][0-9.,:/-]*(?:st|nd|rd|th|%)?")
_QUANTITY = re.compile(r"[0-9][0-9.,]*([^\W\d_]{1,4})")
_UNSPACED = re.compile(   # scripts written without spaces: Thai to Khmer, kana, Han
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\U00020000-\U0003ffff]")
_EMPTY, _NUM, _UNIT, _CAP, _END, _QTY, _SPLIT = (1 << i for i in range(7))
_PLACEHOLDER = {kind: np.uint64(zlib.crc32(name) * 0x9E3779B1 + 1)
                for kind, name in ((_NUM, b"<number>"), (_UNIT, b"<unit>"), (_QTY, b"<quantity>"),
                                   (_CAP, b"<name>"))}
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LISTED = UNITS | NUMBER_WORDS


def _analyse(token: str) -> tuple[int, int]:
    """Hash of the bare token and its flags."""
    value, flags = _plain(token)
    if len(token) > LONG or not token.isascii() and _UNSPACED.search(token):
        flags |= _SPLIT if any(map(str.isalnum, token)) else 0
    return value, flags


def _plain(token: str) -> tuple[int, int]:
    core = token.rstrip(".,;:!?")
    if core.isalpha() and (low := core.lower()) not in _LISTED:       # most tokens
        flags = _END if token[-1] in ".!?:" else 0
        if core[0].isupper() and (len(core) == 1 or not core.isupper()):
            flags |= _CAP
        return _hash(low.encode()), flags
    m = _CORE.search(token)
    end = _END if token.rstrip("\"')]}”’»")[-1:] in (".", "!", "?", ":") else 0
    if m is None:
        return 0, _EMPTY | end
    core = m.group()
    low = core.lower()
    flags = end
    if _NUMBER.fullmatch(low) or low in NUMBER_WORDS:
        flags |= _NUM
    elif (q := _QUANTITY.fullmatch(low)) and q.group(1) in UNITS:
        flags |= _QTY
    elif low in UNITS:
        flags |= _UNIT
    if core[0].isupper() and (len(core) == 1 or not core.isupper()) and not flags & (_NUM | _QTY):
        flags |= _CAP
    return _hash(low.encode()), flags


def _units(token: str) -> np.ndarray:
    """Hashes of the letters and digits of a token that is read by character."""
    return np.array([_hash(c.lower().encode()) for c in token if c.isalnum()], np.uint64)


def _rolling(v: np.ndarray, w: int) -> np.ndarray:
    """Polynomial hash of each ``w`` neighbours, by doubling."""
    h, have = v, 1
    for bit in bin(w)[3:]:
        h = h[:len(h) - have] * np.uint64(pow(int(_BASE), have, 2**64)) + h[have:]
        have *= 2
        if bit == "1":
            h = h[:len(h) - 1] * _BASE + v[have:]
            have += 1
    return h


def _hash(b: bytes) -> int:
    return (zlib.crc32(b) << 31 ^ zlib.adler32(b) * 2654435761 ^ len(b)) & (2**63 - 1) | 1


class Templates:
    """Windows of templates and of plain units, by length; each distinct token
    is analysed once per worker."""

    def __init__(self, lengths: tuple[int, ...], plain: tuple[int, ...]):
        self.lengths, self.plain = lengths, plain
        self.number: dict[str, int] = {}
        self.split: dict[int, np.ndarray] = {}          # units of tokens read by character
        self.hash, self.flags = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.uint8)

    def _learn(self, tokens: set[str]) -> None:
        fresh = [t for t in tokens if t not in self.number]
        at = len(self.number)
        while at + len(fresh) > len(self.hash):
            self.hash = np.concatenate([self.hash, np.zeros_like(self.hash)])
            self.flags = np.concatenate([self.flags, np.zeros_like(self.flags)])
        if fresh:
            found = list(map(_analyse, fresh))
            self.hash[at:at + len(fresh)], self.flags[at:at + len(fresh)] = zip(*found)
            self.number.update(zip(fresh, range(at, at + len(fresh))))
            self.split.update((at + i, _units(t)) for i, (t, f) in
                              enumerate(zip(fresh, found)) if f[1] & _SPLIT)

    def read(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """(text number, flags, value, token number) of all tokens."""
        words = [t.split() for t in texts]
        if len(self.number) > CACHED:
            self.number.clear()
            self.split.clear()
        self._learn(set(chain.from_iterable(words)))
        n = np.fromiter(map(len, words), np.int64, len(words))
        idx = np.fromiter(map(self.number.__getitem__, chain.from_iterable(words)), np.int64,
                          int(n.sum()))
        doc, flags = np.repeat(np.arange(len(words)), n), self.flags[idx]
        real = flags & _EMPTY == 0
        idx = idx[real]
        return doc[real], flags[real], self.hash[idx], idx

    def units(self, doc: np.ndarray, flags: np.ndarray, value: np.ndarray,
              idx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text number, plain unit) of tokens as read."""
        split = np.flatnonzero(flags & _SPLIT)
        if not len(split):
            return doc, value
        n = np.ones(len(doc), np.int64)
        n[split] = [len(self.split[i]) for i in idx[split].tolist()]
        start, unit = np.cumsum(n) - n, np.repeat(value, n)
        for k in split.tolist():
            unit[start[k]:start[k] + n[k]] = self.split[int(idx[k])]
        return np.repeat(doc, n), unit

    def tokens(self, doc: np.ndarray, flags: np.ndarray, value: np.ndarray,
               idx: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, template token, slot value or 0) of tokens as read."""
        if not len(doc):
            return doc, value, value
        follows = np.append(False, doc[1:] == doc[:-1])
        before = np.append(np.uint8(0), flags[:-1])
        name = (flags & _CAP > 0) & follows & (before & _END == 0)
        unit = (flags & _UNIT > 0) & follows & (before & _NUM > 0) & ~name
        number, quantity = flags & _NUM > 0, (flags & _QTY > 0) & ~name
        token = value.copy()
        for kind, mask in ((_NUM, number), (_QTY, quantity), (_UNIT, unit), (_CAP, name)):
            token[mask] = _PLACEHOLDER[kind]
        slot = np.where(number | quantity | unit | name, value, np.uint64(0))
        first = np.flatnonzero(~(name & np.append(False, name[:-1]) & follows))
        return doc[first], token[first], np.add.reduceat(slot, first)

    def open_ended(self, texts: list[str]) -> np.ndarray:
        """Whether each text ends with a name that no mark closes."""
        doc, flags, _, _ = self.read(texts)
        out = np.zeros(len(texts), bool)
        final = np.flatnonzero(np.append(doc[1:] != doc[:-1], True)[:len(doc)])
        out[doc[final]] = flags[final] & (_CAP | _END) == _CAP
        return out

    def windows(self, texts: list[str]) -> Iterator[tuple]:
        """For each kind and length: (plain, length, text number, position, hash,
        slots, number of tokens or units of each text)."""
        seen = self.read(texts)
        if self.lengths:
            doc, token, slot = self.tokens(*seen)
            literal = np.concatenate([[0], np.cumsum(slot == 0)])
            yield from self._kind(False, self.lengths, len(texts), doc, token, slot, literal)
        if self.plain:
            doc, unit = self.units(*seen)
            yield from self._kind(True, self.plain, len(texts), doc, unit, None, None)

    @staticmethod
    def _kind(plain: bool, lengths: tuple[int, ...], texts: int, doc: np.ndarray,
              token: np.ndarray, slot: np.ndarray | None, literal: np.ndarray | None
              ) -> Iterator[tuple]:
        start = np.searchsorted(doc, np.arange(texts + 1))
        size = np.diff(start)
        for w in lengths:
            n = len(doc) - w + 1
            if n <= 0:
                continue
            h = _rolling(token, w) + np.uint64((w + 64 * plain) * int(_BASE) % 2**64)
            h ^= h >> np.uint64(31)
            ok = doc[:n] == doc[w - 1:]
            if not plain:
                ok &= 2 * (literal[w:] - literal[:-w]) >= w
            at = np.flatnonzero(ok)

            def slots(pick: np.ndarray, at=at, w=w) -> np.ndarray:
                if plain:
                    return np.zeros((len(pick), 0), np.int64)
                return slot[at[pick][:, None] + np.arange(w)].astype(np.int64)

            yield plain, w, doc[at], at - start[doc[at]], h[at].astype(np.int64), slots, size


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= CHUNK_CHARS:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def item_windows(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(plain, hash, item, at, slots, windows): every window of every item, and
    how many distinct positions its item has in windows of that kind."""
    rows = common.pick(benchmark, key=key, text=text).select(
        "key", common.text_of(F.col("text")).alias("text")).distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            of = Templates(tuple(range(MIN_TOKENS, WINDOW + 1)), tuple(range(1, WINDOW + 1)))
            texts = b["text"].tolist()
            open_ = of.open_ended(texts)
            for plain, w, owner, at, h, slots, size in of.windows(texts):
                pick = np.flatnonzero((size[owner] == w) | ((w == WINDOW) & (size[owner] > w)))
                if not len(pick):
                    continue
                held = slots(pick)
                if not plain:                 # a name that ends the item may run on in a document
                    last = at[pick] + w == size[owner[pick]]
                    held[last & open_[owner[pick]], -1] = 0
                yield pd.DataFrame({"key": b["key"].to_numpy()[owner[pick]], "plain": plain,
                                    "length": w, "hash": h[pick], "at": at[pick],
                                    "slots": list(held),
                                    "windows": np.bincount(owner[pick], minlength=len(texts))
                                    [owner[pick]]})

    return common.through_python(rows, run, "plain boolean, length int, hash long, at long, "
                                            "slots array<long>, windows long")


def document_windows(docs: DataFrame, lengths: tuple[int, ...], plain: tuple[int, ...],
                     only: np.ndarray | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sig, hash, at, slots) of the documents' windows; with ``only`` (a
    sorted array of hashes), of those alone."""
    rows = common.pick(docs, key=key, text=text).withColumn("text", common.text_of(F.col("text")))
    rows = rows.withColumn("sig", F.xxhash64("text"))
    wanted = None if only is None else docs.sparkSession.sparkContext.broadcast(only)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Templates(lengths, plain)
        low = np.int64((1 << 20) - 1)                 # a first look at the low bits
        likely = np.zeros(1 << 20, bool)
        if wanted is not None:
            likely[wanted.value & low] = True
        for b in batches:
            texts, keys, sigs = b["text"].tolist(), b["key"].to_numpy(), b["sig"].to_numpy()
            for lo, hi in _chunks(texts):
                for _, _, doc, at, h, slots, _ in of.windows(texts[lo:hi]):
                    pick = np.arange(len(h))
                    if wanted is not None:
                        pick = np.flatnonzero(likely[h & low])
                        place = np.searchsorted(wanted.value, h[pick])
                        pick = pick[wanted.value[np.minimum(place, len(wanted.value) - 1)] == h[pick]]
                    for k in range(0, len(pick), 20_000):
                        p = pick[k:k + 20_000]
                        yield pd.DataFrame({"key": keys[lo:hi][doc[p]], "sig": sigs[lo:hi][doc[p]],
                                            "hash": h[p], "at": at[p], "slots": list(slots(p))})

    return common.through_python(rows, run, "sig long, hash long, at long, slots array<long>")


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
         item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, sig, item, n_windows, n_matched, coverage, reparameterised): one row
    per document text and item that it contains."""
    items = common.written(item_windows(benchmark, item, item_text), "item-windows")
    used = sorted((r["length"], r["plain"])
                  for r in items.select("length", "plain").distinct().collect())
    lengths, plain = (tuple(w for w, p in used if p == k) for k in (False, True))
    hashes = items.select("hash").distinct()
    only = None
    if fits_broadcast(hashes):
        only = np.sort(np.array([r["hash"] for r in hashes.collect()], np.int64))
    found = document_windows(docs, lengths, plain, only, key, text)
    side = items.select("hash", F.col("key").alias("item"), F.col("at").alias("item_at"),
                        F.col("slots").alias("item_slots"), "plain", "windows")
    met = found.join(sized_broadcast(side), "hash")
    values = F.filter(F.arrays_zip("item_slots", "slots"), lambda s: s["item_slots"] != 0)
    aligned = (met.withColumn("values", values)
               .groupBy("key", "sig", "item", "plain", "windows",
                        (F.col("at") - F.col("item_at")).alias("by"))
               .agg(F.collect_set(F.struct("item_at", "values")).alias("held"))
               .withColumn("values", F.flatten("held.values")))
    pairs, own = F.array_distinct("values"), F.array_distinct("values.item_slots")
    most = F.transform(own, lambda v: F.array_max(F.transform(     # per value: what meets it most
        F.array_distinct(F.filter("values", lambda s: s["item_slots"] == v)),
        lambda p: F.struct(F.size(F.filter("values", lambda s: s == p)).alias("times"),
                           p.alias("pair"))))["pair"])
    agree = F.filter("held", lambda w: F.forall(
        w["values"], lambda s: F.array_contains(F.col("most"), s))
        | F.forall(w["values"], lambda s: s["item_slots"] == s["slots"]))
    aligned = (aligned.withColumn("most", F.when(F.size(pairs) > F.size(own), most))
               .withColumn("held", F.when(F.col("most").isNull(), F.col("held")).otherwise(agree)))
    changed = F.exists(F.flatten("held.values"), lambda s: s["item_slots"] != s["slots"])
    pair = ["key", "sig", "item", "plain", "windows"]     # a repetitive text has many alignments
    placed = (aligned.select(*pair, changed.alias("changed"), F.explode("held.item_at").alias("place"))
              .groupBy(*pair, "place").agg(F.max("changed").alias("changed")))
    covered = (placed.groupBy(*pair)
               .agg(F.count("*").alias("n_matched"), F.max("changed").alias("reparameterised"))
               .withColumn("coverage", F.col("n_matched") / F.col("windows"))
               .where(F.col("coverage") >= COVERAGE))
    best = F.max(F.struct("coverage", "plain", F.col("windows").alias("n_windows"), "n_matched",
                          "reparameterised"))
    return (covered.groupBy("key", "sig", "item").agg(best.alias("best"))
            .select("key", "sig", "item", "best.n_windows", "best.n_matched", "best.coverage",
                    "best.reparameterised"))


def matches(found: DataFrame) -> DataFrame:
    """The query's rows: one per document id and item."""
    return found.groupBy(F.col("key").alias("doc_id"), F.col("item").alias("item_id")).agg(
        F.max("n_windows").alias("n_windows"), F.max("n_matched").alias("n_matched"),
        F.max("coverage").alias("coverage"), F.max("reparameterised").alias("reparameterised"))


def remove(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text contains a benchmark item."""
    bad = sized_broadcast(common.written(
        find(docs, benchmark, key, text).select("key", "sig").distinct(), "contaminated"))
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    k, t = (F.col(f"_c{common.position(docs, c)}") for c in (key, text))
    return plain.join(bad, k.eqNullSafe(F.col("key"))
                      & (F.xxhash64(common.text_of(t)) == F.col("sig")),
                      "left_anti").toDF(*docs.columns)
