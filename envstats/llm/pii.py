"""Personal data (operator 1): candidate spans, boosted trees, calibrated thresholds.

High-recall generators propose overlapping spans of four kinds.  A span that
meets the strict rule of its kind (``base_spans``) is always kept.  Every
other proposal is scored by boosted trees over format features (lengths,
groups, separators, checksum, octets) and context features (neighbouring
characters, nearby cue words), and kept when its calibrated probability
reaches ``MIN_PROBABILITY``; of overlapping kept proposals the likeliest
stays, and none overlaps a strict span.

The trees learn what a reformatted span looks like.  Every strict span of the
table is a positive, and so are copies of it in its own place and in other
forms (obfuscated, other separators, without the plus), with or without a cue
word; forms that only a cue makes a phone number have one.  Negatives are the
table's own number runs without a cue that meet no strict rule, and runs built
from the spans: plain and grouped numbers, dates, orders, sentences with "(at)",
addresses without a domain.  All these rows count: those of one half (by a hash of span and
surroundings) fit the trees, those of the other calibrate them per kind.  Rows
of equal features are one row with a count; boosting and calibration are Spark
jobs over all of them (``boost``).  A kind whose held-out rows show fewer than ``MIN_SUPPORT`` positives at a probability of
``MIN_PROBABILITY`` adds nothing.

All scans are linear in the text: no expression can be retried over a long
run of letters or digits.

Defined results: null or empty text has no spans; repeated rows give
repeated results; an empty table gives an empty table (and no model); texts
are taken whole; offsets are code points, the end exclusive.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstats.llm import boost, common

# Span kinds in their order, and the strict patterns.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A digit run is taken whole (possessive) and entered at its start only: the
# same leftmost matches as without, found in one pass.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Generators beyond the strict rules.
_WORDY_AT = re.compile(r"([\w.%+-]{1,64})\s?[(\[]\s?(?:at|AT)\s?[)\]]\s?([\w-]{1,63}(?:\s?[.(\[]\s?"
                       r"(?:dot\s?[)\]]\s?)?[\w-]{2,63}){1,4})")
_AT_LEFT = re.compile(r"[^\s@<>()\[\]{},;:|\"']{1,64}$")
_AT_RIGHT = re.compile(r"[^\s@<>()\[\]{},;:|\"']{1,255}")
_DEFANGED = re.compile(r"(?<![0-9.\])])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}+){3}(?![0-9]|\.[0-9]|\[\.)")
_RUN = re.compile(r"(?<![0-9])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+")
_CUES = tuple(re.compile(p) for p in (
    r"(?i)mail|contact|write", r"(?i)\bip\b|host|server|addr", r"(?i)card|visa|master|amex|pay",
    r"(?i)tel|phone|call|fax|mobile|cell", r"(?i)order|invoice|serial|\bno\b|\bid\b|isbn|version|#",
    r"[$€£%]"))
NEEDS = r"[0-9@]|[(\[]\s?(at|AT)\s?[)\]]"   # a text without any of these has no proposal

MIN_PROBABILITY = 0.97   # calibrated probability from which a proposal is kept
MIN_SUPPORT = 30         # held-out positives from there on, of one kind
TREES, DEPTH = 60, 4
_CUE_WORDS = ("mail", "ip", "card", "tel")       # written before copies


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Strict spans (start, kind number, end), leftmost and not overlapping
    within a kind, in order of start and kind."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
               for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 2 * 19:
            d = _digits(m.group())
            if 12 <= len(d) <= 19 and _luhn(d):
                out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def proposals(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """High-recall spans (start, kind number, end), the strict ones included."""
    found = set(base)
    at = text.find("@")
    while at >= 0:
        left, right = _AT_LEFT.search(text, max(0, at - 64), at), _AT_RIGHT.match(text, at + 1)
        if left and right:
            found.add((left.start(), 0, right.end()))
        at = text.find("@", at + 1)
    if "(" in text or "[" in text:
        found.update((m.start(), 0, m.end()) for m in _WORDY_AT.finditer(text))
    for m in _DEFANGED.finditer(text):
        if max(map(int, re.findall("[0-9]+", m.group()))) <= 255:
            found.add((m.start(), 1, m.end()))
    for m in _RUN.finditer(text):
        n = len(_digits(m.group())) if m.end() - m.start() <= 80 else 0
        if 12 <= n <= 19 and _luhn(_digits(m.group())):
            found.add((m.start(), 2, m.end()))
        if 7 <= n <= 15:
            plus = m.start() > 0 and text[m.start() - 1] == "+"
            found.add((m.start() - plus, 3, m.end()))
    return sorted(found)


_SPOKEN_AT = re.compile(r"\s?[(\[]\s?at\s?[)\]]\s?|@", re.I)
_LABELS = re.compile(r"\s?[(\[]\s?dot\s?[)\]]\s?|\.", re.I)


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    """Format and context of one proposal; nothing that only the strict rule asks for."""
    start, kind, end = span
    s = text[start:end]
    digits = "" if kind == 0 else _digits(s)        # a mailbox may have digits or none
    groups = [len(g) for g in re.findall(r"[0-9]+", s[:300])] if digits else []
    labels = _LABELS.split(_SPOKEN_AT.split(s, maxsplit=1)[-1]) if kind == 0 else []
    before, after = text[max(0, start - 24):start], text[end:end + 12]
    prev, nxt = before[-1:], after[:1]
    first, last = (groups[0], groups[-1]) if groups else (0, 0)
    year = bool(re.match(r"(19|20)[0-9]{2}(?![0-9])", s)) or bool(re.search(r"[ .-](19|20)[0-9]{2}$", s))
    return [
        *(float(kind == k) for k in range(4)), float(len(digits)), float(len(groups)),
        float(max(groups, default=0)), float(min(groups, default=0)), float(first), float(last),
        float(len(set(groups))), float(s.count(" ")), float(s.count("-")), float(s.count(".")),
        float(s.count("(") + s.count(")")), float(s.count("[") + s.count("]")), float(year),
        float(digits[:1] == "0"), float(bool(re.search(r"[.]\s+\w", s))), float(s.isascii()),
        float(len(labels)), float(bool(labels) and labels[-1].isalpha() and labels[-1].islower()),
        float(len(labels[-1]) if labels else 0), float(prev.isalnum()), float(nxt.isalnum()), float(nxt in ":/%" and nxt != ""),
        float(prev in "=:\"'#" and prev != ""), *(float(bool(c.search(before))) for c in _CUES),
    ]


def reformatted(text: str, span: tuple[int, int, int]) -> list[tuple[str, tuple, float]]:
    """Training copies (text, span, label) of a strict span: its surroundings with
    the span in another form (1), or with a run built from it that is none (0).
    A hash of span and surroundings picks the forms."""
    start, kind, end = span
    s, before, after = text[start:end], text[max(0, start - 24):start], text[end:end + 12]
    pick = zlib.crc32((before + s).encode("utf-8", "surrogatepass"))
    cue = f"{_CUE_WORDS[kind]} "
    d = _digits(s)
    some = (d * 12)[:12] or "271828182845"

    def one(forms: list[str], salt: int) -> str:
        return forms[(pick >> salt) % len(forms)]

    bare = " ".join(w for w in before.split(" ")[:-1] if not any(c.search(w) for c in _CUES)) + " "
    yes: list[tuple[str, str]] = []          # (before, form)
    no: list[tuple[str, int]] = []           # (form, kind), never behind a cue
    if kind == 0 and "@" in s:
        local, _, domain = s.rpartition("@")
        dots = one(["{}", " {} ", "({})", " ({}) "], 0)
        at = one([" (at) ", "(at)", " [at] ", "[at]"], 2)
        dot = one([".", " (dot) ", "(dot)", " [dot] "], 4) if "(" in dots or pick & 1 else "."
        whole, brief = (local + at + dot.join(labels) for labels in (domain.split("."), domain.split(".")[-2:]))
        yes = [(before, whole), (cue, whole), (bare, whole), (cue, brief), (bare, brief)]
        no = [(one(["meet (at) noon. Then", "look (at) this. It", "sold (at) cost. We", "ten (at) home. All"], 6), 0),
              *((f"{local}@{label}", 0) for label in (domain.partition(".")[0], domain.rpartition(".")[2]))]
    elif kind == 1:
        yes = [(before, s.replace(".", "[.]")), (cue, s.replace(".", one(["(.)", "[.]"], 0)))]
    elif kind == 2:
        four = [d[i:i + 4] for i in range(0, len(d), 4)]
        form = one([".", "  ", "--", ". ", "."], 0).join(four)
        yes = [(before, form), (cue, form), (bare, form)]
        no = [(".".join([d[:2], d[2:3], d[3:9], d[9:]]), 2), (". ".join([d[:1], d[1:]]), 2)]
    elif kind == 3 and len(d) >= 9:
        a, b, c = d[-10:-7] or "201", d[-7:-4], d[-4:]
        sure = one([f"({a}) {b}-{c}", f"({a}){b}-{c}", f"{a}-{b}-{c}", f"({a}) {b} {c}", f"({a}) {b}.{c}"], 0)
        loose = one([f"0{a} {b}{c}", f"0{a[:2]} {a[2]}{b} {c}", f"{a} {b} {c}", f"{a}.{b}.{c}", f"{a}{b}{c}",
                     f"0{a}-{b}{c}", f"0{a[:2]} {b}{c[:1]} {c}", f"{b} {c}"], 3)
        yes = [(before, sure), (bare, sure), (cue, loose), (before + one(["phone ", "call ", "fax ", "mobile: ", "Tel. "], 6), loose)]
    if d:
        no += [(one([some[:8], some[:10], some[:12], f"{some[0]} {some[1:4]} {some[4:7]} {some[7:10]}",
                     f"{some[:4]} {some[4:8]}", f"{some[:6]}-{some[6:9]}", f"{some[0]}.{some[1:4]}.{some[4:7]}.{some[7:10]}"], 9), 3),
               (one([f"20{some[:2]}-0{1 + pick % 9}-1{some[2]} 1{some[3]}", f"1{pick % 9}.0{1 + pick % 9}.20{some[:2]}",
                     f"19{some[:2]} - 20{some[2:4]}", f"20{some[:2]}.0{1 + pick % 9}.2{pick % 9}"], 12), 3)]
    out = [(b + f + after, kind, 1.0, len(b), len(b) + len(f)) for b, f in yes]
    out += [(b + f + after, k, 0.0, len(b), len(b) + len(f))
            for f, k in no for b in (bare, one([f"{bare}order ", f"{bare}No ", f"{bare}version ", f"{bare}$"], 15))]
    return [(t, (lo, k, hi), y) for t, k, y, lo, hi in out if (lo, k, hi) in proposals(t, [])]


@dataclass
class Model:
    """Boosted trees and, per kind, the raw score from which a span is kept."""

    trees: boost.Boosted
    cut: list[float]

    def keep(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Proposals to add to the strict spans."""
        strict = set(base)
        rest = [p for p in proposals(text, base)
                if p not in strict and self.cut[p[1]] < np.inf]
        likely = []
        for k in range(0, len(rest), 5000):
            part = rest[k:k + 5000]
            score = self.trees.score(np.array([features(text, p) for p in part]))
            likely += [(-s, p) for s, p in zip(score.tolist(), part) if s >= self.cut[p[1]]]
        if not likely:
            return []
        taken = bytearray(len(text))
        for start, _, end in base:
            taken[start:end] = b"\1" * (end - start)
        out = []
        for _, p in sorted(likely):
            if taken.find(1, p[0], p[2]) < 0:
                taken[p[0]:p[2]] = b"\1" * (p[2] - p[0])
                out.append(p)
        return out


def _needed(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text): only texts that can hold a proposal travel to Python."""
    rows = common.pick(df, key=key, text=text)
    return rows.withColumn("text", F.when(F.col("text").rlike(NEEDS), F.col("text")))


def fit(df: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Learn from all proposals of all rows; only histograms and the steps of the
    calibration reach the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t in b["text"]:
                base = base_spans(t)
                strict = set(base)
                marked = bytearray(len(t))
                for lo, _, hi in base:
                    marked[lo:hi] = b"\1" * (hi - lo)
                for p in proposals(t, base):
                    near = t[max(0, p[0] - 24):p[2] + 12]
                    if p in strict:
                        rows.append((near, p[1], 1, features(t, p)))
                        rows += [(u, q[1], int(y), features(u, q)) for u, q, y in reformatted(t, p)]
                    elif p[1] >= 2 and marked.find(1, p[0], p[2]) < 0 and not _CUES[p[1]].search(near[:24]):
                        rows.append((near, p[1], 0, features(t, p)))
            if rows:
                near, kind, y, x = zip(*rows)
                yield pd.DataFrame({"near": near, "kind": kind, "y": y,
                                    "x": [v.tobytes() for v in np.array(x, "<f8")]})

    found = (_needed(df, key, text).where(F.col("text").isNotNull())
             .mapInPandas(run, "near string, kind int, y int, x binary"))
    held = common.written(
        found.groupBy("kind", F.pmod(F.xxhash64("near", "kind"), F.lit(2)).alias("half"), "x")
        .agg(F.count("*").alias("n"), F.sum("y").alias("pos")), "proposals")
    trees = boost.fit_rows(held.where("half = 0"), TREES, DEPTH)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b[["kind", "n", "pos"]].assign(score=trees.score(boost.matrix(b["x"])))

    steps = boost.isotonic_rows(held.where("half = 1").mapInPandas(
        scored, "kind int, n long, pos long, score double"))
    cut = []
    for k in range(len(KINDS)):
        sure = [s for s in steps.get(k, []) if s[0] >= MIN_PROBABILITY * s[1]]
        below = [s for s in steps.get(k, []) if s[0] < MIN_PROBABILITY * s[1]]
        if sum(s[0] for s in sure) < MIN_SUPPORT:
            cut.append(np.inf)
            continue
        least = sure[0][2]                   # a step lies halfway between neighbouring scores
        cut.append((least + (below[-1][3] if below else -least)) / 2)
    return Model(trees, cut)


def find(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans): all spans of each row in order of start, then kind; each
    has its kind, start, end and whether it is a strict one.  No shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t in b["text"]:
                base = base_spans(t) if t else []
                more = model.keep(t, base) if t else []
                strict = set(base)
                out.append([{"kind": KINDS[p[1]], "start": p[0], "end": p[2],
                             "base": p in strict} for p in sorted(base + more)])
            yield pd.DataFrame({"key": b["key"], "spans": out})

    return common.through_python(
        _needed(df, key, text), run,
        "spans array<struct<kind:string,start:int,end:int,base:boolean>>")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts of strict spans by kind, their SHA-256, and all spans as text."""
    def strict(kind: str) -> Column:
        return F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))

    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        F.col("key").alias("doc_id"),
        *[F.size(strict(k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"))


def redactor(model: Model):
    """A function text -> text that replaces each run of overlapping spans by
    the kind of its first span in capitals and square brackets."""

    def redact(t: str) -> str:
        base = base_spans(t)
        out, done, open_ = [], 0, -1
        for start, kind, end in sorted(base + model.keep(t, base)):
            if start < open_:
                open_ = max(open_, end)
                done = open_
                continue
            out += [t[done:start], f"[{KINDS[kind].upper()}]"]
            done = open_ = end
        return "".join(out) + t[done:]

    return redact


def redact(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with its text redacted; a null text stays null."""
    one = redactor(model)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else one(t))

    return common.replace_column(
        df, text, lambda c: F.when(c.rlike(NEEDS), clean(c)).otherwise(c))
