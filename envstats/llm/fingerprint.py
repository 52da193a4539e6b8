"""Document fingerprints (operator 10): homomorphic multiset hash, native.

A text is the multiset of its paragraphs; here a paragraph is a line, cut
further after sentence ends so that a text of one line has parts, too, with
white space around it removed.  Each part is hashed to a wide vector, and the
fingerprint is the sum of the vectors, word by word modulo 2^63:

* ``NARROW`` words hold two 31-bit counters each; counter i counts the parts
  whose hash has bit i set.  ``2 * count - parts`` is a +-1 projection, so the
  cosine of two fingerprints estimates how much of two multisets agrees.  They
  are summed three to a word, for ``PIECE`` parts at a time, and then widened;
* ``WIDE`` words sum whole hashes and tell multisets apart;
* the last word counts the parts.

Sums do not depend on order, equal texts have equal fingerprints, and parts
can be inserted or deleted (``add``, ``remove``) without the rest of the text.

Everything is DataFrame functions: no UDF, no explode, no grouping of a
document; a row is fingerprinted in place, so skewed ids do not matter.  The
next document is found from a narrow table of ids: range-partitioned, with a
window inside each partition, and only the partition heads (one row per
partition) meet in one task.  Each document then sends its head and its
fingerprint to its predecessor; whole texts are exchanged once.

Defined results: null text is the empty text (the zero vector); a null id
sorts first; rows with equal id and text count once in the order and get
equal results; rows with equal id and different texts follow each other in
the order of (hash, length) of their texts; an empty table gives an empty
table.  Texts may be as long as a Spark string: it has fewer than 2^31 parts,
which is what a counter holds.  The likeness of two equal vectors is 1, that of an empty and a
non-empty one 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envstats.llm import common

NARROW, WIDE = 63, 4              # words with two counters, words with whole hashes
_LANE = (1 << 21) - 1
PIECE = _LANE                     # parts whose bits are summed three counters to a word, at most
_PACKED = 2 * NARROW // 3         # words of these sums
_ONES = 1 | 1 << 21 | 1 << 42     # lowest bit of each counter of such a word
_LOW = (1 << 31) - 1
_MOD = (1 << 63) - 1              # sums are taken modulo 2^63
_PARTS = r"(?<=[.!?\n])(?=[^.!?\n])"
_FIRST = -(1 << 63)               # stands for a null id (and is one, as an id)


def _sum(values: Column, word) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"),
                       lambda total, h: (total - _MOD - 1 + word(h)).bitwiseAND(F.lit(_MOD)))


def parts(text: Column) -> Column:
    """Parts of a text, as an array."""
    return F.filter(F.transform(F.split(text, _PARTS), lambda p: F.btrim(p, F.lit(" \t\r\n"))),
                    lambda p: p != "")


def _bits(i: int):
    return lambda h: F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_ONES))


def _packed(hashes: list[Column]) -> Column:
    """Sums of all hash bits, three counters of 21 bits to a word."""
    return F.array(*[_sum(h, _bits(i)) for h in hashes for i in range(_PACKED // 2)])


def _widened(packed: Column) -> Column:
    """The same counters, two of 31 bits to a word."""
    def words(p: Column) -> Column:
        lane = [F.shiftrightunsigned(F.element_at(p, 1 + k // 3), 21 * (k % 3)).bitwiseAND(F.lit(_LANE))
                for k in range(2 * NARROW)]
        return F.array(*[a.bitwiseOR(F.shiftleft(b, 31)) for a, b in zip(lane[::2], lane[1::2])])

    return F.element_at(F.transform(F.array(packed), words), 1)     # binds the sums once


def vector(hashes: list[Column]) -> Column:
    """Fingerprint vector (NARROW + WIDE + 1 longs) from ``hashes_of`` arrays."""
    size, bits = F.size(hashes[0]), hashes[:2]

    def piece(total: Column, k: Column) -> Column:
        part = [F.slice(h, k * PIECE + 1, F.lit(PIECE)) for h in bits]
        return F.zip_with(total, _widened(_packed(part)), lambda x, y: x + y)

    pieces = F.sequence(F.lit(0), F.floor(size / PIECE).cast("int"))
    none = F.array_repeat(F.lit(0).cast("long"), NARROW)
    counters = F.when(size <= PIECE, _widened(_packed(bits))).otherwise(F.aggregate(pieces, none, piece))
    whole = [_sum(h, lambda x: F.shiftrightunsigned(x, 2)) for h in hashes[2:]]
    return F.concat(counters, F.array(*whole, size.cast("long")))


def with_vector(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint vector of column ``text`` as ``name``."""
    out = df.withColumn("_parts", parts(F.col(text)))
    seeds = range(2 + WIDE)
    out = out.withColumns({f"_h{s}": F.transform("_parts", _hash(s)) for s in seeds})
    out = out.withColumn(name, vector([F.col(f"_h{s}") for s in seeds]))
    return out.drop("_parts", *[f"_h{s}" for s in seeds])


def _hash(seed: int):
    return lambda p: F.xxhash64(p, F.lit(seed))


def add(a: Column, b: Column) -> Column:
    """Vector of the two multisets together."""
    return F.zip_with(a, b, lambda x, y: (x - F.lit(_MOD) - 1 + y).bitwiseAND(F.lit(_MOD)))


def remove(a: Column, b: Column) -> Column:
    """Vector of multiset ``a`` without the parts of ``b``."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(_MOD)))


def text_form(v: Column) -> Column:
    """A vector as hexadecimal text."""
    return F.array_join(F.transform(v, lambda w: F.lpad(F.hex(w), 16, "0")), "")


def _dot(a: Column, b: Column) -> Column:
    """Dot product of the +-1 projections of two vectors."""
    na, nb = (F.element_at(v, NARROW + WIDE + 1).cast("double") for v in (a, b))

    def lane(word: Column, at: int, n: Column) -> Column:
        return 2.0 * F.shiftrightunsigned(word, at).bitwiseAND(F.lit(_LOW)) - n

    def two(x: Column, y: Column) -> Column:
        return lane(x, 0, na) * lane(y, 0, nb) + lane(x, 31, na) * lane(y, 31, nb)

    return F.aggregate(F.zip_with(F.slice(a, 1, NARROW), F.slice(b, 1, NARROW), two),
                       F.lit(0.0), lambda total, x: total + x)


def likeness(a: Column, b: Column) -> Column:
    """Cosine of two fingerprints, from 0 (nothing shared) to 1 (equal)."""
    size = F.sqrt(_dot(a, a) * _dot(b, b))
    cosine = F.when(size > 0, _dot(a, b) / size).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0)))


def neighbours(ids: DataFrame, *keys: str) -> DataFrame:
    """Distinct ``keys`` in ascending order, each with its predecessor's
    columns as ``prev_*`` (the first one's predecessor is the last)."""
    placed = common.written(
        ids.distinct().repartitionByRange(*keys)
        .withColumn("part", F.spark_partition_id()), "order")
    row = F.struct(*keys)
    tails = placed.groupBy("part").agg(F.max(row).alias("tail"))       # a row per partition
    last = tails.agg(F.max("tail").alias("last"))
    before = tails.select("part", F.lag("tail").over(Window.orderBy("part")).alias("tail"))
    inside = placed.withColumn(
        "prev", F.lag(row).over(Window.partitionBy("part").orderBy(*keys)))
    out = inside.join(F.broadcast(before), "part").join(F.broadcast(last))
    prev = F.coalesce("prev", "tail", "last")
    return out.select(*keys, *[prev[k].alias(f"prev_{k}") for k in keys])


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, vector, edited, next_vector) of every row: ``edited`` has the
    last half of its code points replaced by the first as many of the next
    document."""
    plain = common.pick(docs, key=key, text=text)
    kind = plain.schema["key"].dataType
    rows = plain.select(F.coalesce(F.col("key").cast("long"), F.lit(_FIRST)).alias("k"),
                        common.text_of(F.col("text")).alias("text"))
    rows = rows.withColumns({"h": F.xxhash64("text"), "n": F.length("text")})
    at = ["k", "h", "n"]
    linked = rows.join(neighbours(rows.select(*at), *at).hint("merge"), at)
    sent = linked.select(
        *[F.col(f"prev_{c}").alias(c) for c in at],
        F.expr("left(text, cast(floor(prev_n / 2) as int))").alias("head"), "text")
    sent = with_vector(sent, "text", "next_vector").drop("text").dropDuplicates(at)
    both = rows.join(sent.hint("merge"), at)      # the same exchange of whole texts, reused
    both = both.withColumn("edited", F.concat(
        F.expr("left(text, n - cast(floor(n / 2) as int))"), F.col("head")))
    return with_vector(both, "text", "vector").select(
        F.when(F.col("k") != _FIRST, F.col("k")).cast(kind).alias("key"),
        "text", "n", "vector", "edited", "next_vector")


def digests(pairs: DataFrame) -> DataFrame:
    """The query's columns from ``with_next`` rows."""
    v = with_vector(pairs, "edited", "edited_vector")
    own, edited, after = F.col("vector"), F.col("edited_vector"), F.col("next_vector")
    return v.select(
        F.col("key").alias("doc_id"), F.col("n").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        text_form(own).alias("fingerprint"), text_form(edited).alias("edited_fingerprint"),
        likeness(own, edited).alias("near_edited"), likeness(own, after).alias("near_next"))
