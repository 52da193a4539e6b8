"""WARC archives with a Zstandard dictionary (operator 8).

Writing: each task writes its records, sorted by page id, into archives of
about ``ARCHIVE_BYTES``; an archive starts with one skippable frame that
holds the (trained) dictionary and continues with one Zstandard frame per
record.  Archives have names that follow from the partition and their order
and are moved into place whole, so a task that runs again after an executor
is lost replaces them by equal ones.

Reading: Spark reads the archives as binary files; for each one the reader
loads the dictionary from the leading skippable frame, decodes frame by
frame, and validates the version line, the mandatory headers, the declared
lengths and, for responses, the payload digest.  An archive that fails a
check raises; nothing is skipped.

A payload of at least ``MIN_REVISIT`` bytes that several pages share is
stored once, in the record of the largest page id; the others are revisit
records, which keep the digest and (in their HTTP header) the full length.
Smaller payloads are always stored.

Defined results: null html is the empty payload; a null or odd url is
written percent-encoded and comes back as it was; a null page id makes a
record without a page id, which is always a response; repeated rows with the
largest id are all responses; an empty table gives an empty table; where the
sample of pages is too small to train on (fewer than 16 of them, or less than
eight times the dictionary) the leading frame holds an empty dictionary.
"""

from __future__ import annotations

import hashlib
import io
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import numpy as np
import pandas as pd
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstats.llm import common
from envstats.operators.joins import sized_broadcast
from envstats.session import scratch_path

MIN_REVISIT = 1000
ARCHIVE_BYTES = 16 << 20     # an archive is closed once its frames reach this size
DICTIONARY_BYTES = 64 << 10  # of the trained dictionary
SAMPLE_PAGES = 400           # pages that train the dictionary (about, by a hash of the payload)
SAMPLE_BYTES = 16 << 10      # head of each of them
_SKIPPABLE = 0x184D2A5D      # magic number of the dictionary's skippable frame
_FRAME = b"\x28\xb5\x2f\xfd"
_NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "WARC-Payload-Digest")
_DATE = "2020-01-01T00:00:00Z"
_PAGE = "urn:page:"


class ArchiveError(ValueError):
    """An archive that breaks the format."""


# -- one record --------------------------------------------------------------
def record(page_id, url, payload: bytes, digest: str, refers_to, length: int) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    name = f"{_PAGE}{page_id}" if page_id is not None else f"{_PAGE}none"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {_DATE}",
            "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=')}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_PAGE}{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(lines: bytes) -> dict[str, str]:
    out = {}
    for line in lines.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise ArchiveError(f"header without a colon: {line[:80]!r}")
        out[name.decode()] = value.strip().decode()
    return out


def _page_number(uri: str) -> str | None:
    if not uri.startswith(f"<{_PAGE}") or not uri.endswith(">"):
        raise ArchiveError(f"record id {uri!r}")
    n = uri[len(_PAGE) + 1:-1]
    return None if n == "none" else str(int(n))


def parse(data: bytes) -> dict:
    """Fields of one record; raises unless all declared facts hold."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if version != b"WARC/1.1" or not blank:
        raise ArchiveError(f"version {version[:40]!r}")
    h = _headers(lines)
    missing = [n for n in _NEEDED if n not in h]
    if missing:
        raise ArchiveError(f"headers missing: {missing}")
    size = int(h["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ArchiveError(f"block of {len(rest) - 4} bytes, declared {size}")
    http, blank, payload = rest[:size].partition(b"\r\n\r\n")
    status, _, fields = http.partition(b"\r\n")
    if not status.startswith(b"HTTP/1.1 200") or not blank:
        raise ArchiveError(f"status line {status[:40]!r}")
    length = int(_headers(fields)["Content-Length"])
    algorithm, _, digest = h["WARC-Payload-Digest"].partition(":")
    kind, refers = h["WARC-Type"], h.get("WARC-Refers-To")
    if algorithm != "sha1" or kind not in ("response", "revisit") or (kind == "revisit") != bool(refers):
        raise ArchiveError(f"record of type {kind!r}, digest {algorithm!r}, refers to {refers!r}")
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ArchiveError("payload differs from its length or digest")
    if kind == "revisit" and payload:
        raise ArchiveError("revisit with a payload")
    url = h.get("WARC-Target-URI")
    return {"page_id": _page_number(h["WARC-Record-ID"]), "url": None if url is None else unquote(url),
            "payload": payload if kind == "response" else None, "payload_bytes": length,
            "payload_digest": digest, "record_type": kind,
            "refers_to": _page_number(refers) if refers else None}


# -- one archive ---------------------------------------------------------------
def leading_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", _SKIPPABLE, len(dictionary)) + dictionary


def read_archive(data: bytes) -> Iterator[dict]:
    """Records of one archive, one frame at a time."""
    if len(data) < 8:
        raise ArchiveError("no leading frame")
    magic, size = struct.unpack_from("<II", data)
    if magic != _SKIPPABLE or len(data) < 8 + size:
        raise ArchiveError("no dictionary in the leading frame")
    held = data[8:8 + size]
    decoder = zstandard.ZstdDecompressor(
        dict_data=zstandard.ZstdCompressionDict(held) if held else None)
    at, view = 8 + size, memoryview(data)
    while at < len(data):
        if bytes(view[at:at + 4]) != _FRAME:
            raise ArchiveError(f"no frame at byte {at}")
        one = decoder.decompressobj()
        try:
            out = [one.decompress(view[at:at + (1 << 16)])]
            end = at + (1 << 16)
            while not one.eof:
                if end >= len(data):
                    raise ArchiveError(f"frame at byte {at} is cut off")
                out.append(one.decompress(view[end:end + (1 << 16)]))
                end += 1 << 16
        except zstandard.ZstdError as e:
            raise ArchiveError(f"frame at byte {at}: {e}") from e
        at = min(end, len(data)) - len(one.unused_data)
        yield parse(b"".join(out))


def train(samples: list[bytes]) -> bytes:
    """Dictionary of a bounded list of samples; empty if they are too few."""
    if sum(map(len, samples)) < 8 * DICTIONARY_BYTES or len(samples) < 16:
        return b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()


# -- tables ----------------------------------------------------------------------
def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url",
          html: str = "html") -> None:
    """Write one record per row into archives under ``folder`` (any URI that
    pyarrow's file systems or, for a plain path, the local one can open)."""
    rows = common.pick(pages, key=key, url=url, html=html).withColumn(
        "html", common.text_of(F.col("html")).cast("binary"))
    rows = rows.withColumns({"digest": F.sha1("html"), "n": F.octet_length("html").cast("long")})
    kept = (rows.where((F.col("n") >= MIN_REVISIT) & F.col("key").isNotNull())
            .groupBy("digest").agg(F.max("key").alias("kept"), F.count("*").alias("copies"))
            .where("copies > 1").drop("copies"))
    # a row per payload with copies: broadcast behind a size check, else a shuffle
    # join, in which payloads that can be no revisit are spread by their page
    page = F.concat_ws(" ", F.lit("page"), F.col("key").cast("string"), "url")
    named = rows.withColumn("of", F.when(F.col("n") >= MIN_REVISIT, F.col("digest")).otherwise(page))
    kept = sized_broadcast(common.written(kept.withColumnRenamed("digest", "of"), "kept"))
    linked = named.join(kept, "of", "left").select(
        "key", "url", "digest", "n",
        F.when(F.col("key") < F.col("kept"), F.col("kept")).alias("refers_to"), "html")
    linked = linked.withColumn("html", F.when(F.col("refers_to").isNull(), F.col("html")))
    heads = common.hash_sample(rows, SAMPLE_PAGES, "digest").groupBy("digest").agg(
        F.first(F.substring("html", 1, SAMPLE_BYTES)).alias("head"))     # copies count once
    dictionary = train([bytes(r["head"]) for r in sorted(heads.collect())])
    ready = linked.sortWithinPartitions("key", "digest", "url").withColumns(
        {c: F.col(c).cast("string") for c in ("key", "refers_to")})   # exact beside nulls

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = zstandard.ZstdCompressor(
            level=6, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        part, number, out, count = TaskContext.get().partitionId(), 0, io.BytesIO(), 0

        def close() -> None:
            name = f"part-{part:06d}-{number:05d}.warc.zst"
            hidden = f"{root}/_{name}-{TaskContext.get().taskAttemptId()}"
            with system.open_output_stream(hidden) as f:
                f.write(out.getvalue())
            system.move(hidden, f"{root}/{name}")

        for b in batches:
            for r in b.itertuples(index=False):
                if not out.tell():
                    out.write(leading_frame(dictionary))
                out.write(coder.compress(
                    record(r.key, r.url, r.html or b"", r.digest, r.refers_to, int(r.n))))
                count += 1
                if out.tell() >= ARCHIVE_BYTES:
                    close()
                    number, out = number + 1, io.BytesIO()
        if out.tell():
            close()
        yield pd.DataFrame({"n": np.array([count], np.int64)})

    written = ready.mapInPandas(run, "n long").agg(F.sum("n")).first()[0]
    if not written:
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """A pyarrow file system and the path in it."""
    if uri.startswith("file:") or not urlsplit(uri).scheme:
        return fs.LocalFileSystem(), urlsplit(uri).path if uri.startswith("file:") else uri
    return fs.FileSystem.from_uri(uri)


def read_archives(spark, folder: str, payload: bool = True) -> DataFrame:
    """All records of the archives under ``folder``."""
    schema = ("page_id string, url string, payload binary, payload_bytes long, "
              "payload_digest string, record_type string, refers_to string")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for data in b["content"]:
                rows = []
                for r in read_archive(data):
                    if not payload:
                        r["payload"] = None
                    rows.append(r)
                    if len(rows) == 500:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                yield pd.DataFrame(rows, columns=names)

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.zst")
             .load(folder).select("content"))
    ids = {c: F.col(c).cast("long") for c in ("page_id", "refers_to")}   # exact beside nulls
    return files.mapInPandas(run, schema).withColumns(ids)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url",
               html: str = "html") -> DataFrame:
    """Write the archives into the shared folder and read them back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write(pages, folder, key, url, html)
    return read_archives(spark, folder, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
