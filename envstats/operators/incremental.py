"""Summaries that grow with their files (AGG-10, AGG-13, AGG-15, AGG-16).

A summary of sums and counts is kept as partial states, one per key and source
file version.  An update reads the files that are new or changed since the last
one, adds their states, and drops those of changed or removed files; the summary
is the states' sum.  Work and shuffle follow the new files, not the table.

State folder: ``states/commit=N`` (a row per file and key) and ``files/N`` (which
file version is in which commit, whole at each commit).  An update that dies
before it has written ``files/N`` is invisible and is done again.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envstats.operators.joins import sized_broadcast
from envstats.session import data_version


class Summary:
    """Sums per key over the files of a folder.

    ``read(paths)`` gives the rows of some files (paths as Spark lists them) with
    their ``_metadata``; ``sums`` are the summed expressions by name.
    """

    def __init__(self, spark: SparkSession, root: str, read: Callable[[list[str]], DataFrame],
                 keys: dict[str, Column], sums: dict[str, Column]):
        self.spark, self.root, self.read, self.keys, self.sums = spark, root, read, keys, sums
        self.commit, self.read_last = -1, []

    def _files(self) -> DataFrame | None:
        if self.commit < 0:
            return None
        return self.spark.read.parquet(f"{self.root}/files/{self.commit}")

    def update(self, path: str) -> list[str]:
        """Bring the states up to the files of ``path``; the files that were read."""
        now = {re.sub(r"^(\w+):///", r"\1:/", f): f"{size}-{at}"       # as _metadata names them
               for f, size, at in data_version(self.read([path]))}
        files = self._files()
        held = {r["file"]: r for r in files.collect()} if files is not None else {}   # a row per file, as listed
        kept = [tuple(held[f]) for f in now if f in held and held[f]["version"] == now[f]]
        new = sorted(set(now) - {k[0] for k in kept})
        commit = self.commit + 1
        if new:
            rows = self.read(new).select(F.col("_metadata.file_path").alias("file"),
                                         *[c.alias(k) for k, c in self.keys.items()],
                                         *[c.alias(k) for k, c in self.sums.items()])
            states = rows.groupBy("file", *self.keys).agg(*[F.sum(k).alias(k) for k in self.sums])
            states.write.mode("overwrite").parquet(f"{self.root}/states/commit={commit}")
        rows = kept + [(f, now[f], commit) for f in new]
        (self.spark.createDataFrame(rows, "file string, version string, at int")
         .coalesce(1).write.mode("overwrite").parquet(f"{self.root}/files/{commit}"))
        self.commit, self.read_last = commit, new
        return new

    def table(self) -> DataFrame:
        """The summary: a row per key with the sums over all current files."""
        files = self._files()
        states = self.spark.read.parquet(f"{self.root}/states")
        live = states.join(sized_broadcast(files.select("file", F.col("at").alias("commit"))),
                           ["file", "commit"], "left_semi")
        return live.groupBy(*self.keys).agg(*[F.sum(k).alias(k) for k in self.sums])
