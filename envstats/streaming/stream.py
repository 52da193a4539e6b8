"""Structured Streaming form of the enrichment and aggregates (SRC-5,
SNK-1..5, STR-1..13).

The enrichment and aggregate bodies are the batch functions themselves
(``severity.enrich``, ``alerts.region_summary``, ``trends.month_bucket_trend``,
``alerts.alert_feed``), so stream and batch results are equal by
construction and checked to be.

Sinks:
* ``memory``   complete/append tables in the driver, for small results and
               interactive SQL (SNK-2, SNK-3);
* ``parquet``  durable append with a checkpoint, exactly-once (SNK-4);
* ``console``  per-batch alert print (SNK-5);
* ``snapshot`` durable form of a complete-mode aggregate: ``update`` mode
               rows of each micro-batch are written to their own
               ``batch_id=N`` folder (a replayed batch rewrites only its own
               folder, so replays are idempotent), and the current table is
               the latest row per group key, read back with one aggregate;
               every few batches a full table is written beside the deltas,
               a pointer names the newest, and folders that the last two
               full tables cover are removed, so what is listed and read
               does not grow with the stream's age.

Runs are bounded with ``availableNow`` (all files present at start, still
``maxFilesPerTrigger`` per micro-batch, by default as many as the cluster
has cores); a run takes as long as its input needs, or raises after the
limit that its caller sets (T10).  Only the queries a run started are
stopped (T20).
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from envstats import constants as C
from envstats import schemas
from envstats.operators import quality, severity
from envstats.session import scratch_path
from envstats.sources.files import stage_csv
from envstats.spec import DEFAULT, Spec


# --- input -------------------------------------------------------------------

def stage_input(df: DataFrame, path: str, rows_per_file: int = 100_000,
                spec: Spec = DEFAULT, compression: str = "none") -> str:
    """Write the stream input files: the twelve stream columns in file order,
    rows with null score / precipitation / max temperature dropped (FLT-2,
    SNK-1).  Distributed write; nothing passes the driver."""
    cols = []
    for f in schemas.STREAM.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType.simpleString()).alias(f.name))
    staged = quality.drop_null(df, [spec.score, spec.precip, spec.temp_max]).select(*cols)
    assert tuple(staged.columns) == C.STREAM_COLUMNS   # positional CSV schema
    return stage_csv(staged, path, rows_per_file, compression)


def read_stream(spark: SparkSession, path: str, schema: StructType = schemas.STREAM,
                max_files_per_trigger: int = 1, fmt: str = "csv") -> DataFrame:
    """File stream with a declared schema, header on (SRC-5, STR-2)."""
    r = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        r = r.option("header", "true")
    return r.load(path)


def enrich_stream(df: DataFrame, spec: Spec = DEFAULT) -> DataFrame:
    """``IS NOT NULL`` score filter + label + flags (STR-3, FLT-3)."""
    return severity.enrich(quality.keep_not_null(df, spec.score), spec)


# --- sinks ---------------------------------------------------------------------

@contextmanager
def _state_partitions(spark: SparkSession, n: int | None):
    """Start a stateful query with ``n`` state partitions.

    A stream takes its state partition count from ``spark.sql.shuffle.partitions``
    when it first starts and keeps it for the life of its checkpoint, so a
    cluster-wide setting sized for batch shuffles (tens of thousands) would
    give a few thousand groups as many state stores per micro-batch.  The
    setting is changed only around ``start()`` and restored after it."""
    if not n:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(int(n)))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def default_state_partitions(spark: SparkSession, cap: int | None = None) -> int:
    """State partitions for the grouped stream aggregates of this library:
    one wave of the cluster's cores, at most the session setting (and at
    most ``cap``, where the caller knows that the groups are few).  Their state is one row per group (counties, months: bounded
    by geography and calendar), and each micro-batch reaches the state
    shuffle already partially aggregated (at most one row per group and
    task), so more partitions would only add empty state-store tasks to
    every micro-batch.  A stream with a large or growing key space passes
    its own count (and the RocksDB store, ``session.scale_conf``)."""
    par = spark.sparkContext.defaultParallelism
    n = min(par, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(1, n if cap is None else min(cap, n))


def _trigger(w, trigger):
    if trigger is None or trigger == "availableNow":
        return w.trigger(availableNow=True)
    if trigger == "once":
        return w.trigger(once=True)
    return w.trigger(processingTime=trigger)


def to_memory(df: DataFrame, name: str, mode: str = "complete", trigger=None,
              checkpoint: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Memory sink (SNK-2, SNK-3); ``name`` becomes a table for SQL (SRC-6)."""
    w = df.writeStream.outputMode(mode).format("memory").queryName(name)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    with _state_partitions(df.sparkSession, state_partitions):
        return _trigger(w, trigger).start()


def to_parquet(df: DataFrame, path: str, checkpoint: str, trigger=None,
               partition_by=None, name: str | None = None) -> StreamingQuery:
    """Durable append sink with its own checkpoint (SNK-4, STR-10)."""
    w = (df.writeStream.outputMode("append").format("parquet")
           .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger).start()


def to_console(df: DataFrame, mode: str = "append", trigger=None, rows: int = 20,
               checkpoint: str | None = None) -> StreamingQuery:
    """Console sink for live alerts per micro-batch (SNK-5)."""
    w = df.writeStream.outputMode(mode).format("console").option("numRows", rows) \
          .option("truncate", "false")
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


SNAPSHOT_COMPACT_EVERY = 10


def to_snapshot(df: DataFrame, path: str, checkpoint: str, trigger=None,
                name: str | None = None, keys=None,
                compact_every: int = SNAPSHOT_COMPACT_EVERY,
                state_partitions: int | None = None) -> StreamingQuery:
    """Durable complete-mode equivalent for a grouped aggregate (see module doc).

    With ``keys`` given, every ``compact_every``-th batch also writes the
    full current table to ``{path}-full/batch_id=N``, then names N in the
    pointer ``{path}-full/_latest``; readers start from that table and read
    the delta folders after it, by their paths.  A replayed batch rewrites
    the same delta and the same full table (both are functions of the
    committed deltas up to it), so compaction stays idempotent.  The last two
    full tables and the deltas after the older one are kept (a reader that
    has just read the pointer still finds its files); older folders go.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if keys and compact_every and batch_id > 0 and batch_id % compact_every == 0:
            # base strictly before this batch: a replay never reads the folder it rewrites
            spark = batch.sparkSession
            current = read_snapshot(spark, path, keys, upto=batch_id, base_before=True)
            current.write.mode("overwrite").parquet(f"{path}-full/batch_id={batch_id}")
            _point(spark, path, batch_id)
            _retain(spark, path, batch_id - compact_every)

    w = (df.writeStream.outputMode("update").foreachBatch(write_batch)
           .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    with _state_partitions(df.sparkSession, state_partitions):
        return _trigger(w, trigger).start()


def _folder(spark: SparkSession, path: str):
    """(Hadoop file system, path class) of a folder."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Batch numbers of the ``batch_id=N`` folders under ``path``, ascending."""
    fs, at = _folder(spark, path)
    if not fs.exists(at(path)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at(path))]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch_id="))


def _pointer(spark: SparkSession, path: str) -> int | None:
    """Batch number of the newest complete full table."""
    fs, at = _folder(spark, path)
    names = ([s.getPath().getName() for s in fs.listStatus(at(f"{path}-full"))]
             if fs.exists(at(f"{path}-full")) else [])
    found = [int(n.split("=")[1]) for n in names if n.startswith("_latest=")]
    return max(found, default=None)


def _point(spark: SparkSession, path: str, batch_id: int) -> None:
    """Name full table ``batch_id`` as complete (an empty marker file), then drop
    the marks more than one older."""
    fs, at = _folder(spark, path)
    fs.create(at(f"{path}-full/_latest={batch_id}"), True).close()
    marks = sorted((s.getPath() for s in fs.listStatus(at(f"{path}-full"))
                    if s.getPath().getName().startswith("_latest=")),
                   key=lambda p: int(p.getName().split("=")[1]))
    for old in marks[:-2]:
        fs.delete(old, False)


def _retain(spark: SparkSession, path: str, oldest_full: int) -> None:
    """Remove full tables before ``oldest_full`` and the deltas that it covers."""
    fs, at = _folder(spark, path)
    for n in _batches(spark, f"{path}-full"):
        if n < oldest_full:
            fs.delete(at(f"{path}-full/batch_id={n}"), True)
    if oldest_full in _batches(spark, f"{path}-full"):
        for n in _batches(spark, path):
            if n <= oldest_full:
                fs.delete(at(f"{path}/batch_id={n}"), True)


def read_snapshot(spark: SparkSession, path: str, keys, upto: int | None = None,
                  base_before: bool = False) -> DataFrame:
    """Current aggregate table from a snapshot sink: per group key, the row
    of the latest micro-batch (one aggregate, partial per task).  Reads the
    newest complete full table at or before ``upto`` (strictly before it with
    ``base_before``) and the delta folders after it, each by its path."""
    fulls = [n for n in _batches(spark, f"{path}-full")
             if n <= (_pointer(spark, path) if _pointer(spark, path) is not None else -1)
             and (upto is None or (n < upto if base_before else n <= upto))]
    base = max(fulls, default=None)
    wanted = [f"{path}/batch_id={n}" for n in _batches(spark, path)
              if (upto is None or n <= upto) and (base is None or n > base)]
    wanted += [] if base is None else [f"{path}-full/batch_id={base}"]
    rows = spark.read.parquet(*wanted).withColumn(
        "batch_id", F.regexp_extract(F.input_file_name(), "/batch_id=([0-9]+)/", 1).cast("long"))
    vals = [c for c in rows.columns if c not in keys and c != "batch_id"]
    latest = (rows.groupBy(*keys)
                  .agg(F.max_by(F.struct(*[F.col(c) for c in vals]), F.col("batch_id")).alias("__r")))
    return latest.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in vals])


# --- running -------------------------------------------------------------------

def run_bounded(queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Wait for every query to drain its input; raise on failure, and after
    ``timeout_s`` seconds where the caller sets a limit.

    Stops only these queries, always (STR-7..9)."""
    try:
        for q in queries:
            done = q.awaitTermination(timeout_s)   # None: until the input is drained
            if timeout_s is not None and not done:
                raise TimeoutError(f"stream {q.name or q.id} did not finish in {timeout_s}s")
            if q.exception() is not None:
                raise RuntimeError(f"stream {q.name or q.id} failed: {q.exception()}")
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Micro-batch progress of a query as rows (batchId, numInputRows, rate)."""
    rows = [(int(p["batchId"]), int(p.get("numInputRows", 0)),
             float(p.get("processedRowsPerSecond", 0.0) or 0.0))
            for p in query.recentProgress]
    return spark.createDataFrame(rows, "batchId long, numInputRows long, processedRowsPerSecond double")


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


# --- end-to-end helpers used by the named queries ----------------------------

class StreamRun:
    """Stage ``source`` under the shared folder and drive stream queries over it."""

    def __init__(self, spark: SparkSession, source: DataFrame, rows_per_file: int = 100_000,
                 spec: Spec = DEFAULT, max_files_per_trigger: int | None = None,
                 state_partitions: int | None = None, compression: str = "none"):
        self.spark = spark
        self.spec = spec
        self.state_partitions = state_partitions or default_state_partitions(spark)
        self.root = scratch_path(spark, "stream")
        self.input = stage_input(source, f"{self.root}/input", rows_per_file, spec, compression)
        self.max_files = max_files_per_trigger or spark.sparkContext.defaultParallelism

    def enriched(self) -> DataFrame:
        return enrich_stream(read_stream(self.spark, self.input,
                                         max_files_per_trigger=self.max_files), self.spec)

    def aggregate(self, body, keys, timeout_s: float | None = None,
                  compact_every: int = SNAPSHOT_COMPACT_EVERY) -> DataFrame:
        """Run ``body(enriched_stream)`` as a snapshot stream; return its table."""
        out = f"{self.root}/agg-{uuid.uuid4().hex[:8]}"
        q = to_snapshot(body(self.enriched()), out, f"{out}-ckpt", name=unique_name("agg"),
                        keys=keys, compact_every=compact_every,
                        state_partitions=self.state_partitions)
        run_bounded([q], timeout_s)
        return read_snapshot(self.spark, out, keys)

    def aggregate_in_memory(self, body, timeout_s: float | None = None) -> DataFrame:
        """Complete-mode memory table of ``body(enriched_stream)``."""
        name = unique_name("mem")
        q = to_memory(body(self.enriched()), name, "complete",
                      checkpoint=f"{self.root}/{name}-ckpt", state_partitions=self.state_partitions)
        run_bounded([q], timeout_s)
        return self.spark.table(name)

    def append_in_memory(self, body, timeout_s: float | None = None) -> DataFrame:
        """Append-mode memory table of ``body(enriched_stream)`` (SNK-3): for
        feeds whose rows fit the driver, as for live inspection."""
        name = unique_name("mem")
        q = to_memory(body(self.enriched()), name, "append",
                      checkpoint=f"{self.root}/{name}-ckpt")
        run_bounded([q], timeout_s)
        return self.spark.table(name)

    def result_view(self, body, keys, timeout_s: float | None = None) -> str:
        """Drain ``body(enriched_stream)`` into a snapshot sink and register its
        current table as a temporary view for SQL text (SRC-6, STR-12); the
        result stays distributed, whatever the number of groups."""
        name = unique_name("view")
        self.aggregate(body, keys, timeout_s).createOrReplaceTempView(name)
        return name

    def append_parquet(self, body=None, timeout_s: float | None = None) -> DataFrame:
        """Append ``body(enriched_stream)`` (default: all enriched rows) to parquet."""
        out = f"{self.root}/out-{uuid.uuid4().hex[:8]}"
        s = self.enriched()
        q = to_parquet(body(s) if body else s, out, f"{out}-ckpt", name=unique_name("pq"))
        run_bounded([q], timeout_s)
        return self.spark.read.parquet(out)
