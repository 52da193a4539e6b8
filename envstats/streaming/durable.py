"""Long-running streams: feeds that grow, restarts, state as a table, progress of
a whole run, and malformed rows (SRC-5, SNK-4, STR-4, STR-7, STR-10).

* ``LiveFeed``: staged files that arrive bit by bit, so that a query can be
  stopped in mid-feed and resumed on its checkpoint;
* ``rocksdb``: starts queries on the RocksDB store with changelog checkpoints;
  ``state_table`` reads a checkpoint's state back as rows;
* ``ProgressLog``: a streaming listener that writes every micro-batch's progress
  and observed metrics to the shared folder (``recentProgress`` keeps the last
  100 batches only);
* ``to_good_and_rejects``: the CSV source with malformed rows in a sink of their
  own, replays included.
"""

from __future__ import annotations

import json
import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from envstats import schemas
from envstats.session import scratch_path
from envstats.sources.files import REJECTED, stage_csv
from envstats.spec import DEFAULT, Spec
from envstats.streaming.stream import _folder, _trigger, stage_input


class LiveFeed:
    """A stream folder that receives its files on demand.

    The files are staged beside the folder and moved into it (a rename inside
    one file system: whole files appear at once, no bytes pass the driver).
    """

    def __init__(self, spark: SparkSession, source: DataFrame, rows_per_file: int = 100_000,
                 spec: Spec = DEFAULT, compression: str = "none"):
        self.spark = spark
        self.root = scratch_path(spark, "feed")
        self.staged = stage_input(source, f"{self.root}/staged", rows_per_file, spec, compression)
        self.path = f"{self.root}/live"
        fs, at = _folder(spark, self.path)
        fs.mkdirs(at(self.path))

    def waiting(self) -> list[str]:
        """Names of the staged files that have not arrived yet."""
        fs, at = _folder(self.spark, self.staged)
        names = [s.getPath().getName() for s in fs.listStatus(at(self.staged))]
        return sorted(n for n in names if n.endswith((".csv", ".csv.gz")))

    def release(self, share: float = 1.0) -> int:
        """Move a share of the waiting files into the stream folder."""
        fs, at = _folder(self.spark, self.path)
        names = self.waiting()
        names = names[:-(-len(names) * round(share * 1000) // 1000)]
        for n in names:
            if not fs.rename(at(f"{self.staged}/{n}"), at(f"{self.path}/{n}")):
                raise OSError(f"{n} could not be moved into {self.path}")
        return len(names)


# --- state ---------------------------------------------------------------------

_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB (off the heap, on the
    executors' disks) and upload the changes of each batch instead of the state."""
    old = {k: spark.conf.get(k, None) for k in _ROCKSDB}
    for k, v in _ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_table(spark: SparkSession, checkpoint: str, keys, values) -> DataFrame:
    """State of a grouped aggregate as of its last committed batch: the group
    keys and the aggregates' buffers, in their order, under the given names.
    Read by as many tasks as the query has state partitions."""
    s = spark.read.format("statestore").load(checkpoint)
    return s.select("key.*", "value.*").toDF(*keys, *values)


# --- progress --------------------------------------------------------------------

PROGRESS = ("query string, run string, batch long, rows_in long, rows_per_sec double, "
            "metric string, value long")


class ProgressLog(StreamingQueryListener):
    """Writes each micro-batch of the queries started after it as JSON lines, one
    file for ``every`` batches; the driver holds no more than that.

    With ``df.observe(name, ...)`` in a query each whole-number metric becomes a
    row of its own beside the row of the batch (``metric`` is null there).
    """

    def __init__(self, spark: SparkSession, every: int = 50):
        self.spark, self.every = spark, every
        self.path = scratch_path(spark, "progress")
        self._lines: list[str] = []
        self._batches = self._files = 0
        self._lock = threading.Lock()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"query": str(p.id), "run": str(p.runId), "batch": p.batchId, "rows_in": p.numInputRows,
               "rows_per_sec": p.processedRowsPerSecond}
        found = [row]
        for name, values in (p.observedMetrics or {}).items():
            found += [{**row, "metric": f"{name}.{k}", "value": v} for k, v in values.asDict().items()
                      if isinstance(v, int)]
        with self._lock:
            self._lines += [json.dumps(x) for x in found]
            self._batches += 1
            if self._batches % self.every == 0:
                self._flush()

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._flush()

    def _flush(self) -> None:
        if self._lines:
            fs, at = _folder(self.spark, self.path)
            out = fs.create(at(f"{self.path}/part-{self._files:05d}.json"), True)
            try:
                out.write(bytearray("\n".join(self._lines) + "\n", "utf-8"))
            finally:
                out.close()
            self._files += 1
            self._lines = []

    def close(self) -> None:
        """Wait for the events on their way, write what is held, stop listening."""
        self.spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
        with self._lock:
            self._flush()

    def table(self) -> DataFrame:
        """All rows written so far."""
        return self.spark.read.schema(PROGRESS).json(self.path)


def summarise(progress: DataFrame) -> DataFrame:
    """One row: micro-batches with input, rows that they read, and the sum of each
    observed metric as a map.  A batch that a restart ran again counts once, as
    it ran last."""
    last = (progress.groupBy("query", "batch", "metric")
            .agg(F.max_by(F.struct("rows_in", "value"), "run").alias("r")))
    batches = (last.where("metric IS NULL AND r.rows_in > 0")
               .agg(F.count("*").alias("batches"), F.coalesce(F.sum("r.rows_in"), F.lit(0)).alias("rows_in")))
    sums = last.where("metric IS NOT NULL").groupBy("metric").agg(F.sum("r.value").alias("value"))
    metrics = sums.agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("metrics"))
    return batches.crossJoin(metrics)          # one row each


# --- malformed rows ----------------------------------------------------------------

def read_stream_with_rejects(spark: SparkSession, path: str, schema: StructType = schemas.STREAM,
                             max_files_per_trigger: int = 1) -> DataFrame:
    """The CSV file stream with the text of a malformed row in ``REJECTED``."""
    wide = StructType([*schema.fields, StructField(REJECTED, StringType(), True)])
    r = (spark.readStream.format("csv").schema(wide).option("header", "true")
         .option("columnNameOfCorruptRecord", REJECTED)
         .option("maxFilesPerTrigger", max_files_per_trigger))
    return r.load(path)


def stage_raw(df: DataFrame, path: str, rows_per_file: int, spoil=None, spec: Spec = DEFAULT,
              compression: str = "none") -> str:
    """Stream files with all rows, nulls included; where ``spoil`` holds, the score
    is no number."""
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType.simpleString())
            .cast("string").alias(f.name) for f in schemas.STREAM.fields]
    if spoil is not None:
        cols = [F.when(spoil, F.lit("n/a")).otherwise(c).alias(spec.score) if n == spec.score else c
                for c, n in zip(cols, schemas.STREAM.names)]
    return stage_csv(df.select(*cols), path, rows_per_file, compression)


def to_good_and_rejects(df: DataFrame, path: str, checkpoint: str, trigger=None,
                        spec: Spec = DEFAULT) -> StreamingQuery:
    """Sink of a stream read with rejects: good rows (those with a score) and the
    text of malformed rows, apart (``_bad``), in a folder per batch, which a replay
    writes again.  Each batch is read and written once.  Metrics (``feed.*``): rows
    read, rejected, without a score."""
    fields = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in df.columns]))
    bad = F.when(fields >= 0, F.col(REJECTED).isNotNull())     # all fields are read: a row is judged by them
    null = F.col(spec.score).isNull()
    watched = (df.withColumn("_bad", bad)
               .observe("feed", F.count(F.lit(1)).alias("rows_read"), F.count_if("_bad").alias("rejected"),
                        F.count_if(~F.col("_bad") & null).alias("null_score")))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.where(F.col("_bad") | ~null).write.mode("overwrite").partitionBy("_bad")
         .parquet(f"{path}/batch_id={batch_id}"))

    w = watched.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def read_good_and_rejects(spark: SparkSession, path: str,
                          schema: StructType = schemas.STREAM) -> tuple[DataFrame, DataFrame]:
    """(good rows, text of malformed rows) of that sink."""
    wide = StructType([*schema.fields, StructField(REJECTED, StringType(), True),
                       StructField("_bad", BooleanType(), True), StructField("batch_id", LongType(), True)])
    rows = spark.read.schema(wide).parquet(path)
    return rows.where(~F.col("_bad")).select(*schema.names), rows.where("_bad").select(REJECTED)
