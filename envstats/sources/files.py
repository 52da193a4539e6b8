"""Batch scans and file sinks (SRC-1..4, SNK-1, SNK-6, PRJ-2).

Readers take a declared schema; inference is an explicit opt-in because it
costs a full extra pass and decides column types from the data.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

from envstats import schemas
from envstats.functions.scalar import nan_to_null
from envstats.operators import quality
from envstats.session import data_version, materialize


REJECTED = "_rejected"   # text of a CSV row that does not fit its declared schema


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             infer: bool = False, header: bool = True, rejects: bool = False) -> DataFrame:
    """CSV scan with header (SRC-1, SRC-2).

    Fields are matched by position, so each file's header is compared with the
    declared names and a file with other or swapped columns fails.  With
    ``rejects`` a row with a malformed field keeps its text in ``REJECTED``
    (null for a good row), so that it can be counted instead of passing for
    missing values.
    """
    r = spark.read.option("header", header)
    if schema is None or infer:
        return r.option("inferSchema", True).csv(path)
    r = r.option("enforceSchema", not header)
    if rejects:
        schema = StructType([*schema.fields, StructField(REJECTED, StringType(), True)])
        r = r.option("columnNameOfCorruptRecord", REJECTED).option("enforceSchema", True)
        if header:
            _check_header(spark, path, schema.names[:-1])
    return r.schema(schema).csv(path)


def _is_header(names):
    """Whether a line is the header; only lines with the first name are cleaned and
    compared, for two regular expressions a line cost as much as reading it."""
    line = F.regexp_replace(F.regexp_replace("value", "\ufeff", ""), r'"|\r$', "")
    return F.when(F.col("value").contains(names[0]), line == F.lit(",".join(names))).otherwise(False)


def _check_header(spark: SparkSession, path: str, names) -> None:
    """Fail unless each file that has lines has the declared names, in their
    order, as a line (the reader itself cannot compare them beside a column for
    rejected rows).  A distributed scan of the lines, one partial row per task
    and file."""
    files = (spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file"))
             .agg(F.max(_is_header(names)).alias("has")))
    wrong = [r["file"] for r in files.where(~F.col("has")).limit(5).collect()]
    if wrong:
        raise ValueError(f"header is not {list(names)} in {wrong}")


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows' text) of a ``read_csv(..., rejects=True)`` scan."""
    # a row is judged by the fields that are read: refer to all of them
    fields = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in df.columns]))
    bad = F.when(fields >= 0, F.col(REJECTED).isNotNull())
    return df.where(~bad).drop(REJECTED), df.where(bad).select(REJECTED)


def read_observations(spark: SparkSession, path: str, fmt: str = "csv",
                      schema: StructType = schemas.OBS, not_null=(),
                      rejects: bool = False) -> DataFrame:
    """Observation table with NaN turned into null in every double column.

    Rows without one of the ``not_null`` columns are dropped by a filter on the
    raw columns, below the NaN rewriting, so that it reaches the scan."""
    df = (read_csv(spark, path, schema, rejects=rejects) if fmt == "csv"
          else spark.read.schema(schema).parquet(path))
    return normalize_nan(quality.drop_null(df, list(not_null)))


def read_dimension(spark: SparkSession, path: str, schema: StructType,
                   fmt: str = "csv") -> DataFrame:
    """Static attribute / geocode table (SRC-2, SRC-3 re-aimed: no pandas).

    A missing path fails here, at definition time, instead of later (T11).
    """
    if fmt == "csv":
        return read_csv(spark, path, schema)
    return spark.read.schema(schema).format(fmt).load(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan, e.g. of a stream's durable output (SRC-4)."""
    return spark.read.parquet(path)


def normalize_nan(df: DataFrame) -> DataFrame:
    """Every float/double column: NaN -> null (T13)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    if not cols:
        return df
    return df.withColumns({c: nan_to_null(c) for c in cols})


def existing(df: DataFrame, wanted) -> list[str]:
    """Listed columns that exist in ``df``, in list order (PRJ-2)."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def select_existing(df: DataFrame, wanted) -> DataFrame:
    return df.select(*existing(df, wanted))


def stage_csv(df: DataFrame, path: str, rows_per_file: int = 100_000,
              compression: str = "none") -> str:
    """Write ``df`` as header CSV files of at most ``rows_per_file`` rows (SNK-1).

    With ``compression`` ("gzip": a fifth of the bytes) each file is read by one
    task, so files should be as many as the readers' cores.

    The write is distributed: each task writes its own files, so the table
    never passes through the driver.  Column order is the file's field order.
    """
    (df.write.mode("errorifexists")
       .option("header", True)
       .option("maxRecordsPerFile", int(rows_per_file))
       .option("compression", compression)
       .csv(path))
    return path


def _file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path class) of a path."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jvm.org.apache.hadoop.fs.Path


def _manifest(spark: SparkSession, dst: str) -> tuple[int, dict]:
    """(number, content) of the newest manifest: source -> version, folder, earlier folder."""
    fs, at = _file_system(spark, dst)
    names = ([s.getPath().getName() for s in fs.listStatus(at(f"{dst}/_manifests"))]
             if fs.exists(at(f"{dst}/_manifests")) else [])
    number = max((int(n[:-5]) for n in names if n[:-5].isdigit() and n.endswith(".json")), default=0)
    if not number:
        return 0, {}
    rows = spark.read.option("wholetext", True).text(f"{dst}/_manifests/{number}.json").collect()
    return number, json.loads(rows[0][0])


def _commit(spark: SparkSession, dst: str, number: int, content: dict) -> None:
    """Write manifest ``number``; fails if another writer has taken the number."""
    fs, at = _file_system(spark, dst)
    out = fs.create(at(f"{dst}/_manifests/{number}.json"), False)     # no overwriting
    try:
        out.write(bytearray(json.dumps(content, sort_keys=True), "utf-8"))
    finally:
        out.close()


def publish_parquet(spark: SparkSession, src: str, dst: str, partition_by=None,
                    source: str | None = None) -> DataFrame:
    """Publish a finished parquet table at ``dst`` (SNK-6); returns all that is
    published there.

    ``dst`` holds a folder of files per published version and numbered manifests
    that say which folder belongs to which source and version of its files
    (paths, sizes, times).  Publishing a version again changes nothing; a
    changed source replaces its earlier version, whose folder stays until the
    next change, for readers that have it open; sources (``source``, the path
    unless given) do not touch each other.  A publish that dies before its
    manifest leaves a folder that no reader sees.

    Goes through Spark so that only data files move; a stream sink's
    ``_spark_metadata`` log, which records the source paths, is not copied.
    """
    df = spark.read.parquet(src)
    source = source or src.rstrip("/")
    version = hashlib.sha256(repr(data_version(df)).encode()).hexdigest()
    number, content = _manifest(spark, dst)
    now = content.get(source)
    if now is None or now["version"] != version:
        folder = f"files/{uuid.uuid4().hex}"
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{dst}/{folder}")
        earlier = now and now.get("earlier")
        content[source] = {"version": version, "folder": folder, "earlier": now and now["folder"]}
        _commit(spark, dst, number + 1, content)
        if earlier:
            fs, at = _file_system(spark, dst)
            fs.delete(at(f"{dst}/{earlier}"), True)
    return read_published(spark, dst)


def read_published(spark: SparkSession, dst: str) -> DataFrame:
    """The current versions of all sources published at ``dst``."""
    _, content = _manifest(spark, dst)
    folders = [f"{dst}/{c['folder']}" for _, c in sorted(content.items())]
    first, *rest = [spark.read.parquet(f) for f in folders]      # one folder per source
    for more in rest:
        first = first.unionByName(more, allowMissingColumns=True)
    return first


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows (ACT-1) as a DataFrame."""
    return df.limit(n)


def schema_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Schema dump (ACT-2) as rows (column, type, nullable)."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column string, type string, nullable boolean")


def as_date(df: DataFrame, c: str = "date", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Date text -> date column, malformed -> null (SCL-1)."""
    from envstats.functions.scalar import parse_date
    if dict(df.dtypes).get(c) == "date":
        return df
    return df.withColumn(c, parse_date(c, fmt))


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("F", "annotations")]
