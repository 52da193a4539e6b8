"""Helpers shared by the corpus operators.

Columns are picked by position, so a table may carry extra columns whose
names clash with the wanted ones (in another letter case, or equal to a
column that an operator adds).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envstats.session import scratch_path


BATCH_ROWS, BATCH_BYTES = 1_000, 16 << 20   # of one Arrow batch sent to a Python worker


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch limits to BATCH_ROWS and BATCH_BYTES.

    Spark's default of 10,000 rows is a gigabyte of long texts per batch, on
    both sides of the pipe; results do not depend on it.  Lower settings stay.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of a data folder, whole."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def position(df: DataFrame, name: str) -> int:
    """Index of a column: the exact name, else its only match in any case."""
    if name in df.columns:
        return df.columns.index(name)
    alike = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if len(alike) != 1:
        raise ValueError(f"no single column {name!r} among {df.columns}")
    return alike[0]


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``pick(df, key="doc_id")``: the named columns under new names, nothing else."""
    bound_batches(df.sparkSession)
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_c{position(df, old)}").alias(new)
                          for new, old in columns.items()])


def through_python(rows: DataFrame, run, schema: str) -> DataFrame:
    """``mapInPandas`` over rows with a ``key``: the key travels as text, so that
    nulls beside large integers stay exact; ``schema`` names the other columns."""
    kind = rows.schema["key"].dataType
    out = rows.withColumn("key", F.col("key").cast("string")).mapInPandas(
        run, f"key string, {schema}")
    return out.withColumn("key", F.col("key").cast(kind))


def hash_sample(df: DataFrame, most: int, *columns: str) -> DataFrame:
    """About ``most`` rows of a written table (all, if it has no more), by a hash
    of ``columns``: the filter runs in the scan, so only the sample moves."""
    n = df.count()
    if n <= most:
        return df
    part = F.pmod(F.xxhash64(*columns), F.lit(2**32))
    return df.where(part < F.lit(int(2**32 * most / n)))


def keep_where(df: DataFrame, condition, **columns: str) -> DataFrame:
    """Rows of ``df`` where ``condition(**Columns)`` holds; all columns unchanged."""
    bound_batches(df.sparkSession)
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    at: dict[str, Column] = {k: F.col(f"_c{position(df, c)}") for k, c in columns.items()}
    return plain.where(condition(**at)).toDF(*df.columns)


def replace_column(df: DataFrame, name: str, value) -> DataFrame:
    """``df`` with one column replaced by ``value(its Column)``, order and names kept."""
    bound_batches(df.sparkSession)
    i = position(df, name)
    plain = df.toDF(*[f"_c{j}" for j in range(len(df.columns))])
    return plain.select(*[value(F.col(c)).alias(c) if j == i else F.col(c)
                          for j, c in enumerate(plain.columns)]).toDF(*df.columns)


def text_of(column: Column) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(column.cast("string"), F.lit(""))


_HELD: list[list[str]] = []      # paths written inside each open ``passing``
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write a frame once into the cluster's shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    writer = df.write.mode("overwrite")
    (writer.option("compression", codec) if codec else writer).parquet(path)
    for held in _HELD[-1:]:
        held.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Inside, exchange files go with the write that made them; at the end, so do
    the frames written inside but the last, which must not be read lazily after."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    _HELD.append([])
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        paths = _HELD.pop()
        for held in _HELD[-1:]:
            held.extend(paths[-1:])
        for path in paths[:-1]:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)
