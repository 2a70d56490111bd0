"""Review sources: CSV, Parquet, catalog tables and the generator."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revaudit.operators.generate import generate_reviews
from revaudit.schema import CLEAN_TYPES
from revaudit.sources.splitcsv import read_split_csv
from revaudit.sources.writers import write_csv

# The cell texts pandas reads as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


# Fixed value: where the local source keeps its reviews unless told otherwise.
LOCAL_PATH = "data/raw/synthetic_reviews.csv"


def _typed(name: str, kind: T.DataType) -> Column:
    cell = F.when(~F.col(name).isin(*NA_TOKENS), F.col(name))
    if isinstance(kind, T.IntegralType):
        # A whole-number column that once held nulls is written with a decimal point.
        cell = F.regexp_replace(cell, r"\.0+$", "")
    return cell.cast(kind).alias(name)


def read_reviews_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, T.DataType] = CLEAN_TYPES,
    multi_line: bool = True,
    split: bool = False,
) -> DataFrame:
    """Read a CSV with a header; columns without a known type stay strings.

    Quoted cells may span lines, which keeps Spark from splitting a file. For large files pass
    ``split=True``, which finds record borders by counting quotes and reads blocks in parallel,
    or ``multi_line=False`` if no text has a line break.
    """
    if split:
        raw = read_split_csv(spark, path)
    else:
        raw = spark.read.csv(
            path, header=True, inferSchema=False, multiLine=multi_line, quote='"', escape='"'
        )
    return raw.select(*[_typed(name, types.get(name, T.StringType())) for name in raw.columns])


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether the path holds a whole source: a file, or a folder whose writer has finished.

    Spark's writers end with a ``_SUCCESS`` file, so a folder with part files but without it was
    left by a job that was stopped.
    """
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target):
        return False
    if files.getFileStatus(target).isFile():
        return True
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, "_SUCCESS")
    return files.exists(done)


def _local_path(spark: SparkSession) -> str:
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("name a path all executors can reach; the default is a local folder")
    return LOCAL_PATH


def load_reviews(
    spark: SparkSession, source: str = "local", path: str | None = None, **options
) -> DataFrame:
    """Reviews from a named source.

    ``local`` reads a CSV and, if there is none or it is half-written, first writes 5,000
    synthetic reviews to it. ``csv`` raises on a half-written folder.
    """
    if source == "local":
        path = path or _local_path(spark)
        if not _complete(spark, path):
            write_csv(generate_reviews(spark, **options), path)
        return read_reviews_csv(spark, path)
    if source == "csv":
        if not any(sign in path for sign in "*?[{") and not _complete(spark, path):
            raise ValueError(f"{path} is missing or was left half-written: it has no _SUCCESS")
        return read_reviews_csv(spark, path, **options)
    if source == "parquet":
        return spark.read.parquet(path)
    if source == "table":
        return spark.table(path)
    if source == "synthetic":
        return generate_reviews(spark, **options)
    raise ValueError(f"Unknown source: {source}")
