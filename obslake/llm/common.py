"""Small helpers that the operators of this package share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# the white space that parts words: space, tab, line feed, vertical tab, form feed, return
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which driver and executors share.

    A session without that setting gets a folder of its own where all runs on one machine (tests); on
    a cluster it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends there, so a lost
    executor costs no more than the files that it was reading."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Words of a text, in order; null or blank: none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 200) -> None:
    """Rows handed to Python at once; long texts would else fill a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def read_file(spark: SparkSession, path: str) -> bytes:
    """A small file, read by Spark, so its path may be in any store; a bare path is local."""
    url = path if "://" in path else f"file://{path}"
    return bytes(spark.read.format("binaryFile").load(url).select("content").first()[0])
