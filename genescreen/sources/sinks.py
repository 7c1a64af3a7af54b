"""Sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share: spark.checkpoint.dir, or where it is unset a folder of the warehouse.

    On a cluster a warehouse that is a folder of each machine is refused; a local master has one machine, whose folders are shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/genescreen-intermediate"
        master = spark.sparkContext.master
        if root.startswith(("file:", "/")) and not (master.startswith("local") and not master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write rows as a Parquet table in the shared folder and read them again, so that what uses them several times computes them once."""
    path = scratch_path(df.sparkSession, "table")
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_lines(df: DataFrame, path: str) -> str:
    """Write the column `value`, one line a row."""
    df.select("value").write.text(path)
    return path


def write_fasta(df: DataFrame, path: str, width: int = 60) -> str:
    """Write header and seq as FASTA with sequence lines of `width`."""
    wrapped = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    return write_lines(df.select(F.concat(F.lit(">"), "header", F.lit("\n"), wrapped).alias("value")), path)


def write_report(df: DataFrame, path: str) -> str:
    """Write a tab-separated table with a header; doubles with four decimals."""
    columns = [F.format_string("%.4f", c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    df.select(*columns).write.csv(path, sep="\t", header=True)
    return path


def write_id_list(df: DataFrame, path: str, column: str = "tid") -> str:
    """Write distinct ids in order."""
    return write_lines(df.select(F.col(column).alias("value")).distinct().orderBy("value"), path)
