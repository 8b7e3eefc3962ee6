"""Shared folders for tables that have to outlive one stage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for local sessions."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="candlewright-")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(checkpoint_root(spark), f"{label}-{uuid.uuid4().hex}")


def materialize_by(df: DataFrame, label: str, by: list[str], order: list[str]) -> DataFrame:
    """Write a table in buckets of ``by``, sorted inside, and go on from there.

    Windows, groups and cogroups on ``by`` then read it without an exchange: there are as many buckets
    as a shuffle has partitions. The entry in the
    session's catalog is only needed until the table has been looked up; the files stay.
    """
    spark, name = df.sparkSession, f"{label}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(n, *by).write.format("parquet").bucketBy(n, *by).sortBy(*by, *order)
    writer.option("path", scratch_path(spark, label)).saveAsTable(name)
    table = spark.table(name)
    table.schema  # noqa: B018  looks the table up
    spark.sql(f"DROP TABLE {name}")
    return table


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and go on from there.

    Cuts the lineage where a result is used several times; a lost executor then costs a reread.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
