"""Session helpers: one builder for tests and benches, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with UTC, AQE and Arrow. On a cluster the caller's own session is used instead."""
    builder = (
        SparkSession.builder.master(master or f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .appName("quietfare")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUIETFARE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or os.environ.get("BENCH_CPUS", "8")))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint.

    The folder is the one the cluster names in ``spark.checkpoint.dir`` (shared
    by all executors, so the data outlives any of them). Only a local session
    without that setting, as in tests, gets a temporary folder of its own; on a
    cluster such a folder would be the driver's alone, so it is an error there.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="quietfare-"))
    return df.checkpoint(eager=True)


#: Up to so many bytes a core a scan counts as small: its splits may outnumber its row groups, which are what tasks read.
SMALL_SCAN = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores, for costly work per row.

    A small table often is one file of one row group, which a single task would
    read and work on. Only a scan that is small, by the size of its files or by
    its number of partitions, is shuffled; larger tables and
    plans with a shuffle of their own stay as they are.
    """
    execution = df._jdf.queryExecution()
    if "Exchange" in execution.executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    leaves = execution.optimizedPlan().collectLeaves()
    size = sum(leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size()))
    return df.repartition(cores) if size < cores * SMALL_SCAN or execution.toRdd().getNumPartitions() < cores else df
