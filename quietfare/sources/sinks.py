"""Sinks: Parquet and CSV tables by the executors, small JSON and text files by the driver."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, order: list[str | Column] | None = None) -> None:
    """CSV with a header in one file, in the order of the named columns (or descending expressions); meant for released aggregates, which are small.

    What is before it keeps its own parallelism: only the finished rows go to one task.
    """
    out = df.repartition(1)
    (out.sortWithinPartitions(*order) if order else out).write.mode("overwrite").csv(path, header=True)


def write_tables(tables: dict[str, DataFrame], folder: str | Path) -> dict[str, tuple[str, int]]:
    """Tidy tables as ``<folder>/<name>.csv`` each, and a manifest of name -> (path, rows), which is also written there."""
    manifest = {}
    for name, df in tables.items():
        path = str(Path(folder) / f"{name}.csv")
        flat = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes])
        write_csv(flat, path)
        manifest[name] = (path, df.sparkSession.read.csv(path, header=True, schema=flat.schema).count())
    write_json({k: {"path": p, "rows": n} for k, (p, n) in manifest.items()}, Path(folder) / "manifest.json")
    return manifest


def write_json(record: dict, path: str | Path) -> None:
    """Pretty JSON with sorted keys, replaced as a whole."""
    write_text(json.dumps(record, indent=2, sort_keys=True, default=str) + "\n", path)


def write_text(text: str, path: str | Path) -> None:
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(target.name + ".part")
    part.write_text(text, encoding="utf-8")
    os.replace(part, target)
