"""Scans: Parquet, CSV, JSON, JSON lines, files; each with its schema given, not guessed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_trips(spark: SparkSession, path: str, license_number: str | None = None) -> DataFrame:
    """Trip records, optionally of one licence; the filter reaches the Parquet scan."""
    df = spark.read.parquet(path)
    return df.where(F.col("hvfhs_license_num") == license_number) if license_number else df


def read_zones_csv(spark: SparkSession, path: str) -> DataFrame:
    """The zone dimension from CSV. ``N/A`` stays a string; only empty fields are null."""
    return spark.read.csv(path, header=True, schema="LocationID int, Borough string, Zone string, service_zone string", nullValue="")


def read_json_documents(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON documents of several lines each; a glob reads them all, with their file names."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path).withColumn("file", F.col("_metadata.file_name"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``pos``, ``line`` of a text file without blank lines; positions rise in file order."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``bytes``, ``sha256`` of whole files of any size: executors read them in chunks from a file system that all of them mount. Empty files aren't listed."""
    listed = spark.read.format("binaryFile").load(path).select(F.regexp_replace("path", "^file:/+", "/").alias("file"), F.col("length").alias("bytes"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for name in batch.column(0).to_pylist():
                with open(unquote(name), "rb") as source:
                    digests.append(hashlib.file_digest(source, "sha256").hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.string())], names=["file", "bytes", "sha256"])

    return listed.mapInArrow(hashed, "file string, bytes bigint, sha256 string")


def schema_of(df: DataFrame) -> DataFrame:
    """``position``, ``column``, ``type``: the schema as rows."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def row_count(df: DataFrame, where: str | None = None) -> DataFrame:
    """One row, ``n``."""
    return (df.where(where) if where else df).agg(F.count(F.lit(1)).alias("n"))


def query(spark: SparkSession, sql: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    """SQL over the given tables and values: ``{t}`` stands for a table, ``:name`` for a value, and neither is pasted into the text."""
    return spark.sql(sql, args=args, **tables)
