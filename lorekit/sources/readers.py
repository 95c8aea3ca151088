"""Logs, snapshots, spools and pools as DataFrames."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorekit.schema import FIELDS, LOOSE, RECORD, as_records, typed


def whole_files(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """source_file (base name), path, content: one row for each file."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(paths, wholetext=True).select(F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def log_files(folder: str) -> list[str]:
    """Text logs of a folder, by name."""
    return _sorted(folder, "*.log")


def run_files(folder: str) -> list[str]:
    """Run logs of a folder: run_*.json if there is any, else every *.json."""
    return _sorted(folder, "run_*.json") or _sorted(folder, "*.json")


def spool_files(folder: str) -> list[str]:
    """Spool files waiting in a folder; none if it doesn't exist."""
    return _sorted(folder, "*.jsonl") if Path(folder).is_dir() else []


def _sorted(folder: str, pattern: str) -> list[str]:
    if not Path(folder).is_dir():
        raise FileNotFoundError(folder)
    return sorted(str(p) for p in Path(folder).glob(pattern))


def batches(files: list[str], size: int = 5) -> list[list[str]]:
    """Files in slices; each slice is merged before the next is read, as it sees the merged pool."""
    size = max(1, size)
    return [files[i : i + size] for i in range(0, len(files), size)]


CORRUPT = T.StructType([*LOOSE.fields, T.StructField("_corrupt_record", T.StringType())])


def read_spool(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Records in the order (ord) of file names and lines, and the count of lines that are no JSON (invalid_lines)."""
    meta = lambda name: F.col(f"_metadata.{name}")
    lines = spark.read.text(paths).select(meta("file_name").alias("file"), meta("file_path").alias("path"), meta("file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    files = lines.select("file", "path").distinct().withColumn("file_idx", F.row_number().over(W.orderBy("file", "path")) - 1)  # a row for each file
    line = F.row_number().over(W.partitionBy("path").orderBy("block", "at"))
    lines = lines.join(files.select("path", "file_idx"), "path").withColumn("ord", F.col("file_idx").cast("long") * (1 << 40) + line)
    lines = lines.where(F.regexp_replace("value", r"\s+", "") != "")
    rows = lines.withColumn("r", F.from_json("value", CORRUPT, {"columnNameOfCorruptRecord": "_corrupt_record"}))
    bad = F.col("r._corrupt_record").isNotNull()
    good = rows.where(~bad).select(typed(F.col("r")).alias("r"), "ord").select(*(F.col(f"r.{f}").alias(f) for f in FIELDS), "ord")
    return good, rows.agg(F.count_if(bad).alias("invalid_lines"))


POOL = T.StructType([T.StructField("key", T.StringType()), *RECORD.fields, T.StructField("pos", T.LongType())])


def _pool_json(content) -> object:
    entry = T.MapType(T.StringType(), LOOSE)
    return F.from_json(content, T.StructType([T.StructField("experiences", entry)]))["experiences"]


def read_pool(spark: SparkSession, path: str) -> DataFrame:
    """key, record fields, pos of a pool file; empty if it is missing, empty or no pool."""
    if not Path(path).is_file():
        return spark.createDataFrame([], POOL)
    rows = spark.read.text(path, wholetext=True)
    rows = rows.select(F.posexplode(F.map_entries(_pool_json(F.col("value")))).alias("pos", "e"))
    rows = rows.select("pos", F.col("e.key").alias("key"), typed(F.col("e.value")).alias("e"))
    return rows.select("key", *(F.col(f"e.{f}").alias(f) for f in FIELDS), F.col("pos").cast("long").alias("pos"))


def read_any_pool(spark: SparkSession, path: str) -> DataFrame:
    """A pool file, or a bare list of records."""
    if isinstance(load_json(path), list):
        rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", T.ArrayType(LOOSE))).alias("pos", "e"))
        rows = rows.select("pos", typed(F.col("e")).alias("e"))
        return rows.select(F.col("e.id").alias("key"), "e.*", F.col("pos").cast("long").alias("pos"))
    return read_pool(spark, path)


def load_json(path: str) -> object:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def valid_pool(path: str) -> bool:
    """Whether each entry of a pool file has id, category, problem and solution."""
    try:
        entries = load_json(path)["experiences"]
    except (OSError, ValueError, KeyError, TypeError):
        return False
    return isinstance(entries, dict) and all(isinstance(e, dict) and {"id", "category", "problem", "solution"} <= e.keys() for e in entries.values())


__all__ = ["as_records", "batches", "log_files", "read_any_pool", "read_pool", "read_spool", "run_files", "spool_files", "valid_pool", "whole_files"]
