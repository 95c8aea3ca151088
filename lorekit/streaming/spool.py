"""A spool folder as a stream: each micro-batch of files is merged, then its files are moved."""

from __future__ import annotations

from pathlib import Path
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lorekit.plans.pipeline import LessonPipeline
from lorekit.schema import FIELDS, typed
from lorekit.sources import sinks
from lorekit.sources.readers import CORRUPT


def records(spark: SparkSession, folder: str, files_per_batch: int = 5) -> DataFrame:
    """Spool lines as they arrive: record fields, path and line text."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", "*.jsonl").text(folder)
    rows = lines.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", CORRUPT, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    return rows.where(F.col("r").isNotNull() & F.col("r._corrupt_record").isNull()).select("path", typed(F.col("r")).alias("r")).select("path", *(F.col(f"r.{f}").alias(f) for f in FIELDS))


def start(pipeline: LessonPipeline, folder: str, checkpoint: str, files_per_batch: int = 5) -> StreamingQuery:
    """Merge all waiting files and stop. A file is moved only after its records are in the pool; a crash in between
    merges it again, which upserts the same ids."""

    def one(batch: DataFrame, _: int) -> None:
        rows = batch.withColumn("ord", F.monotonically_increasing_id()).persist()
        try:
            files = sorted(r.path for r in rows.select("path").distinct().collect())  # files_per_batch at most
            if files:
                pipeline.merge(rows.drop("path"))
                sinks.archive([p for f in files if Path(p := unquote(urlparse(f).path)).exists()])
        finally:
            rows.unpersist()

    stream = records(pipeline.spark, folder, files_per_batch).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()
