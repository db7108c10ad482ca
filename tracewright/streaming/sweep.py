"""A resumable sweep: datasets are routed as their info files arrive, each once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tracewright.operators.report import SUPPORTED
from tracewright.sources import collection


def sweep(spark: SparkSession, root: str, manifest: str, checkpoint: str) -> StreamingQuery:
    """Append a line for every new dataset under ``root`` to ``manifest``; a restart goes on where the last run ended."""
    read = spark.readStream.schema(collection.INFO).option("multiLine", True).json(f"{root}/*/*/meta/info.json")
    rows = read.select(collection.name_of(F.col("_metadata.file_path"), "meta/info[.]json$").alias("dataset"), F.coalesce("codebase_version", F.lit("?")).alias("source_version"))

    def write(batch: DataFrame, number: int) -> None:
        # A batch that was written before the checkpoint could say so comes again under its number.
        try:
            written = spark.read.json(manifest)
            if {"sweep", "sweep_batch"} <= set(written.columns) and not written.filter((F.col("sweep") == checkpoint) & (F.col("sweep_batch") == number)).isEmpty():
                return
        except AnalysisException:  # no manifest yet, or an empty one
            pass
        collection.append_manifest(batch.withColumn("status", F.when(F.col("source_version").isin(*SUPPORTED), "todo").otherwise("unsupported")), manifest, sweep=checkpoint, sweep_batch=number)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
