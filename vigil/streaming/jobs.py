"""Streaming jobs.

* ``scoring_stream`` — files landing in a folder are scored by a saved
  ``PipelineModel`` (the same JVM stages as batch scoring);
* ``daily_error_counts`` — a tumbling 1-day window of failed observations with a
  watermark, so late rows within the allowed delay still count and state for
  closed days is dropped.

Checkpoints go under the shared checkpoint folder named by the session.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators.model import PREDICTION
from vigil.session import checkpoint_dir


def scoring_stream(spark: SparkSession, model: PipelineModel, source_dir: str, schema: T.StructType,
                   key: str, max_files_per_trigger: int = 100) -> DataFrame:
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(source_dir))
    return model.transform(src).select(key, PREDICTION)


def daily_error_counts(stream: DataFrame, ts: str, is_error, delay: str = "1 day") -> DataFrame:
    """(window_start, n_observations, n_errors) per 1-day window of ``ts``, append mode after the watermark."""
    flag = is_error if not isinstance(is_error, str) else F.col(is_error)
    return (stream.withWatermark(ts, delay)
                  .groupBy(F.window(F.col(ts), "1 day").alias("w"))
                  .agg(F.count(F.lit(1)).alias("n_observations"), F.count_if(flag).alias("n_errors"))
                  .select(F.col("w.start").alias("window_start"), "n_observations", "n_errors"))


def run_available(sdf: DataFrame, name: str, output_dir: str, mode: str = "append") -> None:
    """Process everything available now into parquet at ``output_dir`` and stop (exactly-once file sink)."""
    ckpt = f"{checkpoint_dir(sdf.sparkSession).rstrip('/')}/stream-{name}"
    q = (sdf.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start(output_dir))
    q.awaitTermination()
