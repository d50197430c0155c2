"""Incremental forms: new files once, late rows within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_rows(spark: SparkSession, path: str, schema: str, glob: str = "*.parquet") -> DataFrame:
    """A stream of the rows of new parquet files below a folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", True).parquet(path)


def once_each(stream: DataFrame, key: str, at: str, late: str) -> DataFrame:
    """The first row of each key, remembered as long as rows may be late."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, at: str, by: str, width: str, late: str) -> DataFrame:
    """start, by, n per time window; rows later than `late` are left out."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n")


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Writes what is there now and stops; a later run goes on where this one ended."""
    q = df.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
