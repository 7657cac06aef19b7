"""The scan on a stream: stateless expressions, so a stream of records is tagged and masked as it arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veilstone.functions import pii
from veilstone.functions.text import language


def read_stream(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def tagged(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """A batch or stream with language, detected, masked and not_detected added."""
    h = F.col("_hits")
    out = texts.withColumn("_hits", pii.regex_hits(F.col(text_col))).withColumn("language", language(F.col(text_col)))
    return out.select(*texts.columns, "language", pii.detected_text(h).alias("detected"), pii.masked_text(h).alias("masked"), pii.not_detected_text(h).alias("not_detected"))


def write_stream(df: DataFrame, folder: str, checkpoint: str):
    """Append to parquet until the input at hand is done; call again to go on where it stopped."""
    return df.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder)
