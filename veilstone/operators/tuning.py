"""Physical choices that don't change results."""

from __future__ import annotations

from pyspark.sql import DataFrame

SMALL = 64 << 20  # bytes of an input that few row groups may hold


def spread(df: DataFrame, small: int = SMALL) -> DataFrame:
    """df over all cores, if it is so small that it may sit in fewer row groups than there are cores.

    Work that costs far more than a shuffle of its input (patterns over whole texts) goes after this. Larger inputs
    have splits enough and stay as they are; the size is the planner's estimate, no data is read.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if int(str(size)) < small else df


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """df partitioned by keys into a fixed number of partitions, for a join on them with costly work after it.

    It is the exchange that the join needs anyway. Left to itself the planner merges small partitions by their bytes and
    may stream a few of them against a broadcast side, whatever is done with the joined rows then.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)
