"""Row-wise Python over Arrow batches: one generator call per record, one Arrow batch out per batch in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

SENTINEL = r"^\s*\[(OCR FAILED|OCR EMPTY|EMPTY|IMAGE NOT FOUND): [^\]]*\]\s*$"


def schema_of(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def flat_map(df: DataFrame, make: Callable[[], Callable[..., Iterator[tuple]]], ddl: str) -> DataFrame:
    """Apply a generator to every row of df; make() is called once a task and returns it.

    The generator gets the row's columns as arguments and yields output tuples of the schema ddl.
    Runs in Arrow batches, so memory is bound by the batch and not by the partition.
    """
    schema = schema_of(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        step = make()
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            rows = [out for row in zip(*columns) for out in step(*row)]
            arrays = [pa.array(list(c), type=f.type) for c, f in zip(zip(*rows), arrow)] if rows else [pa.array([], type=f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def sample(df: DataFrame, n: int) -> DataFrame:
    """Some n rows of df drawn by their hash: the same at any order and layout of the rows, spread over all of them.

    Small tables are taken whole. Repeats of a row are drawn together, so the columns should tell rows apart.
    """
    total = df.count()  # from the files' footers
    if total <= n:
        return df
    return df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(1 << 30)) < int(n / total * (1 << 30)))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
