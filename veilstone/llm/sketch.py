"""Exact counts of string keys over a whole table, distributed by a 64-bit hash of the key."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FLUSH = 300_000  # distinct keys a task holds before it sends them on


def key_hash(key: str) -> int:
    """Signed 64-bit hash of a key."""
    h = xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def key_counts(df: DataFrame, column: str, make: Callable[[], Callable[[str], Iterable[str]]], expand: Callable[[dict[str, int]], dict[str, int]] | None = None, named: Callable[[str], bool] | None = None) -> DataFrame:
    """(key_hash, n): exact counts of all keys of a column, summed in each task before the shuffle; stays distributed.

    With named, (key_hash, key, n): the key itself where named(key) holds, else null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of, held = make(), Counter()

        def out() -> pa.RecordBatch:
            kept = expand(held) if expand else held
            cols = {"key_hash": pa.array([key_hash(k) for k in kept], pa.int64()), "n": pa.array(list(kept.values()), pa.int64())}
            if named:
                cols["key"] = pa.array([k if named(k) else None for k in kept], pa.string())
            batch = pa.RecordBatch.from_pydict(cols)
            held.clear()
            return batch

        for b in batches:
            for text in b.column(0).to_pylist():
                if text:
                    held.update(keys_of(text))
            if len(held) > FLUSH:
                yield out()
        yield out()

    rows = df.select(column).mapInArrow(run, "key_hash long, n long" + ", key string" * bool(named))
    return rows.groupBy("key_hash", *["key"] * bool(named)).agg(F.sum("n").alias("n"))
