"""Problem 9: filling fixed-capacity containers with documents, sized in tokens.

Bound-certified repacking. Items are hashed into partitions of bounded size and packed by best-fit decreasing.
A lower bound from dual feasible functions certifies a partition whose container count meets it: its containers
are closed. In a partition with a gap the well-filled containers are closed as well, and the documents of the
others move to new, fewer partitions, where best-fit decreasing runs again. The last round has few documents left
and closes everything. Only ids and sizes of open documents are shuffled; no round depends on a driver-side loop over
data.

Documents longer than the capacity are cut into full containers and one rest, which is packed like any item;
no other document is divided. Documents without tokens (null, empty) take no room and get container_id null.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilstone.llm.batches import table
from veilstone.llm.tokenization import encode

CAPACITY = 2048
PART_ITEMS = 20_000  # items a partition holds on average
ROUNDS = 3
SHRINK = 8  # a later round has so many times fewer partitions
WELL_FILLED = 0.995


def dff_bound(sizes: np.ndarray, capacity: int) -> int:
    """Lower bound on the containers for sizes: the volume, and two families of dual feasible functions.

    u_k rounds each size to multiples of 1/k from below unless it is a multiple already (Fekete and Schepers);
    f_t raises sizes above capacity - t to a full container and drops those under t (Martello and Toth's L2).
    """
    if not len(sizes):
        return 0
    sizes = sizes.astype(np.int64)
    best = -(-int(sizes.sum()) // capacity)
    for k in range(2, 13):
        x = (k + 1) * sizes
        exact = x % capacity == 0
        value = np.where(exact, sizes * k, (x // capacity) * capacity)
        best = max(best, -(-int(value.sum()) // (k * capacity)))
    for t in np.unique(sizes[sizes <= capacity // 2]):
        big = sizes > capacity - t
        mid = (sizes >= t) & ~big
        best = max(best, int(big.sum()) + -(-int(sizes[mid].sum()) // capacity))
    return max(best, int((sizes > capacity // 2).sum()))


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container number of each item; ties by position, so the result is determined by the order."""
    order = np.argsort(-sizes, kind="stable")
    free: list[tuple[int, int]] = []  # sorted (room, container)
    out, n = np.empty(len(sizes), dtype=np.int64), 0
    for i in order:
        s = int(sizes[i])
        k = bisect_left(free, (s, -1))
        if k < len(free):
            room, box = free.pop(k)
        else:
            room, box, n = capacity, n, n + 1
        out[i] = box
        if room > s:
            insort(free, (room - s, box))
    return out


def repack(capacity: int, round_no: int, last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tokens", "item_key", "part_no"], ascending=[False, True, True], ignore_index=True)
        open_ = pdf["box"].isna().to_numpy()
        if not open_.any():
            return pdf
        sizes = pdf["tokens"].to_numpy()[open_]
        boxes = best_fit_decreasing(sizes, capacity)
        count = int(boxes.max()) + 1
        fill = np.bincount(boxes, weights=sizes, minlength=count)
        close = np.ones(count, dtype=bool) if last or count == dff_bound(sizes, capacity) else fill >= WELL_FILLED * capacity
        label = f"{round_no}-{int(pdf['part'].iloc[0])}-"
        names = np.array([label + str(b) if c else None for b, c in enumerate(close)], dtype=object)
        pdf.loc[open_, "box"] = names[boxes]
        return pdf

    return run


def pack(items: DataFrame, id_col: str, size_col: str, capacity: int = CAPACITY) -> DataFrame:
    """(id, part_no, tokens, container_id) for a table of distinct ids and sizes.

    part_no is 1 unless the item exceeds the capacity. Null sizes count as 0.
    """
    size = F.coalesce(F.col(size_col).cast("bigint"), F.lit(0))
    parts = F.when(size <= capacity, F.array(size)).otherwise(
        F.concat(F.array_repeat(F.lit(capacity).cast("bigint"), (F.floor((size - 1) / capacity)).cast("int")), F.array((size - 1) % capacity + 1))
    )
    rows = items.select(F.col(id_col), F.posexplode(parts).alias("pos", "tokens")).select(
        id_col,
        (F.col("pos") + 1).alias("part_no"),
        "tokens",
        F.col(id_col).cast("string").alias("item_key"),
    )
    # full containers and empty documents need no packing
    rows = rows.withColumn(
        "box",
        F.when(F.col("tokens") == 0, F.lit("")).when(F.col("tokens") == capacity, F.concat(F.lit("full-"), "item_key", F.lit("-"), F.col("part_no").cast("string"))),
    )
    # ids and sizes are kept on disk before the rounds begin, which would compute them side by side; a round's closed rows
    # are done, its open ones go on
    rows = rows.persist(StorageLevel.DISK_ONLY)
    n_parts = max(1, -(-rows.count() // PART_ITEMS))
    closed, open_ = rows.filter("box IS NOT NULL"), rows.filter("box IS NULL")
    for r in range(ROUNDS):
        fewer = max(1, n_parts // SHRINK**r)
        parted = open_.withColumn("part", F.pmod(F.xxhash64("item_key", "part_no", F.lit(r)), F.lit(fewer)))
        packed = parted.groupBy("part").applyInPandas(repack(capacity, r, r == ROUNDS - 1), parted.schema).drop("part")
        if r < ROUNDS - 1:
            packed = packed.persist(StorageLevel.DISK_ONLY)
            open_ = packed.filter("box IS NULL")
        closed = closed.unionByName(packed.filter("box IS NOT NULL"))
    return closed.select(id_col, "part_no", "tokens", F.when(F.col("box") != "", F.col("box")).alias("container_id"))


def packed_documents(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = encode(docs, "doc_id", "text", count_only=True)
    return pack(sizes, "doc_id", "n_tokens")


def p9_containers(spark, sf_dir: str) -> DataFrame:
    return packed_documents(spark, sf_dir)


def p9_checked(spark, sf_dir: str) -> DataFrame:
    """Per document: whether it lies in a container, and whether all its parts and containers keep to the capacity."""
    packed = packed_documents(spark, sf_dir)
    # containers hold few documents, so their sums spread over all tasks
    over = packed.filter("container_id IS NOT NULL").groupBy("container_id").agg(F.sum("tokens").alias("held"))
    rows = packed.join(over, "container_id", "left")
    n, tokens = F.count("*"), F.coalesce(F.sum("tokens"), F.lit(0))
    return rows.groupBy("doc_id").agg(
        (F.max("container_id").isNotNull()).alias("is_placed"),
        ((F.coalesce(F.max("held"), F.lit(0)) <= CAPACITY) & (n == F.greatest(F.lit(1), F.ceil(tokens / CAPACITY)))).alias("keeps_capacity"),
    )


QUERIES = {"p9_containers": p9_containers, "p9_checked": p9_checked}
ORACLES = {"p9_checked": "SELECT doc_id, coalesce(text, '') <> '' AS is_placed, true AS keeps_capacity FROM documents"}
