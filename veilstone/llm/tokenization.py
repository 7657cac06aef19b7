"""Problem 8: encoding of the corpus with a public byte-level BPE tokenizer.

Words are cut by the tokenizer's published pattern. Words a task hasn't met yet are put into padded numpy
matrices by length bucket; every round each row merges its leftmost pair of minimum rank, found by a hashed
pair lookup, and is compacted. Rows without a mergeable pair leave the matrix.

Null, empty: an empty list. Special tokens are never produced: their strings are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilstone.llm.batches import flat_map, table

TOKENIZER_DIR = "/opt/tokenizers"
# Fixed value: the pre-tokenisation pattern published with the byte-level BPE vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG = 1024  # bytes of a word from which it is merged by itself: a row's rounds and cells both grow with its length
CACHE_WORDS = 400_000  # distinct words a task remembers before it starts over: bounds the worker's memory


def load_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class MatrixBpe:
    """Byte-level BPE by padded matrices."""

    def __init__(self, ranks_file: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = rank
        # open-addressed hash table: slots hold the pair key and the rank of the pair's union
        bits = max(4, int(np.ceil(np.log2(len(pairs) + 1))) + 2)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.rank = np.zeros(1 << bits, dtype=np.int64)
        keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
        vals = np.fromiter(pairs.values(), dtype=np.int64, count=len(pairs))
        at = self._slot(keys)
        self.probes = 0
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]
            placed = self.keys[at] == keys
            self.rank[at[placed]] = vals[placed]
            keys, vals, at = keys[~placed], vals[~placed], (at[~placed] + 1) & self.mask
            self.probes += 1
        self.none = np.int64(1 << 40)
        self.cut = regex.compile(PATTERN)
        self.cache: dict[str, list[int]] = {}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the union of each pair, a number above all ranks where there is none."""
        key = (left << 20) | right
        key[(left < 0) | (right < 0)] = -2
        at = self._slot(key)
        out = np.full(key.shape, self.none)
        open_ = np.ones(key.shape, dtype=bool)
        for _ in range(self.probes):
            found = self.keys[at]
            hit = open_ & (found == key)
            out[hit] = self.rank[at[hit]]
            open_ &= ~hit & (found != -1)
            if not open_.any():
                break
            at = (at + 1) & self.mask
        return out

    def merge_bucket(self, words: list[bytes]) -> list[list[int]]:
        width = max(map(len, words))
        m = np.full((len(words), width), -1, dtype=np.int64)
        for i, w in enumerate(words):
            m[i, : len(w)] = self.byte_id[np.frombuffer(w, dtype=np.uint8)]
        out: list[list[int]] = [[] for _ in words]
        rows = np.arange(len(words))
        ranks = self.pair_rank(m[:, :-1], m[:, 1:]) if width > 1 else np.full((len(words), 0), self.none)
        while len(rows):
            if m.shape[1] > 1:
                at = ranks.argmin(axis=1)  # the leftmost minimum
                live = ranks[np.arange(len(rows)), at] < self.none
            else:
                live = np.zeros(len(rows), dtype=bool)
            if not live.all():
                for i in np.flatnonzero(~live):
                    out[rows[i]] = m[i][m[i] >= 0].tolist()
                m, rows, ranks = m[live], rows[live], ranks[live]
                if not len(rows):
                    break
                at = at[live]
            k = np.arange(len(rows))
            m[k, at] = ranks[k, at]  # a token's id is its rank
            keep = np.ones(m.shape, dtype=bool)
            keep[k, at + 1] = False
            m = m[keep].reshape(len(rows), -1)
            # only the two pairs beside the merged token change
            keep = np.ones(ranks.shape, dtype=bool)
            keep[k, at] = False
            ranks = ranks[keep].reshape(len(rows), -1)
            if ranks.shape[1]:
                left = np.flatnonzero(at > 0)
                ranks[left, at[left] - 1] = self.pair_rank(m[left, at[left] - 1], m[left, at[left]])
                right = np.flatnonzero(at < ranks.shape[1])
                ranks[right, at[right]] = self.pair_rank(m[right, at[right]], m[right, at[right] + 1])
        return out

    def merge_long(self, word: bytes) -> list[int]:
        """As merge_bucket() of one word, by a heap of pairs: the time grows little faster than the word."""
        ids = self.byte_id[np.frombuffer(word, dtype=np.uint8)]
        ranks = self.pair_rank(ids[:-1], ids[1:])
        none = int(self.none)
        heap = [(r, i) for i, r in enumerate(ranks.tolist()) if r < none]
        heapq.heapify(heap)
        tokens, n = ids.tolist(), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if tokens[i] < 0 or j >= n or self.rank_of(tokens[i], tokens[j]) != rank:
                continue  # one of the pair has been merged since
            tokens[i], tokens[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := self.rank_of(rank, tokens[k])) < none:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := self.rank_of(tokens[h], rank)) < none:
                heapq.heappush(heap, (r, h))
        return [t for t in tokens if t >= 0]

    def rank_of(self, left: int, right: int) -> int:
        """pair_rank() of one pair."""
        key = left << 20 | right
        at = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
        for _ in range(self.probes):
            found = self.keys[at]
            if found == key:
                return int(self.rank[at])
            if found == -1:
                break
            at = (at + 1) & self.mask
        return int(self.none)

    def learn(self, words: set[str]) -> None:
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for w in words:
            b = w.encode("utf-8", "surrogatepass")
            if len(b) > LONG:
                self.cache[w] = self.merge_long(b)
                continue
            buckets.setdefault(max(1, len(b) - 1).bit_length(), []).append((w, b))
        for bits, group in buckets.items():
            step = max(1, (1 << 20) >> bits)  # a million cells a matrix at most
            for i in range(0, len(group), step):
                part = group[i : i + step]
                for (w, _), ids in zip(part, self.merge_bucket([b for _, b in part])):
                    self.cache[w] = ids

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        cut = [self.cut.findall(t) if t else [] for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        new = {w for words in cut for w in words if w not in self.cache}
        if new:
            self.learn(new)
        cache = self.cache
        return [[i for w in words for i in cache[w]] for words in cut]


_loaded: dict[int, MatrixBpe] = {}


def worker_bpe(ranks_file: bytes) -> MatrixBpe:
    key = hash(ranks_file)
    if key not in _loaded:
        _loaded[key] = MatrixBpe(ranks_file)
    return _loaded[key]


def encode(df: DataFrame, id_col: str, text_col: str, path: str = f"{TOKENIZER_DIR}/byte_bpe_50k.tiktoken", count_only: bool = False) -> DataFrame:
    """(id, ids array<int>) of every row, or (id, n_tokens) with count_only.

    Nulls and empty texts give [] (0). The vocabulary file (under 1 MB) is read on the driver and broadcast,
    so executors need no copy of it. Repeated rows give repeated results; other columns are ignored.
    """
    import pyarrow as pa

    shared = df.sparkSession.sparkContext.broadcast(load_ranks(path))
    kind = df.schema[id_col].dataType.simpleString()
    out = "n_tokens int" if count_only else "ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_bpe(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i in range(0, max(1, len(texts)), 1000):
                ids = bpe.encode_batch(texts[i : i + 1000])
                part = pa.array([len(x) for x in ids], pa.int32()) if count_only else pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1000), part], names=[id_col, out.split()[0]])

    return df.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, {out}")


def p8_ids(spark, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), "doc_id", "text")


def decode(df: DataFrame, id_col: str, ids_col: str, path: str = f"{TOKENIZER_DIR}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(id, content binary): the bytes that the ids stand for."""
    shared = df.sparkSession.sparkContext.broadcast(load_ranks(path))
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        tokens = {int(b): base64.b64decode(a) for a, b in (line.split() for line in shared.value.splitlines() if line)}
        return lambda key, ids: iter([(key, b"".join(tokens[i] for i in ids))])

    return flat_map(df.select(id_col, ids_col), make, f"{id_col} {kind}, content binary")


def p8_rejoined(spark, sf_dir: str) -> DataFrame:
    """Round trip: the MD5 of each document decoded from its ids."""
    return decode(p8_ids(spark, sf_dir), "doc_id", "ids").select("doc_id", F.md5("content").alias("text_md5"))


QUERIES = {"p8_ids": p8_ids, "p8_rejoined": p8_rejoined}
ORACLES = {"p8_rejoined": "SELECT doc_id, md5(coalesce(text, '')) AS text_md5 FROM documents"}
