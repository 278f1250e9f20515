"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space as every contract here means it.
WHITE_SPACE = "[\\x20\\x09-\\x0D]+"
_ENTRY = 150  # bytes of a remembered word besides its letters and ids


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def total_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts; one row comes back."""
    row = docs.agg(F.sum(F.octet_length(F.col(column))).alias("b")).first()
    return int(row["b"] or 0)


def byte_texts(column: pa.Array) -> list[bytes]:
    """The texts as bytes, null as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


class Slots:
    """Ids of words, one behind the other in one array, and the slot (start, length) of each word."""

    def __init__(self):
        self.slot: dict[bytes, int] = {}
        self.used = self.held = self.bytes = 0
        self.start, self.length = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)
        self.ids = np.zeros(1 << 14, dtype="<u4")

    def add(self, words: list[bytes], ids: list[np.ndarray]) -> None:
        """Have ``ids`` under ``words``, none of which is known yet."""
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        total, first = int(lengths.sum()), self.used
        self.start = room(self.start, self.used + len(ids))
        self.length = room(self.length, self.used + len(ids))
        self.ids = room(self.ids, self.held + total)
        self.start[first : first + len(ids)] = self.held + np.cumsum(lengths) - lengths
        self.length[first : first + len(ids)] = lengths
        if total:
            self.ids[self.held : self.held + total] = np.concatenate(ids)
        self.slot.update(zip(words, range(first, first + len(ids)), strict=True))
        self.used, self.held = first + len(ids), self.held + total
        self.bytes += sum(map(len, words)) + _ENTRY * len(words) + 4 * total

    def ids_of(self, word: bytes) -> np.ndarray:
        at = self.slot[word]
        return self.ids[self.start[at] : self.start[at] + self.length[at]]


def room(values: np.ndarray, n: int) -> np.ndarray:
    """The array, or a copy of twice the size and more where ``n`` elements do not fit."""
    if n <= len(values):
        return values
    out = np.zeros(max(n, 2 * len(values)), dtype=values.dtype)
    out[: len(values)] = values
    return out


def gathered(ids: np.ndarray, start: np.ndarray, length: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a row of words, and how many belong to each text; ``counts`` says how many words a text has."""
    at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length - start, length)
    ends = np.concatenate([[0], np.cumsum(length)])[np.cumsum(counts)]
    return ids[at], np.diff(np.concatenate([[0], ends]))


def give_back() -> None:
    """Return the memory that Arrow holds for later use; workers live on between tasks, next to those of other stages."""
    pa.default_memory_pool().release_unused()


def small_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts have about ``limit`` bytes, at least one row each."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + int(size) > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)
