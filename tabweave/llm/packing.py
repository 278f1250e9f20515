"""Packing of tokenized documents into sequences by multiway differencing.

Documents are cut into pieces. Full pieces are sequences by themselves. The rest, in short pieces, is
dealt into blocks of bounded size, and within a block Karmarkar-Karp differencing merges partial
partitions, the largest windows of one with the smallest of the other, until one partition into windows
of nearly equal sums is left. While a window exceeds the capacity the window count rises.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.llm.common import Slots, gathered, give_back, room, small_slices
from tabweave.storage import stage

CAPACITY = 4096
END = 2
PART = 512  # longest piece of what is left of a document behind its full sequences
BLOCK_WINDOWS = 256  # expected windows per block
CACHED = 36 << 20  # bytes of words and ids that a worker keeps, in each of two generations
_TOGETHER = 500  # new words that are encoded as one text


class WordTokens:
    """Ids by the ``tokenizers`` library, remembered per word.

    White space ends words in this vocabulary and leaves no token, and its normalisation does not look
    across white space, so a text's ids are the ids of its words one behind the other. Words seen lately are
    remembered, up to ``CACHED`` bytes, and those seen before them up to as many.
    """

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(content)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        (self._zero,) = self._tokenizer.encode("0", add_special_tokens=False).ids
        self._known, self._older = Slots(), Slots()

    def ids(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null is empty), one text behind the other, and their number per text.

        With ``end`` every text has this id behind its own.
        """
        split = pa.compute.ascii_split_whitespace(_folded(pa.compute.fill_null(texts.cast(pa.string()), "")))
        words = split.flatten().cast(pa.binary()).dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        slots = self._slots_of(distinct)[words.indices.to_numpy(zero_copy_only=False)]
        counts = pa.compute.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        known = self._known
        starts, lengths, ids = known.start, known.length, known.ids
        if end is not None:
            slots = np.insert(slots, np.cumsum(counts), known.used)
            counts = counts + 1
            starts, lengths = room(starts, known.used + 1).copy(), room(lengths, known.used + 1).copy()
            ids = room(ids, known.held + 1)
            starts[known.used], lengths[known.used], ids[known.held] = known.held, 1, end
        return gathered(ids, starts[slots], lengths[slots], counts)

    def _slots_of(self, words: list[bytes]) -> np.ndarray:
        """The slots of some distinct words, learned where they are new."""
        if self._known.bytes > CACHED:
            self._known, self._older = Slots(), self._known
        known = self._known
        found = np.fromiter(map(known.slot.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            new = [words[i] for i in missing]
            self._learn(new)
            found[missing] = list(map(known.slot.__getitem__, new))
        return found

    def _learn(self, words: list[bytes]) -> None:
        known, older = self._known, self._older
        again = [w for w in words if w in older.slot]
        known.add(again, [older.ids_of(w) for w in again])
        new = [w for w in words if w not in older.slot]
        known.add(new, self._encoded(new))

    def _encoded(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of some words by the library; many at a time in one text, told apart by a zero between them.

        A digit is always a token of its own, so words without a zero cannot be mistaken for the mark between them.
        """
        alone = [i for i, w in enumerate(words) if b"0" in w or b"<|" in w]
        rest = [i for i, w in enumerate(words) if not (b"0" in w or b"<|" in w)]
        out: list[np.ndarray] = [np.zeros(0, dtype="<u4")] * len(words)
        texts = [words[i].decode() for i in alone]
        for at in range(0, len(rest), _TOGETHER):
            texts.append("".join([words[i].decode() + " 0 " for i in rest[at : at + _TOGETHER]]))
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for i, e in zip(alone, encoded, strict=False):
            out[i] = np.array(e.ids, dtype="<u4")
        if rest:
            ids = np.concatenate([np.array(e.ids, dtype="<u4") for e in encoded[len(alone) :]])
            ends = np.flatnonzero(ids == self._zero)
            for i, a, b in zip(rest, [0, *(ends[:-1] + 1).tolist()], ends.tolist(), strict=True):
                out[i] = ids[a:b]
        return out


# Marks that end a word, behind a letter or digit: always tokens of their own.
_ENDING = r"([0-9a-z])([.,;:!?]+)([\x09-\x0D ]|$)"


def _folded(texts: pa.Array) -> pa.Array:
    """The texts with the same ids in fewer words: in lower case, and the marks that end a word set apart.

    A text with ``<|`` may hold a special token, which is told apart by case. The vocabulary composes letters before it
    lowers them, and some decomposed letters have a composed form in lower case only; the marks that letters from A to Z
    are composed with begin with one of two bytes in UTF-8. Texts with any of these stay as they are.
    """
    raw = texts.cast(pa.binary())
    kept = pa.compute.match_substring(raw, b"<|")
    for byte in (b"\xcc", b"\xcd"):
        kept = pa.compute.or_(kept, pa.compute.match_substring(raw, byte))
    folded = pa.compute.replace_substring_regex(pa.compute.ascii_lower(texts), _ENDING, r"\1 \2\3")
    return pa.compute.if_else(kept, texts, folded)


@lru_cache(maxsize=2)
def load(content: str) -> WordTokens:
    return WordTokens(content)


def cut_pieces(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    part: int = PART,
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` per piece, and ``ids`` if asked for.

    A document is its ids and one end id, so an empty or null text has one token. Full sequences are cut from the document's
    beginning, and what is left into pieces of at most ``part`` ids: windows of many small pieces come out nearly equal,
    which leaves little padding.
    """
    content = Path(vocabulary).read_text(encoding="utf-8")
    fields = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load(content)
        for whole in batches:
            for batch in small_slices(whole, "text", 4 << 20):
                ids, counts = tokens.ids(batch.column(1), END)
                doc, start, length = _cuts(counts, capacity, part)
                first = (np.cumsum(counts) - counts)[doc] + start
                raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
                bounds = list(zip((4 * first).tolist(), (4 * (first + length)).tolist(), strict=True))
                crc = np.fromiter((zlib.crc32(raw[a:b]) for a, b in bounds), dtype=np.int64, count=len(bounds))
                arrays = [batch.column(0).take(pa.array(doc)), *map(pa.array, (start, length, crc, counts[doc]))]
                if with_ids:
                    arrays.append(pa.array([bytes(raw[a:b]) for a, b in bounds], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, fields)
        give_back()

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return given.mapInArrow(run, schema)


def _cuts(counts: np.ndarray, capacity: int, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and length of the pieces: full sequences first, then parts of what is left."""
    full = counts // capacity
    pieces = full + -(-(counts % capacity) // part)
    doc = np.repeat(np.arange(len(counts)), pieces)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    behind = number - full[doc]
    start = np.where(behind < 0, number * capacity, full[doc] * capacity + behind * part)
    return doc, start, np.minimum(counts[doc] - start, np.where(behind < 0, capacity, part))


def differencing(sizes: list[int], windows: int) -> list[tuple[int, list[int]]]:
    """Karmarkar-Karp: (sum, items) of each non-empty window, largest sum first.

    A partial partition is kept as its non-empty windows (sum, number) in falling order; the others are empty. Windows
    that merge get a new number, and the items are read off the numbers at the end.
    """
    merged_from: list[tuple[int, int]] = []
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        _, tie, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        overlap = max(0, len(a) + len(b) - windows)
        # The smallest windows of a take the largest of b, as far as there are no empty ones.
        merged = a[: len(a) - overlap] + b[overlap:]
        for (x, i), (y, j) in zip(a[len(a) - overlap :], reversed(b[:overlap]), strict=True):
            merged.append((x + y, n + len(merged_from)))
            merged_from.append((i, j))
        merged.sort(reverse=True)
        smallest = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (smallest - merged[0][0], tie, merged))

    def items(number: int) -> list[int]:
        found, todo = [], [number]
        while todo:
            at = todo.pop()
            if at < n:
                found.append(at)
            else:
                todo += merged_from[at - n]
        return found

    return [(total, items(number)) for total, number in heap[0][2]] if heap else []


def pack_block(sizes: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """Windows of at most ``capacity``; starts from the fewest that can hold all and adds one while any exceeds it."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = differencing(sizes, windows)
        if not found or found[0][0] <= capacity:
            return found
        windows += 1


def pack(pieces: DataFrame, capacity: int = CAPACITY, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``.

    Every row is a piece of its own, whatever its id. The pieces are written to the shared folder first and numbered
    there; blocks are dealt by a hash of that number, so no document, source or repeated id can fill a
    block. The number of blocks follows from the sum of lengths. Only lengths and numbers meet in a
    block, never texts. An empty table gives no rows.
    """
    numbered = stage(pieces.withColumn("__piece", F.monotonically_increasing_id()), "pack-pieces")
    full = F.col("length") >= capacity
    tokens = int(numbered.where(~full).agg(F.sum("length").alias("s")).first()["s"] or 0)
    blocks = max(1, -(-tokens // (capacity * block_windows)))
    block = F.pmod(F.xxhash64("__piece"), F.lit(blocks))

    def place(group: pa.Table) -> pa.Table:
        order = pa.compute.sort_indices(group, [("__piece", "ascending")])
        group = group.take(order)
        sizes = group["length"].to_pylist()
        sequence, offset = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
        for number, (_, items) in enumerate(pack_block(sizes, capacity)):
            at = 0
            for i in items:
                sequence[i], offset[i] = number, at
                at += sizes[i]
        first = group["block"][0].as_py() << 32
        return pa.table({"__piece": group["__piece"], "sequence_id": pa.array(sequence + first), "offset": pa.array(offset)})

    small = numbered.where(~full).select(block.alias("block"), "__piece", "length")
    placed = small.groupBy("block").applyInArrow(place, "__piece long, sequence_id long, offset long")
    rest = numbered.where(~full).join(placed, "__piece")
    # Sequences of one full piece are numbered by the piece, below zero.
    whole = numbered.where(full).select(
        "*", (-F.col("__piece") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return whole.unionByName(rest).drop("__piece")
