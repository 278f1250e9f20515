"""Near-duplicates by SimHash, found in the space of segment bit counts.

A 64-bit fingerprint is cut into 32 segments of two bits, and each segment is mapped to its number of set bits. The
Manhattan distance of these vectors never exceeds the Hamming distance of the fingerprints, so pairs within four
bits are within distance four here. With the vector in two halves, either the first half is within distance two
or the second within one. Fingerprints are entered into grid cells of half vectors (their own and those
one step away) so that every such pair shares a cell; within a cell fingerprints are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.llm.common import byte_texts, small_slices
from tabweave.llm.components import connected_components
from tabweave.storage import stage

SHINGLE = 4
MAX_BITS = 4
_SEED = 42
_SWEEP = 1 << 20


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the hashes of all shingles; zero without a word."""
    words = text.lower().split()  # of bytes: lower-cases A-Z only, splits at the six ASCII white spaces
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, _SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate([[0], ends[:-shingle]]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], _SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)], dtype="<u8"
    )
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, carry: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, fp`` per row, and ``carried``; the fingerprint is a long with the same 64 bits."""
    extra = ["carried"] if carry else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text", 4 << 20):
                found = np.array([fingerprint(t, shingle) for t in byte_texts(batch.column(1))], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(found.view(np.int64)), *[batch.column(c) for c in extra]],
                    ["doc_id", "fp", *extra],
                )

    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []),
    )
    carried = f", carried {given.schema['carried'].dataType.simpleString()}" if carry else ""
    return given.mapInArrow(run, f"doc_id long, fp long{carried}")


def _counts(half: np.ndarray) -> np.ndarray:
    """Bit counts of the 16 two-bit segments of a 32-bit half, two bits of result per segment."""
    low = np.uint64(0x55555555)
    return (half & low) + ((half >> np.uint64(1)) & low)


def _neighbours(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, cell) of all cells one step away from each given one."""
    at, found = [], []
    for segment in range(16):
        one = np.uint64(1 << (2 * segment))
        count = (cells >> np.uint64(2 * segment)) & np.uint64(3)
        up, down = np.flatnonzero(count < 2), np.flatnonzero(count > 0)
        at += [up, down]
        found += [cells[up] + one, cells[down] - one]
    return np.concatenate(at), np.concatenate(found)


def _cells(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, position): the first half with all neighbours, the second with those needed for distance one.

    Two vectors at distance two share a neighbour, at distance one each is a neighbour of the other. At
    distance one exactly one of two vectors has an odd sum, so in the second half only odd vectors
    enter their neighbours.
    """
    every = np.arange(len(fps))
    first, second = _counts(fps & np.uint64(0xFFFFFFFF)), _counts(fps >> np.uint64(32))
    at1, near1 = _neighbours(first)
    odd = np.flatnonzero(np.bitwise_count(second & np.uint64(0x55555555)) % 2 == 1)
    at2, near2 = _neighbours(second[odd])
    mark = np.uint64(1 << 40)
    cells = np.concatenate([first, near1, second | mark, near2 | mark])
    return cells, np.concatenate([every, at1, every, odd[at2]])


def links_in_cell(fps: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Positions to link so that all fingerprints within ``max_bits`` are connected; at most one less than members.

    Who is already connected to the first member's component needs no sweep of its own: a partner outside of it
    makes one.
    """
    parent = list(range(len(fps)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for i in range(len(fps)):
        if i and find(i) == find(0):
            continue
        for start in range(0, len(fps), _SWEEP):
            near = np.flatnonzero(np.bitwise_count(fps[start : start + _SWEEP] ^ fps[i]) <= max_bits) + start
            for j in near.tolist():
                a, b = find(i), find(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    links.append((i, j))
    return links


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (``fp``): the components are those of all pairs within reach.

    Cells are dealt by hash and sorted within a task, so a task sees one cell after the other; most hold one
    fingerprint and are skipped as arrays. A crowded cell leaves fewer links than it has members.
    """
    if max_bits > 4:
        raise ValueError("the grid is laid out for up to four bits")

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            cells, at = _cells(fps)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells.view(np.int64)), pa.array(fps[at].view(np.int64))], ["cell", "fp"]
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_cells, held_fps = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)

        def linked(cells: np.ndarray, fps: np.ndarray) -> pa.RecordBatch | None:
            edges = np.concatenate([[0], np.flatnonzero(np.diff(cells)) + 1, [len(cells)]])
            sizes = np.diff(edges)
            a: list[np.ndarray] = []
            b: list[np.ndarray] = []
            two = edges[:-1][sizes == 2]
            close = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= max_bits]
            a.append(fps[close])
            b.append(fps[close + 1])
            for start, size in zip(edges[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                mine = fps[start : start + size]
                pairs = np.array(links_in_cell(mine, max_bits), dtype=np.int64).reshape(-1, 2)
                a.append(mine[pairs[:, 0]])
                b.append(mine[pairs[:, 1]])
            left, right = np.concatenate(a), np.concatenate(b)
            if not len(left):
                return None
            return pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], ["a", "b"])

        for batch in batches:
            cells = np.concatenate([held_cells, batch.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([held_fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(cells):
                continue
            # The last cell may go on in the next batch.
            last = int(np.searchsorted(cells, cells[-1], side="left"))
            held_cells, held_fps = cells[last:], fps[last:]
            if last and (out := linked(cells[:last], fps[:last])) is not None:
                yield out
        if len(held_cells) and (out := linked(held_cells, held_fps)) is not None:
            yield out

    entered = distinct.select("fp").mapInArrow(enter, "cell long, fp long")
    return entered.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest id reachable over links of at most ``max_bits`` differing bits.

    A null text counts as empty; texts without words have fingerprint zero and are linked like any other. Repeated ids
    and rows are rows like any other; a component whose ids are all null has a null id. An empty table
    gives no rows. Other columns are not read.

    Texts are read once and never moved. Equal fingerprints are one before anything is searched, so a group of copies
    costs as much as one document. Cells, links and components are tables; none is collected.
    """
    marked = stage(fingerprints(docs, id_col, text_col, shingle), "simhash")
    of_fp = _component_of(marked, F.lit(0).cast("long"), max_bits)
    return marked.join(of_fp.select("fp", F.col("first.id").alias("component_id")), "fp").select("doc_id", "fp", "component_id")


def _component_of(marked: DataFrame, row: Column, max_bits: int) -> DataFrame:
    """``fp, first`` per distinct fingerprint; ``first`` is the row (``id``, ``row``) with the smallest id of the component."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), row.alias("row"))
    nodes = stage(marked.groupBy("fp").agg(F.min(order).alias("least")), "simhash-distinct")
    component = connected_components(near_links(nodes, max_bits))
    labelled = nodes.join(component.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    smallest = labelled.groupBy("component").agg(F.min("least").alias("first"))
    return labelled.join(smallest, "component").select("fp", "first")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row of each component, the one with the smallest id, with all its columns."""
    marked = fingerprints(docs, id_col, text_col, shingle, carry=docs.columns)
    rows = stage(marked.withColumn("row", F.monotonically_increasing_id()), "simhash")
    first = _component_of(rows, F.col("row"), max_bits).select(F.col("first.row").alias("row")).distinct()
    return rows.join(first, "row", "left_semi").select("carried.*")
