"""Vector code compression: product codebooks refined by Lloyd rounds over cover trees.

A vector is cut into equal parts, and a code names the nearest codebook entry of every part. The rows of a task
are gathered into forests of bounded size, one cover tree per part: the points below a node lie within its
radius, its children are further apart than half its level's distance, and it carries the number and the sum of its
points. A node whose ball lies nearer to one entry than to all others is assigned as a whole, with
its sums; only the others descend, in the end to exact comparisons in their leaves. Trees are built once
and written; each round reads them and returns one line of sums per codebook component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.storage import stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
FOREST_ROWS = 1024  # vectors per forest, so that a forest stays below some MB
LEAF = 8  # nodes of so few points have no children
WIDEST = 128  # nodes that would have more children are leaves, which only saves work
LARGEST = 1 << 24  # integers beyond this could overflow the squares


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, position]``: integers."""

    entries: np.ndarray

    def sha256(self) -> str:
        """Digest of all components in decimal, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _runs(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``begin, begin + 1, ...`` for ``count`` steps, one run behind the other."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - begin, count)


def _firsts(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    if not len(sorted_values):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


def _square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    difference = a - b
    return np.einsum("ij,ij->i", difference, difference)


@dataclass
class Forest:
    """Cover trees over ``points[part * rows + row]``; a node holds the points ``order[start : start + size]``.

    The first of them is its centre. Children of a node are consecutive nodes. Roots come first, one per part.
    """

    points: np.ndarray
    order: np.ndarray
    start: np.ndarray
    size: np.ndarray
    child: np.ndarray
    children: np.ndarray
    radius: np.ndarray
    sums: np.ndarray

    FIELDS = (
        ("points", "<i4"),
        ("order", "<i4"),
        ("start", "<i4"),
        ("size", "<i4"),
        ("child", "<i4"),
        ("children", "<i4"),
        ("radius", "<f8"),
        ("sums", "<i8"),
    )

    def pack(self) -> list[bytes]:
        return [np.ascontiguousarray(getattr(self, n), dtype=t).tobytes() for n, t in self.FIELDS]

    @classmethod
    def unpack(cls, packed: list[bytes], width: int) -> Forest:
        read = [np.frombuffer(b, dtype=t) for b, (_, t) in zip(packed, cls.FIELDS, strict=True)]
        read = [a.astype(np.int64) if a.dtype.kind == "i" else a for a in read]
        read[0], read[-1] = read[0].reshape(-1, width), read[-1].reshape(-1, width)
        return cls(*read)


def _net(points: np.ndarray, segment: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Number of the child that each point falls to, -1 throughout nodes that would need too many.

    In turn the first free point of every segment becomes a centre and takes the free points within the limit (squared).
    """
    child = np.full(len(points), -1, dtype=np.int64)
    free = np.arange(len(points))
    for number in range(WIDEST):
        if not len(free):
            return child
        mine = segment[free]
        first = _firsts(mine)
        centre = np.repeat(free[first], np.diff(np.append(first, len(mine))))
        near = _square(points[free], points[centre]) <= limit[mine]
        child[free[near]] = number
        free = free[~near]
    child[np.isin(segment, segment[free])] = -1
    return child


def build_forest(points: np.ndarray) -> Forest:
    """One cover tree per part over ``points[part, row, position]``, all of them level by level."""
    parts, rows, width = points.shape
    flat = points.reshape(-1, width)
    order = np.arange(parts * rows)
    start, size = np.arange(parts) * rows, np.full(parts, rows)
    levels, made = [], parts
    while len(start):
        at = _runs(start, size)
        node = np.repeat(np.arange(len(start)), size)
        far = np.maximum.reduceat(_square(flat[order[at]], flat[order[start]][node]), np.cumsum(size) - size)
        inner = (size > LEAF) & (far > 0)
        at, node = at[inner[node]], node[inner[node]]
        # A node of level i has its points within 2**i; its children are of level i - 1.
        limit = 4.0 ** (np.ceil(np.log2(np.maximum(far, 1)) / 2) - 1)
        number = _net(flat[order[at]], node, limit)
        at, node, number = at[number >= 0], node[number >= 0], number[number >= 0]
        moved = np.lexsort((number, node))
        order[at] = order[at][moved]
        begin = _firsts(node * WIDEST + number[moved])
        parent = node[begin]
        children = np.bincount(parent, minlength=len(start))
        levels.append((start, size, made + np.cumsum(children) - children, children, np.sqrt(far)))
        made += len(begin)
        start, size = at[begin], np.diff(np.append(begin, len(at)))
    start, size, child, children, radius = (np.concatenate(c) for c in zip(*levels, strict=True))
    running = np.concatenate([np.zeros((1, width), dtype=np.int64), np.cumsum(flat[order], axis=0)])
    return Forest(flat, order, start, size, child, children, radius, running[start + size] - running[start])


@dataclass
class Settled:
    """Nodes that fall to one entry as a whole, and single points; entries are numbered over all parts."""

    nodes: np.ndarray
    node_entries: np.ndarray
    points: np.ndarray
    point_entries: np.ndarray


def settle(forest: Forest, books: np.ndarray) -> Settled:
    """The nearest entry of every point, ties to the lower one, by descending all trees together."""
    parts, entries, width = books.shape
    flat = books.reshape(-1, width)
    node, entry = np.repeat(np.arange(parts), entries), np.arange(parts * entries)
    found: list[list[np.ndarray]] = [[], [], [], []]
    while len(node):
        centre = forest.points[forest.order[forest.start[node]]]
        apart = np.sqrt(_square(centre, flat[entry]).astype(np.float64))
        first = _firsts(node)
        held = np.diff(np.append(first, len(node)))
        # No point of the ball is nearer to an entry beyond this; a margin covers the rounding of roots.
        reach = np.repeat(np.minimum.reduceat(apart, first), held) + 2 * forest.radius[node]
        within = apart <= reach + 1e-9 * (1 + reach)
        node, entry = node[within], entry[within]
        first = _firsts(node)
        held = np.diff(np.append(first, len(node)))
        mine = node[first]
        alone = held == 1
        found[0].append(mine[alone])
        found[1].append(entry[first[alone]])
        leaf = ~alone & (forest.children[mine] == 0)
        for place, values in zip((2, 3), _compare(forest, flat, mine[leaf], first[leaf], held[leaf], entry), strict=True):
            found[place].append(values)
        inner = ~alone & ~leaf
        below, copies = forest.children[mine[inner]], held[inner]
        node = np.repeat(_runs(forest.child[mine[inner]], below), np.repeat(copies, below))
        entry = entry[_runs(np.repeat(first[inner], below), np.repeat(copies, below))]
    return Settled(*[np.concatenate(f) if f else np.zeros(0, dtype=np.int64) for f in found])


def _compare(forest, flat, node, first, held, entry) -> tuple[np.ndarray, np.ndarray]:
    """Exact distances of the points of leaves to the entries that are left for them."""
    size = forest.size[node]
    point = forest.order[_runs(forest.start[node], size)]
    tries = np.repeat(held, size)
    candidate = entry[_runs(np.repeat(first, size), tries)]
    if not len(point):
        return point, candidate
    square = _square(np.repeat(forest.points[point], tries, axis=0), flat[candidate])
    begin = np.cumsum(tries) - tries
    best = np.flatnonzero(square == np.repeat(np.minimum.reduceat(square, begin), tries))
    owner = np.repeat(np.arange(len(point)), tries)[best]
    return point, candidate[best[_firsts(owner)]]


def entry_sums(forest: Forest, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points and sums of points per entry, over all parts."""
    parts, entries, width = books.shape
    settled = settle(forest, books)
    counts = np.zeros(parts * entries, dtype=np.int64)
    sums = np.zeros((parts * entries, width), dtype=np.int64)
    np.add.at(counts, settled.node_entries, forest.size[settled.nodes])
    np.add.at(sums, settled.node_entries, forest.sums[settled.nodes])
    np.add.at(counts, settled.point_entries, 1)
    np.add.at(sums, settled.point_entries, forest.points[settled.points])
    return counts, sums


def codes_of(forest: Forest, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``codes[row, part]`` and the squared distances of each row, summed over parts."""
    parts, entries, width = books.shape
    settled = settle(forest, books)
    code = np.zeros(len(forest.points), dtype=np.int64)
    size = forest.size[settled.nodes]
    code[forest.order[_runs(forest.start[settled.nodes], size)]] = np.repeat(settled.node_entries, size)
    code[settled.points] = settled.point_entries
    square = _square(forest.points, books.reshape(-1, width)[code])
    return (code % entries).reshape(parts, -1).T, square.reshape(parts, -1).sum(axis=0)


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """``id, label, whole``: rows whose vector has only finite components, as integers ``floor(scale * x)``."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    too_large = F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}")).cast("bigint")

    def whole(x: Column) -> Column:
        return F.when(F.abs(x) * scale > LARGEST, too_large).otherwise(F.floor(x * scale).cast("bigint"))

    usable = vectors.where(vector.isNotNull() & ~odd)
    return usable.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.transform(vector, whole).alias("whole")
    )


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def plant_forests(usable: DataFrame, parts: int, width: int) -> DataFrame:
    """One row per forest: the ids and labels of its vectors, and its trees."""
    types = {c: usable.schema[c].dataType.simpleString() for c in ("id", "label")}

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, FOREST_ROWS):
                batch = whole.slice(at, FOREST_ROWS)
                points = _matrix(batch.column(2), parts * width).reshape(-1, parts, width).transpose(1, 0, 2)
                packed = build_forest(np.ascontiguousarray(points)).pack()
                kept = [pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(c)) for c in (0, 1)]
                names = ["ids", "labels", *[n for n, _ in Forest.FIELDS]]
                yield pa.RecordBatch.from_arrays([*kept, *[pa.array([b], pa.binary()) for b in packed]], names)

    fields = ", ".join(f"{n} binary" for n, _ in Forest.FIELDS)
    return usable.mapInArrow(plant, f"ids array<{types['id']}>, labels array<{types['label']}>, {fields}")


def _forests(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, Forest]]:
    for i in range(batch.num_rows):
        yield i, Forest.unpack([batch.column(n)[i].as_py() for n, _ in Forest.FIELDS], width)


def refine(forests: DataFrame, books: np.ndarray) -> np.ndarray:
    """One Lloyd round: entries become the floored mean of their parts, unused ones stay.

    A task returns at most one line per codebook component, and so does the driver get.
    """
    parts, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(parts * entries, dtype=np.int64), np.zeros((parts * entries, width), dtype=np.int64)
        for batch in batches:
            for _, forest in _forests(batch, width):
                for total, more in zip((counts, sums), entry_sums(forest, books), strict=True):
                    total += more
        used = np.flatnonzero(counts)
        place = (used[:, None] * width + np.arange(width)).ravel()
        values = [place, np.repeat(counts[used], width), sums[used].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["place", "n", "total"])

    columns = [n for n, _ in Forest.FIELDS]
    added = forests.select(*columns).mapInArrow(add, "place long, n long, total long")
    found = added.groupBy("place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).toArrow()
    moved = books.ravel().copy()
    moved[found["place"].to_numpy()] = found["total"].to_numpy() // found["n"].to_numpy()
    return moved.reshape(books.shape)


def encode_forests(forests: DataFrame, books: np.ndarray) -> DataFrame:
    """``id, label, code, error`` of every vector, by the entries as they are."""
    width = books.shape[2]
    types = {c: forests.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels")}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, forest in _forests(batch, width):
                codes, errors = codes_of(forest, books)
                hexes = pa.array([c.tobytes().hex() for c in codes.astype(np.uint8)], pa.string())
                kept = [batch.column(c)[i].values for c in ("ids", "labels")]
                yield pa.RecordBatch.from_arrays([*kept, hexes, pa.array(errors)], ["id", "label", "code", "error"])

    return forests.mapInArrow(encode, f"id {types['ids']}, label {types['labels']}, code string, error long")


def first_codebooks(usable: DataFrame, parts: int, entries: int, width: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids; equal ids by their vectors, null behind all ids."""
    first = usable.select("id", "whole").orderBy(F.asc_nulls_last("id"), "whole").limit(entries)
    rows = stage(first, "first_entries").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["id"] is None, 0 if r["id"] is None else r["id"], r["whole"]))
    vectors = np.array([r["whole"] for r in rows], dtype=np.int64)
    return np.ascontiguousarray(vectors.reshape(-1, parts, width).transpose(1, 0, 2))


def compress_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """``id, label, code, error`` of every usable vector, and the codebooks.

    Rows whose vector is null or holds null, NaN or infinity are left out. All others must have one length that is
    a multiple of ``parts``, and components up to ``LARGEST / scale``; both are checked. Repeated rows and ids are rows of
    their own; a null id comes behind all others where the first entries are chosen. With fewer vectors than
    ``entries`` there are as many entries as vectors. A table without usable vectors gives no rows and empty codebooks.
    Other columns are not read.

    Two passes over the vectors (first entries and lengths, trees), then one over the trees per round and one for the codes.
    The trees are a written copy of the table; no row moves between tasks.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits, so a codebook has 1 to 256 entries")
    usable = usable_vectors(vectors, id_col, vector_col, label_col, scale)
    lengths = usable.agg(F.min(F.size("whole")).alias("least"), F.max(F.size("whole")).alias("most")).first()
    if lengths["least"] is None:
        nothing = usable.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
        return nothing, Codebooks(np.zeros((parts, 0, 0), dtype=np.int64))
    if lengths["least"] != lengths["most"] or lengths["least"] % parts or not lengths["least"]:
        raise ValueError(f"vectors have {lengths['least']} to {lengths['most']} components, not one multiple of {parts}")
    width = lengths["least"] // parts
    books = first_codebooks(usable, parts, entries, width)
    forests = stage(plant_forests(usable, parts, width), "forests")
    for _ in range(rounds):
        books = refine(forests, books)
    return encode_forests(forests, books), Codebooks(books)


def with_label_error(codes: DataFrame) -> DataFrame:
    """Add ``label_error``: the error summed over rows of the same label, null being one.

    Codes and sums are written first, so that the join sees their sizes and can split a label with many rows.
    """
    codes = stage(codes, "codes")
    sums = codes.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return codes.join(stage(sums, "label_errors"), F.col("label").eqNullSafe(F.col("__label"))).drop("__label")
