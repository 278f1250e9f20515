"""Seeded permutation and exact three-way split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.operators.ordered import Running, running

TRAIN_FRACTION = 0.70
VALIDATION_FRACTION = 0.15
DEFAULT_SEED = 42

_SLICE_ROWS = 200_000  # rows of the seeded order that are numbered together
_STEP_DIGITS = 3  # hex digits read per refinement, 4,096 cells
_KEY_DIGITS = 32
_CELL_ROWS = 20_000  # a cell this small is read directly
_COPIES_PER_TASK_ROW = 100_000


def order_key(columns: Sequence[str], seed: int, key: Sequence[str] | None = None) -> Column:
    """Place of a row in the seeded order: md5 of the seed and the key, or of the whole row."""
    if key:
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    else:
        parts = [F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def _copies_spread_out(df: DataFrame, copies: str, offset: str) -> DataFrame:
    """One row per copy, numbered from 0 in ``offset``.

    A row may stand for a third of the table, so it is first cut into pieces that move to other
    tasks, and only then unfolded.
    """
    last_piece = F.floor((F.col(copies) - 1) / F.lit(_COPIES_PER_TASK_ROW))
    pieces = df.withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("long"), last_piece)))
    start = F.col("__piece") * _COPIES_PER_TASK_ROW
    stop = F.least(start + _COPIES_PER_TASK_ROW, F.col(copies)) - 1
    return (
        pieces.repartition("order_key", "__piece")
        .withColumn(offset, F.explode(F.sequence(start, stop)))
        .drop("__piece")
    )


def slice_digits(rows: int) -> int:
    """Hex digits of the order key that cut ``rows`` rows into slices of at most some 200,000."""
    digits = 1
    while rows > _SLICE_ROWS * 16**digits:
        digits += 1
    return digits


def seeded_shuffle(
    df: DataFrame, seed: int = DEFAULT_SEED, key: Sequence[str] | None = None, digits: int | None = None
) -> DataFrame:
    """Every row once with its ``order_key`` and its ``rank`` (from 0) in the seeded order.

    ``key`` must identify a row. Without a key equal rows share a place; they are counted first and
    unfolded at the end, so copies of one row never meet in one window. ``digits`` sets the number
    of slices, 16 to the power of it; without it the rows are counted and the slices keep their size.
    """
    if digits is None:
        digits = slice_digits(df.count())
    keyed = df if key else df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias("__copies"))
    keyed = keyed.withColumn("order_key", order_key(df.columns, seed, key))
    # A prefix sorts as the keys do and serves as a slice. It is never null.
    keyed = keyed.withColumn("__slice", F.coalesce(F.substring("order_key", 1, digits), F.lit("")))
    weight = F.lit(1).cast("long") if key else F.col("__copies")
    ranked = running(
        keyed, {"rank": Running("sum", weight, include_current=False)}, "order_key", slice_col="__slice"
    ).drop("__slice")
    if key:
        return ranked
    return (
        _copies_spread_out(ranked, "__copies", "__offset")
        .withColumn("rank", F.col("rank") + F.col("__offset"))
        .drop("__copies", "__offset")
    )


def split_ends(rows: int, train: float = TRAIN_FRACTION, validation: float = VALIDATION_FRACTION) -> tuple[int, int]:
    """Ranks at which train and validation end; products are truncated in double arithmetic."""
    train_end = int(train * rows)
    return train_end, train_end + int(validation * rows)


def split_name(rank: Column, ends: tuple[int, int]) -> Column:
    return F.when(rank < ends[0], "train").when(rank < ends[1], "val").otherwise("test")


class _Cut:
    """Search for the key at one rank: the cell that holds it and what lies before the cell."""

    def __init__(self, rank: int, rows: int):
        self.rank, self.rows, self.before = rank, rows, 0
        self.prefix, self.one_key = "", False
        self.key: str | None = None

    def descend(self, cells: list) -> None:
        for c in sorted(cells, key=lambda c: c["prefix"]):
            if not c["prefix"].startswith(self.prefix):
                continue
            if self.rank < self.before + c["n"]:
                self.prefix, self.rows, self.one_key = c["prefix"], c["n"], c["low"] == c["high"]
                return
            self.before += c["n"]

    @property
    def wide(self) -> bool:
        return self.rows > _CELL_ROWS and not self.one_key and len(self.prefix) < _KEY_DIGITS


def _cells(keys: DataFrame, length: int) -> list:
    """Row counts per key prefix: at most 4,096 rows per cell that is refined.

    ``low`` equals ``high`` where a cell holds a single key. They are hashes, not keys: buffers of
    longs keep this a hash aggregate, while strings would make it sort the rows.
    """
    fingerprint = F.xxhash64("order_key")
    return (
        keys.groupBy(F.substring("order_key", 1, length).alias("prefix"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(fingerprint).alias("low"), F.max(fingerprint).alias("high"))
        .collect()
    )


def _inside(cuts: list[_Cut], length: int) -> Column:
    return F.substring("order_key", 1, length).isin(sorted({c.prefix for c in cuts if len(c.prefix) == length}))


def _find_cuts(keys: DataFrame, ends_of) -> tuple[int, tuple[int, int], list[_Cut]]:
    """Keys at the split ends, found by counting key prefixes instead of sorting the table.

    Only the key column is read: once for all rows, then for the cells that contain an end.
    """
    length = _STEP_DIGITS
    cells = _cells(keys, length)
    rows = sum(c["n"] for c in cells)
    ends = ends_of(rows)
    cuts = [_Cut(rank, rows) for rank in ends]
    inside = [c for c in cuts if c.rank < rows]
    for cut in inside:
        cut.descend(cells)
    while wide := [c for c in inside if c.wide]:
        length += _STEP_DIGITS
        found = _cells(keys.filter(_inside(wide, length - _STEP_DIGITS)), length)
        for cut in wide:
            cut.descend(found)
    if inside:
        # At most _CELL_ROWS rows per cut, or copies of one key, which are counted on the map side.
        near = F.lit(False)
        for n in sorted({len(c.prefix) for c in inside}):
            near = near | _inside(inside, n)
        counted = keys.filter(near).groupBy("order_key").agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(counted, key=lambda r: r["order_key"]):
            for cut in inside:
                if cut.key is None and r["order_key"].startswith(cut.prefix):
                    if cut.rank < cut.before + r["n"]:
                        cut.key = r["order_key"]
                    else:
                        cut.before += r["n"]
    return rows, ends, cuts


def _split_copies(ties: DataFrame, columns: list[str], ends: tuple[int, int]) -> DataFrame:
    """Deal out equal rows by number: which copy goes where makes no difference."""
    counted = ties.groupBy(*[f"`{c}`" for c in columns], "order_key").agg(F.count(F.lit(1)).alias("__copies"))
    spread = _copies_spread_out(counted, "__copies", "__offset")
    return spread.select(*[f"`{c}`" for c in columns], "order_key", split_name(F.col("__offset"), ends).alias("split"))


def _split(df: DataFrame, seed: int, key: Sequence[str] | None, ends_of) -> DataFrame:
    columns = df.columns
    keyed = df.withColumn("order_key", order_key(columns, seed, key))
    rows, ends, cuts = _find_cuts(keyed.select("order_key"), ends_of)

    split = F.lit("test")
    straddled: dict[str, int] = {}
    for name, cut in zip(("val", "train"), reversed(cuts)):
        if cut.key is None:  # the end lies at or beyond the last row
            split = F.lit(name)
            continue
        split = F.when(F.col("order_key") < cut.key, name).otherwise(split)
        if cut.before < cut.rank:
            straddled[cut.key] = cut.before
    whole = keyed.withColumn("split", split)
    if not straddled:
        return whole

    parts = [whole.filter(~F.col("order_key").isin(sorted(straddled)))]
    for tie_key, before in sorted(straddled.items()):
        ties = keyed.filter(F.col("order_key") == tie_key)
        inner = tuple(max(end - before, 0) for end in ends)
        if key:
            # Rows that share a key but differ elsewhere are ordered by their whole content.
            again = _split(ties.drop("order_key"), seed, None, lambda _rows, inner=inner: inner)
            parts.append(again.withColumn("order_key", F.lit(tie_key)))
        else:
            parts.append(_split_copies(ties, columns, inner))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def three_way_split(
    df: DataFrame,
    seed: int = DEFAULT_SEED,
    key: Sequence[str] | None = None,
    train: float = TRAIN_FRACTION,
    validation: float = VALIDATION_FRACTION,
) -> DataFrame:
    """Add ``order_key`` and ``split`` with exact sizes.

    The same rows as cutting :func:`seeded_shuffle` by position, but the table is neither sorted
    nor shuffled: the two keys at the cut positions are searched first, then each row compares its
    own key with them. Equal keys across a cut are dealt out separately.
    """
    return _split(df, seed, key, lambda rows: split_ends(rows, train, validation))
