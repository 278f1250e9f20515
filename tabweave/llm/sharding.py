"""Shards of near equal size by sampled splitters.

Keys are sampled in proportion to size, quantiles of the sample cut the key space into ranges, the
ranges are measured exactly, and those that a shard boundary falls into are cut again while they are
overfull. The order of the keys puts equal texts side by side, so a group of copies lies in one
shard unless it is too large for that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabweave.llm.common import whole_text
from tabweave.storage import stage

SAMPLE = 8_192  # sampled keys that come back to the driver per round, whatever the input
RANGES = 1_024  # measured ranges per round
RANGE_SHARE = 0.005  # a range above this share of a shard is overfull
WHOLE_GROUP_SHARE = 0.05  # equal texts up to this share of a shard stay together
_KEYS = ("text_key", "id_key", "row")
_MOST = 2**63 - 1


@dataclass(frozen=True)
class _Open:
    """A range of keys that still holds a boundary: equal on the first keys, ``low`` to ``high`` on the next."""

    fixed: tuple[int, ...]
    low: int
    high: int
    before: int  # bytes of all rows in front of it
    held: int

    def holds(self) -> str:
        parts = [f"{k} = {v}L" for k, v in zip(_KEYS, self.fixed, strict=False)]
        key = _KEYS[len(self.fixed)]
        return " AND ".join([*parts, f"{key} >= {_sql_long(self.low)}", f"{key} <= {_sql_long(self.high)}"])


def _sql_long(value: int) -> str:
    return f"(-{_MOST}L - 1)" if value == -_MOST - 1 else f"{value}L"


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 42,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: shards of near equal bytes, slots from 0 without gaps.

    Size is the UTF-8 length of the text plus 1; null counts as empty. Rows with null or repeated
    ids are rows like any other. An empty table gives no rows. Other columns are not read.

    What comes back to the driver is ``SAMPLE`` keys and ``RANGES`` sums per round. A round divides the
    open ranges by about ``RANGES``; two or three are enough at any size. A group of equal texts that
    fills more than ``WHOLE_GROUP_SHARE`` of a shard is divided by id, and rows that repeat an id by
    their place in the staged table.
    """
    text = whole_text(text_col)
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_MOST)).alias("id_key"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stage(keyed, "shard-keys")
    cuts = _boundaries(rows, shards, seed)
    return _slots(rows.withColumn("shard", _shard_of(cuts)))


def _boundaries(rows: DataFrame, shards: int, seed: int) -> list[tuple[int, ...]]:
    """Per boundary the first key of the shard to its right, as a tuple over a prefix of ``_KEYS``."""
    total = int(rows.agg(F.sum("size").alias("s")).first()["s"] or 0)
    if not total:
        return []
    share = total / shards
    targets = [share * i for i in range(1, shards)]
    found: dict[int, tuple[int, ...]] = {}
    ranges = {_Open((), -_MOST - 1, _MOST, 0, total): list(range(len(targets)))}
    while ranges:
        again: dict[_Open, list[int]] = {}
        measured = _measure(rows, list(ranges), seed)
        for open_range, wanted in ranges.items():
            parts = measured[open_range]
            for t in wanted:
                part = next((p for p in parts if p.before + p.held > targets[t]), parts[-1])
                single = part.low == part.high
                whole = single and len(part.fixed) == 0 and part.held <= WHOLE_GROUP_SHARE * share
                if part.held <= RANGE_SHARE * share or whole or (single and len(part.fixed) == len(_KEYS) - 1):
                    # Cut at the nearer edge of the range.
                    right = targets[t] - part.before > part.held / 2
                    following = part.high + 1 if part.high < _MOST else None
                    if not right:
                        found[t] = (*part.fixed, part.low)
                    elif following is not None:
                        found[t] = (*part.fixed, following)
                    else:
                        found[t] = _after(part.fixed)
                    continue
                if single:
                    part = _Open((*part.fixed, part.low), -_MOST - 1, _MOST, part.before, part.held)
                again.setdefault(part, []).append(t)
        ranges = again
    return [found[t] for t in range(len(targets))]


def _after(fixed: tuple[int, ...]) -> tuple[int, ...]:
    """The first key behind everything that begins with ``fixed``."""
    while fixed and fixed[-1] == _MOST:
        fixed = fixed[:-1]
    return (*fixed[:-1], fixed[-1] + 1) if fixed else (_MOST, _MOST, _MOST)


def _measure(rows: DataFrame, ranges: list[_Open], seed: int) -> dict[_Open, list[_Open]]:
    """Cut every open range at quantiles of a size-weighted sample and sum up the bytes of each part."""
    number = F.lit(None).cast("int")
    key = F.lit(None).cast("long")
    for i, r in reversed(list(enumerate(ranges))):
        number = F.when(F.expr(r.holds()), F.lit(i)).otherwise(number)
        key = F.when(F.expr(r.holds()), F.col(_KEYS[len(r.fixed)])).otherwise(key)
    inside = rows.select(number.alias("open"), key.alias("key"), "size", "row").where("open IS NOT NULL")
    # The smallest of -ln(u) / size are a sample in proportion to size; u comes from the row alone.
    u = (F.pmod(F.xxhash64("key", "row", F.lit(seed)), F.lit(2**52)) + 1) / F.lit(2.0**52 + 1)
    sampled = inside.orderBy(-F.log(u) / F.col("size"), "open", "key").limit(SAMPLE).select("open", "key").collect()
    cuts: list[np.ndarray] = []
    for i in range(len(ranges)):
        keys = sorted(s["key"] for s in sampled if s["open"] == i)
        most = max(2, RANGES // len(ranges))
        picked = {keys[len(keys) * j // most] for j in range(most)} if keys else set()
        # Each key is also followed by a cut, so a key with many bytes is a range by itself.
        picked |= {k + 1 for k in picked if k < _MOST}
        cuts.append(np.array(sorted(picked - {ranges[i].low}), dtype=np.int64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(len(c) + 1, dtype=np.int64) for c in cuts]
        for batch in batches:
            which = batch.column(0).to_numpy(zero_copy_only=False)
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            sizes = batch.column(2).to_numpy(zero_copy_only=False)
            for i in np.unique(which):
                mine = which == i
                np.add.at(sums[i], np.searchsorted(cuts[i], keys[mine], side="right"), sizes[mine])
        for i, s in enumerate(sums):
            parts = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(parts), i, np.int32)), pa.array(parts.astype(np.int32)), pa.array(s[parts])],
                ["open", "part", "bytes"],
            )

    counted = inside.select("open", "key", "size").mapInArrow(count, "open int, part int, bytes long")
    held = {(r["open"], r["part"]): r["b"] for r in counted.groupBy("open", "part").agg(F.sum("bytes").alias("b")).collect()}
    result: dict[_Open, list[_Open]] = {}
    for i, r in enumerate(ranges):
        before, parts = r.before, []
        edges = [r.low, *cuts[i].tolist()]
        for j, low in enumerate(edges):
            high = edges[j + 1] - 1 if j + 1 < len(edges) else r.high
            if size := held.get((i, j), 0):
                parts.append(_Open(r.fixed, low, high, before, size))
                before += size
        result[r] = parts
    return result


def _shard_of(cuts: list[tuple[int, ...]]):
    """Number of boundaries at or below a row's key."""
    passed = F.lit(0)
    for cut in cuts:
        at_or_after = F.lit(False)
        for depth in range(len(cut)):
            same = F.lit(True)
            for k, v in zip(_KEYS[:depth], cut[:depth], strict=True):
                same = same & (F.col(k) == F.lit(v))
            compare = F.col(_KEYS[depth])
            reached = compare >= F.lit(cut[depth]) if depth == len(cut) - 1 else compare > F.lit(cut[depth])
            at_or_after = at_or_after | (same & reached)
        passed = passed + at_or_after.cast("int")
    return passed


def _slots(placed: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0: places within range partitions plus what lies before them."""
    ranged = placed.repartitionByRange("shard", "text_key", "id_key", "row").sortWithinPartitions(
        "shard", "text_key", "id_key", "row"
    )
    # The id holds the partition in its upper bits and counts rows below them.
    numbered = stage(
        ranged.select("doc_id", "size", "text_crc32", "shard", F.monotonically_increasing_id().alias("place")),
        "shard-places",
    ).withColumn("part", F.shiftright("place", 33))
    counts = numbered.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return numbered.join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first") + F.col("before")).alias("slot")
    )
