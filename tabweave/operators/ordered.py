"""Running totals over a total order, without putting the order into one task.

A window without a partition runs in a single task. Here the order is cut into slices of bounded
size first. Every slice is scanned on its own, and what the slices before it add up to (one row per
slice) is carried in by a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tabweave.storage import stage

ROWS_PER_SLICE = 200_000
_FIRST_LOOK = 1_024
_SKETCH = 8_000
_GROUPS = 1_024  # groups of tasks whose sketches are merged on their own
_PARTITION = "__partition"


@dataclass(frozen=True)
class Slicing:
    """Cut points of an order; values equal to a cut point open the slice to its right."""

    cuts: tuple[float, ...]
    also: dict = field(default_factory=dict)

    @property
    def single(self) -> bool:
        return not self.cuts


def _even_percentiles(
    df: DataFrame, order: str, slices: int, also: dict[str, Column] | None = None
) -> tuple[int, list[float], dict]:
    """Number of values, cuts between ``slices`` parts of about equal size, and the ``also`` aggregates.

    Sketches of tasks meet group by group first, so no task reads those of all tasks.
    """
    value = F.col(order).cast("double")
    parts = df.groupBy((F.spark_partition_id() % _GROUPS).alias("g")).agg(
        F.count(value).alias("n"), F.kll_sketch_agg_double(value, _SKETCH).alias("s")
    )
    fractions = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    cuts = F.when(F.kll_sketch_get_n_double("s") > 0, F.kll_sketch_get_quantile_double("s", fractions))
    merged = parts.agg(F.sum("n").alias("n"), F.kll_merge_agg_double("s", _SKETCH).alias("s"))
    row = merged.select("n", cuts.alias("cuts")).first()
    extra = df.agg(*[column.alias(name) for name, column in also.items()]).first().asDict() if also else {}
    return row["n"] or 0, row["cuts"] or [], extra


def _cuts_within(df: DataFrame, order: str, coarse: Slicing, parts: int) -> list[float]:
    """Cut points inside each coarse slice: one sketch and one row per slice, however many there are."""
    fractions = ", ".join(f"{i / parts!r}D" for i in range(1, parts))
    sliced = assign_slices(df.select(order), order, coarse, "__coarse")
    inner = sliced.groupBy("__coarse").agg(
        F.expr(f"percentile_approx(CAST(`{order}` AS DOUBLE), array({fractions}), {max(1_000, 10 * parts)})").alias("cuts")
    )
    return [c for row in inner.collect() for c in row["cuts"] or []]


def plan_slices(
    df: DataFrame, order: str, rows_per_slice: int = ROWS_PER_SLICE, also: dict[str, Column] | None = None
) -> Slicing:
    """Cut a numeric order column into slices of about ``rows_per_slice`` rows.

    One pass that returns one row: the percentile sketches are combined in stages. Beyond
    1,024 slices a second pass cuts each of them again, so slices keep their size. Equal
    values stay together, so callers with repeated values group by value first. The cut points only
    balance the work; results do not depend on how good they are. ``also`` are further aggregates the
    caller wants.
    """
    n, cuts, extra = _even_percentiles(df, order, _FIRST_LOOK, also)
    wanted = -(-n // rows_per_slice)
    if wanted > _FIRST_LOOK:
        coarse = Slicing(tuple(sorted({c for c in cuts if c == c})))
        cuts = [*coarse.cuts, *_cuts_within(df, order, coarse, -(-wanted // _FIRST_LOOK))]
    else:
        step = _FIRST_LOOK / max(wanted, 1)
        cuts = [cuts[int(i * step) - 1] for i in range(1, wanted)]
    # NaN sorts last and has a slice of its own in assign_slices.
    return Slicing(tuple(sorted({c for c in cuts if c == c})), extra)


def assign_slices(df: DataFrame, order: str, slicing: Slicing, name: str = "slice") -> DataFrame:
    if slicing.single:
        return df.withColumn(name, F.lit(0))
    as_double = f"__{name}_order"
    cutter = Bucketizer(
        splits=[float("-inf"), *slicing.cuts, float("inf")],
        inputCol=as_double,
        outputCol=name,
        handleInvalid="keep",
    )
    sliced = cutter.transform(df.withColumn(as_double, F.col(order).cast("double")))
    # Never null, so the join on slices adds no filter and both its sides can share one exchange.
    return sliced.withColumn(name, F.coalesce(F.col(name).cast("int"), F.lit(0))).drop(as_double)


@dataclass(frozen=True)
class Running:
    """One running measure.

    ``kind`` is sum, min, max, last (the last value that is not null) or whole (the sum over all rows
    of the partition, the same on each of them).
    """

    kind: str
    value: Column
    include_current: bool = True


def _total(measure: Running, order: Column) -> Column:
    if measure.kind in ("sum", "whole"):
        return F.sum(measure.value)
    if measure.kind == "min":
        return F.min(measure.value)
    if measure.kind == "max":
        return F.max(measure.value)
    if measure.kind == "last":
        return F.max_by(measure.value, F.when(measure.value.isNotNull(), order))
    raise ValueError(f"unknown running measure '{measure.kind}'")


def _over(kind: str, value: Column, ordered: WindowSpec, all_rows: WindowSpec) -> Column:
    if kind == "last":
        return F.last(value, ignorenulls=True).over(ordered)
    if kind == "whole":
        return F.sum(value).over(all_rows)
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](value).over(ordered)


def _combine(kind: str, carried: Column, local: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))
    if kind == "min":
        return F.least(carried, local)
    if kind == "max":
        return F.greatest(carried, local)
    if kind == "whole":
        return F.coalesce(carried, local)
    return F.coalesce(local, carried)


def running(
    df: DataFrame,
    measures: dict[str, Running],
    order: str,
    partition: Sequence[str] = (),
    slice_col: str = "slice",
    single_slice: bool = False,
    descending: bool = False,
) -> DataFrame:
    """Add running measures along ``order`` within ``partition``.

    ``slice_col`` must grow with ``order``. Null is a partition of its own. The window of a slice and
    the join to its carried totals need the same distribution, so the rows move once. The sum of no
    values is 0. "last" is only defined for ascending order.
    """
    given = df.columns
    # Structs of equal parts are equal even where parts are null, unlike the columns themselves.
    df = df.withColumn(_PARTITION, F.struct(*[F.col(c) for c in partition] or [F.lit(0)]))
    partition = [_PARTITION]

    def towards(name: str) -> Column:
        return F.desc(name) if descending else F.asc(name)

    of_slice = Window.partitionBy(*partition, slice_col)
    local = of_slice.orderBy(towards(order))
    before = Window.unboundedPreceding

    def frame(window, measure: Running):
        return window.rowsBetween(before, 0 if measure.include_current else -1)

    if single_slice:
        none = F.lit(None)
        return df.select(
            *given,
            *[
                _combine(m.kind, none, _over(m.kind, m.value, frame(local, m), of_slice)).alias(name)
                for name, m in measures.items()
            ],
        )

    totals = df.groupBy(*partition, slice_col).agg(
        *[_total(m, F.col(order)).alias(f"__total_{name}") for name, m in measures.items()]
    )
    of_partition = Window.partitionBy(*partition)
    earlier = of_partition.orderBy(towards(slice_col)).rowsBetween(before, -1)
    carried = totals.select(
        *partition,
        slice_col,
        *[
            _over(m.kind, F.col(f"__total_{name}"), earlier, of_partition).alias(f"__carry_{name}")
            for name, m in measures.items()
        ],
    )
    scanned = df.select(
        "*",
        *[
            (F.lit(None) if m.kind == "whole" else _over(m.kind, m.value, frame(local, m), of_slice)).alias(f"__local_{name}")
            for name, m in measures.items()
        ],
    )
    return scanned.join(carried, [*partition, slice_col]).select(
        *given,
        *[
            _combine(m.kind, F.col(f"__carry_{name}"), F.col(f"__local_{name}")).alias(name)
            for name, m in measures.items()
        ],
    )


def global_positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Add the place of every row, from 0, in the order of some columns.

    Rows are dealt into ranges and sorted within them; the ranges are written to the shared folder with the place
    of each row in its range, and one line per range says how many rows lie before it. Equal rows take
    neighbouring places.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id holds the range in its upper bits and counts rows below them.
    held = stage(ranged.withColumn("__place", F.monotonically_increasing_id()), "positions")
    held = held.withColumn("__range", F.shiftright("__place", 33))
    counts = held.groupBy("__range").agg(F.count(F.lit(1)).alias("n"), F.min("__place").alias("first"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__range", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("__start"))
    return held.join(starts, "__range").select(*df.columns, (F.col("__place") + F.col("__start")).alias(name))
