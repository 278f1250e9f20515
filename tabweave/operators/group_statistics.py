"""Exact medians per group, for any number of groups and any size of one.

Groups of few rows are sorted and picked from directly. For the others the search is a table with one row per group,
column and middle rank: the range of values that still holds the rank, how many values are in it and which of them it
is. A round sketches the values in each range, counts them between the sketched cuts and keeps the part with the rank.
The cuts of the first round are close together around the middle, and only values next to it are read again.
Ranges of few values are picked from directly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabweave.storage import stage

IN_MEMORY_ROWS = 10_000  # rows of a group, or values of a range, that are sorted in one place
_CUTS = 64  # parts that a round cuts a range into
_CLOSER = 1.3  # of two neighbours on one side of the middle, how much farther the outer cut of the first round is
_SKETCH = 2_000
_PARTS = 1_024  # groups of tasks whose sketches of one range are merged on their own
_SENT = 100_000  # ranges or large groups that are sent to the tasks instead of moving the values to them
_KEY = ("g", "i", "which")
_SPAN = ("g", "i", "low", "high")


def _sent(lines: DataFrame, n: int) -> DataFrame:
    """Few lines go to every task: values of one group never meet in one then. Spark expects far more of joined tables."""
    return F.broadcast(lines) if n <= _SENT else lines


def _inside(values: DataFrame, ranges: DataFrame, n: int) -> DataFrame:
    """The values that lie in the ``n`` ranges of their group and column, once per range."""
    found = values.join(_sent(ranges, n), ["g", "i"])
    open_ended = F.col("low").isNull()
    return found.where(open_ended | ((F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high"))))


def _evenly() -> list[float]:
    return [k / _CUTS for k in range(_CUTS + 1)]


def _around_middle() -> list[float]:
    """As many fractions, finer towards the middle than a sketch can tell."""
    sides = [0.5 / _CLOSER**k for k in range(_CUTS // 2)]
    return sorted([0.5, *[0.5 - x for x in sides], *[0.5 + x for x in sides]])


def _cuts(inside: DataFrame, fractions: Sequence[float]) -> DataFrame:
    """The number of values in each range and values that cut it at ``fractions``, none if it holds nothing but NaN."""
    part = (F.spark_partition_id() % _PARTS).alias("part")
    sketches = inside.groupBy(*_SPAN, part).agg(
        F.count("v").alias("inside"), F.kll_sketch_agg_double("v", _SKETCH).alias("s")
    )
    merged = sketches.groupBy(*_SPAN).agg(
        F.sum("inside").alias("inside"), F.kll_merge_agg_double("s", _SKETCH).alias("s")
    )
    at = F.array(*[F.lit(fraction) for fraction in fractions])
    cuts = F.when(F.kll_sketch_get_n_double("s") > 0, F.kll_sketch_get_quantile_double("s", at))
    return merged.select(*_SPAN, "inside", F.coalesce(cuts, F.array().cast("array<double>")).alias("cuts"))


def _with_part(values: DataFrame) -> DataFrame:
    """``part``: twice the number of ``cuts`` below ``v``, found by halving, and one more where ``v`` is a cut."""
    found, step = values.withColumn("below", F.lit(0)), 1 << (_CUTS + 1).bit_length() - 1
    while step:
        higher = F.get("cuts", F.col("below") + (step - 1)) < F.col("v")
        found, step = found.withColumn("below", F.col("below") + F.when(higher, step).otherwise(0)), step >> 1
    on_cut = F.coalesce(F.get("cuts", F.col("below")) == F.col("v"), F.lit(False))
    return found.withColumn("part", 2 * F.col("below") + on_cut.cast("int"))


def _narrowed(values: DataFrame, ranges: DataFrame, cuts: DataFrame, n: int) -> DataFrame:
    """The part between ``cuts`` of every range that holds its rank. A value that is a cut has a part of its own.

    Ranks that share a range share its counts.
    """
    v = F.col("v")
    counted = (
        _with_part(_inside(values, cuts.drop("inside"), n))
        .groupBy(*_SPAN, "part")
        .agg(F.count(v).alias("n"), F.min(v).alias("first"), F.max(v).alias("last"))
    )
    # At most as many lines per range as there are parts.
    before = F.sum("n").over(Window.partitionBy(*_SPAN).orderBy("part")) - F.col("n")
    placed = counted.withColumn("before", before).alias("p")
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"r.{c}")) for c in _SPAN]
    holds = (F.col("p.before") <= F.col("r.rank")) & (F.col("r.rank") < F.col("p.before") + F.col("p.n"))
    return placed.join(_sent(ranges, n).alias("r"), [*same, holds]).select(
        *[f"r.{c}" for c in _KEY],
        (F.col("r.rank") - F.col("p.before")).alias("rank"),
        F.col("p.n").alias("inside"),
        F.col("p.first").alias("low"),
        F.col("p.last").alias("high"),
    )


def _small_medians(rows: DataFrame, keys: Sequence[str], columns: int) -> DataFrame:
    """Medians of groups that fit a task, by sorting each.

    Rows meet before they are listed: lists made where the rows are read would hold hardly more than one row each.
    """
    lists = (
        rows.repartition(*keys)
        .groupBy(*keys)
        .agg(*[F.sort_array(F.collect_list(f"v{i}")).alias(f"s{i}") for i in range(columns)])
    )

    def median(i: int) -> Column:
        n = F.size(f"s{i}")
        low, high = (F.get(f"s{i}", F.floor((n - 1 + k) / 2).cast("int")) for k in (0, 1))
        return F.when(n > 0, (low + high) / 2).alias(f"m{i}")

    return lists.select(*keys, *[median(i) for i in range(columns)])


def _large_medians(rows: DataFrame, large: DataFrame, n: int, columns: int, in_memory_rows: int) -> DataFrame:
    """``key`` and medians of the ``n`` groups of ``large``, which have a number ``g`` each, by narrowing ranges."""
    given = [f"v{i}" for i in range(columns)]
    mine = stage(rows.join(_sent(large, n), "key").select("g", *given), "median-rows")
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(v).alias("v")) for i, v in enumerate(given)])
    values = mine.select("g", F.explode(pairs).alias("x")).select("g", "x.i", "x.v").where("v IS NOT NULL")
    none = F.lit(None).cast("double")
    whole = values.withColumns({"low": none, "high": none})
    cuts = stage(_cuts(whole, _around_middle()), "median-cuts")
    middle = F.array(*[F.struct(F.lit(k).alias("which"), F.floor((F.col("inside") - 1 + k) / 2).alias("rank")) for k in (0, 1)])
    ranges = cuts.select(*_SPAN, F.explode(middle).alias("m")).select(*_SPAN, "m.which", "m.rank")
    narrowed = stage(_narrowed(values, ranges, cuts, columns * n), "median-ranges")
    one = F.col("low").eqNullSafe(F.col("high"))
    done = (F.col("inside") <= in_memory_rows) | one
    if (wide := narrowed.where(~one).count()) > 0:
        near = _inside(values, narrowed.where(~one).select(*_SPAN).distinct(), wide)
        values = stage(near.select("g", "i", "v"), "median-values")
    known, left = [narrowed.where(done)], narrowed.where(~done)
    while (wide := left.count()) > 0:
        cuts = stage(_cuts(_inside(values, left.select(*_SPAN).distinct(), wide), _evenly()), "median-cuts")
        narrowed = stage(_narrowed(values, left, cuts, wide), "median-ranges")
        known.append(narrowed.where(done))
        left = narrowed.where(~done)
    small = known[0].select(*_KEY, "rank", "inside", "low", "high")
    for more in known[1:]:
        small = small.unionByName(more.select(*_KEY, "rank", "inside", "low", "high"))
    # A range of one value needs no look at the rows, however many there are.
    single = F.col("low").isNotNull() & F.col("low").eqNullSafe(F.col("high"))
    picked = (
        _inside(values, small.where(~single), 2 * columns * n)
        .groupBy(*_KEY, "rank")
        .agg(F.sort_array(F.collect_list("v")).alias("sorted"))
        .select(*_KEY, F.element_at("sorted", (F.col("rank") + 1).cast("int")).alias("value"))
    )
    middles = picked.unionByName(small.where(single).select(*_KEY, F.col("low").alias("value")))

    def median(i: int) -> Column:
        return F.avg(F.when(F.col("i") == i, F.col("value")))

    medians = middles.groupBy("g").agg(*[median(i).alias(f"m{i}") for i in range(columns)])
    return large.join(medians, "g", "left").drop("g")


def group_medians(
    df: DataFrame, groups: Sequence[str], columns: Sequence[str], in_memory_rows: int = IN_MEMORY_ROWS
) -> DataFrame:
    """The ``groups`` columns and the exact median of each of ``columns``, one row per group.

    Null values are left out, and a column without any other value in a group has a null median. NaN is the highest
    value. Null is a group like any other. An even number of values gives the mean of the two in the middle.

    One pass counts the rows of the groups. Groups of at most ``in_memory_rows`` rows are sorted in one more. Another one
    writes the rows of larger groups, which are read three times: for sketches, for counts around the middle and for
    the values next to it, about a thousandth of all unless values repeat. Rounds go on over these, two passes per
    factor 64 that a range has more than ``in_memory_rows`` of them. There are few large groups, so their ranges are sent
    to the values, which stay where they are; beyond ``_SENT`` ranges Spark chooses the join. The driver gets the
    number of large groups and of ranges that are left, never a group.
    """
    clash = {"g", "i", "v", "x"} & {*groups}
    if clash or not groups:
        raise ValueError("medians per group need groups" if not groups else f"columns {sorted(clash)} are used inside")
    keys = [f"k{i}" for i in range(len(groups))]
    rows = df.select(
        *[F.col(f"`{c}`").alias(k) for k, c in zip(keys, groups, strict=True)],
        *[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(columns)],
    )
    # A struct of nulls equals another one, so null is a group like any other.
    marked = rows.withColumn("key", F.struct(*keys))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > in_memory_rows)
    large = stage(sizes.select(F.struct(*keys).alias("key"), F.monotonically_increasing_id().alias("g")), "median-large")
    n, given = large.count(), len(columns)
    fitting = marked.join(_sent(large.select("key"), n), "key", "left_anti") if n else rows
    medians = _small_medians(fitting, keys, given)
    if n:
        found = _large_medians(marked, large, n, given, in_memory_rows)
        medians = medians.unionByName(found.select("key.*", *[f"m{i}" for i in range(given)]))
    return medians.select(
        *[F.col(k).alias(c) for k, c in zip(keys, groups, strict=True)],
        *[F.col(f"m{i}").alias(c) for i, c in enumerate(columns)],
    )
