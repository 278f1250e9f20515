"""Exact medians of many columns without sorting or shuffling the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IN_MEMORY_ROWS = 100_000  # values picked directly, over all columns together
_SKETCH = 8_000
_MARGIN = 1e-3  # of the rank, on either side of what a sketch says
_GROUPS = 1_024  # tasks are merged in so many groups before the groups are
_SEPARATE = 32  # picks that share a pass


@dataclass
class _Selection:
    """Search for the value at one rank of one column, inside an open interval."""

    column: str
    rank: int  # from 0, among the values inside the interval
    inside: int
    low: float | None = None
    high: float | None = None
    answer: float | None = None

    def values(self) -> Column:
        v = F.col(self.column).cast("double")
        within = v.isNotNull()
        if self.low is not None:
            within = within & (v > F.lit(self.low))
        if self.high is not None:
            within = within & (v < F.lit(self.high))
        return F.when(within, v)

    def narrow(self, low: float, high: float, c: dict[str, int]) -> None:
        """Keep the one of five zones (below, at low, between, at high, above) holding the rank."""
        zones = [
            (c["below"], self.low, low, None),
            (c["at_low"], None, None, low),
            (c["between"], low, high, None),
            (c["at_high"], None, None, high),
            (self.inside - sum(c.values()), high, self.high, None),
        ]
        for count, zone_low, zone_high, value in zones:
            if self.rank < count:
                self.low, self.high, self.inside, self.answer = zone_low, zone_high, count, value
                return
            self.rank -= count
        raise AssertionError(f"rank outside column '{self.column}'; did the input change between passes?")


def _around(df: DataFrame, wanted: Sequence[tuple[Column, float]]) -> list[tuple[int, float, float]]:
    """Per (values, fraction) the number of values, and values a little below and above that fraction.

    Tasks are merged group by group, then the groups column by column, so no task sees the sketches
    of all tasks or of all columns. The driver gets one row per column. A sketch leaves NaN out; where there is
    nothing else, both values are NaN.
    """
    group = (F.spark_partition_id() % _GROUPS).alias("g")
    first = [
        f for i, (v, _) in enumerate(wanted) for f in (F.count(v).alias(f"n{i}"), F.kll_sketch_agg_double(v, _SKETCH).alias(f"s{i}"))
    ]
    lines = F.explode(
        F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("s")) for i in range(len(wanted))])
    )
    merged = (
        df.groupBy(group)
        .agg(*first)
        .select(lines.alias("line"))
        .groupBy("line.i")
        .agg(F.sum("line.n").alias("n"), F.kll_merge_agg_double("line.s", _SKETCH).alias("s"))
    )

    def value(shift: float) -> Column:
        """The rank must be a constant, so there is a case for each one that occurs."""
        chosen = F.lit(float("nan"))
        filled = F.kll_sketch_get_n_double("s") > 0
        for fraction in sorted({f for _, f in wanted}):
            of_fraction = F.col("i").isin([i for i, (_, f) in enumerate(wanted) if f == fraction])
            rank = F.lit(min(max(fraction + shift, 0.0), 1.0))
            chosen = F.when(filled & of_fraction, F.kll_sketch_get_quantile_double("s", rank)).otherwise(chosen)
        return chosen

    rows = merged.select("i", "n", value(-_MARGIN).alias("low"), value(_MARGIN).alias("high")).collect()
    found = {r["i"]: (r["n"], r["low"], r["high"]) for r in rows}
    return [found.get(i, (0, float("nan"), float("nan"))) for i in range(len(wanted))]


def _count_zones(df: DataFrame, selections: list[_Selection], brackets: list[tuple[float, float]]) -> None:
    """Exact counts around each bracket, and the step into the zone that holds the rank."""
    counts = []
    for i, (s, (low, high)) in enumerate(zip(selections, brackets)):
        v = s.values()
        zones = {
            "below": v < F.lit(low),
            "at_low": v == F.lit(low),
            "between": (v > F.lit(low)) & (v < F.lit(high)),
            "at_high": (v == F.lit(high)) & F.lit(low != high),
        }
        counts += [F.count_if(zone).alias(f"{i}_{name}") for name, zone in zones.items()]
    row = df.agg(*counts).first().asDict()
    for i, (s, (low, high)) in enumerate(zip(selections, brackets)):
        s.narrow(low, high, {z: row[f"{i}_{z}"] for z in ("below", "at_low", "between", "at_high")})


def exact_medians(
    df: DataFrame,
    columns: Sequence[str],
    in_memory_rows: int = IN_MEMORY_ROWS,
    also: Mapping[str, Column] | None = None,
) -> tuple[dict[str, float | None], dict]:
    """Median of the non-null values of each column, and the ``also`` aggregates from the first pass.

    The first pass counts the values and sketches where the middle is. Then exact counts decide on
    which side of the sketched values the median lies. What is left between them is about 2e-3 of
    the values, and a value that repeats often is met as one of them, so even 10^12 rows need three
    rounds. Once few values are left they are picked directly, ``in_memory_rows`` at most over all
    columns of a pass. Every pass returns one row per column at most.
    """
    also = dict(also or {})
    row = df.agg(*[column.alias(f"also_{name}") for name, column in also.items()]).first().asDict() if also else {}
    middles = _around(df, [(F.col(c).cast("double"), 0.5) for c in columns]) if columns else []

    selections: dict[str, list[_Selection]] = {}
    brackets: list[tuple[float, float]] = []
    for i, c in enumerate(columns):
        n = middles[i][0]
        ranks = sorted({(n - 1) // 2, n // 2}) if n else []
        selections[c] = [_Selection(c, rank, n) for rank in ranks]
        brackets += [middles[i][1:]] * len(ranks)
    every = [s for found in selections.values() for s in found]

    picked_directly = max(1, in_memory_rows // max(1, min(len(every), _SEPARATE)))

    def wide(s: _Selection) -> bool:
        return s.answer is None and s.inside > picked_directly

    first_round = [(s, b) for s, b in zip(every, brackets) if wide(s)]
    if first_round:
        _count_zones(df, *map(list, zip(*first_round)))
    while left := [s for s in every if wide(s)]:
        found = _around(df, [(s.values(), (s.rank + 0.5) / s.inside) for s in left])
        _count_zones(df, left, [(low, high) for _, low, high in found])
    small = [s for s in every if s.answer is None]
    for at in range(0, len(small), _SEPARATE):
        together = small[at : at + _SEPARATE]
        picks = [
            F.element_at(F.sort_array(F.collect_list(s.values())), s.rank + 1).alias(str(i))
            for i, s in enumerate(together)
        ]
        for s, value in zip(together, df.agg(*picks).first(), strict=True):
            s.answer = value
    medians = {c: sum(s.answer for s in found) / len(found) if found else None for c, found in selections.items()}
    return medians, {name: row[f"also_{name}"] for name in also}
