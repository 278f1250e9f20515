"""The best decision threshold without the curve: branch and bound over intervals of scores.

A pass counts rows and positives in a bounded number of intervals. From the counts above an interval and inside it
follow the exact merit of its lowest score and a bound for all others in it. Intervals whose bound does not reach the
best merit seen are done with; the others are cut into smaller ones and counted again. Passes return bounded rows
and move no scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.operators.curve import DEFAULT_MIN_RECALL, NO_THRESHOLD

INTERVALS = 4_096  # that a pass counts in
_ROUNDING = 1e-12  # by which equal F1 may differ
_FLIP = np.int64(0x7FFFFFFFFFFFFFFF)
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


def _codes(scores: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the scores; NaN is the highest one, and both zeros are one."""
    plain = np.where(scores == 0, 0.0, scores)
    plain[np.isnan(plain)] = np.nan
    bits = plain.view(np.int64)
    return np.where(bits < 0, bits ^ _FLIP, bits)


def _score_of(code: int) -> float:
    bits = np.array([code], dtype=np.int64)
    return float(np.where(bits < 0, bits ^ _FLIP, bits).view(np.float64)[0])


@dataclass(frozen=True)
class _Interval:
    """Scores between two codes that both occur, with the rows and positives inside and above."""

    least: int
    most: int
    rows: int
    positives: int
    rows_above: int
    positives_above: int


def _count(scored: DataFrame, starts: list[int], ends: list[int]) -> dict[int, tuple[int, int, int, int]]:
    """Per interval that holds rows: rows, positives, lowest and highest code. The intervals ascend and do not meet."""
    first, last = np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, positives = np.zeros(len(first), dtype=np.int64), np.zeros(len(first), dtype=np.int64)
        least, most = np.full(len(first), _HIGHEST), np.full(len(first), _LOWEST)
        for batch in batches:
            code = _codes(batch.column(0).to_numpy(zero_copy_only=False))
            positive = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            at = np.searchsorted(first, code, side="right") - 1
            inside = (at >= 0) & (code <= last[at])
            at, code = at[inside], code[inside]
            rows += np.bincount(at, minlength=len(first))
            positives += np.bincount(at[positive[inside]], minlength=len(first))
            np.minimum.at(least, at, code)
            np.maximum.at(most, at, code)
        used = np.flatnonzero(rows)
        columns = [used, rows[used], positives[used], least[used], most[used]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["at", "n", "pos", "least", "most"])

    counted = scored.mapInArrow(count, "at long, n long, pos long, least long, most long").groupBy("at")
    found = counted.agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.min("least").alias("least"), F.max("most").alias("most")
    )
    return {r["at"]: (r["n"], r["pos"], r["least"], r["most"]) for r in found.collect()}


@dataclass(frozen=True)
class _Merit:
    """What makes a threshold good, for its hits and the rows it predicts as positive."""

    strategy: str
    positives: int
    min_recall: float

    def recall(self, hits: int) -> float:
        return hits / self.positives if self.positives else 1.0

    def of(self, hits: int, predicted: int) -> tuple[bool, float]:
        precision, recall = hits / predicted, self.recall(hits)
        if self.strategy == "f1":
            return True, 2 * precision * recall / (precision + recall) if precision + recall > 0 else 0.0
        enough = recall >= self.min_recall
        return enough, precision if enough else recall

    def open(self, interval: _Interval, best: tuple) -> bool:
        """Whether a score above the interval's lowest one may be better than the best seen, or as good and lower."""
        if interval.least == interval.most:
            return False
        # At best all positives lie above all other rows.
        enough, value = self.bound(interval)
        (best_enough, best_value), lowest = best[0], best[1]
        if enough != best_enough:
            return enough
        slack = _ROUNDING if self.strategy == "f1" and self.positives else 0.0
        if slack:
            return value >= best_value - slack
        return value > best_value or (value == best_value and interval.least < -lowest)

    def bound(self, interval: _Interval) -> tuple[bool, float]:
        hits = interval.positives_above + interval.positives
        return self.of(hits, interval.rows_above + max(interval.positives, 1))


def _split(chosen: list[_Interval], parts: int) -> tuple[list[int], list[int], list[_Interval]]:
    """Each interval in ``parts`` of about equal width, ascending, and the interval that each part comes from."""
    starts, ends, parents = [], [], []
    for interval in sorted(chosen, key=lambda i: i.least):
        width = interval.most - interval.least + 1
        cuts = sorted({interval.least + width * k // parts for k in range(parts)})
        starts += cuts
        ends += [*(c - 1 for c in cuts[1:]), interval.most]
        parents += [interval] * len(cuts)
    return starts, ends, parents


def best_threshold(
    df: DataFrame,
    actual: str,
    score: str,
    strategy: str = "f1",
    min_recall: float = DEFAULT_MIN_RECALL,
    intervals: int = INTERVALS,
) -> DataFrame:
    """One row ``threshold, precision, recall``. Use validation rows, never test rows.

    "f1" takes the highest F1; "min_recall" the highest precision among points that reach the
    minimum recall, or the highest recall if none does. The lowest threshold wins ties. Rows without a score are
    left out; without any the threshold is 0.5. The result is that of picking a point of the whole curve.

    The scores are read once per pass, a few times in all, and stay where they are; a pass returns at most ``intervals``
    rows. If more intervals are open, those with the best bounds go first and often settle the others.
    """
    if strategy not in ("f1", "min_recall"):
        raise ValueError(f"strategy '{strategy}' is neither 'f1' nor 'min_recall'")
    if intervals < 2:
        raise ValueError("a pass needs two intervals at least")
    positive = F.coalesce(F.col(actual).cast("int") == 1, F.lit(False)).alias("positive")
    scored = df.where(F.col(score).isNotNull()).select(F.col(score).cast("double").alias("score"), positive)
    everything = _Interval(_LOWEST, _HIGHEST, 0, 0, 0, 0)
    left, chosen, parts = [], [everything], intervals
    merit = best = None
    while chosen:
        starts, ends, parents = _split(chosen, parts)
        counted = _count(scored, starts, ends)
        if merit is None:
            merit = _Merit(strategy, sum(c[1] for c in counted.values()), min_recall)
        # From the highest score down, what lies above grows by what is passed.
        parent, rows, positives = None, 0, 0
        for at in sorted(counted, reverse=True):
            if parents[at] is not parent:
                parent = parents[at]
                rows, positives = parent.rows_above, parent.positives_above
            n, pos, least, most = counted[at]
            part = _Interval(least, most, n, pos, rows, positives)
            rows, positives = rows + n, positives + pos
            point = (merit.of(positives, rows), -least, positives, rows)
            best = point if best is None else max(best, point)
            left.append(part)
        if best is None:
            break
        left = sorted((i for i in left if merit.open(i, best)), key=merit.bound)
        chosen, left = left[-(intervals // 2) :], left[: -(intervals // 2)]
        parts = max(2, intervals // max(len(chosen), 1))
    if best is None:
        row = (NO_THRESHOLD, 0.0, 0.0)
    else:
        _, lowest, hits, predicted = best
        row = (_score_of(-lowest), hits / predicted, merit.recall(hits))
    return df.sparkSession.createDataFrame([row], "threshold double, precision double, recall double")
