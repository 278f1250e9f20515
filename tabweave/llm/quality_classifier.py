"""Quality classifier by positive-unlabelled learning.

Trusted documents are the positives, all documents the unlabelled text. A linear model on the shape of texts minimises
the non-negative unbiased risk: with loss l and prior p, p E+[l(f)] + max(0, E[l(-f)] - p E+[l(-f)]).
With the logistic loss this is the larger of two convex functions, which Newton steps minimise; each step is one pass
over all documents' features that returns sums only. The prior is estimated from scores of trusted documents
that the first model has not seen: where the best share of them lies, unlabelled text can hardly be denser.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.llm.text_shape import FEATURES, count_column, features_of
from tabweave.storage import stage

FIRST_PRIOR = 0.5  # of the model whose scores give the estimate
RIDGE = 0.1  # a weight's square counts this much against the sum of one trusted document's losses
STEPS = 40  # passes that a fit may take; it ends before when a step gains next to nothing
SMALL_GAIN = 1e-6
HALVINGS = 8
BINS = 4096  # of scores, for the estimate
BIN_RANGE = 64.0
CONFIDENCE = 0.1
_UNIT = float(1 << 24)  # sums travel as whole numbers, so that their order does not matter


@dataclass(frozen=True)
class QualityModel:
    """Weights of the features and the share of good documents; no weights if nothing was trusted."""

    weights: np.ndarray | None
    prior: float | None

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), 0.5) if self.weights is None else _sigmoid(x @ self.weights)


def _sigmoid(f: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(f / 2))


def _softplus(f: np.ndarray) -> np.ndarray:
    return np.maximum(f, 0) + np.log1p(np.exp(-np.abs(f)))


def shape_table(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, x, half``: features of every document; ``half`` is 0 or 1 for trusted ones, else null.

    ``trusted`` has one row per id in ``id_col``. Texts are read once and do not move, their features do. The ids are
    written first, so that the join sees their size and can split an id with many documents.
    """

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                x = features_of(count_column(batch.column(1))).astype(np.float32)
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * FEATURES)
                rows = pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), rows], ["doc_id", "x"])

    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    ids = trusted.select(F.col(f"`{id_col}`").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    halves = stage(ids.withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")), "trusted")
    return given.mapInArrow(shape, "doc_id long, x array<float>").join(halves, "doc_id", "left")


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index(name)).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, FEATURES).astype(np.float64)


@dataclass(frozen=True)
class Risk:
    """The risk at some weights, its two convex parts, their gradients and the curvature of unlabelled text."""

    weights: np.ndarray
    value: float
    negative: float
    gradients: tuple[np.ndarray, np.ndarray]
    curvature: np.ndarray

    def direction(self, at_kink: bool = False) -> np.ndarray:
        """A Newton step down; where the parts are about equal, along the shortest mixture of their gradients."""
        first, second = (np.linalg.solve(self.curvature, g) for g in self.gradients)
        if not at_kink:
            return -(second if self.negative > 0 else first)
        apart, along = self.gradients[1] - self.gradients[0], second - first
        share = float(np.clip(-(apart @ first) / max(apart @ along, 1e-300), 0.0, 1.0))
        return -(first + share * along)


def risk_at(table: DataFrame, weights: np.ndarray, prior: float, halves: tuple[int, ...]) -> Risk | None:
    """One pass over ``table``; the driver gets one line per sum. Null without trusted documents in ``halves``."""
    d = FEATURES

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(5 + 3 * d + d * d)
        for batch in batches:
            x = _matrix(batch)
            half = pa.compute.fill_null(batch.column(1), -1).to_numpy(zero_copy_only=False)
            f = x @ weights
            s = _sigmoid(f)
            good = np.isin(half, halves)
            total[:5] += [len(x), _softplus(f).sum(), good.sum(), _softplus(-f[good]).sum(), _softplus(f[good]).sum()]
            total[5 : 5 + 3 * d] += np.concatenate([s @ x, x[good].sum(axis=0), s[good] @ x[good]])
            total[5 + 3 * d :] += ((x * (s * (1 - s))[:, None]).T @ x).ravel()
        values = np.rint(total * _UNIT).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["place", "value"])

    added = table.select("x", "half").mapInArrow(add, "place long, value long")
    sums = added.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    total = np.zeros(5 + 3 * d + d * d)
    total[sums["place"].to_numpy()] = sums["value"].to_numpy() / _UNIT
    rows, loss, trusted, loss_good, loss_not_good = total[:5]
    if not trusted:
        return None
    expected, mean, expected_good = total[5 : 5 + 3 * d].reshape(3, d) / np.array([[rows], [trusted], [trusted]])
    ridge = RIDGE / trusted
    shrink = ridge * np.concatenate([[0.0], weights[1:]])
    negative = loss / rows - prior * loss_not_good / trusted
    positive = prior * loss_good / trusted
    at_zero = prior * (expected_good - mean) + shrink  # gradient of the positive part, l(f) alone
    return Risk(
        weights,
        positive + max(0.0, negative) + ridge / 2 * float(weights[1:] @ weights[1:]),
        negative,
        (at_zero, expected - prior * mean + shrink),
        total[5 + 3 * d :].reshape(d, d) / rows + ridge * np.eye(d),
    )


def minimise(table: DataFrame, prior: float, halves: tuple[int, ...], start: np.ndarray, steps: int = STEPS) -> np.ndarray | None:
    """Weights of least risk, by Newton steps that are halved until the risk falls; null without trusted documents."""
    best, weights, mixed = None, start, False
    size, direction = 1.0, np.zeros_like(start)
    for _ in range(steps):
        risk = risk_at(table, weights, prior, halves)
        if risk is None:
            return None
        if best is None or risk.value < best.value:
            gain = math.inf if best is None else best.value - risk.value
            best, mixed, size, direction = risk, False, 1.0, risk.direction()
            if gain < SMALL_GAIN:
                break
        elif not mixed and risk.negative * best.negative < 0:  # the step went past the place where the parts are equal
            mixed, size, direction = True, 1.0, best.direction(at_kink=True)
        else:
            size /= 2
            if size < 0.5**HALVINGS:
                break
        weights = best.weights + size * direction
    return best.weights


def estimate_prior(table: DataFrame, weights: np.ndarray, half: int) -> float:
    """Share of good documents, from the scores of all documents and of trusted ones that ``weights`` have not seen.

    Above any cut, all text is at least as frequent as the share times the frequency of good documents, so
    every cut bounds the share from above. See :func:`prior_from_counts`.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, BINS), dtype=np.int64)
        for batch in batches:
            f = np.clip(_matrix(batch) @ weights, -BIN_RANGE, BIN_RANGE)
            at = np.minimum(((f + BIN_RANGE) * (BINS / (2 * BIN_RANGE))).astype(np.int64), BINS - 1)
            mine = pa.compute.fill_null(batch.column(1), -1).to_numpy(zero_copy_only=False) == half
            found += [np.bincount(at, minlength=BINS), np.bincount(at[mine], minlength=BINS)]
        used = np.flatnonzero(found[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(f[used]) for f in found]], ["bin", "n", "good"])

    counted = table.select("x", "half").mapInArrow(count, "bin long, n long, good long").groupBy("bin")
    sums = counted.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).toArrow()
    n, good = np.zeros(BINS), np.zeros(BINS)
    n[sums["bin"].to_numpy()], good[sums["bin"].to_numpy()] = sums["n"].to_numpy(), sums["good"].to_numpy()
    return prior_from_counts(n, good)


def prior_from_counts(n: np.ndarray, good: np.ndarray) -> float:
    """The estimate from documents and trusted documents per bin of scores, ascending.

    The cut whose ratio of frequencies, widened by the confidence of both, is least gives a ratio. The estimate is its
    lower confidence bound, at least half of it: a prior that is too high makes bad documents good, while one that
    is too low only makes scores of good ones smaller. The more documents, the nearer the two.
    """
    if not good.sum():
        return FIRST_PRIOR
    above, good_above = (np.cumsum(c[::-1])[::-1] / c.sum() for c in (n, good))
    spread = sum(math.sqrt(math.log(4 / CONFIDENCE) / (2 * c.sum())) for c in (n, good))
    usable = np.flatnonzero(good_above > 0)
    bound = (above[usable] + spread) / good_above[usable]
    at = usable[np.argmin(bound)]
    ratio = min(above[at] / good_above[at], 1.0)
    return float(max(ratio - spread / good_above[at], ratio / 2))


def fit_quality(table: DataFrame) -> QualityModel:
    """Prior and weights from a written table of :func:`shape_table`, without any labels but the trusted marks."""
    first = minimise(table, FIRST_PRIOR, (0,), np.zeros(FEATURES))
    if first is None:  # no trusted document in this half; the other one may have some
        last = minimise(table, FIRST_PRIOR, (0, 1), np.zeros(FEATURES))
        return QualityModel(last, None if last is None else FIRST_PRIOR)
    prior = estimate_prior(table, first, 1)
    return QualityModel(minimise(table, prior, (0, 1), first), prior)


def classify_quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, QualityModel]:
    """``doc_id, score`` of every document, and the model; ``trusted`` holds ids of good documents.

    The score estimates how likely a document is good, from its text alone. A null text is empty and scored like
    one; null ids are never trusted; repeated rows and ids are rows of their own, all trusted if the id is. Without
    trusted documents every score is 0.5. Empty tables give no rows. Other columns are not read.

    Every fit covers all documents and all trusted ids. One pass over the texts makes features, which are written
    (some 90 numbers per document); each Newton step reads those.
    """
    table = stage(shape_table(docs, trusted, id_col, text_col), "shapes")
    model = fit_quality(table)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(_matrix(batch)))], ["doc_id", "score"])

    return table.select("doc_id", "x").mapInArrow(score, "doc_id long, score double"), model


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids whose labels all say 1; an id with both labels is not trusted, a null label says nothing."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    return known.groupBy("doc_id").agg(F.min("quality").alias("least")).where("least = 1").select("doc_id")
