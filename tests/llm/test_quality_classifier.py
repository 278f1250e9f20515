"""The positive-unlabelled classifier: features, risk, prior and accuracy against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import SCHEMA, corpus, frame, prose

from tabweave.llm import text_shape
from tabweave.llm.quality_classifier import (
    RIDGE,
    classify_quality,
    estimate_prior,
    minimise,
    prior_from_counts,
    risk_at,
    shape_table,
    trusted_ids,
)
from tabweave.llm.text_shape import COUNTED, FEATURES, TRIGRAMS, count_column, features_of

MARKS = b".,;:!?'\"()-"


def plain_counts(text: bytes):
    def kind(b):
        if b >= 128:
            return 8
        c = chr(b)
        if c.isalnum():
            return 0 if c.islower() else 1 if c.isupper() else 2
        if c in "\t\x0b\x0c\r ":
            return 3
        return 4 if c == "\n" else 5 if b in MARKS else 7 if b < 32 or b == 127 else 6

    out = [0] * COUNTED
    for b in text:
        out[kind(b)] += 1
    words = text.split()
    kinds = [[kind(b) for b in w] for w in words]
    lettered = [any(k in (0, 1, 2, 8) for k in w) for w in kinds]
    out[9] = len(words)
    out[10] = sum(a == b for a, b in zip(words, words[1:]))
    out[11] = sum(len(set(words[i : i + text_shape.WINDOW])) for i in range(0, len(words), text_shape.WINDOW))
    out[12] = sum(1 in w and 0 not in w and len(w) > 1 for w in kinds)
    out[13] = lettered.count(False)
    out[14] = sum(has and w[-1] == 5 for w, has in zip(kinds, lettered, strict=True))
    out[15] = sum(has and w[-1] in (6, 7) for w, has in zip(kinds, lettered, strict=True))
    out[16] = sum(len(w) > text_shape.LONG_WORD for w in words)
    lines = [line for line in text.split(b"\n") if line.split()]
    out[17], out[18] = len(lines), len(lines) - len(set(lines))
    for a, b, c in zip(text, text[1:], text[2:]):
        out[19 + (((a << 16 | b << 8 | c) * 0x9E3779B1 & 0xFFFFFFFF) >> 26) % TRIGRAMS] += 1
    return out


def texts(n=200, seed=3):
    rng = random.Random(seed)
    fixed = [None, "", "a", " \n", "aB cd CD.\nx  y\n\nx  y\n#", "é ü é ü", "a\x0bb\x0c a a a", "X" * 60]
    return fixed + ["".join(rng.choice("ab AB\n.#1é\x7f") for _ in range(rng.randrange(300))) for _ in range(n)]


def test_counts():
    column = pa.array(texts())
    expected = np.array([plain_counts((t or "").encode()) for t in texts()])
    assert (count_column(column) == expected).all()
    assert (count_column(column.slice(3, 50)) == expected[3:53]).all()
    assert count_column(pa.array([], pa.string())).shape == (0, COUNTED)
    assert features_of(expected).shape == (len(expected), FEATURES) and np.isfinite(features_of(expected)).all()


def test_long_texts_are_counted_in_pieces(monkeypatch):
    rng = random.Random(1)
    text = prose(rng, 4_000)
    whole = count_column(pa.array(["b", text, "a"]))
    monkeypatch.setattr(text_shape, "PIECE", 1_000)
    cut = count_column(pa.array(["b", text, "a"]))
    exact = [*range(9), 9, 12, 13, 14, 15, 16]
    assert (cut[:, exact] == whole[:, exact]).all() and (cut[[0, 2]] == whole[[0, 2]]).all()
    assert abs(cut[1, 19:].sum() - whole[1, 19:].sum()) < 100
    assert count_column(pa.array(["x" * 5_000]))[0, 0] == 5_000


def plain_risk(x, half, weights, prior, halves):
    f = x @ weights
    good = np.isin(half, halves)
    negative = np.logaddexp(0, f).mean() - prior * np.logaddexp(0, f[good]).mean()
    return prior * np.logaddexp(0, -f[good]).mean() + max(0, negative) + RIDGE / good.sum() / 2 * (weights[1:] ** 2).sum()


@pytest.fixture(scope="module")
def mixture(spark):
    """Good prose and three kinds of bad text; a third of the good documents are trusted."""
    rng = random.Random(8)
    rows, good = [], []
    for i in range(600):
        text = prose(rng, rng.randrange(20, 80))
        bad = i % 5 == 0
        if bad:
            text = [text.upper() + "!!", " | ".join(text.split()), " ".join(w for w in text.split()[:9] for _ in range(9))][i % 3]
        rows.append((i, text, None, None, None))
        if not bad:
            good.append(i)
    trusted = [i for i in good if i % 3 == 0]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    ids = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
    table = shape_table(docs, ids).cache()
    return docs, ids, table, set(good)


def plain_table(table):
    rows = table.collect()
    return np.array([r.x for r in rows], dtype=np.float64), np.array([-1 if r.half is None else r.half for r in rows])


def test_risk_and_its_gradients(spark, mixture):
    x, half = plain_table(mixture[2])
    rng = np.random.default_rng(0)
    for prior, size in ((0.5, 0.1), (0.95, 2.0)):
        weights = rng.normal(size=FEATURES) * size
        risk = risk_at(mixture[2], weights, prior, (0, 1))
        assert risk.value == pytest.approx(plain_risk(x, half, weights, prior, (0, 1)), abs=1e-6)
        active = risk.gradients[1 if risk.negative > 0 else 0]
        for k in range(0, FEATURES, 9):
            step = np.eye(FEATURES)[k] * 1e-5
            slope = (plain_risk(x, half, weights + step, prior, (0, 1)) - plain_risk(x, half, weights - step, prior, (0, 1))) / 2e-5
            assert active[k] == pytest.approx(slope, abs=1e-5)


@pytest.mark.parametrize("prior", [0.7, 0.97])
def test_minimum(spark, mixture, prior):
    """No nearby weights have a smaller risk, also where both parts of the risk are equal (prior too high)."""
    x, half = plain_table(mixture[2])
    weights = minimise(mixture[2], prior, (0, 1), np.zeros(FEATURES))
    least = plain_risk(x, half, weights, prior, (0, 1))
    assert least < plain_risk(x, half, np.zeros(FEATURES), prior, (0, 1)) - 0.05
    rng = np.random.default_rng(2)
    around = [plain_risk(x, half, weights + rng.normal(size=FEATURES) * s, prior, (0, 1)) for s in (1e-3, 1e-2, 0.1) for _ in range(50)]
    assert min(around) > least - 1e-4


def test_prior(spark, mixture):
    first = minimise(mixture[2], 0.5, (0,), np.zeros(FEATURES))
    x, half = plain_table(mixture[2])
    f = x @ first
    estimate = estimate_prior(mixture[2], first, 1)
    assert 0.5 < estimate < 0.85  # 0.8 are good; the estimate is a lower bound
    cuts = np.unique(f)
    ratios = [(f >= c).mean() / (f[half == 1] >= c).mean() for c in cuts if (f[half == 1] >= c).any()]
    assert estimate < min(ratios) + 0.05
    assert prior_from_counts(np.array([5.0, 5.0]), np.zeros(2)) == 0.5
    many = prior_from_counts(np.array([2e7, 8e7]), np.array([0.0, 1e7]))
    assert many == pytest.approx(0.8, abs=1e-3)


def test_scores(spark, mixture):
    docs, ids, _, good = mixture
    scored, model = classify_quality(docs, ids)
    found = {r.doc_id: r.score for r in scored.collect()}
    assert set(found) == set(range(600)) and all(0 <= s <= 1 for s in found.values())
    assert np.mean([(s >= 0.3) == (i in good) for i, s in found.items()]) > 0.98
    assert {i: pytest.approx(s, abs=1e-6) for i, s in found.items()} == {r.doc_id: r.score for r in classify_quality(docs.repartition(7), ids)[0].collect()}


@pytest.mark.parametrize("clashing", [False, True])
def test_awkward_documents(spark, clashing):
    rows = corpus()
    docs = frame(spark, rows, clashing)
    if clashing:
        docs = docs.selectExpr("*", "1 AS x", "2 AS half", "3 AS score")
    trusted = spark.createDataFrame([(i,) for i in (30, 60, 63, 66, 90, 93, 30, None)], "doc_id long")
    scored, _ = classify_quality(docs, trusted)
    found = scored.collect()
    assert sorted((r.doc_id for r in found), key=str) == sorted((r[0] for r in rows), key=str)
    assert all(0 <= r.score <= 1 for r in found)


def test_nothing_trusted_and_nothing_to_score(spark):
    none = spark.createDataFrame([], "doc_id long")
    scored, model = classify_quality(frame(spark, corpus()), none)
    assert {r.score for r in scored.collect()} == {0.5} and model.prior is None
    ids = spark.createDataFrame([(1,)], "doc_id long")
    assert classify_quality(spark.createDataFrame([], SCHEMA), ids)[0].collect() == []


def test_trusted_ids(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (3, 0), (None, 1), (4, None), (5, 1), (5, 1)], "doc_id long, quality int")
    assert sorted(r.doc_id for r in trusted_ids(labels).collect()) == [1, 5]
