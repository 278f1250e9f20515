"""Vector codes and their cover trees against plain nearest entries."""

import hashlib
import math
import random

import numpy as np
import pytest

from tabweave.llm import vector_codes
from tabweave.llm.vector_codes import Forest, build_forest, codes_of, compress_vectors, entry_sums, settle, with_label_error

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_codes(rows, parts=2, entries=3, rounds=2, scale=256):
    """Codes, errors and label errors by id and label, and the digest of the codebooks."""
    usable = [(i, [math.floor(scale * x) for x in v], c) for i, v, c in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(usable[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in usable]
    first = sorted(range(len(usable)), key=lambda k: (usable[k][0] is None, usable[k][0] or 0, usable[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def nearest(v, book):
        squares = [sum((a - b) ** 2 for a, b in zip(v, e, strict=True)) for e in book]
        return squares.index(min(squares)), min(squares)

    for _ in range(rounds):
        for p in range(parts):
            owned = [[] for _ in books[p]]
            for c in cut:
                owned[nearest(c[p], books[p])[0]].append(c[p])
            books[p] = [[sum(x) // len(o) for x in zip(*o)] if o else e for o, e in zip(owned, books[p], strict=True)]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(square for _, square in f) for f in found]
    of_label = {}
    for (_, _, label), e in zip(usable, errors, strict=True):
        of_label[label] = of_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    lines = [(i, "".join(f"{k:02x}" for k, _ in f), e, of_label[label]) for (i, _, label), f, e in zip(usable, found, errors, strict=True)]
    return sorted(lines, key=repr), digest


def awkward(n=300, width=6, seed=4):
    rng = random.Random(seed)
    rows = [(i * 7 % 311, [rng.gauss(0, 0.4) for _ in range(width)], rng.choice([None, 1, 2, 3])) for i in range(n)]
    rows = [(i, [float(np.float32(x)) for x in v], c) for i, v, c in rows]
    same = rows[5]
    rows += [same] * 150 + [(900 + k, same[1], None) for k in range(40)]  # a group of copies, ids repeated or not
    rows += [(2, None, 1), (3, [None] * width, 2), (4, [0.5] * (width - 1) + [float("nan")], 1), (5, [float("inf")] + [0.0] * (width - 1), None)]
    return rows + [(None, [0.25] * width, 2), (None, [-0.25] * width, None)]


def result(codes):
    return sorted(((r.id, r.code, r.error, r.label_error) for r in with_label_error(codes).collect()), key=repr)


@pytest.mark.parametrize("clashing", [False, True])
def test_codes(spark, clashing):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if clashing:
        df = df.selectExpr("*", "1 AS id", "2 AS whole", "3 AS code", "4 AS error", "5 AS label_error", "6 AS __label")
    codes, books = compress_vectors(df, parts=2, entries=9)
    expected, digest = plain_codes(rows, entries=9)
    assert result(codes) == expected and books.sha256() == digest


def test_fewer_vectors_than_entries_and_none(spark):
    rows = [(1, [0.1, 0.2], 1), (1, [0.1, 0.2], 1), (0, [-3.0, 0.0], None)]
    codes, books = compress_vectors(spark.createDataFrame(rows, SCHEMA), parts=2, entries=64)
    expected, digest = plain_codes(rows, entries=64)
    assert result(codes) == expected and books.sha256() == digest
    codes, books = compress_vectors(spark.createDataFrame([(1, None, 1)], SCHEMA))
    assert result(codes) == [] and books.entries.size == 0


def test_wrong_vectors_are_refused(spark):
    for rows in ([(1, [0.1, 0.2], 1), (2, [0.1] * 4, 1)], [(1, [0.1] * 3, 1)]):
        with pytest.raises(ValueError, match="components"):
            compress_vectors(spark.createDataFrame(rows, SCHEMA), parts=2)
    with pytest.raises(Exception, match="beyond"):
        compress_vectors(spark.createDataFrame([(1, [1e30, 0.0], 1)], SCHEMA), parts=2)[0].collect()


@pytest.mark.parametrize(("parts", "rows", "width", "entries", "spread"), [(3, 400, 4, 16, 30), (1, 500, 24, 20, 9), (2, 60, 1, 5, 2), (1, 1, 2, 1, 3), (2, 40, 3, 4, 0)])
def test_trees(parts, rows, width, entries, spread):
    rng = np.random.default_rng(rows)
    points = rng.integers(-spread, spread + 1, (parts, rows, width))
    points[:, : rows // 3] = points[:, :1]
    books = points[:, rng.choice(rows, min(entries, rows), replace=False)]
    forest = Forest.unpack(build_forest(points).pack(), width)
    square = ((points[:, :, None] - books[:, None]) ** 2).sum(axis=-1)
    codes, errors = codes_of(forest, books)
    assert (codes == square.argmin(axis=-1).T).all() and (errors == square.min(axis=-1).sum(axis=0)).all()
    counts, sums = entry_sums(forest, books)
    for p in range(parts):
        for e in range(books.shape[1]):
            mine = points[p][square[p].argmin(axis=1) == e]
            at = p * books.shape[1] + e
            assert counts[at] == len(mine) and (sums[at] == mine.sum(axis=0)).all()
    for v in range(len(forest.start)):
        below = forest.points[forest.order[forest.start[v] : forest.start[v] + forest.size[v]]]
        far = ((below - below[0]) ** 2).sum(axis=1).max()
        assert forest.radius[v] == math.sqrt(far) and (forest.sums[v] == below.sum(axis=0)).all()
        children = range(forest.child[v], forest.child[v] + forest.children[v])
        if children:
            centres = forest.points[forest.order[forest.start[list(children)]]]
            apart = ((centres[:, None] - centres) ** 2).sum(axis=-1)[np.triu_indices(len(centres), 1)]
            half = 4.0 ** (math.ceil(math.log2(far) / 2) - 1)
            assert (apart > half).all() and all(forest.radius[c] ** 2 <= half + 1e-6 for c in children)
            assert forest.size[list(children)].sum() == forest.size[v]


def test_whole_subtrees_are_assigned():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-50, 50, (1, 500, 4)) + 10_000 * k for k in range(3)], axis=1)
    settled = settle(build_forest(points), points[:, [0, 500, 1000]])
    assert len(settled.points) == 0 and len(settled.nodes) < 10


def test_forests_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "FOREST_ROWS", 50)
    rows = awkward()
    codes, _ = compress_vectors(spark.createDataFrame(rows, SCHEMA).coalesce(1), parts=2, entries=9)
    assert result(codes) == plain_codes(rows, entries=9)[0]
