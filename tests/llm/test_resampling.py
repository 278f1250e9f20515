"""Importance resampling and the radix sort behind it, against plain versions."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import pytest
from helpers import corpus, frame
from pyspark.sql import functions as F

from tabweave.llm.resampling import radix_ranks, resample
from tabweave.storage import shared_dir

BENCHMARK = "item_id long, text string"


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_features(text, ngrams):
    words = plain_words(text)
    return [" ".join(words[i : i + n]) for n in range(1, ngrams + 1) for i in range(len(words) - n + 1)]


def plain_resample(rows, target, ngrams=1, buckets=10_000, seed=2024, min_words=20, percent=10):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    raw = Counter(bucket(f) for _, text in rows for f in plain_features(text, ngrams))
    wanted = Counter(bucket(f) for text in target for f in plain_features(text, ngrams))
    s_all, t_all = sum(raw.values()), sum(wanted.values())
    lines, eligible = [], []
    for doc_id, text in rows:
        found = plain_features(text, ngrams)
        weight = sum(
            math.floor(1000 * math.log((wanted[b] + 1.0) * (s_all + buckets) / ((raw[b] + 1.0) * (t_all + buckets))))
            for b in map(bucket, found)
        )
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        lines.append((doc_id, len(found), weight, score))
        if len(plain_words(text)) >= min_words:
            eligible.append(lines[-1])
    eligible.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = [(r[3], r[0]) for r in eligible[: percent * len(eligible) // 100]]
    return sorted(lines, key=repr), drawn


def check(found, rows, target, **options):
    lines, drawn = plain_resample(rows, target, **options)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in found), key=repr) == lines
    ranked = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.score, r.doc_id) for r in ranked] == drawn


@pytest.mark.parametrize("clashing", [False, True])
@pytest.mark.parametrize("ngrams", [1, 2])
def test_resample(spark, clashing, ngrams):
    rows = corpus()
    target = ["w3x1 W4x2 w5x0 " * 9, None, "", "Ä-ö_ü 12"]
    items = spark.createDataFrame([(i, t) for i, t in enumerate(target)], BENCHMARK)
    docs = frame(spark, rows, clashing)
    if clashing:
        docs = docs.selectExpr("*", "0 AS position", "0 AS block", "0 AS digit", "0 AS place", "0 AS score", "0 AS n_words")
    found = resample(docs, items, ngrams=ngrams, percent=40).collect()
    check(found, [r[:2] for r in rows], target, ngrams=ngrams, percent=40)


def test_long_texts_ties_and_copies(spark):
    rng = random.Random(2)
    copied = " ".join(f"c{rng.randrange(50)}" for _ in range(40))
    long_text = " ".join(f"v{rng.randrange(9_000)}" for _ in range(250_000))
    rows = [(i, copied) for i in range(120)] + [(7, copied)] * 60 + [(500, long_text), (None, copied), (None, copied)]
    rows += [(1_000 + i, "too short") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(0, copied)], BENCHMARK)
    check(resample(docs, items, percent=90).collect(), rows, [copied], percent=90)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], BENCHMARK)
    assert resample(none, items).collect() == []
    rows = [(1, "a b c " * 10), (2, None)]
    check(resample(spark.createDataFrame(rows, "doc_id long, text string"), items).collect(), rows, [])


VALUES = {
    "small": [3, 1, 2, 2, 0, 3, 3],
    "both signs": [-5, 5, 0, -1, 1, 2**40, -(2**40)],
    "whole range": [2**63 - 1, -(2**63), 0, -1, 1],
    "with null": [None, 4, None, -4, 0],
    "only null": [None, None, None],
    "one value": [9] * 40,
    "one row": [7],
}


@pytest.mark.parametrize("name", VALUES)
def test_radix_order(spark, name):
    values, descending = VALUES[name], len(name) % 2 == 0
    rng = random.Random(1)
    rows = [(v, rng.randrange(3), i) for i, v in enumerate(values * 5)]
    df = spark.createDataFrame(rows, "a long, b long, i long").repartition(4)
    found = radix_ranks(df, {"a": descending, "b": not descending}, digit_bits=1 + max(map(abs, [v or 0 for v in values])).bit_length() // 3, block_bits=2).collect()
    assert sorted(r.position for r in found) == list(range(len(rows)))

    def key(a, b):
        return (a is None, (-a if descending else a) if a is not None else 0, b if descending else -b)

    ordered = [(r.a, r.b) for r in sorted(found, key=lambda r: r.position)]
    assert ordered == sorted(((a, b) for a, b, _ in rows), key=lambda r: key(*r))
    assert sorted(r.i for r in found) == sorted(i for *_, i in rows)


def test_radix_sort_leaves_only_its_last_copy(spark):
    shared = shared_dir(spark)
    before = set(os.listdir(shared))
    df = spark.range(1_000).select((F.col("id") * 7 % 1_000).alias("k"))
    radix_ranks(df, {"k": False}, digit_bits=5).count()
    assert len(set(os.listdir(shared)) - before) == 1


def test_names_that_the_sort_uses_are_refused(spark):
    with pytest.raises(ValueError, match="digit"):
        radix_ranks(spark.createDataFrame([(1, 2)], "k long, digit int"), {"k": False})
