"""Target-distribution importance resampling: array-scored weights and a distributed radix sort.

Words and runs of words are counted in hashed buckets over the corpus and over target texts. The log ratio of a
bucket is its gain, a document's weight the sum over its features, looked up in one array. A seeded
Gumbel term turns weights into scores whose largest ones are a draw without replacement. Ranks come from a radix
sort from the least significant digit up: every pass counts digits per block of positions, turns the
counts into global offsets and gives each row its next position.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabweave.llm.common import byte_texts, small_slices
from tabweave.storage import remove, scratch_path, stage, staged

BUCKETS = 10_000
NGRAMS = 1
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
DIGIT_BITS = 13
BLOCK_BITS = 17  # positions per block, as a power of two

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters, digits and characters beyond ASCII; only A to Z change case."""
    return _WORDS.findall(text.lower())


def buckets_of(words: list[bytes], ngrams: int = NGRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of all runs of 1 to ``ngrams`` words."""
    features = words
    for n in range(2, ngrams + 1):
        features = features + [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return np.fromiter(map(zlib.crc32, features), dtype=np.int64, count=len(features)) % buckets


def bucket_counts(texts: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over a whole column ``text``; a task returns at most one line per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, dtype=np.int64)
        for whole in batches:
            for batch in small_slices(whole, "text", 4 << 20):
                for text in byte_texts(batch.column(0)):
                    found += np.bincount(buckets_of(words_of(text), ngrams, buckets), minlength=buckets)
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(found[used])], ["bucket", "n"])

    sums = texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(buckets, dtype=np.int64)
    total[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return total


def gains_of(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log ratio of target to corpus, floored, per bucket."""
    raw_sum, target_sum, buckets = int(raw.sum()), int(target.sum()), len(raw)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (raw_sum + buckets) / ((s + 1) * (target_sum + buckets))))
            for s, t in zip(raw.astype(float).tolist(), target.astype(float).tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel number from the SHA-256 of ``seed:id``, floored; a null id is the empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weigh(docs: DataFrame, gains: np.ndarray, ngrams: int = NGRAMS) -> DataFrame:
    """``doc_id, n_features, n_words, weight`` of documents ``doc_id, text``; null text has no features."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text", 4 << 20):
                rows = []
                for text in byte_texts(batch.column(1)):
                    words = words_of(text)
                    found = buckets_of(words, ngrams, len(gains))
                    rows.append((len(found), len(words), int(gains[found].sum())))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_features", "n_words", "weight"])

    return docs.mapInArrow(score, "doc_id long, n_features long, n_words long, weight long")


def _digits(column: str, least: int, most: int, descending: bool, digit_bits: int) -> list[Column]:
    """Digits of a long column from the least significant one up; none if all values are equal."""
    span = most - least
    if span < 2**63:
        key, bits = F.col(column) - F.lit(least).cast("long"), span.bit_length()
    else:  # the difference would overflow; with its sign bit turned a long has the same order without sign
        key, bits = F.col(column).bitwiseXOR(F.lit(-(2**63)).cast("long")), 64
    passes = math.ceil(bits / digit_bits)
    width = math.ceil(bits / passes) if passes else 0
    mask = (1 << width) - 1
    key = F.coalesce(key, F.lit(0).cast("long"))
    digits = [F.shiftrightunsigned(key, width * i).bitwiseAND(F.lit(mask).cast("long")) for i in range(passes)]
    return [F.lit(mask) - d for d in digits] if descending else digits


def radix_ranks(
    rows: DataFrame, keys: dict[str, bool], digit_bits: int = DIGIT_BITS, block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Add ``position``: the place from 0 of every row in the order of the long columns ``keys``.

    ``keys`` names the columns from the most to the least significant, with true for descending ones. Null comes
    behind all values of its column, either way. Rows equal in all keys follow each other in an order that is fixed once
    the rows are written. No rows give no rows. Columns named ``place``, ``position``, ``block``, ``digit`` or ``offset``
    are refused.

    A pass moves every row once, to its block and digit; such a group has at most a block of rows, whatever
    the digits are. Counts are one line per block and digit that occurs. Bits that no two rows differ in need no
    pass, so the number of passes follows from the spread of the keys, not from the number of rows.
    """
    if clash := {"place", "position", "block", "digit", "offset"} & set(rows.columns):
        raise ValueError(f"columns {sorted(clash)} have names that the sort uses")
    spark = rows.sparkSession
    # The places of the first pass are those in the written table; they have gaps between its parts.
    now, path = _written(rows.withColumn("position", F.monotonically_increasing_id()))
    bounds = now.agg(
        *[f(c).alias(f"{n}_{c}") for c in keys for n, f in (("min", F.min), ("max", F.max))],
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in keys],
        F.count(F.lit(1)).alias("n"),
    ).first()
    digits: list[Column] = []
    for column, descending in reversed(keys.items()):
        if bounds[f"min_{column}"] is not None:
            digits += _digits(column, bounds[f"min_{column}"], bounds[f"max_{column}"], descending, digit_bits)
        if 0 < bounds[f"null_{column}"] < bounds["n"]:
            digits.append(F.col(column).isNull().cast("long"))
    for digit in digits or [F.lit(0)]:
        before, (now, path) = path, _counting_pass(now, digit, block_bits)
        remove(spark, before)
    return now


def _written(rows: DataFrame) -> tuple[DataFrame, str]:
    path = scratch_path(rows.sparkSession, "radix")
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path), path


def _counting_pass(rows: DataFrame, digit: Column, block_bits: int) -> tuple[DataFrame, str]:
    """One stable counting sort by ``digit``: offset of block and digit, plus the place within the two."""
    marked = rows.withColumns({"block": F.shiftright("position", block_bits), "digit": digit.cast("int")})
    with staged(marked.groupBy("digit", "block").agg(F.count(F.lit(1)).alias("n")), "digits") as counts:
        # Rows of smaller digits come first. A digit has a fixed number of values, and so has this table lines.
        of_digit = counts.groupBy("digit").agg(F.sum("n").alias("rows"))
        below = F.sum("rows").over(Window.orderBy("digit")) - F.col("rows")
        earlier = F.sum("n").over(Window.partitionBy("digit").orderBy("block")) - F.col("n")
        offset = (F.col("below") + F.col("earlier")).alias("offset")
        before = of_digit.select("digit", below.alias("below"))
        offsets = counts.withColumn("earlier", earlier).join(before, "digit").select("block", "digit", offset)
        with staged(offsets, "offsets") as found:
            place = F.row_number().over(Window.partitionBy("block", "digit").orderBy("position")) - 1
            moved = marked.withColumn("place", place).join(found, ["block", "digit"])
            return _written(moved.withColumn("position", F.col("offset") + F.col("place")).select(*rows.columns))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    ngrams: int = NGRAMS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; ``rank`` counts the drawn ones from 1.

    Of the documents with at least ``min_words`` words, ``percent`` in a hundred are drawn, the highest scores first,
    equal ones by id. A null text has no features and weight 0; a null id is hashed as the empty text and comes
    behind all ids of the same score. Rows that share id and score and so take neighbouring ranks do so in an
    order that is fixed once they are written. Empty tables: without target texts the target is uniform over the
    buckets, without documents there are no rows. Other columns are not read.

    Two passes over the texts, one to count and one to score; what is sorted is four numbers per document.
    The gains are one number per bucket, whatever the tables hold.
    """
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    wanted = target.select(F.col(f"`{target_text_col}`").cast("string").alias("text"))
    gains = gains_of(bucket_counts(given.select("text"), ngrams, buckets), bucket_counts(wanted, ngrams, buckets))
    weighed = weigh(given, gains, ngrams).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    weighed = stage(weighed, "weighed")
    eligible = F.col("n_words") >= min_words
    drawn = weighed.where(eligible).count() * percent // 100
    ranked = radix_ranks(weighed.where(eligible), {"score": True, "doc_id": False})
    columns = ("doc_id", "n_features", "weight", "score")
    rank = F.when(F.col("position") < drawn, F.col("position") + 1).cast("long")
    others = weighed.where(~eligible).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank.alias("rank")).unionByName(others)
