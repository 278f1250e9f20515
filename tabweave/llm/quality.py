"""Quality rules: hashed n-gram log-likelihood ratio between trusted documents and the raw corpus.

Tokens (runs of word characters, runs of marks) and pairs of them are hashed into a fixed number of
buckets. Two multinomials over the buckets are counted, one over all documents, one over trusted
ones. A document's score is the mean log ratio of its n-grams, and one threshold decides for all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm.common import byte_texts, give_back, small_slices
from tabweave.operators.ordered import global_positions
from tabweave.storage import stage

BUCKETS = 1 << 16
_SENT = 1_000_000  # labelled ids that are sent to the texts instead of moving the texts to them
LOST_GOOD = 0.002  # share of trusted documents held out that the threshold may cost
SMOOTHING = 1.0
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8

_TOKENS = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[^0-9A-Za-z_\x80-\xff\x20\x09-\x0d]+")
_SYMBOLS = b"#*$%&|<>"
_NOT_COUNTED = b" \t\n\r\x0b\x0c" + bytes(range(0x80, 0xC0))  # white space, continuation bytes
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(WINDOW)], dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens), dtype=np.uint64, count=len(tokens))


def buckets_of(text: bytes) -> np.ndarray:
    """Buckets of all tokens and of all pairs of neighbours."""
    h = _hashes(_TOKENS.findall(text))
    pairs = _mix(h[:-1] * _ODD + h[1:])
    return (np.concatenate([_mix(h), pairs]) % np.uint64(BUCKETS)).astype(np.int64)


def base_measures(text: bytes) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of one text."""
    words = text.split()  # of bytes: exactly the six ASCII white spaces
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, _NOT_COUNTED)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated_words(words),
    )


def _repeated_words(words: list[bytes]) -> int:
    """Words inside windows of eight that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = _mix(_hashes(words))
    windows = np.zeros(n, dtype=np.uint64)
    for j in range(WINDOW):
        windows += h[j : j + n] * _PLACES[j]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[:n] += twice
    edges[WINDOW:] -= twice
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


_ROLES = "doc_id long, role byte"


def label_roles(labels: DataFrame) -> DataFrame:
    """``doc_id, role`` of every labelled id: 1 fits the target, 2 is good and held out, 3 is bad.

    Every second good id, by hash, is held out for the threshold. An id with both labels counts as bad.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
    marked = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))

    def role(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit = np.array([_fits(i) for i in batch.column(0).to_pylist()], dtype=bool)
            good = batch.column(1).to_numpy(zero_copy_only=False) == 1
            found = np.where(good, np.where(fit, 1, 2), 3).astype(np.int8)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "role"])

    return marked.mapInArrow(role, _ROLES)


def _fits(doc_id: int) -> bool:
    return xxhash.xxh64_intdigest(str(doc_id)) % 2 == 0


@dataclass(frozen=True)
class Labelled:
    """Labels in the driver: ids sorted, ``good`` per id, and whether it would fit the target."""

    ids: np.ndarray
    good: np.ndarray
    fit: np.ndarray


def sample_labels(labels: DataFrame) -> Labelled:
    """All labels as arrays, to look at small tables; the rules use :func:`label_roles`, which stays a table."""
    rows = sorted((r["doc_id"], r["role"]) for r in label_roles(labels).collect())
    return Labelled(
        np.array([i for i, _ in rows], dtype=np.int64),
        np.array([role != 3 for _, role in rows], dtype=bool),
        np.array([_fits(i) for i, _ in rows], dtype=bool),
    )


def _with_roles(docs: DataFrame, roles: DataFrame, n: int) -> DataFrame:
    """``role`` and ``text`` of every document, role 0 without a label.

    Texts stay where they are unless there are more than ``_SENT`` labelled ids. Rows without an id have no label and
    are left out of the join, so they do not meet.
    """
    role = F.coalesce("role", F.lit(0).cast("byte")).alias("role")
    if n <= _SENT:
        return docs.join(F.broadcast(roles), "doc_id", "left").select(role, "text")
    found = docs.where("doc_id IS NOT NULL").join(roles, "doc_id", "left").select(role, "text")
    return found.unionByName(docs.where("doc_id IS NULL").select(F.lit(0).cast("byte").alias("role"), "text"))


def log_ratios(marked: DataFrame) -> np.ndarray | None:
    """Log ratio per bucket, from all documents (``role``, ``text``) and those of role 1; null without n-grams of these.

    A task returns at most one line per bucket; the driver gets one line per bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
        for whole in batches:
            for batch in small_slices(whole, "text", 4 << 20):
                found = [buckets_of(t) for t in byte_texts(batch.column(1))]
                raw += np.bincount(np.concatenate(found), minlength=BUCKETS)
                trusted = [b for b, role in zip(found, batch.column(0).to_pylist(), strict=True) if role == 1]
                if trusted:
                    target += np.bincount(np.concatenate(trusted), minlength=BUCKETS)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"]
        )

    counted = marked.mapInArrow(count, "bucket int, raw long, target long")
    sums = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = sums["bucket"].to_numpy()
    raw[at], target[at] = sums["raw"].to_numpy(), sums["target"].to_numpy()
    if not target.sum():
        return None
    return np.log((target + SMOOTHING) / (target.sum() + SMOOTHING * BUCKETS)) - np.log(
        (raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS)
    )


def threshold_of(scored: DataFrame) -> float:
    """The cut between good and bad documents that were held out of the fit (columns ``role``, ``score``).

    At most a share ``LOST_GOOD`` of the good ones lies below it; where the classes leave a gap it is the middle
    of the gap. Without documents of both classes nothing is below. All of them count: they are ranked in ranges, and the
    driver gets counts and two scores.
    """
    held = stage(scored, "quality-scores")
    sizes = {r["role"]: r["n"] for r in held.groupBy("role").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(2) or not sizes.get(3):
        return float("-inf")
    ranked = global_positions(held.where("role = 2").select("score"), ["score"])
    low = ranked.where(F.col("position") == int(LOST_GOOD * sizes[2])).first()["score"]
    below = held.where((F.col("role") == 3) & (F.col("score") < low)).agg(F.max("score")).first()[0]
    return float("-inf") if below is None else (low + below) / 2


def _score(text: bytes, ratios: np.ndarray | None) -> float:
    if ratios is None:
        return 0.0
    found = buckets_of(text)
    return float(ratios[found].mean()) if len(found) else 0.0


def _failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words)


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """Per document its base measures, ``base_failed``, ``score`` and ``kept``.

    ``kept`` is false for documents that fail the base rules (fewer than 20 words, or more than 30 % of the words in
    repeated windows) and for those whose score is below the threshold. A null text is empty; null or
    repeated ids are scored as rows of their own. Without labels there is no trusted target: all scores
    are 0 and only the base rules decide. An empty table gives no rows. Other columns are not read, except those named in
    ``carry``, which are returned in a struct ``carried``.

    Three passes over the texts (counts, scores of the labelled ones, scores of all). All labels are used: they are a
    table that is joined by id, sent to the texts up to ``_SENT`` ids. The driver gets one line per bucket and the
    threshold.
    """
    roles = stage(label_roles(labels), "quality-roles")
    known = roles.count()
    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []),
    )
    marked = _with_roles(given.select("doc_id", "text"), roles, known)
    ratios = log_ratios(marked)

    def score_held_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text", 4 << 20):
                texts = byte_texts(batch.column(1))
                measures = np.array([base_measures(t) for t in texts], dtype=np.int64).reshape(-1, 5)
                counted = pa.array(~_failed(measures[:, 0], measures[:, 4]))
                found = [batch.column(0), pa.array([_score(t, ratios) for t in texts], pa.float64())]
                yield pa.RecordBatch.from_arrays([c.filter(counted) for c in found], ["role", "score"])

    cut = threshold_of(marked.where("role >= 2").mapInArrow(score_held_out, "role byte, score double"))
    extra = ["carried"] if carry else []

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text", 4 << 20):
                texts = byte_texts(batch.column(1))
                measures = np.array([base_measures(t) for t in texts], dtype=np.int64)
                scores = np.array([_score(t, ratios) for t in texts])
                failed = _failed(measures[:, 0], measures[:, 4])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        *[pa.array(measures[:, i]) for i in range(5)],
                        pa.array(failed),
                        pa.array(scores),
                        pa.array(~failed & (scores >= cut)),
                        *[batch.column(c) for c in extra],
                    ],
                    ["doc_id", *_MEASURES, "base_failed", "score", "kept", *extra],
                )
        give_back()

    carried = f", carried {given.schema['carried'].dataType.simpleString()}" if carry else ""
    measures = ", ".join(f"{m} long" for m in _MEASURES)
    return given.mapInArrow(judge, f"doc_id long, {measures}, base_failed boolean, score double, kept boolean{carried}")


def load_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
