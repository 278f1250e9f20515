"""The corpus pipeline: quality rules, exact dedup, near dedup, repeated passages, packing.

Each stage works on all that the one before it kept. All but the last return the columns of ``documents``. The frame
of a stage is to be written before the next stage is called, as ``run`` does.

Every stage takes null texts as empty and null ids as ids like any other, judges rows and not ids, so that rows that
share an id or repeat are rows of their own, carries extra columns whatever their names, and gives no rows for an
empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm.exact_dedup import drop_copies
from tabweave.llm.packing import cut_pieces, pack
from tabweave.llm.quality import load_labels, quality_rules
from tabweave.llm.repeated_spans import cut_repeats
from tabweave.llm.simhash import drop_near_duplicates
from tabweave.storage import remove, stage, staged_paths

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_left: dict[str, list[str]] = {}


def _clearing(before: str | None, name: str, function: Stage) -> Stage:
    """A stage that removes the copies that the stage before it made, if that was called on its own.

    A stage's frame reads copies that its operator made. It is written before the next stage is called, so
    the copies can go then. Runs have copies of their own, which no stage removes.
    """

    @wraps(function)
    def stage_on_its_own(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in _left.pop(before, []):
            remove(spark, path)
        with staged_paths() as made:
            result = function(spark, docs, sf_dir)
        _left.setdefault(name, []).extend(made)
        return result

    return stage_on_its_own


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie below the quality threshold go; empty texts fail the rules."""
    judged = quality_rules(docs, load_labels(spark, sf_dir), carry=docs.columns)
    return judged.where("kept").select("carried.*")


def keep_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, that with the smallest id; empty texts are one group."""
    return drop_copies(docs)


def keep_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays; texts without words are near each other."""
    return drop_near_duplicates(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat are cut out of all rows, which all stay; the number of characters follows the text."""
    cut = cut_repeats(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, each with its sequence and its place there; an empty text is its end token."""
    import public_tokenizers

    return pack(cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


_OPERATORS: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("exact_dedup", keep_exact),
    ("near_dedup", keep_near),
    ("repeated_passages", cut_passages),
    ("packing", pack_sequences),
]

STAGES = [
    (name, _clearing(_OPERATORS[i - 1][0] if i else None, name, function)) for i, (name, function) in enumerate(_OPERATORS)
]

# Fingerprints, log ratios, tokens and windows have no equivalent in SQL.
ORACLE_SQL = None


@dataclass(frozen=True)
class Run:
    """The result of all stages, and the copies in the shared folder that it reads."""

    frame: DataFrame
    paths: tuple[str, ...]

    def release(self) -> None:
        """Remove the copies; ``frame`` cannot be read any more."""
        for path in self.paths:
            remove(self.frame.sparkSession, path)


def start(spark: SparkSession, sf_dir: str) -> Run:
    """All stages over ``documents``; each writes its result, and the next one reads it.

    A run owns its copies: what a stage has left goes once its result is written, and that of the stage before it once
    it is read. Other runs are not touched.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    result: list[str] = []
    for name, function in _OPERATORS[:-1]:
        with staged_paths() as made:
            kept = function(spark, docs, sf_dir)
        with staged_paths() as written:
            docs = stage(kept, name)
        for path in [*made, *result]:
            remove(spark, path)
        result = written
    with staged_paths() as made:
        frame = _OPERATORS[-1][1](spark, docs, sf_dir)
    # Packing has numbered and written its pieces, and reads the texts no more.
    for path in result:
        remove(spark, path)
    return Run(frame, tuple(made))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that the stages keep; see :func:`start` for a run that can be released."""
    return start(spark, sf_dir).frame
