"""Exact deduplication by radix partitioning from the first byte on.

Documents are split by successive bytes, a run of bytes at a time: whoever is alone in its group is
done, whoever has ended is equal to the others that ended there, and the rest goes on with the next,
longer run. Groups are told apart by the bytes themselves; no digest takes part in the decision.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.llm.common import WHITE_SPACE
from tabweave.storage import stage

FIRST_DIGIT = 64
GROWTH = 16


def _normalise(text: Column) -> Column:
    """Each run of white space as one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE_SPACE, " ")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal normalised texts the row with the smallest id stays; null ids come last, and of rows
    that repeat an id one stays. Null and empty texts are equal; an empty table gives no rows. Other
    columns are not read, except those named in ``carry``, which are returned in a struct ``carried``.

    Each round counts the rows of every (group, next bytes) with a hash aggregate, combined on the
    map side, so a group of copies leaves one line per task. The join that brings the counts back
    is an equi-join whose large side adaptive execution splits where one group holds most rows.
    After the first round only documents with a common beginning are left. The runs of bytes grow
    16 times per round, so the number of rounds grows with the logarithm of the longest text.
    Every round is written to the shared folder: ids given to groups and rows are fixed there, and a
    lost executor costs one round at most.
    """
    carried = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []
    extra = ["carried"] if carry else []
    text = F.col(f"carried.`{text_col}`") if text_col in carry else F.col("text")
    own = [] if text_col in carry else [F.col(text_col).alias("text")]
    active = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("grp"), *own, *carried)
    # The text itself moves once, in the first round; what follows from it is computed behind the join.
    rest = _normalise(text).cast("binary")
    sha = F.sha2(rest, 256)
    width = FIRST_DIGIT
    done = []
    while True:
        level = _split(active, width, rest, sha, extra)
        done.append(level.where("state != 'open'").drop("rest"))
        active = level.where("state = 'open'").drop("state", "row")
        if active.isEmpty():
            break
        rest, sha = F.col("rest"), F.col("text_sha256")
        width *= GROWTH
    parts = []
    for found in done:
        alone = found.where("state = 'alone'").select(
            "doc_id",
            F.col("doc_id").alias("keep_id"),
            F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"),
            "text_sha256",
            *extra,
        )
        parts += [alone, _resolve(found.where("state = 'ended'"), extra)]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _split(active: DataFrame, width: int, rest: Column, sha: Column, extra: list[str]) -> DataFrame:
    """One round: rows with their new group and state, ``alone``, ``ended`` or ``open``."""
    keyed = active.withColumn("digit", F.substring(rest, 1, width))
    shared = keyed.groupBy("grp", "digit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = stage(shared.select("grp", "digit", F.monotonically_increasing_id().alias("next")), "radix-groups")
    ended = F.octet_length("digit") < width
    # The same join at every size: a table of groups small enough to broadcast says nothing about the texts beside it.
    placed = keyed.join(groups.hint("merge"), ["grp", "digit"], "left").select(
        "doc_id",
        sha.alias("text_sha256"),
        F.when(F.col("next").isNull(), "alone").when(ended, "ended").otherwise("open").alias("state"),
        F.col("next").alias("grp"),
        F.when(F.col("next").isNotNull() & ~ended, F.substring(rest, width + 1, 2**31 - 1)).alias("rest"),
        F.monotonically_increasing_id().alias("row"),
        *extra,
    )
    return stage(placed, "radix-round")


def _resolve(ended: DataFrame, extra: list[str]) -> DataFrame:
    """Members of equal groups with the row that stays and the size."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    # Written, so that the join reads plain exchanges and a group with most of the rows can be split.
    leaders = stage(
        ended.groupBy("grp").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size")), "radix-leaders"
    )
    return ended.join(leaders, "grp").select(
        "doc_id",
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("first.row") == F.col("row")).alias("kept"),
        "text_sha256",
        *extra,
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return exact_groups(docs, id_col, text_col, carry=docs.columns).where("kept").select("carried.*")
