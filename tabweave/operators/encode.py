"""Projection, filtering, labels, one-hot columns and feature arrays."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.operators.ordered import global_positions
from tabweave.storage import stage

FILL_VALUE = "unknown"
LABEL = "classification_target"
MAX_ONE_HOT_COLUMNS = 10_000
_SENT_VALUES = 100_000  # of a column's vocabulary, that are sent to the rows
_DEALT = 4_096  # parts that rows without a value are dealt into


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns])


def keep_members(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is one of ``values``; null is none of them."""
    return df.filter(F.col(column).isin(list(values)))


def fill_categories(df: DataFrame, columns: Sequence[str], fill: str = FILL_VALUE) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(fill)) for c in columns})


def label_rows(df: DataFrame, source: str, zero_value: str, name: str = LABEL) -> DataFrame:
    """0 where ``source`` equals ``zero_value``, otherwise 1 (also for null, so filter first)."""
    return df.withColumn(name, F.when(F.col(source) == zero_value, 0).otherwise(1))


def fit_vocabulary(
    df: DataFrame, columns: Sequence[str], max_columns: int = MAX_ONE_HOT_COLUMNS
) -> dict[str, list[str]]:
    """Sorted distinct values per column, null left out.

    One pass for all columns; values are made distinct on the map side. The vocabulary becomes a
    schema, so it must fit one: more than ``max_columns`` values in total is an error.
    """
    pairs = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in columns])).alias("p")
    ).select("p.*")
    found = pairs.filter(F.col("value").isNotNull()).distinct().take(max_columns + 1)
    if len(found) > max_columns:
        raise ValueError(f"one-hot encoding of {list(columns)} needs more than {max_columns} columns")
    vocabulary: dict[str, list[str]] = {c: [] for c in columns}
    for row in found:
        vocabulary[row["feature"]].append(row["value"])
    return {c: sorted(values) for c, values in vocabulary.items()}


def vocabulary_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, value, position`` for every distinct value, however many there are; null is none.

    Positions count from 0 over all columns, in the order of columns and values, as one-hot columns would.
    """
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("place"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)])
        ).alias("p")
    ).select("p.*")
    distinct = pairs.filter(F.col("value").isNotNull()).distinct()
    ranked = global_positions(distinct, ["place", "value"])
    names = F.array(*[F.lit(c) for c in columns])
    return ranked.select(F.element_at(names, F.col("place") + 1).alias("feature"), "value", "position")


def one_hot_positions(df: DataFrame, vocabulary: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """``key, positions``: where the ones are, in the order of columns, for vocabularies too wide to be columns.

    The vocabulary is a table and is joined column by column; values that it does not have leave no position. The part of a
    column with at most ``_SENT_VALUES`` values is sent to the rows, which would meet in few tasks otherwise. Rows
    without a value are dealt out by their key and match nothing. Rows that share a key are put together. The driver
    gets one line per column.
    """
    held = stage(vocabulary.select("feature", "value", "position"), "one-hot")
    sizes = {r["feature"]: r["n"] for r in held.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    # A column that has no value anywhere leaves no position.
    known = [c for c in dict.fromkeys(columns) if c in sizes]
    rows = df.select(F.col(f"`{key}`").alias("__key"), *[F.col(f"`{c}`").cast("string").alias(f"v{i}") for i, c in enumerate(known)])
    nobody = F.concat(F.lit("none "), F.pmod(F.xxhash64("__key"), F.lit(_DEALT)).cast("string"))
    for i, c in enumerate(known):
        part = held.where(F.col("feature") == c).select(F.col("value").alias(f"w{i}"), F.col("position").alias(f"p{i}"))
        given, small = F.col(f"v{i}"), sizes[c] <= _SENT_VALUES
        same = given == F.col(f"w{i}") if small else (F.coalesce(given, nobody) == F.col(f"w{i}")) & given.isNotNull()
        rows = rows.join(F.broadcast(part) if small else part, same, "left").drop(f"v{i}", f"w{i}")
    found = F.array_compact(F.array(*[F.col(f"p{i}") for i in range(len(known))])) if known else F.array().cast("array<bigint>")
    grouped = rows.select(F.col("__key").alias(key), found.alias("found")).groupBy(key)
    return grouped.agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("positions"))


def one_hot_names(vocabulary: dict[str, list[str]]) -> list[str]:
    return [f"{c}_{v}" for c, values in vocabulary.items() for v in values]


def one_hot(df: DataFrame, vocabulary: dict[str, list[str]]) -> DataFrame:
    """Replace each column of ``vocabulary`` in place by one 0/1 column per value.

    Values outside the vocabulary give zeros only.
    """
    kept = [c for c in df.columns if c not in vocabulary]
    case_sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    names = Counter(n if case_sensitive else n.lower() for n in kept + one_hot_names(vocabulary))
    clashes = sorted(n for n, times in names.items() if times > 1)
    if clashes:
        raise ValueError(f"one-hot column names clash: {clashes}; set spark.sql.caseSensitive or clean the values")
    columns: list[Column] = []
    for c in df.columns:
        if c in vocabulary:
            hit = F.coalesce(F.col(f"`{c}`"), F.lit(None).cast("string"))
            columns += [
                F.coalesce(hit == F.lit(v), F.lit(False)).cast("tinyint").alias(f"{c}_{v}") for v in vocabulary[c]
            ]
        else:
            columns.append(F.col(f"`{c}`"))
    return df.select(*columns)


# Columns that are never features, and the label of each task.
NOT_FEATURES = ("classification_target", "int_rate", "loan_status")
LABEL_OF_MODE = {"classification": ("classification_target", "bigint"), "regression": ("int_rate", "float")}


def feature_columns(columns: Sequence[str], exclude: Sequence[str] = ()) -> list[str]:
    left_out = {*NOT_FEATURES, *exclude}
    return [c for c in columns if c not in left_out]


def assemble(
    df: DataFrame,
    mode: str | None = "classification",
    exclude: Sequence[str] = ("split", "order_key"),
    keep: Sequence[str] = (),
) -> DataFrame:
    """``keep`` columns, a float array of all features and the label of the task (none without a mode).

    A feature that is null (only possible when it was null in every training row) is an error.
    """
    if mode is not None and mode not in LABEL_OF_MODE:
        raise ValueError(f"mode '{mode}' is not one of {sorted(LABEL_OF_MODE)}")
    names = feature_columns(df.columns, [*exclude, *keep])
    elements = [
        F.coalesce(F.col(f"`{c}`").cast("float"), F.raise_error(F.lit(f"feature '{c}' is null")).cast("float"))
        for c in names
    ]
    return df.select(
        *[F.col(f"`{c}`") for c in keep],
        F.array(*elements).alias("features"),
        *([F.col(LABEL_OF_MODE[mode][0]).cast(LABEL_OF_MODE[mode][1]).alias("label")] if mode else []),
    )


def split_sizes(df: DataFrame, width: int | None = None) -> DataFrame:
    """Rows per split, with the number of columns of the prepared frame."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows")).withColumn("width", F.lit(width or len(df.columns)))
