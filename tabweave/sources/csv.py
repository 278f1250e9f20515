"""Tolerant CSV scan."""

from __future__ import annotations

import csv
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.sources.records import QUOTED_LINES, read_records


def scan_csv(
    spark: SparkSession, path: str, numeric: Mapping[str, str] | list[str] = (), multi_line: bool = False
) -> DataFrame:
    """Read a CSV with a header; cells of numeric columns that do not parse become null.

    Every column is read as text and cast by name, so nothing is inferred from the head of the file
    and columns may come in any order. ``numeric`` lists double columns or maps columns to types.
    ``multi_line`` accepts line breaks inside quotes. Files are split all the same, so quotes must be used as the
    format has them: around a whole cell, and doubled inside of it.
    """
    types = dict(numeric) if isinstance(numeric, Mapping) else {c: "double" for c in numeric}
    text = _quoted_lines(spark, path) if multi_line else spark.read.csv(path, header=True, escape='"')
    return text.select(
        *[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in text.columns]
    )


def _quoted_lines(spark: SparkSession, path: str) -> DataFrame:
    """All cells as text; the first record of every file is its header, and that of the first file names the columns."""
    records = read_records(spark, path, QUOTED_LINES)
    header = records.where("number = 0").orderBy("file").select("text").first()
    names = next(csv.reader([header["text"].rstrip("\r\n")]), []) if header else []
    if not names:
        raise ValueError(f"{path} has no header")
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    line = F.regexp_replace("text", "\r?\n$", "")
    rows = records.where("number > 0").select(F.from_csv(line, schema, {"escape": '"'}).alias("row"))
    return rows.select(*[F.col("row").getField(n).alias(n) for n in names])
