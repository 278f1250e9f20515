"""Append-only run history, epoch history and JSON results."""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.sources.compaction import Manifest, appended_files, fold, read_manifest, table_paths
from tabweave.sources.records import JSON_ARRAY, read_records
from tabweave.sources.schemas import EPOCH_SCHEMA, STORED_RUN_SCHEMA

TASKS = ("classification", "regression")
_BROKEN = "_corrupt_record"


def append_runs(records: DataFrame, path: str) -> None:
    """Append run records. New files only, so writers do not disturb each other or earlier records."""
    _with_fields(records, STORED_RUN_SCHEMA).write.mode("append").json(path)


def _with_fields(records: DataFrame, schema: str) -> DataFrame:
    """The columns of a stored record; a map that the records lack is null."""
    optional = {f.name: f.dataType for f in T._parse_datatype_string(schema).fields if isinstance(f.dataType, T.MapType)}
    names = T._parse_datatype_string(schema).fieldNames()
    missing = {n: F.lit(None).cast(t) for n, t in optional.items() if n not in records.columns}
    return records.withColumns(missing).select(*names) if missing else records.select(*names)


def log_run(
    spark: SparkSession, task: str, model_name: str, metrics: dict[str, Any], notes: str | None = None, *, path: str
) -> dict[str, Any]:
    """Append one record with the current UTC time in seconds and return it.

    Metrics under names that the record does not know are kept as numbers in ``extra``.
    """
    schema = T._parse_datatype_string(STORED_RUN_SCHEMA)
    known = [f.name for f in schema["metrics"].dataType.fields]
    extra = {k: _number(v) for k, v in metrics.items() if k not in known}
    wrong = sorted(k for k, v in extra.items() if v is not None and not isinstance(v, float))
    if wrong:
        raise ValueError(f"metrics {wrong} are neither known nor numbers")
    entry = {
        "timestamp": datetime.now(timezone.utc).isoformat(timespec="seconds"),
        "task": task,
        "model_name": model_name,
        "notes": notes,
        "metrics": {k: _number(metrics.get(k)) for k in known},
        "seq": time.time_ns(),
        "writer": uuid.uuid4().hex,
        "extra": extra or None,
    }
    append_runs(spark.createDataFrame([entry], schema).coalesce(1), path)
    return {**entry, "metrics": metrics}


def _number(value: Any) -> Any:
    return float(value) if isinstance(value, int) and not isinstance(value, bool) else value


def _load(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Records of a JSON folder; a missing folder is empty and broken records are left out.

    Lines are parsed after reading, so that a record is judged as a whole even where a query needs
    none of its columns, such as a count.
    """
    names = T._parse_datatype_string(schema).fieldNames()
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    record = F.from_json("value", f"{schema}, {_BROKEN} string", options).alias("record")
    whole = F.col("record").isNotNull() & F.col(f"record.{_BROKEN}").isNull()
    return lines.filter(F.trim("value") != "").select(record).filter(whole).select(*[f"record.{n}" for n in names])


def load_history(spark: SparkSession, path: str) -> DataFrame:
    """All records of a history: those in sorted tables, if it was folded, and those appended since."""
    path = path.rstrip("/")
    manifest = read_manifest(spark, path)
    if not manifest.number:
        return _load(spark, path, STORED_RUN_SCHEMA)
    files = [f"{path}/{n}" for n in appended_files(spark, path, manifest)]
    return _records(spark, files, table_paths(path, manifest))


def load_records(spark: SparkSession, path: str, files: list[str], tables: list[str]) -> DataFrame:
    """The records of some appended files and sorted tables of a history, by their names."""
    return _records(spark, [f"{path}/{n}" for n in files], table_paths(path, Manifest(tables=tables)))


def _records(spark: SparkSession, files: list[str], tables: list[str]) -> DataFrame:
    appended = _load(spark, files, STORED_RUN_SCHEMA) if files else spark.createDataFrame([], STORED_RUN_SCHEMA)
    if not tables:
        return appended
    return spark.read.schema(STORED_RUN_SCHEMA).parquet(*tables).unionByName(appended)


def fold_history(spark: SparkSession, path: str) -> bool:
    """Fold the files appended so far into a table sorted by ``seq``; false if there was nothing to do or another call did it.

    Appending and loading go on meanwhile. Broken records are left out for good.
    """
    return fold(spark, path.rstrip("/"), lambda files, tables: _records(spark, files, tables), ["seq", "writer"])


def _array_file(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Objects of a file that is one JSON array, with their place in it; several files go on from one another.

    The file is read by as many tasks as Spark splits it into. Objects that do not parse are left out.
    """
    elements = read_records(spark, path, JSON_ARRAY).withColumn("text", F.regexp_extract("text", r"(?s)\{.*", 0))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    record = F.from_json("text", f"{schema}, {_BROKEN} string", options).alias("record")
    parsed = elements.where("text != ''").select(record, "position").where(f"record.{_BROKEN} IS NULL")
    return parsed.select(*[f"record.{n}" for n in T._parse_datatype_string(schema).fieldNames()], "position")


def import_history(spark: SparkSession, path: str, after: DataFrame | None = None) -> DataFrame:
    """Run records from a file that holds them as one JSON array, oldest first.

    Their place in the array becomes ``seq``, counted on from the highest one in the history ``after`` if it is given, so
    that what is imported later comes later. Metrics under unknown names go to ``extra`` as far as they are
    numbers. The result has the columns of :func:`load_history` and can be appended to a history.
    """
    record = T._parse_datatype_string(STORED_RUN_SCHEMA)
    known = record["metrics"].dataType.fieldNames()
    highest = after.agg(F.max("seq")).first()[0] if after is not None else None
    first = 0 if highest is None else highest + 1
    given = _array_file(spark, path, "timestamp string, task string, model_name string, notes string, metrics string")
    numbers = F.transform_values(F.from_json("metrics", "map<string,string>"), lambda _, v: v.try_cast("double"))
    extra = F.map_filter(numbers, lambda k, v: ~k.isin(known) & v.isNotNull())
    return given.select(
        "timestamp",
        "task",
        "model_name",
        "notes",
        F.from_json("metrics", record["metrics"].dataType).alias("metrics"),
        (F.col("position") + first).alias("seq"),
        F.lit("").alias("writer"),
        F.when(F.size(extra) > 0, extra).alias("extra"),
    )


def import_epochs(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Epoch losses from a file that holds them as one JSON array; the place in it, from 1, is the epoch."""
    given = _array_file(spark, path, "train_loss double, val_loss double")
    return given.select(
        F.lit(run_id).alias("run_id"),
        (F.col("position") + 1).cast("int").alias("epoch"),
        "train_loss",
        "val_loss",
        F.lit(None).cast("map<string,double>").alias("metrics"),
    )


def append_epochs(epochs: DataFrame, path: str) -> None:
    """Append ``run_id, epoch, train_loss, val_loss`` records, with ``metrics`` by name where there are any."""
    _with_fields(epochs, EPOCH_SCHEMA).write.mode("append").json(path)


def load_epochs(spark: SparkSession, path: str) -> DataFrame:
    """Stored epoch losses; no data means an empty frame, never example values."""
    return _load(spark, path, EPOCH_SCHEMA)


def write_json(df: DataFrame, path: str) -> None:
    """Write rows as JSON lines in place of what was there."""
    df.write.mode("overwrite").json(path)
