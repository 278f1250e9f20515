"""The report as tables: comparison, evolution, verdict and loss curves per task."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.functions.display import NOT_AVAILABLE, delta_text, number_text, time_text
from tabweave.operators.baselines import NETWORK_NAME
from tabweave.operators.runs import (
    MAIN_METRIC,
    TABLE_METRICS,
    comparison,
    evolution,
    latest_runs,
    loss_series,
    verdict,
)
from tabweave.sources.history import TASKS
from tabweave.storage import staged

# Decimals per metric and per evolution table, and the time of a model without a run.
METRIC_DIGITS = {"mae": 6, "mse": 6, "rmse": 6}
EVOLUTION_DIGITS = {"classification": 4, "regression": 6}
NO_RUN = "sem execução registrada"
NO_NOTES = "-"

TABLES_AT_ONCE = 4  # tables that are written side by side


def comparison_text(table: DataFrame, task: str) -> DataFrame:
    """A comparison table as it is shown."""
    logged = F.when(F.col("available"), time_text(F.col("logged_at"))).otherwise(F.lit(NO_RUN))
    return table.select(
        "display_name",
        *[number_text(F.col(m), METRIC_DIGITS.get(m, 4)).alias(m) for m in TABLE_METRICS[task]],
        logged.alias("logged_at"),
    )


def evolution_text(table: DataFrame, task: str) -> DataFrame:
    """An evolution table as it is shown."""
    digits = EVOLUTION_DIGITS[task]
    notes = F.when(F.coalesce("notes", F.lit("")) == "", F.lit(NO_NOTES)).otherwise(F.col("notes"))
    return table.select(
        "model_name",
        F.col("n").cast("string").alias("n"),
        F.coalesce("logged_at", F.lit(NOT_AVAILABLE)).alias("logged_at"),
        number_text(F.col("value"), digits).alias(MAIN_METRIC[task]),
        delta_text(F.col("delta"), digits).alias("delta"),
        notes.alias("notes"),
    )


def report_tables(
    history: DataFrame, epochs: Mapping[str, DataFrame], latest: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All tables of the report by name; ``latest`` are the latest runs if they are at hand.

    ``epochs`` maps a task to its stored epoch losses. What is missing is said in ``notices``: no
    history at all, no run of a task, no loss curve of a task. Nothing is filled in for it.
    """
    spark = history.sparkSession
    newest = latest_runs(history) if latest is None else latest
    counts = history.groupBy("task").agg(F.count(F.lit(1)).alias("runs"))
    seen = {r["task"] for r in counts.collect()}
    tables, notices = {"runs": counts}, []
    if not seen:
        notices.append((None, "no_history"))
    for task in TASKS if seen else ():
        if task not in seen:
            notices.append((task, "no_runs"))
            continue
        tables[f"{task}_comparison"] = comparison_text(comparison(newest, task), task)
        tables[f"{task}_evolution"] = evolution_text(evolution(history, task, NETWORK_NAME), task)
        tables[f"{task}_verdict"] = verdict(newest, task)
        if task in epochs and not epochs[task].isEmpty():
            tables[f"{task}_loss_curve"] = loss_series(epochs[task])
        else:
            notices.append((task, "no_loss_curve"))
    tables["notices"] = spark.createDataFrame(notices, "task string, notice string")
    return tables


def report(
    history: DataFrame, epochs: Mapping[str, DataFrame], out_dir: str, latest: DataFrame | None = None
) -> list[str]:
    """Write every table under ``out_dir`` and return the names written.

    The history is read once, as JSON; the tables work on a columnar copy, and comparisons and verdicts on one
    table of latest runs, which is made here unless ``latest`` is that of
    :func:`tabweave.sources.latest.maintained_latest`. Copies are deleted at the end.
    """
    with staged(history, "history") as records, (
        nullcontext(latest) if latest is not None else staged(latest_runs(records), "latest-runs")
    ) as newest:
        tables = report_tables(records, epochs, newest)

        def write(name: str) -> None:
            tables[name].write.mode("overwrite").json(f"{out_dir}/{name}")

        # Small tables, most of whose time is that of starting jobs.
        with ThreadPoolExecutor(TABLES_AT_ONCE) as writers:
            list(writers.map(write, tables))
    return list(tables)
