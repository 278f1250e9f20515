"""Questions to the run history. Every function takes run records and returns rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.functions.display import direction
from tabweave.operators.baselines import BASELINE_NAME, NETWORK_NAME
from tabweave.operators.ordered import ROWS_PER_SLICE, Running, assign_slices, plan_slices, running

# Name for records without a model, rows and metrics of the comparison tables.
UNNAMED_MODEL = "desconhecido"
EXPECTED_MODELS = {
    "classification": (
        ("Regressão Logística (Baseline)", BASELINE_NAME["classification"]),
        ("MLP", NETWORK_NAME),
    ),
    "regression": (
        ("Regressão Linear (Baseline)", BASELINE_NAME["regression"]),
        ("MLP", NETWORK_NAME),
    ),
}
TABLE_METRICS = {
    "classification": ("accuracy", "precision", "recall", "f1"),
    "regression": ("mae", "mse", "rmse", "r2"),
}
MAIN_METRIC = {"classification": "recall", "regression": "rmse"}
RECALL_TOLERANCE = 1e-9


def _named(history: DataFrame) -> DataFrame:
    return history.withColumn("model_name", F.coalesce("model_name", F.lit(UNNAMED_MODEL)))


def latest_run_per_model(history: DataFrame, task: str) -> DataFrame:
    """The last record of each model in a task."""
    return latest_runs(history.filter(F.col("task") == task))


def latest_runs(history: DataFrame) -> DataFrame:
    """The last record of each model in each task.

    The highest ``seq`` per model is a hash aggregate over three columns. Whole records are then only
    taken where they match it, so wide records are neither sorted nor shuffled in bulk. Latest runs
    of latest runs are the same, so the other questions can be put to this table as well.
    """
    named = _named(history.filter(F.col("task").isNotNull()))
    newest = named.groupBy("task", "model_name").agg(F.max("seq").alias("seq"))
    candidates = named.join(newest, ["task", "model_name", "seq"])
    # Usually one record per model; the writer settles appends in the same nanosecond.
    last = F.max_by(F.struct(*[F.col(c) for c in named.columns]), "writer")
    return candidates.groupBy("task", F.col("model_name").alias("m")).agg(last.alias("r")).select("r.*")


def runs_for_model(history: DataFrame, task: str, model_name: str) -> DataFrame:
    """All records of one model in order of appending."""
    return history.filter((F.col("task") == task) & (F.col("model_name") == model_name)).orderBy("seq", "writer")


def comparison(
    history: DataFrame, task: str, expected: Sequence[tuple[str, str]] | None = None
) -> DataFrame:
    """One row per expected model with the metrics of its latest run; nulls where there is none."""
    models = history.sparkSession.createDataFrame(
        [(i, d, m) for i, (d, m) in enumerate(expected or EXPECTED_MODELS[task])],
        "place int, display_name string, model_name string",
    )
    wanted = [m for _, m in (expected or EXPECTED_MODELS[task])]
    latest = latest_run_per_model(_named(history).filter(F.col("model_name").isin(wanted)), task).select(
        "model_name", "timestamp", "metrics", F.lit(True).alias("found")
    )
    return (
        models.join(latest, "model_name", "left")
        .orderBy("place")
        .select(
            "display_name",
            "model_name",
            *[F.col(f"metrics.{m}").alias(m) for m in TABLE_METRICS[task]],
            F.replace(F.substring("timestamp", 1, 19), F.lit("T"), F.lit(" ")).alias("logged_at"),
            F.coalesce("found", F.lit(False)).alias("available"),
        )
    )


def evolution(
    history: DataFrame,
    task: str,
    model_name: str | None = None,
    metric: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """All runs of a model (or of every model) numbered from 1, each with its change.

    The change is measured from the last earlier run that has the metric. Models with fewer than two
    runs give no rows. A model may own most of the history, so its runs are numbered slice by slice.
    """
    value = F.col(f"metrics.{metric or MAIN_METRIC[task]}").cast("double")
    runs = _named(history.filter(F.col("task") == task))
    if model_name is not None:
        runs = runs.filter(F.col("model_name") == model_name)
    runs = runs.select(
        "model_name", "seq", F.struct("seq", "writer").alias("place"), "timestamp", value.alias("value"), "notes"
    )
    slicing = plan_slices(runs, "seq", rows_per_slice)
    sliced = assign_slices(runs, "seq", slicing)
    numbered = running(
        sliced,
        {
            "n": Running("sum", F.lit(1)),
            "previous": Running("last", F.col("value"), include_current=False),
            "runs": Running("whole", F.lit(1)),
        },
        "place",
        ["model_name"],
        single_slice=slicing.single,
    )
    delta = F.col("value") - F.col("previous")
    return numbered.filter("runs >= 2").select(
        "model_name",
        F.col("n").cast("int").alias("n"),
        F.replace(F.substring("timestamp", 1, 19), F.lit("T"), F.lit(" ")).alias("logged_at"),
        "value",
        delta.alias("delta"),
        direction(delta).alias("direction"),
        "notes",
    )


def verdict(
    history: DataFrame, task: str, baseline: str | None = None, model: str = NETWORK_NAME
) -> DataFrame:
    """One row that says how the latest run of the model compares with that of the baseline.

    ``verdict`` is missing_runs, missing_metric, better, worse or equal. Recall counts upwards with a
    tolerance, RMSE downwards without one. A metric that is no number is neither better nor worse.
    """
    baseline = baseline or BASELINE_NAME[task]
    metric = MAIN_METRIC[task]
    latest = latest_run_per_model(_named(history).filter(F.col("model_name").isin(baseline, model)), task)

    def of(name: str, field: Column) -> Column:
        return F.max(F.when(F.col("model_name") == name, field))

    has_baseline, has_model = (F.count_if(F.col("model_name") == n) > 0 for n in (baseline, model))
    pair = latest.agg(
        has_baseline.alias("has_baseline"),
        has_model.alias("has_model"),
        of(baseline, F.col(f"metrics.{metric}")).alias("baseline_value"),
        of(model, F.col(f"metrics.{metric}")).alias("model_value"),
        of(baseline, F.col("metrics.f1")).alias("baseline_f1"),
        of(model, F.col("metrics.f1")).alias("model_f1"),
    )
    missing = F.concat_ws(
        ",", F.when(~F.col("has_baseline"), F.lit(baseline)), F.when(~F.col("has_model"), F.lit(model))
    )
    difference = F.col("model_value") - F.col("baseline_value")
    gain, margin = (difference, RECALL_TOLERANCE) if task == "classification" else (-difference, 0.0)
    code = (
        F.when(~F.col("has_baseline") | ~F.col("has_model"), "missing_runs")
        .when(F.col("baseline_value").isNull() | F.col("model_value").isNull(), "missing_metric")
        .when(F.isnan(gain), "equal")
        .when(gain > margin, "better")
        .when(gain < -margin, "worse")
        .otherwise("equal")
    )
    columns = [
        F.lit(task).alias("task"),
        code.alias("verdict"),
        missing.alias("missing"),
        "baseline_value",
        "model_value",
        difference.alias("difference"),
    ]
    if task == "classification":
        columns += ["baseline_f1", "model_f1"]
    return pair.select(*columns)


def loss_series(epochs: DataFrame) -> DataFrame:
    """Loss curves as plot-ready rows: ``run_id, epoch, series, loss``."""
    return epochs.select(
        "run_id",
        "epoch",
        F.explode(
            F.array(
                F.struct(F.lit("train").alias("series"), F.col("train_loss").alias("loss")),
                F.struct(F.lit("val").alias("series"), F.col("val_loss").alias("loss")),
            )
        ).alias("s"),
    ).select("run_id", "epoch", "s.series", "s.loss")
