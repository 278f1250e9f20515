"""Run history, epoch history, report tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.catalog.registry import query
from tabweave.catalog.views import EPOCHS_SQL, ITEM_SQL, RUNS_SQL, epochs, item_scores, runs
from tabweave.functions.display import number_text
from tabweave.functions.scores import decide
from tabweave.operators.metrics import binary_aggregates
from tabweave.operators.runs import (
    TABLE_METRICS,
    comparison,
    evolution,
    latest_run_per_model,
    loss_series,
    runs_for_model,
    verdict,
)
from tabweave.plans.report import comparison_text, evolution_text, report
from tabweave.sources.history import (
    append_epochs,
    append_runs,
    fold_history,
    import_history,
    load_epochs,
    load_history,
    write_json,
)
from tabweave.sources.latest import maintained_latest
from tabweave.storage import scratch_path

METRICS = ("accuracy", "precision", "recall", "f1", "mae", "mse", "rmse", "r2")
METRIC_LIST = ", ".join(METRICS)


def flat(records: DataFrame) -> DataFrame:
    return records.select(
        "timestamp", "task", "model_name", "notes", *[F.col(f"metrics.{m}").alias(m) for m in METRICS], "seq"
    )


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run view through the append-only history, written in two appends."""
    path = scratch_path(spark, "history")
    records = runs(spark, sf_dir)
    append_runs(records.filter("task = 'classification'"), path)
    append_runs(records.filter("task = 'regression'"), path)
    return load_history(spark, path)


@query("s2_s3_run_history", f"WITH {RUNS_SQL} SELECT timestamp, task, model_name, notes, {METRIC_LIST}, seq FROM runs")
def s2_s3_run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(stored(spark, sf_dir))


@query("s3_folded_history", f"WITH {RUNS_SQL} SELECT timestamp, task, model_name, notes, {METRIC_LIST}, seq FROM runs")
def s3_folded_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history folded twice into sorted tables, with appends before, between and after."""
    path = scratch_path(spark, "history")
    records = runs(spark, sf_dir)
    for part in range(3):
        append_runs(records.filter(F.col("seq") % 3 == part), path)
        if part < 2:
            fold_history(spark, path)
    return flat(load_history(spark, path))


@query(
    "s3_broken_records",
    f"WITH {RUNS_SQL} SELECT timestamp, task, model_name, notes, {METRIC_LIST}, seq FROM runs WHERE model_name IS DISTINCT FROM 'm4'",
)
def s3_broken_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that are no JSON are left out on loading; here those of one model lose their braces."""
    path = scratch_path(spark, "broken-history")
    text = F.to_json(F.struct(*[F.col(c) for c in runs(spark, sf_dir).columns]))
    damaged = F.when(F.col("model_name") == "m4", F.translate(text, "{}", "")).otherwise(text)
    runs(spark, sf_dir).select(damaged.alias("value")).write.text(path)
    return flat(load_history(spark, path))


@query(
    "s4_json_result",
    f"""WITH {ITEM_SQL}
SELECT y, count(*) AS n, round(avg(p1), 6) AS mean FROM scores GROUP BY y""",
)
def s4_json_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result written twice to one place and read back."""
    path = scratch_path(spark, "result")
    result = item_scores(spark, sf_dir).groupBy("y").agg(F.count("*").alias("n"), F.round(F.avg("p1"), 6).alias("mean"))
    write_json(item_scores(spark, sf_dir).groupBy("y").agg(F.count("*").alias("n")), path)
    write_json(result, path)
    return spark.read.schema("y int, n bigint, mean double").json(path)


@query(
    "s5_epoch_history",
    f"WITH {EPOCHS_SQL} SELECT run_id, epoch, round(train_loss, 6) AS train_loss, val_loss FROM epochs",
)
def s5_epoch_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "epochs")
    append_epochs(epochs(spark, sf_dir), path)
    return load_epochs(spark, path).drop("metrics").withColumn("train_loss", F.round("train_loss", 6))


def written_arrays(records: DataFrame, order: str, path: str) -> None:
    """Rows as JSON arrays in order, one per range of them, in files whose names have the order of the ranges.

    This is the form of histories kept elsewhere, in parts.
    """
    text = F.to_json(F.struct(*[F.col(c) for c in records.columns if c != order])).alias("value")

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            lines = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([(before if i == 0 else ",") + t for i, t in enumerate(lines)])], ["value"])
            before = "," if lines else before
        yield pa.RecordBatch.from_arrays([pa.array(["]" if before == "," else "[]"])], ["value"])

    ranged = records.repartitionByRange(order).sortWithinPartitions(order)
    ranged.select(text).mapInArrow(bracketed, "value string").write.text(path)


@query(
    "s3_array_history",
    f"""WITH {RUNS_SQL}
SELECT timestamp, task, model_name, notes, {METRIC_LIST}, row_number() OVER (ORDER BY seq) - 1 AS seq,
       CASE WHEN seq % 3 = 0 THEN seq / 4 END AS latency FROM runs""",
)
def s3_array_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history kept as arrays, with a metric that records do not know, through import and append."""
    source, path = scratch_path(spark, "array-history"), scratch_path(spark, "history")
    latency = F.when(F.col("seq") % 3 == 0, F.col("seq") / 4)
    metrics = F.struct("metrics.*", latency.alias("latency"), F.lit("fast").alias("remark"))
    written_arrays(
        runs(spark, sf_dir).select("timestamp", "task", "model_name", metrics.alias("metrics"), "notes", "seq"), "seq", source
    )
    append_runs(import_history(spark, source), path)
    stored = load_history(spark, path)
    return flat(stored).join(stored.select("seq", F.col("extra")["latency"].alias("latency")), "seq")


@query(
    "s2_extra_metrics",
    f"""WITH {RUNS_SQL}
SELECT seq, round(m * 3, 4) AS auc, seq % 7 AS depth FROM runs JOIN (SELECT event_id AS seq, m FROM marked) USING (seq)""",
)
def s2_extra_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics under names of their own survive the history, null and NaN included."""
    path = scratch_path(spark, "history")
    records = runs(spark, sf_dir)
    m = F.coalesce(F.col("metrics.accuracy") * 50_003, F.col("metrics.mae") * 50_000)
    extra = F.map_from_arrays(F.array(F.lit("auc"), F.lit("depth")), F.array(m * 3, (F.col("seq") % 7).cast("double")))
    append_runs(records.withColumn("extra", extra), path)
    return load_history(spark, path).select(
        "seq", F.round(F.col("extra")["auc"], 4).alias("auc"), F.col("extra")["depth"].cast("bigint").alias("depth")
    )


@query(
    "s5_epoch_metrics",
    f"""WITH {EPOCHS_SQL}
SELECT run_id, epoch, val_loss, CASE WHEN epoch % 2 = 0 THEN epoch / 8 END AS val_f1, epoch * 2.0::DOUBLE AS train_grad_norm FROM epochs""",
)
def s5_epoch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch records with metrics beside the losses."""
    path = scratch_path(spark, "epochs")
    f1 = F.when(F.col("epoch") % 2 == 0, F.col("epoch") / 8)
    norm = F.col("epoch") * F.lit(2.0)
    named = F.map_from_arrays(F.array(F.lit("val_f1"), F.lit("train_grad_norm")), F.array(f1, norm))
    append_epochs(epochs(spark, sf_dir).withColumn("metrics", named), path)
    return load_epochs(spark, path).select(
        "run_id", "epoch", "val_loss", *[F.col("metrics")[n].alias(n) for n in ("val_f1", "train_grad_norm")]
    )


LATEST_SQL = f"""{RUNS_SQL}, named AS (
  SELECT * REPLACE (coalesce(model_name, 'desconhecido') AS model_name) FROM runs
), newest AS (
  SELECT task, model_name, max(seq) AS seq FROM named GROUP BY task, model_name
), latest AS (
  SELECT named.* FROM named JOIN newest ON named.task = newest.task AND named.model_name = newest.model_name AND named.seq = newest.seq
)"""


@query(
    "h1_latest_runs",
    f"""WITH {LATEST_SQL}
SELECT timestamp, task, model_name, notes, {METRIC_LIST}, seq FROM latest WHERE task = 'classification'""",
)
def h1_latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(latest_run_per_model(runs(spark, sf_dir), "classification"))


@query(
    "h1_maintained_latest",
    f"""WITH {LATEST_SQL} SELECT timestamp, task, model_name, notes, {METRIC_LIST}, seq FROM latest""",
)
def h1_maintained_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest runs brought up to date after every append, with the history folded in between."""
    path = scratch_path(spark, "history")
    records = runs(spark, sf_dir)
    for part in range(3):
        append_runs(records.filter(F.col("seq") % 3 == part), path)
        latest = maintained_latest(spark, path)
        if part == 1:
            fold_history(spark, path)
    return flat(latest)


@query(
    "h2_runs_of_model",
    f"""WITH {RUNS_SQL} SELECT timestamp, task, model_name, notes, {METRIC_LIST}, seq FROM runs
WHERE task = 'regression' AND model_name = 'm3' ORDER BY seq""",
)
def h2_runs_of_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(runs_for_model(runs(spark, sf_dir), "regression", "m3"))


EXPECTED = {
    "classification": [("Baseline", "baseline_logistic_regression"), ("MLP", "mlp"), ("Never run", "m9")],
    "regression": [("Baseline", "baseline_linear_regression"), ("MLP", "mlp"), ("Never run", "m9")],
}


def comparison_sql(task: str, models: list[tuple[str, str]] | None = None) -> str:
    expected = ", ".join(f"('{d}', '{m}')" for d, m in models or EXPECTED[task])
    metrics = ", ".join(TABLE_METRICS[task])
    return f"""WITH {LATEST_SQL}, expected(display_name, model_name) AS (VALUES {expected}), compared AS (
  SELECT display_name, expected.model_name, {metrics}, replace(substr(timestamp, 1, 19), 'T', ' ') AS logged_at,
         latest.seq IS NOT NULL AS available
  FROM expected LEFT JOIN latest ON latest.model_name = expected.model_name AND latest.task = '{task}'
)"""


@query("h3_comparison_classification", comparison_sql("classification") + " SELECT * FROM compared")
def h3_comparison_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparison(runs(spark, sf_dir), "classification", EXPECTED["classification"])


@query("h3_comparison_regression", comparison_sql("regression") + " SELECT * FROM compared")
def h3_comparison_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparison(runs(spark, sf_dir), "regression", EXPECTED["regression"])


def evolution_sql(task: str, metric: str, where: str) -> str:
    return f"""WITH {RUNS_SQL}, mine AS (
  SELECT coalesce(model_name, 'desconhecido') AS model_name, timestamp, notes, {metric} AS value, seq
  FROM runs WHERE task = '{task}'
), numbered AS (
  SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY model_name) AS times,
         last_value(value IGNORE NULLS) OVER (PARTITION BY model_name ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous
  FROM mine WHERE {where} WINDOW w AS (PARTITION BY model_name ORDER BY seq)
), changed AS (
  SELECT model_name, CAST(n AS INT) AS n, replace(substr(timestamp, 1, 19), 'T', ' ') AS logged_at, value,
         value - previous AS delta, notes
  FROM numbered WHERE times >= 2
)"""


DIRECTION_SQL = "CASE WHEN isnan(delta) THEN 'flat' WHEN delta > 0 THEN 'up' WHEN delta < 0 THEN 'down' WHEN delta = 0 THEN 'flat' END AS direction"


@query(
    "h4_evolution_of_model",
    evolution_sql("classification", "recall", "model_name = 'mlp'")
    + f" SELECT model_name, n, logged_at, value, round(delta, 6) AS delta, {DIRECTION_SQL}, notes FROM changed",
)
def h4_evolution_of_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = evolution(runs(spark, sf_dir), "classification", "mlp", rows_per_slice=100)
    return table.withColumn("delta", F.round("delta", 6))


@query(
    "h4_evolution_of_all",
    evolution_sql("regression", "rmse", "true")
    + f" SELECT model_name, n, logged_at, value, round(delta, 6) AS delta, {DIRECTION_SQL}, notes FROM changed",
)
def h4_evolution_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every model at once, numbered over several slices."""
    table = evolution(runs(spark, sf_dir), "regression", rows_per_slice=500)
    return table.withColumn("delta", F.round("delta", 6))


def verdict_sql(task: str, metric: str, baseline: str, model: str, better: str, worse: str, extra: str = "") -> str:
    def of(name: str, field: str) -> str:
        return f"(SELECT {field} FROM latest WHERE task = '{task}' AND model_name = '{name}')"

    return f"""WITH {LATEST_SQL}, pair AS (
  SELECT {of(baseline, 'count(*)')} AS has_b, {of(model, 'count(*)')} AS has_m, {of(baseline, metric)} AS b, {of(model, metric)} AS m,
         {of(baseline, 'f1')} AS bf, {of(model, 'f1')} AS mf
)
SELECT '{task}' AS task,
       CASE WHEN has_b = 0 OR has_m = 0 THEN 'missing_runs' WHEN b IS NULL OR m IS NULL THEN 'missing_metric'
            WHEN isnan(m - b) THEN 'equal' WHEN {better} THEN 'better' WHEN {worse} THEN 'worse' ELSE 'equal' END AS verdict,
       concat_ws(',', CASE WHEN has_b = 0 THEN '{baseline}' END, CASE WHEN has_m = 0 THEN '{model}' END) AS missing,
       b AS baseline_value, m AS model_value, round(m - b, 6) AS difference{extra}
FROM pair"""


RECALL_RULE = ("m - b > 1e-9", "m - b < -1e-9")
RMSE_RULE = ("m < b", "m > b")


@query(
    "h5_classification_verdict",
    verdict_sql(
        "classification", "recall", "baseline_logistic_regression", "mlp", *RECALL_RULE,
        ", bf AS baseline_f1, mf AS model_f1",
    ),
)
def h5_classification_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict(runs(spark, sf_dir), "classification").withColumn("difference", F.round("difference", 6))


@query("h6_regression_verdict", verdict_sql("regression", "rmse", "baseline_linear_regression", "mlp", *RMSE_RULE))
def h6_regression_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict(runs(spark, sf_dir), "regression").withColumn("difference", F.round("difference", 6))


@query("h6_verdict_without_runs", verdict_sql("regression", "rmse", "m2", "m9", *RMSE_RULE))
def h6_verdict_without_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The named model never ran."""
    table = verdict(runs(spark, sf_dir), "regression", "m2", "m9")
    return table.withColumn("difference", F.round("difference", 6))


def text_sql(column: str, digits: int = 4) -> str:
    return f"coalesce(printf('%.{digits}f', {column}), 'N/D')"


@query(
    "h7_comparison_text",
    comparison_sql("regression")
    + f""" SELECT display_name, {text_sql('mae', 6)} AS mae, {text_sql('mse', 6)} AS mse, {text_sql('rmse', 6)} AS rmse,
       {text_sql('r2')} AS r2, CASE WHEN available THEN logged_at ELSE 'sem execução registrada' END AS logged_at
FROM compared""",
)
def h7_comparison_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparison_text(comparison(runs(spark, sf_dir), "regression", EXPECTED["regression"]), "regression")


@query(
    "h7_evolution_text",
    evolution_sql("regression", "rmse", "true")
    + f""" SELECT model_name, CAST(n AS VARCHAR) AS n, logged_at, {text_sql('value', 6)} AS rmse,
       CASE WHEN delta IS NULL THEN '-'
            ELSE CASE WHEN isnan(delta) THEN '→' WHEN delta > 0 THEN '▲' WHEN delta < 0 THEN '▼' ELSE '→' END || ' ' || printf('%+.6f', delta) END AS delta,
       coalesce(nullif(notes, ''), '-') AS notes
FROM changed""",
)
def h7_evolution_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evolution_text(evolution(runs(spark, sf_dir), "regression"), "regression")


@query(
    "h8_loss_series",
    f"""WITH {EPOCHS_SQL}
SELECT run_id, epoch, 'train' AS series, round(train_loss, 6) AS loss FROM epochs
UNION ALL SELECT run_id, epoch, 'val', round(val_loss, 6) FROM epochs""",
)
def h8_loss_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loss_series(epochs(spark, sf_dir)).withColumn("loss", F.round("loss", 6))


@query(
    "h9_report",
    f"""WITH {RUNS_SQL}, {EPOCHS_SQL}
SELECT 'runs' AS name, count(DISTINCT task) AS rows FROM runs
UNION ALL SELECT 'classification_comparison', 2
UNION ALL SELECT 'classification_evolution', count(*) FROM runs WHERE task = 'classification' AND model_name = 'mlp'
UNION ALL SELECT 'classification_verdict', 1
UNION ALL SELECT 'regression_comparison', 2
UNION ALL SELECT 'regression_evolution', count(*) FROM runs WHERE task = 'regression' AND model_name = 'mlp'
UNION ALL SELECT 'regression_verdict', 1
UNION ALL SELECT 'classification_loss_curve', 2 * count(*) FROM epochs
UNION ALL SELECT 'notices', 1""",
)
def h9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report from a stored history: rows in each table it wrote.

    One task has stored epochs, the other gets a notice.
    """
    out = scratch_path(spark, "report")
    names = report(stored(spark, sf_dir), {"classification": epochs(spark, sf_dir)}, out)
    sizes = None
    for name in names:
        table = spark.read.text(f"{out}/{name}").agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"))
        sizes = table if sizes is None else sizes.unionByName(table)
    return sizes


def cells_sql(name: str, source: str, cells: list[str]) -> str:
    listed = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cells)
    return f"SELECT '{name}' AS name, concat_ws('|', {listed}) AS cells FROM ({source})"


def report_cells_sql() -> str:
    parts = []
    expected = {
        "classification": [("Regressão Logística (Baseline)", "baseline_logistic_regression"), ("MLP", "mlp")],
        "regression": [("Regressão Linear (Baseline)", "baseline_linear_regression"), ("MLP", "mlp")],
    }
    rules = {"classification": ("recall", "baseline_logistic_regression", RECALL_RULE), "regression": ("rmse", "baseline_linear_regression", RMSE_RULE)}
    for task, digits in (("classification", 4), ("regression", 6)):
        metric, baseline, rule = rules[task]
        texts = [text_sql(m, 6 if m in ("mae", "mse", "rmse") else 4) for m in TABLE_METRICS[task]]
        logged = "CASE WHEN available THEN logged_at ELSE 'sem execução registrada' END"
        parts.append(
            cells_sql(f"{task}_comparison", comparison_sql(task, expected[task]) + " SELECT * FROM compared", ["display_name", *texts, logged])
        )
        delta = (
            "CASE WHEN delta IS NULL THEN '-' ELSE CASE WHEN isnan(delta) THEN '→' WHEN delta > 0 THEN '▲' WHEN delta < 0 THEN '▼' "
            f"ELSE '→' END || ' ' || printf('%+.{digits}f', delta) END"
        )
        parts.append(
            cells_sql(
                f"{task}_evolution",
                evolution_sql(task, metric, "model_name = 'mlp'") + " SELECT * FROM changed",
                ["model_name", "n", "logged_at", text_sql("value", digits), delta, "coalesce(nullif(notes, ''), '-')"],
            )
        )
        values = [text_sql(v, 6) for v in ("baseline_value", "model_value", "difference")]
        parts.append(
            cells_sql(f"{task}_verdict", verdict_sql(task, metric, baseline, "mlp", *rule), ["task", "verdict", "missing", *values])
        )
    parts.append(cells_sql("runs", f"WITH {RUNS_SQL} SELECT task, count(*) AS n FROM runs GROUP BY task", ["task", "n"]))
    parts.append("SELECT 'notices', 'regression|no_loss_curve'")
    curve = f"""WITH {EPOCHS_SQL} SELECT run_id, epoch, 'train' AS series, train_loss AS loss FROM epochs
UNION ALL SELECT run_id, epoch, 'val', val_loss FROM epochs"""
    parts.append(cells_sql("classification_loss_curve", curve, ["run_id", "epoch", "series", "printf('%.6f', loss)"]))
    return "\nUNION ALL ".join(f"({p})" for p in parts)


def _cells(table: DataFrame, name: str, columns: list) -> DataFrame:
    listed = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return table.select(F.lit(name).alias("name"), F.concat_ws("|", *listed).alias("cells"))


@query("h9_report_cells", report_cells_sql())
def h9_report_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report from a stored history, every cell of every table it wrote."""
    out = scratch_path(spark, "report")
    names = report(stored(spark, sf_dir), {"classification": epochs(spark, sf_dir)}, out)
    found = None
    for name in names:
        task = name.split("_")[0]
        if name.endswith("_comparison"):
            columns = ["display_name", *TABLE_METRICS[task], "logged_at"]
        elif name.endswith("_evolution"):
            columns = ["model_name", "n", "logged_at", {"classification": "recall", "regression": "rmse"}[task], "delta", "notes"]
        elif name.endswith("_verdict"):
            columns = ["task", "verdict", "missing", "baseline_value", "model_value", "difference"]
        else:
            columns = {"runs": ["task", "runs"], "notices": ["task", "notice"]}.get(name, ["run_id", "epoch", "series", "loss"])
        kinds = {"baseline_value": "double", "model_value": "double", "difference": "double", "loss": "double"}
        table = spark.read.schema(", ".join(f"{c} {kinds.get(c, 'string')}" for c in columns)).json(f"{out}/{name}")
        shown = [number_text(F.col(c), 6) if c in kinds else F.col(c) for c in columns]
        part = _cells(table, name, shown)
        found = part if found is None else found.unionByName(part)
    return found


@query(
    "evaluated_runs",
    f"""WITH {ITEM_SQL}, cut AS (SELECT CAST(c / 10 AS DOUBLE) AS threshold FROM range(1, 10) AS s(c)), decided AS (
  SELECT threshold, y, CAST(p1 >= threshold AS INT) AS pred FROM scores CROSS JOIN cut
), counts AS (
  SELECT threshold, count(*) AS n, count(*) FILTER (WHERE y = pred) AS hits, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp,
         count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp, count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn
  FROM decided GROUP BY threshold
)
SELECT threshold, round(hits / n, 6) AS accuracy, coalesce(round(tp / nullif(tp + fp, 0), 6), 0) AS precision,
       coalesce(round(tp / nullif(tp + fn, 0), 6), 0) AS recall, coalesce(round(2 * tp / nullif(2 * tp + fp + fn, 0), 6), 0) AS f1
FROM counts""",
)
def evaluated_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics at several cutoffs from one pass over the scores."""
    cutoffs = [c / 10 for c in range(1, 10)]
    decided = item_scores(spark, sf_dir).select(
        "y", *[decide(F.col("p1"), c).alias(f"pred_{i}") for i, c in enumerate(cutoffs)]
    )
    lines = decided.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("threshold"), *[m.alias(n) for n, m in binary_aggregates("y", f"pred_{i}").items()])
                for i, c in enumerate(cutoffs)
            ]
        ).alias("lines")
    )
    return lines.select(F.explode("lines").alias("l")).select(
        "l.threshold", *[F.round(f"l.{m}", 6).alias(m) for m in ("accuracy", "precision", "recall", "f1")]
    )
