"""The given tables in the shape of the operators' inputs, as frames and as SQL.

The tables hold no nulls in these columns, so the views make some by rule.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.operators.network import MLPSpec, Parameters
from tabweave.operators.ordered import Running, assign_slices, plan_slices, running
from tabweave.operators.scoring import TabledParameters

NUMERIC = ("loan_amnt", "annual_inc")
CATEGORICAL = ("grade", "purpose")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    status = F.when(F.col("o_orderstatus") == "F", "Fully Paid").when(F.col("o_orderstatus") == "P", "Charged Off")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_totalprice").alias("loan_amnt"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("annual_inc"),
        status.otherwise("Current").alias("loan_status"),
        F.col("o_orderpriority").alias("grade"),
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("purpose"),
        F.round(5 + (F.col("o_custkey") % 97) / 4.0, 2).cast("double").alias("int_rate"),
    )


LOANS_SQL = """loans AS (
  SELECT o_orderkey AS loan_id, o_totalprice AS loan_amnt,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS annual_inc,
         CASE o_orderstatus WHEN 'F' THEN 'Fully Paid' WHEN 'P' THEN 'Charged Off' ELSE 'Current' END AS loan_status,
         o_orderpriority AS grade, nullif(c_mktsegment, 'HOUSEHOLD') AS purpose,
         CAST(round(5 + (o_custkey % 97) / 4.0, 2) AS DOUBLE) AS int_rate
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

# Rows that survive the filter, with filled categories and the label.
CLEAN_SQL = f"""{LOANS_SQL}, cleaned AS (
  SELECT loan_id, loan_amnt, annual_inc, loan_status, coalesce(grade, 'unknown') AS grade,
         coalesce(purpose, 'unknown') AS purpose, int_rate,
         CASE WHEN loan_status = 'Fully Paid' THEN 0 ELSE 1 END AS classification_target
  FROM loans WHERE loan_status IN ('Fully Paid', 'Charged Off')
)"""


# The split by position in the order of md5(seed:key), sizes truncated from the row count.
def split_sql(source: str, key: str, seed: int = 42) -> str:
    return f"""ranked AS (
  SELECT *, row_number() OVER (ORDER BY order_key) - 1 AS rank
  FROM (SELECT *, md5('{seed}:' || CAST({key} AS VARCHAR)) AS order_key FROM {source})
), sized AS (
  SELECT CAST(floor(0.70::DOUBLE * count(*)) AS BIGINT) AS train_end,
         CAST(floor(0.70::DOUBLE * count(*)) AS BIGINT) + CAST(floor(0.15::DOUBLE * count(*)) AS BIGINT) AS val_end
  FROM {source}
), divided AS (
  SELECT ranked.*, CASE WHEN rank < train_end THEN 'train' WHEN rank < val_end THEN 'val' ELSE 'test' END AS split
  FROM ranked, sized
)"""


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return documents.join(labels, "doc_id").select(
        "doc_id",
        F.col("quality").cast("int").alias("y"),
        F.round(F.col("n_chars") / (F.col("n_chars") + 1000), 3).alias("p1"),
    )


QUALITY_SQL = """scores AS (
  SELECT doc_id, CAST(quality AS INT) AS y,
         round(n_chars / (n_chars + 1000), 3) AS p1
  FROM documents JOIN labels USING (doc_id)
)"""


def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        "doc_id",
        F.col("toxic").cast("int").alias("y"),
        F.round((F.col("toxic") * 30 + (F.col("doc_id") * 37) % 71) / 101, 3).alias("p1"),
    )


TOXIC_SQL = """scores AS (
  SELECT doc_id, CAST(toxic AS INT) AS y, round((toxic * 30 + (doc_id * 37) % 71) / 101, 3) AS p1 FROM labels
)"""


def item_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score per line item, made from its price in cents; returned items score somewhat higher."""
    returned = (F.col("l_returnflag") == "R").cast("int")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return table(spark, sf_dir, "lineitem").select(
        returned.alias("y"), ((cents % 99_991 + returned * 15_000) / 120_000).alias("p1")
    )


ITEM_SQL = """scores AS (
  SELECT y, (CAST(round(l_extendedprice * 100) AS BIGINT) % 99991 + y * 15000) / 120000 AS p1
  FROM (SELECT CAST(l_returnflag = 'R' AS INT) AS y, l_extendedprice FROM lineitem)
)"""


def price_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * 1500).alias("pred"),
        (F.col("l_orderkey") % 64).alias("batch"),
    )


PAIRS_SQL = """pairs AS (
  SELECT l_extendedprice AS y, l_quantity * 1500 AS pred, l_orderkey % 64 AS batch FROM lineitem
)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records of both tasks: baselines, network, other models and runs without a model name.

    The divisors leave no value in the middle between two texts of four decimals.
    """
    cents = F.when(
        (F.col("event_type") != "error") & (F.col("value") >= 1),
        F.when(F.col("event_id") % 53 == 7, F.lit(float("nan"))).otherwise(F.round(F.col("value") * 100)),
    )
    classification = F.col("event_type").isin("view", "click")
    kind = F.col("user_id") % 6
    name = (
        F.when(kind == 0, F.when(classification, "baseline_logistic_regression").otherwise("baseline_linear_regression"))
        .when(kind == 1, "mlp")
        .when(kind < 5, F.concat(F.lit("m"), kind.cast("string")))
    )
    nothing = F.lit(None).cast("double")

    def of(task, value):
        return F.when(task, value).otherwise(nothing)

    return (
        table(spark, sf_dir, "events")
        .withColumn("m", cents)
        .select(
            F.concat(F.translate(F.substring(F.col("ts").cast("string"), 1, 19), " ", "T"), F.lit("+00:00"))
            .alias("timestamp"),
            F.when(classification, "classification").otherwise("regression").alias("task"),
            name.alias("model_name"),
            F.col("props").alias("notes"),
            F.struct(
                F.when(classification, "classification").otherwise("regression").alias("mode"),
                of(classification, F.lit(0.5)).alias("threshold"),
                of(classification, F.col("m") / 50_003).alias("accuracy"),
                of(classification, F.col("m") / 100_003).alias("precision"),
                of(classification, F.col("m") / 200_003).alias("recall"),
                of(classification, F.col("m") / 400_009).alias("f1"),
                of(~classification, F.col("m") / 50_000).alias("mae"),
                of(~classification, F.col("m") / 12_500).alias("mse"),
                of(~classification, F.col("m") / 25_000).alias("rmse"),
                of(~classification, (50_000 - F.col("m")) / 50_000).alias("r2"),
                F.lit(None).cast("array<array<bigint>>").alias("confusion_matrix"),
            ).alias("metrics"),
            F.col("event_id").alias("seq"),
            F.lit("").alias("writer"),
        )
    )


RUNS_SQL = """marked AS (
  SELECT *, event_type IN ('view', 'click') AS c, user_id % 6 AS kind,
         CASE WHEN event_type <> 'error' AND value >= 1
              THEN CASE WHEN event_id % 53 = 7 THEN 'NaN'::DOUBLE ELSE round(value * 100) END END AS m
  FROM events
), runs AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS timestamp,
         CASE WHEN c THEN 'classification' ELSE 'regression' END AS task,
         CASE WHEN kind = 0 AND c THEN 'baseline_logistic_regression'
              WHEN kind = 0 THEN 'baseline_linear_regression'
              WHEN kind = 1 THEN 'mlp'
              WHEN kind < 5 THEN 'm' || CAST(kind AS VARCHAR) END AS model_name,
         props AS notes,
         CASE WHEN c THEN m / 50003 END AS accuracy,
         CASE WHEN c THEN m / 100003 END AS precision,
         CASE WHEN c THEN m / 200003 END AS recall,
         CASE WHEN c THEN m / 400009 END AS f1,
         CASE WHEN NOT c THEN m / 50000 END AS mae,
         CASE WHEN NOT c THEN m / 12500 END AS mse,
         CASE WHEN NOT c THEN m / 25000 END AS rmse,
         CASE WHEN NOT c THEN (50000 - m) / 50000 END AS r2,
         event_id AS seq
  FROM marked
)"""


def epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch losses of one run per user, numbered in the order of the event log; one run has no id.

    A user may own most of the log, so the numbering goes slice by slice.
    """
    log = table(spark, sf_dir, "events").select(F.nullif("user_id", F.lit(7)).alias("user_id"), "event_id", "value")
    slicing = plan_slices(log, "event_id")
    numbered = running(
        assign_slices(log, "event_id", slicing),
        {"epoch": Running("sum", F.lit(1))},
        "event_id",
        ["user_id"],
        single_slice=slicing.single,
    )
    return numbered.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("epoch").cast("int").alias("epoch"),
        (F.col("value") * 0.9).alias("train_loss"),
        F.col("value").alias("val_loss"),
    )


EPOCHS_SQL = """epochs AS (
  SELECT CAST(nullif(user_id, 7) AS VARCHAR) AS run_id,
         CAST(row_number() OVER (PARTITION BY nullif(user_id, 7) ORDER BY event_id) AS INT) AS epoch,
         value * 0.9::DOUBLE AS train_loss, value AS val_loss
  FROM events
)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as features, with a binary label and batches of about 64 rows."""
    embeddings = table(spark, sf_dir, "embeddings")
    return embeddings.select(
        "vec_id",
        F.col("embedding").alias("features"),
        (F.col("label") % 2).cast("bigint").alias("label"),
        F.floor(F.col("vec_id") / 64).alias("batch"),
    )


VECTORS_SQL = """vectors AS (
  SELECT vec_id, embedding AS features, CAST(label % 2 AS BIGINT) AS label, CAST(floor(vec_id / 64.0) AS BIGINT) AS batch
  FROM embeddings
)"""


def formula_params(spec: MLPSpec) -> Parameters:
    """Weights by formula, so that SQL can make the same ones."""
    out: Parameters = {}
    for name, shape in spec.shapes().items():
        layer, kind = name.split(".")
        i = np.arange(shape[0])
        if kind == "weight":
            rows, columns = i[:, None], np.arange(shape[1])[None, :]
            first = ((rows * 31 + columns * 17) % 11 - 5) / 10
            later = ((rows * 7 + columns * 5) % 9 - 4) / 10
            out[name] = first if layer == "0" else later
        elif kind == "bias":
            out[name] = (i % 3 - 1) / 10 if layer == "0" else np.zeros(shape)
        else:
            base = {"gain": 1.0, "shift": 0.0, "running_mean": 0.1, "running_var": 0.5}[kind]
            out[name] = base + (i % 4) / 8
    return out


def formula_table(spark: SparkSession, spec: MLPSpec) -> TabledParameters:
    """The same weights with the first layer as a table, for widths that do not fit one place."""
    units, position = spec.linear_shapes[0][0], F.col("id")
    weights = [((i * 31 + position * 17) % 11 - 5) / 10 for i in range(units)]
    rest = formula_params(replace(spec, input_size=1))
    del rest["0.weight"]
    return TabledParameters(spark.range(spec.input_size).select(position.alias("position"), F.array(*weights).alias("weights")), rest)
