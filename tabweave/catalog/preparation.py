"""Sources, projection, labels, encoding, shuffle, split, statistics and scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.catalog.registry import query
from tabweave.catalog.views import CATEGORICAL, CLEAN_SQL, LOANS_SQL, NUMERIC, loans, split_sql, table
from tabweave.operators.classes import class_counts, class_weights
from tabweave.operators.encode import (
    assemble,
    fill_categories,
    fit_vocabulary,
    keep_members,
    label_rows,
    one_hot,
    one_hot_positions,
    project,
    vocabulary_table,
)
from tabweave.operators.group_statistics import group_medians
from tabweave.operators.ordered import Running, assign_slices, plan_slices, running
from tabweave.operators.scaling import fit_scaling, impute, scaling_table, standardize
from tabweave.operators.shuffle_split import seeded_shuffle, three_way_split
from tabweave.plans.prepare import clean, prepare
from tabweave.sources.csv import scan_csv
from tabweave.sources.schemas import LOAN_KEPT_STATUS
from tabweave.storage import scratch_path

KEY = ["loan_id"]
# Values of the given tables: order priorities and market segments, the hidden one made "unknown".
GRADES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
PURPOSES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "unknown")

DIVIDED_SQL = f"{CLEAN_SQL}, {split_sql('cleaned', 'loan_id')}"
STATS_SQL = """stats AS (
  SELECT median(loan_amnt) AS loan_median, avg(loan_amnt) AS loan_mean,
         coalesce(nullif(stddev_samp(loan_amnt), 0), 1.0) AS loan_std,
         median(annual_inc) AS inc_median, avg(annual_inc) AS inc_mean,
         coalesce(nullif(stddev_samp(annual_inc), 0), 1.0) AS inc_std
  FROM divided WHERE split = 'train'
)"""
ENCODED_SQL = ",\n".join(
    [f"CAST(grade = '{v}' AS TINYINT) AS \"grade_{v}\"" for v in GRADES]
    + [f"CAST(purpose = '{v}' AS TINYINT) AS \"purpose_{v}\"" for v in PURPOSES]
)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(loans(spark, sf_dir), CATEGORICAL)


def divided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return three_way_split(cleaned(spark, sf_dir), key=KEY)


def prepared(spark: SparkSession, sf_dir: str):
    # The join behind the view is worth doing once.
    return prepare(loans(spark, sf_dir), NUMERIC, CATEGORICAL, key=KEY, stage=True)


@query(
    "s1_csv_scan",
    f"""WITH {LOANS_SQL}
SELECT loan_id, CASE WHEN grade = '5-LOW' THEN NULL ELSE loan_amnt END AS loan_amnt, annual_inc, purpose, int_rate
FROM loans""",
)
def s1_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan view through a CSV with an unused column and damaged cells."""
    path = scratch_path(spark, "loans-csv")
    damaged = F.when(F.col("grade") == "5-LOW", "oops").otherwise(F.concat(F.lit(" "), F.col("loan_amnt")))
    loans(spark, sf_dir).select(
        F.lit("a,b").alias("unused"), "purpose", damaged.alias("loan_amnt"), "int_rate", "annual_inc", "loan_id"
    ).write.csv(path, header=True, ignoreLeadingWhiteSpace=False)
    types = {"loan_id": "bigint", "loan_amnt": "double", "annual_inc": "double", "int_rate": "double"}
    return scan_csv(spark, path, types).select("loan_id", "loan_amnt", "annual_inc", "purpose", "int_rate")


@query(
    "s1_quoted_breaks",
    f"""WITH {LOANS_SQL}
SELECT loan_id, loan_amnt, grade || ', "' || coalesce(purpose, '') || '"' || chr(10) || CAST(int_rate AS VARCHAR) AS note FROM loans""",
)
def s1_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with quotes, commas and line breaks; the files are split all the same."""
    path = scratch_path(spark, "notes-csv")
    quote = F.lit('"')
    note = F.concat(F.col("grade"), F.lit(", "), quote, F.coalesce("purpose", F.lit("")), quote, F.lit("\n"), F.col("int_rate"))
    loans(spark, sf_dir).select("loan_id", note.alias("note"), "loan_amnt").write.csv(path, header=True, escape='"')
    found = scan_csv(spark, path, {"loan_id": "bigint", "loan_amnt": "double"}, multi_line=True)
    return found.select("loan_id", "loan_amnt", "note")


@query("p1_projection", f"WITH {LOANS_SQL} SELECT loan_id, loan_amnt, grade, int_rate FROM loans")
def p1_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(loans(spark, sf_dir), ["loan_id", "loan_amnt", "grade", "int_rate"])


@query(
    "p2_membership_filter",
    f"WITH {LOANS_SQL} SELECT loan_id, loan_status FROM loans WHERE loan_status IN ('Fully Paid', 'Charged Off')",
)
def p2_membership_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_members(loans(spark, sf_dir), "loan_status", LOAN_KEPT_STATUS).select("loan_id", "loan_status")


@query(
    "p3_fill_categories",
    f"""WITH {LOANS_SQL}
SELECT loan_id, coalesce(grade, 'unknown') AS grade, coalesce(purpose, 'unknown') AS purpose FROM loans""",
)
def p3_fill_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_categories(loans(spark, sf_dir), CATEGORICAL).select("loan_id", *CATEGORICAL)


@query("p4_label", f"WITH {CLEAN_SQL} SELECT loan_id, loan_status, classification_target FROM cleaned")
def p4_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = keep_members(loans(spark, sf_dir), "loan_status", LOAN_KEPT_STATUS)
    return label_rows(kept, "loan_status", "Fully Paid").select("loan_id", "loan_status", "classification_target")


@query("p5_one_hot", f"WITH {CLEAN_SQL} SELECT loan_id, {ENCODED_SQL} FROM cleaned")
def p5_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaned(spark, sf_dir).select("loan_id", *CATEGORICAL)
    return one_hot(rows, fit_vocabulary(rows, CATEGORICAL))


@query(
    "p5_one_hot_positions",
    """WITH pairs AS (
  SELECT l_orderkey * 10 + l_linenumber AS line_id, 0 AS place, CAST(l_partkey AS VARCHAR) AS value FROM lineitem
  UNION ALL SELECT l_orderkey * 10 + l_linenumber, 1, CAST(l_suppkey AS VARCHAR) FROM lineitem
  UNION ALL SELECT l_orderkey * 10 + l_linenumber, 2, nullif(l_returnflag, 'N') FROM lineitem
), vocabulary AS (
  SELECT place, value, row_number() OVER (ORDER BY place, value) - 1 AS position
  FROM (SELECT DISTINCT place, value FROM pairs WHERE value IS NOT NULL)
)
SELECT line_id, array_to_string(list(position ORDER BY position) FILTER (WHERE position IS NOT NULL), ',') AS positions
FROM pairs LEFT JOIN vocabulary USING (place, value) GROUP BY line_id""",
)
def p5_one_hot_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and suppliers have too many values for columns; where their ones are is kept instead."""
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"),
        "l_partkey",
        "l_suppkey",
        F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
    )
    columns = ["l_partkey", "l_suppkey", "l_returnflag"]
    found = one_hot_positions(lines, vocabulary_table(lines, columns), columns, "line_id")
    return found.select("line_id", F.array_join("positions", ",").alias("positions"))


@query(
    "p6_assemble",
    f"""WITH {CLEAN_SQL}, encoded AS (
  SELECT loan_id, classification_target,
         [CAST(loan_amnt AS FLOAT), CAST(coalesce(annual_inc, 0) AS FLOAT),
          {", ".join([f"CAST(grade = '{v}' AS FLOAT)" for v in GRADES])},
          {", ".join([f"CAST(purpose = '{v}' AS FLOAT)" for v in PURPOSES])}] AS features
  FROM cleaned
)
SELECT loan_id, CAST(classification_target AS BIGINT) AS label, CAST(i AS INT) AS position,
       CAST(features[i + 1] AS DOUBLE) AS feature
FROM encoded, generate_series(0, 11) AS g(i)""",
)
def p6_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature arrays, one row per element so that values can be compared one by one."""
    rows = cleaned(spark, sf_dir).withColumn("annual_inc", F.coalesce("annual_inc", F.lit(0.0)))
    ordered = rows.select("loan_id", *NUMERIC, *CATEGORICAL, "loan_status", "int_rate", "classification_target")
    encoded = one_hot(ordered, fit_vocabulary(rows, CATEGORICAL))
    return assemble(encoded, "classification", keep=["loan_id"]).select(
        "loan_id", "label", F.posexplode("features").alias("position", "feature")
    ).withColumn("feature", F.col("feature").cast("double"))


@query(
    "p7_split_sizes",
    f"WITH {DIVIDED_SQL} SELECT split, count(*) AS rows, 15 AS width FROM divided GROUP BY split",
)
def p7_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per split; 2 numeric, 10 one-hot and 3 label columns."""
    return prepared(spark, sf_dir).sizes()


@query(
    "x1_seeded_shuffle",
    f"""WITH {LOANS_SQL}
SELECT loan_id, md5('7:' || CAST(loan_id AS VARCHAR)) AS order_key,
       row_number() OVER (ORDER BY md5('7:' || CAST(loan_id AS VARCHAR))) - 1 AS rank
FROM loans""",
)
def x1_seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeded_shuffle(loans(spark, sf_dir).select("loan_id"), seed=7, key=KEY)


@query("x2_three_way_split", f"WITH {DIVIDED_SQL} SELECT loan_id, order_key, split FROM divided")
def x2_three_way_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divided(spark, sf_dir).select("loan_id", "order_key", "split")


@query(
    "x2_split_of_copies",
    """WITH copies AS (
  SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL
), keyed AS (
  SELECT *, md5('42:{"o_orderstatus":"' || o_orderstatus || '","o_orderpriority":"' || o_orderpriority || '"}') AS order_key
  FROM copies
), placed AS (
  SELECT *, sum(n) OVER (ORDER BY order_key) - n AS first, sum(n) OVER (ORDER BY order_key) AS last,
         CAST(floor(0.70::DOUBLE * sum(n) OVER ()) AS BIGINT) AS train_end,
         CAST(floor(0.70::DOUBLE * sum(n) OVER ()) AS BIGINT) + CAST(floor(0.15::DOUBLE * sum(n) OVER ()) AS BIGINT) AS val_end
  FROM keyed
), dealt AS (
  SELECT o_orderstatus, o_orderpriority, 'train' AS split, greatest(least(last, train_end) - first, 0) AS n FROM placed
  UNION ALL
  SELECT o_orderstatus, o_orderpriority, 'val', greatest(least(last, val_end) - greatest(first, train_end), 0) FROM placed
  UNION ALL
  SELECT o_orderstatus, o_orderpriority, 'test', greatest(last - greatest(first, val_end), 0) FROM placed
)
SELECT o_orderstatus, o_orderpriority, split, CAST(n AS BIGINT) AS n FROM dealt WHERE n > 0""",
)
def x2_split_of_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key and with many copies: sizes stay exact across groups of equal rows."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderstatus", "o_orderpriority")
    return three_way_split(rows).groupBy("o_orderstatus", "o_orderpriority", "split").agg(F.count("*").alias("n"))


@query(
    "x3_running_totals",
    """SELECT o_orderkey,
       round(CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER w AS DOUBLE) / 100, 2) AS total,
       max(o_totalprice) OVER w AS highest, count(*) OVER w AS place
FROM orders WINDOW w AS (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def x3_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global running sum, maximum and position in key order."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    slicing = plan_slices(orders, "o_orderkey", rows_per_slice=5_000)
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    out = running(
        assign_slices(orders, "o_orderkey", slicing),
        {
            "cents": Running("sum", cents),
            "highest": Running("max", F.col("o_totalprice")),
            "place": Running("sum", F.lit(1).cast("bigint")),
        },
        "o_orderkey",
        single_slice=slicing.single,
    )
    return out.select(
        "o_orderkey", F.round(F.col("cents").cast("double") / 100, 2).alias("total"), "highest", "place"
    )


@query(
    "a1_fit_scaling",
    f"""WITH {DIVIDED_SQL}, {STATS_SQL}
SELECT 'loan_amnt' AS feature, round(loan_median, 4) AS median, round(loan_mean, 4) AS mean, round(loan_std, 4) AS std
FROM stats
UNION ALL SELECT 'annual_inc', round(inc_median, 4), round(inc_mean, 4), round(inc_std, 4) FROM stats""",
)
def a1_fit_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = divided(spark, sf_dir).filter("split = 'train'")
    return scaling_table(spark, fit_scaling(train, NUMERIC)).select(
        "feature", *[F.round(c, 4).alias(c) for c in ("median", "mean", "std")]
    )


@query(
    "a1_exact_median",
    """SELECT l_returnflag AS flag, median(l_extendedprice) AS price_median, median(l_quantity) AS quantity_median,
       median(l_discount) AS discount_median
FROM lineitem GROUP BY l_returnflag""",
)
def a1_exact_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians over the line items by narrowing ranges, one set per return flag."""
    items = table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "flag")
    medians = group_medians(items, ["flag"], ["l_extendedprice", "l_quantity", "l_discount"])
    return medians.toDF("flag", "price_median", "quantity_median", "discount_median")


@query(
    "a1_group_medians",
    """WITH items AS (
  SELECT CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_orderkey END AS order_id, l_extendedprice, l_quantity,
         nullif(l_discount, 0.05) AS l_discount
  FROM lineitem
)
SELECT order_id, median(l_extendedprice) AS price_median, median(l_quantity) AS quantity_median,
       round(median(l_discount), 6) AS discount_median
FROM items GROUP BY order_id""",
)
def a1_group_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians per order with a returned or accepted line; all other lines are one group without an order."""
    order = F.when(F.col("l_returnflag") != "N", F.col("l_orderkey")).alias("order_id")
    items = table(spark, sf_dir, "lineitem").select(
        order, "l_extendedprice", "l_quantity", F.nullif("l_discount", F.lit(0.05)).alias("l_discount")
    )
    medians = group_medians(items, ["order_id"], ["l_extendedprice", "l_quantity", "l_discount"], in_memory_rows=1_000)
    return medians.toDF("order_id", "price_median", "quantity_median", "discount_median").withColumn(
        "discount_median", F.round("discount_median", 6)
    )


@query(
    "a2_impute",
    f"""WITH {DIVIDED_SQL}, {STATS_SQL}
SELECT loan_id, split, coalesce(loan_amnt, loan_median) AS loan_amnt, coalesce(annual_inc, inc_median) AS annual_inc
FROM divided, stats""",
)
def a2_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = divided(spark, sf_dir)
    scales = fit_scaling(rows.filter("split = 'train'"), NUMERIC)
    return impute(rows, scales).select("loan_id", "split", *NUMERIC)


@query(
    "a3_standardize",
    f"""WITH {DIVIDED_SQL}, {STATS_SQL}
SELECT loan_id, split, round((coalesce(loan_amnt, loan_median) - loan_mean) / loan_std, 6) AS loan_amnt,
       round((coalesce(annual_inc, inc_median) - inc_mean) / inc_std, 6) AS annual_inc
FROM divided, stats""",
)
def a3_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = divided(spark, sf_dir)
    scales = fit_scaling(rows.filter("split = 'train'"), NUMERIC)
    return standardize(impute(rows, scales), scales).select(
        "loan_id", "split", *[F.round(c, 6).alias(c) for c in NUMERIC]
    )


@query(
    "a4_class_counts",
    f"""WITH {CLEAN_SQL}
SELECT CAST(i AS INT) AS class_id, CAST(count(classification_target) AS BIGINT) AS n, (SELECT count(*) FROM cleaned) AS total
FROM generate_series(0, 2) AS g(i) LEFT JOIN cleaned ON classification_target = i GROUP BY i""",
)
def a4_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three classes, one of them absent."""
    return class_counts(cleaned(spark, sf_dir), "classification_target", num_classes=3)


@query(
    "a5_class_weights",
    f"""WITH {DIVIDED_SQL}, train AS (SELECT * FROM divided WHERE split = 'train'), counted AS (
  SELECT CAST(i AS INT) AS class_id, CAST(count(classification_target) AS BIGINT) AS n
  FROM generate_series(0, 1) AS g(i) LEFT JOIN train ON classification_target = i GROUP BY i
)
SELECT class_id, n, round((SELECT count(*) FROM train) / (2.0 * greatest(n, 1)), 6) AS weight FROM counted""",
)
def a5_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = divided(spark, sf_dir).filter("split = 'train'")
    return class_weights(train, "classification_target").withColumn("weight", F.round("weight", 6))


@query(
    "prepared_table",
    f"""WITH {DIVIDED_SQL}, {STATS_SQL}
SELECT order_key, split, loan_status, classification_target, int_rate,
       round((coalesce(loan_amnt, loan_median) - loan_mean) / loan_std, 6) AS loan_amnt,
       round((coalesce(annual_inc, inc_median) - inc_mean) / inc_std, 6) AS annual_inc,
       {ENCODED_SQL}
FROM divided, stats""",
)
def prepared_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All preparation steps in one job."""
    frame = prepared(spark, sf_dir).frame
    return frame.withColumns({c: F.round(c, 6) for c in NUMERIC})


@query(
    "split_summary",
    f"""WITH {DIVIDED_SQL}, {STATS_SQL}, scaled AS (
  SELECT split, classification_target, (coalesce(loan_amnt, loan_median) - loan_mean) / loan_std AS loan_amnt,
         (coalesce(annual_inc, inc_median) - inc_mean) / inc_std AS annual_inc
  FROM divided, stats
), train AS (SELECT count(*) AS total FROM divided WHERE split = 'train')
SELECT split, count(*) AS rows, CAST(sum(classification_target) AS BIGINT) AS positives,
       round(avg(loan_amnt), 6) + 0.0 AS loan_mean, round(avg(annual_inc), 6) + 0.0 AS income_mean
FROM scaled GROUP BY split""",
)
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows are in which split, and the scaled means that follow."""
    return (
        prepared(spark, sf_dir)
        .frame.groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.col("classification_target").cast("bigint")).alias("positives"),
            (F.round(F.avg("loan_amnt"), 6) + 0.0).alias("loan_mean"),
            (F.round(F.avg("annual_inc"), 6) + 0.0).alias("income_mean"),
        )
    )
