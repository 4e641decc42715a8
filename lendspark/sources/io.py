"""Readers and writers.  Explicit schemas on read (no inference), columnar
Parquet as the default exchange format, nested columns preserved."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

CUSTOMERS_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()), T.StructField("city", T.StringType()),
    T.StructField("city_tier", T.StringType()), T.StructField("occupation", T.StringType()),
    T.StructField("true_monthly_income", T.DoubleType()), T.StructField("declared_monthly_income", T.DoubleType()),
    T.StructField("tenure_months", T.IntegerType()), T.StructField("existing_products", T.IntegerType()),
    T.StructField("digital_engagement_score", T.DoubleType()), T.StructField("loan_product_interest", T.StringType()),
])
TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()), T.StructField("txn_date", T.DateType()),
    T.StructField("txn_type", T.StringType()), T.StructField("amount", T.DoubleType()),
    T.StructField("category", T.StringType()), T.StructField("merchant", T.StringType()),
    T.StructField("channel", T.StringType()),
])
BEHAVIOR_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()), T.StructField("month", T.StringType()),
    T.StructField("app_logins", T.IntegerType()), T.StructField("emi_calculator_views", T.IntegerType()),
    T.StructField("loan_page_visits", T.IntegerType()), T.StructField("product_page_visits", T.IntegerType()),
    T.StructField("viewed_product", T.StringType()),
])
SCHEMAS = {"customers": CUSTOMERS_SCHEMA, "transactions": TRANSACTIONS_SCHEMA, "behavioral_signals": BEHAVIOR_SCHEMA}


def read_table(spark: SparkSession, path: str, kind: str | None = None, fmt: str = "parquet",
               **options) -> DataFrame:
    """Read one input table; CSV gets the library's fixed schema."""
    reader = spark.read.options(**options)
    if fmt == "csv":
        reader = reader.option("header", True)
        if kind:
            reader = reader.schema(SCHEMAS[kind])
        return reader.csv(path)
    return reader.format(fmt).load(path)


def read_jdbc(spark: SparkSession, url: str, table: str = "customers", properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """``SELECT * FROM table`` over JDBC, split into parallel range reads when
    a numeric partition column is given (one connection per partition)."""
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def write_table_overwrite(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalog table (``if_exists='replace'``)."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> str:
    """Write ``df`` as a new catalog table ``name_<unique>`` of ``buckets`` buckets
    by ``key``, sorted in each, and return its name.  Tables bucketed alike are
    joined on the key without an exchange.  Its files lie in the shared folder
    of ``spark.checkpoint.dir``; a row with a null key is kept."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", f"{ensure_checkpoint_dir(spark)}/{table}").saveAsTable(table))
    return table


def stored_sorted(df: DataFrame, key: str) -> DataFrame:
    """Write ``df`` as Parquet in key order into the shared folder of
    ``spark.checkpoint.dir`` and read it back.  Row groups then hold narrow key
    ranges and a bloom filter of the key, so a lookup reads few of them, and a
    query reads its own columns only.  Cuts the lineage like a checkpoint."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    (df.repartitionByRange(F.col(key)).sortWithinPartitions(key).write
     .option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path))
    return spark.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_nested(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Whole scored frame incl. ARRAY / MAP / STRUCT columns."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_nested(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_metrics(spark: SparkSession, metrics: dict, path: str) -> None:
    """A metrics document as one JSON record (nested dicts preserved)."""
    spark.createDataFrame([(json.dumps(metrics),)], "doc string").coalesce(1).write.mode("overwrite").text(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metric documents (one JSON object per line, or multi-line files)."""
    return spark.read.option("multiLine", True).json(path)


def write_metric_documents(docs: DataFrame, path: str) -> None:
    """One-row frames of metrics, nested or not, as JSON text: docs(document, doc STRING)."""
    docs.select("document", "doc").write.mode("overwrite").partitionBy("document").text(path)


def read_metric_documents(spark: SparkSession, path: str) -> DataFrame:
    """(document, doc VARIANT): documents of any shape as one table, without a
    schema of their fields.  A line that is not JSON fails the read."""
    lines = spark.read.schema("value string, document string").text(path)
    return lines.select("document", F.parse_json("value").alias("doc"))


def metric_fields(docs: DataFrame, depth: int = 3) -> DataFrame:
    """(document, field, value, text): one row for each leaf of docs(document, doc
    VARIANT); nested fields are named a.b.  value is the leaf as a number, NULL
    where it is none; text is the leaf as JSON.  Arrays, and objects below
    ``depth`` levels, stay one leaf."""
    rows, leaves = docs.select("document", F.lit("").alias("field"), F.col("doc").alias("node")), None
    for level in range(depth):
        inside = rows.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("node").outer()))
        rows = inside.select("document", F.concat_ws(".", F.nullif("field", F.lit("")), "key").alias("field"), F.col("value").alias("node"))
        nested = F.schema_of_variant("node").startswith("OBJECT") if level < depth - 1 else F.lit(False)
        here = rows.where(~nested)
        leaves = here if leaves is None else leaves.unionByName(here)
        rows = rows.where(nested)
    return leaves.select("document", "field", F.try_variant_get("node", "$", "double").alias("value"), F.to_json("node").alias("text"))


def metrics_row(df: DataFrame) -> dict:
    """A one-row metrics DataFrame as a plain dict (tiny by construction)."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("metrics frame must have exactly one row")
    return rows[0].asDict(recursive=True)
