"""Readers and writers at the edges of a run; any URI that Spark opens will do."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RECOMMENDATIONS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("customer_id", "recommended_product", "cluster_id", "segment", "l2_category", "l3_category", "trigger_product")]
    + [T.StructField(n, T.DoubleType()) for n in ("support", "confidence", "lift", "score")]
    + [T.StructField("recommended_qty", T.IntegerType()), T.StructField("reason", T.StringType()), T.StructField("rank", T.IntegerType())]
)
ASSOCIATIONS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("segment", "cluster_id", "product_a", "product_b")]
    + [T.StructField(n, T.LongType()) for n in ("pair_freq", "product_freq")]
    + [T.StructField(n, T.DoubleType()) for n in ("confidence", "support", "weighted_support", "lift")]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A CSV with a header; without a schema all columns are text, which the canonical forms parse."""
    return spark.read.csv(path, header=True, schema=schema)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path) if ".parquet" in path else read_csv(spark, path)


def find(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All files called `name` below root."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", name).csv(root, header=True)


def read_optional(spark: SparkSession, path: str | None) -> DataFrame | None:
    """None where there is no such table, or nothing in it."""
    if not path:
        return None
    try:
        df = read_any(spark, path)
    except AnalysisException:
        return None
    return None if not df.columns or df.isEmpty() else df


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """df, or an error where it has no rows."""
    if df.isEmpty():
        raise ValueError(what)
    return df


def publish(df: DataFrame, path: str, *order: str) -> int:
    """Write rows as CSV, sorted, and refuse an empty result; returns their number."""
    n = df.count()
    if not n:
        raise ValueError("nothing to publish")
    write_csv(df.orderBy(*order) if order else df, path)
    return n


def write_json(df: DataFrame, path: str) -> None:
    """A column of JSON documents, one a line; other tables as one JSON document a row."""
    if df.dtypes == [(df.columns[0], "string")]:
        df.write.mode("overwrite").text(path)
    else:
        df.write.mode("overwrite").json(path)


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a folder of our own where it is unset in local mode, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tallyloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tallyloom-stages/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: later steps start from it, whatever executors are lost."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
