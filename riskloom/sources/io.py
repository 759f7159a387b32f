"""Readers, sinks, presence and contract checks, model persistence."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from riskloom.schemas import LABEL, require_columns


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence on any Hadoop file system (local, HDFS, object stores)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_csv_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """CSV with header; a missing file is an error (FileNotFoundError)."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Missing required input: {path}")
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Missing required input: {path}")
    if path.endswith(".csv"):
        return read_csv_table(spark, path, schema)
    return spark.read.parquet(path)


def load_features(spark: SparkSession, full_path: str, sample_path: str | None = None,
                  prefer_sample: bool = False) -> DataFrame:
    """The whole feature table, or the sample when that is asked for; one never stands in for the other."""
    p = sample_path if prefer_sample else full_path
    if p and path_exists(spark, p):
        df = read_table(spark, p)
        require_columns(df, [LABEL], "feature table")
        return df
    raise FileNotFoundError("Missing engineered features. Run the feature job first.")


def presence(spark: SparkSession, items: dict[str, str]) -> DataFrame:
    """(name, path, present) for required inputs/artifacts."""
    rows = [(n, p, bool(path_exists(spark, p))) for n, p in items.items()]
    return spark.createDataFrame(rows, StructType([StructField("name", StringType()),
                                                   StructField("path", StringType()),
                                                   StructField("present", BooleanType())]))


def contract_report(tables: dict[str, DataFrame], required: dict[str, list[str]], strict: bool = True) -> DataFrame:
    """(table_name, column_name, data_type, present) of every required column;
    ``strict``: raise ValueError when one is missing."""
    if not tables:
        raise ValueError("no table to check")
    if strict:
        for name, cols in required.items():
            require_columns(tables[name], cols, name)
    rows = [(name, c, dict(tables[name].dtypes).get(c), c in tables[name].columns) for name, cols in required.items() for c in cols]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, present boolean")


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_keyed(df: DataFrame, path: str, key: str, group_rows: int = 100_000) -> None:
    """A table for point lookups: rows in the order of ``key``, files and row groups of disjoint ranges of it with
    its least and greatest value and a Bloom filter, so a lookup of one key opens one row group at most."""
    sorted_rows = df.repartitionByRange(F.col(key)).sortWithinPartitions(key)
    sorted_rows.write.mode("overwrite").option("parquet.block.row.count.limit", group_rows) \
               .option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.enable.dictionary#{key}", "false").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Small report: one CSV file with a header (coalesce(1) on a bounded table)."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_text(lines: DataFrame, path: str, col: str = "text", order=None) -> None:
    """Text blocks separated by a blank line, in the given order.  The sort
    range-partitions the rows, so the part files are in order and no single
    task writes every block."""
    x = lines.orderBy(*(order or [col])).select(F.concat(F.col(col), F.lit("\n")).alias("value"))
    x.write.mode("overwrite").text(path)


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """Absent report -> None (not an error)."""
    if not path_exists(spark, path):
        return None
    try:
        if fmt == "csv":
            return spark.read.option("header", True).option("inferSchema", True).csv(path)
        if fmt == "text":
            return spark.read.text(path)
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def save_model(model, metadata: DataFrame, model_path: str, metadata_path: str) -> None:
    model.write().overwrite().save(model_path)
    metadata.coalesce(1).write.mode("overwrite").parquet(metadata_path)


def load_or_train(spark: SparkSession, model_path: str, loader, train_fn):
    """(model, source): the saved model when present, else a fresh fit."""
    if path_exists(spark, model_path):
        return loader.load(model_path), "loaded"
    return train_fn(), "retrained"


def load_threshold(spark: SparkSession, metadata_path: str, default: float = 0.5) -> float:
    meta = read_optional(spark, metadata_path)
    if meta is None or "optimized_threshold" not in meta.columns:
        return default
    r = meta.select(F.first("optimized_threshold", ignorenulls=True)).first()
    return float(r[0]) if r and r[0] is not None else default


def join_path(base: str, *parts: str) -> str:
    return os.path.join(base, *parts)
