"""Raw transaction and identity files: declared schema, rejected rows, contract figures.

One pass reads a file (CSV with a header, or Parquet), keeps what fits the
contract and what does not as two partitions of one table, and gathers the
contract's figures on the way (``Observation``).  Nothing is inferred: columns
that the jobs read by name have declared types, every other column is text,
since only its being missing counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from riskloom.functions.columns import without_nan
from riskloom.schemas import AMOUNT, CARD, ID, LABEL, TIME, TX_REQUIRED, require_columns
from riskloom.sources.io import path_exists

DECLARED = {ID: LongType(), LABEL: IntegerType(), TIME: LongType(), AMOUNT: DoubleType(), CARD: LongType()}
REQUIRED = {"transactions": list(TX_REQUIRED), "identity": [ID]}
RAW, REJECTED = "__raw", "rejected"
FIGURES = "table_name string, figure string, value double"


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV: a read of its first line alone."""
    return spark.read.option("header", True).option("enforceSchema", False).csv(path).columns


def _declared(names: list[str], types: dict) -> StructType:
    return StructType([StructField(n, types.get(n, StringType())) for n in names])


def _read(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, Column]:
    """The file's rows with ``RAW`` (the text of a row that does not parse), and whether a row fits the contract."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Missing required input: {path}")
    types = DECLARED if kind == "transactions" else {ID: DECLARED[ID]}
    if path.rstrip("/").endswith(".parquet"):
        table = spark.read.parquet(path)
        require_columns(table, REQUIRED[kind], kind)
        stored = [c for c in types if c in table.columns]
        cast = {c: F.col(c).try_cast(types[c]) for c in stored}
        lost = [cast[c].isNull() & F.col(c).isNotNull() for c in stored]
        bad = lost[0]
        for x in lost[1:]:
            bad = bad | x
        rows = table.withColumn(RAW, F.when(bad, F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in stored])))).withColumns(cast)
    else:
        names = _header(spark, path)
        schema = _declared(names, types)
        for c in REQUIRED[kind]:
            if c not in names:
                raise ValueError(f"{kind} must contain the column(s): {c}")
        rows = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW)
                .schema(schema.add(RAW, StringType())).csv(path))
    fits = F.col(RAW).isNull() & F.col(ID).isNotNull()
    if kind == "transactions":
        fits = fits & F.coalesce(F.col(LABEL).isin(0, 1), F.lit(False))
    return rows, fits


def take_in(spark: SparkSession, path: str, out: str, kind: str) -> DataFrame:
    """Writes the file's rows to ``out``, partitioned by whether they were rejected, and returns the figures.

    Rejected are lines that do not parse to the declared types or have another number of fields than the
    header, and rows without an id or (transactions) with a label other than 0 and 1."""
    rows, fits = _read(spark, path, kind)
    seen = Observation(f"intake-{kind}-{uuid.uuid4().hex}")
    one = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("double")
    figures = [F.count(F.lit(1)).cast("double").alias("rows"), one(~fits).alias("rejected"), one(F.col(RAW).isNotNull()).alias("unreadable"),
               one(F.col(RAW).isNull() & F.col(ID).isNull()).alias("without_id")]
    if kind == "transactions":
        figures += [one(fits & (F.col(LABEL) == 1)).alias("positives"), one(fits & F.col(TIME).isNull()).alias("without_time"),
                    F.min(F.when(fits, F.col(TIME))).cast("double").alias("first_time"), F.max(F.when(fits, F.col(TIME))).cast("double").alias("last_time")]
    rows.observe(seen, *figures).withColumn(REJECTED, (~fits).cast("int")).write.mode("overwrite").partitionBy(REJECTED).parquet(out)
    return spark.createDataFrame([(kind, k, v) for k, v in seen.get.items()], FIGURES)


def accepted(spark: SparkSession, out: str) -> DataFrame:
    """The rows that fit the contract."""
    return without_nan(spark.read.parquet(out).where(F.col(REJECTED) == 0).drop(RAW, REJECTED))


def rejected(spark: SparkSession, out: str) -> DataFrame:
    """The other rows, with the text of those that could not be read (``raw``)."""
    return spark.read.parquet(out).where(F.col(REJECTED) == 1).withColumnRenamed(RAW, "raw").drop(REJECTED)
