"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.session import scratch_path

SPACES = " \t\n\x0b\x0c\r"          # the separators of the contract, \x20 and \x09-\x0D


BATCH_ROWS = 2_000          # texts in one Arrow batch, about 7 MB of usual documents


def small_batches(spark: SparkSession) -> None:
    """Bounds the texts that the JVM and a Python worker hold at once (Spark's default is 10,000)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table, by Spark's reader only (any file system)."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs only the re-reading of files that
    every executor sees.  Folder names are unique, so drivers never collide.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = scratch_path(spark, f"riskloom-{name}-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``stored`` that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


BROADCAST_ROWS = 4_000_000


def few(df: DataFrame) -> DataFrame:
    """A stored table of a few numbers a row, marked to be sent to every task if
    it has at most ``BROADCAST_ROWS`` rows (about 100 MB); else it is joined as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def id_fold(col: Column | str, m: int) -> Column:
    """crc32 of the id written as text, modulo ``m`` (null for a null id)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(m))


def temp_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet (compared without case)."""
    have, name = {c.lower() for c in df.columns}, f"__{stem}"
    while name.lower() in have:
        name += "_"
    return name


def text_udf(setup: Callable[[], Callable[[list], pa.Array]], kind: str):
    """An Arrow UDF over one text column.  ``setup`` runs once a task and
    returns the function that maps a list of texts (or None) to an Arrow array."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn = setup()
        for batch in batches:
            yield fn(batch.to_pylist())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind)


def _worker() -> dict:
    return sys.modules.setdefault("_riskloom_worker", types.ModuleType("_riskloom_worker")).__dict__


def per_worker(name: str, make: Callable[[], object], place: str | None = None):
    """An object that a Python worker keeps from task to task (a memory of results, never state that they depend on).
    Of the objects with one ``place`` it keeps the last."""
    held, key = _worker(), f"riskloom {place or name}"
    if key not in held or held[key][0] != name:
        held.pop(key, None)
        held[key] = name, make()
    return held[key][1]


def free_worker() -> None:
    """Drops what this Python worker keeps from other steps, for a step that needs the memory itself."""
    held = _worker()
    for key in [k for k in held if k.startswith("riskloom ")]:
        del held[key]


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of 64-bit values (in wrap-around arithmetic)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def sampled_ids(df: DataFrame, id_col: str, by: str, per_class: int) -> DataFrame:
    """(id, class): the ``per_class`` ids of each class with the smallest hash.

    Only ids travel; the window's row limit is applied before its shuffle, so
    a class with a third of all rows sends at most ``per_class`` rows a task.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(by).orderBy(F.xxhash64(id_col), id_col)
    n = temp_name(df, "rank")
    return (df.select(id_col, by).where(F.col(id_col).isNotNull() & F.col(by).isNotNull())
            .withColumn(n, F.row_number().over(w)).where(F.col(n) <= per_class).drop(n))
