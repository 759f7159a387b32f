"""Wide <-> long reshaping helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_values(df: DataFrame, ids: list[str], cols: list[str],
                   name: str = "feature", value: str = "value", dtype: str = "double") -> DataFrame:
    """One row per (id..., column) with the column's value cast to ``dtype``."""
    return df.select(*ids, F.inline(F.array(*[
        F.struct(F.lit(c).alias(name), F.col(c).cast(dtype).alias(value)) for c in cols])))
