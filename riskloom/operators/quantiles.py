"""Exact medians without holding a group in one buffer.

Spark's exact ``percentile``/``median`` keeps every distinct value of a
group in one aggregation buffer, which does not survive a hot group at
scale.  Here each round narrows, per (group, column), a value band that is
guaranteed to contain the two middle order statistics:

1. exact counts per key (one partial aggregate);
2. while a band holds more than ``band_limit`` values: a 1000-point
   ``percentile_approx`` sketch inside the band brackets the target ranks;
   exact counts on the bracket confirm it (else the old band is kept);
3. the confirmed band is ranked with a window partitioned by key — at most
   ``band_limit`` rows per key — and the middle values are read off.

Only per-key scalars (counts, band edges) reach the driver, of at most
``MAX_KEYS`` keys.  With more keys nothing is collected: values are counted,
dealt by sampled ranges of (key, value), and the middle ranks are picked by
running counts (``prefix``), which gives the same medians.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from riskloom.operators.prefix import running_sums
from riskloom.operators.reshape import unpivot_values

_GRID = [i / 1000 for i in range(1, 1000)]
MAX_KEYS = 100_000      # (group, column) pairs whose band edges the driver holds; more go by ranges


def _band_frame(spark: SparkSession, groups: list[str], gtypes, bands: dict) -> DataFrame:
    fields = [StructField(g, t) for g, t in zip(groups, gtypes)] + [
        StructField("feature", StringType()), StructField("__lo", DoubleType()),
        StructField("__hi", DoubleType()), StructField("__mid", DoubleType()),
        StructField("__below", LongType()), StructField("__n", LongType())]
    rows = [(*k, b["lo"], b["hi"], b.get("mid"), b["below"], b["n"]) for k, b in bands.items()]
    return spark.createDataFrame(rows, StructType(fields))


def _joined(long: DataFrame, bands: DataFrame, keys: list[str]) -> DataFrame:
    """Values with their key's band (at most MAX_KEYS rows); a missing group value is a key like any other."""
    named = bands.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                         *[c for c in bands.columns if c not in keys])
    same = [long[k].eqNullSafe(named[f"__k{i}"]) for i, k in enumerate(keys)]
    return long.join(F.broadcast(named), same).drop(*[f"__k{i}" for i in range(len(keys))])


def _in_band(v, lo, hi):
    return (lo.isNull() | (v > lo)) & (hi.isNull() | (v <= hi))


def _count_le(v, bound):
    return F.sum(F.when(bound.isNotNull() & (v <= bound), 1).otherwise(0))


def _ordered_medians(long: DataFrame, keys: list[str], schema: StructType) -> DataFrame:
    """Medians of any number of keys: the values whose running counts pass the middle ranks."""
    values = long.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c"))
    x = running_sums(values, keys, [F.asc("__v")], {"__upto": "__c"}, totals={"n": "__c"})

    def holds(rank):        # whether a value's copies fill the rank
        return (F.col("__upto") >= rank) & (F.col("__upto") - F.col("__c") < rank)

    low, high = F.floor((F.col("n") + 1) / 2), F.floor((F.col("n") + 2) / 2)
    x = x.where(holds(low) | holds(high)).groupBy(*keys).agg(
        (F.sum(F.when(holds(low), F.col("__v"))) / 2 + F.sum(F.when(holds(high), F.col("__v"))) / 2).alias("median"), F.max("n").alias("n"))
    return x.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def exact_medians(df: DataFrame, cols: list[str], groups: list[str] | tuple = (),
                  band_limit: int = 200_000, accuracy: int = 10_000,
                  max_rounds: int = 6) -> DataFrame:
    """Median (mean of the two middle values, as pandas/DuckDB) of each
    column per group, long form: ``(*groups, feature, median, n)``.
    Missing values are skipped; a column without values has no row."""
    groups = list(groups)
    spark = df.sparkSession
    long = unpivot_values(df, groups, cols, "feature", "__v").where(
        F.col("__v").isNotNull() & ~F.isnan("__v"))
    keys = groups + ["feature"]
    gtypes = [df.schema[g].dataType for g in groups]
    out_schema = StructType([StructField(g, t) for g, t in zip(groups, gtypes)]
                            + [StructField("feature", StringType()),
                               StructField("median", DoubleType()), StructField("n", LongType())])
    counts = long.groupBy(*keys).agg(F.count("__v").alias("n")).limit(MAX_KEYS + 1).collect()
    if len(counts) > MAX_KEYS:
        return _ordered_medians(long, keys, out_schema)
    bands = {tuple(r[k] for k in keys): {"n": r["n"], "lo": None, "hi": None, "below": 0,
                                         "size": r["n"]} for r in counts}
    done: dict = {}
    v = F.col("__v")
    for _ in range(max_rounds):
        wide = {k: b for k, b in bands.items() if k not in done and b["size"] > band_limit}
        if not wide:
            break
        inside = _joined(long, _band_frame(spark, groups, gtypes, wide), keys) \
                     .where(_in_band(v, F.col("__lo"), F.col("__hi")))
        sk = inside.groupBy(*keys).agg(F.percentile_approx("__v", _GRID, accuracy).alias("q")).collect()
        cand = {}
        for r in sk:
            k = tuple(r[x] for x in keys)
            b, q = bands[k], r["q"]
            k1, k2 = (b["n"] + 1) // 2, (b["n"] + 2) // 2
            f1, f2 = (k1 - b["below"]) / b["size"], (k2 - b["below"]) / b["size"]
            m_lo, m_hi = int(f1 * 1000) - 4, int(f2 * 1000) + 3
            mid = q[min(max(int(f1 * 1000) - 1, 0), len(q) - 1)]
            cand[k] = {"n": b["n"], "below": b["below"],
                       "lo": q[m_lo] if m_lo >= 0 else b["lo"],
                       "hi": q[m_hi] if m_hi < len(q) else b["hi"], "mid": mid}
        if not cand:
            break
        chk = _joined(long, _band_frame(spark, groups, gtypes, cand), keys).groupBy(*keys).agg(
            _count_le(v, F.col("__lo")).alias("c_lo"),
            F.sum(F.when(F.col("__hi").isNull() | (v <= F.col("__hi")), 1).otherwise(0)).alias("c_hi"),
            F.sum(F.when(v < F.col("__mid"), 1).otherwise(0)).alias("c_mid_lt"),
            _count_le(v, F.col("__mid")).alias("c_mid_le")).collect()
        for r in chk:
            k = tuple(r[x] for x in keys)
            b, c = bands[k], cand[k]
            k1, k2 = (b["n"] + 1) // 2, (b["n"] + 2) // 2
            if r["c_mid_lt"] < k1 and r["c_mid_le"] >= k2:
                done[k] = c["mid"]          # both middle values equal the candidate
                continue
            size = r["c_hi"] - r["c_lo"]
            if r["c_lo"] < k1 and r["c_hi"] >= k2 and size < b["size"]:
                bands[k] = {"n": b["n"], "lo": c["lo"], "hi": c["hi"], "below": r["c_lo"], "size": size}
            else:
                b["size"] = 0               # no progress: rank the band as it is
    result = None
    rest = {k: b for k, b in bands.items() if k not in done}
    if rest:
        inside = _joined(long, _band_frame(spark, groups, gtypes, rest), keys) \
                     .where(_in_band(v, F.col("__lo"), F.col("__hi")))
        w = Window.partitionBy(*keys).orderBy("__v")
        ranked = inside.withColumn("__r", F.row_number().over(w) + F.col("__below"))
        k1 = F.floor((F.col("__n") + 1) / 2)
        k2 = F.floor((F.col("__n") + 2) / 2)
        result = ranked.where((F.col("__r") == k1) | (F.col("__r") == k2)).groupBy(*keys).agg(
            (F.sum(F.when(F.col("__r") == k1, v)) / 2 + F.sum(F.when(F.col("__r") == k2, v)) / 2)
            .alias("median"), F.first("__n").alias("n"))
    if done:
        fixed = spark.createDataFrame([(*k, float(m), bands[k]["n"]) for k, m in done.items()], out_schema)
        result = fixed if result is None else result.unionByName(fixed)
    if result is None:
        result = spark.createDataFrame([], out_schema)
    return result
