"""what the feature build costs a row — Window nodes, method sizes and rounding."""

import re

from pyspark.sql import functions as F

from barwise.functions import round_double
from barwise.plans.features import build_features, round_features


def _bars(spark):
    k = F.col("id")
    close = 100 + k % 37 + (k % 11) / 100
    return spark.range(400).select(
        F.concat(F.lit("S"), (k % 2).cast("string")).alias("symbol"), F.date_add(F.lit("2020-01-01").cast("date"), k.cast("int")).alias("date"),
        (close - 1).alias("open"), (close + 2).alias("high"), (close - 2).alias("low"), close.alias("close"), (k % 5 + 1).cast("bigint").alias("volume"))


def test_feature_plan_fits_the_compiler(spark):
    """The JVM compiles no method above 8,000 bytes; before, one had 16,112, and rows passed 11 Window nodes."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = round_features(build_features(_bars(spark)))
        code = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) <= 8000
    assert len(re.findall(r"\bWindow \[", plan)) <= 8


def test_round_double_is_round(spark):
    halves = [n / 2 / 10 ** d + e for n in (1, 3, 5, 2469135, 1999999) for d in (4, 6, 8) for e in (0.0, 1e-15, -1e-15, 1e-9)]
    special = [None, 0.0, -0.0, 1e-7, 4.9e-324, 1e13, 9007199254740993.0, 1.7e308, float("nan"), float("inf"), 1.005, 2.675, 0.1 + 0.2]
    values = [(x,) for x in halves + special] + [(-x,) for x in halves + special if x is not None]
    grid = spark.range(20000).select((F.rand(7) * F.pow(F.lit(10.0), F.col("id") % 17) * F.when(F.col("id") % 2 == 0, 1).otherwise(-1)).alias("x"))
    df = spark.createDataFrame(values, "x double").union(grid)
    for d in (4, 6, 8):
        # as text, so that 0.0 and -0.0 differ
        bad = df.select("x", F.round("x", d).alias("a"), round_double("x", d).alias("b")).where("NOT cast(a AS string) <=> cast(b AS string)")
        assert bad.collect() == []
