"""C3 for a day: only the rows that new, late or corrected inputs can change.

A symbol's features change from its first changed date on, and five bars before it
(labels look that far ahead).  To compute them the newest ``HALO`` bars before
that are enough: the longest window has 252 rows, and an EWM forgets what lies
further back (a weight under 1e-20 after 600 observations, below what a double
can hold).  The rows go through the same plan as the full build and are merged
by key, so a day rewrites the files of its own months, not the history.

Three kinds of symbols are built in full: those the table does not have
(new, or quarantined so far), those whose halo holds too few bars with high and low
for the average true range to have forgotten, and those where a fact about
the whole symbol changed (sector, industry, its first dividend).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwise.operators import snapshots
from barwise.operators.summaries import latest_per_symbol, status_summary
from barwise.plans.features import FEATURE_COLS, build_features, to_feature_schema
from barwise.plans.jobs import feature_log
from barwise.session import scratch, written

#: Bars before the first changed one that are read, and bars before it that its changes reach.
HALO, AHEAD = 640, 5
#: Observations after which an EWM has forgotten its start (the slowest keeps 13/14 a bar).
FORGOTTEN = 500


def changed_from(*batches: tuple[DataFrame, str]) -> DataFrame:
    """symbol and the first date that the batches (rows, date column) change."""
    rows = [b.select("symbol", F.col(c).alias("since")) for b, c in batches]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out.groupBy("symbol").agg(F.min("since").alias("since"))


def affected(bars: DataFrame, dividends: DataFrame, universe: DataFrame, table: DataFrame, changed: DataFrame) -> DataFrame:
    """symbol and since of every symbol to be built; since is NULL where all its rows are."""
    u = universe.select(F.col("yf_symbol").alias("symbol"), "sector", "industry").distinct()
    last = latest_per_symbol(table.select("symbol", "date", "sector", "industry")).select(
        "symbol", F.col("sector").alias("t_sector"), F.col("industry").alias("t_industry"), F.lit(True).alias("stored"))
    first_dividend = dividends.groupBy("symbol").agg(F.min("ex_date").alias("first_dividend"))
    rows = u.join(last, "symbol", "left").join(changed, "symbol", "left").join(first_dividend, "symbol", "left")
    moved = ~F.col("sector").eqNullSafe(F.col("t_sector")) | ~F.col("industry").eqNullSafe(F.col("t_industry"))
    whole = F.col("stored").isNull() | moved | F.coalesce(F.col("since") <= F.col("first_dividend"), F.lit(False))
    rows = rows.where(whole | F.col("since").isNotNull())
    return (rows.join(bars.select("symbol").distinct(), "symbol", "left_semi")
            .select("symbol", F.when(~whole, F.col("since")).alias("since")))


def halo(bars: DataFrame, todo: DataFrame) -> DataFrame:
    """The bars that the affected rows need, with ``fresh``: whether a bar's features can have changed."""
    by_date = Window.partitionBy("symbol").orderBy("date")
    whole = Window.partitionBy("symbol")
    usable = bars.where(F.col("open").isNotNull() & F.col("close").isNotNull())
    rows = (usable.join(todo, "symbol").withColumn("k", F.row_number().over(by_date))
            .withColumn("first", F.coalesce(F.min(F.when(F.col("since").isNull() | (F.col("date") >= F.col("since")), F.col("k"))).over(whole),
                                            F.count("*").over(whole) + 1)))
    low = F.col("first") - AHEAD
    ranged = F.col("high").isNotNull() & F.col("low").isNotNull()
    held = F.count(F.when(ranged & (F.col("k") < low) & (F.col("k") >= low - HALO), 1)).over(whole)
    rows = rows.withColumn("start", F.when((low - HALO <= 1) | (held < FORGOTTEN), F.lit(1)).otherwise(low - HALO))
    return rows.where(F.col("k") >= F.col("start")).withColumn("fresh", F.col("k") >= low).drop("since", "k", "first", "start")


def update_features(spark: SparkSession, bars: DataFrame, fundamentals: DataFrame, dividends: DataFrame, splits: DataFrame,
                    universe: DataFrame, changed: DataFrame, table: str, log_table: str, run_id: str, computed_at) -> dict[str, DataFrame]:
    """Bring the stored feature table up to date after ``changed`` (symbol, since); untouched rows keep their
    computed_at.  ``bars`` and the event tables are the whole stored ones."""
    with scratch(spark):
        todo = written(affected(bars, dividends, universe, snapshots.read(spark, table), changed), "todo")
        window = written(halo(bars, todo), "halo")
        wanted = universe.join(todo.select(F.col("symbol").alias("yf_symbol")), "yf_symbol", "left_semi")
        built = build_features(window.drop("fresh"), fundamentals, dividends, splits, wanted)
        fresh = built.join(window.where("fresh").select("symbol", "date"), ["symbol", "date"], "left_semi")
        staged = written(to_feature_schema(fresh, computed_at), "features-staged")
        ok = staged.where(F.col("_status") == "success").drop("_status")
        version = snapshots.merge(spark, table, ok, ["symbol", "date"], [c for c in FEATURE_COLS if c not in ("symbol", "date")], "date",
                                  touch={"computed_at": F.lit(computed_at).cast("timestamp_ntz")})
        snapshots.append(spark, log_table, feature_log(staged, run_id, computed_at))
        counts = staged.groupBy("symbol").count()
        rows = spark.createDataFrame(counts.collect(), counts.schema)              # one row per symbol
    return {"features": snapshots.read(spark, table), "version": version, "rows": rows,
            "summary": status_summary(snapshots.read(spark, log_table), run_id, "features", by=("status",))}
