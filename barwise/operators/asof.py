"""Backward as-of joins and event recency as union + window plans.

Instead of a join that compares every left row with every right row of the
key, both sides are tagged and unioned, shuffled once by the key and sorted
by (time, tag) with right rows ordered first on equal times (ties are
included, like ``merge_asof(direction="backward")``).  A running
``last(struct, ignorenulls=True)`` then carries the latest right row — the
whole row, so a NULL field is not back-filled from an older snapshot.

Cost is one exchange of (left + right) rows and one sort; nothing is
broadcast and no pair of rows is ever materialised.  Per key the window
holds the key's rows only; for daily bars that is bounded by the number of
trading days (the key (symbol, date) is unique).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_TAG = "__asof_tag"
_VAL = "__asof_val"


def asof_join(left: DataFrame, right: DataFrame, key: str, left_on: str, right_on: str,
              cols: list[str], struct_name: str | None = None) -> DataFrame:
    """Attach to every ``left`` row the ``cols`` of the newest ``right``
    row with ``right_on <= left_on`` for the same ``key``."""
    r = right.select(F.col(key), F.col(right_on).alias(left_on), F.lit(0).alias(_TAG),
                     F.struct(*cols).alias(_VAL))
    lcols = left.columns
    l = left.select("*", F.lit(1).alias(_TAG), F.lit(None).cast(r.schema[_VAL].dataType).alias(_VAL))
    u = l.unionByName(r, allowMissingColumns=True)
    w = (Window.partitionBy(key).orderBy(left_on, _TAG)
         .rowsBetween(Window.unboundedPreceding, 0))
    u = u.withColumn(_VAL, F.last(_VAL, ignorenulls=True).over(w)).where(F.col(_TAG) == 1)
    if struct_name:
        return u.select(*lcols, F.col(_VAL).alias(struct_name))
    return u.select(*lcols, *[F.col(f"{_VAL}.{c}").alias(c) for c in cols])


def days_since(left: DataFrame, events: DataFrame, key: str, left_on: str, event_on: str,
               out: str) -> DataFrame:
    """Calendar days from the newest event at or before each left
    date (NULL before the first event or for keys without events)."""
    r = events.select(F.col(key), F.col(event_on).alias(left_on), F.lit(0).alias(_TAG),
                      F.col(event_on).alias(_VAL))
    lcols = left.columns
    l = left.select("*", F.lit(1).alias(_TAG), F.lit(None).cast("date").alias(_VAL))
    u = l.unionByName(r, allowMissingColumns=True)
    w = (Window.partitionBy(key).orderBy(left_on, _TAG)
         .rowsBetween(Window.unboundedPreceding, 0))
    u = u.withColumn(_VAL, F.max(_VAL).over(w)).where(F.col(_TAG) == 1)
    return u.select(*lcols, F.datediff(F.col(left_on), F.col(_VAL)).alias(out))
