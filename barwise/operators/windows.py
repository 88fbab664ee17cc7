"""Ordered-window building blocks for per-symbol daily series.

All feature windows share ONE ordering — ``PARTITION BY symbol ORDER BY blk, rn``
— where ``rn`` is the 1-based bar index inside the symbol and ``blk`` the
EWM block of ``rn`` (see :mod:`barwise.operators.ewm`).  Ordering by
``(blk, rn)`` is the same order as ``date``, and it is also the ordering
required by the block windows ``partitionBy(key, blk).orderBy(rn)``, so a
single exchange + a single sort feed every Window node of the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EWM_BLOCK = 256


def add_bar_index(df, key: str = "symbol", order: str = "date",
                  rn: str = "rn", blk: str = "blk", block: int = EWM_BLOCK):
    """1-based bar index per key and its EWM block."""
    w = Window.partitionBy(key).orderBy(order)
    return (df.withColumn(rn, F.row_number().over(w))
              .withColumn(blk, ((F.col(rn) - 1) / block).cast("int")))


# ---- window columns as SQL text ------------------------------------------------------------
# Feature columns are written as SQL expressions: one JVM parse per column
# instead of dozens of py4j calls per Column tree.  Every expression of a
# SqlWindow uses the same PARTITION BY / ORDER BY, so Catalyst puts them in
# the same Window nodes and one sort serves all of them.

SYMBOL_SERIES = "PARTITION BY symbol ORDER BY blk, rn"
BLOCK = 14
_INF = "CAST('Infinity' AS DOUBLE)"


class SqlWindow:
    """SQL snippets over one window specification."""

    def __init__(self, spec: str):
        self.spec = spec
        self.whole = f"OVER ({spec} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
        self.run = f"OVER ({spec} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        self.before = f"OVER ({spec} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

    def frame(self, n: int) -> str:
        return f"OVER ({self.spec} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"

    def full(self, agg: str, x: str, n: int, running_count: str | None = None) -> str:
        """Rolling ``agg`` over the last ``n`` rows, NULL unless all ``n``
        are present and non-null (pandas ``rolling(n)`` default).  The rows are
        counted in the frame, or from ``running_count`` of ``x`` where there is one."""
        seen = self.delta(running_count, n) if running_count else f"count({x}) {self.frame(n)}"
        return f"CASE WHEN {seen} = {n} THEN {agg}({x}) {self.frame(n)} END"

    def lag(self, x: str, n: int, fn: str = "lag") -> str:
        return f"{fn}({x}, {n}) OVER ({self.spec})"

    # O(1)-per-row rolling aggregates.  Spark re-aggregates a sliding ROWS
    # frame for every row (n updates per row); these need two Window levels
    # of the same ordering and cost O(1) (sums, counts, means) or
    # O(n / 14 + 14) (min / max) per row.
    def running(self, x: str, name: str) -> dict[str, str]:
        """Level-1 columns: running sum and running non-null count."""
        return {f"__rs_{name}": f"sum({x}) {self.run}", f"__rc_{name}": f"count({x}) {self.run}"}

    def delta(self, col: str, n: int) -> str:
        """Last-``n``-rows total from a running column."""
        return f"({col} - coalesce({self.lag(col, n)}, 0))"

    def fast_mean(self, name: str, n: int) -> str:
        """Full-window mean from running sums, to be rounded to 8 decimals.
        Exact after that where the true mean has few decimals (e.g. cents /
        n); the difference of running sums carries ~1e-10 absolute error,
        which the eighth decimal rounds away, so a later rounding does not
        depend on where the series began."""
        return (f"CASE WHEN {self.delta(f'__rc_{name}', n)} = {n} "
                f"THEN {self.delta(f'__rs_{name}', n)} / {n} END")

    def extreme_parts(self, x: str, name: str, n: int, fn: str) -> dict[str, str]:
        """Level-1 columns: ``fn`` over 14-row and (n mod 14)-row frames."""
        out = {f"__xb_{name}": f"{fn}({x}) {self.frame(BLOCK)}"}
        if n % BLOCK:
            out[f"__xr_{name}"] = f"{fn}({x}) {self.frame(n % BLOCK)}"
        return out

    def fast_extreme(self, name: str, n: int, comb: str) -> str:
        """Full-window min / max from lagged 14-row block extremes (needs
        ``running`` of the same input for the count guard)."""
        k, r = divmod(n, BLOCK)
        parts = [f"__xb_{name}"] + [self.lag(f"__xb_{name}", j * BLOCK) for j in range(1, k)]
        if r:
            parts.append(self.lag(f"__xr_{name}", k * BLOCK))
        return f"CASE WHEN {self.delta(f'__rc_{name}', n)} = {n} THEN {comb}({', '.join(parts)}) END"


def sql_div(a: str, b: str) -> str:
    """F8/F9 in SQL: zero denominator or a non-finite result gives NULL."""
    q = f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0D))"
    return f"CASE WHEN abs({q}) < {_INF} THEN {q} END"


def with_sql(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Append SQL-expression columns in one projection."""
    return df.select("*", *[F.expr(e).alias(k) for k, e in cols.items()])
