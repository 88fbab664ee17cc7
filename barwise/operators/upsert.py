"""Keyed upsert (``INSERT ... ON CONFLICT (keys) DO UPDATE SET cols``) and
snapshot writes.

``upsert`` is one full-outer join on the keys: both sides are exchanged by
the key hash once, no row pairs beyond the key match are formed (keys are
unique on both sides, so no key is hot).  Unmatched batch rows
are inserted, matched rows take ONLY ``update_cols`` from the batch (NULL
included), every other column keeps the stored value.  Duplicate keys inside
one batch are collapsed first, the row with the largest ``order_col`` wins;
without one, or in a tie, the row with the largest values in column order, so
the result does not depend on the partitioning.

``write_snapshot`` writes a new immutable directory and never overwrites the
folder being read; stored tables are merged by :mod:`barwise.operators.snapshots`,
which rewrites only the files that a batch touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_T, _S = "__in_target", "__in_source"


def dedupe_batch(source: DataFrame, keys: list[str], order_col: str | None = None) -> DataFrame:
    """One row per key: the largest by ``order_col``, then by the other
    columns in their order (NULL is smallest).

    The maximum of a struct: partial aggregation runs map-side, so a key
    repeated in a third of the batch is collapsed before the shuffle."""
    others = [c for c in source.columns if c not in keys]
    if not others:
        return source.distinct()
    first = [F.col(order_col).alias("__order")] if order_col else []
    best = source.groupBy(*keys).agg(F.max(F.struct(*first, *others)).alias("__row"))
    return best.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in others])


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str],
           touch: dict[str, Column] | None = None, order_col: str | None = None,
           insert_defaults: dict[str, Column] | None = None) -> DataFrame:
    """Merged table with the target's columns (plus source-only columns)."""
    touch = touch or {}
    insert_defaults = insert_defaults or {}
    src = dedupe_batch(source, keys, order_col)
    t = target.select(*keys, *[F.col(c).alias(f"t__{c}") for c in target.columns if c not in keys],
                      F.lit(True).alias(_T))
    s = src.select(*keys, *[F.col(c).alias(f"s__{c}") for c in src.columns if c not in keys],
                   F.lit(True).alias(_S))
    j = t.join(s, keys, "full_outer")
    in_s = F.coalesce(F.col(_S), F.lit(False))
    in_t = F.coalesce(F.col(_T), F.lit(False))
    cols = list(target.columns) + [c for c in src.columns if c not in target.columns]
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
            continue
        tv = F.col(f"t__{c}") if c in target.columns else F.lit(None)
        sv = F.col(f"s__{c}") if c in src.columns else insert_defaults.get(c, F.lit(None))
        if c in touch:
            v = F.when(in_s, touch[c]).otherwise(tv)
        elif c in update_cols:
            v = F.when(in_s, sv).otherwise(tv)
        else:
            v = F.when(in_t, tv).otherwise(sv)
        dt = (target.schema[c] if c in target.columns else src.schema[c]).dataType
        out.append(v.cast(dt).alias(c))
    return j.select(*out)


def upsert_stats(target: DataFrame, source: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """U10 counts of a document upsert: inserted (key absent), modified (key
    present and any field differs, NULL-safe), total (batch rows)."""
    t = target.select(*keys, *[F.col(c).alias(f"t__{c}") for c in fields], F.lit(True).alias(_T))
    s = source.select(*keys, *[F.col(c).alias(f"s__{c}") for c in fields])
    j = s.join(t, keys, "left")
    differs = F.lit(False)
    for c in fields:
        differs = differs | ~F.col(f"s__{c}").eqNullSafe(F.col(f"t__{c}"))
    return j.agg(
        F.count(F.when(F.col(_T).isNull(), 1)).cast("bigint").alias("inserted"),
        F.count(F.when(F.col(_T).isNotNull() & differs, 1)).cast("bigint").alias("modified"),
        F.count(F.lit(1)).cast("bigint").alias("total"),
    )


def align_to_schema(df: DataFrame, schema) -> DataFrame:
    """Project onto a fixed schema; missing columns become typed NULLs
    (the additive-migration rule), extra columns are dropped."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def write_snapshot(df: DataFrame, path: str, partition_by: list[str] | None = None,
                   sort_within: list[str] | None = None, mode: str = "errorifexists") -> str:
    """Write a new immutable snapshot folder.  ``sort_within`` lays rows out
    (e.g. by symbol, date) so Parquet row-group min/max statistics skip
    unrelated symbols on read — the file-layout stand-in for an index."""
    w = df
    if sort_within:
        w = w.sortWithinPartitions(*sort_within)
    writer = w.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path
