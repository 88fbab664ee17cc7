"""Document fingerprints by MinHash, and near copies by banded signatures.

A document's shingles are its five-word shingles (lower-cased A-Z; a shorter
text is one shingle).  ``HASHES`` universal hash functions ``(a * h + b) >> 32``
permute them, and the smallest value of each, kept to 16 bits, is the
signature; all of it is numpy over blocks of texts.  The fingerprint is the
signature in hex, and the share of equal places of two fingerprints estimates
the Jaccard similarity of their shingle sets.

``near_copies`` cuts signatures into bands, joins documents on (band, value)
in Spark and verifies the Jaccard similarity of every candidate pair on the
whole shingle sets.

Results for odd input: null texts count as empty; all texts without a word
have one fingerprint (all bits set) and are near copies of nothing.  Rows are
ordered by doc_id (nulls first), rows of one doc_id by the key of their text.
A table of one row has that row as its own next.  An empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.llm import textblocks as tb
from barwise.llm.setjoin import checked_broadcast, keyed
from barwise.session import written

SHINGLE = 5
HASHES = 128
#: 32 bands of 4: near copies at 0.8 share a band with probability 1 - 5e-8.
BANDS = 32
_RND = np.random.default_rng(20_011)
A = _RND.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
B = _RND.integers(0, 1 << 63, HASHES, np.uint64)
BLOCK = 1 << 20


def signatures(texts: list[bytes], k: int = SHINGLE) -> np.ndarray:
    """(texts, HASHES) 16-bit signatures."""
    ends = np.cumsum([0, *map(len, texts)])
    unit, h = tb.shingles(*tb.words(np.frombuffer(b"".join(texts), np.uint8), ends[:-1]), len(texts), k)
    order = np.argsort(unit, kind="stable")
    unit, h = unit[order], h[order]
    out = np.full((len(texts), HASHES), 0xFFFF, np.uint16)
    if len(unit):
        at = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
        for p in range(HASHES):
            out[unit[at], p] = np.minimum.reduceat((h * A[p] + B[p]) >> np.uint64(32), at) & np.uint64(0xFFFF)
    return out


def _lows(ids: DataFrame) -> list[tuple]:
    """First (doc_id, text_key) of each of about as many ranges as there are shuffle partitions."""
    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sorted((tuple(r.low) for r in ids.repartitionByRange(n, "doc_id", "text_key").groupBy(F.spark_partition_id().alias("p"))
                   .agg(F.min(F.struct("doc_id", "text_key")).alias("low")).collect()), key=_order)


def _order(row: tuple) -> tuple:
    return (row[0] is not None, row[0] or 0, row[1])


def _ranges(lows: list[tuple]):
    """UDF: the range of a row; for a range's first row also the range before it."""
    nulls = sum(d is None for d, _ in lows)
    ids = np.array([d for d, _ in lows[nulls:]], np.int64)
    keys = [_order(x) for x in lows]
    firsts = {x: i for i, x in enumerate(lows)}

    @F.pandas_udf("array<int>")
    def of(doc_id: pd.Series, text_key: pd.Series) -> pd.Series:
        out = []
        for d, k in zip(doc_id.astype("Int64"), text_key):
            d = None if d is pd.NA else int(d)
            a = 0 if d is None else nulls + int(np.searchsorted(ids, d, "left"))
            while a < len(lows) and keys[a] <= _order((d, k)):
                a += 1
            here = max(0, a - 1)
            out.append([here, (here - 1) % len(lows)] if (d, k) in firsts else [here])
        return pd.Series(out)

    return of


ROW = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ranges in order; the last of each range is the next range's first."""
    held: list[tuple] = []  # (range, guard, doc_id, text)

    def done() -> pa.RecordBatch:
        pairs = [(x, y[3]) for x, y in zip(held, held[1:]) if x[0] == y[0] and not x[1]]
        own = [x[3].encode() for x, _ in pairs]
        edited = [(x[3][: len(x[3]) - len(x[3]) // 2] + after[: len(x[3]) // 2]).encode() for x, after in pairs]
        sig = signatures(own + edited + [after.encode() for _, after in pairs[-1:]])
        mine, changed = sig[: len(own)], sig[len(own): 2 * len(own)]
        where = {i: j for j, i in enumerate(i for i, (x, y) in enumerate(zip(held, held[1:])) if x[0] == y[0] and not x[1])}
        following = np.empty_like(mine)
        lone = []
        for i, j in where.items():
            if i + 1 in where:
                following[j] = mine[where[i + 1]]
            elif j + 1 == len(own):
                following[j] = sig[-1]
            else:
                lone.append((j, held[i + 1][3].encode()))
        if lone:
            following[[j for j, _ in lone]] = signatures([t for _, t in lone])
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        return pa.RecordBatch.from_arrays(
            [pa.array([x[2] for x, _ in pairs], pa.int64()), pa.array([len(x[3]) for x, _ in pairs], pa.int64()),
             pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()), pa.array([s.tobytes().hex() for s in mine], pa.string()),
             pa.array([s.tobytes().hex() for s in changed], pa.string()), pa.array((mine == changed).mean(axis=1)),
             pa.array((mine == following).mean(axis=1))], names)

    size = 0
    for batch in batches:
        for x in zip(*(batch.column(c).to_pylist() for c in ("range", "guard", "doc_id", "text"))):
            if held and held[-1][0] == x[0] and held[-1][1]:
                continue  # a further copy of the guard row
            held.append(x)
            size += len(x[3])
            if size >= BLOCK and len(held) > 1:
                yield done()
                held, size = held[-1:], 0
    if len(held) > 1:
        yield done()


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row's text and of its edited text.

    The edited text is the text whose last ``n_chars // 2`` code points give
    way to the first as many of the next row's.  ``near_edited`` and
    ``near_next`` are the likeness of the fingerprint to the edited text's and
    to the next row's.  Texts are shuffled once, into ranges of doc_id; the
    first row of each range also goes to the range before it.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    lows = _lows(rows.select("doc_id", "text_key"))
    if not lows:
        return docs.sparkSession.createDataFrame([], ROW)
    dealt = rows.select("doc_id", "text", "text_key", F.posexplode(_ranges(lows)("doc_id", "text_key")).alias("guard", "range"))
    return (dealt.repartition(len(lows), "range").sortWithinPartitions("range", "guard", "doc_id", "text_key")
            .select(F.col("range"), (F.col("guard") > 0).alias("guard"), "doc_id", "text").mapInArrow(_with_next, ROW))


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tb.utf8(batch.column("text"))
        for a, b in tb.blocks(offsets, BLOCK):
            texts = [data[offsets[i]: offsets[i + 1]].tobytes() for i in range(a, b)]
            sig = signatures(texts)
            some = np.flatnonzero([bool(t.split()) for t in texts])
            values = tb.mix(sig[some].reshape(len(some), BANDS, -1).copy().view(np.uint64)[..., 0] + np.arange(BANDS, dtype=np.uint64) * tb.STEP)
            at = pa.array(a + some)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("text_key").take(at),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * BANDS), pa.array(values.view(np.int64).ravel()))],
                ["doc_id", "text_key", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tb.utf8(batch.column("text"))
        for a, b in tb.blocks(offsets):
            begin = offsets[a:b] - offsets[a]
            unit, h = tb.distinct(*tb.shingles(*tb.words(data[offsets[a]: offsets[b]], begin), b - a, SHINGLE))
            ends = np.r_[0, np.cumsum(np.bincount(unit, minlength=b - a))].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends), pa.array(h.view(np.int64)))],
                                             ["node", "tokens"])


def exact_copies(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and representative of every row: the smallest doc_id of
    the rows of its text (null if all are null), under which ``near_copies`` has it."""
    texts = keyed(docs).select("doc_id", "text_key")
    first = texts.groupBy("text_key").agg(F.min("doc_id").alias("representative"))
    return texts.join(first, "text_key").select("doc_id", "text_key", "representative")


def near_copies(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, other_id, jaccard, text_key and other_key of all pairs of different texts that share a band and match.

    Equal texts stand as one, under their smallest doc_id; ``exact_copies`` has
    the representative of every row.  All pairs of a group are given, so they
    grow with the square of its different texts.
    """
    texts = keyed(docs)
    first = texts.groupBy("text_key").agg(F.min("doc_id").alias("first_id")).withColumnRenamed("text_key", "first_key")
    own = (F.col("text_key") == F.col("first_key")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    nodes = written(texts.join(first, own, "left_semi").dropDuplicates(["doc_id", "text_key"]).mapInArrow(
        _bands, "doc_id long, text_key long, bands array<long>").withColumn("node", F.monotonically_increasing_id()), "signatures")
    index = nodes.select("node", F.explode("bands").alias("band"))
    shared = index.groupBy("band").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last").select("band")
    live = written(index.join(shared, "band"), "bands")
    pairs = written(live.alias("r").join(live.alias("s"), "band").where("r.node < s.node")
                    .select(F.col("r.node").alias("a"), F.col("s.node").alias("b")).distinct(), "pairs")

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(nodes.select("node", "doc_id", "text_key"), "node")
    wanted = written(wanted.withColumnsRenamed({"doc_id": "of_id", "text_key": "of_key"}), "wanted")
    sets = texts.join(checked_broadcast(wanted, wanted.count()), F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key")))
    sets = written(sets.select("node", "text").dropDuplicates(["node"]).mapInArrow(_sets, "node long, tokens array<long>"), "whole")
    for x in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(x), F.col("tokens").alias("s" + x)), x)
    pairs = pairs.withColumn("both", F.size(F.array_intersect("sa", "sb"))).withColumn("all", F.size("sa") + F.size("sb") - F.col("both"))
    found = pairs.where(f"100L * both >= {percent}L * all").select("a", "b", F.expr("both / all").alias("jaccard"))
    for x, name, key in (("a", "doc_id", "text_key"), ("b", "other_id", "other_key")):
        found = found.join(nodes.select(F.col("node").alias(x), F.col("doc_id").alias(name), F.col("text_key").alias(key)), x)
    return found.select("doc_id", "other_id", "jaccard", "text_key", "other_key")
