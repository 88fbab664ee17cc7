"""Exact set-similarity join of word-shingle sets by rare-first prefixes.

A *unit* is a document or a line; its set is its distinct k-word shingles.
Two sets a, b match when ``100 * |a & b| >= percent * |a | b|``.

1. Units with equal sets form a class; everything after handles classes.
2. Order of the tokens, one for all sets.  For whole texts a share of all shingles,
   chosen by hash and somewhat larger than a prefix's share of a set, comes first, ordered
   by the exact number of classes that have them (lines are short: of the few shingles
   of a line by far most are outside such a share).  The others follow by rarity class (from
   ``2**SKETCH_BITS`` counters over all shingles) and hash.
3. Two matching sets share a token among the first ``n - ceil(t * n) + 1`` of
   each.  The chosen shingles' counts come out of the one shuffle of the index; a
   set whose prefix is full of shingles that no other class has can match nothing
   and leaves, so what goes on grows with the near copies, not with the chance
   meetings of shingles.  Tokens that the counters show as very frequent skip that
   shuffle and come last.
4. Candidates come from joining index rows on the token under the length and
   the positional bound; of a class's earlier tokens only those count that some
   other class has.  In each token's group all rows first meet one pivot
   (the class with the fewest rarer tokens); rows that a pivot settles need
   not meet each other, so a large group of near copies costs pairs in
   proportion to its size.  The rest meets everything: no link is lost.
   The join also applies the suffix bound: bitmaps of the two whole sets show
   tokens that one of them lacks.
5. Distinct candidate pairs are verified once on the whole sets, which are made
   anew from the texts of those candidates only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwise.llm import textblocks as tb
from barwise.llm.counts import summed
from barwise.session import forget, written

SKETCH_BITS = 18
#: Rows of one token beyond which it is not sent through the grouping shuffle.
HOT_ROWS = 200_000
#: Rows of a lookup table up to which it is broadcast (about 30 MB).
BROADCAST_ROWS = 300_000
LOW56 = np.uint64((1 << 56) - 1)
#: Chosen shingles, as a multiple of a prefix's share of a set.
CHOSEN = 1.6
RECORD = "doc_id long, text_key long, unit int, n int, fp binary, chosen array<long>, others array<long>, bits array<long>"


@dataclass(frozen=True)
class Sets:
    """How texts become sets: k words a shingle, similarity in percent, lines
    or whole texts as units; units without a word have no set.
    ``bits`` is the length of a set's bitmap, a multiple of 64; ``exact`` lets a
    share of the shingles be ordered by their exact counts."""

    k: int
    percent: int
    lines: bool = False
    bits: int = 512
    exact: bool = True

    def is_chosen(self, token: np.ndarray) -> np.ndarray:
        """Whether a token's exact count orders it; a share of all shingles, by hash."""
        if not self.exact:
            return np.zeros(len(token), bool)
        return (token & np.uint64(0xFFFF)) < np.uint64(min(1 << 16, int(CHOSEN * (100 - self.percent) / 100 * (1 << 16))))

    def units(self, data: np.ndarray, starts: np.ndarray):
        """(number of units, row and number of each, shingles' units and hashes)."""
        if self.lines:
            begin, row, number = tb.split_lines(data, starts)
        else:
            begin, row, number = starts, np.arange(len(starts)), np.zeros(len(starts), np.int64)
        unit, word = tb.words(data, begin)
        return len(begin), row, number, *tb.shingles(unit, word, len(begin), self.k)


def rarity(docs: DataFrame, sets: Sets) -> tuple[np.ndarray, int]:
    """Rarity class of every counter, and the lowest class of very frequent ones."""
    def count(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        parts: list[np.ndarray] = []

        def add() -> None:
            if parts:
                np.add(total, np.bincount(np.concatenate(parts), minlength=1 << SKETCH_BITS), out=total)
                parts.clear()

        for batch in batches:
            data, offsets = tb.utf8(batch.column(0))
            for a, b in tb.blocks(offsets):
                h = sets.units(data[offsets[a]: offsets[b]], offsets[a:b] - offsets[a])[-1]
                parts.append((h >> np.uint64(64 - SKETCH_BITS)).astype(np.int32))
                if sum(map(len, parts)) > 1 << SKETCH_BITS:
                    add()
        add()
        return {"": total}

    counts = summed(docs.select("text"), count).get("", np.zeros(1 << SKETCH_BITS, np.int64)).astype(float)
    mean = counts.mean()
    scale = lambda x: np.clip(np.rint(16 * np.arcsinh(x / np.sqrt(mean + 1))) + 64, 0, 255)
    return scale(counts - mean).astype(np.uint8), int(scale(HOT_ROWS))


def _tokens(sets: Sets, classes: np.ndarray, data: np.ndarray, starts: np.ndarray):
    """Units with their distinct, rare-first tokens and the sets' fingerprints."""
    units, row, number, unit, h = sets.units(data, starts)
    token = (classes[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (h & LOW56)
    unit, token = tb.distinct(unit, token)
    n = np.bincount(unit, minlength=units)
    first = np.cumsum(n) - n
    full = np.flatnonzero(n)
    fp = np.zeros((units, 2), np.uint64)
    fp[full, 0] = tb.segment_sums(tb.mix(token ^ np.uint64(0x5851F42D4C957F2D)), first[full])
    fp[full, 1] = tb.segment_sums(tb.mix(token * np.uint64(0xDA942042E4DD58B5) + np.uint64(1)), first[full])
    return row, number, n, first, unit, token, fp


def records(docs: DataFrame, sets: Sets, classes: np.ndarray) -> DataFrame:
    """One row per unit: its set's size, fingerprint, chosen tokens, as many others as its prefix lacks, and bitmap.

    Units without a set are left out for lines, and have n = 0 and no
    fingerprint for whole texts.  A task gives tokens and bitmap of equal sets
    once (again after it has seen many), the others have null there.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            data, offsets = tb.utf8(batch.column("text"))
            ids, keys = batch.column("doc_id"), batch.column("text_key")
            for a, b in tb.blocks(offsets):
                row, number, n, first, unit, token, fp = _tokens(sets, classes, data[offsets[a]: offsets[b]], offsets[a:b] - offsets[a])
                keep = np.flatnonzero(n) if sets.lines else np.arange(len(n))
                both = fp[keep].tobytes()
                names = [both[16 * i: 16 * i + 16] if size else None for i, size in enumerate(n[keep].tolist())]
                new = np.zeros(len(n), bool)
                for i, x in zip(keep.tolist(), names):
                    if x is not None and x not in seen:
                        seen.add(x)
                        new[i] = True
                if len(seen) > 200_000:
                    seen.clear()
                mine = sets.is_chosen(token) & new[unit]
                held = np.bincount(unit[mine], minlength=len(n))
                before = np.cumsum(~mine) - ~mine
                lacks = np.maximum(n + (-n * sets.percent // 100) + 1 - held, 0)
                others = ~mine & new[unit] & (before - before[np.minimum(first, max(len(token) - 1, 0))][unit] < lacks[unit]) if len(token) else mine
                lists = []
                for part in (mine, others):
                    ends = np.concatenate([[0], np.cumsum(np.bincount(unit[part], minlength=len(n))[keep])]).astype(np.int32)
                    lists.append((pa.array(ends), pa.array(token[part].view(np.int64))))
                null = pa.array(~new[keep])
                flags = np.zeros((len(n), sets.bits), bool)
                flags[unit, ((token >> np.uint64(3)) & np.uint64(sets.bits - 1)).astype(np.int64)] = True
                words = np.packbits(flags[keep], axis=1).view(np.int64)
                bits = pa.ListArray.from_arrays(pa.array(np.arange(len(keep) + 1, dtype=np.int32) * words.shape[1]), pa.array(words.ravel()), mask=null)
                at = pa.array(a + row[keep])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), keys.take(at), pa.array(number[keep].astype(np.int32)), pa.array(n[keep].astype(np.int32)),
                     pa.array(names, pa.binary()), *(pa.ListArray.from_arrays(ends, values, mask=null) for ends, values in lists), bits],
                    ["doc_id", "text_key", "unit", "n", "fp", "chosen", "others", "bits"])

    return docs.mapInArrow(rows, RECORD)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the text's key; rows equal in the three are one document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))


def checked_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its counted rows are few; else it is shuffled."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


class Join:
    """The written tables of one similarity join over ``docs`` (doc_id, text).

    ``members`` are the classes with rows in the index; their ``node`` numbers
    follow the order of their first units, (doc_id, text_key, unit).
    """

    def __init__(self, docs: DataFrame, sets: Sets):
        self.docs, self.sets = keyed(docs), sets
        self.classes, hot = rarity(docs, sets)
        made = written(records(self.docs, sets, self.classes), "sets")
        self.nodes = written(
            made.where("n > 0").groupBy("fp")
            .agg(F.min(F.struct("doc_id", "text_key", "unit")).alias("first"), F.min("doc_id").alias("least_id"), F.count("*").alias("units"),
                 F.max("n").alias("n"), F.max("chosen").alias("chosen"), F.max("others").alias("others"), F.max("bits").alias("bits"))
            .withColumn("class", F.monotonically_increasing_id()), "classes")
        self.records = written(made.select("doc_id", "text_key", "unit", "n", "fp"), "units")
        forget(made)
        live = written(self._live(hot), "index")
        names = live.select("class").distinct().join(self.nodes.select("class", "fp", "first", "n", "bits"), "class")
        self.members = written(names.repartitionByRange("first").sortWithinPartitions("first")
                               .withColumn("node", F.monotonically_increasing_id()), "members")
        self.live = written(live.join(self.members.select("class", "node", "n", "bits"), "class").drop("class"), "index")
        forget(live)
        self.whole = None  # node and all tokens, of the members met so far

    def _live(self, hot: int) -> DataFrame:
        """Index rows (token, class, pos, shared) of the tokens in prefixes that several classes have.

        ``pos`` is the token's place in the order of its set; of the tokens before it, ``shared`` are held by other classes."""
        p = self.sets.percent
        sizes = ["class", "n", F.size("chosen").alias("held")] if self.sets.exact else ["class"]
        index = self.nodes.select(*sizes, F.posexplode("others").alias("place", "token"))
        if self.sets.exact:
            index = index.union(self.nodes.select(*sizes, F.lit(-1).alias("place"), F.explode("chosen").alias("token")))
        by_token, frequent = Window.partitionBy("token"), F.shiftrightunsigned("token", 56) >= hot
        rows = index.withColumn("classes", F.lit(1 << 40))
        if (self.classes >= hot).any():
            rows = rows.where(frequent).union(index.where(~frequent).withColumn("classes", F.count("*").over(by_token)))
        else:
            rows = index.withColumn("classes", F.count("*").over(by_token))
        by_class = Window.partitionBy("class")
        rows = rows.where("classes > 1")
        if not self.sets.exact:
            # all tokens in one order: a token's place is its position, and all of them lie in the prefix
            shared = F.row_number().over(by_class.orderBy("place")) - 1
            return rows.select("token", "class", F.col("place").alias("pos"), shared.alias("shared"))
        rows = (rows.withColumn("shared", F.row_number().over(by_class.orderBy(F.col("place") >= 0, F.when(F.col("place") < 0, F.col("classes")), "place", "token")) - 1)
                .withColumn("alone", F.col("held") - F.count(F.when(F.col("place") < 0, 1)).over(by_class)))
        pos = F.when(F.col("place") < 0, F.col("alone") + F.col("shared")).otherwise(F.col("held") + F.col("place"))
        return rows.withColumn("pos", pos.cast("int")).where(f"pos < n - ({p}L * n + 99) div 100 + 1").select("token", "class", "pos", "shared")

    def need(self, na: str, nb: str) -> Column:
        """Least overlap of two matching sets of these sizes."""
        p = self.sets.percent
        return F.expr(f"({p}L * ({na} + {nb}) + {99 + p}) div {100 + p}")

    def near(self, a: str, b: str) -> Column:
        """Length, positional and suffix bound of two index rows of one token.

        Two matching sets share a token among the first ``n - need + 1`` of
        each, so rows beyond that leave the pair to an earlier token."""
        length = F.expr(f"100L * least({a}.n, {b}.n) >= {self.sets.percent} * greatest({a}.n, {b}.n)")
        most = F.expr(f"least({a}.shared, {b}.shared) + least({a}.n - {a}.pos, {b}.n - {b}.pos)")
        lacks = lambda x, y: " + ".join(f"bit_count({x}.bits[{i}] & ~{y}.bits[{i}])" for i in range(self.sets.bits // 64))
        both = F.expr(f"least({a}.n - ({lacks(a, b)}), {b}.n - ({lacks(b, a)}))")
        need = self.need(f"{a}.n", f"{b}.n")
        prefix = (F.col(f"{a}.pos") <= F.col(f"{a}.n") - need) & (F.col(f"{b}.pos") <= F.col(f"{b}.n") - need)
        return length & prefix & (most >= need) & (both >= need)

    def crowded(self) -> DataFrame:
        """Index rows of the tokens that three or more members have: of two, one is the pivot."""
        tokens = self.live.groupBy("token").count().where("count > 2").select("token")
        return written(self.live.join(tokens, "token", "left_semi"), "crowded")

    def pivots(self, rows: DataFrame) -> DataFrame:
        """The pivot of each token's rows: fewest rarer tokens, then smallest node."""
        return rows.groupBy("token").agg(F.min(F.struct("pos", "node", "n", "shared", "bits")).alias("p")).select("token", "p.*")

    def fetch(self, pairs: DataFrame) -> None:
        """Make the whole sets of the pairs' members that are not made yet, from their first units' texts."""
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        if self.whole is not None:
            nodes = nodes.join(self.whole.select("node"), "node", "left_anti")
        wanted = written(self.members.select("node", "fp", "first").join(nodes, "node").groupBy("first.doc_id", "first.text_key")
                         .agg(F.collect_list(F.struct("node", "fp")).alias("wanted")), "wanted")
        of = checked_broadcast(wanted.withColumnsRenamed({"doc_id": "of_id", "text_key": "of_key"}), wanted.count())
        texts = self.docs.join(of, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key"))).select("text", "wanted")
        whole = written(texts.mapInArrow(_whole_sets(self.sets, self.classes), "node long, tokens array<long>"), "whole")
        self.whole = whole if self.whole is None else self.whole.union(whole)

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The matching pairs (a, b) of a written table of distinct pairs, as a written table.

        Rows that repeat a document give its sets, and so a pair, again."""
        self.fetch(pairs)
        count = pairs.count()
        second = self.whole.join(checked_broadcast(pairs, count), F.col("node") == F.col("b")).select("a", "b", F.col("tokens").alias("sb"))
        firsts = pairs.select("a").distinct()
        first = self.whole.join(checked_broadcast(firsts, count), F.col("node") == F.col("a")).select("a", F.col("tokens").alias("sa"))
        both = second.join(first, "a").withColumn("both", F.size(F.array_intersect("sa", "sb")))
        return written(both.where(F.expr(f"100L * both >= {self.sets.percent}L * (size(sa) + size(sb) - both)")).select("a", "b"), "matches")


def _whole_sets(sets: Sets, classes: np.ndarray) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.utf8(batch.column(0))
            names = [{bytes(x["fp"]): x["node"] for x in w} for w in batch.column(1).to_pylist()]
            for a, b in tb.blocks(offsets):
                row, _, n, first, _, token, fp = _tokens(sets, classes, data[offsets[a]: offsets[b]], offsets[a:b] - offsets[a])
                found = [(i, node) for i in np.flatnonzero(n) if (node := names[a + row[i]].get(fp[i].tobytes())) is not None]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for _, x in found], pa.int64()),
                     pa.array([token[first[i]: first[i] + n[i]].view(np.int64) for i, _ in found], pa.list_(pa.int64()))], ["node", "tokens"])

    return rows
