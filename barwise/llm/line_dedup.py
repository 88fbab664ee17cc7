"""Line dedup: remove lines that match an earlier line of the corpus.

Method: exact set-similarity join (:mod:`barwise.llm.setjoin`) of the lines'
token sets: tokens ordered by rarity, prefix, positional and length filters,
Jaccard verified on whole sets, later matches removed.  A line's tokens are its
distinct five-word shingles (lower-cased A-Z); two lines match at a Jaccard
similarity of 0.8 or more.  Lines come in the order of (doc_id, line number);
a line goes if any earlier line, removed or not, matches it.

Results for odd input: a line of one to four words is one shingle, so it
matches lines of the same words only.  A line without a word has no shingle and
is never removed.  Null and empty texts have no lines to remove and stay as they
are.  A null doc_id comes before all others.  Rows equal in doc_id and text are
one document and lose the same lines; rows that repeat a doc_id with other
texts are ordered by the key of the text.  An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.llm.setjoin import Join, Sets, checked_broadcast
from barwise.session import scratch, written


def _later(join: Join) -> DataFrame:
    """Classes whose first line matches an earlier line; nodes are in the lines' order."""
    pivots = join.pivots(join.live)
    pairs = written(join.live.alias("r").join(pivots.alias("p"), "token").where("r.node <> p.node").where(join.near("r", "p"))
                    .select(F.least("r.node", "p.node").alias("a"), F.greatest("r.node", "p.node").alias("b")).distinct(), "candidates")
    gone = written(join.verified(pairs).select(F.col("b").alias("node")).distinct(), "later")
    # members not yet known to be later meet every other member that comes before them
    crowded = join.crowded()
    still = crowded.join(gone, "node", "left_anti")
    rows = crowded.join(still.select("token").distinct(), "token", "left_semi")
    more = written(still.alias("r").join(rows.alias("s"), "token").where("s.node < r.node").where(join.near("r", "s"))
                   .select(F.col("s.node").alias("a"), F.col("r.node").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti"), "candidates")
    if not more.isEmpty():
        gone = gone.union(join.verified(more).select("b")).distinct()
    return join.members.join(gone, "node", "left_semi").select("class")


def removed_lines(docs: DataFrame, percent: int = 80, k: int = 5) -> DataFrame:
    """doc_id, text_key and the removed line numbers (from 0, ascending) of the
    documents that lose lines; ``text_key`` is ``xxhash64(text)``."""
    with scratch(docs.sparkSession) as keep:
        join = Join(docs, Sets(k, percent, lines=True, bits=256, exact=False))
        named = join.nodes.select("fp", "class", "first", "units").join(_later(join).withColumn("later", F.lit(True)), "class", "left")
        # a line that no other one equals stays if no other one matches it
        named = written(named.where("later or units > 1").drop("units", "class"), "named")
        lines = join.records.select("doc_id", "text_key", "unit", "fp").join(checked_broadcast(named, named.count()), "fp")
        own = F.struct("doc_id", "text_key", "unit").eqNullSafe(F.col("first"))
        rows = (lines.where(F.col("later").isNotNull() | ~own).groupBy("doc_id", "text_key")
                .agg(F.array_sort(F.collect_set("unit")).alias("removed")))
        return keep(written(rows, "removed"))


def line_report(docs: DataFrame, percent: int = 80, k: int = 5) -> DataFrame:
    """doc_id, n_lines, n_removed and the removed line numbers of every row."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                        F.coalesce(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long").alias("n_lines"))
    gone = removed_lines(docs, percent, k).withColumnsRenamed({"doc_id": "gone_id", "text_key": "gone_key"})
    return (keyed.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_key") == F.col("gone_key")), "left")
            .select("doc_id", "n_lines",
                    F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("removed", F.array().cast("array<int>")).alias("removed")))


def dedup_lines(docs: DataFrame, percent: int = 80, k: int = 5) -> DataFrame:
    """``docs`` with the later matches cut out of ``text``.

    A document that loses its every non-blank line goes.  ``n_chars``, where
    there is such a column, follows the text.
    """
    gone = removed_lines(docs, percent, k)
    held = gone.agg(F.count("*"), F.coalesce(F.sum(F.size("removed")), F.lit(0))).first()
    gone = checked_broadcast(gone, max(held[0], held[1] // 4)).withColumnsRenamed({"doc_id": "__llm_gone_id", "text_key": "__llm_gone_key", "removed": "__llm_gone_lines"})
    rows = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__llm_gone_id")) & (F.xxhash64("text") == F.col("__llm_gone_key")), "left")
    lines = F.split("text", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__llm_gone_lines")
    cut = F.expr("array_join(transform(__llm_left, i -> __llm_lines[i]), '\n')")
    hit = F.col("__llm_gone_lines").isNotNull()
    rows = (rows.withColumn("__llm_lines", F.when(hit, lines)).withColumn("__llm_left", F.when(hit, left))
            .withColumn("text", F.when(hit, cut).otherwise(F.col("text")))
            .where(~hit | F.col("text").rlike(r"[^\x20\x09-\x0D]")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(docs.columns)
