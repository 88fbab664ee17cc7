"""N-gram Jaccard join: groups of documents linked by their shingle sets.

Method: rare-first prefix filtering with length, positional and suffix
filters, joined on prefix n-grams and verified once per pair
(:mod:`barwise.llm.setjoin`); components of the verified links.  Sets of
different groups around one pivot meet where they differ from it in the same
tokens, as matching ones must, so near misses of a large group do not meet
all its members.

Results for odd input: a document without words (null, empty or blank text)
has no shingles and is linked with nothing.  A text of fewer than k words is
one shingle.  Rows may repeat a doc_id: every row gets a result, and rows of
equal sets are linked.  A row without a doc_id takes part; it gets its group's
smallest doc_id, or null if its group has none.  An empty table gives an empty
table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwise.llm.components import components
from barwise.llm.setjoin import Join, Sets, checked_broadcast
from barwise.session import scratch, written

#: Rows of a token up to which rows of different groups meet each other; beyond, they meet by what sets them apart from the pivot.
FEW = 16
#: Nodes around a pivot that show which differences from it are common.
SHOWN = 64


def links(join: Join) -> DataFrame:
    """(node, component) of the linked members of a :class:`Join`."""
    pivots = join.pivots(join.live)
    tested = written(join.live.alias("r").join(pivots.alias("p"), "token").where("r.node <> p.node").where(join.near("r", "p"))
                     .select(F.least("r.node", "p.node").alias("a"), F.greatest("r.node", "p.node").alias("b")).distinct(), "candidates")
    found = join.verified(tested)
    groups = components(found)
    # every row outside its token's pivot's group is compared with all rows of other groups
    every = written(_grouped(join.crowded(), groups), "grouped")
    tokens = every.groupBy("token").agg(F.count("*").alias("rows"), F.min(F.struct("pos", "node", "g")).alias("p"), F.min("g").alias("lo"), F.max("g").alias("hi"))
    mixed = written(every.join(tokens.where("lo <> hi").select("token", "rows", F.col("p.node").alias("pivot"), F.col("p.g").alias("home")), "token"), "mixed")
    few = mixed.where(F.col("rows") <= FEW)
    pairs = (few.where("g <> home").alias("r").join(few.alias("s"), "token").where("r.g <> s.g").where(join.near("r", "s"))
             .select(F.least("r.node", "s.node").alias("a"), F.greatest("r.node", "s.node").alias("b")))
    around = written(mixed.where(F.col("rows") > FEW).where("node <> pivot").select("pivot", "home", "node", "g").distinct(), "around")
    edits = written(_rare_first(written(_edits(join, around), "edits")), "edits")
    p = join.sets.percent
    beside = edits.where("g <> home").where(F.expr(f"{100 + p}L * e <= {100 - p}L * (n + pivot_n)")).select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b"))
    pairs = written(pairs.union(_by_edits(edits, p)).distinct().join(tested, ["a", "b"], "left_anti"), "candidates")
    more = join.verified(pairs).union(beside)
    return groups if more.isEmpty() else components(found.union(more))


def _edits(join: Join, around: DataFrame) -> DataFrame:
    """``around`` (pivot, home, node, g) with the tokens that only one of node and pivot has (those of the node first), their
    number ``e`` and the sizes ``n`` and ``pivot_n`` of the two sets."""
    join.fetch(around.select(F.col("pivot").alias("a"), F.col("node").alias("b")))
    own = join.whole.join(checked_broadcast(around, around.count()), "node")
    pivots = join.whole.join(around.select(F.col("pivot").alias("node")).distinct(), "node").select(F.col("node").alias("pivot"), F.col("tokens").alias("theirs"))
    return (own.join(pivots, "pivot")
            .select("pivot", "home", "node", "g", F.size("tokens").alias("n"), F.size("theirs").alias("pivot_n"),
                    F.concat(F.array_except("tokens", "theirs"), F.array_except("theirs", "tokens")).alias("edits"))
            .withColumn("e", F.size("edits")))


def _rare_first(edits: DataFrame) -> DataFrame:
    """``edits`` ordered by how many of some nodes around the pivot, matches or not, have them; those of one of these at
    most come first.  Any order that is one for all nodes around a pivot gives the same matches; this one gives few candidates."""
    by_pivot = Window.partitionBy("pivot").orderBy(F.xxhash64("node"), "node")
    some = edits.withColumn("k", F.row_number().over(by_pivot)).where(F.col("k") <= SHOWN)
    held = some.select("pivot", F.explode("edits").alias("edit")).groupBy("pivot", "edit").agg(F.count("*").alias("held")).where("held > 1")
    usual = held.groupBy("pivot").agg(F.array_sort(F.collect_list(F.struct("held", "edit"))).alias("usual")).select("pivot", F.col("usual.edit").alias("usual"))
    usual_of = F.coalesce("usual", F.expr("array()").cast("array<long>"))
    return (edits.join(usual, "pivot", "left")
            .withColumn("edits", F.concat(F.array_except("edits", usual_of), F.array_intersect(usual_of, "edits"))).drop("usual"))


def _by_edits(edits: DataFrame, p: int) -> DataFrame:
    """Pairs (a, b) of different groups around one pivot that may match: one is no match of the pivot, and the two share
    edits among the first ones of each.

    Sets r and s differ in e_r + e_s - 2 * (shared edits) tokens and match if these are at most
    c * (n_r + n_s), c = (100 - p) / (100 + p).  If r is no match of the pivot, that takes at least
    (e_s - c * (n_s - n_pivot)) / 2 shared edits, so one at least; it also takes e_r - c * (n_r + n_s) of them, and
    as many of s."""
    row = "pivot", "edit", "place", "node", "g", "n", "e", "far"
    far = f"g <> home and {100 + p}L * e > {100 - p}L * (n + pivot_n)"
    most = f"n * {100 - p}L div {p}"                            # tokens in which a set and any match of it differ
    half = f"({100 + p}L * e - {100 - p}L * (n - pivot_n) + {2 * (100 + p) - 1}) div {2 * (100 + p)}"

    def first(least: str, rows: DataFrame) -> DataFrame:
        part = F.expr(f"slice(edits, 1, cast(e - {least} + 1 as int))")
        return rows.select("pivot", "node", "g", "n", "e", F.expr(far).alias("far"), F.posexplode(part).alias("place", "edit")).select(*row)

    s = first(f"greatest(1L, e - {most}, {half})", edits)
    r = first(f"greatest(1L, e - {most})", edits.where(far))
    held = s.groupBy("pivot", "edit").agg(F.min("g").alias("lo"), F.max("g").alias("hi"))
    r = r.join(held, ["pivot", "edit"]).where("lo <> g or hi <> g").select(*row)
    shared = F.expr(f"(r.e + s.e - ({100 - p}L * (r.n + s.n)) div {100 + p} + 1) div 2")
    return (r.alias("r").join(s.alias("s"), ["pivot", "edit"]).where("r.g <> s.g and (not s.far or r.node < s.node)")
            .where(F.expr(f"100L * least(r.n, s.n) >= {p} * greatest(r.n, s.n)"))
            .where(F.least(F.expr("r.e - r.place"), F.expr("s.e - s.place")) >= shared)
            .select(F.least("r.node", "s.node").alias("a"), F.greatest("r.node", "s.node").alias("b")))


def _grouped(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return rows.join(groups, "node", "left").withColumn("g", F.coalesce("component", "node")).drop("component")


def near_groups(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_key, n_shingles and component_id of every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable by links, its own
    included.  ``text_key`` is ``xxhash64(text)``.
    """
    with scratch(docs.sparkSession) as keep:
        join = Join(docs, Sets(k, percent))
        groups = links(join)
        linked = join.members.select("class", "node").join(groups, "node").select("class", "component")
        named = join.nodes.select("fp", "class", "least_id").join(linked, "class", "left")
        # the numbers of unlinked classes are their own; linked ones take a number below zero
        named = named.withColumn("g", F.coalesce(-1 - F.col("component"), F.col("class")))
        least = named.groupBy("g").agg(F.min("least_id").alias("component_id"))
        of_set = named.select("fp", "g").join(least, "g").select("fp", "component_id")
        rows = (join.records.select("doc_id", "text_key", F.col("n").cast("long").alias("n_shingles"), "fp").join(of_set, "fp", "left")
                .select("doc_id", "text_key", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
        return keep(written(rows, "groups"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows of a group other than its smallest doc_id.

    A row without a doc_id cannot be named as a member and stays.  Of rows
    that repeat the smallest doc_id one stays.
    """
    groups = near_groups(docs, k, percent)
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("__llm_gone_id"), F.col("text_key").alias("__llm_gone_key")).distinct()
    kept = docs.join(checked_broadcast(gone, gone.count()), (F.col("doc_id") == F.col("__llm_gone_id")) & (F.xxhash64("text") == F.col("__llm_gone_key")), "left_anti")
    twice = groups.where("doc_id = component_id and n_shingles > 0").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("__llm_twice_id"))
    if twice.isEmpty():
        return kept
    single = kept.join(twice, F.col("doc_id") == F.col("__llm_twice_id"), "left_anti")
    return single.unionByName(kept.join(twice, F.col("doc_id") == F.col("__llm_twice_id"), "left_semi").dropDuplicates(["doc_id"]))
