"""Merkle manifest of a dataset: a digest tree per group of rows, and a proof per row.

A row's leaf is the digest of its fields.  Inside a group (a ``lang``) leaves
ascend by doc_id, and while several nodes remain every ``arity`` consecutive
ones become the digest of their concatenation (the last run may be shorter,
even one node).  What remains is the group's subroot; the subroots, in the
order of their groups, give the root in the same way.  A row's proof is the
list of its path's siblings, from which anyone can fold its leaf to the root.

Method: sibling-shift self-joins.  Every level is a table of nodes (group,
place, digest).  A level is joined with itself on computed sibling places, by
``place XOR 1`` for two nodes a run, by the other slots' offsets otherwise;
the nodes in slot zero then hold their whole run and emit the parents.  Proofs
come from the top down: each node appends its parent's path to its own siblings,
so all levels together cost about twice the lowest.

Places are counted by range partitions: rows are dealt by (group, doc_id, leaf)
ranges, numbered inside each, and moved on by the counts of the ranges before.
No group lies in one task, and joins are on (group, place), which no row shares
with another.  What reaches the driver is one count and the root.

Results for odd input: a null group is a group of its own and comes first.  A
null doc_id comes first in its group and is ``-`` in the leaf; rows that repeat
a doc_id are ordered by leaf, and equal rows are leaves of their own.  A group
of one row has its leaf as its subroot; a lone subroot is the root.  An empty
table has an empty manifest and no root.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from barwise.session import written

#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of the way down that one plan joins before its rows are written.
LEVELS = 4


def digest(data: str | Column) -> Column:
    """SHA-256 of a text column, as 32 bytes."""
    return F.unhex(F.sha2(F.col(data).cast("binary") if isinstance(data, str) else data, 256))


def text_of(digests: str | Column) -> Column:
    """Lowercase hex of digests."""
    return F.lower(F.hex(digests))


def field(value: Column) -> Column:
    """A field of a leaf: its UTF-8 length, a colon and its text; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return digest(F.concat(*[field(c) for c in fields]).cast("binary"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their place in their group (from 0, by ``order``) and the group's size ``n``.

    Rows are equal in every column used if they are equal in group and order."""
    spread = written(rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
                     .withColumn("seat", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()), "placed")
    counts = spread.groupBy("grp", "part").agg(F.min("seat").alias("first"), F.count("*").alias("held"))
    by_group = Window.partitionBy("grp")                       # one row per range that the group reaches into
    before = F.sum("held").over(by_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("grp", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("held").over(by_group).alias("n"))
    return (spread.join(counts, ["grp", "part"]).withColumn("place", F.col("seat") + F.col("shift")).drop("seat", "part", "shift"))


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes with their slot and ``others``, their run's other digests from left to right."""
    nodes = nodes.withColumn("slot", (F.col("place") % arity).cast("int"))
    pool = nodes.select(F.col("grp").alias("s_grp"), F.col("place").alias("s_place"), F.col("hash").alias("sibling"))
    if arity == 2:
        joined = nodes.join(pool, (F.col("grp") == F.col("s_grp")) & (F.col("place").bitwiseXOR(F.lit(1)) == F.col("s_place")), "left")
        return joined.select(*nodes.columns, F.coalesce("sibling", F.lit(b"")).alias("others"))
    shifts = nodes.select("grp", "place", F.explode(F.array(*map(F.lit, range(1, arity)))).alias("shift"))
    wanted = shifts.withColumn("other", F.col("place") - F.col("place") % arity + (F.col("place") + F.col("shift")) % arity)
    found = (wanted.join(pool, (F.col("grp") == F.col("s_grp")) & (F.col("other") == F.col("s_place")))
             .groupBy("grp", "place").agg(F.array_sort(F.collect_list(F.struct("other", "sibling"))).alias("run")))
    others = F.aggregate("run", F.lit(b""), lambda a, r: F.concat(a, r["sibling"]))
    return (nodes.join(found, ["grp", "place"], "left")
            .select(*nodes.columns, F.coalesce(others, F.lit(b"")).alias("others")))


def levels(leaves: DataFrame, arity: int = 2) -> list[DataFrame]:
    """The levels of all groups' trees, lowest first: grp, place, n, hash, slot and others.

    ``n`` is the group's number of nodes on the level; a group's top is the node with n = 1.
    Further columns of ``leaves`` stay on the lowest level."""
    extra = [c for c in leaves.columns if c not in ("grp", "place", "n", "hash")]
    width = leaves.agg(F.max("n")).first()[0]
    top = {"slot": F.lit(0), "others": F.lit(b"")}
    now, out = leaves, []
    while width and width > 1:
        level = written(_with_siblings(now.where("n > 1"), arity).unionByName(now.where("n = 1").withColumns(top)), "level")
        out.append(level)
        run = F.concat(text_of("hash"), text_of("others"))
        now = level.where("n > 1 and slot = 0").drop(*extra).select(
            "grp", F.expr(f"place div {arity}").alias("place"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"), digest(run).alias("hash"))
        width = -(-width // arity)
    return out + [written(now.withColumns(top), "level")] if width else out


def paths(tree: list[DataFrame], upper: DataFrame | None = None, arity: int = 2) -> DataFrame:
    """The lowest level's rows with their ``subroot`` and ``path``: (slot, others) of every level up to
    their group's top, then that group's path in ``upper`` (grp, path), if given."""
    tops = tree[0].where("n = 1").select(F.lit(0).alias("depth"), "grp", "hash")
    for depth, level in enumerate(tree[1:], 1):
        tops = tops.union(level.where("n = 1").select(F.lit(depth), "grp", "hash"))
    none = F.array().cast("array<struct<slot: int, others: binary>>")
    tops = tops.join(upper, "grp") if upper is not None else tops.withColumn("path", none)
    tops = written(tops.select("depth", "grp", F.col("hash").alias("subroot"), "path"), "tops")
    columns = [c for c in tree[0].columns if c not in ("slot", "others")]
    above = None
    for depth in reversed(range(len(tree))):
        level, ends = tree[depth], tops.where(F.col("depth") == depth)
        if depth:
            found, keep = ends.select("grp", F.lit(0).cast("long").alias("place"), "subroot", "path"), ["grp", "place"]
        else:
            found, keep = level.where("n = 1").join(ends, "grp").select(*columns, "subroot", "path"), columns
        if above is not None:
            parent = above.select(F.col("grp").alias("p_grp"), F.col("place").alias("p_place"), "subroot", F.col("path").alias("rest"))
            lower = level.where("n > 1").join(parent, (F.col("grp") == F.col("p_grp")) & (F.expr(f"place div {arity}") == F.col("p_place")))
            own = F.array(F.struct("slot", "others"))
            found = found.unionByName(lower.select(*keep, "subroot", F.concat(own, F.col("rest")).alias("path")))
        above = written(found, "paths") if depth and depth % LEVELS == 0 else found
    return above


def folded(start: Column, path: Column) -> Column:
    """The digest that a leaf and a path give."""
    def step(below: Column, run: Column) -> Column:
        left = F.substr(run["others"], F.lit(1), 32 * run["slot"])
        right = F.substr(run["others"], 32 * run["slot"] + 1, F.octet_length(run["others"]))
        return digest(F.concat(text_of(left), text_of(below), text_of(right)).cast("binary"))

    return F.aggregate(path, start, step)


def manifest(docs: DataFrame, arity: int = 2, change: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, path, changed_leaf and folded_root of every row, digests as 32 bytes.

    ``change`` says which rows are tampered with: there ``n_chars`` is one more when the leaf is made
    again, and folded with the original siblings."""
    fields = [F.col(c) for c in FIELDS]
    moved = [(F.col(c).cast("long") + 1) if c == "n_chars" else F.col(c) for c in FIELDS]
    first = docs.select(F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("grp"), F.col("doc_id").cast("long").alias("row_id"),
                        leaf(fields).alias("hash"), (F.when(change, leaf(moved)) if change is not None else F.lit(None).cast("binary")).alias("moved"))
    rows = placed(written(first, "leaves"), ["row_id", "hash"])
    tree = levels(rows, arity)
    if not tree:
        return rows.select(F.col("row_id").alias("doc_id"), F.col("hash").alias("leaf"), F.col("hash").alias("subroot"), F.col("hash").alias("root"),
                           F.array(F.struct(F.lit(0).alias("slot"), F.col("hash").alias("others"))).alias("path"),
                           F.col("hash").alias("changed_leaf"), F.col("hash").alias("folded_root"))
    subroots = tree[0].where("n = 1").select("grp", "hash")
    for level in tree[1:]:
        subroots = subroots.union(level.where("n = 1").select("grp", "hash"))
    crown = levels(placed(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("group"), "hash"), ["group"]), arity)
    root = bytes(crown[-1].first()["hash"])
    found = paths(tree, written(paths(crown, arity=arity).select(F.col("group").alias("grp"), "path"), "upper"), arity)
    changed = F.coalesce("moved", "hash")
    return found.select(F.col("row_id").alias("doc_id"), F.col("hash").alias("leaf"), "subroot", F.lit(root).alias("root"), "path",
                        changed.alias("changed_leaf"), folded(changed, F.col("path")).alias("folded_root"))
