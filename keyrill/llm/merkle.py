"""Operator 13: a Merkle manifest of a dataset, with a proof for every row, by nested-interval labels.

A node of a tree is labelled with the interval [low, high) of the ranks of the leaves it covers, its level and its tree. Nodes of one
level are cut at multiples of the fan-out to that level's power, so the number of its interval's cut is a node's bucket: a
child meets its parent by an equality of tree and bucket and the containment of its interval. The siblings of a node are those
children of its parent whose intervals lie outside its own.

Leaves are ranked by range partitioning and the counts of each task's runs, without a window over a tree, so one tree may hold any
share of the rows. Trees are built level by level, each an eighth of the one below; proofs come down the other way, from a level to the
next, so a digest of an upper level is never paired with all leaves below it. Between levels are written tables.

A leaf is the digest of doc_id, source, lang, n_chars and text: `-` for null, else the UTF-8 length, a colon and the value. Null ids come
first in their language; rows of equal ids are ordered by their leaves, and rows that are equal in all have the same digests
whichever comes first, but each its own place. Null language is a tree of its own, the first. Empty texts are values, not nulls. Very long texts
are read once, by a built-in digest. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyrill.llm.common import remainder, stored

FAN_OUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """One input of a leaf's digest."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _joined(digests: Column) -> Column:
    return F.concat_ws("", digests)


def ranked(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Add `low`, the rank of each row within its tree in the given order, which must have no ties that matter."""
    placed = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    # the place of a row rises through its task, which goes with the row into the written table
    placed = stored(placed.withColumn("place", F.monotonically_increasing_id()), "merkle-ranks")
    task = F.shiftrightunsigned("place", 33)
    runs = placed.groupBy(tree, task.alias("task")).agg(F.min("place").alias("first"), F.count("*").alias("count"))
    before = F.sum("count").over(Window.partitionBy(tree).orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(F.col(tree).alias("of"), "task", "first", F.coalesce(before, F.lit(0)).alias("before"))
    found = placed.withColumn("task", task).join(runs.withColumnRenamed("task", "run"), F.col(tree).eqNullSafe(F.col("of")) & (F.col("task") == F.col("run")))
    return found.withColumn("low", F.col("place") - F.col("first") + F.col("before")).drop("place", "task", "of", "run", "first", "before")


def _parents(nodes: DataFrame, level: int) -> DataFrame:
    """The nodes of a level over (tree, low, high, digest) of the level below, with the children in order."""
    run = F.floor(F.col("low") / F.lit(FAN_OUT**level))
    children = F.array_sort(F.collect_list(F.struct("low", "high", "digest")))
    grouped = nodes.groupBy("tree", run.alias("bucket")).agg(children.alias("children"))
    return grouped.select(
        "tree",
        F.lit(level).alias("level"),
        "bucket",
        F.col("children")[0]["low"].alias("low"),
        F.element_at("children", -1)["high"].alias("high"),
        F.sha2(_joined(F.col("children.digest")), 256).alias("digest"),
        "children",
    )


def grown(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The levels above `leaves` (tree, low, digest), and the subroots (tree, digest).

    A tree is done once a level has one node of it; a tree of one leaf has that leaf for its root.
    """
    sizes = stored(leaves.groupBy("tree").count(), "merkle-sizes")
    largest = sizes.agg(F.max("count")).first()[0] or 0
    nodes = leaves.join(sizes.withColumnRenamed("tree", "of"), F.col("tree").eqNullSafe(F.col("of")))
    nodes = nodes.select("tree", "low", (F.col("low") + 1).alias("high"), "digest", "count")
    roots, levels, level = [nodes.where("count = 1").select("tree", "digest")], [], 0
    below = nodes.where("count > 1").drop("count")
    while FAN_OUT**level < largest:
        level += 1
        found = stored(_parents(below, level), f"merkle-level-{level}")
        levels.append(found)
        # the one node of a level covers its whole tree
        whole = sizes.where(F.col("count").between(FAN_OUT ** (level - 1) + 1, FAN_OUT**level)).select(F.col("tree").alias("of"))
        roots.append(found.join(whole, F.col("tree").eqNullSafe(F.col("of")), "left_semi").select("tree", "digest"))
        below = found.join(whole, F.col("tree").eqNullSafe(F.col("of")), "left_anti").select("tree", "low", "high", "digest")
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.unionByName(more)
    return levels, subroots


def _step(low: Column, high: Column, children: Column) -> Column:
    """The digests left and right of a node among its parent's children: those of intervals outside its own."""
    left = F.filter(children, lambda c: c["high"] <= low)
    right = F.filter(children, lambda c: c["low"] >= high)
    return F.struct(_joined(left["digest"]).alias("left"), _joined(right["digest"]).alias("right"))


def _under(nodes: DataFrame, parents: DataFrame, level: int) -> DataFrame:
    """`nodes` of a level with `path`, the steps from each up to its root: its own before those of its parent."""
    above = parents.select(
        F.col("tree").alias("of"), F.col("bucket").alias("parent"), F.col("low").alias("from"), F.col("high").alias("to"), F.col("children").alias("family"), F.col("path").alias("upper")
    )
    meets = F.col("tree").eqNullSafe(F.col("of")) & (F.floor(F.col("low") / F.lit(FAN_OUT ** (level + 1))) == F.col("parent"))
    inside = (F.col("from") <= F.col("low")) & (F.col("high") <= F.col("to"))
    found = nodes.join(above, meets & inside, "left")
    step = F.array(_step(F.col("low"), F.col("high"), F.col("family")))
    path = F.when(F.col("family").isNotNull(), F.concat(step, F.coalesce("upper", F.array().cast("array<struct<left:string,right:string>>"))))
    return found.withColumn("path", F.coalesce(path, "start")).drop("of", "parent", "from", "to", "family", "upper", "start")


def with_paths(leaves: DataFrame, levels: Sequence[DataFrame], roots: DataFrame) -> DataFrame:
    """`leaves` (tree, low, ...) with the `path` of each, ending with that of its tree in `roots` (tree, path)."""
    start = roots.select(F.col("tree").alias("own"), F.col("path").alias("start"))

    def started(nodes: DataFrame) -> DataFrame:
        return nodes.join(start, F.col("tree").eqNullSafe(F.col("own")), "left").drop("own")

    above = None
    for level in range(len(levels), 0, -1):
        nodes = started(levels[level - 1])
        above = stored(_under(nodes, above, level) if above is not None else nodes.withColumnRenamed("start", "path"), f"merkle-paths-{level}")
    leaves = started(leaves.withColumn("high", F.col("low") + 1))
    return _under(leaves, above, 0) if above is not None else leaves.withColumnRenamed("start", "path")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the steps above it give."""
    return F.aggregate(path, start, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, low, subroot, root, path, seen) of every row.

    `low` is its rank in its language, `path` the steps (left, right) of its proof, and `seen` the leaf as a reader would
    compute it who gets altered texts: lower-cased A-Z where 3 divides the crc32 of the id, else as they are.
    """
    values = [F.col(name) for name in FIELDS]
    altered = F.translate("text", _UPPER, _LOWER)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("lang").alias("tree"),
        leaf(values).alias("digest"),
        F.when(remainder(F.col("doc_id"), 3) == 0, leaf([*values[:-1], altered])).alias("altered"),
    )
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    leaves = stored(ranked(rows, "tree", ("doc_id", "digest", "row")).drop("row"), "merkle-ranked")
    levels, subroots = grown(leaves.select("tree", "low", "digest"))
    subroots = stored(subroots, "merkle-subroots")

    # the tree over the languages is grown in the same way, over their subroots
    top = stored(ranked(subroots.withColumn("all", F.lit(0)), "all", ("tree",)), "merkle-languages").withColumnRenamed("tree", "lang")
    tops, root = grown(top.select(F.col("all").alias("tree"), "low", "digest"))
    empty = F.array().cast("array<struct<left:string,right:string>>")
    upper = with_paths(top.withColumnRenamed("all", "tree"), tops, root.select("tree", empty.alias("path")))
    roots = upper.join(root.select("tree", F.col("digest").alias("root")), "tree")
    roots = stored(roots.select(F.col("lang").alias("tree"), F.col("digest").alias("subroot"), "path", "root"), "merkle-roots")

    found = with_paths(leaves, levels, roots.select("tree", "path"))
    ends = roots.select(F.col("tree").alias("of"), "subroot", "root")
    found = found.join(ends, F.col("tree").eqNullSafe(F.col("of")))
    return found.select("doc_id", F.col("digest").alias("leaf"), "low", "subroot", "root", "path", F.coalesce("altered", "digest").alias("seen"))


def proofs(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    found = manifest(docs)
    proof = _joined(F.transform("path", lambda step: F.concat(step["left"], step["right"])))
    found = found.select("doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), folded(F.col("seen"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
