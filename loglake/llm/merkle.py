"""Merkle manifest of a document collection: one tree for each source, and one over their roots.

Only every few levels are stored, one row for each aligned subtree of the level below. A proof goes
from the top down: the missing interior nodes of a subtree are hashed again from its stored
descendants, give the siblings of its nodes, and are not kept. What a subtree's nodes share of a
proof, the levels above, is worked out once for all of them.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.llm.common import stored

#: The fields of a leaf, in order, and nodes hashed into one.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16
#: Levels from one stored level to the next.
EVERY = 2

#: ``monotonically_increasing_id`` keeps the place within the partition in the lower bits.
PLACE_BITS = 33


class Manifest(NamedTuple):
    """Stored levels, lowest first: rows ``tree, block, n, nodes`` of one aligned subtree each.

    ``n`` counts the nodes of the tree on that level. ``trees`` has a tree for each source, its leaves
    with their ``doc_id`` and carried columns; ``top`` has the tree 0 over their roots. ``sources``
    names the trees: ``tree, source, n_leaves``. ``roots`` holds ``tree, root`` of ``top``, one row,
    and none for an empty table.
    """

    trees: list[DataFrame]
    top: list[DataFrame]
    sources: DataFrame
    roots: DataFrame
    every: int


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The digest of a row of documents, some of its fields ``changed``."""
    return F.sha2(F.concat(*[_field(changed.get(name, F.col(name))) for name in FIELDS]), 256)


def _ceil(n: Column, parts: int) -> Column:
    return F.floor((n + parts - 1) / F.lit(parts)).cast("long")


def _place(i: Column, parts: int) -> Column:
    return F.shiftright(i, parts.bit_length() - 1)


def _hash_runs(level: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda r: F.sha2(F.array_join(F.slice(level, r * FANOUT + 1, FANOUT), ""), 256))


def _with_levels(blocks: DataFrame, every: int) -> DataFrame:
    """Each subtree with its levels ``up0`` (the stored nodes) to its top ``up<every>``, hashed anew."""
    rows = blocks.withColumn("up0", F.col("nodes.digest"))
    for k in range(every):
        alone = _ceil(F.col("n"), FANOUT ** k) == 1
        rows = rows.withColumn(f"up{k + 1}", F.when(alone, F.col(f"up{k}")).otherwise(_hash_runs(F.col(f"up{k}"))))
    return rows


def _grow(blocks: DataFrame, largest: int, label: str, every: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels above and with ``blocks``, and the root of each tree."""
    span = FANOUT ** every
    levels, roots = [stored(blocks, f"{label}-0")], []
    while True:
        tops = _with_levels(levels[-1], every).select("tree", "block", "n", F.col(f"up{every}")[0].alias("digest"))
        roots.append(tops.filter(F.col("n") <= span).select("tree", F.col("digest").alias("root")))
        if largest <= span:
            return levels, reduce(DataFrame.unionByName, roots)
        nodes = tops.filter(F.col("n") > span).select(
            "tree", F.col("block").alias("at"), _ceil(F.col("n"), span).alias("n"), "digest")
        levels.append(stored(_in_blocks(nodes, span), f"{label}-{len(levels)}"))
        largest = -(-largest // span)


def _in_blocks(nodes: DataFrame, span: int) -> DataFrame:
    """Nodes ``tree, at, n, digest, ...`` as rows of aligned subtrees."""
    others = [c for c in nodes.columns if c not in ("tree", "at", "n")]
    return nodes.groupBy("tree", _place(F.col("at"), span).alias("block"), "n").agg(
        F.sort_array(F.collect_list(F.struct("at", *others))).alias("nodes"))


def _part(row: Column) -> Column:
    return F.shiftright(row, PLACE_BITS)


def _numbered(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves with ``tree, at, n``, and ``tree, source, n_leaves`` of the sources.

    The leaves are sorted by range and stored; partitions are then counted, and a leaf's number is
    its place in the partition's part of the source, moved up by the parts before.
    """
    ordered = leaves.withColumn("salt", F.rand(1)).repartitionByRange("source", "doc_id", "digest", "salt").sortWithinPartitions(
        "source", "doc_id", "digest").drop("salt").withColumn("row", F.monotonically_increasing_id())
    ordered = stored(ordered, "leaves").withColumn("part", _part(F.col("row")))
    parts = stored(ordered.groupBy("source", "part").agg(F.min("row").alias("first"), F.count("*").alias("held")), "parts")
    sources = parts.groupBy("source").agg(F.min("first").alias("first"), F.sum("held").alias("n_leaves"))
    sources = sources.withColumn("part", _part(F.col("first")))
    # One row for each partition, whose number the session bounds.
    before = sources.groupBy("part").agg(F.count("*").alias("held")).withColumn(
        "before", F.sum("held").over(Window.orderBy("part")) - F.col("held"))
    sources = stored(sources.join(before.select("part", "before"), "part").select(
        "source", "n_leaves", (F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy("first")) - 1).alias("tree")),
        "sources")
    own = parts.withColumn("before", F.sum("held").over(Window.partitionBy("source").orderBy("part")) - F.col("held"))
    own = own.alias("p").join(sources.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source"))).select(
        F.col("p.source").alias("of_source"), F.col("part").alias("of_part"), "first", "before", "tree", F.col("n_leaves").alias("n"))
    numbered = ordered.join(own, (F.col("part") == F.col("of_part")) & F.col("source").eqNullSafe(F.col("of_source")))
    numbered = numbered.withColumn("at", F.col("before") + F.col("row") - F.col("first"))
    return numbered.drop("row", "part", "of_source", "of_part", "first", "before"), sources


def build(documents: DataFrame, carried: Mapping[str, Column] | None = None, every: int = EVERY) -> Manifest:
    """The manifest of ``documents`` (``FIELDS``); ``carried`` are small columns kept beside each leaf.

    A leaf is the SHA-256 of its fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its
    value. Leaves of a source (null is one of its own, the first) ascend by ``doc_id``, null first, then
    by digest; equal rows are leaves of their own. Every 16 nodes in turn are hashed into one until one
    remains. Texts of any length are hashed whole. Other columns are ignored, whatever their names.
    """
    span = FANOUT ** every
    extra = dict(carried or {})
    rows = documents.select(*FIELDS).select(
        F.col("source").cast("string").alias("source"), "doc_id", leaf().alias("digest"), *[c.alias(f"c_{k}") for k, c in extra.items()])
    numbered, sources = _numbered(rows)
    n_sources, largest = sources.agg(F.count("*"), F.max("n_leaves")).first()
    kept = numbered.select("tree", "at", "n", "digest", "doc_id", *[f"c_{k}" for k in extra])
    trees, subroots = _grow(_in_blocks(kept, span), largest or 0, "trees", every)
    over = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"),
                           F.lit(n_sources).cast("long").alias("n"), F.col("root").alias("digest"))
    top, roots = _grow(_in_blocks(over, span), n_sources, "top", every)
    return Manifest(trees, top, sources, roots, every)


def _siblings(at: Column, level: Column, k: int) -> Column:
    """What stands left and right of a node's ancestor on level ``k`` of its subtree, within the run of 16."""
    own = _place(at, FANOUT ** k)
    first = own - own % FANOUT
    return F.struct(
        F.array_join(F.slice(level, first + 1, own - first), "").alias("left"),
        F.array_join(F.slice(level, own + 2, first + (FANOUT - 1) - own), "").alias("right"))


def _descend(blocks: DataFrame, whole: DataFrame, above: DataFrame | None, every: int) -> DataFrame:
    """Nodes of a stored level with their ``siblings`` up to the root.

    ``whole`` (``tree, rest, ...``) gives what follows above a tree's root, ``above`` (``tree, at, rest,
    ...``) what follows above the top of a subtree that is not alone in its tree.
    """
    span = FANOUT ** every
    joined = blocks.filter(F.col("n") <= span).join(whole, "tree")
    if above is not None:
        joined = joined.unionByName(blocks.filter(F.col("n") > span).join(above.withColumnRenamed("at", "block"), ["tree", "block"]))
    rows = _with_levels(joined, every)
    nothing = F.array().cast("array<struct<left:string,right:string>>")

    def of(node: Column, i: Column) -> Column:
        steps = [F.when(_ceil(F.col("n"), FANOUT ** k) > 1, F.array(_siblings(i, F.col(f"up{k}"), k))).otherwise(nothing)
                 for k in range(every)]
        return F.struct(node.alias("node"), F.concat(*steps, F.col("rest")).alias("siblings"))

    others = [c for c in whole.columns if c not in ("tree", "rest")]
    return rows.select("tree", *others, F.explode(F.transform("nodes", of)).alias("p")).select(
        "tree", *others, "p.node", "p.siblings")


def prove(manifest: Manifest) -> DataFrame:
    """``doc_id, leaf, siblings, subroot, root`` and the carried columns of every leaf.

    ``siblings`` are, level by level from the leaf up to the root, the digests left and right of the
    node on the way within its run of 16, joined; both empty where a run has one node.
    """
    rest = F.array().cast("array<struct<left:string,right:string>>").alias("rest")
    whole, above = manifest.roots.select("tree", rest, "root"), None
    for blocks in reversed(manifest.top):
        found = _descend(blocks, whole, above, manifest.every)
        above = found.select("tree", F.col("node.at").alias("at"), F.col("siblings").alias("rest"), "root")
    whole, above = found.select(F.col("node.at").alias("tree"), F.col("siblings").alias("rest"),
                                F.col("node.digest").alias("subroot"), "root"), None
    for blocks in reversed(manifest.trees):
        found = _descend(blocks, whole, above, manifest.every)
        above = found.select("tree", F.col("node.at").alias("at"), F.col("siblings").alias("rest"), "subroot", "root")
    names = found.schema["node"].dataType.names
    return found.select(
        "node.doc_id", F.col("node.digest").alias("leaf"), "siblings", "subroot", "root",
        *[F.col(f"node.{c}").alias(c[2:]) for c in names if c.startswith("c_")])


def proof_digest(siblings: Column) -> Column:
    """The SHA-256 of all sibling digests of a proof, in order."""
    return F.sha2(F.array_join(F.transform(siblings, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(digest: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(siblings, digest, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))
