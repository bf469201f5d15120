"""Merkle manifest of a table: a rollup of nested structs, with a proof for every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hailscope.llm.common import LOWER, UPPER, stage

#: Children of a node, and levels that are rolled up within one block of rows.
FAN_IN, DIGITS = 8, 3
BLOCK = FAN_IN**DIGITS
#: What a leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 3

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row number below


def leaf_hash(columns: Sequence[Column]) -> Column:
    """Lower-case hex SHA-256 over the columns: ``-`` for NULL, else ``<bytes>:<value>``."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, tree, leaf, forged, tie``: one row per document, without its text.

    ``forged`` is the leaf after tampering (A-Z of the text in lower case) where 3
    divides the crc32 of the id, and NULL elsewhere, also for a NULL id.
    """
    forged = [F.translate(c, UPPER, LOWER).alias(c) if c == "text" else F.col(c) for c in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    return docs.select(
        "doc_id",
        F.col("lang").alias("tree"),
        leaf_hash([F.col(c) for c in FIELDS]).alias("leaf"),
        F.when(hit, leaf_hash(forged)).alias("forged"),
        F.spark_partition_id().alias("tie"),
    )


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``place`` (from 0 within the ``tree``) and ``size`` (rows of the tree) *(action)*.

    Rows are sorted over ranges of (tree, order, tie), so that a tree of any size
    and rows that repeat are spread over tasks. Places are counted from a table with
    one row per range and one per tree.
    """
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order, "tie")]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mid = F.monotonically_increasing_id()
    numbered = stage(
        rows.repartitionByRange(n, *by)
        .sortWithinPartitions(*by)
        .withColumns({"part": F.shiftright(mid, _ROW_BITS), "row": mid.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}),
        "manifest-ranked",
    )
    whole = Window.partitionBy("tree")
    runs = numbered.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    runs = runs.select(
        F.col("tree").alias("run_tree"),
        F.col("part").alias("run_part"),
        (F.sum("n").over(whole.orderBy("part")) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(whole).alias("size"),
    )
    same = (F.col("part") == F.col("run_part")) & F.col("tree").eqNullSafe(F.col("run_tree"))
    placed = numbered.join(runs, same).withColumn("place", F.col("row") + F.col("shift"))
    return placed.select(*rows.columns, "place", "size")


def _active(level: int) -> Column:
    """Whether nodes of this level of the block still get a parent: more than one is left."""
    return F.col("size") > FAN_IN**level


def roll_up(nodes: DataFrame) -> DataFrame:
    """``tree, block, size, node, body``: each run of ``BLOCK`` nodes as one row of nested structs.

    ``nodes`` has ``tree, place, size, node, item``. The rank's digits are grouped
    away one by one, the last first; a group is one run of ``FAN_IN`` nodes at most,
    sorted by its digit, and becomes the body of its parent. All groupings follow one
    shuffle by block. Levels above the tree's top pass their only node on.
    """
    digits = [f"d{k}" for k in range(DIGITS)]
    place = F.col("place")
    rows = nodes.select(
        "tree",
        F.floor(place / BLOCK).alias("block"),
        "size",
        *(F.pmod(F.floor(place / FAN_IN**k), F.lit(FAN_IN)).cast("int").alias(d) for k, d in enumerate(digits)),
        "node",
        F.col("item").alias("body"),
    ).repartition("tree", "block")
    for k, digit in enumerate(digits):
        run = F.sort_array(F.collect_list(F.struct(digit, "node", "body"))).alias("body")
        rows = rows.groupBy("tree", "block", "size", *digits[k + 1 :]).agg(run)
        joined = F.array_join(F.col("body.node"), "")
        node = F.when(_active(k), F.sha2(joined, 256)).otherwise(joined)
        rows = rows.withColumn("node", node)
    return rows.select("tree", "block", "size", "node", "body")


def _paths(children: Column, level: int, above: Column) -> Column:
    """All items below ``children`` with their node and path: siblings left and right, from the item up."""
    nodes = F.transform(children, lambda c: c["node"])

    def below(child: Column, i: Column) -> Column:
        left = F.array_join(F.slice(nodes, F.lit(1), i), "")
        right = F.array_join(F.slice(nodes, i + 2, F.lit(FAN_IN)), "")
        own = F.filter(F.array(F.struct(left.alias("left"), right.alias("right"))), lambda _: _active(level))
        path = F.concat(own, above)
        if level:
            return _paths(child["body"], level - 1, path)
        return F.array(F.struct(child["body"].alias("item"), child["node"].alias("node"), path.alias("path")))

    return F.flatten(F.transform(children, below))


def _descend(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """``tree, item, node, path, subroot, root`` of all nodes in ``blocks``.

    ``above`` has ``tree, block, path, subroot, root``, one row per block. The two
    meet by a union and a grouping, and each block then unfolds on its own.
    """
    inside = F.struct("size", "body")
    upper = F.struct("path", "subroot", "root")
    kinds = {"inside": blocks.select(inside.alias("x")).schema["x"].dataType}
    kinds["upper"] = above.select(upper.alias("x")).schema["x"].dataType
    both = blocks.select("tree", "block", inside.alias("inside"), F.lit(None).cast(kinds["upper"]).alias("upper"))
    both = both.unionByName(
        above.select("tree", "block", F.lit(None).cast(kinds["inside"]).alias("inside"), upper.alias("upper"))
    )
    met = both.groupBy("tree", "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in kinds))
    met = met.select("tree", "inside.*", "upper.*")
    found = F.explode(_paths(F.col("body"), DIGITS - 1, F.col("path"))).alias("found")
    return met.select("tree", "subroot", "root", found).select("tree", "subroot", "root", "found.*")


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of each round, until every tree is one block *(action)*."""
    most = nodes.agg(F.max("size")).first()[0] or 1
    out = []
    while True:
        out.append(stage(roll_up(nodes), "manifest-blocks"))
        most = -(-most // BLOCK)
        if most <= 1:
            return out
        size = F.ceil(F.col("size") / BLOCK).alias("size")
        item = F.struct(F.col("block").alias("block")).alias("item")
        nodes = out[-1].select("tree", F.col("block").alias("place"), size, "node", item)


def _unfold(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Paths of the first round's items, from those above the last round's blocks."""
    for blocks in reversed(rounds[1:]):
        found = _descend(blocks, above)
        above = found.select("tree", F.col("item.block").alias("block"), "path", "subroot", "root")
    return _descend(rounds[0], above)


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, forged, subroot, root, path`` of every row *(action)*.

    A tree for each ``lang`` and one over their roots. Leaves of a language ascend by
    ``doc_id``; every ``FAN_IN`` consecutive nodes get a parent until one is left.
    ``path`` lists the siblings left and right of the way from the leaf through the
    ``subroot`` to the ``root``, one entry per level, and is the row's proof: see
    :func:`fold`. ``forged`` is another leaf, to test the proof, where there is one.

    Texts are hashed where they are read and never shuffled. A rank over the whole
    table gives each leaf its place; its digits are grouped away within blocks of
    ``BLOCK`` leaves, whose roots are the nodes of the next round. So no row, group
    or task holds more than a block, whatever the size of a language, and rounds grow
    with the logarithm. On the way back each block unfolds into proofs by ``transform``
    and ``explode``, without a join.

    A NULL language is a tree of its own, the first. NULL ids come first in their
    tree. Rows of one id are ordered by their leaf, and rows that repeat are leaves
    of their own. Empty and NULL texts differ. An empty table gives no rows. Columns
    other than ``FIELDS`` are not read.
    """
    placed = ranked(stage(leaves(docs), "manifest-leaves"), ["doc_id", "leaf"])
    item = F.struct("doc_id", "forged").alias("item")
    trees = _rounds(placed.select("tree", "place", "size", F.col("leaf").alias("node"), item))

    tops = trees[-1].select(F.lit(0).alias("tree"), F.col("tree").alias("lang"), "node", F.lit(0).alias("tie"))
    tops = ranked(tops, ["lang"])
    over = _rounds(tops.select("tree", "place", "size", "node", F.struct("lang").alias("item")))
    empty = F.array().cast("array<struct<left:string,right:string>>").alias("path")
    none = F.lit(None).cast("string").alias("subroot")
    seed = over[-1].select("tree", "block", empty, none, F.col("node").alias("root"))
    heads = _unfold(over, seed).select(
        F.col("item.lang").alias("tree"), F.lit(0).cast("long").alias("block"), "path", F.col("node").alias("subroot"), "root"
    )
    found = _unfold(trees, heads)
    return found.select(
        F.col("item.doc_id").alias("doc_id"), F.col("node").alias("leaf"), F.col("item.forged").alias("forged"), "subroot", "root", "path"
    )


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def siblings(path: Column) -> Column:
    """All sibling digests of a path as one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")
