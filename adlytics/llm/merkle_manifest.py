"""A Merkle manifest of a dataset: subtrees by superblock, proofs by cogrouped exchange.

Every row is a leaf, the digest of its fields. The leaves of a tree (one per value of the
tree column) ascend by key; a node is the digest of two neighbours, the last one of a level
of itself alone where it has no neighbour. The trees' roots, in the order of their values,
are the leaves of one more tree, whose root names the dataset.

A superblock is ``2 ** height`` neighbouring nodes of a tree. Upwards, each superblock is
reduced to its top; the tops are the nodes of the next tier, until each tree is one node.
Downwards, the nodes of a tier and the outer nodes that the proofs of their superblock need
(one row per superblock: the path from its top to the root) are cogrouped by superblock.
There the local levels are reduced once more, each node's local siblings are joined with
the outer path to its whole proof, and, for the leaves, a second digest is folded along it.
So no task holds more than a superblock and one path, whatever a tree holds, and no tree,
level or proof passes through the driver.

Leaves are placed by ``numbered``: equal leading keys spread over range partitions, so a
tree with a third of all rows is as even as any other.

Defined results: a NULL field is ``-`` in a leaf, a NULL tree value is a tree of its own
and comes first, NULL keys come first in a tree. Rows with equal keys are ordered by their
digest; equal rows are leaves of their own, next to each other. A dataset of one row has
its leaf for subroot and root, and an empty proof. Any text length; an empty table gives no
rows. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import checkpointed, numbered, stored

#: Levels of a superblock, if no other number is asked for.
HEIGHT = 10
#: A step of a proof is a side and a digest: the sibling stands left or right, or is missing.
LEFT, RIGHT, ALONE = "L", "R", "-"
STEP = 65

NODE = ("tree", "nodes", "place", "digest")
NODES = "tree bigint, nodes bigint, place bigint, digest string"
PATHS = "tree bigint, place bigint, path string"
PROOFS = "label string, leaf string, subroot string, proof_sha256 string, folded_root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of fields: each its UTF-8 length, a colon and its value, or ``-`` for NULL."""
    parts = []
    for field in fields:
        text = field.cast("string")
        known = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(known, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def local_levels(nodes: int, height: int) -> int:
    """Levels a tier of ``nodes`` nodes is reduced by inside its superblocks."""
    return min(height, (nodes - 1).bit_length())


def reduce_block(digests: list[str], levels: int) -> tuple[str, list[str]]:
    """The top of neighbouring nodes and the local path of each of them."""
    paths = [[] for _ in digests]
    below = [[i] for i in range(len(digests))]
    for _ in range(levels):
        above, members = [], []
        for i in range(0, len(digests), 2):
            pair = digests[i : i + 2]
            for at in below[i]:
                paths[at].append(RIGHT + pair[1] if len(pair) == 2 else ALONE.ljust(STEP))
            if len(pair) == 2:
                for at in below[i + 1]:
                    paths[at].append(LEFT + pair[0])
                members.append(below[i] + below[i + 1])
            else:
                members.append(below[i])
            above.append(digest("".join(pair)))
        digests, below = above, members
    return digests[0], ["".join(path) for path in paths]


def fold(leaf: str, path: str) -> str:
    """The root that a leaf and the siblings on its path give."""
    for at in range(0, len(path), STEP):
        side, sibling = path[at], path[at + 1 : at + STEP]
        leaf = digest(sibling + leaf if side == LEFT else leaf + sibling if side == RIGHT else leaf)
    return leaf


def proof_digest(path: str) -> str:
    """Digest of the siblings of a path, from the leaf to the root."""
    steps = (path[at : at + STEP] for at in range(0, len(path), STEP))
    return digest("".join(step[1:] for step in steps if step[0] != ALONE))


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("place", height))


def _tops(nodes: DataFrame, height: int) -> DataFrame:
    """The next tier: each superblock's top, with the number of tops of its tree."""

    def top(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        nodes = int(pdf["nodes"].iloc[0])
        found, _ = reduce_block(pdf["digest"].tolist(), local_levels(nodes, height))
        return pd.DataFrame(
            {
                "tree": [pdf["tree"].iloc[0]],
                "nodes": [-(-nodes >> height)],
                "place": [pdf["block"].iloc[0]],
                "digest": [found],
            }
        )

    return checkpointed(_blocks(nodes, height).groupBy("tree", "block").applyInPandas(top, NODES))


def _outer(paths: DataFrame) -> DataFrame:
    """Paths of a tier's nodes as outer paths of the superblocks below them."""
    return paths.select("tree", F.col("place").alias("block"), "path")


def _sorted_paths(
    nodes: pd.DataFrame, outer: pd.DataFrame, height: int
) -> tuple[pd.DataFrame, list[str]]:
    nodes = nodes.sort_values("place")
    levels = local_levels(int(nodes["nodes"].iloc[0]), height)
    _, local = reduce_block(nodes["digest"].tolist(), levels)
    return nodes, [path + outer["path"].iloc[0] for path in local]


def _node_paths(nodes: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """The path from every node of a tier to the root of all."""

    def exchange(own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        own, paths = _sorted_paths(own, above, height)
        return pd.DataFrame({"tree": own["tree"], "place": own["place"], "path": paths})

    return checkpointed(_cogrouped(_blocks(nodes, height), outer).applyInPandas(exchange, PATHS))


def _cogrouped(nodes: DataFrame, outer: DataFrame):
    return nodes.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))


def _leaf_proofs(leaves: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """Digest of each leaf's proof, and the root its ``seen`` digest folds to."""

    def exchange(own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        own, paths = _sorted_paths(own, above, height)
        seen = own["seen"].where(own["seen"].notna(), own["digest"])
        return pd.DataFrame(
            {
                "label": own["label"],
                "leaf": own["digest"],
                "subroot": above["subroot"].iloc[0],
                "proof_sha256": [proof_digest(path) for path in paths],
                "folded_root": [fold(leaf, path) for leaf, path in zip(seen, paths)],
            }
        )

    return _cogrouped(_blocks(leaves, height), outer).applyInPandas(exchange, PROOFS)


def _tiers(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The tiers of trees from ``nodes`` up, to the one where each tree is one node."""
    tiers = [nodes]
    while (most := tiers[-1].agg(F.max("nodes")).first()[0]) is not None and most > 1:
        tiers.append(_tops(tiers[-1], height))
    return tiers


def manifest(
    rows: DataFrame,
    key: str,
    tree: str,
    fields: Sequence[str],
    seen: dict[str, Column] | None = None,
    suspect: Column | None = None,
    height: int = HEIGHT,
) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``seen`` replaces fields, for the rows where ``suspect`` holds, by what someone else has
    of them (columns over ``rows``); ``folded_root`` is the root that follows from the leaf
    so seen and the siblings of the proof, ``verified`` whether it is the root.
    """
    leaf = leaf_digest([F.col(f) for f in fields])
    other = F.lit(None).cast("string")
    if suspect is not None:
        changed = leaf_digest([(seen or {}).get(f, F.col(f)) for f in fields])
        other = F.when(suspect, changed)
    # Stored first: the ranges are found in one more pass, which need not hash the texts.
    leaves = stored(
        rows.select(
            F.col(key).alias("key"),
            F.col(tree).cast("string").alias("value"),
            leaf.alias("digest"),
            other.alias("seen"),
        )
    )
    order = [F.asc_nulls_first("value"), F.asc_nulls_first("key"), F.asc("digest")]
    placed = numbered(leaves, order, "number")
    # A tree is named by its first place: known for NULL too, and ascending with the value.
    trees = checkpointed(
        placed.groupBy("value").agg(F.min("number").alias("tree"), F.count("*").alias("nodes"))
    )
    own_tree = F.col("value").eqNullSafe(F.col("of"))
    leaves = stored(
        placed.join(trees.withColumnRenamed("value", "of"), own_tree).select(
            # As text: pandas has no whole numbers beside missing ones.
            F.col("key").cast("string").alias("label"),
            "tree",
            "nodes",
            (F.col("number") - F.col("tree")).alias("place"),
            "digest",
            "seen",
        )
    )
    tiers = _tiers(leaves.select(*NODE), height)
    subroots = tiers[-1].select("tree", F.col("digest").alias("subroot"))
    numbers = numbered(subroots, [F.asc("tree")], "place")
    crown = checkpointed(
        numbers.select(
            F.lit(0).cast("bigint").alias("tree"),
            F.lit(trees.count()).cast("bigint").alias("nodes"),
            "place",
            F.col("subroot").alias("digest"),
            F.col("tree").alias("of"),
        )
    )
    above = _tiers(crown.select(*NODE), height)
    top = above[-1].first()
    root = F.lit(top["digest"] if top else None).cast("string")

    # Downwards: the paths of a tier's nodes are the outer paths of the tier below.
    outer = above[-1].select("tree", F.col("place").alias("block"), F.lit("").alias("path"))
    for tier in reversed(above[:-1]):
        outer = _outer(_node_paths(tier, outer, height))
    outer = crown.join(outer.select("block", "path"), F.col("place") == F.col("block")).select(
        F.col("of").alias("tree"), F.lit(0).cast("bigint").alias("block"), "path"
    )
    for tier in reversed(tiers[1:-1]):
        outer = _outer(_node_paths(tier, outer, height))
    proofs = _leaf_proofs(leaves, outer.join(subroots, "tree"), height)
    return proofs.select(
        F.col("label").cast(rows.schema[key].dataType).alias(key),
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
