"""Merkle manifest of a dataset: one digest for all rows, and for each row a proof that it is among them.

A row's leaf is the digest of its encoded columns. Per group (a language) leaves stand in order of their ids; runs of
`FANOUT` neighbours become one parent until one node, the subroot, is left, and the subroots, in order of their groups,
become one root the same way. Every node carries the interval of leaf ranks that it covers, so a tree is a set of nested
intervals: a node joins its parent by bucket of the parent's level and containment, and what is left of the parent's
interval without the node's own are its siblings. Ancestors are attached from the top: each level hands its path on to
the level under it, so a leaf meets only its parent.

No step holds a whole group: ranks come from ranges of rows and the sizes of the ranges before them, a parent collects at
most `FANOUT` nodes, and rows that are equal in everything are spread by a number of their own.

Defined cases: null columns are encoded as `-`; null ids stand before all others, a null group before all other groups;
rows with one id stand in order of their leaves, so equal rows may change places without any digest changing; a group of
one row has its leaf as subroot, one group's subroot is the root; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runsift.llm.common import ascii_lower
from runsift.session import broadcast_if_small, written

FANOUT = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = "string"
CHILDREN = "array<struct<lo:bigint,hi:bigint,digest:string>>"
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(changed: dict[str, Column] | None = None) -> Column:
    """Digest of a row's columns, some of them replaced."""
    return digest(*[encoded((changed or {}).get(c, F.col(c))) for c in COLUMNS])


def group_key(group: Column) -> Column:
    """A name that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("+"), group), F.lit(""))


def ranked(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """Add rank (from 0 within grp) and n (rows of grp). `order` begins with grp.

    Rows are dealt out by ranges of the whole order. A row's rank is its place in its range, less the place of the first
    row of its group there, plus the rows of its group in the ranges before.
    """
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    slices = written(spread.withColumn("slice", F.spark_partition_id()).withColumn("place", place), f"{label}-slices")
    by_group = Window.partitionBy("grp")
    before = by_group.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per group and range, not per row.
    sizes = (
        slices.groupBy("grp", "slice")
        .agg(F.count(F.lit(1)).alias("size"), F.min("place").alias("first"))
        .select(
            "grp",
            "slice",
            (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("size").over(by_group).alias("n"),
        )
    )
    return (
        slices.join(broadcast_if_small(sizes), ["grp", "slice"])
        .withColumn("rank", F.col("place") + F.col("shift"))
        .drop("slice", "place", "shift")
    )


def _bucket(level: int) -> Column:
    """Which node of a level covers an interval."""
    return F.floor(F.col("lo") / F.lit(FANOUT**level))


def levels(leaves: DataFrame, label: str) -> list[DataFrame]:
    """Tables of nodes (grp, n, lo, hi, digest, children), leaves first; a group ends at the level where it has one node.

    `leaves` is a written table with grp, n, rank and digest.
    """
    nodes = leaves.select(
        "grp",
        "n",
        F.col("rank").alias("lo"),
        (F.col("rank") + 1).alias("hi"),
        "digest",
        F.array().cast(CHILDREN).alias("children"),
    )
    out, largest = [nodes], leaves.agg(F.max("n")).first()[0] or 0
    while FANOUT ** (len(out) - 1) < largest:
        level = len(out)
        parents = (
            out[-1]
            .where(F.col("n") > FANOUT ** (level - 1))
            .groupBy("grp", "n", _bucket(level).alias("bucket"))
            .agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"))
            .select(
                "grp",
                "n",
                F.array_min("children.lo").alias("lo"),
                F.array_max("children.hi").alias("hi"),
                digest(F.array_join("children.digest", "")).alias("digest"),
                "children",
            )
        )
        out.append(written(parents, f"{label}-level{level}"))
    return out


def _beside(children: Column, lo: Column, hi: Column) -> Column:
    """Digests of the siblings: the parent's interval without the node's own, cut into what is left and right of it."""

    def joined(kept: Column) -> Column:
        return F.array_join(F.transform(kept, lambda c: c["digest"]), "")

    return F.struct(
        joined(F.filter(children, lambda c: c["hi"] <= lo)).alias("left"),
        joined(F.filter(children, lambda c: c["lo"] >= hi)).alias("right"),
    )


def with_paths(tree: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves (grp, lo, path, top, root): siblings from the leaf up, the digest of the group's last node, the root.

    `above` is (grp, tail, root): what follows a group's own path.
    """
    labelled = None
    for level in range(len(tree) - 1, -1, -1):
        nodes = tree[level]
        last = nodes.where(F.col("n") <= FANOUT**level).join(above, "grp")
        parts = [
            last.select("grp", "lo", "hi", "children", F.col("tail").alias("path"), F.col("digest").alias("top"), "root")
        ]
        if labelled is not None:
            # Containment within a bucket of the parents' level.
            parents = labelled.select(
                F.col("grp").alias("p_grp"),
                _bucket(level + 1).alias("p_bucket"),
                F.col("lo").alias("p_lo"),
                F.col("hi").alias("p_hi"),
                F.col("children").alias("p_children"),
                F.col("path").alias("p_path"),
                "top",
                "root",
            )
            inside = nodes.where(F.col("n") > FANOUT**level).join(
                parents,
                (F.col("grp") == F.col("p_grp"))
                & (_bucket(level + 1) == F.col("p_bucket"))
                & (F.col("p_lo") <= F.col("lo"))
                & (F.col("hi") <= F.col("p_hi")),
            )
            beside = _beside(F.col("p_children"), F.col("lo"), F.col("hi"))
            path = F.concat(F.array(beside), F.col("p_path")).alias("path")
            parts.append(inside.select("grp", "lo", "hi", "children", path, "top", "root"))
        labelled = reduce(DataFrame.unionByName, parts)
    return labelled.select("grp", "lo", "path", "top", "root")


def group_paths(tree: list[DataFrame], label: str) -> DataFrame:
    """(grp, tail, root): the way from each group's subroot to the root."""
    subroots = reduce(
        DataFrame.unionByName,
        [
            nodes.where((F.col("n") <= FANOUT**k) & (F.col("n") > (FANOUT ** (k - 1) if k else 0))).select("grp", "digest")
            for k, nodes in enumerate(tree)
        ],
    )
    named = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    leaves = written(ranked(named, ["grp", "name"], f"{label}-groups"), f"{label}-groups")
    above = leaves.select("grp").distinct().select(
        "grp", F.array().cast(PATH).alias("tail"), F.lit(None).cast(DIGEST).alias("root")
    )
    paths = with_paths(levels(leaves, f"{label}-groups"), above)
    placed = leaves.select("name", F.col("rank").alias("lo")).join(paths, "lo")
    return placed.select(F.col("name").alias("grp"), F.col("path").alias("tail"), F.col("top").alias("root"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(path, leaf, lambda under, s: digest(s["left"], under, s["right"]))


def proofs(docs: DataFrame, seen: Column | None = None, label: str = "merkle") -> DataFrame:
    """(doc_id, leaf, seen_leaf, path, subroot, root): every row's leaf and its way to the root.

    `seen` is the leaf of the row as a reader found it, by default the leaf itself.
    """
    leaf = leaf_digest()
    rows = docs.select(
        group_key(F.col("lang")).alias("grp"),
        "doc_id",
        leaf.alias("digest"),
        (leaf if seen is None else seen).alias("seen_leaf"),
        # Equal rows are told apart by where they stand, so that any number of them can be spread.
        F.xxhash64(F.monotonically_increasing_id()).alias("place_hash"),
    )
    order = ["grp", "doc_id", "digest", "place_hash"]
    leaves = written(ranked(written(rows, f"{label}-rows"), order, label), f"{label}-leaves")
    tree = levels(leaves, label)
    above = written(group_paths(tree, label), f"{label}-tails")
    paths = with_paths(tree, above).withColumnRenamed("lo", "rank")
    return leaves.join(paths, ["grp", "rank"]).select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "seen_leaf",
        "path",
        F.col("top").alias("subroot"),
        "root",
    )


def verified(proven: DataFrame) -> DataFrame:
    """Proofs as digests, and whether the leaf as it was seen still gives the root."""
    beside = F.transform("path", lambda s: F.concat(s["left"], s["right"]))
    rows = proven.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join(beside, ""), 256).alias("proof_sha256"),
        folded(F.col("seen_leaf"), F.col("path")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered_leaf() -> Column:
    """Leaf of a row whose text lost its capitals A-Z, for every third id by crc32; else the row's own leaf."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    return F.when(chosen, leaf_digest({"text": ascii_lower(F.col("text"))})).otherwise(leaf_digest())


def manifest(docs: DataFrame) -> DataFrame:
    """Every row's place in the manifest, checked against rows of which a third were tampered with."""
    return verified(proofs(docs, tampered_leaf()))
