"""Merkle manifest of a dataset: one tree per group of rows, one over the groups.

Rows are numbered from 0 in their group by ranges of (group, key, digest), so
that a group of any size is spread over all tasks. Every level is built by
sibling-shift self-joins: each node sends its digest to the computed index of
a sibling (index XOR 1 in a binary tree, else the slot moved on by 1, 2, ...
within the run of ``fanout`` slots), one equijoin on (group, index) per
shift; then the rows in slot zero, which hold the digests of their whole run,
emit the parents. A level is written to the shared folder and is a
``fanout``-th of the one below. A parent is the SHA-256 of its children's
lowercase hex digests, also where the last run holds a single node. Proofs
come down the levels again: a node's path is its siblings and then the path
of its parent, joined on the parent's index, so no join has a key that more
than ``fanout`` rows share.

Defined cases: null groups are one group, before all others; null keys come
first in their group; rows of one key are ordered by digest, and rows that
agree in both are interchangeable; a lone row is its group's subroot and a
lone group's subroot the root, with no step in the path; an empty table has
no rows and no root; null digests are refused by the digest's definition
(``record_digest`` is never null); other columns pass through, but those
named like a result are replaced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenlab.llm.shared import keep, parallelism

FANOUT = 3
_STEP = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256."""
    return F.sha2(text, 256)


def record_digest(*fields: Column) -> Column:
    """Digest of the fields in order: ``-`` for null, else byte count, colon, value."""
    def one(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(F.concat(*[one(c) for c in fields]))


def sibling(index: Column, shift: int, fanout: int) -> Column:
    """The index that a node's digest is sent to by the ``shift``-th join."""
    if fanout == 2:
        return index.bitwiseXOR(F.lit(1))
    slot = index % fanout
    return index - slot + (slot + shift) % fanout


def _numbered(leaves: DataFrame) -> DataFrame:
    """``leaves`` (group, key, digest, row) with tree (a long that ascends with
    the group), index and n (rows of the group); without group and key."""
    parts = parallelism(leaves.sparkSession)
    # equal rows are interchangeable: the salt only deals them to several ranges
    order = ["group", "key", "digest", "salt"]
    ranged = (leaves.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
              .sortWithinPartitions(*order).drop("salt", "key"))
    placed = keep(ranged.withColumn("place", F.monotonically_increasing_id()), "manifest-rows")
    # one row per group and range: the places of a group in a range are gapless
    spans = (placed.groupBy("group", F.shiftright("place", 33).alias("range"))
             .agg(F.min("place").alias("start"), F.count("*").alias("rows")))
    whole, before = Window.partitionBy("group"), Window.partitionBy("group").orderBy("range")
    spans = keep(spans.select("group", "range", "start",
                              F.coalesce(F.sum("rows").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                              F.sum("rows").over(whole).alias("n"), F.min("start").over(whole).alias("tree")), "manifest-spans")
    held = spans.select(F.col("group").alias("own"), "range", "start", "before", "n", "tree")
    same = F.col("group").eqNullSafe(F.col("own")) & (F.shiftright("place", 33) == F.col("range"))
    return placed.join(held, same).select(
        "tree", (F.col("place") - F.col("start") + F.col("before")).alias("index"), "n", "digest", "row")


def _level(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` (tree, index, n, digest, ...) with left and right: the digests
    of their siblings before and after them, concatenated."""
    found = nodes
    for shift in range(1, fanout):
        sent = nodes.select("tree", sibling(F.col("index"), shift, fanout).alias("index"), F.col("digest").alias(f"s{shift}"))
        found = found.join(sent, ["tree", "index"], "left")
    slot = F.col("index") % fanout
    # the shift-th join brings the digest of slot (own - shift) mod fanout
    by_slot = [[F.when(slot == (k + shift) % fanout, F.col(f"s{shift}")) for shift in range(1, fanout)] for k in range(fanout)]
    at = [F.coalesce(*choices, F.lit("")) for choices in by_slot]
    left = F.concat(*[F.when(slot > k, at[k]).otherwise("") for k in range(fanout)])
    right = F.concat(*[F.when(slot < k, at[k]).otherwise("") for k in range(fanout)])
    return found.withColumns({"left": left, "right": right}).drop(*[f"s{shift}" for shift in range(1, fanout)])


def _parents(level: DataFrame, fanout: int) -> DataFrame:
    whole = digest(F.concat("digest", "right"))
    return level.where(F.col("index") % fanout == 0).select(
        "tree", F.floor(F.col("index") / fanout).cast("long").alias("index"), F.ceil(F.col("n") / fanout).cast("long").alias("n"),
        whole.alias("digest"))


def build(nodes: DataFrame, fanout: int = FANOUT) -> tuple[list[DataFrame], list[DataFrame]]:
    """The levels of the trees over ``nodes`` (tree, index, n, digest, ...),
    leaves first: nodes that have a parent, with left and right, and the
    trees' roots that lie on that level (tree, digest, ...)."""
    levels, roots = [], []
    most = nodes.agg(F.max("n")).first()[0]
    while True:
        roots.append(nodes.where("n = 1"))
        if most is None or most <= 1:
            return levels, roots
        levels.append(keep(_level(nodes.where("n > 1"), fanout), "manifest-level"))
        nodes, most = _parents(levels[-1], fanout), -(-most // fanout)


def _paths(levels: list[DataFrame], roots: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """The leaves with path and subroot; ``tops`` (tree, path, subroot) are those of the roots."""
    def ends(level: int) -> DataFrame:
        return roots[level].join(tops, "tree")

    wanted = ["tree", "index", "path", "subroot"]
    found = ends(len(levels))
    for k in range(len(levels) - 1, -1, -1):
        above = found.select("tree", F.col("index").alias("parent"), F.col("path").alias("up"), "subroot")
        inner = levels[k].withColumn("parent", F.floor(F.col("index") / fanout).cast("long")).join(above, ["tree", "parent"])
        inner = inner.withColumn("path", F.concat(F.array(F.struct("left", "right")), "up"))
        columns = wanted if k else [*wanted, "digest", "row"]
        found = inner.select(*columns).unionByName(ends(k).select(*columns))
    return found


def manifest(rows: DataFrame, group: str, key: str, leaf: str, fanout: int = FANOUT) -> tuple[DataFrame, str | None]:
    """``rows`` with subroot and path, and the root. ``leaf`` names the column
    with a row's digest; path is an array of (left, right), from the leaf's
    run up to the root's."""
    names = [c for c in rows.columns if c not in ("subroot", "path")]
    leaves = rows.select(F.col(f"`{group}`").alias("group"), F.col(f"`{key}`").alias("key"), F.col(f"`{leaf}`").alias("digest"),
                         F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    nodes = keep(_numbered(leaves), "manifest-leaves")
    levels, roots = build(nodes, fanout)
    subroots = roots[0].select("tree", "digest")
    for more in roots[1:]:
        subroots = subroots.unionByName(more.select("tree", "digest"))
    subroots = subroots.select(F.lit(None).cast("string").alias("group"), F.col("tree").alias("key"), "digest", F.struct("tree").alias("row"))
    groups = keep(_numbered(subroots), "manifest-groups")
    upper, top = build(groups, fanout)
    root = top[-1].select("digest").first()
    only = F.array().cast(_STEP)
    tops = top[-1].select("tree", only.alias("path"), F.col("digest").alias("subroot"))
    over = _paths(upper, top, tops, fanout)
    if not upper:  # no group or a single one: its subroot is the root
        over = groups.withColumns({"path": only, "subroot": F.col("digest")})
    over = keep(over.select("row.tree", "path", F.col("digest").alias("subroot")), "manifest-groups")
    found = _paths(levels, roots, over, fanout) if levels else nodes.join(over, "tree")
    return found.select(*[F.col("row")[c].alias(c) for c in names], "subroot", "path"), root and root[0]


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on the way to the root, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda acc, s: digest(F.concat(s["left"], acc, s["right"])))
