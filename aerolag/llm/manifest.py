"""Merkle manifest of a table: a leaf per row, a tree of digests per group, one root, proofs by pointer jumping.

Trees grow level by level: every ``WIDTH`` consecutive nodes become the digest of their digests in hex. Each
node points at its parent and holds the siblings of that step. Then the nodes join themselves: what an
ancestor points at becomes the node's ancestor and the ancestor's siblings follow the node's own, so every
join doubles the distance, until all leaves reach the root.

Nodes are named (tree, level, place). Groups number their trees in ascending order; the tree above them,
``TOP``, has the root of a group in the place of its number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.llm.tables import ranked, small_side
from aerolag.storage import stage

WIDTH = 3
TOP = -1
#: Pointers that have reached the root lead into this tree, each to a place of its own, so that they meet nowhere.
ARRIVED = -2
#: Rows of a group that share a join key with what is known of the group.
STRETCH = 65_536
#: Bytes of a pointer without its siblings, and of the siblings of one step, when broadcasts are measured.
POINTER_BYTES, STEP_BYTES = 128, 128

_NAME = ["tree", "level", "place"]


def encoded(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(*values: Column) -> Column:
    """The digest of a row's values, in binary."""
    return F.unhex(F.sha2(F.concat(*[encoded(value) for value in values]), 256))


def hex_digest(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _digest_of(digests: Column) -> Column:
    """The digest of digests that follow one another."""
    return F.unhex(F.sha2(hex_digest(digests), 256))


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(bytearray()), lambda before, digest: F.concat(before, digest))


def folded(digest: Column, path: Column) -> Column:
    """The digest at the end of a path of siblings, from the digest at its beginning."""
    return F.aggregate(path, digest, lambda node, run: _digest_of(F.concat(run["before"], node, run["after"])))


def path_digest(path: Column) -> Column:
    """The digest in hex of all siblings of a path, one after another."""
    runs = F.aggregate(path, F.lit(bytearray()), lambda before, run: F.concat(before, run["before"], run["after"]))
    return hex_digest(_digest_of(runs))


@dataclass(frozen=True)
class Manifest:
    """Levels of the groups' trees and of the tree above them, from the leaves up, and the root.

    Nodes are rows (tree, place, size, digest, row). ``size`` counts the nodes of the tree on the level and
    ``row`` holds what goes along with a leaf. Nodes above the leaves have ``children`` in order.
    """

    groups: list[DataFrame]
    top: list[DataFrame]
    root: bytes | None

    @property
    def depth(self) -> int:
        """Steps to the root from the deepest leaf, at most."""
        return len(self.groups) + len(self.top) - 2


def _grown(leaves: DataFrame, largest: int, name: str) -> list[DataFrame]:
    """All levels over ``leaves``; ``largest`` is the number of leaves of the largest tree."""
    levels = [leaves]
    while largest > 1:
        parents = levels[-1].filter("size > 1").groupBy("tree", F.floor(F.col("place") / WIDTH).alias("place"), "size")
        # At most WIDTH rows each.
        parents = parents.agg(F.sort_array(F.collect_list(F.struct("place", "digest", "row"))).alias("children"))
        parents = parents.select(
            "tree",
            "place",
            F.ceil(F.col("size") / WIDTH).alias("size"),
            _digest_of(_joined(F.col("children.digest"))).alias("digest"),
            F.lit(None).cast(leaves.schema["row"].dataType).alias("row"),
            "children",
        )
        levels.append(stage(parents, f"{name}-{len(levels)}"))
        largest = -(-largest // WIDTH)
    return levels


def _stretches(extents: DataFrame, first: Column, last: Column) -> DataFrame:
    """A copy of each row for every stretch of places from ``first`` to ``last``."""
    stretches = F.sequence(F.floor(first / STRETCH), F.floor(last / STRETCH))
    return extents.withColumn("stretch", F.explode(stretches))


def _roots(levels: list[DataFrame]) -> DataFrame:
    """The highest node of every tree."""
    found = [level.filter("size = 1").select("tree", "digest") for level in levels]
    roots = found[0]
    for more in found[1:]:
        roots = roots.unionByName(more)
    return roots


def build_manifest(rows: DataFrame) -> Manifest:
    """The manifest of ``rows`` (group, order, digest, row).

    Within a group the leaves ascend by ``order``, then by digest; groups ascend; nulls come first. A group
    may hold any share of the rows: rows are dealt over ranges of the whole order, equal rows too, and
    meet their group's number by stretches of ``STRETCH`` places.
    """
    # Written first: dealing by ranges reads its input twice, and digests take a pass over all texts.
    rows = stage(rows.withColumn("serial", F.monotonically_increasing_id()), "digests")
    order = ranked(rows, *[F.col(name).asc_nulls_first() for name in ("group", "order", "digest", "serial")])
    extents = order.groupBy("group").agg(F.min("position").alias("start"), F.count("*").alias("size"))
    extents = stage(extents, "groups")
    trees = ranked(extents, F.col("group").asc_nulls_first()).withColumnRenamed("position", "tree")
    trees = trees.withColumn("name", encoded(F.col("group"))).drop("group")
    spread = stage(_stretches(trees, F.col("start"), F.col("start") + F.col("size") - 1), "group-stretches")
    spread = small_side(spread, "name")

    named = order.withColumn("name", encoded(F.col("group"))).withColumn("stretch", F.floor(F.col("position") / STRETCH))
    placed = named.join(spread, ["stretch", "name"])
    leaves = placed.select("tree", (F.col("position") - F.col("start")).alias("place"), "size", "digest", "row")
    leaves = stage(leaves, "leaves")
    found = extents.agg(F.count("*").alias("trees"), F.coalesce(F.max("size"), F.lit(0)).alias("largest")).first()
    groups = _grown(leaves, found["largest"], "level")

    above = _roots(groups).select(
        F.lit(TOP).cast("long").alias("tree"),
        F.col("tree").alias("place"),
        F.lit(found["trees"]).cast("long").alias("size"),
        "digest",
        F.lit(None).cast(leaves.schema["row"].dataType).alias("row"),
    )
    top = _grown(stage(above, "group-roots"), found["trees"], "top-level")
    root = top[-1].select("digest").first()
    return Manifest(groups, top, bytes(root["digest"]) if root else None)


def _steps(parents: DataFrame, level: int, height: int) -> DataFrame:
    """Pointers of the children of ``parents``, nodes of ``level``.

    The root of a group is named by its place in the tree above. That tree's own root, of level ``height``, is
    where all pointers end.
    """
    listed = parents.select("tree", "place", "size", "children", F.posexplode("children").alias("at", "child"))
    digests = F.col("children.digest")
    before = F.slice(digests, F.lit(1), F.col("at"))
    after = F.slice(digests, F.col("at") + 2, F.size("children") - F.col("at") - 1)
    is_root, in_top = F.col("size") == 1, F.col("tree") == TOP
    ends = is_root & (in_top | F.lit(height == 0))
    up = (
        F.when(ends, F.lit(ARRIVED)).when(is_root, F.lit(TOP)).otherwise(F.col("tree")),
        F.when(is_root & ~in_top, 0).otherwise(level),
        F.when(is_root & ~in_top, F.col("tree")).otherwise(F.col("place")),
    )
    return listed.select(
        "tree",
        F.lit(level - 1).alias("level"),
        F.col("child.place").alias("place"),
        *[value.cast(kind).alias(f"up_{name}") for name, kind, value in zip(_NAME, ("long", "int", "long"), up)],
        F.array(F.struct(_joined(before).alias("before"), _joined(after).alias("after"))).alias("path"),
        F.col("child.digest").alias("digest"),
        F.col("child.row").alias("row"),
    )


def _jumped(pointers: DataFrame, nodes: DataFrame) -> DataFrame:
    """``pointers`` moved on by what the nodes they point at point at."""
    names = [F.col(name).alias(f"up_{name}") for name in _NAME]
    ahead = nodes.select(*names, F.struct(*[f"up_{name}" for name in _NAME], "path").alias("ahead"))
    met = pointers.join(ahead, [f"up_{name}" for name in _NAME], "left")
    up = {name: F.coalesce(F.col(f"ahead.up_{name}"), F.col(f"up_{name}")) for name in _NAME}
    own = F.xxhash64(*_NAME)
    up["place"] = F.when(up["tree"] == ARRIVED, own).otherwise(up["place"])
    return met.select(
        *[name for name in pointers.columns if not name.startswith("up_") and name != "path"],
        *[up[name].alias(f"up_{name}") for name in _NAME],
        F.coalesce(F.concat("path", "ahead.path"), F.col("path")).alias("path"),
    )


def proofs(manifest: Manifest) -> DataFrame:
    """Every leaf (tree, place, digest, row) with the path of its siblings up to the root.

    Only nodes that are still pointed at stay in the self-joins. Where these are few, as they are from the
    third join on, they are broadcast, by a measured size, and leaves are not moved.
    """
    leaves, height = manifest.groups[0], len(manifest.top) - 1
    no_step = F.lit([]).cast("array<struct<before:binary,after:binary>>")
    alone = leaves.filter("size = 1").select(
        "tree",
        F.lit(0).alias("level"),
        "place",
        F.lit(TOP if height else ARRIVED).cast("long").alias("up_tree"),
        F.lit(0).alias("up_level"),
        F.col("tree").alias("up_place"),
        no_step.alias("path"),
        "digest",
        "row",
    )
    pointers, nodes = alone, None
    for level, parents in list(enumerate(manifest.groups))[1:]:
        steps = _steps(parents, level, height)
        if level == 1:
            pointers = steps.unionByName(alone)
        else:
            steps = steps.drop("digest", "row")
            nodes = steps if nodes is None else nodes.unionByName(steps)
    for level, parents in list(enumerate(manifest.top))[1:]:
        steps = _steps(parents, level, height).drop("digest", "row")
        nodes = steps if nodes is None else nodes.unionByName(steps)
    distance = 1
    # A leaf alone in its group begins at its root, one step behind the others.
    while nodes is not None and distance < manifest.depth + 1:
        nodes = stage(nodes, f"nodes-{distance}")
        ahead = small_side(nodes, row_bytes=POINTER_BYTES + STEP_BYTES * distance)
        pointers = _jumped(pointers, ahead)
        distance *= 2
        nodes = _jumped(nodes, ahead).filter((F.col("tree") == TOP) | (F.col("level") >= distance))
    return pointers.select("tree", "place", "digest", "row", "path")


def document_manifest(documents: DataFrame) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and what its proof says of a tampered copy.

    Leaves are rows of doc_id, source, lang, n_chars and text, groups are sources. Where the crc32 of the doc_id
    (in decimal) is even, the tampered copy has lost the line ends of its text; a null doc_id is not tampered
    with. Equal doc_ids of a source are ordered by their leaves; a null doc_id or source comes first. Columns:
    doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. An empty table gives no rows.
    """
    chosen = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    name = F.col("doc_id").cast("string").cast("binary")
    bare = F.translate(F.col("text").cast("string"), "\n", "")
    tampered = F.when(F.crc32(name) % 2 == 0, row_digest(*chosen, bare))
    rows = documents.select(
        F.col("source").alias("group"),
        F.col("doc_id").alias("order"),
        row_digest(*chosen, F.col("text")).alias("digest"),
        F.struct("doc_id", tampered.alias("tampered")).alias("row"),
    )
    manifest = build_manifest(rows)
    # Roots of groups, for stretches of their leaves.
    sizes = manifest.groups[0].groupBy("tree").agg(F.max("place").alias("last"))
    roots = manifest.top[0].select(F.col("place").alias("tree"), F.col("digest").alias("subroot"))
    roots = small_side(stage(_stretches(roots.join(sizes, "tree"), F.lit(0), F.col("last")), "subroots"))
    leaves = proofs(manifest).withColumn("stretch", F.floor(F.col("place") / STRETCH))
    shown = leaves.join(roots.drop("last"), ["tree", "stretch"])
    root = F.lit(manifest.root.hex() if manifest.root else None).cast("string")
    again = hex_digest(folded(F.coalesce("row.tampered", "digest"), F.col("path")))
    return shown.select(
        F.col("row.doc_id").alias("doc_id"),
        hex_digest(F.col("digest")).alias("leaf"),
        hex_digest(F.col("subroot")).alias("subroot"),
        root.alias("root"),
        path_digest(F.col("path")).alias("proof_sha256"),
        again.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
