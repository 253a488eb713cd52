"""A Merkle manifest of a table, and inclusion proofs of its rows by octopus multiproofs.

Every row is a leaf. The leaves of a group (a language) form a tree in order of their ids,
eight consecutive nodes to a parent, and the groups' roots form a second tree of the same
kind. Digests are lower-case hexadecimal SHA-256, of the children's digests put together.

Leaves are dealt out in blocks of 4,096 consecutive ones. Building folds each block in one
task and hands on its topmost node; a few rounds reach the roots, and every inner node
is stored under its coordinates (tree, level, index). Proving is done by block as well: a block
works out the least set of nodes it cannot derive from its own leaves (level by level, the
missing children of the parents it needs), all those coordinates are fetched in one join,
and from leaves and fetched nodes the block derives the shared inner nodes once and
expands the proof of each leaf. Any subset of leaves can be proved that way; the more leaves of a
block are wanted, the fewer nodes are fetched for each.

Edge cases: null fields are hashed as ``-``; rows without a group form the first group and rows
without an id come first in theirs; rows that share an id are ordered by their digests, and repeated
rows are leaves of their own. A tree of one leaf has that leaf as its root, and a proof without
siblings is the digest of nothing. Empty tables give empty manifests and no proofs. Texts are
hashed whole. Only the named columns are read, further ones are ignored whatever their names.

Positions come from a range partitioning by group, id and digest that is written down, with
the rows counted per file and group; one window over those counts is all that is ordered in
one place, and one row per group orders the second tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mostrador.session import shared_folder

ARITY = 8
BLOCK_LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = ""  # the tree over the groups' roots; the keys of groups are never empty
_NODE = "key string, level int, idx bigint, digest string"


class Manifest(NamedTuple):
    """``leaves`` (key, pos, total, group_pos, groups, doc_id, leaf, tampered), ``nodes`` (key, level, idx, digest), and the root."""

    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def encoded(value: Column) -> Column:
    """A value as its length in bytes, a colon and itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]), 256)


def group_key(group: Column) -> Column:
    """The group as a key that is never null nor empty; keys sort as groups do, null first."""
    return F.coalesce(F.concat(F.lit("s"), group), F.lit("n"))


def _stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def positions(rows: DataFrame, folder: str) -> DataFrame:
    """``rows`` (key, doc_id, leaf, ...) with ``pos``, the place within the key by id, and ``total``, the rows of the key."""
    order = [F.col("key").asc(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()]
    # Identifiers rise along a file, and files follow each other in the order of the ranges.
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = _stored(ranged, f"{folder}/ranged").withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy("key", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    of_key = Window.partitionBy("key")
    before = F.sum("n").over(of_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(
        "key", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(of_key).alias("total")
    )
    joined = placed.join(_stored(parts, f"{folder}/parts"), ["key", "part"])
    return joined.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _parent(children: Sequence[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def height(total: int) -> int:
    """Levels above the leaves."""
    levels = 0
    while total > 1:
        total, levels = -(-total // ARITY), levels + 1
    return levels


def fold_block(idx: np.ndarray, digests: list[str], total: int, level: int, levels: int = BLOCK_LEVELS) -> list[tuple[int, int, str]]:
    """``level, index, digest`` of the inner nodes above a block of all consecutive nodes of one level.

    ``total`` is the number of leaves of the tree. At most ``levels`` levels are built.
    """
    out: list[tuple[int, int, str]] = []
    first, top = int(idx[0]), min(height(total), level + levels)
    while level < top:
        first, level = first // ARITY, level + 1
        digests = [_parent(digests[k : k + ARITY]) for k in range(0, len(digests), ARITY)]
        out.extend((level, first + k, digest) for k, digest in enumerate(digests))
    return out


def _fold(nodes: DataFrame, level: int) -> DataFrame:
    """Inner nodes above ``nodes`` (key, total, idx, digest), which are all those of a level."""
    levels = BLOCK_LEVELS

    def folded(block: pa.Table) -> pa.Table:
        block = block.sort_by("idx")
        found = fold_block(block.column("idx").to_numpy(), block.column("digest").to_pylist(), block.column("total")[0].as_py(), level, levels)
        n = len(found)
        columns = [[block.column("key")[0].as_py()] * n, *([list(c) for c in zip(*found)] or [[], [], []])]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.string()))], ["key", "level", "idx", "digest"])

    block = F.shiftright("idx", 3 * levels).alias("block")
    return nodes.select("key", "total", "idx", "digest", block).groupBy("key", "block").applyInArrow(folded, _NODE)


def _trees(leaves: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """All inner nodes over ``leaves`` (key, total, pos, leaf), and ``key, total, subroot`` of every tree."""
    most = leaves.agg(F.max("total")).first()[0] or 0
    sizes = leaves.groupBy("key").agg(F.first("total").alias("total"))
    lone = leaves.where("total = 1").select("key", "total", F.col("leaf").alias("subroot"))
    level, current = 0, leaves.where("total > 1").select("key", "total", F.col("pos").alias("idx"), F.col("leaf").alias("digest"))
    sizes = _stored(sizes, f"{folder}/sizes")
    parts, tops = [], [lone]
    while level < max(1, height(most)):
        step = _stored(_fold(current, level), f"{folder}/inner-{level}")
        parts.append(step)
        level += BLOCK_LEVELS
        current = step.where(F.col("level") == level).join(sizes, "key").where(F.col("total") > ARITY**level)
        current = current.select("key", "total", "idx", "digest")
        # The one node of its level: no tree has another one at or above the level of its root.
        tops.append(step.join(sizes, "key").where(_is_root(F.col("level"), F.col("total"))).select("key", "total", F.col("digest").alias("subroot")))
    nodes = reduce(DataFrame.unionByName, parts)
    return nodes, _stored(reduce(DataFrame.unionByName, tops), f"{folder}/roots")


def _is_root(level: Column, total: Column) -> Column:
    """Whether a level of a tree with ``total`` leaves is its root's."""
    reach = F.lit(float(ARITY))
    return (F.pow(reach, level) >= total) & (F.pow(reach, level - 1) < total)


def manifest(
    docs: DataFrame,
    group: str = "lang",
    fields: Sequence[str] = FIELDS,
    tampered: Callable[[], tuple[Column, dict[str, Column]]] | None = None,
) -> Manifest:
    """The leaves and inner nodes of both trees, stored in the shared folder.

    ``tampered`` may name a condition and changed columns: rows that meet it get a second digest of the changed
    row, null for all others. It is there to try what a proof finds out.
    """
    folder = shared_folder(docs.sparkSession, "merkle")
    columns = {f: F.col(f) for f in fields}
    other = F.lit(None).cast("string")
    if tampered is not None:
        condition, changed = tampered()
        other = F.when(condition, leaf_digest({**columns, **changed}.values()))
    rows = docs.select(
        group_key(F.col(group)).alias("key"), "doc_id", leaf_digest(columns.values()).alias("leaf"), other.alias("tampered")
    )
    leaves = positions(rows, f"{folder}/leaves")
    inner, roots = _trees(leaves, f"{folder}/groups")
    # One row per group.
    ranked = Window.orderBy("key")
    count = Window.partitionBy()
    upper = roots.select(
        F.lit(TOP).alias("key"),
        F.col("key").alias("group"),
        (F.row_number().over(ranked) - 1).cast("bigint").alias("pos"),
        F.count("*").over(count).alias("total"),
        F.col("subroot").alias("leaf"),
    )
    upper = _stored(upper, f"{folder}/upper")
    top_nodes, top = _trees(upper, f"{folder}/top")
    of_group = upper.select(F.col("group").alias("key"), F.col("pos").alias("group_pos"), F.col("total").alias("groups"))
    subroots = upper.select("key", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("leaf").alias("digest"))
    nodes = inner.unionByName(top_nodes).unionByName(subroots)
    root = top.select("subroot").first()  # one digest
    return Manifest(leaves.join(_stored(of_group, f"{folder}/of-group"), "key"), nodes, root and root[0])


# --- proofs -------------------------------------------------------------------------------
def missing_nodes(positions: np.ndarray, total: int) -> list[np.ndarray]:
    """Per level, the indices of the nodes that the root above ``positions`` (ascending) needs and cannot derive."""
    out, known = [], positions
    while total > 1:
        parents = np.unique(known // ARITY)
        children = (parents[:, None] * ARITY + np.arange(ARITY)).ravel()
        out.append(np.setdiff1d(children[children < total], known, assume_unique=True))
        known, total = parents, -(-total // ARITY)
    return out


class _Above(NamedTuple):
    """What the leaves of a block share: the root, and the siblings from each leaf's parent upwards."""

    root: str
    runs: dict[int, list[str]]  # the children of each parent of leaves
    proofs: dict[int, str]  # the siblings above each of these parents, put together
    steps: list[dict[int, tuple[int, list[str]]]]  # per higher level: node -> its place in its run, the run


def derive(known: dict[int, str], fetched: list[dict[int, str]], total: int, beyond: str = "") -> _Above:
    """Shared inner nodes and sibling lists of leaves ``known`` by index, from ``fetched`` nodes per level.

    ``beyond`` is what follows the root in every proof.
    """
    levels: list[dict[int, list[str]]] = []
    now = known
    while total > 1:
        held = {**now, **fetched[len(levels)]}
        runs = {}
        for parent in sorted({i // ARITY for i in now}):
            first = parent * ARITY
            runs[parent] = [held[i] for i in range(first, min(first + ARITY, total))]
        levels.append(runs)
        now, total = {parent: _parent(children) for parent, children in runs.items()}, -(-total // ARITY)
    root = next(iter(now.values()))
    proofs, steps = {0: beyond}, []
    for runs in reversed(levels[1:]):
        step, below = {}, {}
        for parent, children in runs.items():
            for k in range(len(children)):
                node = parent * ARITY + k
                step[node] = (k, children)
                below[node] = "".join(children[:k] + children[k + 1 :]) + proofs[parent]
        steps.append(step)
        proofs = below
    return _Above(root, levels[0] if levels else {}, proofs, steps[::-1])


def _siblings(above: _Above, pos: int) -> str:
    """The siblings of a leaf and of the nodes above it, put together."""
    if not above.runs:
        return above.proofs[0]
    parent, k = divmod(pos, ARITY)
    children = above.runs[parent]
    return "".join(children[:k] + children[k + 1 :]) + above.proofs[parent]


def _climb(digest: str, pos: int, above: _Above) -> str:
    """The root that a leaf and its siblings give."""
    if not above.runs:
        return digest
    parent, k = divmod(pos, ARITY)
    children = above.runs[parent]
    digest = _parent([*children[:k], digest, *children[k + 1 :]])
    for step in above.steps:
        k, children = step[parent]
        digest = _parent([*children[:k], digest, *children[k + 1 :]])
        parent //= ARITY
    return digest


def _levels(fetched: pa.Table, top: bool) -> list[dict[int, str]]:
    """The fetched digests of one of the two trees, by level and index."""
    out: list[dict[int, str]] = [{} for _ in range(64 // 3 + 1)]
    for own, level, idx, digest in zip(*(fetched.column(c).to_pylist() for c in ("top", "level", "idx", "digest"))):
        if own == top:
            out[level][idx] = digest
    return out


def _needs(wanted: DataFrame) -> DataFrame:
    """``key, block, top, level, idx``: the nodes each block of ``wanted`` leaves has to fetch, and its group's root."""

    def coordinates(block: pa.Table) -> pa.Table:
        first = {c: block.column(c)[0].as_py() for c in ("key", "block", "total", "group_pos", "groups")}
        lower = missing_nodes(np.unique(block.column("pos").to_numpy()), first["total"])
        upper = missing_nodes(np.array([first["group_pos"]]), first["groups"])
        found = [(True, 0, first["group_pos"])]
        found += [(top, level, int(i)) for top, part in ((False, lower), (True, upper)) for level, idx in enumerate(part) for i in idx]
        n = len(found)
        columns = list(zip(*found))
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int32(), pa.int64())
        values = [[first["key"]] * n, [first["block"]] * n, *map(list, columns)]
        return pa.table([pa.array(v, t) for v, t in zip(values, kinds)], ["key", "block", "top", "level", "idx"])

    return (
        wanted.select("key", "block", "pos", "total", "group_pos", "groups")
        .groupBy("key", "block")
        .applyInArrow(coordinates, "key string, block bigint, top boolean, level int, idx bigint")
    )


def proofs(tree: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, folded_root, verified`` of the ``wanted`` rows of ``tree.leaves``, all by default.

    ``proof`` is the siblings' digests in order, level by level, put together. ``folded_root`` is what the
    tampered digest, where there is one, and otherwise the leaf's own gives with these siblings.
    """
    return _prove(tree, wanted, "proof", lambda proof: proof)


def proof_digests(tree: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """As ``proofs``, with the digest of each proof instead of the proof."""
    return _prove(tree, wanted, "proof_sha256", lambda proof: hashlib.sha256(proof.encode()).hexdigest())


def _prove(tree: Manifest, wanted: DataFrame | None, name: str, finish: Callable[[str], str]) -> DataFrame:
    spark = tree.leaves.sparkSession
    folder = shared_folder(spark, "proofs")
    chosen = (tree.leaves if wanted is None else wanted).withColumn("block", F.shiftright("pos", 3 * BLOCK_LEVELS))
    needs = _stored(_needs(chosen), f"{folder}/needs")
    nodes = tree.nodes
    if needs.where("level = 0 AND NOT top").limit(1).count():
        level_0 = tree.leaves.select("key", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("leaf").alias("digest"))
        nodes = nodes.unionByName(level_0)
    place = F.when(F.col("top"), F.lit(TOP)).otherwise(F.col("key"))
    asked = needs.select(place.alias("tree"), "level", "idx", F.col("key").alias("for_key"), "block", "top")
    fetched = asked.join(nodes.withColumnRenamed("key", "tree"), ["tree", "level", "idx"]).select(
        F.col("for_key").alias("key"), "block", "top", "level", "idx", "digest"
    )
    root, kind = tree.root, chosen.schema["doc_id"].dataType.simpleString()
    texts = ("leaf", "subroot", "root", name, "folded_root")

    def expanded(block: pa.Table, nodes: pa.Table) -> pa.Table:
        total, place, groups = (block.column(c)[0].as_py() for c in ("total", "group_pos", "groups"))
        fetched = _levels(nodes, True)
        upper = derive({place: fetched[0][place]}, fetched, groups)
        beyond = _siblings(upper, place)
        pos, leaf, tampered = (block.column(c).to_pylist() for c in ("pos", "leaf", "tampered"))
        lower = derive(dict(zip(pos, leaf)), _levels(nodes, False), total, beyond)
        if (lower.root, upper.root) != (fetched[0][place], root):
            raise RuntimeError("the fetched nodes do not lead to the root")
        found = [finish(_siblings(lower, p)) for p in pos]
        folded = [_climb(_climb(changed or own, p, lower), place, upper) for p, own, changed in zip(pos, leaf, tampered)]
        n = len(pos)
        out = {"doc_id": block.column("doc_id"), "leaf": leaf, "subroot": [lower.root] * n, "root": [root] * n, name: found, "folded_root": folded}
        return pa.table({**out, "verified": [f == root for f in folded]})

    by = ("key", "block")
    strings = ", ".join(f"{c} string" for c in texts)
    return chosen.groupBy(*by).cogroup(fetched.groupBy(*by)).applyInArrow(expanded, f"doc_id {kind}, {strings}, verified boolean")
