"""A Merkle manifest with versions: trees of sixteen branches over the documents of each source, and one over the sources.

Leaves of a source ascend by id; sixteen consecutive nodes become the hash of their digests, until one is left, the
source's subroot; the subroots, by source, become the root likewise. The tree is kept in aligned blocks of 4,096 nodes of a
level, a row each, which a task builds three levels up; the blocks' roots are ranked, cut into blocks and built
again, so a hot source is as many tasks as it has blocks and the driver sees a count a level. The siblings on the way to
the root go down again, block by block, as a path for every block.

A changed leaf makes a *version* of the tree. It is persistent: the version copies the leaf's ancestors inside the
block, shares every other node, and continues through the upper levels on the path that Spark has brought down, a node a
level. Nothing is built anew, and a version is as many rows as the tree is high.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marajo.llm.arrow import small_batches
from marajo.operators.ordered import positions
from marajo.session import small_side, stash

WIDTH = 16
LEVELS = 3
BLOCK = WIDTH**LEVELS
#: Path rows (some kilobytes each) that may be sent to every executor.
BROADCAST_PATHS = 2_000

_ITEMS = "array<struct<pos: long, doc_id: long, leaf: string, changed: string>>"
_PATH = "at array<int>, siblings array<string>"


@dataclass(frozen=True)
class Tree:
    """``blocks``: a row per block of leaves with its path; ``root``: digest of all, None without documents."""

    blocks: DataFrame
    root: str | None


def digest(*values: Column) -> Column:
    """Hex SHA-256 of the values, one after the other, each as ``-`` if null, else byte count, ``:`` and itself."""
    part = lambda v: F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
    return F.sha2(F.concat(*[part(v.cast("string")) for v in values]).cast("binary"), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def grown(nodes: list[str], whole: bool) -> list[list[str]]:
    """Levels above ``nodes``, which come first: three of them, or up to the single node if the block is the whole tree."""
    levels = [nodes]
    while len(levels) <= LEVELS and not (whole and len(levels[-1]) == 1):
        low = levels[-1]
        levels.append([_hash("".join(low[i : i + WIDTH])) for i in range(0, len(low), WIDTH)])
    return levels


def path(levels: list[list[str]], at: int) -> tuple[list[int], list[str]]:
    """For each level below the block's root the place in its run and the digests of the run's others."""
    places, siblings = [], []
    for level in levels[:-1]:
        run = at - at % WIDTH
        places.append(at % WIDTH)
        siblings.append("".join(level[run:at] + level[at + 1 : run + WIDTH]))
        at //= WIDTH
    return places, siblings


def copied(leaf: str, places: list[int], siblings: list[str]) -> list[str]:
    """The version's own nodes, from the leaf's parent to the root; siblings are shared."""
    nodes = []
    for place, others in zip(places, siblings, strict=True):
        cut = 64 * place
        leaf = _hash(others[:cut] + leaf + others[cut:])
        nodes.append(leaf)
    return nodes


def _blocks(ranked: DataFrame) -> DataFrame:
    """Blocks of consecutive nodes; at most ``BLOCK`` rows meet in a group. ``whole``: the block is all of its tree."""
    item = F.struct("pos", "doc_id", "leaf", "changed")
    grouped = ranked.groupBy("owner", F.shiftright("pos", 12).alias("block")).agg(F.max("of").alias("of"), F.sort_array(F.collect_list(item)).alias("items"))
    return grouped.select("owner", "block", (F.col("of") <= BLOCK).alias("whole"), "of", "items")


def _roots(blocks: DataFrame) -> DataFrame:
    """The node that each block comes to, as a row of the next level."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [grown([x["leaf"] for x in r["items"]], r["whole"])[-1][0] for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("owner"), batch.column("block"), batch.column("of"), pa.array(rows, pa.string())], ["owner", "pos", "below", "leaf"])

    made = small_batches(blocks).mapInArrow(build, "owner string, pos long, below long, leaf string")
    none = F.lit(None)
    return made.select("owner", "pos", F.ceil(F.col("below") / BLOCK).alias("of"), none.cast("long").alias("doc_id"), "leaf", none.cast("string").alias("changed"))


def _climb(ranked: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every level from the leaves up, and the last node of each owner with the ``level`` that it is whole at."""
    levels, tops = [], None
    while True:
        blocks = stash(_blocks(ranked), f"{name}{len(levels)}")
        nodes = stash(_roots(blocks), f"{name}-roots{len(levels)}")
        done = nodes.where(F.col("of") == 1).select("owner", F.lit(len(levels)).alias("level"), "leaf")
        tops = done if tops is None else tops.unionByName(done)
        levels.append(blocks)
        ranked = nodes.where(F.col("of") > 1)
        if ranked.isEmpty():
            return levels, tops


def _with_path(blocks: DataFrame, paths: DataFrame, name: str) -> DataFrame:
    own = paths.select(F.struct("owner", F.col("pos").alias("block")).alias("holder"), *[c for c in paths.columns if c not in ("owner", "pos")])
    return blocks.join(small_side(own, name, BROADCAST_PATHS), F.struct("owner", "block") == F.col("holder")).drop("holder")


def _paths(blocks: DataFrame) -> DataFrame:
    """Paths of the nodes in blocks whose own path is known; ``subroot``, if there, is handed on."""
    handed = ["subroot"] if "subroot" in blocks.columns else []

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                levels = grown([x["leaf"] for x in r["items"]], r["whole"])
                for i, x in enumerate(r["items"]):
                    places, siblings = path(levels, i)
                    made = {"owner": r["owner"], "pos": x["pos"], "at": places + r["at"], "siblings": siblings + r["siblings"]} | {c: r[c] for c in handed}
                    yield pa.RecordBatch.from_pylist([made], kind)

    fields = [("owner", pa.string()), ("pos", pa.int64()), ("at", pa.list_(pa.int32())), ("siblings", pa.list_(pa.string())), *[(c, pa.string()) for c in handed]]
    kind = pa.schema(fields)
    return small_batches(blocks).mapInArrow(walk, f"owner string, pos long, {_PATH}" + "".join(f", {c} string" for c in handed))


def _descend(levels: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """The blocks of leaves with their paths. ``tops`` has a path for each owner's last node and its ``level``."""
    upper = None
    for level in reversed(range(len(levels))):
        ends = tops.where(F.col("level") == level).drop("level").withColumn("pos", F.lit(0).cast("long"))
        here = ends if upper is None else ends.unionByName(upper)
        blocks = _with_path(levels[level], here, f"{name}-path{level}")
        if level:
            upper = _paths(blocks)
    return blocks


def build(leaves: DataFrame) -> Tree:
    """The tree over ``leaves``: ``owner`` (what a tree is over; null is an owner, before all others), ``doc_id``, ``leaf``
    (hex digest) and ``changed`` (the digest of the tampered leaf, null where it isn't).

    Leaves ascend by ``doc_id``, null first; rows that share an id by digest, so equal rows are neighbours and it doesn't
    matter which is first. An empty table has no blocks and no root. Owners are told apart by a prefix, so that null and
    the empty text differ. Digests have 64 characters.
    """
    owner = F.coalesce(F.concat(F.lit("s"), "owner"), F.lit("n"))
    held = stash(leaves.select(owner.alias("owner"), "doc_id", "leaf", "changed"), "leaves")
    levels, last = _climb(positions(held, ["owner"], ["doc_id", "leaf", "changed"]), "blocks")
    last = stash(last, "subroots")
    ranked = stash(positions(last, [], ["owner"]), "sources")
    none = F.lit(None)
    over = ranked.select(F.lit("").alias("owner"), "pos", "of", none.cast("long").alias("doc_id"), "leaf", none.cast("string").alias("changed"))
    top_levels, top = _climb(over, "top")
    root = top.select("leaf").first()
    empty = top.select("owner", "level", F.array().cast("array<int>").alias("at"), F.array().cast("array<string>").alias("siblings"))
    ways = _paths(_descend(top_levels, empty, "top")).drop("owner")
    tops = ranked.join(ways, "pos").select("owner", "level", "at", "siblings", F.col("leaf").alias("subroot"))
    return Tree(_descend(levels, stash(tops, "ways"), "blocks"), root and root[0])


def check(tree: Tree) -> DataFrame:
    """Per leaf ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (digest of the siblings, level by level to the
    root), ``folded_root`` (root of the leaf's version; of the unchanged tree where the leaf is unchanged, folded as well)
    and ``verified`` (whether that is the root)."""
    root = tree.root

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                levels = grown([x["leaf"] for x in r["items"]], r["whole"])
                found = []
                for i, x in enumerate(r["items"]):
                    places, siblings = path(levels, i)
                    nodes = copied(x["changed"] or x["leaf"], places + r["at"], siblings + r["siblings"])
                    proof = _hash("".join(siblings) + "".join(r["siblings"]))
                    folded = nodes[-1] if nodes else x["changed"] or x["leaf"]
                    found.append((x["doc_id"], x["leaf"], r["subroot"], root, proof, folded, folded == root))
                columns = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    kind = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in names], ("verified", pa.bool_())])
    return small_batches(tree.blocks).mapInArrow(verify, "doc_id long, " + ", ".join(f"{c} string" for c in names) + ", verified boolean")


def versions(tree: Tree) -> DataFrame:
    """The nodes that the versions own: ``source``, ``doc_id`` and ``leaf`` (the changed one) of the version, ``level`` from
    1 (the leaf's parent) to the root and ``digest``. All other nodes are those of the tree."""

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                levels = grown([x["leaf"] for x in r["items"]], r["whole"])
                source = r["owner"][1:] if r["owner"].startswith("s") else None
                found = []
                for i, x in enumerate(r["items"]):
                    if x["changed"]:
                        places, siblings = path(levels, i)
                        nodes = copied(x["changed"], places + r["at"], siblings + r["siblings"])
                        found += [{"source": source, "doc_id": x["doc_id"], "leaf": x["changed"], "level": k, "digest": d} for k, d in enumerate(nodes, 1)]
                if found:
                    yield pa.RecordBatch.from_pylist(found, kind)

    kind = pa.schema([("source", pa.string()), ("doc_id", pa.int64()), ("leaf", pa.string()), ("level", pa.int32()), ("digest", pa.string())])
    return small_batches(tree.blocks).mapInArrow(copy, "source string, doc_id long, leaf string, level int, digest string")
