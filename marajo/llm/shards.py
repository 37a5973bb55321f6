"""Sharding by a hierarchical weighted hash tree.

The tree has regions, racks and shards. Every node draws an exponential variate for a row, with the node's
weight as its rate; the row descends into the region with the smallest draw, then into its rack and shard with
the smallest. A shard's draw is ``-ln(u) / weight`` with ``u`` hashed from the row's id and the shard's path;
a node's draw is the smallest of its children's, which is again exponential with the sum of their weights.
So each node wins in proportion to its weight, and a change of weights below one node alters no draw outside
it: rows move only into a subtree that gains weight, or out of one that loses it. Draws of their own for regions and
racks would break this: rows drawn into a region by a new shard would then be dealt to its old shards too.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marajo.operators.ordered import positions
from marajo.session import stash


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0

    @property
    def path(self) -> str:
        return f"{self.region}/{self.rack}/{self.shard}"


def even_tree(n: int, regions: int = 4, racks: int = 5) -> list[Leaf]:
    """``n`` shards of weight one, dealt over regions and racks so that shard ``s`` keeps its path for any ``n``."""
    return [Leaf(s % regions, s // regions % racks, s) for s in range(n)]


def _tree(leaves: list[Leaf]) -> dict[int, dict[int, list[Leaf]]]:
    """Shards that can win by region and rack; a shard of weight zero is drained and stands nowhere."""
    tree: dict[int, dict[int, list[Leaf]]] = {}
    for x in sorted(leaves, key=lambda x: (x.region, x.rack, x.shard)):
        if not (math.isfinite(x.weight) and x.weight >= 0):
            raise ValueError(f"shard {x.shard} has weight {x.weight}")
        if x.weight > 0:
            tree.setdefault(x.region, {}).setdefault(x.rack, []).append(x)
    return tree


def _draws(key: Column, leaves: list[Leaf]) -> Column:
    """Array of the leaves' draws: the hash of id and path, in proportion to the weight."""
    unit = lambda x: (F.conv(F.substring(F.md5(F.concat_ws("|", key, F.lit(x.path))), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return F.array(*[-F.ln(unit(x)) / float(x.weight) for x in leaves])


def _descend(draws: Column, at: dict[Leaf, int], leaves: list[Leaf]) -> Column:
    """Shard reached from the root: the region of the smallest draw, in it the rack, in it the shard; equal draws go to
    the node of the lowest number. Null where no shard can win. ``at`` has each leaf's place in ``draws``."""
    tree = _tree(leaves)
    if not tree:
        return F.lit(None).cast("int")
    shards = lambda own: F.array(*[F.struct(F.get(draws, F.lit(at[x])).alias("draw"), F.lit(x.shard).alias("shard")) for x in own])
    racks = lambda region: F.array(*[_node(F.lit(k), shards(own), "shards") for k, own in tree[region].items()])
    regions = F.array(*[_node(F.lit(r), racks(r), "racks") for r in tree])
    region = F.array_min(regions)
    rack = F.array_min(region["racks"])
    return F.array_min(rack["shards"])["shard"]


def _node(number: Column, below: Column, name: str) -> Column:
    """A node of the tree: its draw is the smallest of those below it."""
    return F.element_at(F.transform(F.array(below), lambda b: F.struct(F.array_min(b)["draw"].alias("draw"), number.alias("number"), b.alias(name))), 1)


def place(docs: DataFrame, leaves: list[Leaf], grown: list[Leaf] | None = None) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot`` and ``grown_shard`` for every row of ``docs``.

    ``doc_id`` and the tree alone decide the shard, so rows that repeat an id share one; a null id counts as the
    text ``null``. ``size`` is the text's UTF-8 bytes (null: none) plus 16, ``text_crc32`` that of a null text is
    0. ``slot`` numbers a shard's rows from 0 without gaps in order of id, then checksum and size. ``grown_shard`` is
    the shard in the tree ``grown`` (null without one). Shards of weight zero get no rows; where no shard has weight,
    ``shard`` is null and slots number all rows. Negative and infinite weights are refused. Other columns are not
    read; an empty table gives no rows.

    A leaf that both trees have with equal weight is drawn once for both. The drawn shards are written, without the texts; slots
    come from an order over all rows by range, whatever ids look like (see ``ordered.positions``).
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    drawn_once = [x for x in dict.fromkeys([*leaves, *(grown or [])]) if x.weight > 0]
    at = {x: i for i, x in enumerate(drawn_once)}
    drawn = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        _draws(key, drawn_once).alias("draws"),
        F.monotonically_increasing_id().alias("row"),  # tells equal rows apart, so that ranges can split them
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        _descend(F.col("draws"), at, leaves).alias("shard"),
        (_descend(F.col("draws"), at, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        "row",
    )
    placed = positions(stash(drawn, "drawn"), ["shard"], ["doc_id", "text_crc32", "size", "row"])
    return placed.select("doc_id", "size", "text_crc32", "shard", F.col("pos").cast("long").alias("slot"), "grown_shard")
