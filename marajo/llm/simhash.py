"""SimHash near-dedup over a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most ``k`` bits differ in at most ``k`` of their 8 bytes, so they
share at least ``8 - k`` positional bytes. A posting list of one positional byte holds 1/256 of the corpus,
which would make the tally quadratic, so postings are kept for *sets* of byte positions: a covering family
guarantees that any pair with the minimum number of matches meets in at least one list. Pairs met are tallied
over all eight positions, kept from ``8 - k`` matches on, and verified by bit count.

A list longer than ``LIST_LIMIT`` fingerprints is not paired up. Its members agree in the list's bytes, so
they can only differ in the free ones: members that agree once any ``k`` free bits are masked out are within
``k`` bits of each other and are tied to the smallest of them. That is exact and linear in the list.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marajo.llm.arrow import as_bytes, small_batches, steps
from marajo.llm.graph import connected_components
from marajo.session import small_side, stash

LIST_LIMIT = 256
_HEX = "%016x"


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the 64-bit ``hashes``; 0 without any."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of one UTF-8 text: majority of each bit over its shingles' hashes; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    return majority(np.fromiter((digest(g, seed) for g in grams), np.uint64, n))


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as a signed long) of each row; a null text has no words."""

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                found = [fingerprint(t or b"", shingle, seed) for t in as_bytes(part.column("text"))]
                signed = np.array(found, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(signed)], names=["doc_id", "fp"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, fp long")


def covering(k: int) -> list[tuple[int, ...]]:
    """Sets of ``k + 1`` byte positions such that any ``k`` positions lie within one of them (greedy)."""
    size = min(8, k + 1)
    missing = set(combinations(range(8), k))
    blocks = []
    while missing:
        best = max(combinations(range(8), size), key=lambda b: sum(c in missing for c in combinations(b, k)))
        blocks.append(best)
        missing -= set(combinations(best, k))
    return blocks


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _list_masks(k: int) -> list[int]:
    """For each list kind, the mask of the bytes that its members share."""
    return [((1 << 64) - 1) & ~sum(0xFF << 8 * p for p in block) for block in covering(k)]


def _free_masks(k: int) -> list[list[int]]:
    """For each list kind, all masks that clear ``k`` of the bits its members may differ in."""
    full = (1 << 64) - 1
    return [
        [full & ~sum(1 << b for b in bits) for bits in combinations([8 * p + j for p in block for j in range(8)], k)]
        for block in covering(k)
    ]


def shared_bytes(difference: Column) -> Column:
    """Positional bytes that agree, given the exclusive or of two fingerprints."""
    total = F.lit(0)
    for p in range(8):
        total = total + F.when(F.shiftright(difference, 8 * p).bitwiseAND(F.lit(255)) == 0, 1).otherwise(0)
    return total


def links(fps: DataFrame, k: int = 2, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints (column ``fp``) that join all within ``k`` bits.

    Lists up to ``list_limit`` give verified pairs, longer ones a star over each set of members that agree
    outside ``k`` bits; both leave the same components.
    """
    masks = _list_masks(k)
    posted = fps.select("fp").distinct().select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("kind", "key")
    )
    sizes = posted.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    met = posted.join(sizes, ["kind", "key"])
    short = (
        met.where(F.col("n") <= list_limit)
        .groupBy("kind", "key")
        .agg(F.collect_list("fp").alias("fps"))
        .select(F.explode("fps").alias("a"), "fps")
        .select("a", F.explode("fps").alias("b"))
        .where(F.col("a") > F.col("b"))
    )
    difference = F.col("a").bitwiseXOR(F.col("b"))
    pairs = short.where(shared_bytes(difference) >= 8 - k).where(F.bit_count(difference) <= k).select("a", "b")
    free = F.array(*[F.array(*[F.lit(_signed(m)) for m in row]) for row in _free_masks(k)])
    masked = met.where(F.col("n") > list_limit).select("fp", F.explode(F.element_at(free, F.col("kind") + 1)).alias("mask"))
    masked = masked.withColumn("rest", F.col("fp").bitwiseAND(F.col("mask")))
    hub = masked.groupBy("mask", "rest").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    stars = masked.join(hub, ["mask", "rest"]).select(F.col("fp").alias("a"), "b").where(F.col("a") != F.col("b"))
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, k: int = 2, seed: int = 42) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row of ``docs``.

    Rows whose fingerprints differ in ``k`` bits or fewer are linked; ``component_id`` is the smallest id
    reachable, the row's own included. Null and empty texts have fingerprint zero and link like any other.
    A null id keeps its row and never names a component unless all its members are null; repeated rows each
    come back; other columns of ``docs`` are not read, whatever their names. An empty table gives no rows.
    """
    fps = stash(fingerprints(docs, shingle, seed), "fingerprints")
    first = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    labels = connected_components(links(first, k))
    named = first.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    lowest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = named.join(lowest, "label").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, shingle: int = 3, k: int = 2, seed: int = 42) -> DataFrame:
    """The rows of ``docs``, all columns as they were, that have the smallest id of their near-duplicate group.

    Rows that repeat an id stay together; rows without an id stay.
    """
    verdict = near_duplicates(docs.where(F.col("doc_id").isNotNull()), shingle, k, seed)
    gone = verdict.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(small_side(gone, "copies"), "doc_id", "left_anti").select(*docs.columns)
