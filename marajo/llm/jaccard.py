"""Near-dedup by exact Jaccard similarity of word shingles, over operator 1's index of SimHash fingerprints and MinHash bands.

A text is the set of its shingles; equal sets are one node. Its fingerprint is the SimHash of the set, and the nodes whose
fingerprints the byte-position index of ``simhash`` links, by ``BITS`` bits or fewer from one to the next, form a list. At a
similarity of 0.8 some ten of 64 bits differ, which no positional byte survives for certain, so ``BANDS`` keys of ``ROWS``
minima each post a node too, for the rest: two sets of similarity ``s`` meet in a list of a band with chance
``1 - (1 - s**ROWS)**BANDS``, which is 0.999997 at 0.8 and more above. Whatever is met, by fingerprint or by band, is
verified by the exact similarity of the two sets.

A list isn't paired up at once, which would be quadratic in a group of near copies. Its members are first compared
with ``HEADS`` of them, the same in all lists that hold them, and linked; only lists that the links so far leave in
several components are then compared whole, part against part, each two parts inside one task that reports no more
than a spanning forest. That leaves the components of comparing all pairs of a list.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marajo.llm import simhash
from marajo.llm.arrow import as_bytes, lists, small_batches, steps
from marajo.llm.graph import connected_components
from marajo.llm.shared import possibly_in
from marajo.session import BROADCAST_ROWS, small_side, stash

#: Ids that are sent to every executor; beyond, a bitmap of them is, and texts still stay where they lie.
FEW_IDS = BROADCAST_ROWS
ROWS, BANDS, HEADS = 4, 24, 3
#: Bits in which the fingerprints of two sets that the index links differ at most, as in operator 1.
BITS = 2
#: Shingles of the sets that one part of a list holds, on average; a shingle takes 8 bytes.
PART = 1 << 15
#: Sets that one part holds, on average: two parts are compared by a matrix of all their sets.
PART_SETS = 512
#: Sets up to which a shingle's holders are paired directly, and columns of a matrix product beyond.
SPARSE, COLUMNS = 12, 4096
_U = np.uint64
_M1, _M2, _M3 = (_U(x) for x in (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))
_ODD, _ADD = np.random.default_rng(42).integers(0, 1 << 64, (2, ROWS * BANDS), np.uint64)
_ODD |= _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _M2
    x = (x ^ (x >> _U(29))) * _M3
    return x ^ (x >> _U(32))


def shingles(text: bytes, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words (of the whole text if it is shorter); none without words."""
    digest = xxhash.xxh64_intdigest
    words = text.lower().split()
    size = max(1, min(size, len(words)))
    n = len(words) - size + 1
    hashed = np.fromiter(map(digest, words), np.uint64, len(words))
    made = np.full(max(n, 0), size, np.uint64)
    for i in range(size):
        made = _mix(made * _M1 + hashed[i : i + len(made)])
    return np.unique(made)


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """The band keys of each non-empty set, a row each."""
    flat, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    keys = np.empty((len(sets), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(sets), band, np.uint64)
        for i in range(band * ROWS, (band + 1) * ROWS):
            key = _mix(key * _M1 + np.minimum.reduceat(flat * _ODD[i] + _ADD[i], starts))
        keys[:, band] = key
    return keys


def _node(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes())


def sketches(docs: DataFrame, size: int = 5) -> DataFrame:
    """``doc_id``, ``node`` (hash of the set of shingles), ``n`` (its size), ``fp`` (its SimHash) and ``bands`` of each row; a null
    text has no words."""

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                sets = [shingles(t or b"", size) for t in as_bytes(part.column("text"))]
                full = [s for s in sets if len(s)]
                keys = bands(full) if full else np.zeros((0, BANDS), np.uint64)
                ends = np.append(0, np.cumsum([BANDS * (len(s) > 0) for s in sets]))
                node = np.array([_node(s) for s in sets], np.uint64).view(np.int64)
                n = np.array([len(s) for s in sets], np.int32)
                fp = np.array([simhash.majority(s) for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(node), pa.array(n), pa.array(fp), lists(keys.reshape(-1).view(np.int64), ends, pa.int64())],
                    names=["doc_id", "node", "n", "fp", "bands"],
                )

    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(scan, "doc_id long, node long, n int, fp long, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``node`` and ``shingles`` of the rows that ``wanted`` (``doc_id``, ``node``) names."""

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                sets = [shingles(t or b"", size) for t in as_bytes(part.column("text"))]
                ends = np.append(0, np.cumsum([len(s) for s in sets]))
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                node = np.array([_node(s) for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(node), lists(flat, ends, pa.int64())], names=["doc_id", "node", "shingles"])

    held = small_side(wanted, "wanted", FEW_IDS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # texts are cut where they lie; the join behind takes out what the bitmap lets pass
    rows = rows.join(held.select("doc_id"), "doc_id", "left_semi") if held.count() <= FEW_IDS else possibly_in(rows, "doc_id", held)
    made = rows.mapInArrow(scan, "doc_id long, node long, shingles array<long>")
    return made.join(held, ["doc_id", "node"], "left_semi").select("node", "shingles")


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (``a``, ``b``) whose sets share at least ``percent`` per cent of their union."""
    own = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    both = own.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")

    def scan(batches):
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("sa", "sb"))
            common = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b, strict=True)], np.int64)
            union = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)], np.int64) - common
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(100 * common >= percent * union))

    return both.select("a", "b", "sa", "sb").mapInArrow(scan, "a long, b long").distinct()


def _alike(full: DataFrame) -> DataFrame:
    """``node``, ``n`` and ``key`` of each set: a list for each group of sets whose fingerprints operator 1's index links."""
    group = connected_components(simhash.links(full.select("fp"), BITS)).withColumnRenamed("node", "fp")
    named = full.select("node", "n", "fp").join(group, "fp", "left")
    return named.select("node", "n", F.xxhash64(F.lit("fp"), F.coalesce("label", "fp")).alias("key"))


def links(docs: DataFrame, first: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Edges ``a``, ``b`` between nodes that join all met pairs of similarity ``percent`` per cent or more.

    ``first`` has ``node``, ``first_id``, ``n``, ``fp`` and ``bands`` of each distinct set of ``docs``.
    """
    # of two sets that differ, the smaller one needs this many shingles to be similar enough
    full = first.where(F.col("n") * (100 - percent) >= percent)
    posted = _alike(full).unionByName(full.select("node", "n", F.explode("bands").alias("key")))
    order = [F.struct(F.xxhash64("node", F.lit(i)).alias("h"), "node", "n") for i in range(HEADS)]
    heads = posted.groupBy("key").agg(F.count(F.lit(1)).alias("met"), F.array(*[F.min(o) for o in order]).alias("heads")).where("met > 1")
    met = stash(posted.join(heads, "key").select("key", "node", "n", "heads"), "met")
    fits = lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y)
    a, b = F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")
    star = met.select(F.col("node").alias("x"), "n", F.explode("heads").alias("h")).select("x", "n", F.col("h.node").alias("y"), F.col("h.n").alias("m"))
    star = stash(star.where((F.col("x") != F.col("y")) & fits(F.col("n"), F.col("m"))).select(a, b).distinct(), "star")
    nodes = met.select("node").distinct()
    sets = stash(_sets(docs, first.join(nodes, "node", "left_semi").select(F.col("first_id").alias("doc_id"), "node"), size), "sets")
    edges = stash(_similar(star, sets, percent), "edges")
    label = connected_components(edges)
    labelled = met.join(label, "node", "left").select("key", "node", "n", F.coalesce("label", "node").alias("label"))
    return edges.unionByName(_unresolved(stash(labelled, "labelled"), sets, percent))


def _unresolved(labelled: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges that join the similar nodes of every list which still holds several labels.

    Lists of the same nodes are taken once. A list is dealt into parts of about ``PART`` shingles or ``PART_SETS`` sets, and every two parts
    meet as one row, whose sets are compared in the task: no pair of nodes is ever a row, and a list of any size is
    compared whole in pieces of bounded size.
    """
    mixed = F.xxhash64("node")
    told = labelled.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("size"),
        F.bit_xor(mixed).alias("x"), F.sum(mixed.bitwiseAND(F.lit(0xFFFFFFFF))).alias("s"),
    ).where("low < high")
    own = told.groupBy("size", "total", "x", "s").agg(F.min("key").alias("key"))
    parts = F.ceil(F.greatest(F.col("total") / PART, F.col("size") / PART_SETS)).cast("int")
    rows = labelled.join(own.select("key", parts.alias("parts")), "key")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("key", "node"), F.col("parts")).cast("int"))
    rows = rows.select("key", "node", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    rows = rows.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "node")
    blocks = rows.join(sets, "node").groupBy("key", "i", "j").agg(F.collect_list("node").alias("nodes"), F.collect_list("shingles").alias("sets"))

    def scan(batches):
        for batch in batches:
            for nodes, held in zip(batch.column("nodes"), batch.column("sets"), strict=True):
                ids = nodes.values.to_numpy(zero_copy_only=False)
                sizes = np.diff(held.values.offsets.to_numpy())
                a, b = forest(held.values.flatten().to_numpy(zero_copy_only=False), sizes, percent)
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])

    found = blocks.select("nodes", "sets").mapInArrow(scan, "a long, b long")
    return found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def common(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, which stand in a row in ``flat``."""
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    _, name, counts = np.unique(flat, return_inverse=True, return_counts=True)
    out = np.zeros((n, n), np.int64)
    dense = counts > SPARSE
    # what many sets hold: products of 0-1 matrices, some columns at a time
    column = np.cumsum(dense) - 1
    pick = dense[name]
    rows, cols = owner[pick], column[name[pick]]
    for low in range(0, int(dense.sum()), COLUMNS):
        inside = (cols >= low) & (cols < low + COLUMNS)
        held = np.zeros((n, min(COLUMNS, int(dense.sum()) - low)), np.float32)
        held[rows[inside], cols[inside] - low] = 1
        out += (held @ held.T).astype(np.int64)
    # what few hold: the pairs of its holders
    pick = ~dense[name] & (counts[name] > 1)
    order = np.argsort(name[pick], kind="stable")
    rows, held = owner[pick][order], name[pick][order]
    for step in range(1, min(SPARSE, len(held))):
        same = held[step:] == held[:-step]
        pair = rows[step:][same] * n + rows[:-step][same]
        add = np.bincount(pair, minlength=n * n).reshape(n, n)
        out += add + add.T
    np.fill_diagonal(out, sizes)
    return out


def forest(flat: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of edges that join all pairs of sets with a similarity of ``percent`` per cent or more: a spanning forest."""
    shared = common(flat, sizes)
    near = 100 * shared >= percent * (sizes[:, None] + sizes - shared)
    fresh = np.ones(len(sizes), bool)
    a, b = [], []
    for root in range(len(sizes)):
        if not fresh[root]:
            continue
        fresh[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            found = np.flatnonzero(near[at] & fresh).tolist()
            fresh[found] = False
            a += [at] * len(found)
            b += found
            queue += found
    return np.array(a, np.int64), np.array(b, np.int64)


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns as they were, that have the smallest id of their group of near copies.

    Texts are linked if their sets of ``size``-word shingles have Jaccard similarity of ``percent`` per cent or more;
    texts without words are copies of each other. Rows that repeat an id stay together; rows without an id stay.
    """
    known = docs.where(F.col("doc_id").isNotNull())
    made = stash(sketches(known, size), "sketches")
    held = [F.first(c).alias(c) for c in ("n", "fp", "bands")]
    first = stash(made.groupBy("node").agg(F.min("doc_id").alias("first_id"), *held), "nodes")
    labels = connected_components(links(known, first, size, percent))
    named = first.select("node", "first_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lowest = named.groupBy("label").agg(F.min("first_id").alias("kept_id"))
    named = named.join(lowest, "label").select("node", "kept_id")
    gone = made.select("doc_id", "node").join(named, "node").where(F.col("doc_id") != F.col("kept_id")).select("doc_id").distinct()
    gone = small_side(gone, "copies", FEW_IDS)
    if gone.count() <= FEW_IDS:
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    # most rows stay where they lie; those whose id may be gone are looked up
    doubtful = possibly_in(docs, "doc_id", gone).join(gone, "doc_id", "left_anti").select(*docs.columns)
    return possibly_in(docs, "doc_id", gone, negate=True).unionByName(doubtful)
