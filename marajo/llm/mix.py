"""Mixing sources to target weights by a splitting tree of multivariate hypergeometric draws.

Texts are cut into blocks of words. A source's blocks are put into a keyed order; what it gives to the mix is that order
from its start, once round and as far into a second round as its target goes, the last block cut so that the target is met
to the word. So a source has an exact quota of blocks. The quotas are dealt among output shards by a tree: a node
holds so many blocks of each source for a range of shards, its left half gets as many blocks of each as a multivariate
hypergeometric draw gives for the half's room, the right half the rest. A leaf is a shard's exact quota of every
source. Shards then take their blocks from each source's order one after the other, so no two share any, and every
shard puts its own into a keyed order of its own.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marajo.operators.ordered import positions
from marajo.session import small_side, stash

WORD = r"[^\x20\x09-\x0D]+"
#: Sources (or groups of them) that are dealt in one task.
FAN = 1024


@dataclass(frozen=True)
class Recipe:
    """``weights`` are dealt to sources in order, again and again; the mix has ``share`` of all words, a source at most
    ``most`` times its own. ``words`` is the length of a block."""

    weights: tuple[float, ...] = (3, 1, 2)
    share: float = 1.5
    most: int = 2
    words: int = 512
    shards: int = 64
    seed: int = 42


@dataclass(frozen=True)
class Mix:
    """``sizes``: a row per document (``row``, ``doc_id``, ``source``, ``size``); ``targets``: a row per source; ``draws``: a
    row per block that the mix takes, with the document's ``row``, the block's first word ``start``, ``taken`` words, its
    ``round``, ``shard`` and the key ``place`` that orders it in the shard."""

    sizes: DataFrame
    targets: DataFrame
    draws: DataFrame


def sizes(docs: DataFrame) -> DataFrame:
    """Words of every whole text; a null text has none. Other columns aren't read."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "source", words.alias("size"), text_hash.alias("text_hash"))


def targets(sized: DataFrame, recipe: Recipe) -> DataFrame:
    """``source``, ``pos``, ``source_size``, ``target`` and ``quota`` (the target in whole words) of every source.

    Sources are in order of code point, null last. The level ``rate`` (words per weight) is raised until the words that
    capped sources leave are shared out: each round finds the sources whose part exceeds their cap and divides what is left
    by the weights of the others, and the rounds end when no other exceeds it. Rounds are counts over a row per source.
    """
    by = stash(sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("unnamed", F.col("source").isNull()), "by-source")
    ranked = positions(by, [], ["unnamed", "source"])
    n = len(recipe.weights)
    weights = F.array(*[F.lit(float(w)) for w in recipe.weights])
    held = stash(ranked.select("source", "pos", "source_size", F.element_at(weights, (F.col("pos") % n + 1).cast("int")).alias("weight"), (F.col("source_size") * recipe.most).alias("cap")), "weights")
    total = recipe.share * (held.agg(F.sum("source_size")).first()[0] or 0)
    rate, capped = 0.0, -1
    over = F.lit(False)
    while True:
        got = held.agg(F.sum(F.when(over, F.col("cap"))).alias("cap"), F.sum(F.when(~over, F.col("weight"))).alias("weight"), F.count_if(over).alias("n")).first()
        if got.n == capped:
            break
        capped = got.n
        rate = (total - (got.cap or 0)) / got.weight if got.weight else math.inf
        over = F.col("weight") * F.lit(rate) > F.col("cap")
    part = F.when(over, F.col("cap").cast("double")).otherwise(F.col("weight") * F.lit(rate))
    return held.select("source", "pos", "source_size", part.alias("target"), F.floor(part + 0.5).cast("long").alias("quota"))


def _key(recipe: Recipe, *values: Column) -> Column:
    """Sixteen hex digits of the hash of seed and values; null is the text ``null``."""
    text = F.concat_ws("|", F.lit(str(recipe.seed)), *[F.coalesce(v.cast("string"), F.lit("null")) for v in values])
    return F.substring(F.md5(text.cast("binary")), 1, 16)


def _blocks(sized: DataFrame, recipe: Recipe) -> DataFrame:
    """Blocks in the order of their source, with the words before them in it (``before``) and their number (``of``)."""
    last = F.floor((F.col("size") - 1) / recipe.words).cast("int")
    cut = sized.where(F.col("size") > 0).select("row", "doc_id", "source", "size", F.explode(F.sequence(F.lit(0), last)).alias("block"))
    start = F.col("block").cast("long") * recipe.words
    keyed = cut.select("row", "doc_id", "source", "block", start.alias("start"), F.least(F.lit(recipe.words), F.col("size") - start).cast("long").alias("words"), _key(recipe, F.col("doc_id"), F.col("block")).alias("key"))
    return positions(stash(keyed, "blocks"), ["source"], ["key", "doc_id", "block", "row"], weight="words")


def _uniform(*key) -> float:
    """A number between 0 and 1 from the hash of ``key``."""
    return (int.from_bytes(hashlib.blake2b("|".join(map(str, key)).encode(), digest_size=8).digest(), "big") + 0.5) / 2**64


def hypergeometric(good: int, bad: int, draws: int, u: float) -> int:
    """The number of good ones among ``draws`` of ``good + bad``, by inverting the distribution at ``u``.

    Its ratios are summed outward from the mode as far as twelve deviations, beyond which less lies than a double can
    tell from nothing, so counts may be as large as doubles hold whole.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    n = good + bad
    mode = (draws + 1) * (good + 1) // (n + 2)
    deviation = math.sqrt(draws * (good / n) * (bad / n) * ((n - draws) / max(1, n - 1)))
    reach = int(12 * deviation) + 40
    a, b = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(a, b, dtype=np.float64)
    ratio = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    log_p = np.concatenate([[0.0], np.cumsum(ratio)])
    below = np.cumsum(np.exp(log_p - log_p.max()))
    return min(b, a + int(np.searchsorted(below, u * below[-1])))


def deal(quotas: list[int], rooms: list[int], seed, names: list) -> np.ndarray:
    """What each of ``rooms`` gets of each of ``quotas``, which add up to the same: rows are quotas, columns rooms.

    Recursively, the left half of a range of rooms gets of each quota as many as a draw without replacement gives; the
    draw for one quota is hypergeometric among it and those after it. Numbers come from ``seed``, the range and the
    quota's name, so they don't depend on who deals.
    """
    dealt = np.zeros((len(quotas), len(rooms)), dtype=np.int64)
    before = np.concatenate([[0], np.cumsum(np.array(rooms, dtype=np.int64))])

    def split(low: int, high: int, held: list[int]) -> None:
        if high - low == 1:
            dealt[:, low] = held
            return
        middle = (low + high) // 2
        room, rest, left = int(before[middle] - before[low]), sum(held), []
        for name, own in zip(names, held, strict=True):
            rest -= own
            left.append(hypergeometric(own, rest, room, _uniform(seed, low, high, name)) if own and room else 0)
            room -= left[-1]
        split(low, middle, left)
        split(middle, high, [a - b for a, b in zip(held, left, strict=True)])

    split(0, len(rooms), list(quotas))
    return dealt


def _deal_rows(seed: int):
    def deal_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                names = [x["pos"] for x in r["items"]]
                parts = deal([x["quota"] for x in r["items"]], r["rooms"], f"{seed}|{r['level']}", names)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array([list(p) for p in parts.tolist()], pa.list_(pa.int64()))], ["pos", "rooms"])

    return deal_out


def shard_quotas(quotas: DataFrame, n_shards: int, seed: int = 42) -> DataFrame:
    """``pos`` and ``rooms`` (blocks for each shard) from ``pos`` (0, 1, ...) and ``quota`` of every source; shards get equal
    numbers of blocks, or one more.

    Beyond ``FAN`` sources, ``FAN`` consecutive ones are dealt as one, and what each shard has of these is dealt among
    them by a tree of their own, which is the same distribution; so a task holds ``FAN`` sources, however many there are.
    """
    levels = [quotas.select("pos", "quota")]
    top = levels[0].agg(F.max("pos").alias("last"), F.sum("quota").alias("all")).first()
    last, blocks = top["last"] or 0, top["all"] or 0
    while last >= FAN:
        last //= FAN
        levels.append(levels[-1].groupBy(F.floor(F.col("pos") / FAN).alias("pos")).agg(F.sum("quota").alias("quota")))
    even = [blocks // n_shards + (k < blocks % n_shards) for k in range(n_shards)]
    above = levels[0].sparkSession.createDataFrame([(0, even)], "node long, rooms array<long>")
    for level in reversed(range(len(levels))):
        items = levels[level].groupBy(F.floor(F.col("pos") / FAN).alias("node")).agg(F.sort_array(F.collect_list(F.struct("pos", "quota"))).alias("items"))
        rows = items.join(above, "node").select("items", "rooms", F.lit(level).alias("level"))
        above = rows.mapInArrow(_deal_rows(seed), "pos long, rooms array<long>").select(F.col("pos").alias("node"), "rooms")
    return above.select(F.col("node").alias("pos"), "rooms")


def _shard_of(index: Column, starts: Column, n: int) -> Column:
    """The last of the ascending ``starts`` that isn't above ``index``, looked for in steps and then within one."""
    step = max(1, math.isqrt(n))
    coarse = F.filter(F.sequence(F.lit(0), F.lit(n - 1), F.lit(step)), lambda k: F.get(starts, k) <= index)
    first = F.element_at(coarse, -1)
    return first + F.size(F.filter(F.slice(starts, first + 1, step), lambda s: s <= index)) - 1


def mix(docs: DataFrame, recipe: Recipe = Recipe()) -> Mix:
    """The mix of ``docs`` (``doc_id``, ``source``, ``text``) by ``recipe``; see ``Mix``.

    Every source gives its target to the nearest word, a document at most ``most`` times its words. Null and empty texts
    give nothing; a null source is one; rows that repeat are drawn each by itself; null ids are one key, told apart by their
    row. An empty table gives an empty mix. The order of blocks and shards depends on seed, id and block alone, except
    among rows that share an id. Nothing but rows of sources and of shards is broadcast, by a count; no source is
    ever one task.
    """
    sized = stash(sizes(docs), "sizes")
    aims = stash(targets(sized, recipe), "targets")
    aim = aims.select(F.struct("source").alias("whose"), "pos", "source_size", "quota")
    blocks = _blocks(sized, recipe).withColumnRenamed("pos", "rank").join(small_side(aim, "aims"), F.struct("source").eqNullSafe(F.col("whose")))
    ahead = lambda r: F.col("quota") - r.cast("long") * F.col("source_size") - F.col("before")
    rounds = F.filter(F.sequence(F.lit(0), F.lit(recipe.most - 1)), lambda r: ahead(r) > 0)
    drawn = blocks.select("row", "doc_id", "block", "start", "words", "rank", "of", "pos", "quota", "source_size", "before", F.explode(rounds).alias("round"))
    drawn = drawn.select("row", "doc_id", "block", "start", F.least("words", ahead(F.col("round"))).alias("taken"), "round", "pos", (F.col("round") * F.col("of") + F.col("rank")).alias("index"))
    drawn = stash(drawn, "drawn")
    counts = stash(drawn.groupBy("pos").agg(F.count(F.lit(1)).alias("quota")), "counts")
    # sources that give nothing leave gaps, which only make a task's group smaller
    rooms = shard_quotas(counts, recipe.shards, recipe.seed)
    sums = F.aggregate("rooms", F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    starts = small_side(rooms.select("pos", sums.alias("starts")), "starts", max(1, 2_000_000 // recipe.shards))
    dealt = drawn.join(starts, "pos").withColumn("shard", _shard_of(F.col("index"), F.col("starts"), recipe.shards))
    placed = dealt.select("row", "doc_id", "block", "start", "taken", "round", "shard", _key(recipe, F.lit("place"), F.col("shard"), F.col("doc_id"), F.col("block"), F.col("round")).alias("place"))
    return Mix(sized, aims, stash(placed, "draws"))


def per_document(made: Mix) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` (words that the shards take, repeats counted)."""
    taken = made.draws.where(F.col("shard").isNotNull()).groupBy("row").agg(F.sum("taken").alias("taken"))
    aims = small_side(made.targets.select(F.struct("source").alias("whose"), "source_size", "target"), "aims")
    joined = made.sizes.join(taken, "row", "left").join(aims, F.struct("source").eqNullSafe(F.col("whose")))
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_texts(docs: DataFrame, made: Mix) -> DataFrame:
    """``shard``, ``place``, ``doc_id`` and ``text`` of every block drawn, each shard's in its own order inside one
    partition: the shuffle is local. Words are joined by one space.

    Texts are matched by id and hash, so each is moved once however often it is drawn.
    """
    own = made.draws.join(made.sizes.select("row", "text_hash"), "row")
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text").dropDuplicates(["doc_id", "text_hash"])
    one = lambda i, h: F.struct(i, h)
    texts = held.select(one("doc_id", "text_hash").alias("which"), "text")
    parts = own.withColumn("wanted", one("doc_id", "text_hash")).drop("doc_id").join(texts, F.col("wanted").eqNullSafe(F.col("which")))
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), (F.col("start") + 1).cast("int"), F.col("taken").cast("int"))
    cut = parts.select("shard", "place", F.col("which.doc_id").alias("doc_id"), F.array_join(words, " ").alias("text"))
    return cut.repartition("shard").sortWithinPartitions("shard", "place")
