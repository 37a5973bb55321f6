"""Spelling variants of a vocabulary: words one edit apart, found by pivotal grams.

Bigrams are ordered by how many words hold them, rare ones first. The *prefix* of a word is its three first bigrams in
that order (two edits' worth and one, as one edit touches two bigrams), and those that tie with the third. Its *pivots*
are the two disjoint bigrams of the prefix that the fewest words hold. One edit leaves one of two disjoint bigrams
as it is; and if the prefix of ``a`` doesn't reach further in the order than that of ``b``, whatever ``b`` holds of the
bigrams of ``a``'s prefix is in its own. So of two near words one has a pivot in the other's prefix, at the same place or
moved by the difference of the lengths.

With a pivot that the edit has left, either all before it is equal or all behind it, and of the other side one half. What
is equal (about half of the word at least) goes into the index beside place and length, so that lists are short
however many words share a bigram; nothing is lost by it. Every met pair is verified by its edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marajo.llm.arrow import as_bytes, small_batches, steps
from marajo.session import stash

#: Maximal runs of these letters are words; A-Z are lower-cased.
LETTERS = "A-Za-zÀ-ÿ"
#: Shorter words have too few bigrams for three of them in a prefix to be worth it.
MIN_LENGTH = 5
#: Distinct words that a task counts before it reports them.
HELD_WORDS = 200_000
#: Bigrams are told apart by their CRC-32 modulo this, so that their order is a small table whatever the alphabet; two
#: that fall together count as one, which only lengthens lists.
BIGRAMS = 1 << 14

_LOWER = bytes(c + 32 if ord("A") <= c <= ord("Z") else c for c in range(256))
#: Sides of a word of this many code points or fewer aren't halved.
SHORT_SIDE = 3


def _counted(every: int | None):
    runs = re.compile(f"[{LETTERS}]{{{MIN_LENGTH},}}")

    def report(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for part in steps(batch, "text"):
                for doc_id, text in zip(part.column("id").to_pylist(), as_bytes(part.column("text")), strict=True):
                    before = zlib.crc32(f"{doc_id}:".encode())
                    for run, n in Counter(runs.findall(text.translate(_LOWER).decode())).items():
                        if every and (h := zlib.crc32(run.encode(), before)) % every == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                        held[run] += n
                if len(held) > HELD_WORDS:
                    yield report(held)
                    held = Counter()
        yield report(held)

    return count


def vocabulary(docs: DataFrame, every: int | None = None, least: int = 3) -> DataFrame:
    """``word`` and ``n`` of every word of five letters or more with ``least`` occurrences in all texts.

    ``every`` plants slips: a run loses the code point ``h % length`` where ``every`` divides ``h``, the CRC-32 of
    ``<doc_id>:<run>`` (a null id is the text ``null``). Null and empty texts have no words; rows that repeat count each
    time; other columns aren't read. Tasks count before the exchange.
    """
    texts = docs.where(F.col("text").isNotNull()).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"), "text")
    counted = small_batches(texts).mapInArrow(_counted(every), "word string, n long")
    return counted.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def disjoint_pair(places: list[tuple[int, int]]) -> tuple[int, int]:
    """The two places at least two apart of the smallest total cost; ``places`` are (place, cost) by place.

    ``one`` is the cheapest single place that ends before the present one, ``two`` the cheapest pair so far; each place
    either closes a pair with ``one`` or is left out. Equal costs go to the pair that is complete first.
    """
    one, two, waiting = None, None, []
    for place, cost in places:
        while waiting and waiting[0][1] <= place - 2:
            one = min(one, waiting.pop(0)) if one else waiting.pop(0)
        if one and (two is None or one[0] + cost < two[0]):
            two = (one[0] + cost, one[1], place)
        waiting.append((cost, place))
    return two[1], two[2]


def _kept(n: Column, p: Column, m: Column, q: Column) -> tuple[Column, Column, Column, Column]:
    """What ``word`` (of length ``m``, with the bigram at ``q``) has in common with any word of length ``n`` that has the bigram at
    ``p`` and is one edit away: if the edit is behind the bigram all up to it and the first or second half of the rest, if it
    is before it likewise. Null where it can't be. Sides of ``SHORT_SIDE`` are left out whole."""
    word, rest = F.col("word"), n - p - 2
    half = F.when(rest <= SHORT_SIDE, 0).otherwise(F.floor(rest / 2)).cast("int")
    tail = rest - half
    key = lambda name, *kept: F.xxhash64(F.lit(name), n, p, *kept)
    behind = key("a", F.substring(word, F.lit(1), p + 2 + half))
    behind_too = F.when((rest > SHORT_SIDE) & (tail <= m - q - 2), key("b", F.substring(word, F.lit(1), p + 2), F.substring(word, m - tail + 1, tail)))
    lost = F.when(p <= SHORT_SIDE, p).otherwise(F.floor(p / 2)).cast("int")
    before = F.when(p - lost <= q, key("c", F.substring(word, q - (p - lost) + 1, m)))
    before_too = F.when((p > SHORT_SIDE) & (lost <= q), key("d", F.substring(word, F.lit(1), lost), F.substring(word, q + 1, m)))
    return behind, behind_too, before, before_too


def prefix_and_pivots(word: str, order: dict[int, tuple[int, int]]) -> tuple[list[int], tuple[int, int], int]:
    """Places of the prefix and of the two pivots, and how far the prefix reaches in the order. ``order`` gives each
    bigram's place in the order and the number of words that hold it."""
    grams = [zlib.crc32(word[i : i + 2].encode()) % BIGRAMS for i in range(len(word) - 1)]
    reach = sorted(order[g][0] for g in grams)[2]
    prefix = [i for i, g in enumerate(grams) if order[g][0] <= reach]
    return prefix, disjoint_pair([(i, order[grams[i]][1]) for i in prefix]), reach


def _chosen(order: dict[int, tuple[int, int]]):
    """Adds the places of every word's prefix and pivots, and the prefix's reach."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [prefix_and_pivots(w, order) for w in batch.column("word").to_pylist()]
            prefixes, pivots, reaches = zip(*rows, strict=True) if rows else ((), (), ())
            lists = pa.list_(pa.int32())
            made = [pa.array(prefixes, lists), pa.array(pivots, lists), pa.array(reaches, pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), *made], ["word", "n", "prefix", "pivots", "reach"])

    return choose


def near_words(vocab: DataFrame) -> DataFrame:
    """``a``, ``b``, ``b_n``: every two different words of ``vocab`` (``word``, ``n``) that one inserted, deleted or replaced code
    point turns into each other, in both directions, and the second one's ``n``; the rows of an ``a`` are in one partition.

    Words shorter than five code points and nulls are left out; a word that repeats must have one ``n``. The letters may be
    any: the order of ``BIGRAMS`` bigrams at most is the only thing held whole.
    """
    words = stash(vocab.where(F.length("word") >= MIN_LENGTH).select("word", "n"), "words")
    bigram = lambda i: F.crc32(F.substring("word", i, F.lit(2)).cast("binary")) % BIGRAMS
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("word") - 1), bigram))
    held = words.select(F.explode(grams).alias("gram")).groupBy("gram").count().orderBy("count", "gram").collect()
    order = {r["gram"]: (i, r["count"]) for i, r in enumerate(held)}
    chosen = stash(words.mapInArrow(_chosen(order), "word string, n long, prefix array<int>, pivots array<int>, reach int"), "chosen")
    m, p, q, longer = F.length("word"), F.col("p"), F.col("q"), F.col("longer")

    pivots = chosen.select("word", "n", "reach", F.explode("pivots").alias("p"))
    pivots = pivots.select(F.struct("word", "n", "reach").alias("a"), F.explode(F.array(*_kept(m, p, m, p))).alias("key"))
    probes = chosen.select("word", "n", "reach", F.explode("prefix").alias("q")).withColumn("longer", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
    other = m + longer
    same, moved = _kept(other, q, m, q)[:2], _kept(other, q + longer, m, q)[2:]
    fits = lambda at, keys: [F.when((other >= MIN_LENGTH) & (at >= 0) & (at <= other - 2), k) for k in keys]
    probes = probes.select(F.struct("word", "n", "reach").alias("b"), F.explode(F.array(*fits(q, same), *fits(q + longer, moved))).alias("key"))
    # Spark takes an exploded table for as large as the one before, and would send it through the driver
    met = pivots.where(F.col("key").isNotNull()).join(probes.where(F.col("key").isNotNull()).hint("merge"), "key")
    near = met.where((F.col("a.reach") <= F.col("b.reach")) & (F.col("a.word") != F.col("b.word"))).where(F.levenshtein("a.word", "b.word", 1) == 1)
    way = lambda a, b: F.struct(F.col(f"{a}.word").alias("a"), F.col(f"{b}.word").alias("b"), F.col(f"{b}.n").alias("b_n"))
    return near.select(F.inline(F.array(way("a", "b"), way("b", "a")))).repartition("a").distinct()


def spelling_forms(vocab: DataFrame, times: int = 2) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every row of ``vocab`` (``word``, ``n``; one row a word).

    ``form`` is the near word with the largest ``n`` (ties: the smallest in code-point order) if that is ``times`` the word's
    own or more, else null; ``root`` is where following forms ends. Following is by doubling, each round a join of the words
    that still move, so rounds grow with the logarithm of the longest chain, which is itself one of the largest ``n``.
    """
    vocab = stash(vocab.select("word", "n"), "vocabulary")
    best = near_words(vocab).groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("near"))).alias("best"))
    joined = vocab.join(best.hint("merge"), "word", "left")  # neither side is bounded, nor in any join below
    takes = -F.col("best.less") >= times * F.col("n")
    formed = stash(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(takes, F.col("best.near")).alias("form"), F.when(takes, -F.col("best.less")).alias("form_n")),
        "forms",
    )
    steps_ = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        onward = steps_.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stash(steps_.join(onward.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        steps_ = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    found = formed.join(steps_.hint("merge"), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
