"""Substring dedup by recompression.

Words are named by hash, and rounds replace runs of equal symbols, then adjacent pairs of a left and a right
symbol, by new names hashed from what they replace. Names depend on content alone, so the naming is global
without any exchange, and equal stretches of words get equal symbols inside, whatever surrounds them. For every
symbol the *context* is kept: the words that decided it. A window of ``window`` words that holds a symbol's context
holds that symbol wherever the window occurs.

So a window can repeat only where all symbols of its level are shared: the level is the highest at which the
window holds a context (single words hold their own, so there always is one). Shared symbols are found in one
exchange; where all of a window's symbols are shared the window's words are compared by a hash of 95 bits in a
second one, and what survives is removed. Rounds run inside each text; Spark exchanges and verifies.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marajo.llm.arrow import as_bytes, lists, small_batches, steps
from marajo.session import stash

ROUNDS = 8
STEP = 3 << 20

_U = np.uint64
_M1, _M2, _M3, _M4, _M5 = (_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x165667B19E3779F9))
#: Odd multipliers of the two rolling hashes, and their inverses modulo 2**64.
_ROLL = tuple((m, pow(m, -1, 1 << 64)) for m in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _M3
    x = (x ^ (x >> _U(29))) * _M4
    return x ^ (x >> _U(32))


class Words:
    """Hashed words of several texts in a row, one separator before each text and one at the end."""

    def __init__(self, texts: list[bytes | None]):
        self.words = [t.split() if t else [] for t in texts]
        self.sizes = np.fromiter(map(len, self.words), np.int64, len(texts))
        self.first = 1 + np.cumsum(self.sizes + 1) - (self.sizes + 1)
        total = int(self.sizes.sum()) + len(texts) + 1
        self.text_of = np.repeat(np.arange(len(texts)), self.sizes + 1)
        self.text_of = np.append(self.text_of, len(texts) - 1)
        self.gap = np.zeros(total, bool)
        self.gap[np.append(self.first - 1, total - 1)] = True
        self.hash = np.empty(total, _U)
        flat = (xxhash.xxh64_intdigest(w) for words in self.words for w in words)
        self.hash[~self.gap] = np.fromiter(flat, _U, int(self.sizes.sum()))
        self.hash[self.gap] = _mix(np.arange(int(self.gap.sum())).astype(_U) * _M5 + _M1)

    def windows(self, window: int) -> np.ndarray:
        """Mask of the positions at which a window starts."""
        place = np.arange(len(self.hash))
        last = (self.first + self.sizes - window)[self.text_of]
        return ~self.gap & (place <= last)

    def rolled(self, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes (64 and 32 bits) of the windows that start at ``at``."""
        out = []
        for (power, inverse), salt in zip(_ROLL, (_U(0), _M2), strict=True):
            x = self.hash if not salt else _mix(self.hash ^ salt)
            n = len(x)
            with np.errstate(over="ignore"):
                up = np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, _U(power))]))
                down = np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, _U(inverse))]))
                sums = np.concatenate([[_U(0)], np.cumsum(x * up)])
                out.append(_mix((sums[at + window] - sums[at]) * down[at]))
        return out[0], (out[1] >> _U(33)).astype(np.int32)


class Level:
    """Symbols in a row: name, words [start, end), context [low, high); separators take part as gaps."""

    def __init__(self, name, start, end, low, high, gap):
        self.name, self.start, self.end, self.low, self.high, self.gap = name, start, end, low, high, gap

    @staticmethod
    def words(w: Words) -> Level:
        place = np.arange(len(w.hash))
        return Level(w.hash, place, place + 1, place, place + 1, w.gap)

    def runs(self, w: Words) -> Level:
        """Runs of equal symbols become one symbol named after the symbol and the run's length.

        That a neighbour differs is certain from one word if its nearest end isn't the symbol's, else from its
        whole context.
        """
        head = np.append(True, self.name[1:] != self.name[:-1])
        first = np.flatnonzero(head)
        count = np.diff(np.append(first, len(self.name)))
        last = first + count - 1
        name = self.name[first]
        name = np.where(count > 1, _mix(name * _M1 + count.astype(_U) * _M2), name)
        start, end, low, high = self.start[first], self.end[last], self.low[first].copy(), self.high[last].copy()
        inner = np.arange(1, len(first))
        plain = w.hash[start[inner] - 1] != w.hash[self.end[first[inner]] - 1]
        low[inner] = np.minimum(low[inner], np.where(plain, start[inner] - 1, self.low[first[inner] - 1]))
        inner -= 1
        plain = w.hash[end[inner]] != w.hash[self.start[last[inner]]]
        high[inner] = np.maximum(high[inner], np.where(plain, end[inner] + 1, self.high[last[inner] + 1]))
        return Level(name, start, end, low, high, self.gap[first])

    def pairs(self, salt: int) -> Level:
        """A symbol of the left kind and the next, if of the right kind, become one; the kind is a bit of the name.

        What isn't paired owes it to one neighbour's kind, so to that neighbour's context.
        """
        right = (_mix(self.name + np.full(1, salt, _U) * _M5) >> _U(63)).astype(bool)
        opens = np.append(~right[:-1] & right[1:] & ~self.gap[:-1] & ~self.gap[1:], False)
        closes = np.append(False, opens[:-1])
        low, high = self.low.copy(), self.high.copy()
        alone = ~opens & ~closes
        alone_left = np.flatnonzero(alone & ~right)
        alone_left = alone_left[alone_left < len(high) - 1]
        high[alone_left] = np.maximum(high[alone_left], self.high[alone_left + 1])
        alone_right = np.flatnonzero(alone & right)
        alone_right = alone_right[alone_right > 0]
        low[alone_right] = np.minimum(low[alone_right], self.low[alone_right - 1])
        name, end = self.name.copy(), self.end.copy()
        i = np.flatnonzero(opens)
        name[i] = _mix(self.name[i] * _M2 + _mix(self.name[i + 1] ^ _M1))
        end[i], high[i] = self.end[i + 1], self.high[i + 1]
        kept = ~closes
        return Level(name[kept], self.start[kept], end[kept], low[kept], high[kept], self.gap[kept])


def symbols(w: Words, window: int, rounds: int = ROUNDS):
    """For each level that some window needs, from the highest: mask of its windows, and name, first and last
    window start of each symbol whose context some of them hold."""
    levels = [Level.words(w)]
    for k in range(rounds):
        levels.append(levels[-1].runs(w).pairs(k + 1))
    open_ = w.windows(window)
    for k in range(rounds, -1, -1):
        if not open_.any():
            return
        level = levels.pop()
        text = w.text_of[level.start]
        low = np.maximum(level.high - window, w.first[text])
        high = np.minimum(level.low, w.first[text] + w.sizes[text] - window)
        needed = np.append(0, np.cumsum(open_))
        use = ~level.gap & (low <= high)
        use[use] = needed[high[use] + 1] > needed[low[use]]
        low, high = low[use], high[use]
        mine = open_ & spread(low, high, len(open_))
        name = _mix(level.name[use] ^ _U(k + 1)).view(np.int64)
        yield mine, name, low, high
        open_ = open_ & ~mine


def spread(low: np.ndarray, high: np.ndarray, size: int) -> np.ndarray:
    """Mask of the positions within any of the intervals, ends included."""
    depth = np.bincount(low, minlength=size + 1) - np.bincount(high + 1, minlength=size + 1)[: size + 1]
    return np.cumsum(depth)[:size] > 0


class Seen:
    """The least id that a task has met a hash with, for up to ``limit`` hashes that it met with several ids.

    Later steps of the task settle such a hash on the spot, so one that is everywhere costs a row a task in the
    exchange, not one a step. Forgetting costs rows, never results. ``checks`` are a second hash that must agree.
    """

    def __init__(self, limit: int = 1 << 20):
        self.limit = limit
        self.hash, self.check, self.least = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def look_up(self, hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is held, and under which id."""
        if not len(self.hash):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        return (self.hash[at] == hashes) & (self.check[at] == checks), self.least[at]

    def add(self, hashes: np.ndarray, checks: np.ndarray, ids: np.ndarray) -> None:
        """Hold ``hashes`` with their least ids; what is held keeps the lesser id."""
        if len(hashes) + len(self.hash) > self.limit:
            self.hash, self.check, self.least = self.hash[:0], self.check[:0], self.least[:0]
        held = [np.concatenate([x, y[: self.limit]]) for x, y in ((self.hash, hashes), (self.check, checks), (self.least, ids))]
        order = np.lexsort((held[2], held[0]))
        name, check, least = (x[order] for x in held)
        head = np.append(True, name[1:] != name[:-1])[: len(name)]
        self.hash, self.check, self.least = name[head], check[head], least[head]


def _bounds(masked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the stretches of True."""
    edge = np.diff(np.concatenate([[0], masked.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _key() -> tuple[Column, Column, Column]:
    return F.col("doc_id").cast("long").alias("doc_id"), F.hash("text").alias("tag"), F.col("text")


def name_symbols(docs: DataFrame, window: int) -> DataFrame:
    """``doc_id``, ``tag``, ``n_words``, ``whole_sha256``, and the text's distinct symbols: ``open`` of which the
    corpus must be asked, ``met`` which another id of the same task has too. Of a task's shared symbols only
    one id asks, with ``asks_for_all``, so a symbol that is everywhere costs a row per task, not per text."""
    kind = "doc_id long, tag int, n_words long, whole_sha256 string, open array<long>, asks_for_all array<long>, met array<long>"

    def scan(batches):
        seen = Seen()
        for batch in batches:
            for part in steps(batch, "text", STEP):
                w = Words(as_bytes(part.column("text")))
                ids = part.column("doc_id").to_pylist()
                found = [(name, w.text_of[low]) for _, name, low, _ in symbols(w, window)]
                name = np.concatenate([x[0] for x in found]) if found else np.zeros(0, np.int64)
                text = np.concatenate([x[1] for x in found]) if found else np.zeros(0, np.int64)
                # rows without an id take no part in the exchange, so they can't ask for others
                known = np.array([x is not None for x in ids], bool)[text]
                name, text = name[known], text[known]
                order = np.lexsort((text, name))
                name, text = name[order], text[order]
                fresh = np.append(True, (name[1:] != name[:-1]) | (text[1:] != text[:-1]))[: len(name)]
                name, text = name[fresh], text[fresh]
                # ids of equal names are compared, as rows may repeat an id
                number = {x: i for i, x in enumerate(dict.fromkeys(ids))}
                by = np.array([number[x] for x in ids], np.int64)[text] if len(text) else text
                head = np.append(True, name[1:] != name[:-1])[: len(name)]
                group = np.cumsum(head) - 1
                first = np.flatnonzero(head)
                several = np.zeros(len(first), bool)
                np.logical_or.at(several, group, by != by[first][group])
                shared = several[group]
                # asked for all before: two ids at least have it
                none = np.zeros(len(name), np.int32)
                before = seen.look_up(name, none)[0]
                kinds = np.where(before, 2, np.where(~shared, 0, np.where(head, 1, 2)))
                fresh = kinds == 1
                seen.add(name[fresh], none[fresh], none[fresh].astype(np.int64))
                columns = []
                for k in range(3):
                    pick = np.flatnonzero((kinds == k) | ((k == 2) & (kinds == 1)))
                    pick = pick[np.argsort(text[pick], kind="stable")]
                    counts = np.bincount(text[pick], minlength=len(ids))
                    columns.append(lists(name[pick], np.append(0, np.cumsum(counts)), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tag"), pa.array(w.sizes), pa.array([_sha(x) for x in w.words]), *columns],
                    names=["doc_id", "tag", "n_words", "whole_sha256", "open", "asks_for_all", "met"],
                )

    return small_batches(docs).select(*_key()).mapInArrow(scan, kind)


def shared_symbols(named: DataFrame) -> DataFrame:
    """``doc_id``, ``tag`` and ``shared``: the text's symbols that another id has too."""
    known = named.where(F.col("doc_id").isNotNull())
    asked = known.select("doc_id", "tag", F.explode("open").alias("sym"), F.lit(False).alias("sure")).unionByName(
        known.select("doc_id", "tag", F.explode("asks_for_all").alias("sym"), F.lit(True).alias("sure"))
    )
    # minima and maxima are combined before they are dealt out; the join back splits a frequent symbol like any skewed key
    ends = asked.groupBy("sym").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.max("sure").alias("sure"))
    told = asked.select("doc_id", "tag", "sym").join(ends.where("low < high or sure").select("sym"), "sym")
    rows = told.select("doc_id", "tag", "sym")
    local = known.select("doc_id", "tag", F.explode("met").alias("sym"))
    return rows.unionByName(local).groupBy("doc_id", "tag").agg(F.collect_set("sym").alias("shared"))


def candidates(docs: DataFrame, shared: DataFrame, window: int) -> DataFrame:
    """``doc_id``, ``tag``, ``text`` and ``starts`` (stretches of window starts, end exclusive, flat) of the texts
    with a window all of whose symbols are shared."""

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "text", STEP):
                w = Words(as_bytes(part.column("text")))
                lists_ = part.column("shared")
                flat = lists_.flatten().to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(part.num_rows), np.diff(lists_.offsets.to_numpy()))
                pairs = np.sort(_mix(flat.view(_U) + owner.astype(_U) * _M1))
                keep = np.zeros(len(w.hash), bool)
                for mine, name, low, high in symbols(w, window):
                    ask = _mix(name.view(_U) + w.text_of[low].astype(_U) * _M1)
                    at = np.minimum(np.searchsorted(pairs, ask), len(pairs) - 1)
                    bad = pairs[at] != ask
                    keep |= mine & ~spread(low[bad], high[bad], len(keep))
                begin, end = _bounds(keep)
                text = w.text_of[begin]
                counts = np.bincount(text, minlength=part.num_rows)
                ranges = np.stack([begin - w.first[text], end - w.first[text]], 1).reshape(-1)
                column = lists(ranges, np.append(0, np.cumsum(2 * counts)), pa.int32())
                rows = pa.array(np.flatnonzero(counts))
                out = pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tag"), part.column("text"), column], names=["doc_id", "tag", "text", "starts"])
                yield out.take(rows)

    joined = docs.where(F.col("doc_id").isNotNull()).select(*_key()).join(shared, ["doc_id", "tag"])
    return joined.select("doc_id", "tag", "text", "shared").mapInArrow(scan, "doc_id long, tag int, text string, starts array<int>")


def _places(w: Words, column: pa.ListArray) -> np.ndarray:
    """Positions of the window starts in a column of flat stretches."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, 2)
    owner = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()) // 2)
    begin, size = flat[:, 0] + w.first[owner], flat[:, 1] - flat[:, 0]
    before = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(begin - before, size)


def repeated_windows(found: DataFrame, window: int) -> DataFrame:
    """``doc_id``, ``tag`` and ``gone``: the starts of the text's windows that also start in a smaller id's text.

    What a step of a task, or an earlier step of it, has met under a smaller id is settled on the spot and only reported
    by its place; the others are exchanged. So a window that is everywhere meets as a row a task.
    """
    kind = "h1 long, h2 int, doc_id long, tag int, at int, settled array<int>"

    def scan(batches):
        seen = Seen()
        for batch in batches:
            for part in steps(batch, "text", STEP):
                w = Words(as_bytes(part.column("text")))
                at = _places(w, part.column("starts"))
                if not len(at):
                    continue
                h1, h2 = w.rolled(at, window)
                own_ids, own_tags = (part.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tag"))
                order = np.lexsort((own_ids[w.text_of[at]], h2, h1))
                at, name, h2 = at[order], h1[order].view(np.int64), h2[order]
                text = w.text_of[at]
                ids, place = own_ids[text], (at - w.first[text]).astype(np.int32)
                head = np.append(True, (name[1:] != name[:-1]) | (h2[1:] != h2[:-1]))
                first, group = np.flatnonzero(head), np.cumsum(head) - 1
                least = ids[first][group]
                several = np.zeros(len(first), bool)
                np.logical_or.at(several, group, ids != least)
                held, earlier = seen.look_up(name, h2)
                keep = several | held[first]
                seen.add(name[first][keep], h2[first][keep], ids[first][keep])
                settled = ids > np.where(held, np.minimum(least, earlier), least)
                # a row a text for what is settled, a row a window for the rest
                rest = np.flatnonzero(~settled)
                rest = rest[np.argsort(at[rest])]  # text by text, so that what rows share is compressed
                done = np.flatnonzero(settled)
                done = done[np.argsort(text[done], kind="stable")]
                owners, counts = np.unique(text[done], return_counts=True)
                blank, n = np.zeros(len(owners), np.int64), len(rest)
                places = lists(place[done], np.append(0, np.cumsum(counts)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(name[rest], blank)), pa.array(np.append(h2[rest], blank.astype(np.int32))), pa.array(np.append(ids[rest], own_ids[owners])),
                        pa.array(np.append(own_tags[text[rest]], own_tags[owners])), pa.array(np.append(place[rest], blank.astype(np.int32)), mask=np.arange(n + len(owners)) >= n),
                        pa.concat_arrays([pa.nulls(n, places.type), places]),
                    ],
                    names=["h1", "h2", "doc_id", "tag", "at", "settled"],
                )

    sent = found.mapInArrow(scan, kind)
    # settled rows need no company: a key of their own spreads them
    side = F.when(F.col("settled").isNotNull(), F.hash("doc_id", "tag")).otherwise(0)
    same = Window.partitionBy("h1", "h2", "side")
    told = sent.withColumn("side", side).withColumn("least", F.min("doc_id").over(same))
    gone = told.where(F.col("settled").isNotNull() | (F.col("least") < F.col("doc_id")))
    return gone.groupBy("doc_id", "tag").agg(F.sort_array(F.concat(F.collect_list("at"), F.flatten(F.collect_list("settled")))).alias("gone"))


def removals(found: DataFrame, gone: DataFrame, window: int) -> DataFrame:
    """``doc_id``, ``tag``, ``n_removed``, ``kept_sha256``, ``kept`` (the text of what stays) and ``spans`` (flat
    word positions, end exclusive) of the texts that lose words."""
    kind = "doc_id long, tag int, n_removed long, kept_sha256 string, kept string, spans array<int>"

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "text", STEP):
                rows: dict[str, list] = {k: [] for k in ("n_removed", "kept_sha256", "kept", "spans")}
                starts = part.column("gone")
                flat, ends = starts.flatten().to_numpy(zero_copy_only=False), (starts.offsets.to_numpy() - starts.offsets[0].as_py()).tolist()
                for i, text in enumerate(as_bytes(part.column("text"))):
                    words = text.split()
                    hit = flat[ends[i] : ends[i + 1]]
                    lost = spread(hit, hit + window - 1, len(words))
                    begin, end = _bounds(lost)
                    left = [x for x, y in zip(words, lost.tolist(), strict=True) if not y]
                    rows["n_removed"].append(len(words) - len(left))
                    rows["kept_sha256"].append(_sha(left))
                    rows["kept"].append(b" ".join(left).decode())
                    rows["spans"].append(np.stack([begin, end], 1).reshape(-1).tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("tag"), pa.array(rows["n_removed"], pa.int64()), pa.array(rows["kept_sha256"]),
                        pa.array(rows["kept"]), pa.array(rows["spans"], pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "tag", "n_removed", "kept_sha256", "kept", "spans"],
                )

    return found.join(gone, ["doc_id", "tag"]).select("doc_id", "tag", "text", "gone").mapInArrow(scan, kind)


def dedup_substrings(docs: DataFrame, window: int = 50) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256``, and for rows that lose words ``kept`` and ``spans``.

    Each word goes that is covered by a window of ``window`` consecutive words whose word sequence also starts in a
    row with a smaller id; windows are judged on the texts as given. Words are divided by ASCII white space and
    compared as they are. Null and empty texts have no words. Rows with a null id have no order: they keep all words
    and take none from others. Rows that repeat an id are judged one by one and never against each other. Other
    columns are not read; an empty table gives no rows. ``kept`` (null where nothing goes) joins what stays by one
    space.
    """
    named = stash(name_symbols(docs, window), "symbols")
    found = stash(candidates(docs, shared_symbols(named), window), "candidates")
    lost = removals(found, repeated_windows(found, window), window).dropDuplicates(["doc_id", "tag"])
    return named.select("doc_id", "tag", "n_words", "whole_sha256").join(lost, ["doc_id", "tag"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
        "kept",
        "spans",
    )
