"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

The items' words become the automaton's alphabet; every training text is streamed through it once, keeping
the longest suffix that some item contains. A window is ``window`` consecutive words of an item (the whole
item where it is shorter); each position whose matching length reaches a window's length marks that window's
words as hit.

The automaton lies in flat arrays: about 80 bytes a state, so that one holds millions of words of items, is saved in the
shared folder as it is and is mapped from there. Words are known by 64-bit hashes; one that equals an item's by chance
would only matter inside a whole window of them. Before a text is streamed, its pairs of neighbouring words are looked up in
a bitmap of the items' pairs: only where as many as the shortest window has follow each other can a window end, and only
these stretches go through the automaton. Items beyond ``BLOCK_WORDS`` are dealt into blocks, each with an automaton built by
an executor; every stretch of texts goes through all of them, of which a worker holds ``RESIDENT``. So neither the
driver nor a worker ever holds more of the item table than a block.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marajo.llm.arrow import as_bytes, lists, small_batches, steps
from marajo.llm.shared import mapped, new_folder, save
from marajo.session import stash

#: Words of items in an automaton (about 160 MB; building it takes about 700 MB).
BLOCK_WORDS = 2_000_000
#: Automata that a worker holds, and bytes of text it streams through all where there are more.
RESIDENT = 2
MANY_BLOCKS_STEP = 64 << 20
#: Words of texts whose symbols a worker remembers.
SEEN_WORDS = 500_000

#: Maps A-Z to a-z and every other ASCII character that is no digit or letter to a space.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32) for c in range(256))
_WORD = re.compile(rb"[^ ]+")

_SPANS = "array<struct<start:int,end:int>>"
_MATCHES = f"doc_id long, n_words long, spans {_SPANS}, item_ids array<long>"


def normal_words(text: bytes) -> list[bytes]:
    """Lower-cased words of ASCII letters, digits and characters beyond ASCII."""
    return text.translate(_FOLD).split()


def _hashes(words: Iterable[bytes], n: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=n)


def _slot(state: int, symbol: int, mask: int) -> int:
    return (state * 0x9E3779B1 + symbol * 0x85EBCA6B) & mask


class _Growing:
    """The automaton while items are added: states, and edges both in a list for each state and in a table of open addresses."""

    def __init__(self):
        self.link, self.length, self.first = array("i", [-1]), array("i", [0]), array("i", [-1])
        self.source, self.symbol, self.target, self.later = array("i"), array("i"), array("i"), array("i")
        self.table, self.mask = array("i", bytes(4 << 10)), (1 << 10) - 1

    def edge(self, state: int, symbol: int) -> int:
        """The edge of ``state`` by ``symbol``, -1 if there is none."""
        table, mask, at = self.table, self.mask, _slot(state, symbol, self.mask)
        while e := table[at]:
            if self.source[e - 1] == state and self.symbol[e - 1] == symbol:
                return e - 1
            at = (at + 1) & mask
        return -1

    def _place(self, e: int) -> None:
        at = _slot(self.source[e], self.symbol[e], self.mask)
        while self.table[at]:
            at = (at + 1) & self.mask
        self.table[at] = e + 1

    def put(self, state: int, symbol: int, target: int) -> None:
        e = len(self.source)
        self.source.append(state)
        self.symbol.append(symbol)
        self.target.append(target)
        self.later.append(self.first[state])
        self.first[state] = e
        if 2 * e > self.mask:
            self.mask = 2 * self.mask + 1
            self.table = array("i", bytes(4 * (self.mask + 1)))
            for other in range(e):
                self._place(other)
        self._place(e)

    def state(self, length: int, link: int) -> int:
        self.link.append(link)
        self.length.append(length)
        self.first.append(-1)
        return len(self.link) - 1

    def split(self, parent: int, e: int) -> int:
        """The state that edge ``e`` of ``parent`` leads to, by itself: its longest string is one longer than the parent's."""
        target, symbol = self.target[e], self.symbol[e]
        if self.length[target] == self.length[parent] + 1:
            return target
        copy = self.state(self.length[parent] + 1, self.link[target])
        out = self.first[target]
        while out >= 0:
            self.put(copy, self.symbol[out], self.target[out])
            out = self.later[out]
        self.link[target] = copy
        while parent >= 0 and (e := self.edge(parent, symbol)) >= 0 and self.target[e] == target:
            self.target[e] = copy
            parent = self.link[parent]
        return copy

    def extend(self, last: int, symbol: int) -> int:
        if (e := self.edge(last, symbol)) >= 0:
            return self.split(last, e)
        state = self.state(self.length[last] + 1, 0)
        while last >= 0 and (e := self.edge(last, symbol)) < 0:
            self.put(last, symbol, state)
            last = self.link[last]
        if last >= 0:
            self.link[state] = self.split(last, e)
        return state


#: The arrays of an automaton and their types, as they are saved: hashes of words by symbol; of each state its link, length, the
#: smallest matching length at which a window ends in it, the state of its suffix of window words, and the nearest state up
#: the links (itself included) where a short item ends; edges and their table; which items have windows in a state, and which
#: short items of which length end in one; a bitmap of pairs of symbols.
_ARRAYS = {
    "words": "u8", "link": "i4", "length": "i4", "due": "i4", "base": "i4", "short_up": "i4", "source": "i4", "symbol": "i4", "target": "i4", "table": "i4",
    "owned": "i4", "owner": "i8", "short_state": "i4", "short_length": "i4", "short_item": "i8", "pairs": "u1",
}


class Automaton:
    """Suffix automaton of several word sequences, with what ends in each state, in flat arrays."""

    def __init__(self, window: int, shortest: int, arrays: dict[str, np.ndarray]):
        self.window, self.shortest, self.arrays = window, shortest, arrays
        # plain views are read faster one by one
        self.view = {k: memoryview(v) for k, v in arrays.items()}
        self.seen: dict[bytes, int] = {}

    def dump(self) -> bytes:
        head = json.dumps({"window": self.window, "shortest": self.shortest, "sizes": {k: len(self.arrays[k]) for k in _ARRAYS}}).encode()
        head += b" " * (-len(head) % 8)
        parts = [len(head).to_bytes(8, "little"), head]
        for k in _ARRAYS:
            data = self.arrays[k].tobytes()
            parts += [data, bytes(-len(data) % 8)]
        return b"".join(parts)

    @classmethod
    def read(cls, data) -> Automaton:
        """The automaton in a buffer, without copying its arrays."""
        at = 8 + int.from_bytes(bytes(data[:8]), "little")
        head = json.loads(bytes(data[8:at]))
        arrays = {}
        for k, kind in _ARRAYS.items():
            arrays[k] = np.frombuffer(data, dtype=kind, count=head["sizes"][k], offset=at)
            at += -(-arrays[k].nbytes // 8) * 8
        return cls(head["window"], head["shortest"], arrays)

    def symbols(self, words: list[bytes]) -> np.ndarray:
        """Symbols of the words, -1 of those that no item has."""
        found = list(map(self.seen.get, words))
        if None in found:
            if len(self.seen) > SEEN_WORDS:
                self.seen.clear()
            new = list({w for w, f in zip(words, found, strict=True) if f is None})
            hashes, known = _hashes(new, len(new)), self.arrays["words"]
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            ids = np.where(known[at] == hashes, at, -1).tolist() if len(known) else [-1] * len(new)
            own = dict(zip(new, ids, strict=True))
            found = [own[w] if f is None else f for w, f in zip(words, found, strict=True)]
            self.seen |= own
        return np.array(found, dtype=np.int64)

    def stretches(self, symbols: np.ndarray) -> Iterator[tuple[int, int]]:
        """Where windows can be: stretches of known words whose neighbours are neighbours in an item, as long as the shortest window."""
        good = symbols >= 0
        if self.shortest > 1:
            good = good[1:] & good[:-1]
            good[good] = _in_bitmap(self.arrays["pairs"], symbols[:-1][good], symbols[1:][good])
        need = max(1, self.shortest - 1)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], good, [False]]).astype(np.int8)))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - start >= need:
                yield start, end + (self.shortest > 1)

    def walk(self, symbols: np.ndarray):
        """Position, state and matching length wherever a window may end."""
        link, length, due, source, symbol, target, table = (self.view[k] for k in ("link", "length", "due", "source", "symbol", "target", "table"))
        mask = len(table) - 1
        for start, end in self.stretches(symbols):
            state = matched = 0
            for at, wanted in enumerate(symbols[start:end].tolist(), start):
                while True:
                    slot = _slot(state, wanted, mask)
                    while (e := table[slot]) and not (source[e - 1] == state and symbol[e - 1] == wanted):
                        slot = (slot + 1) & mask
                    if e:
                        state, matched = target[e - 1], matched + 1
                        break
                    if not state:
                        matched = 0
                        break
                    state = link[state]
                    matched = length[state]
                if matched >= due[state]:
                    yield at, state, matched

    def match(self, words: list[bytes]) -> tuple[list[list[int]], set[int]]:
        """Merged hit spans (word positions, end exclusive) and the items whose windows occur."""
        return self.match_all([words])[0]

    def match_all(self, texts: list[list[bytes]]) -> list[tuple[list[list[int]], set[int]]]:
        """:meth:`match` of several texts, which are streamed one behind the other with a word between that no item has."""
        out: list[tuple[list[list[int]], set[int]]] = [([], set()) for _ in texts]
        flat: list[bytes] = []
        ends = []
        for words in texts:
            flat += words
            flat.append(b" ")
            ends.append(len(flat))
        text, first, told = 0, 0, set()
        for at, state, matched in self.walk(self.symbols(flat)) if flat else ():
            if at >= ends[text]:
                text = bisect_right(ends, at)
                first, told = ends[text - 1], set()
            self._note(at - first, state, matched, *out[text], told)
        return out

    def _note(self, at: int, state: int, matched: int, spans: list[list[int]], found: set[int], told: set[int]) -> None:
        """Add the windows that end at ``at`` to ``spans`` and ``found``; ``told`` are the states whose items are there already."""
        size = 0
        if matched >= self.window:
            size = self.window
            held = self.view["base"][state]
            if held not in told:
                told.add(held)
                owned, owner = self.view["owned"], self.view["owner"]
                i = bisect_left(owned, held)
                while i < len(owned) and owned[i] == held:
                    found.add(owner[i])
                    i += 1
        up, link, short, short_length, short_item = (self.view[k] for k in ("short_up", "link", "short_state", "short_length", "short_item"))
        state = up[state]
        while state:
            i = bisect_left(short, state)
            while i < len(short) and short[i] == state:
                if short_length[i] <= matched:
                    size = max(size, short_length[i])
                    found.add(short_item[i])
                i += 1
            state = up[link[state]]
        if size:
            start = at - size + 1
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append([start, at + 1])


def _bit(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    return ((a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(20)) & np.uint64(bits - 1)


def _in_bitmap(bitmap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    at = _bit(a, b, 8 * len(bitmap))
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def build(items: list[tuple[int, bytes | None]], window: int) -> Automaton:
    """The finished automaton of ``(item_id, text)`` rows."""
    split = [(i, words) for i, text in items if text is not None and (words := normal_words(text))]
    sizes = [len(words) for _, words in split]
    hashes = _hashes((w for _, words in split for w in words), sum(sizes))
    known, flat = np.unique(hashes, return_inverse=True)
    ends = np.cumsum(sizes, dtype=np.int64)
    rows = [(i, flat[end - n : end]) for (i, _), n, end in zip(split, sizes, ends, strict=True)]

    grown = _Growing()
    for _, symbols in rows:
        last = 0
        for symbol in symbols.tolist():
            last = grown.extend(last, symbol)
    link, length = grown.link, grown.length
    n = len(link)

    short: dict[int, set[tuple[int, int]]] = {}
    for item_id, symbols in rows:
        if len(symbols) < window:
            state = 0
            for symbol in symbols.tolist():
                state = grown.target[grown.edge(state, symbol)]
            short.setdefault(state, set()).add((len(symbols), item_id))
    base, due, up = array("i", bytes(4 * n)), array("i", [window]) * n, array("i", bytes(4 * n))
    for state in np.argsort(np.array(length), kind="stable").tolist()[1:]:
        above = link[state]
        base[state] = state if length[above] < window else base[above]
        up[state], due[state] = (state, min(due[above], min(short[state])[0])) if state in short else (up[above], due[above])

    pairs_a = np.concatenate([s[:-1] for _, s in rows]) if rows else np.zeros(0, np.int64)
    pairs_b = np.concatenate([s[1:] for _, s in rows]) if rows else np.zeros(0, np.int64)
    bits = 1 << max(10, (16 * len(pairs_a)).bit_length())
    at = _bit(pairs_a, pairs_b, bits)
    bitmap = np.zeros(bits // 8, np.uint8)
    np.bitwise_or.at(bitmap, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    ended = sorted((state, size, item_id) for state, own in short.items() for size, item_id in own)
    columns = list(zip(*ended, strict=True)) or [(), (), ()]
    arrays = {k: np.array(getattr(grown, k), dtype=_ARRAYS[k]) for k in ("link", "length", "source", "symbol", "target", "table")}
    arrays |= {"words": known.astype("u8"), "due": np.array(due, "i4"), "base": np.array(base, "i4"), "short_up": np.array(up, "i4"), "pairs": bitmap}
    arrays |= {k: np.array(c, dtype=_ARRAYS[k]) for k, c in zip(("short_state", "short_length", "short_item"), columns, strict=True)}
    arrays |= {"owned": np.zeros(0, "i4"), "owner": np.zeros(0, "i8")}
    made = Automaton(window, min([window, *sizes]), arrays)

    states, owners = array("q"), array("q")
    for item_id, symbols in rows:
        if len(symbols) >= window:
            held = {base[state] for _, state, matched in made.walk(symbols) if matched >= window}
            states.extend(held)
            owners.extend([item_id] * len(held))
    pairs = np.unique(np.stack([np.array(states), np.array(owners)], axis=1), axis=0) if states else np.zeros((0, 2), np.int64)
    return Automaton(window, made.shortest, arrays | {"owned": pairs[:, 0].astype("i4"), "owner": pairs[:, 1].astype("i8")})


def shelve(items: DataFrame, window: int, block_words: int = BLOCK_WORDS) -> list[str]:
    """URIs of the automata of ``items``, each built by an executor and saved in the shared folder.

    Items are cut into stretches of at most ``block_words`` words that overlap by ``window - 1``, so every window is
    whole in one of them; stretches are dealt into blocks of about ``block_words`` words. Only the URIs, one a block,
    come to the driver.
    """
    known = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    reach = max(block_words, window)

    def cut_items(batches):
        for batch in batches:
            rows: dict[str, list] = {"item_id": [], "words": [], "n": []}
            for item_id, text in zip(batch.column("item_id").to_pylist(), as_bytes(batch.column("text")), strict=True):
                words = normal_words(text)
                for at in range(0, max(len(words) - window + 1, min(len(words), 1)), reach - window + 1):
                    part = words[at : at + reach]
                    rows["item_id"].append(item_id)
                    rows["words"].append(b" ".join(part).decode())
                    rows["n"].append(len(part))
            yield pa.RecordBatch.from_pydict({"item_id": pa.array(rows["item_id"], pa.int64()), "words": pa.array(rows["words"], pa.string()), "n": pa.array(rows["n"], pa.int64())})

    stretches = stash(small_batches(known).mapInArrow(cut_items, "item_id long, words string, n long"), "stretches")
    blocks = -(-(stretches.agg(F.sum("n")).first()[0] or 0) // block_words)
    if not blocks:
        return []
    root = new_folder(items.sparkSession, "automata")

    def build_block(held: pa.Table) -> pa.Table:
        made = build(list(zip(held.column("item_id").to_pylist(), as_bytes(held.column("words").combine_chunks()), strict=True)), window)
        return pa.table({"uri": [save(root, made.dump())]})

    dealt = stretches.withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)))
    return sorted(r.uri for r in dealt.groupBy("block").applyInArrow(build_block, "uri string").collect())


class Shelf:
    """The automata at ``uris``, of which a worker holds ``RESIDENT`` at most."""

    def __init__(self, uris: list[str]):
        self.uris = uris
        self.held: dict[str, Automaton] = {}

    def __iter__(self):
        # what is held comes first, so that a step of texts loads only the others
        for uri in sorted(self.uris, key=lambda u: u not in self.held):
            if uri not in self.held:
                if len(self.held) >= RESIDENT:
                    self.held.pop(next(iter(self.held)))
                self.held[uri] = Automaton.read(mapped(uri))
            yield self.held[uri]

    def match(self, texts: list[list[bytes]]) -> list[tuple[list[list[int]], set[int]]]:
        """Merged hit spans and found items of each split text, over all automata."""
        found: list[tuple[list[list[int]], set[int]]] = [([], set()) for _ in texts]
        for automaton in self:
            for i, (spans, ids) in enumerate(automaton.match_all(texts)):
                if spans:
                    found[i] = (merge(found[i][0], spans), found[i][1] | ids)
        return found

    def stretches(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of ``batches`` in stretches for one turn of the shelf: longer ones where automata have to be
        loaded again in each."""
        if len(self.uris) <= RESIDENT:
            for batch in batches:
                yield from steps(batch, "text")
            return
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(x.nbytes for x in waiting) >= MANY_BLOCKS_STEP:
                yield pa.concat_batches(waiting)
                waiting = []
        if waiting:
            yield pa.concat_batches(waiting)


def merge(one: list[list[int]], other: list[list[int]]) -> list[list[int]]:
    """Union of two ordered lists of spans (end exclusive); touching spans become one."""
    if not one or not other:
        return one or other
    out: list[list[int]] = []
    for start, end in sorted(map(tuple, one + other)):
        if out and out[-1][1] >= start:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def matches(docs: DataFrame, items: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, merged hit ``spans`` of word positions and the distinct
    ``item_ids`` whose windows occur.

    Null texts have no words. Items without an id, a text or a word take no part; repeated items count once. An empty
    item table leaves every text clean. Every row comes back once, repeated rows and rows without an id too, however
    many blocks the items need. Other columns are not read; an empty table gives no rows.
    """
    uris = shelve(items, window, block_words)

    def scan(batches):
        shelf = Shelf(uris)
        for part in shelf.stretches(batches):
            yield _scan_step(part, shelf)

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, _MATCHES)


def _scan_step(part: pa.RecordBatch, shelf: Shelf) -> pa.RecordBatch:
    sizes, starts, ends, span_at, ids, id_at = [], [], [], [0], [], [0]
    texts = [normal_words(t) if t else [] for t in as_bytes(part.column("text"))]
    for words, (spans, found) in zip(texts, shelf.match(texts), strict=True):
        sizes.append(len(words))
        starts.extend(s[0] for s in spans)
        ends.extend(s[1] for s in spans)
        span_at.append(len(starts))
        ids.extend(sorted(found))
        id_at.append(len(ids))
    pairs = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["start", "end"])
    return pa.RecordBatch.from_arrays(
        [
            part.column("doc_id"),
            pa.array(sizes, pa.int64()),
            pa.ListArray.from_arrays(pa.array(span_at, pa.int32()), pairs),
            lists(ids, id_at, pa.int64()),
        ],
        names=["doc_id", "n_words", "spans", "item_ids"],
    )


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the stretches from the first to the last word of each span."""
    at = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    kept, done = [], 0
    for start, end in spans:
        kept.append(text[done : at[start][0]])
        done = at[end - 1][1]
    return b"".join([*kept, text[done:]])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without contaminated passages, all columns as they were.

    Hit spans (``window`` words or a whole shorter item at least) are cut out of the text; a text of which
    more than ``max_coverage`` of the words are hit goes altogether. Clean rows come back unchanged: null and empty
    texts, rows without an id and repeated rows, each judged by itself, as nothing is joined. An empty item table
    leaves all rows, an empty table gives none; columns may have any names.
    """
    uris = shelve(items, window, block_words)

    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        shelf = Shelf(uris)
        for part in shelf.stretches(pa.RecordBatch.from_arrays([x], ["text"]) for x in texts):
            held = as_bytes(part.column("text"))
            split = [normal_words(t) if t else [] for t in held]
            cut_texts, gone = [], []  # a null text stands for one that stays as it is
            for text, words, (spans, _) in zip(held, split, shelf.match(split), strict=True):
                hit = sum(end - start for start, end in spans)
                gone.append(hit > max_coverage * len(words))
                cut_texts.append(cut(text, spans).decode() if spans and not gone[-1] else None)
            yield pa.StructArray.from_arrays([pa.array(cut_texts, pa.string()), pa.array(gone, pa.bool_())], ["text", "gone"])

    # called once a row, not again by the filter; the rows travel in a struct, so that no column of theirs can clash
    judged = F.arrow_udf(clean, "text string, gone boolean").asNondeterministic()
    rows = small_batches(docs).select(F.struct(*docs.columns).alias("row"))
    told = rows.withColumn("told", judged(F.col("row.text"))).where(~F.col("told.gone"))
    return told.select(*[(F.coalesce("told.text", "row.text") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
