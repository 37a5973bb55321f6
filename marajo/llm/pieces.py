"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

Encoding works the agenda of candidate merges by rank, then from left to right. Each candidate is first put to a
keyed hash of (seed, chunk of text, draw, start of the left symbol, merged piece); below the dropout rate it is
skipped. The draw of a chunk's occurrence is hashed from seed, document and place, so a word is cut differently from
place to place, yet any executor repeats the same cut. A merge type is skipped or made by the key alone, so every
segmentation is reproducible, and all of them decode to the same text. Every occurrence has a draw of its own, so the
segmentations of a frequent word are as many as there can be.

No piece of a fit vocabulary joins characters across the start of a run of spaces or a line feed, so texts are
encoded in chunks. All chunks of equal length in a step of texts are merged at once, one agenda step of each at a
time; chunks longer than ``MATRIX_CHARS`` go through a heap.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marajo.llm.arrow import as_bytes, lists, small_batches, steps

MATRIX_CHARS = 48
STEP = 2 << 20
#: Largest vocabulary that is sent to the executors.
MAX_PIECES = 1_000_000

#: Texts that a unigram model, a normaliser, or one without a space in front would encode otherwise.
PROBES = ("a", "  two  spaces and a tail ", "internationalization of the understandings", "\tTab\nline\n\n", "ﬁ ① ＡＢ é e\u0301 \u00a0x", "日本語 😀 \x1f", "12345.67 $%&")

_CHUNK = re.compile(rb" *[^ \n]+| +|\n")
_NEVER = np.int32(2**31 - 1)
_MASK = (1 << 64) - 1
_A, _B, _C, _D = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53


def _mix(x):
    """Scramble a uint64 array, or a Python integer."""
    if isinstance(x, int):
        x &= _MASK
        x = (x ^ x >> 33) * _C & _MASK
        x = (x ^ x >> 29) * _D & _MASK
        return x ^ x >> 32
    x = (x ^ (x >> np.uint64(33))) * np.uint64(_C)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_D)
    return x ^ (x >> np.uint64(32))


@dataclass
class Vocabulary:
    """Tables of a SentencePiece BPE model with byte fallback, as sent to the executors."""

    surface: list[bytes]
    rank: np.ndarray
    char_ids: dict[str, int]
    #: Symbols of the code points below 65,536.
    plane: np.ndarray
    byte_ids: np.ndarray
    keys: np.ndarray
    values: np.ndarray
    bits: int

    @property
    def size(self) -> int:
        return len(self.surface)

    @cached_property
    def pairs(self) -> dict[int, int]:
        """The merges once more, for one pair at a time."""
        held = self.keys != -1
        return dict(zip(self.keys[held].tolist(), self.values[held].tolist(), strict=True))

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece that joins each pair of symbols, -1 for none (open addressing)."""
        key = (left.astype(np.int64) << 32) | right
        slot = (key.astype(np.uint64) * np.uint64(_A)) >> np.uint64(64 - self.bits)
        slot = slot.astype(np.int64)
        held = self.keys[slot]
        out = np.where(held == key, self.values[slot], np.int32(-1))
        open_ = np.nonzero((held != key) & (held != -1))
        while open_[0].size:
            at = (slot[open_] + 1) & (len(self.keys) - 1)
            slot[open_] = at
            held = self.keys[at]
            hit = held == key[open_]
            out[tuple(x[hit] for x in open_)] = self.values[at[hit]]
            open_ = tuple(x[~hit & (held != -1)] for x in open_)
        return out


def load(model_file: str) -> Vocabulary:
    """Read a model file on the driver; refuses vocabularies this encoder can't work in chunks."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    n = model.get_piece_size()
    if n > MAX_PIECES:
        raise ValueError(f"{n} pieces; at most {MAX_PIECES} are sent to executors")
    names = [model.id_to_piece(i) for i in range(n)]
    byte_ids = np.full(256, -1, np.int32)
    normal: dict[str, int] = {}
    surface = [b""] * n
    for i, name in enumerate(names):
        if model.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
            surface[i] = bytes([int(name[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            if "▁" in name.lstrip("▁") or "\n" in name:
                raise ValueError(f"piece {name!r} joins characters across chunks")
            normal[name] = i
            surface[i] = name.replace("▁", " ").encode()
    if (byte_ids < 0).any():
        raise ValueError("the vocabulary has no byte fallback")
    rank = np.full(n, _NEVER, np.int32)
    order = sorted(normal.values(), key=lambda i: (-model.get_score(i), i))
    rank[order] = np.arange(len(order), dtype=np.int32)
    char_ids = {" " if name == "▁" else name: i for name, i in normal.items() if len(name) == 1}
    plane = np.arange(n, n + 0x10000, dtype=np.int64)
    for char, i in char_ids.items():
        if ord(char) < 0x10000:
            plane[ord(char)] = i
    symbol = lambda s: normal.get(s, -1) if len(s) > 1 or s in normal else n + ord(s)
    pairs = {}
    for name, i in normal.items():
        for k in range(1, len(name)):
            left, right = symbol(name[:k]), symbol(name[k:])
            if left >= 0 and right >= 0:
                pairs[left << 32 | right] = i
    bits = max(8, (4 * len(pairs)).bit_length())
    keys, values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
    for key, i in pairs.items():
        slot = (key * _A & _MASK) >> (64 - bits)
        while keys[slot] != -1:
            slot = (slot + 1) & ((1 << bits) - 1)
        keys[slot], values[slot] = key, i
    vocabulary = Vocabulary(surface, rank, char_ids, plane, byte_ids, keys, values, bits)
    encoder = Encoder(vocabulary, 0, 0.0)
    for text in PROBES:
        if encoder.encode([0], [text.encode()])[0].tolist() != model.encode(text):
            raise ValueError(f"the model doesn't merge by rank, or normalises texts: it encodes {text!r} otherwise")
    return vocabulary


def _symbols(vocabulary: Vocabulary, points: np.ndarray) -> np.ndarray:
    """Symbols of code points: piece of the character, or ``size + point`` where it has none."""
    plain = points < 0x10000
    out = vocabulary.plane[np.where(plain, points, 0)]
    if not plain.all():
        out[~plain] = [vocabulary.char_ids.get(chr(p), vocabulary.size + p) for p in points[~plain].tolist()]
    return out


def _spell(vocabulary: Vocabulary, symbols: list[int]) -> list[int]:
    """Piece ids of final symbols; characters without a piece become bytes."""
    out: list[int] = []
    for s in symbols:
        if s < vocabulary.size:
            out.append(s)
        else:
            out.extend(int(vocabulary.byte_ids[b]) for b in chr(s - vocabulary.size).encode())
    return out


def agenda(vocabulary: Vocabulary, chunk: str, key: int = 0, dropout: float = 0.0) -> list[int]:
    """Piece ids of one chunk by the agenda of candidate merges, skipping those whose keyed hash is below ``dropout``."""
    below, rank = int(dropout * 2**64), vocabulary.rank.tolist() if len(chunk) > len(vocabulary.rank) else vocabulary.rank
    symbols = [vocabulary.char_ids.get(c, vocabulary.size + ord(c)) for c in chunk]
    after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(left: int) -> None:
        right = after[left]
        if left < 0 or right >= len(symbols):
            return
        piece = vocabulary.pairs.get(symbols[left] << 32 | symbols[right], -1)
        if piece >= 0 and not _mix(key ^ (left * _A) ^ (piece * _B)) < below:
            heapq.heappush(heap, (rank[piece], left, symbols[left], symbols[right], piece))

    for i in range(len(symbols) - 1):
        offer(i)
    while heap:
        _, left, was_left, was_right, piece = heapq.heappop(heap)
        right = after[left] if symbols[left] == was_left else len(symbols)
        if right >= len(symbols) or symbols[right] != was_right:
            continue
        symbols[left], symbols[right] = piece, -1
        after[left] = after[right]
        if after[left] < len(symbols):
            before[after[left]] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    return _spell(vocabulary, [s for s in symbols if s >= 0])


def _merge_equal(vocabulary: Vocabulary, symbols: np.ndarray, keys: np.ndarray, dropout: float):
    """Work the agendas of chunks of equal length together; yields (rows, final symbols)."""
    n, size = symbols.shape
    rows, at = np.arange(n), np.broadcast_to(np.arange(size, dtype=np.uint64), (n, size))
    below = np.uint64(min(int(dropout * 2**64), _MASK))
    while symbols.shape[1] > 1 and len(rows):
        pieces = vocabulary.merged(symbols[:, :-1], symbols[:, 1:])
        ranks = np.where(pieces >= 0, vocabulary.rank[pieces], _NEVER)
        if dropout > 0:
            drawn = _mix(keys[:, None] ^ (at[:, :-1] * np.uint64(_A)) ^ (pieces.astype(np.uint64) * np.uint64(_B)))
            ranks[drawn < below] = _NEVER
        best = ranks.argmin(1)
        every = np.arange(len(rows))
        going = ranks[every, best] != _NEVER
        if not going.all():
            yield rows[~going], symbols[~going]
            rows, symbols, at, keys, best, pieces = rows[going], symbols[going], at[going], keys[going], best[going], pieces[going]
            every = every[: len(rows)]
        left = np.arange(symbols.shape[1] - 1) <= best[:, None]
        made = pieces[every, best]
        symbols, at = np.where(left, symbols[:, :-1], symbols[:, 1:]), np.where(left, at[:, :-1], at[:, 1:])
        symbols[every, best] = made
    if len(rows):
        yield rows, symbols


class Encoder:
    """Encodes texts in bulk."""

    def __init__(self, vocabulary: Vocabulary, seed: int, dropout: float):
        self.vocabulary, self.seed, self.dropout = vocabulary, seed, dropout

    def keys(self, chunks: list[bytes], draws: np.ndarray) -> np.ndarray:
        """Dropout keys of chunks under their draws."""
        hashes = np.fromiter((xxhash.xxh64_intdigest(c, self.seed) for c in chunks), np.uint64, len(chunks))
        return _mix(hashes + draws.astype(np.uint64) * np.uint64(_A))

    def segment(self, chunks: list[bytes], draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all chunks in a row, and the number of each chunk's."""
        texts = [c.decode() for c in chunks]
        keys = self.keys(chunks, draws)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        blocks: list[tuple[np.ndarray, np.ndarray]] = []
        order = np.argsort(lengths, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
            size = int(lengths[group[0]]) if len(group) else 0
            if size > MATRIX_CHARS:
                for i in group.tolist():
                    ids = agenda(self.vocabulary, texts[i], int(keys[i]), self.dropout)
                    blocks.append((np.array([i]), np.array([ids])))
                continue
            joined = "".join([texts[i] for i in group.tolist()]).encode("utf-32-le")
            symbols = _symbols(self.vocabulary, np.frombuffer(joined, np.uint32).reshape(len(group), size))
            for rows, final in _merge_equal(self.vocabulary, symbols, keys[group], self.dropout):
                odd = (final >= self.vocabulary.size).any(1)
                for row, strange in zip(group[rows[odd]].tolist(), final[odd].tolist(), strict=True):
                    blocks.append((np.array([row]), np.array([_spell(self.vocabulary, strange)])))
                blocks.append((group[rows[~odd]], final[~odd]))
        sizes = np.zeros(len(texts), np.int64)
        for rows, final in blocks:
            sizes[rows] = final.shape[1]
        starts = np.cumsum(sizes) - sizes
        flat = np.zeros(int(sizes.sum()), np.int32)
        for rows, final in blocks:
            flat[starts[rows][:, None] + np.arange(final.shape[1])] = final
        return flat, sizes

    def encode(self, ids: list[int | None], texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all texts in a row, and each text's bounds in them."""
        chunks: list[bytes] = []
        counts = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if text:
                chunks += _CHUNK.findall(b" " + text)
            counts[i + 1] = len(chunks)
        per = np.diff(counts)
        # a text's chunks draw by its id and their place in it
        base = np.fromiter((xxhash.xxh64_intdigest(b"%d" % (i if i is not None else -1), self.seed) for i in ids), np.uint64, len(ids))
        place = (np.arange(len(chunks)) - np.repeat(counts[:-1], per)).astype(np.uint64)
        pieces, sizes = self.segment(chunks, _mix(np.repeat(base, per) + place * np.uint64(_B)))
        return pieces, np.concatenate([[0], np.cumsum(sizes)])[counts]


def decode_ids(vocabulary: Vocabulary, ids: list[int]) -> bytes:
    """The text of piece ids: their surfaces in a row, without the space that encoding puts in front."""
    return b"".join(map(vocabulary.surface.__getitem__, ids)).removeprefix(b" ")


def _ship(spark: SparkSession, model_file: str):
    """The vocabulary's fields for the executors, which needn't have this module."""
    return spark.sparkContext.broadcast(vars(load(model_file)))


def encode(docs: DataFrame, model_file: str, seed: int = 42, dropout: float = 0.1) -> DataFrame:
    """``doc_id``, ``ids`` (array<int>) and ``lossless`` (the ids decode to the very text) of every row of ``docs``.

    ``dropout`` 0 gives the model's own segmentation. A null text gives null ids and a null verdict, an empty one
    no ids. Characters without a piece, and the model's own space mark, are spelled in byte pieces. Rows that
    repeat an id and a text get the same ids; a null id draws like -1. Other columns are not read; an empty table
    gives no rows.
    """
    shipped = _ship(docs.sparkSession, model_file)

    def scan(batches):
        encoder = Encoder(Vocabulary(**shipped.value), seed, dropout)
        for batch in batches:
            for part in steps(batch, "text", STEP):
                texts = as_bytes(part.column("text"))
                pieces, bounds = encoder.encode(part.column("doc_id").to_pylist(), texts)
                spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
                right = [None if t is None else decode_ids(encoder.vocabulary, pieces[a:b].tolist()) == t for t, (a, b) in zip(texts, spans, strict=True)]
                ids = lists(pieces, bounds, pa.int32())
                if None in right:
                    ids = pa.array([None if r is None else pieces[a:b] for r, (a, b) in zip(right, spans, strict=True)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, pa.array(right, pa.bool_())], names=["doc_id", "ids", "lossless"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, ids array<int>, lossless boolean")


def decode(pieces: DataFrame, model_file: str) -> DataFrame:
    """``doc_id`` and ``text`` of every row with ``doc_id`` and ``ids``; null ids give a null text, no ids an empty one.

    Rows with a null id and repeated rows come back once each; other columns are not read; an empty table gives no rows.
    """
    shipped = _ship(pieces.sparkSession, model_file)

    def scan(batches):
        vocabulary = Vocabulary(**shipped.value)
        for batch in batches:
            texts = [None if x is None else decode_ids(vocabulary, x).decode() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return pieces.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(scan, "doc_id long, text string")
