import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marajo.llm import pieces
from marajo.llm.queries import PIECE_MODEL

from .common import AWKWARD, docs

pytestmark = pytest.mark.skipif(not os.path.exists(PIECE_MODEL), reason="no vocabulary file")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(PIECE_MODEL)


@pytest.fixture(scope="module")
def processor():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PIECE_MODEL)


TEXT = st.text(alphabet=st.sampled_from("aeiou the tion\n  Éçßñ日😀#"), max_size=80)


@settings(max_examples=80, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_without_dropout_it_is_the_model_own_encoding(vocabulary, processor, texts):
    flat, bounds = pieces.Encoder(vocabulary, 1, 0.0).encode(list(range(len(texts))), [t.encode() for t in texts])
    for t, a, b in zip(texts, bounds, bounds[1:]):
        assert flat[a:b].tolist() == processor.encode(t)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5), st.sampled_from([0.0, 0.1, 0.5, 1.0]))
def test_any_text_decodes_losslessly(vocabulary, texts, dropout):
    flat, bounds = pieces.Encoder(vocabulary, 7, dropout).encode(list(range(len(texts))), [t.encode() for t in texts])
    for t, a, b in zip(texts, bounds, bounds[1:]):
        assert pieces.decode_ids(vocabulary, flat[a:b].tolist()) == t.encode()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdehinorst ", min_size=1, max_size=60), st.integers(0, 3))
def test_equal_lengths_at_once_equal_one_agenda(vocabulary, chunk, draw):
    e = pieces.Encoder(vocabulary, 3, 0.2)
    chunk = chunk.encode()
    flat, _ = e.segment([chunk], np.array([draw]))
    assert flat.tolist() == pieces.agenda(vocabulary, chunk.decode(), int(e.keys([chunk], np.array([draw]))[0]), 0.2)


def brute(processor, chunk, key, dropout):
    """Piece ids of a chunk with every candidate looked for again after each merge, from the model's own tables."""
    ids = {processor.id_to_piece(i): i for i in range(processor.get_piece_size()) if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i))}
    mask = 2**64 - 1

    def mix(x):
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
            x = ((x ^ x >> shift) * factor) & mask
        return x ^ x >> 32

    parts = [(i, c.replace(" ", "▁")) for i, c in enumerate(chunk)]
    while True:
        found = []
        for k, ((at, left), (_, right)) in enumerate(zip(parts, parts[1:])):
            piece = ids.get(left + right)
            if piece is not None and mix((key ^ at * 0x9E3779B97F4A7C15 ^ piece * 0xC2B2AE3D27D4EB4F) & mask) >= dropout * 2**64:
                found.append((-processor.get_score(piece), piece, at, k))
        if not found:
            break
        _, _, at, k = min(found)
        parts[k : k + 2] = [(at, parts[k][1] + parts[k + 1][1])]
    out = []
    for _, text in parts:
        out += [ids[text]] if text in ids else [processor.piece_to_id(f"<0x{b:02X}>") for b in text.encode()]
    return out


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdehinorst é日", min_size=1, max_size=70), st.integers(0, 2**64 - 1), st.sampled_from([0.1, 0.4]))
def test_dropout_equals_brute_force(vocabulary, processor, text, draw, dropout):
    e = pieces.Encoder(vocabulary, 9, dropout)
    chunk = (" " + text.replace(" ", "")).encode()
    flat, _ = e.segment([chunk], np.array([draw], np.uint64))
    assert flat.tolist() == brute(processor, chunk.decode(), int(e.keys([chunk], np.array([draw], np.uint64))[0]), dropout)


def test_other_models_are_refused(monkeypatch):
    import sentencepiece

    class Upper(sentencepiece.SentencePieceProcessor):
        def encode(self, text, *more, **options):
            return super().encode(text.upper(), *more, **options)

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Upper)
    with pytest.raises(ValueError, match="normalises"):
        pieces.load(PIECE_MODEL)


def test_a_long_line_without_spaces_takes_seconds(vocabulary):
    import time

    start = time.time()
    text = b"understandings" * 20_000
    flat, _ = pieces.Encoder(vocabulary, 5, 0.1).encode([1], [text])
    assert pieces.decode_ids(vocabulary, flat.tolist()) == text and time.time() - start < 20


def test_dropout_varies_with_place_and_repeats_with_the_seed(vocabulary):
    text = [b"international understanding " * 40]
    one = pieces.Encoder(vocabulary, 5, 0.3).encode([1], text)[0].tolist()
    assert one == pieces.Encoder(vocabulary, 5, 0.3).encode([1], text)[0].tolist()
    assert one != pieces.Encoder(vocabulary, 6, 0.3).encode([1], text)[0].tolist()
    plain = pieces.Encoder(vocabulary, 5, 0.0).encode([1], text)[0].tolist()
    assert len(one) > len(plain)
    word, cuts = b"internationalisation", set()
    for i in range(200):  # no bound on the cuts of a word
        cuts.add(tuple(pieces.Encoder(vocabulary, 5, 0.3).encode([i], [word])[0].tolist()))
    assert len(cuts) > 16


def test_awkward_rows_round_trip(spark):
    found = pieces.encode(docs(spark), PIECE_MODEL)
    assert all(r.lossless is None if r.ids is None else r.lossless for r in found.collect())
    back = pieces.decode(found, PIECE_MODEL).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in back))) == sorted(map(str, AWKWARD))
    assert pieces.encode(docs(spark, []), PIECE_MODEL).collect() == []
