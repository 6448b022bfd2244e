"""Piece-wise encoding equals encoding each text whole."""

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from logharrow.llm.tokens import PieceEncoder

ENCODERS = {f: (PieceEncoder(P.path(f), drops), Tokenizer.from_file(P.path(f))) for f, drops in (("byte_bpe_50k.json", False), ("word_bpe_49k.json", True))}
for _, whole in ENCODERS.values():
    whole.encode_special_tokens = True
ODD = ["", " ", "  a  b ", "\n\n a\t b\r\nc", "it's we'll 's 'S x'd", "ÀÉ İI ß ẞ ΑΣ Σ. σ", "e\u0301 e \u0301", "\x1c a\x1db \x85c", "a\xa0b\u2003c\u3000 d", "日本語 テスト 😀 👩‍👩‍👧", "<|endoftext|> a <|startoftext|>", "12 345 ½ ² x²", "a" * 500, "###*** a%%% b&&&", "\u200b a\u200b"]


@pytest.mark.parametrize("name", ENCODERS)
def test_odd_texts(name):
    pieces, whole = ENCODERS[name]
    for texts in (ODD, ODD[::-1], [t + " " + u for t in ODD for u in ODD]):
        assert [list(np.frombuffer(x, "<u4")) for x in pieces.encode(texts)] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", ENCODERS)
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'.,aAéÉsSdtß1²-_|\x85\xa0\u2028\x1f"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=5))
def test_random_texts(name, texts):
    pieces, whole = ENCODERS[name]
    assert [list(np.frombuffer(x, "<u4")) for x in pieces.encode(texts)] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", ENCODERS)
def test_frequent_pieces_are_encoded_once(name, monkeypatch):
    """Words that come back stay known while one-off words pass, and are one piece whatever punctuation follows."""
    monkeypatch.setattr("logharrow.llm.tokens.CACHE_ENTRIES", 200)
    pieces = PieceEncoder(P.path(name), name.startswith("word"))
    whole, asked = ENCODERS[name][1], []
    encode = pieces.cache.encode
    pieces.cache.encode = lambda piece: asked.append(piece.strip()) or encode(piece)
    for k in range(100):
        text = " " + "".join(f" come{end}" for end in ".,;:!?") + "".join(f" once{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + i)}" for i in range(20))
        assert list(np.frombuffer(pieces.encode([text])[0], "<u4")) == whole.encode(text, add_special_tokens=False).ids
    assert asked.count("come") == 1 and len(asked) < 2100 and len(pieces.cache) + len(pieces.cache.older) <= 200
