"""Packing: every id in one piece, sequences full but the last."""

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from logharrow.llm.packing import assemble, pack, tokenise

PATH = P.path("word_bpe_49k.json")


def test_round_trip(docs, awkward):
    pieces = pack(tokenise(docs(awkward), PATH), 64).toPandas()
    whole = Tokenizer.from_file(PATH)
    want = sorted([*whole.encode(t or "", add_special_tokens=False).ids, 2] for _, t in awkward)
    got = []
    for (_, _), g in pieces.sort_values("start").groupby([pieces.doc_id.fillna(-1), pieces.sequence_id * 64 + pieces.offset - pieces.start]):
        assert list(g.start) == list(np.cumsum([0, *g.length])[:-1]) and g.length.sum() == g.doc_tokens.iloc[0]
        got.append(np.frombuffer(b"".join(g.ids), "<u4").tolist())
    assert sorted(got) == want
    sizes = pieces.groupby("sequence_id").length.sum()
    assert (sizes[:-1] == 64).all() and list(sizes.index) == list(range(len(sizes)))
    for _, g in pieces.sort_values("offset").groupby("sequence_id"):
        assert list(g.offset) == list(np.cumsum([0, *g.length])[:-1])


def test_assembled(docs):
    pieces = pack(tokenise(docs(["one two three", "four five"]), PATH), 4)
    ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in assemble(pieces).orderBy("sequence_id").collect()])
    assert sorted(ids.tolist()) == sorted(i for t in ("one two three", "four five") for i in [*Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids, 2])


def test_empty(docs):
    assert pack(tokenise(docs([]), PATH)).count() == 0
