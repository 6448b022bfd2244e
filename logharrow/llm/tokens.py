"""Token ids by the tokenizers library, with a bounded cache of pieces cut at safe white space."""

from __future__ import annotations

import re
import struct

import numpy as np

#: Letters whose lower case is Python's and that every pattern takes for letters, and punctuation but for the apostrophe.
LETTERS, MARKS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff", r"!-&(-/:-@\[-`{-~"
#: Such letters, with at most one space before them, up to white space or such punctuation; such punctuation up to white space
#: or such letters; else a run without white space with at most one space before it, or white space as byte-level patterns cut it.
CHUNKS = re.compile(rf" ?[{LETTERS}]++(?![^\s{MARKS}])|[{MARKS}]++(?![^\s{LETTERS}])| ?[^\s]+|\s+(?!\S)|\s+")
#: For vocabularies that drop white space: cut at plain blanks and line ends only.
PLAIN_CHUNKS = re.compile(rf"[{LETTERS}]++(?![^ \n{MARKS}])|[{MARKS}]++(?![^ \n{LETTERS}])|[^ \n]+")
#: What is one piece to the vocabularies' patterns.
SIMPLE = re.compile(rf" ?[{LETTERS}]+|[{MARKS}]+")
#: Control characters that Python counts as white space and the tokenizers' patterns don't: such a text is encoded whole.
ODD_SPACE = re.compile("[\x1c-\x1f]")
CACHE_ENTRIES = 300_000
LONGEST_CACHED = 64

_encoders: dict[tuple[str, bool], "PieceEncoder"] = {}


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Pieces(dict):
    """Ids of pieces; one that is missing is encoded. When half of the bound is full, the older half goes, but for what is looked up again."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, piece: str) -> bytes:
        raw = self.older.get(piece)
        if raw is None:
            raw = self.encode(piece)
        if len(piece) <= LONGEST_CACHED:
            if len(self) >= CACHE_ENTRIES // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = raw
        return raw


class PieceEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids; equal to encoding each text whole.

    The tokenizers' own pre-tokenisation never joins characters across the cuts made here, so a piece has the
    same ids alone as inside its text. A piece that it would leave whole goes to the library's model at once.
    """

    def __init__(self, path: str, drops_space: bool):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # such strings in a text are ordinary text
        self.drops_space = drops_space
        self.model, self.cache = self.tokenizer.model, Pieces(self._piece)
        self.top_id = max(self.tokenizer.get_vocab().values())
        spelt = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        #: what the library's byte-level alphabet has for a letter beyond ASCII, in lower case if that comes first, and for the space
        self.alphabet = str.maketrans({c: spelt(c.lower() if drops_space else c)[0][0] for c in " " + "".join(map(chr, range(0xC0, 0x100)))} | ({chr(c): chr(c + 32) for c in range(65, 91)} if drops_space else {}))
        self.blank = spelt(" ")[0][0]

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        body = piece[1:] if piece[:1] == " " else piece
        if body.isascii() and body.isalpha():
            text = piece.lower() if self.drops_space else piece if body is piece else self.blank + body
        elif SIMPLE.fullmatch(piece):
            text = piece.translate(self.alphabet)
        else:
            return self._ids(piece)
        ids = [t.id for t in self.model.tokenize(text)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        cut, known, out = (PLAIN_CHUNKS if self.drops_space else CHUNKS).findall, self.cache.__getitem__, []
        for t in texts:
            if ODD_SPACE.search(t):
                out.append(self._ids(t))
            else:
                # lower case comes first in a vocabulary that drops space; for these letters it is Python's
                out.append(b"".join(map(known, cut(t.lower() if self.drops_space and _latin(t) else t))))
        return out


def encoder(path: str, drops_space: bool) -> PieceEncoder:
    """One encoder for each worker process and vocabulary."""
    key = (path, drops_space)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, drops_space)
    return _encoders[key]


def text_batches(batches, column: str, limit: int = 1 << 21):
    """Cut Arrow batches at about `limit` characters of text; yields (piece, texts), null as empty."""
    for batch in batches:
        texts = [t or "" for t in batch.column(column).to_pylist()]
        start = held = 0
        for i, t in enumerate(texts):
            held += len(t)
            if held >= limit:
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, held = i + 1, 0
        if start < len(texts):
            yield batch.slice(start), texts[start:]
