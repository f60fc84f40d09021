"""Token ids of whole texts by the tokenizers library, with a bounded cache of word pieces.

A byte-level BPE never merges across the borders of its pre-tokenizer, so a text can be cut at
borders that certainly are such borders, each distinct piece encoded once, and the ids joined.
Pieces of plain letters go straight to the BPE model, other ASCII ones after the cuts that the pre-tokenizer
makes in them; everything else goes through the whole tokenizer.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

_N, _W = r"[\S\x1c-\x1f]", r"[^\S\x1c-\x1f]"
_PLAIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
_PIECES = re.compile(rf"{_PLAIN.pattern}(?![^.,\s])|{_W}+(?!{_N})| ?{_N}+|{_W}+")
#: What the pre-tokenizer cuts ASCII text into.
_ASCII = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
_CACHE_ENTRIES = 600_000


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


_LETTERS = _byte_letters()
_open: dict[int, TextEncoder] = {}


def encoder(vocabulary: str) -> TextEncoder:
    """The encoder of this vocabulary in this Python worker; its cache lives as long as the worker."""
    key = hash(vocabulary)
    if key not in _open:
        _open.clear()
        _open[key] = TextEncoder(vocabulary)
    return _open[key]


class _Pieces(dict):
    """piece -> its ids as little-endian 32-bit bytes; when half full, forgets what was not met since it last was."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.before = encode, {}

    def __missing__(self, piece):
        if len(self) >= _CACHE_ENTRIES // 2:
            self.before = dict(self)
            self.clear()
        ids = self.before.get(piece)
        if ids is None:
            ids = self.encode(piece)
        self[piece] = ids
        return ids


class TextEncoder:
    """Encodes texts with a tokenizers JSON vocabulary, ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        told = json.loads(vocabulary)
        before = told.get("pre_tokenizer") or {}
        self.byte_level = before.get("type") == "ByteLevel" and before.get("add_prefix_space") is False
        # Where nothing else changes a text, ASCII is cut here as the pre-tokenizer would.
        self.own_cuts = self.byte_level and before.get("use_regex", True) and told.get("normalizer") is None
        self.model = self.tokenizer.model
        self.packed = [i.to_bytes(4, "little") for i in range(1 + max(self.tokenizer.get_vocab().values(), default=0))]
        self.pieces = _Pieces(self._piece_ids)

    def _whole_ids(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece_ids(self, piece: str) -> bytes:
        if self.own_cuts and piece.isascii():
            parts = [piece] if piece.strip(" ").isalpha() else _ASCII.findall(piece)
        elif _PLAIN.fullmatch(piece):
            parts = [piece]
        else:
            return self._whole_ids(piece)
        found, tokenize, packed = [], self.model.tokenize, self.packed
        for part in parts:
            found += [packed[t.id] for t in tokenize(part.encode().decode("latin-1").translate(_LETTERS))]
        return b"".join(found)

    def ids(self, text: str) -> bytes:
        """All ids of a whole text, the same as encoding it in one call."""
        if not self.byte_level or any(s in text for s in self.special):
            return self._whole_ids(text)
        return b"".join(map(self.pieces.__getitem__, _PIECES.findall(text)))


def _packed(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(4, "little") for i in ids])


def encode_texts(vocabulary: str, texts: Iterable[str | None], end_id: int = 0) -> Iterator[bytes]:
    """Ids of each text (null: empty) and then ``end_id``."""
    encode, end = encoder(vocabulary).ids, end_id.to_bytes(4, "little")
    for text in texts:
        yield (encode(text) if text else b"") + end
