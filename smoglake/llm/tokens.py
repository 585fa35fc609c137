"""Token ids of whole texts by a byte-level BPE tokenizer, with a cache of text pieces.

The tokenizer first cuts a text into pieces (words with their leading blank,
numbers, punctuation, blanks) and encodes each piece by itself. Here the
cutting is done by one compiled expression and every distinct piece goes
through the tokenizer's model once per worker, as long as it is among the
pieces used lately. That gives the tokenizer's own
ids; texts with characters outside the range that the expression is built for
go to the tokenizer whole, and so do texts that hold one of its added tokens.
"""

from __future__ import annotations

import functools
import re
import unicodedata
import weakref
from array import array

import numpy as np

#: Characters for which the piece classes are built (assigned ones below this code point).
COVERED = 0x2100
CACHE_PIECES = 300_000  # of the newer and of the older pieces

# The contractions and classes of the byte-level piece pattern.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _class(kinds: str) -> str:
    """Ranges of the covered characters whose category starts with one of ``kinds``."""
    ranges: list[list[int]] = []
    for code in range(COVERED):
        if unicodedata.category(chr(code))[0] in kinds:
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ranges)


@functools.cache
def _patterns() -> tuple[re.Pattern, re.Pattern]:
    letter, number = _class("L"), _class("N")
    pieces = re.compile(f"{CONTRACTIONS}| ?[{letter}]+| ?[{number}]+| ?[^{SPACES}{letter}{number}]+"
                        f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
    assigned = "".join(_class(k) for k in "LMNPSZ") + "\\u0000-\\u001f\\u007f-\\u009f"
    return pieces, re.compile(f"[^{assigned}]")


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def _added(path: str) -> re.Pattern | None:
    """Finds the tokenizer's added tokens, which it takes out of a text before it cuts the rest."""
    names = [x.content for x in _tokenizer(path).get_added_tokens_decoder().values()]
    return re.compile("|".join(map(re.escape, names))) if names else None


def _byte_letters() -> str:
    """The letter that stands for each byte in the vocabulary: itself if it is visible, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return "".join(chr(b) if b in seen else chr(next(spare)) for b in range(256))


class Known(dict):
    """The ids of an encoder's newer pieces; looking up another piece encodes it or takes it from the older ones."""

    def __init__(self, encoder: Encoder):
        self.encoder = weakref.proxy(encoder)  # no cycle: a dropped encoder frees its pieces at once

    def __missing__(self, piece: str) -> bytes:
        encoder = self.encoder
        if len(self) >= CACHE_PIECES:
            encoder.older = dict(self)
            self.clear()
        made = self[piece] = encoder.older.get(piece) or encoder._piece(piece)
        return made


class Encoder:
    """Encodes lists of texts to little-endian uint32 id strings."""

    def __init__(self, path: str):
        self.path = path
        self.known: dict[str, bytes] = Known(self)
        self.older: dict[str, bytes] = {}  # known before the cache was last full
        self.letters = dict(enumerate(_byte_letters()))

    def _whole(self, texts: list[str]) -> list[bytes]:
        made = _tokenizer(self.path).encode_batch(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in made]

    def _piece(self, piece: str) -> bytes:
        spelled = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in _tokenizer(self.path).model.tokenize(spelled)]).tobytes()

    def encode(self, texts: list[str], group: int = 64) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(texts), group):
            out += self._group(texts[at:at + group])
        return out

    def _group(self, texts: list[str]) -> list[bytes]:
        pattern, uncovered = _patterns()
        added = _added(self.path)
        ids = self.known.__getitem__
        return [self._whole([x])[0] if not x.isascii() and uncovered.search(x) or added and added.search(x)
                else b"".join(map(ids, pattern.findall(x))) for x in texts]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder, with its cache, per worker and tokenizer file."""
    return Encoder(path)
