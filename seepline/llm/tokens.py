"""Token ids of whole texts, as packed little-endian unsigned 32-bit numbers.

Byte-level BPE encodes each word by itself, so ids are kept per word. Words come from the
published splitting rule; for texts with only Latin letters it is written out for arrays
(letters and numbers by their Unicode class), others go through the tokenizer whole.
"""

from __future__ import annotations

import re
import struct
import unicodedata

import numpy as np
import pyarrow as pa

_LATIN = 0x250
#: words that are kept, twice over
_CACHED = 100_000


def _kind(point: str) -> int:
    """Letter 0, number 1, white space by the Unicode property 3, any other 2."""
    return 3 if point in "\t\n\x0b\x0c\r \x85\xa0" else {"L": 0, "N": 1}.get(unicodedata.category(point)[0], 2)


_BLANK = 3
_KINDS = np.array([_kind(c) for c in map(chr, range(_LATIN))], np.uint8)
_BEYOND = re.compile(f"[^\\x00-{chr(_LATIN - 1)}]")
_ENDINGS = {"s", "t", "m", "d"}, {"re", "ve", "ll"}


def word_starts(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Marks where words start in Latin texts put end to end, given as code points and the
    places of the texts' first ones. The splitting rule, as a pattern, is

    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
    """
    n, kinds = len(points), _KINDS[points]
    starts, first = np.ones(n, bool), np.zeros(n, bool)
    first[firsts] = True
    np.not_equal(kinds[1:], kinds[:-1], out=starts[1:])
    starts |= first
    # the last blank before a word: a space belongs to the word, any other stands alone
    blank = kinds == _BLANK
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & ~first[1:])
    starts[last] = True
    starts[last[points[last] == ord(" ")] + 1] = False
    quotes = np.flatnonzero(points == ord("'"))
    for at in quotes[starts[quotes]].tolist():
        for size, endings in enumerate(_ENDINGS, 1):
            end = at + 1 + size
            if end <= n and not first[at + 1 : end].any() and "".join(map(chr, points[at + 1 : end])) in endings:
                starts[at + 1] = False
                starts[end : end + 1] = True
    return starts


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself if
    printable, else the next unused code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class PieceEncoder:
    """Encodes texts with a public tokenizer file; strings of special tokens are plain text."""

    def __init__(self, name: str):
        import os

        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        path = name if "/" in name else public_tokenizers.path(name)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.letters = byte_letters()
        self.model = self.tokenizer.model
        # words met of late, and those before them
        self.known: dict[bytes, bytes] = {}
        self.past: dict[bytes, bytes] = {}

    def _word(self, word: bytes) -> bytes:
        if len(self.known) >= _CACHED:
            self.known, self.past = {}, self.known
        packed = self.past.get(word)
        if packed is None:
            ids = [t.id for t in self.model.tokenize(word.decode("latin-1").translate(self.letters))]
            packed = struct.pack(f"<{len(ids)}I", *ids)
        self.known[word] = packed
        return packed

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _latin(self, texts: list[str]) -> list[bytes]:
        """Ids of Latin texts. Each distinct word of the texts is looked up once."""
        joined = "".join(texts)
        if not joined:
            return [b""] * len(texts)
        raw = joined.encode()
        ends = np.cumsum([len(t) for t in texts])
        firsts = np.r_[0, ends[:-1]]
        points = np.frombuffer(raw, np.uint8) if len(raw) == len(joined) else np.frombuffer(joined.encode("utf-32-le"), "<u4")
        at = np.flatnonzero(word_starts(points, firsts[firsts < len(points)]))
        place = at if len(raw) == len(joined) else at + np.cumsum(points >= 0x80)[at] - (points[at] >= 0x80)
        offsets = np.append(place, len(raw)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).dictionary_encode()
        packed = [self.known.get(w) or self._word(w) for w in words.dictionary.to_numpy(zero_copy_only=False).tolist()]
        sizes = np.array([len(p) // 4 for p in packed])
        ids, begin = np.frombuffer(b"".join(packed), "<u4"), np.cumsum(sizes) - sizes
        codes = words.indices.to_numpy()
        size = sizes[codes]
        upto = np.cumsum(size)
        out = ids[np.arange(upto[-1]) + np.repeat(begin[codes] - upto + size, size)]
        edges = np.r_[0, upto][np.searchsorted(at, np.r_[0, ends])]
        return [out[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        beyond = [bool(_BEYOND.search(t)) for t in texts]
        latin = iter(self._latin([t for t, b in zip(texts, beyond, strict=True) if not b]))
        return [self.whole(t) if b else next(latin) for t, b in zip(texts, beyond, strict=True)]

    def __call__(self, text: str) -> bytes:
        return self.batch([text])[0]
