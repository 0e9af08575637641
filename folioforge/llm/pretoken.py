"""Byte-level pre-tokenisation over code-point arrays, and a bounded cache from pieces to token ids.

The split is that of the public pattern 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+,
found with array operations for a whole slice of documents at once. White space is Unicode's White_Space.
"""

from __future__ import annotations

import struct
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np

from folioforge.llm import arrays

_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3
#: Unicode White_Space.
_WHITE = [9, 10, 11, 12, 13, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """The class of each code point, made once a process."""
    if not _classes:
        kinds = {"L": _LETTER, "N": _NUMBER}
        table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
        table[_WHITE] = _SPACE
        _classes.append(table)
    return _classes[0]


def piece_starts(chars: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Starts of the pieces of documents chars[offs[i]:offs[i + 1]], uint32 code points."""
    n = len(chars)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[chars]
    head = np.zeros(n + 1, bool)
    head[offs[:-1]] = True
    head = head[:n]
    last = np.zeros(n, bool)
    last[offs[1:][offs[1:] > offs[:-1]] - 1] = True
    space = kind == _SPACE
    before_space = np.concatenate([[False], space[:-1]]) & ~head
    next_solid = np.concatenate([~space[1:], [False]]) & ~last
    before_blank = np.concatenate([[False], chars[:-1] == 0x20]) & ~head
    changed = np.concatenate([[True], kind[1:] != kind[:-1]])
    # A run of white space starts a piece; of a longer run before a solid, the last one starts another.
    start = head | (space & (~before_space | (next_solid & before_space))) | (~space & np.where(before_space, ~before_blank, changed))
    quote = np.flatnonzero(start & (chars == 0x27) & ~last)
    if len(quote):
        padded = np.concatenate([chars, np.zeros(2, chars.dtype)])
        a, b = padded[quote + 1], padded[quote + 2]
        room = ~last[quote + 1]
        short = np.isin(a, [ord(c) for c in "stmd"])
        long = room & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        start[quote[short | long] + 1] = False
        start[quote[long] + 2] = False
        after = np.concatenate([quote[short] + 2, quote[long] + 3])
        start[after[after < n]] = True
    return np.flatnonzero(start)


class PieceCache:
    """Ids of pieces, each encoded once and kept, up to a bound: the half that was not asked for lately goes.

    The pieces of a slice are grouped by hash and compared with their group's first piece, character by character;
    groups are looked up by the piece itself.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], most: int = 1 << 20):
        self.encode, self.most = encode, most
        self.young: dict[str, bytes] = {}  # ids as unsigned 32-bit integers
        self.old: dict[str, bytes] = {}

    def _ids(self, pieces: list[str]) -> list[bytes]:
        young, old = self.young, self.old
        new = []
        for piece in pieces:
            if piece not in young:
                ids = old.get(piece)
                if ids is None:
                    new.append(piece)
                else:
                    young[piece] = ids
        if new:
            new = list(dict.fromkeys(new))
            young.update((p, struct.pack(f"{len(x)}I", *x)) for p, x in zip(new, self.encode(new), strict=True))
        out = [young[p] for p in pieces]
        if 2 * len(young) > self.most:
            self.young, self.old = {}, young
        return out

    def __call__(self, chars: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the documents, one after another, and the n + 1 places of each document's ids."""
        starts = piece_starts(chars, offs)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        ends = np.append(starts[1:], len(chars))
        _, first, group = np.unique(arrays.span_hash(chars, starts, ends), return_index=True, return_inverse=True)
        odd = self._differ(chars, starts, ends, first[group])
        if len(odd):  # two pieces with one hash: each is a group of its own
            group[odd] = len(first) + np.arange(len(odd))
            first = np.concatenate([first, odd])
        text = chars.astype("<u4").tobytes().decode("utf-32-le")
        found = self._ids([text[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
        ids = np.frombuffer(b"".join(found), np.uint32)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        off, lens = (np.cumsum(size) - size)[group], size[group]
        total = np.concatenate([[0], np.cumsum(lens)])
        return arrays.ragged(ids, off, lens), total[np.searchsorted(starts, offs)]

    @staticmethod
    def _differ(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The pieces that aren't the piece numbered in of."""
        lens = ends - starts
        bad = lens != ends[of] - starts[of]
        shift = np.where(bad, 0, starts[of] - starts)
        same = chars == chars[np.arange(len(chars)) + np.repeat(shift, lens)]  # the pieces cover chars
        return np.flatnonzero(bad | (np.add.reduceat(~same, starts) > 0))


def texts_as_chars(texts: list[str | None], limit: int = arrays.SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices (i, j, chars, offs) of the texts; null counts as empty."""
    lens = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
    offs = np.concatenate([[0], np.cumsum(lens)])
    for i, j in arrays.slices(offs, limit):
        chars = np.frombuffer("".join(t or "" for t in texts[i:j]).encode("utf-32-le"), np.uint32)
        yield i, j, chars, offs[i : j + 1] - offs[i]
