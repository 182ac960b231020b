"""Rounds of recompression over word sequences: equal substrings get equal interior symbols, whatever surrounds them."""

from __future__ import annotations

import numpy as np

from .textbuf import U64, Words, mix

#: Rounds of pair naming. Each shortens a sequence by about a quarter and widens what a symbol depends on.
ROUNDS = 3
#: Words from which an anchor is rare enough to be preferred.
SURE = 5
_NONE = U64((1 << 64) - 1)
_FAR = 1 << 40


class Symbols:
    """Symbols of all rows in order: ``name``, words [start, end), ``row``, and the words [low, high) that fix the symbol.

    A symbol is the same wherever the words [low, high) stand; a bound beyond the row (a decision that the row's edge
    took part in) is far away.
    """

    def __init__(self, w: Words):
        n = len(w)
        self.name, self.row = w.h.copy(), w.doc
        self.start, self.end = np.arange(n), np.arange(1, n + 1)
        self.low, self.high = self.start.copy(), self.end.copy()

    def _sides(self) -> tuple[np.ndarray, np.ndarray]:
        """low of the symbol before and high of the symbol after, far away at a row's edge."""
        n = len(self.name)
        before, after = np.full(n, -_FAR), np.full(n, _FAR)
        if n > 1:
            same = self.row[1:] == self.row[:-1]
            before[1:][same] = self.low[:-1][same]
            after[:-1][same] = self.high[1:][same]
        return before, after

    def _group(self, head: np.ndarray, name: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Merge each head with what follows it up to the next head; ``name`` is the heads' new name."""
        at = np.flatnonzero(head)
        last = np.append(at[1:], len(head)) - 1
        self.name, self.row, self.start, self.end = name[at], self.row[at], self.start[at], self.end[last]
        self.low, self.high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)

    def name_runs(self) -> None:
        """Each maximal run of one symbol becomes a symbol, named by the symbol and the run's length."""
        n = len(self.name)
        if n < 2:
            return
        head = np.ones(n, bool)
        head[1:] = (self.name[1:] != self.name[:-1]) | (self.row[1:] != self.row[:-1])
        at = np.flatnonzero(head)
        length = np.diff(np.append(at, n))
        before, after = self._sides()
        low, high = np.minimum(self.low, before), np.maximum(self.high, after)
        name = self.name.copy()
        long = length > 1
        name[at[long]] = mix(name[at[long]] * U64(0x9FB21C651E98DF25) + length[long].astype(U64))
        self._group(head, name, low, high)

    def name_pairs(self, salt: int) -> None:
        """Symbols are dealt to a left and a right class by a hash of their name; each left one and a right one after it
        become one symbol, so pairs never overlap. One that stays alone also depends on the neighbour that it missed."""
        n = len(self.name)
        if n < 2:
            return
        right = (mix(self.name ^ U64(salt)) & U64(1)).astype(bool)
        pair = np.zeros(n, bool)
        pair[:-1] = ~right[:-1] & right[1:] & (self.row[:-1] == self.row[1:])
        second = np.zeros(n, bool)
        second[1:] = pair[:-1]
        alone = ~pair & ~second
        before, after = self._sides()
        low = np.where(alone & right, np.minimum(self.low, before), self.low)
        high = np.where(alone & ~right, np.maximum(self.high, after), self.high)
        name = self.name.copy()
        i = np.flatnonzero(pair)
        name[i] = mix(name[i] * U64(0xD6E8FEB86659FD93) + name[i + 1] + U64(salt))
        self._group(~second, name, low, high)


def recompress(w: Words, rounds: int = ROUNDS) -> Symbols:
    s = Symbols(w)
    s.name_runs()
    for k in range(rounds):
        s.name_pairs(0x5851F42D4C957F2D * (k + 1) % (1 << 64))
    return s


def anchors(w: Words, width: int, names: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(first word, anchor) of every window of ``width`` words of one row.

    A window's anchor is one of the symbols that its words alone fix, with the words that fix it: by hash, those with
    SURE words or more first. So every occurrence of a window's word sequence has the same anchor. A window that fixes
    none is its own anchor. ``names``: w.grams(width).
    """
    at, own = names
    s = recompress(w, rounds)
    ok = (s.high - s.low <= width) & (s.low >= 0) & (s.high <= len(w))
    low, high = s.low[ok], s.high[ok]
    first, spare = high - width, width - (high - low)
    context = mix(w.ranges(low, high))
    key = ((high - low < SURE).astype(U64) << U64(62)) | (context >> U64(2))
    best = np.full(len(w) + 1, _NONE, U64)
    for t in range(width):
        use = np.flatnonzero((spare >= t) & (first + t >= 0))
        if not len(use):
            break
        np.minimum.at(best, first[use] + t, key[use])
    anchor = best[at]
    none = anchor == _NONE
    anchor[none] = own[none] | (U64(1) << U64(63))
    return at, anchor
