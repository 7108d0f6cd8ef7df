"""Double-array tries over word symbols, built and walked in numpy.

A word is a 64-bit symbol; the alphabet numbers the symbols, common ones
first, and a number is written as two digits, so that a state has few and
close children whatever the size of the vocabulary. State ``s`` goes to
``base[s] + digit`` if that place's ``check`` is ``s``; the root is place 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Place tests per search window; windows tried before children go behind all that is placed; share taken at which
#: searches begin behind a window.
WINDOW_TESTS, WINDOWS, FULL = 1 << 13, 6, 0.9
#: Parents of up to so many children are placed together, by drawing places for all at once so many times.
FEW, DRAWS = 16, 24
#: ``check`` of a free place, and of the root.
FREE, ROOT = -1, -2


@dataclass
class WordTrie:
    symbols: np.ndarray         # the alphabet, ascending
    numbers: np.ndarray         # the number of each symbol
    radix: int
    base: np.ndarray
    check: np.ndarray           # the state that leads here
    accepts: np.ndarray         # whether a phrase ends here

    def _step(self, state: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which states go on, where to)."""
        to = self.base[state].astype(np.int64) + digit
        on = (to > 0) & (to < len(self.check))
        on[on] = self.check[to[on]] == state[on]
        return on, to[on]

    def advance(self, number: np.ndarray, piece: np.ndarray, levels: int,
                first: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(level, last word of each live state, state) after every word: the states of all positions step together.

        ``number`` holds the words' numbers in the trie's alphabet, -1 for others (``Alphabet``); only the positions
        ``first`` begin, if given.
        """
        end = np.flatnonzero(number >= 0) if first is None else first[number[first] >= 0]
        state = np.zeros(len(end), np.int64)
        for level in range(1, levels + 1):
            if level > 1:
                inside = end + 1 < len(number)
                end, state = end[inside] + 1, state[inside]
                step = (piece[end] == piece[end - 1]) & (number[end] >= 0)
                end, state = end[step], state[step]
            for digit in (np.floor_divide, np.remainder):
                on, state = self._step(state, digit(number[end], self.radix))
                end = end[on]
            yield level, end, state


class Alphabet:
    """The symbols of several tries together: a text's symbols are looked up once for all of them."""

    def __init__(self, tries: dict[int, WordTrie]):
        self.symbols = np.unique(np.concatenate([t.symbols for t in tries.values()]))
        self.numbers = {}
        for b, t in tries.items():
            own = np.full(len(self.symbols) + 1, -1, np.int32)          # the last place: no word of any trie
            own[np.searchsorted(self.symbols, t.symbols)] = t.numbers
            self.numbers[b] = own

    def places(self, symbols: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.symbols, symbols), len(self.symbols) - 1)
        return np.where(self.symbols[at] == symbols, at, len(self.symbols))


def build(phrases: np.ndarray) -> tuple[WordTrie, np.ndarray]:
    """The trie of distinct phrases (rows of symbols, 0 behind the last), and the state that accepts each."""
    real = phrases > 0
    symbols, inverse, times = np.unique(phrases[real], return_inverse=True, return_counts=True)
    numbers = np.empty(len(symbols), np.int64)
    numbers[np.argsort(-times, kind="stable")] = np.arange(len(symbols))
    radix = max(int(np.ceil(np.sqrt(len(symbols)))), 1)
    number = np.zeros(phrases.shape, np.int64)
    number[real] = numbers[inverse]
    digits = np.stack([number // radix, number % radix], 2).reshape(len(phrases), -1)
    length = 2 * real.sum(1)
    places = _Places()
    state = np.zeros(len(phrases), np.int64)            # the state of each phrase's digits so far
    for depth in range(digits.shape[1]):
        on = np.flatnonzero(length > depth)
        edges, which = np.unique(state[on] * radix + digits[on, depth], return_inverse=True)
        state[on] = places.children(edges // radix, edges % radix)[which]
    base, check = places.arrays()
    accepts = np.zeros(len(check), bool)
    accepts[state] = True
    return WordTrie(symbols, numbers, radix, base, check, accepts), state


class _Places:
    """The two arrays while they grow."""

    def __init__(self):
        self.base = np.zeros(1 << 12, np.int64)
        self.check = np.full(1 << 12, FREE, np.int64)
        self.check[0] = ROOT
        self.start = self.top = 1                       # where searches begin; behind the last place taken

    def _room(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, FREE, np.int64)])

    def children(self, parents: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """Places for edges sorted by (parent, digit): the widest parents choose first, single children fill the gaps."""
        heads = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]]) if len(parents) else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[heads, len(parents)])
        self.start = 1
        for i in np.argsort(-sizes, kind="stable"):
            if sizes[i] <= FEW:
                break
            self._place(parents, digits, heads[i], sizes[i])
        for k in range(min(FEW, int(sizes.max(initial=0))), 1, -1):
            for head in self._drawn(parents, digits, heads[sizes == k], k):
                self._place(parents, digits, head, k)
        single = heads[sizes == 1]
        if len(single):
            self._room(self.top + len(single))
            free = np.flatnonzero(self.check == FREE)[:len(single)]
            self.check[free] = parents[single]
            self.base[parents[single]] = free - digits[single]
            self.top = max(self.top, int(free[-1]) + 1)
        return self.base[parents] + digits

    def _place(self, parents: np.ndarray, digits: np.ndarray, head: int, size: int) -> None:
        own = digits[head:head + size]
        base = self._fit(own)
        self.base[parents[head]] = base
        self.check[base + own] = parents[head]
        self.top = max(self.top, base + int(own[-1]) + 1)

    def _drawn(self, parents: np.ndarray, digits: np.ndarray, heads: np.ndarray, k: int) -> np.ndarray:
        """Place parents of k children at free places drawn for all of them, as far as draws do not meet; who is left."""
        rng = np.random.default_rng(k)
        for _ in range(DRAWS):
            if not len(heads):
                break
            own = digits[heads[:, None] + np.arange(k)]
            shift = own - own[:, :1]
            limit = self.top + len(heads) * k // 2
            self._room(limit + int(shift.max()) + 1)
            first = rng.choice(np.flatnonzero(self.check[1:limit] == FREE) + 1, len(heads))
            at = first[:, None] + shift
            fits = (self.check[at] == FREE).all(1)
            claim = np.full(len(self.check), -1, np.int64)
            claim[at[fits]] = np.flatnonzero(fits)[:, None]
            fits &= (claim[at] == np.arange(len(heads))[:, None]).all(1)
            if fits.any():
                self.check[at[fits]] = parents[heads[fits]][:, None]
                self.base[parents[heads[fits]]] = first[fits] - own[fits, 0]
                self.top = max(self.top, int(at[fits].max()) + 1)
            heads = heads[~fits]
        return heads

    def _fit(self, digits: np.ndarray) -> int:
        """A base with all of the children's places free."""
        shift = digits - digits[0]
        span = max(WINDOW_TESTS // len(digits), 32)
        self._room(self.top + (WINDOWS + 1) * span + int(shift[-1]) + 1)
        at = self.start
        for _ in range(WINDOWS):
            if at >= self.top:
                break
            first = at + np.flatnonzero(self.check[at:at + span] == FREE)
            if at == self.start and len(first) < (1 - FULL) * span:
                self.start += span
            fits = np.flatnonzero((self.check[first[:, None] + shift] == FREE).all(1))
            if len(fits):
                return int(first[fits[0]] - digits[0])
            at += span
        return int(self.top - digits[0])

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return self.base[:self.top].astype(np.int32), self.check[:self.top].astype(np.int32)
