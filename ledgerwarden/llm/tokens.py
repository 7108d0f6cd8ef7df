"""Token ids of texts by the ``tokenizers`` library, with a bounded cache of encoded pieces.

A byte-level BPE splits a text into pieces (a word with the blank before it, a
run of digits, ...) and merges inside a piece only, so the ids of a text are
the ids of its pieces one after the other. The pieces are found here with
array operations over a slice of texts; each distinct piece goes through
``Tokenizer.encode_batch`` once and its ids are kept. Texts with characters or
forms for which the split is not plain (see ``_plain``) go through
``Tokenizer.encode`` whole. Both ways give the same ids (tests compare them).
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from .common import run_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
#: Pieces kept per worker (about 40 bytes each); beyond it the cache starts anew.
CACHE_PIECES = 700_000
#: Words that go through the library in one call.
GROUP_WORDS = 256
LETTER, DIGIT, BLANK, OTHER = 1, 2, 3, 4


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _classes() -> np.ndarray:
    """Class of each code point below 0x10000; 0 where a text goes to the library whole."""
    c = np.zeros(0x10000, np.uint8)
    plain = [*range(0x20, 0x7F), *range(0xA1, 0x250), *range(0x400, 0x460), *range(0x2010, 0x2028),
             *range(0x2030, 0x205F), 0x20AC, *range(0x4E00, 0x9FA6)]
    for i in plain:
        kind = unicodedata.category(chr(i))[0]
        c[i] = LETTER if kind == "L" else DIGIT if kind == "N" else OTHER
    c[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = BLANK
    return c


class PieceEncoder:
    """Encodes slices of texts; keep one per worker process."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache_pieces = cache_pieces
        self.classes = _classes()
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)   # sorted
        self.slot = np.zeros(0, np.int64)    # of each key, into start/size
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [e.ids for e in batch(texts, add_special_tokens=False)]

    def _plain(self, text: str) -> bool:
        """No apostrophe before a letter (contractions split apart) and no special token's string."""
        at = text.find("'")
        while at >= 0:
            if text[at + 1:at + 2].isalpha():
                return False
            at = text.find("'", at + 1)
        return not any(s in text for s in self.specials)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each)."""
        n = len(texts)
        points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        kinds = [self.classes[np.minimum(p, 0xFFFF)] for p in points]
        plain = [bool(k.all()) and self._plain(t) for k, t in zip(kinds, texts)]
        out: list[np.ndarray | None] = [None] * n
        odd = [i for i in range(n) if not plain[i]]
        for i in odd:
            out[i] = np.asarray(self._encode([texts[i]])[0], np.uint32)
        even = [i for i in range(n) if plain[i]]
        if even:
            ids, counts = self._pieces([points[i] for i in even], [kinds[i] for i in even])
            if not odd:
                return ids, counts
            for i, part in zip(even, np.split(ids, np.cumsum(counts)[:-1])):
                out[i] = part
        counts = np.array([len(x) for x in out], np.int64)
        return (np.concatenate(out) if n else np.zeros(0, np.uint32)), counts

    def _pieces(self, points: list[np.ndarray], kinds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        import pandas as pd

        sizes = np.array([len(p) for p in points], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        total = int(offsets[-1])
        if not total:
            return np.zeros(0, np.uint32), np.zeros(len(points), np.int64)
        cp, kind = np.concatenate(points), np.concatenate(kinds)
        begin = np.zeros(total + 1, bool)
        begin[offsets[:-1]] = True
        fresh = begin[:total].copy()
        begin[1:total] |= kind[1:] != kind[:-1]
        # a word takes one plain blank before it; any other blank stands alone before a word
        after = np.flatnonzero((kind[1:] != BLANK) & (kind[:-1] == BLANK) & ~fresh[1:]) + 1
        begin[after - 1] = True
        begin[after] = cp[after - 1] != 0x20
        starts = np.flatnonzero(begin[:total])
        ends = np.append(starts[1:], total)
        codes, uniq = pd.factorize(run_hashes(cp, starts, ends))
        uniq = np.asarray(uniq, np.uint64)
        at = np.searchsorted(self.keys, uniq)
        known = (at < len(self.keys))
        known[known] = self.keys[at[known]] == uniq[known]
        if not known.all():
            if len(self.keys) + int((~known).sum()) > self.cache_pieces:
                self._reset()
                known[:] = False
            first = np.full(len(uniq), -1, np.int64)
            first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)   # first place of each
            self._learn(uniq[~known], cp, starts[first[~known]], ends[first[~known]])
            at = np.searchsorted(self.keys, uniq)
        slot = self.slot[at][codes]
        size = self.size[slot]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.start[slot] - upto[:-1], size) + np.arange(upto[-1])]
        bounds = upto[np.searchsorted(starts, offsets)]
        return ids, np.diff(bounds)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of blank-led words, encoded many at a time and told apart by word number."""
        groups = [words[i:i + GROUP_WORDS] for i in range(0, len(words), GROUP_WORDS)]
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for group, e in zip(groups, self.tokenizer.encode_batch(["".join(g) for g in groups], add_special_tokens=False)):
            size = np.bincount(np.array(e.word_ids, np.int64), minlength=len(group))
            if len(size) != len(group) or not size.all():
                raise ValueError("the tokenizer does not split before a blank-led word")
            ids.append(np.array(e.ids, np.uint32))
            sizes.append(size)
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, keys: np.ndarray, cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw = cp.tobytes()
        pieces = [raw[a * 4:b * 4].decode("utf-32-le") for a, b in zip(starts.tolist(), ends.tolist())]
        words = [i for i, x in enumerate(pieces) if x[0] == " " and x[1:].isalpha()]
        other = [i for i, x in enumerate(pieces) if not (x[0] == " " and x[1:].isalpha())]
        keys = keys[words + other]
        ids, size = self._words([pieces[i] for i in words])
        found = self._encode([pieces[i] for i in other])
        size = np.concatenate([size, np.array([len(x) for x in found], np.int64)])
        base = len(self.flat)
        self.flat = np.concatenate([self.flat, ids, np.array([i for x in found for i in x], np.uint32)])
        slot = len(self.size) + np.arange(len(keys))
        self.start = np.concatenate([self.start, base + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        allk, alls = np.concatenate([self.keys, keys]), np.concatenate([self.slot, slot])
        order = np.argsort(allk, kind="stable")
        self.keys, self.slot = allk[order], alls[order]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
