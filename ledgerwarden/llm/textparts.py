"""Texts of an Arrow batch in parts of bounded size, cut between words.

Many short texts form one part; a text above the limit is dealt out in several
parts, so the memory of what follows depends on the limit and the longest word,
never on the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import SLICE_BYTES, SPACE, slices, string_bytes


@dataclass
class Part:
    """Rows ``first`` to ``first + len(offsets) - 1`` of the batch; ``follows``: the text began in an earlier part."""
    first: int
    raw: np.ndarray
    offsets: np.ndarray
    follows: bool = False

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def text_parts(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Part]:
    """The column's texts in order; a null text has no bytes."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for a, b in slices(sizes, limit):
        flat = pc.fill_null(column.slice(a, b - a), "").cast(pa.large_string())
        raw, offsets = string_bytes(flat)
        if b - a > 1 or len(raw) <= limit:
            yield Part(a, raw, offsets)
            continue
        at = 0
        while at < len(raw):
            end = _cut(raw, at, limit)
            yield Part(a, raw[at:end], np.array([0, end - at], np.int64), at > 0)
            at = end


def _cut(raw: np.ndarray, at: int, limit: int) -> int:
    """Where the part from ``at`` on ends: behind the last separator within the limit, else behind the next one."""
    if len(raw) - at <= limit:
        return len(raw)
    back = np.flatnonzero(SPACE[raw[at:at + limit]])
    if len(back):
        return at + int(back[-1]) + 1
    for start in range(at + limit, len(raw), limit):
        ahead = np.flatnonzero(SPACE[raw[start:start + limit]])
        if len(ahead):
            return start + int(ahead[0]) + 1
    return len(raw)


def runs_of(kinds: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the maximal runs of equal kind above 0; a run never crosses one of ``offsets``."""
    if len(kinds) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    turn = np.ones(len(kinds) + 1, bool)
    turn[1:-1] = kinds[1:] != kinds[:-1]
    turn[offsets] = True
    edges = np.flatnonzero(turn)
    full = kinds[edges[:-1]] > 0
    return edges[:-1][full], edges[1:][full]
