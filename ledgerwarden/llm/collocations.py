"""Phrase collocation mining with double-array tries of Apriori-safe candidates.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
those into words ``[^\\x20\\x09]+``; everything is counted per language (null:
``und``). A phrase of 2 or 3 words is a candidate if it can occur ``least``
times; the rest follows from exact counts:

1. every word's occurrences, counted per task and summed;
2. hashes of the pairs of frequent words, each with its occurrences in a task
   up to ``least``: a hash whose sum stays below ``least`` is no frequent pair;
   then hashes of the triples of two frequent pairs (Apriori: no frequent phrase
   is lost, since each of its parts is as frequent). They travel cut to some 5
   bits more than their count needs, sorted, as steps of one or two bytes;
   phrases that share a cut hash are summed together, which errs towards more;
3. the pairs and triples whose hash passed are the candidates. Each text position
   is dealt to the block of the candidates that can end there, by the hash of its
   last two words, with up to three words; equal positions of a task travel once,
   with their number; the words' texts travel besides;
4. a double-array trie (``word_trie``) of each block's candidates, some ``BLOCK``
   phrases, written from their last word: all positions of the block advance
   through it together, level by level, and the states that they reach are
   counted by ``bincount``.

The score of a phrase with ``a`` occurrences is floor(1000000 a a / (l r)) at
its weakest cut into a first part with ``l`` and a rest with ``r``. A pair
inside a triple with at least ``COVER`` percent of its occurrences is
dropped. Each language's first ``top`` phrases stay, by score, occurrences
and bytes of the phrase.

The texts are read four times, whatever their size: for words, pairs, triples and
positions. What is broadcast: bit tables of the frequent words, pairs and triples (at most 2^BITS[1] bits
each). Tests by bits err only towards more rows to sum. Words are told apart by 64-bit hashes
of language and word.

Odd input: a null text has no words; a null language and a language called
``und`` are one; repeated rows and ids count each time they occur; texts of
any length are read whole, in parts; an empty table gives no rows. Only text
and lang are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, mix64, run_hashes, ship, stage
from .textparts import Part, runs_of, text_parts
from .word_trie import Alphabet, build

LEAST, WORDS, TOP, COVER = 10, 3, 2000, 50
#: Phrases in a trie, about; positions that advance through it together, that travel in one Arrow batch; bits of a bit
#: table (least, most).
BLOCK, STEPPED, DEALT = 1 << 16, 1 << 18, 1 << 17
BITS = (16, 28)
#: Bits of a table that travel as one row; entries a task keeps before it merges or lets go of them.
SEGMENT, KEPT = 1 << 13, 1 << 19
#: Bits of a cut hash beyond those of the words' number; words for a group of hashes, and the most groups (bits).
SPARE, GROUP, GROUPS = 5, 17, 12
#: Places for the words that a task remembers to have sent (bits).
SENT = 22
#: Counting tasks for each core of the cluster: the fewer, the fewer rows are summed.
TASKS_PER_CORE = 2
#: Texts in an Arrow batch at most; an executor holds several batches for each of its tasks, in the JVM and in Python.
BATCH = 2000
#: Rows of a lookup table that may be broadcast (words, pairs or dictionary entries of some tens of bytes).
SMALL = 500_000
#: Parts of a language that are ranked apart before its ranking.
SALTS = 64

#: Bytes of words, blanks, and breaks between pieces.
_KIND = np.ones(256, np.int8)
_KIND[[0x20, 0x09]] = 0
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = -1
#: The first 0 to 8 bytes of eight; bytes above which a word is hashed as a run.
_FIRST, LONG = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64), 64
_SIZE, _EIGHT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9FB21C651E98DF25)
_PAIR, _TRIPLE = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


# --- text to symbols ---------------------------------------------------------------

class Stream:
    """The word symbols of one part, behind up to two of the text's part before that are still in its piece."""

    def __init__(self, part: Part, language: np.ndarray, before: list):
        padded = np.zeros(len(part.raw) + 8, np.uint8)
        self.raw = raw = np.take(LOWER, part.raw, out=padded[:len(part.raw)])
        kind = np.take(_KIND, raw)
        self.starts, self.ends = runs_of(kind, part.offsets)
        row = np.repeat(np.arange(part.rows), np.diff(np.searchsorted(self.starts, part.offsets)))
        broken = np.cumsum(kind < 0, dtype=np.int32)
        if not part.follows:
            before.clear()
        self.kept = len(before)
        own = _word_hashes(padded, self.starts, self.ends)
        with np.errstate(over="ignore"):
            own = np.maximum(mix64(own ^ language[part.first + row]), np.uint64(1))      # 0 stands for "no word"
        self.symbols = np.concatenate([np.array(before, np.uint64), own])
        self.piece = np.concatenate([np.zeros(self.kept, np.int64), broken[self.starts] + row])
        last = broken[-1] if len(raw) else 0
        before[:] = self.symbols[-(WORDS - 1):][self.piece[-(WORDS - 1):] == last].tolist() if part.rows == 1 else []

    def hashes(self, words: np.ndarray | None = None, lengths: tuple = (2, 3)):
        """(length, index of the last word, hash) of the pairs and triples that end here, of marked words alone."""
        s, piece = self.symbols, self.piece
        ok = np.ones(len(s), bool) if words is None else words
        with np.errstate(over="ignore"):
            pair = mix64(s[:-1] * _PAIR + s[1:])
            two = (piece[1:] == piece[:-1]) & ok[1:] & ok[:-1]
            triple = mix64(pair[:-1] * _TRIPLE + s[2:]) if 3 in lengths else pair[:0]
        three = two[1:] & two[:-1] if 3 in lengths else two[:0]
        for k, found, h in ((2, two, pair), (3, three, triple)):
            if k in lengths:
                end = np.flatnonzero(found) + k - 1
                yield k, end, h[end - k + 1]


def _word_hashes(padded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, eight bytes at a time; eight bytes at least follow the last word."""
    sizes = ends - starts
    eights = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    with np.errstate(over="ignore"):
        h = mix64((eights[starts] & _FIRST[np.minimum(sizes, 8)]) ^ (sizes.astype(np.uint64) * _SIZE))
        for at in range(8, LONG, 8):
            more = np.flatnonzero(sizes > at)
            if not len(more):
                break
            h[more] = mix64(h[more] * _EIGHT + (eights[starts[more] + at] & _FIRST[np.minimum(sizes[more] - at, 8)]))
    long = sizes > LONG
    h[long] = run_hashes(padded, starts[long], ends[long])
    return h


def _streams(batch: pa.RecordBatch):
    language = mix64(batch.column("language").to_numpy(zero_copy_only=False).astype(np.uint64))
    before: list = []
    for part in text_parts(batch.column("text")):
        yield Stream(part, language, before)


def _bit(table: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    at = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


# --- 1 and 2: words and pairs ---------------------------------------------------------

class Tally:
    """Occurrences of 64-bit values in a task, let go of as (ascending values, occurrences) when they are too many to keep."""

    def __init__(self, cap: int | None = None):
        self.cap, self.kept, self.size = cap, [], 0

    def add(self, *values: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        self.kept.append(self._counted(*values))
        self.size += len(self.kept[-1][0])
        if self.size <= 2 * self._most():
            return []
        self.kept = [self._merged()]
        self.size = len(self.kept[0][0])
        return self.rest() if self.size > self._most() else []

    def _most(self) -> int:
        return KEPT

    def _counted(self, values: np.ndarray) -> tuple[np.ndarray, ...]:
        return np.unique(values, return_counts=True)

    def _merged(self) -> tuple[np.ndarray, ...]:
        return self.kept[0] if len(self.kept) == 1 else _summed(*(np.concatenate(x) for x in zip(*self.kept)))

    def rest(self) -> list[tuple[np.ndarray, ...]]:
        if not self.size:
            return []
        out, self.kept, self.size = self._merged(), [], 0
        return [out if self.cap is None else (out[0], np.minimum(out[1], self.cap))]


def _summed(values: np.ndarray, counts: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ascending distinct values, the sums of their counts, and what stands beside one of each."""
    order = np.argsort(values)
    values = values[order]
    heads = np.flatnonzero(np.r_[True, values[1:] != values[:-1]][:len(values)])
    sums = np.add.reduceat(counts[order].astype(np.int64), heads) if len(heads) else np.zeros(0, np.int64)
    return values[heads], sums, *(x[order[heads]] for x in more)


def _count_words(batches):
    """(symbol, occurrences, null) rows, and (null, occurrences of all words, language)."""
    tally = Tally()
    for batch in batches:
        totals = np.zeros(batch.num_rows, np.int64)
        before: list = []
        language = mix64(batch.column("language").to_numpy(zero_copy_only=False).astype(np.uint64))
        for part in text_parts(batch.column("text")):
            s = Stream(part, language, before)
            own = np.searchsorted(part.offsets, s.starts, side="right") - 1
            totals[part.first:part.first + part.rows] += np.bincount(own, minlength=part.rows)
            yield from (_symbol_rows(*out) for out in tally.add(s.symbols[s.kept:]))
        per = pa.table({"lang": batch.column("lang"), "f": totals}).group_by("lang").aggregate([("f", "sum")])
        yield pa.record_batch([pa.nulls(per.num_rows, pa.int64()), per["f_sum"].combine_chunks().cast(pa.int64()),
                               per["lang"].combine_chunks().cast(pa.string())], names=["symbol", "f", "lang"])
    yield from (_symbol_rows(*out) for out in tally.rest())


def _symbol_rows(symbols: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([_signed(symbols), pa.array(counts), pa.nulls(len(counts), pa.string())], names=["symbol", "f", "lang"])


def _likely(s: Stream, words, pairs=None, triples=None):
    """(length, index of the last word, hash) of the part's own pairs of marked words and triples of two marked pairs.

    Each of ``words``, ``pairs`` and ``triples`` is a bit table and its bits; without one nothing is refused, and
    there are triples only of marked pairs.
    """
    pair = np.zeros(len(s.symbols) + 1, bool)
    for k, end, h in s.hashes(_bit(words[0], s.symbols, words[1]), (2, 3) if pairs else (2,)):
        on = pair[end - 1] & pair[end] if k == 3 else np.ones(len(end), bool)
        marks = pairs if k == 2 else triples
        if marks:
            on[on] = _bit(marks[0], h[on], marks[1])
        end, h = end[on], h[on]
        if k == 2:
            pair[end] = True
        own = end >= s.kept
        yield k, end[own], h[own]


def _count_hashes(length: int, tables, bits: int, groups: int, least: int):
    """Rows (group, n, steps, counts): the cut hashes of likely phrases, each with its occurrences in the task up to ``least``."""
    def count(batches):
        tally = Tally(least)
        marks = [(t.value, b) for t, b in tables]
        for batch in batches:
            for s in _streams(batch):
                for k, _, h in _likely(s, *marks):
                    if k == length:
                        yield from (_packed(*out, bits - groups) for out in tally.add(h >> np.uint64(64 - bits)))
        yield from (_packed(*out, bits - groups) for out in tally.rest())
    return count


def _packed(values: np.ndarray, counts: np.ndarray, low: int) -> pa.RecordBatch:
    """Ascending values as one row for each value of the bits above ``low``: steps and counts in the smallest types."""
    group = (values >> np.uint64(low)).astype(np.int64)
    runs = list(_runs(group))
    steps = np.diff(values, prepend=np.uint64(0))
    heads = np.array([a for a, _ in runs])
    steps[heads] = values[heads] & np.uint64((1 << low) - 1)

    return pa.record_batch([pa.array(group[heads], pa.int32()), pa.array([b - a for a, b in runs], pa.int32()),
                            pa.array([_small(steps[a:b]) for a, b in runs], pa.binary()),
                            pa.array([_small(counts[a:b].astype(np.uint64)) for a, b in runs], pa.binary())],
                           names=["group", "n", "steps", "counts"])


def _small(x: np.ndarray) -> bytes:
    return x.astype(np.min_scalar_type(int(x.max()))).tobytes()


def _unpacked(data: list[bytes], n: list[int]) -> list[np.ndarray]:
    return [np.frombuffer(d, f"u{len(d) // k}").astype(np.uint64) for d, k in zip(data, n)]


def _often(low: int, bits: int, least: int):
    """The hashes of one group, zeros behind their cut, that occur ``least`` times."""
    def often(table: pa.Table) -> pa.Table:
        n = table["n"].to_pylist()
        values, f = _summed(np.concatenate([np.cumsum(x) for x in _unpacked(table["steps"].to_pylist(), n)]),
                            np.concatenate(_unpacked(table["counts"].to_pylist(), n)))
        found = values[f >= least] + np.uint64(table["group"][0].as_py() << low)
        return pa.table({"symbol": _signed(found << np.uint64(64 - bits))})
    return often


def frequent_hashes(rows: DataFrame, length: int, tables, n_words: int, least: int) -> DataFrame:
    """symbol: cut hashes of the phrases of ``length`` words that pass ``tables`` and may occur ``least`` times."""
    bits, groups = cut_bits(n_words), int(np.clip(n_words.bit_length() - GROUP, 0, GROUPS))
    return stage(rows.mapInArrow(_count_hashes(length, tables, bits, groups, least), "group int, n int, steps binary, counts binary")
                 .groupBy("group").applyInArrow(_often(bits - groups, bits, least), "symbol long"), f"frequent-{length}")


def cut_bits(n_words: int) -> int:
    """Bits of a cut hash: not fewer than any bit table has, and few phrases share one."""
    return int(np.clip(n_words.bit_length() + SPARE, BITS[1], 63))


def _bit_segments(of, batches):
    """Rows (segment, ...) sorted by segment, folded by ``of`` into one row of packed bits for each segment."""
    now, state = None, None

    def row():
        return pa.record_batch([pa.array([now], pa.int64()), pa.array([np.packbits(of(state, None), bitorder="little").tobytes()])],
                               names=["segment", "bits"])

    for batch in batches:
        segments = batch.column("segment").to_numpy()
        for a, b in _runs(segments):
            if segments[a] != now:
                if now is not None:
                    yield row()
                now, state = int(segments[a]), None
            state = of(state, batch.column("data").slice(a, b - a))
    if now is not None:
        yield row()


def _runs(values: np.ndarray):
    edges = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]) if len(values) else np.zeros(1, np.int64)
    return zip(edges[:-1].tolist(), edges[1:].tolist())


def _fold(rows: DataFrame, of, bits: int) -> np.ndarray:
    """The table of 2^bits bits from rows (segment, data); 2^bits / 8 bytes come to the driver."""
    def folded(batches):
        yield from _bit_segments(of, batches)

    dealt = rows.repartition("segment").sortWithinPartitions("segment")
    table = np.zeros(max((1 << bits) // 8, 1), np.uint8)
    got = dealt.mapInArrow(folded, "segment long, bits binary").toArrow()
    for segment, data in zip(got["segment"].to_pylist(), got["bits"].to_pylist()):
        at = segment * SEGMENT // 8
        table[at:at + len(data)] |= np.frombuffer(data, np.uint8)[:len(table) - at]
    return table


def _marked(state, data):
    """Bits of the places (offsets within the segment) that occur."""
    state = np.zeros(SEGMENT, bool) if state is None else state
    if data is not None:
        state[data.to_numpy(zero_copy_only=False)] = True
    return state


def bit_table(frequent: DataFrame, n: int, each: int = 7) -> tuple[np.ndarray, int]:
    """(table, its bits): ``n`` symbols, some 2^each bits for each of them up to the greatest table."""
    bits = int(np.clip(n.bit_length() + each, *BITS))
    at = f"shiftrightunsigned(symbol, {64 - bits})"
    rows = frequent.selectExpr(f"{at} div {SEGMENT} AS segment", f"CAST({at} & {SEGMENT - 1} AS INT) AS data")
    return _fold(rows, _marked, bits), bits


# --- 3: candidates and the positions where they may end ------------------------------

class Sent:
    """Values a task remembers, one for each place; the first stays, others of its place are taken for new each time."""

    def __init__(self, n: int):
        self.bits = min(n.bit_length() + 2, SENT)
        self.values = np.zeros(1 << self.bits, np.uint64)

    def fresh(self, values: np.ndarray) -> np.ndarray:
        """Which of the distinct values are not remembered yet."""
        at = (values >> np.uint64(64 - self.bits)).astype(np.int64)
        new = (self.values[at] != values) | (values == 0)
        empty = new & (self.values[at] == 0)
        self.values[at[empty]] = values[empty]
        return new


class Windows(Tally):
    """Occurrences of positions in a task, by the hash of the longest phrase there, with its words, the last one first."""

    def _most(self) -> int:
        return KEPT // 2                                        # each has its words besides

    def _counted(self, values: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, ...]:
        return _summed(values, np.ones(len(values), np.int64), words)


_FOUND = "block int, n int, symbols binary, places binary, counts binary, symbol long, lang string, word string"
_COLUMNS, _PACKED = [c.split()[0] for c in _FOUND.split(", ")], (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())


def _find_windows(tables, blocks: int, n_words: int):
    """Rows (block, n, symbols, places, counts): positions where likely phrases end; and (block, nulls, symbol, lang, word): words."""
    def find(batches):
        windows, told = Windows(), Sent(n_words)
        marks = [(t.value, b) for t, b in tables]
        for batch in batches:
            language = mix64(batch.column("language").to_numpy(zero_copy_only=False).astype(np.uint64))
            before: list = []
            for part in text_parts(batch.column("text")):
                s = Stream(part, language, before)
                named = np.zeros(len(s.symbols), bool)
                if part.rows == 1:
                    named[-(WORDS - 1):] = True                 # the part that follows may need them
                key, size = np.zeros(len(s.symbols), np.uint64), np.zeros(len(s.symbols), np.int8)
                for k, end, h in _likely(s, *marks):            # triples come behind the pairs in them
                    key[end], size[end] = h, k
                    for i in range(k):
                        named[end - i] = True
                end = np.flatnonzero(size)
                words = np.zeros((len(end), WORDS), np.uint64)
                for i in range(WORDS):
                    on = size[end] > i
                    words[on, i] = s.symbols[end[on] - i]
                for out in windows.add(key[end], words):
                    yield from _window_rows(*out, blocks)
                own = np.flatnonzero(named[s.kept:])
                symbols, first = np.unique(s.symbols[s.kept:][own], return_index=True)
                new = own[first[told.fresh(symbols)]]
                if len(new):
                    yield _word_rows(s, part, new, batch.column("lang"), blocks)
        for out in windows.rest():
            yield from _window_rows(*out, blocks)
    return find


def _block_of(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int32)


def _window_rows(_, counts: np.ndarray, words: np.ndarray, blocks: int):
    """One row for each block of the last two words: its distinct symbols, and the places of its words among them, column by column."""
    with np.errstate(over="ignore"):
        block = _block_of(mix64(words[:, 1] * _PAIR + words[:, 0]), blocks)
    order = np.argsort(block, kind="stable")
    block = block[order]
    rows, held = [], 0
    for a, b in _runs(block):
        symbols, places = np.unique(words[order[a:b]].T, return_inverse=True)
        rows.append((int(block[a]), b - a, symbols.tobytes(), _small(places.ravel()), _small(counts[order[a:b]])))
        held += b - a
        if held >= DEALT or b == len(block):
            blank = pa.nulls(len(rows), pa.string())
            yield pa.record_batch([*(pa.array(x, t) for x, t in zip(zip(*rows), _PACKED)), pa.nulls(len(rows), pa.int64()), blank, blank],
                                  names=_COLUMNS)
            rows, held = [], 0


def _word_rows(s: Stream, part: Part, which: np.ndarray, lang: pa.Array, blocks: int) -> pa.RecordBatch:
    row = part.first + np.searchsorted(part.offsets, s.starts[which], side="right") - 1
    text = [s.raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(s.starts[which], s.ends[which])]
    symbols, blank = s.symbols[s.kept:][which], pa.nulls(len(which), pa.binary())
    return pa.record_batch([pa.array(_block_of(symbols, blocks)), pa.nulls(len(which), pa.int32()), blank, blank, blank, _signed(symbols),
                            lang.take(pa.array(row)).cast(pa.string()), pa.array(text, pa.string())], names=_COLUMNS)


# --- 4: tries -----------------------------------------------------------------------

_COUNTED = pa.schema([*((x, pa.int64()) for x in ("a", "b", "c", "f", "symbol")), ("lang", pa.string()), ("word", pa.string())])


def _count_block(least: int):
    """The candidates of one block that occur ``least`` times, c 0 for pairs; and its words, each once; nulls elsewhere."""
    def count(table: pa.Table) -> pa.Table:
        phrases, f = _walked(table, least)
        last, middle, first = phrases.T
        pair = first == 0
        told = table.filter(table["symbol"].is_valid())
        symbols, one = np.unique(told["symbol"].to_numpy(), return_index=True)
        told, n = told.take(pa.array(one)), len(one)
        return pa.concat_tables([
            pa.table([_signed(np.where(pair, middle, first)), _signed(np.where(pair, last, middle)), _signed(np.where(pair, 0, last)),
                      pa.array(f), *(pa.nulls(len(f), t) for t in _COUNTED.types[4:])], schema=_COUNTED),
            pa.table([*(pa.nulls(n, t) for t in _COUNTED.types[:4]), pa.array(symbols),
                      *(told[x].cast(pa.string()) for x in ("lang", "word"))], schema=_COUNTED)])
    return count


def _dealt(table: pa.Table):
    """(words, occurrences) of a block's positions, the last word first, ``STEPPED`` at a time or as many as one row has."""
    words, counts, held = [], [], 0
    for batch in table.to_batches():
        for i in np.flatnonzero(batch.column("n").is_valid().to_numpy(zero_copy_only=False)).tolist():
            n, (symbols, places, times) = batch.column("n")[i].as_py(), (batch.column(x)[i].as_buffer() for x in ("symbols", "places", "counts"))
            if held and held + n > STEPPED:
                yield np.concatenate(words, 1).T, np.concatenate(counts)
                words, counts, held = [], [], 0
            words.append(np.frombuffer(symbols, np.uint64)[_unpacked([places], [WORDS * n])[0].reshape(WORDS, n).astype(np.int64)])
            counts += _unpacked([times], [n])
            held += n
    if held:
        yield np.concatenate(words, 1).T, np.concatenate(counts)


def _walked(table: pa.Table, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrases, occurrences) from ``least`` on: a block's positions walk a trie of all phrases that end there."""
    distinct = np.zeros((0, WORDS), np.uint64)
    for words, _ in _dealt(table):
        distinct = _distinct_rows(np.concatenate([distinct, words]))
    pairs = _distinct_rows(distinct * np.array([1] * (WORDS - 1) + [0], np.uint64))
    phrases = np.concatenate([pairs, distinct[distinct[:, -1] > 0]])
    if not len(phrases):
        return phrases, np.zeros(0, np.int64)
    trie, state = build(phrases)
    alphabet = Alphabet({0: trie})
    f = np.zeros(len(trie.check), np.int64)
    for words, n in _dealt(table):
        number = alphabet.numbers[0][alphabet.places(words.ravel())]
        times, first = n.astype(np.float64), np.arange(0, words.size, WORDS)        # whole numbers, summed exactly
        for level, end, reached in trie.advance(number, np.repeat(np.arange(len(words)), WORDS), WORDS, first):
            if level > 1:
                f += np.bincount(reached, times[end // WORDS], len(f)).astype(np.int64)
    f = f[state]
    return phrases[f >= least], f[f >= least]


def _distinct_rows(rows: np.ndarray) -> np.ndarray:
    order = np.lexsort(rows.T)
    rows = rows[order]
    return rows[np.r_[True, (rows[1:] != rows[:-1]).any(1)][:len(rows)]]


def count_candidates(rows: DataFrame, tables, n: int, n_words: int, least: int) -> DataFrame:
    """(a, b, c, f, null, null, null): the candidates' occurrences in all texts, from ``least`` on; (nulls, symbol, lang, word): words."""
    blocks = -(-n // BLOCK)
    return stage(_few(rows).mapInArrow(_find_windows(tables, blocks, n_words), _FOUND)
                 .groupBy("block").applyInArrow(_count_block(least), "a long, b long, c long, f long, symbol long, lang string, word string"),
                 "found")


def _few(rows: DataFrame) -> DataFrame:
    """In few tasks, where a task sends a row for each phrase it met."""
    return rows.coalesce(TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism)


# --- the whole -----------------------------------------------------------------------

def mine(docs: DataFrame, least: int = LEAST, top: int = TOP, cover: int = COVER) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases."""
    with _small_batches(docs.sparkSession):
        return _mined(docs, least, top, cover)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of at most ``BATCH`` texts; the session's own setting stands again afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own, now = spark.conf.get(key, None), int(spark.conf.get(key))
    spark.conf.set(key, str(min(now, BATCH) if now > 0 else BATCH))
    try:
        yield
    finally:
        spark.conf.unset(key) if own is None else spark.conf.set(key, own)


def _mined(docs: DataFrame, least: int, top: int, cover: int) -> DataFrame:
    """As ``mine``; all readings of the texts happen here."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.selectExpr("coalesce(CAST(lang AS STRING), 'und') AS lang",
                           "xxhash64(coalesce(CAST(lang AS STRING), 'und')) AS language", "text")
    seen = stage(rows.mapInArrow(_count_words, "symbol long, f long, lang string").groupBy("symbol", "lang")
                 .agg(F.sum("f").alias("f")).where((F.col("f") >= least) | F.col("symbol").isNull()), "word-counts")
    totals = seen.where("symbol IS NULL").selectExpr("lang", "f AS n")
    frequent = seen.where("symbol IS NOT NULL").select("symbol", "f")
    n_words = frequent.count()
    if not n_words:
        return spark.createDataFrame([], _RESULT)
    total = totals.agg(F.sum("n")).first()[0]
    tables, sizes = [], []
    for length in range(1, WORDS + 1):
        often = frequent.select("symbol") if length == 1 else frequent_hashes(rows, length, tuple(tables), total, least)
        sizes.append(often.count())
        table, bits = bit_table(often, sizes[-1], 5 if length == 1 else 7)      # few texts have many rare words
        tables.append((spark.sparkContext.broadcast(table), bits))
    if not sizes[1]:
        return spark.createDataFrame([], _RESULT)
    counted = count_candidates(rows, tables, sum(sizes[1:]), n_words, least)
    phrases = counted.where("symbol IS NULL").select("a", "b", "c", "f")
    scored = _scores(phrases, _uncovered(phrases, cover), frequent, n_words)
    return _ranked(scored, counted.where("symbol IS NOT NULL").selectExpr("symbol AS a", "lang", "word"), totals, top)


def _lookup(table: DataFrame, n: int) -> DataFrame:
    """Broadcast by its counted rows, else left to a shuffle join, whose skewed keys are split at run time."""
    return F.broadcast(table) if n <= SMALL else table


def _scores(phrases: DataFrame, kept: DataFrame, frequent: DataFrame, n_words: int) -> DataFrame:
    """(a, b, c, f, l, r, score) of those kept, at the weakest cut; all phrases are needed for the parts."""
    word = _lookup(frequent.selectExpr("symbol", "f AS word_f"), n_words)
    pairs = phrases.where("c = 0")
    pair = _lookup(pairs.selectExpr("a AS pa", "b AS pb", "f AS pair_f"), pairs.count())

    def with_word(df, column, name):
        return df.join(word.withColumnRenamed("word_f", name), F.col(column) == F.col("symbol")).drop("symbol")

    def with_pair(df, one, two, name):
        return df.join(pair.withColumnRenamed("pair_f", name), (F.col(one) == F.col("pa")) & (F.col(two) == F.col("pb"))).drop("pa", "pb")

    def cut(l, r):
        return (f"named_struct('score', CAST((CAST(f AS DECIMAL(16,0)) * CAST(f AS DECIMAL(16,0)) * CAST(1000000 AS DECIMAL(7,0))) "
                f"div (CAST({l} AS DECIMAL(16,0)) * CAST({r} AS DECIMAL(16,0))) AS LONG), 'k', {{k}}, 'l', {l}, 'r', {r})")

    two = with_word(with_word(kept.where("c = 0"), "a", "first"), "b", "second").withColumn("cut", F.expr(cut("first", "second").format(k=1)))
    three = phrases.where("c <> 0")
    three = with_word(with_word(with_pair(with_pair(three, "a", "b", "front"), "b", "c", "back"), "a", "first"), "c", "second")
    three = three.withColumn("cut", F.expr(f"least({cut('first', 'back').format(k=1)}, {cut('front', 'second').format(k=2)})"))
    columns = ["a", "b", "c", "f", "cut.l", "cut.r", "cut.score"]
    return two.select(*columns).unionAll(three.select(*columns))


def _uncovered(phrases: DataFrame, cover: int) -> DataFrame:
    """Without the pairs that a triple covers."""
    triples = phrases.where("c <> 0")
    most = (triples.selectExpr("a AS ta", "b AS tb", "f AS tf").unionAll(triples.selectExpr("b", "c", "f"))
            .groupBy("ta", "tb").agg(F.max("tf").alias("tf")))
    kept = (phrases.where("c = 0").join(most, (F.col("a") == F.col("ta")) & (F.col("b") == F.col("tb")), "left")
            .where(F.col("tf").isNull() | (100 * F.col("tf") < cover * F.col("f"))).select(phrases.columns))
    return kept.unionAll(triples)


def _ranked(scored: DataFrame, names: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """With the phrases' texts, each language's first ``top``: first of every salt's rows, then of what is left."""
    name = _lookup(names.selectExpr("a AS na", "lang AS name_lang", "word AS name"), names.count())
    for i, column in enumerate("abc"):
        scored = (scored.join(name.selectExpr("na", f"name AS w{i}", *(["name_lang AS lang"] if i == 0 else [])),
                              F.col(column) == F.col("na"), "left" if column == "c" else "inner").drop("na"))
    told = scored.select("lang", F.expr("concat_ws(' ', w0, w1, w2)").alias("phrase"), F.col("f").alias("a"), "l", "r", "score",
                         F.expr(f"pmod(xxhash64(a, b, c), {SALTS})").alias("salt"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = (told.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
             .where(F.col("rank") <= top))
    best = (first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
