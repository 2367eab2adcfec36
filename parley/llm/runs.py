"""Periodic runs of words, found online by dyadic square catching.

Words are appended; over every completed block of 2^k words that starts at a multiple of 2^k a
catcher is set. It waits for its block to come again q words later, 2^(k+1) - 1 <= q <= 2^(k+2) - 2:
any square whose period is in that range holds such a block whole in its first half, so no square is
missed, and every appended word is compared with two catchers a level only. Where neighbouring
catchers are answered at the same q, their squares overlap and merge into one stretch; once the next
catcher stays silent, suffix comparisons word by word find the exact ends, and the stretch is
reported as a run. A stretch that lies in a reported run whose period divides q is that run again.

Comparisons go by 64-bit names of blocks (the name of 2^(k+1) words is made of the names of its
halves); what is reported is held against the words themselves. Only the tail that a level can
still need is kept, so the state is linear in the text. Words are appended in stretches, and all
words of a stretch advance the catchers of a level in one numpy step; several texts share one
sequence, with a word of its own between them that no square can cross.

Work is done where the text lies: nothing is shuffled.

Defined results: text null or without a word: no runs, collapsed text empty; repeated rows: a
result each; doc_id null: handed through; very long texts: linear memory, at most log n levels; a
text of one word over and over: one run of period 1; empty table: no rows; further columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import pick

#: Words that are appended at once, and about as many words of short texts that share a sequence.
STRETCH = 1 << 16
#: Bytes of result that leave a task at once.
BYTES_OUT = 8 << 20
#: Suffix comparisons of all stretches in step, before each goes on alone.
IN_STEP = 32


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A name for two names in this order."""
    z = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return z ^ (z >> np.uint64(29))


class _Level:
    """Catchers over blocks of 2^k words: names, open stretches (period, first and last block), runs."""

    def __init__(self, k: int):
        self.size = 1 << k
        self.low, self.high = 2 * self.size - 1, 4 * self.size - 2
        self.names, self.at = np.empty(0, np.uint64), 0     # of the words from ``at`` on
        self.blocks, self.block_at = np.empty(0, np.uint64), 0
        self.open = np.empty((0, 3), np.int64)
        self.runs = np.empty((0, 3), np.int64)              # start, end, period


class Catchers:
    """Runs of ``power`` periods and ``least`` words at least. ``longest``: the longest period that can
    occur, where that is known."""

    def __init__(self, power: int = 4, least: int = 6, longest: int | None = None):
        if power < 2:
            raise ValueError("a run holds two periods at least")
        self.power, self.least, self.longest = power, least, longest
        self.words, self.n = np.empty(STRETCH, np.int64), 0
        self.levels = [_Level(0)]

    def append(self, words: np.ndarray) -> None:
        for at in range(0, len(words), STRETCH):
            self._append(np.asarray(words[at:at + STRETCH], np.int64))

    def _append(self, words: np.ndarray) -> None:
        before, self.n = self.n, self.n + len(words)
        if self.n > len(self.words):
            self.words = np.concatenate([self.words, np.empty(max(self.n, len(self.words)), np.int64)])
        self.words[before:self.n] = words
        most = self.n // self.power if self.longest is None else min(self.longest, self.n // self.power)
        k, fresh = 0, _mix(words.astype(np.uint64), np.zeros(len(words), np.uint64))
        while k < len(self.levels):
            level = self.levels[k]
            self._advance(level, fresh)
            if k + 1 == len(self.levels) and 4 * level.size - 1 <= most:
                self.levels.append(self._opened(level, k + 1))
            fresh = self._doubled(level, self.levels[k + 1]) if k + 1 < len(self.levels) else fresh
            k += 1

    def _opened(self, lower: _Level, k: int) -> _Level:
        """A new level; it begins as if it had been there from the first word."""
        if not lower.at:
            return _Level(k)
        names = _mix(self.words[:self.n].astype(np.uint64), np.zeros(self.n, np.uint64))
        for i in range(k - 1):
            names = _mix(names[:max(0, len(names) - (1 << i))], names[1 << i:])
        lower.names, lower.at = names, 0
        return _Level(k)

    def _doubled(self, level: _Level, upper: _Level) -> np.ndarray:
        """Names of the windows of twice the size that are complete by now and were not before."""
        begin = upper.at + len(upper.names)
        names = level.names[begin - level.at:]
        fresh = _mix(names[:max(0, len(names) - level.size)], names[level.size:])
        level.names, level.at = names[len(fresh):], begin + len(fresh)
        return fresh

    def _advance(self, level: _Level, fresh: np.ndarray) -> None:
        """Compare the fresh windows with the catchers that wait for them."""
        first, size = level.at + len(level.names), level.size
        level.names = np.concatenate([level.names, fresh])
        starts = -(-first // size) * size
        level.blocks = np.concatenate([level.blocks, fresh[starts - first::size]])
        window = np.arange(first, first + len(fresh))
        near = (window - level.low) // size
        found = [level.open]
        for block in (near, near - 1):
            there = int(np.searchsorted(block, 0))
            asked = block[there:]
            hit = there + np.flatnonzero(level.blocks[asked - level.block_at] == fresh[there:])
            place = block[hit] * size
            found.append(np.column_stack([window[hit] - place, place, place]))
        needed = max(0, (first + len(fresh) - level.low) // size - 1)
        if needed > level.block_at:
            level.blocks, level.block_at = level.blocks[needed - level.block_at:], needed
        self._merge(level, np.concatenate(found))
        self._close(level, self.n)

    def _merge(self, level: _Level, squares: np.ndarray) -> None:
        """Neighbouring blocks answered at the same distance are one stretch."""
        if len(squares):
            squares = squares[np.lexsort((squares[:, 1], squares[:, 0]))]
            breaks = np.ones(len(squares) + 1, bool)
            breaks[1:-1] = (squares[1:, 0] != squares[:-1, 0]) | (squares[1:, 1] != squares[:-1, 2] + level.size)
            heads = np.flatnonzero(breaks)
            level.open = np.column_stack([squares[heads[:-1], 0], squares[heads[:-1], 1], squares[heads[1:] - 1, 2]])

    def _close(self, level: _Level, n: int, ended: bool = False) -> None:
        """Report the stretches whose next catcher has had its turn."""
        size, held = level.size, level.open
        if not len(held):
            return
        over = held[:, 2] + 2 * size + held[:, 0] <= n if not ended else np.ones(len(held), bool)
        level.open, held = held[~over], held[over]
        # a run of power * q words holds so many whole blocks, each followed by itself at q
        blocks = ((self.power - 1) * held[:, 0] - size + 1) // size
        held = held[(held[:, 2] - held[:, 1]) // size + 1 >= np.maximum(1, blocks)]
        if len(held):
            held = held[~self._known(held, size)]
        if len(held):
            self._report(level, held)

    def _known(self, held: np.ndarray, size: int) -> np.ndarray:
        """Whether a stretch lies in a reported run whose period divides its own."""
        known = np.zeros(len(held), bool)
        for level in self.levels:
            if len(level.runs):
                at = np.searchsorted(level.runs[:, 0], held[:, 1], side="right") - 1
                run = level.runs[np.maximum(at, 0)]
                known |= (at >= 0) & (held[:, 2] + size + held[:, 0] <= run[:, 1]) & (held[:, 0] % run[:, 2] == 0)
        return known

    def _report(self, level: _Level, held: np.ndarray) -> None:
        q, size = held[:, 0], level.size
        start = held[:, 1] - self._same(held[:, 1] - 1, q, -1, size)
        end = held[:, 2] + size + self._same(held[:, 2] + size, q, 1, size) + q
        keep = end - start >= np.maximum(self.least, self.power * q)
        found = [run for s, e, p in zip(start[keep].tolist(), end[keep].tolist(), q[keep].tolist()) for run in self._exact(s, e, p)]
        if found:
            runs = np.concatenate([level.runs, np.array(found, np.int64)])
            level.runs = runs[np.argsort(runs[:, 0], kind="stable")]

    def _same(self, at: np.ndarray, q: np.ndarray, step: int, most: int) -> np.ndarray:
        """How many words from ``at`` on, in the direction of ``step``, equal the word q later."""
        words, got, live = self.words[:self.n], np.zeros(len(at), np.int64), np.arange(len(at))
        for d in range(min(most, IN_STEP)):
            place = at[live] + step * d
            inside = (place >= 0) & (place + q[live] < self.n)
            live, place = live[inside], place[inside]
            live = live[words[place] == words[place + q[live]]]
            if not len(live):
                return got
            got[live] += 1
        for i in live.tolist():
            done, stride, p = int(got[i]), max(1, IN_STEP), int(q[i])
            while done < most:
                if step > 0:
                    a = int(at[i]) + done
                    b = min(a + stride, int(at[i]) + most, self.n - p)
                    differ = words[a:b] != words[a + p:b + p] if b > a else words[:0]
                else:
                    b = int(at[i]) - done + 1
                    a = max(b - stride, int(at[i]) + 1 - most, 0)
                    differ = (words[a:b] != words[a + p:b + p])[::-1] if b > a else words[:0]
                same = int(differ.argmax()) if differ.any() else len(differ)
                done += same
                if same < stride:
                    break
                stride *= 2
            got[i] = done
        return got

    def _exact(self, start: int, end: int, q: int) -> list[tuple[int, int, int]]:
        """The run itself; should two different blocks have had one name, the runs that are there."""
        differ = np.flatnonzero(self.words[start:end - q] != self.words[start + q:end])
        if not len(differ):
            return [(start, end, q)]
        edges = [start - 1, *(start + differ).tolist(), end - q]
        return [(a + 1, b + q, q) for a, b in zip(edges, edges[1:]) if b - a - 1 + q >= max(self.least, self.power * q)]

    def finish(self) -> np.ndarray:
        """All runs: start, end, smallest period, in order of start and period."""
        for level in self.levels:
            self._close(level, self.n, ended=True)
        runs = np.concatenate([level.runs for level in self.levels])
        runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
        if len(runs):
            # a run of a multiple of the smallest period has the same ends
            runs = runs[np.concatenate([[True], (runs[1:, 0] != runs[:-1, 0]) | (runs[1:, 1] != runs[:-1, 1])])]
        return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of(texts: list[list[bytes]], power: int = 4, least: int = 6) -> list[np.ndarray]:
    """Runs (start, end, period) of each text, given as its words."""
    number = defaultdict(count().__next__)
    longest = max(map(len, texts), default=0)
    sequence, begins, n = [], [], 0
    for i, words in enumerate(texts):
        begins.append(n)
        ids = np.empty(len(words) + 1, np.int64)
        ids[:-1] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        ids[-1] = -1 - i
        sequence.append(ids)
        n += len(ids)
    caught = Catchers(power, least, longest // power)
    if sequence:
        caught.append(np.concatenate(sequence))
    runs = caught.finish()
    of = np.searchsorted(np.array(begins, np.int64), runs[:, 0], side="right") - 1
    bounds = np.searchsorted(of, np.arange(len(texts) + 1))
    return [runs[a:b] - np.array([at, at, 0]) for a, b, at in zip(bounds[:-1], bounds[1:], begins)]


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words but those that a run holds after its first period."""
    if not len(runs):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def _grouped(texts: list[list[bytes]]) -> Iterator[list[int]]:
    """Texts that share a sequence: of like length, and about a stretch of words together."""
    group, total = [], 0
    for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):
        if group and total + len(texts[i]) > STRETCH:
            yield group
            group, total = [], 0
        group.append(i)
        total += len(texts[i]) + 1
    if group:
        yield group


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"


def periodic_runs(docs: DataFrame, power: int = 4, least: int = 6) -> DataFrame:
    """doc_id, n_words, runs (start, length, period, by start, then period), collapsed: a row each."""

    def result(ids: list, texts: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(texts):
            runs = runs_of([texts[i] for i in group], power, least)
            rows, size = [], 0
            for i, found in zip(group, runs):
                short = b" ".join(collapse(texts[i], found))
                stated = [{"start": s, "length": e - s, "period": p} for s, e, p in found.tolist()]
                rows.append((ids[i], len(texts[i]), stated, short))
                size += len(short)
                if size >= BYTES_OUT:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column("doc_id").to_pylist(), batch.column("text")
            at, size, lengths = 0, 0, [len(x) if x.is_valid else 0 for x in map(_view, column)]
            for i, length in enumerate(lengths):
                size += length
                if size >= BYTES_OUT or i + 1 == len(lengths):  # words of so many bytes are held at once
                    yield from result(ids[at:i + 1], [(t or b"").split() for t in column[at:i + 1].to_pylist()])
                    at, size = i + 1, 0

    given = pick(docs, doc_id="long", text="binary")
    return given.mapInArrow(run, SCHEMA).withColumn("collapsed", F.col("collapsed").cast("string"))


class _view:
    """Validity and length of a binary value, without a copy of it."""

    def __init__(self, value: pa.Scalar):
        self.is_valid, self.buffer = value.is_valid, value.as_buffer() if value.is_valid else b""

    def __len__(self) -> int:
        return len(self.buffer)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.list_(RUN), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                                      names=["doc_id", "n_words", "runs", "collapsed"])


def planted(doc_id: Column, text: Column) -> Column:
    """The text of the query: where crc32 of the id is divisible by ten, the words from one place on
    repeat the first of them. Other texts are left as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    turn = F.slice(words, a + 1, p)
    again = F.slice(F.flatten(F.array_repeat(turn, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a), again), " ")
    return F.when((h % 10 == 0) & (n > 0), made).otherwise(text)
