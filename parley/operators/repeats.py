"""WIN-1: equidistant-repetition filter.

Rule: split a text into words with positions. For a word seen at least ``min_occurrences``
times, look at the gaps between its consecutive positions. For each gap length, the positions
touched by gaps of that length form a set; if a set has at least ``min_positions`` members,
every position in it is deleted (the first one included, behaviour B1). The remaining words
are re-joined with single blanks. A text that loses every word becomes ``''``; a null text
stays null.

The rule concerns one text at a time, so it needs no shuffle: a batch of texts is one Arrow
batch, whose words are numbered and handled together by array operations. (As DataFrame steps it
took a shuffle of the texts and three sorts of every word; see README for both times.) A set's
size is computed without building the set: for gap length d, ``|S_d| = 2 * A_d - C_d`` where
``A_d`` is the number of gaps of length d and ``C_d`` the number of positions whose gaps on both
sides have length d.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.constants import REPEAT_MIN_OCCURRENCES, REPEAT_MIN_POSITIONS
from parley.functions.text import by_slices

#: Words handled at once; a longer text is a batch of its own.
WORDS_AT_ONCE = 1 << 18


def deleted_words(keys: np.ndarray, min_occurrences: int, min_positions: int, keep_first: bool) -> np.ndarray:
    """Which places of a run of words go. ``keys`` numbers the pairs (text, word), so that places
    of different texts never meet."""
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    same = np.zeros(n + 1, dtype=bool)
    same[1:n] = keys[order[1:]] == keys[order[:-1]]
    before = np.where(same[:n], np.diff(order, prepend=0), 0)    # gap to the same word before, 0 for none
    after = np.append(before[1:], 0)                             # and behind
    after[~same[1:]] = 0
    _, word = np.unique(keys[order], return_inverse=True)
    often = np.bincount(word)[word] >= min_occurrences
    wide = np.int64(n + 1)
    kinds, kind = np.unique(word * wide + before, return_inverse=True)
    sizes = 2 * np.bincount(kind) - np.bincount(kind, weights=(before == after), minlength=len(kinds)).astype(np.int64)
    sizes[kinds % wide == 0] = 0
    behind = np.searchsorted(kinds, word * wide + after)
    gone = often & ((sizes[kind] >= min_positions) | ((after > 0) & (sizes[np.minimum(behind, len(kinds) - 1)] >= min_positions)))
    if keep_first:
        firsts = np.flatnonzero(gone)
        gone[firsts[np.unique(word[firsts], return_index=True)[1]]] = False
    out = np.zeros(n, dtype=bool)
    out[order] = gone
    return out


def _batches(texts: pd.Series) -> Iterator[tuple[list[int], list[list[str]]]]:
    rows, words, held = [], [], 0
    for i, text in enumerate(texts):
        if text is None:
            continue
        own = text.split()
        rows.append(i)
        words.append(own)
        held += len(own)
        if held >= WORDS_AT_ONCE:
            yield rows, words
            rows, words, held = [], [], 0
    yield rows, words


def without_repeats(texts: pd.Series, min_occurrences: int, min_positions: int, keep_first: bool) -> pd.Series:
    out: list[str | None] = [None] * len(texts)
    for rows, words in _batches(texts):
        numbers: dict[str, int] = {}
        codes = np.fromiter((numbers.setdefault(w, len(numbers)) for own in words for w in own), dtype=np.int64)
        lengths = np.array([len(own) for own in words], dtype=np.int64)
        keys = np.repeat(np.arange(len(words)), lengths) * max(1, len(numbers)) + codes
        gone = deleted_words(keys, min_occurrences, min_positions, keep_first) if len(keys) else np.zeros(0, dtype=bool)
        ends = np.cumsum(lengths)
        hit = np.add.reduceat(np.append(gone, False), np.minimum(ends - lengths, len(gone))) if len(words) else []
        for i, own, end, some in zip(rows, words, ends, hit):
            if len(own) and some:
                own = [w for w, g in zip(own, gone[end - len(own):end]) if not g]
            out[i] = " ".join(own)
    return pd.Series(out, dtype=object)


def repeats_removed(text: Column, min_occurrences: int = REPEAT_MIN_OCCURRENCES,
                    min_positions: int = REPEAT_MIN_POSITIONS, keep_first: bool = False) -> Column:
    """The text without its repeated words. ``keep_first=True`` keeps the first position of each
    deleted word (our option)."""

    return by_slices(lambda texts: without_repeats(texts, min_occurrences, min_positions, keep_first))(text)


def filter_repeats(df: DataFrame, id_col: str, text_col: str, out_col: str | None = None, **settings) -> DataFrame:
    """Return ``(id_col, out_col)`` with repeated words removed; one row per input row."""
    return df.select(id_col, repeats_removed(F.col(text_col), **settings).alias(out_col or text_col))
