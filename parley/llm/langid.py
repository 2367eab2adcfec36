"""Language identification with string kernels.

A text is the set of its letter n-grams of 1 to 3 symbols (blended spectrum, presence only), after
lower-casing, with every run of other characters as one blank. The kernel of two texts is the size
of the sets' intersection over the root of the product of their sizes. Landmark texts give a
Nyström map (kernel to the landmarks times the inverse root of the landmarks' own kernel matrix),
on which one ridge regression a language is fitted, one language against the rest.

Scoring a batch is a product of matrices: the texts' sparse presence matrix times the landmarks'
presence matrix times the regression's coefficients. The second product holds no text, so it is
done once, and each batch takes one sparse product. The largest output is the language.

What is learned comes from a bounded sample: ``per_lang`` documents of each of at most
``max_langs`` languages (the most frequent), cut into pieces, of which at most ``pieces`` a
language train and ``landmarks`` in all are landmarks. Predictions read the text only.

Defined results: text null or without a letter: language ``und``, score 0; nothing to learn from:
``und`` for all; letters that the sample did not show are one common symbol; ties go to the first
language by code point; empty table: no rows; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import pick, staged

#: Symbols: 0 blank, 1 any other letter, 2 and above the sample's letters, the most frequent first.
#: Up to so many symbols, tables over all n-grams serve; a larger alphabet looks codes up in order.
BASE = 96
#: Lengths of training pieces, in turn, so that short and long texts are learned.
PIECES = (80, 300, 1200, 4000)
UND = "und"


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    letters: str
    grams: bytes      # int64 codes of the landmarks' n-grams, ascending
    weights: bytes    # float32, a row for each n-gram and a column for each language


def symbol_table(letters: str) -> np.ndarray:
    """Symbol of every code point."""
    table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=np.int32, count=0x110000)
    for i, c in enumerate(letters):
        table[ord(c)] = i + 2
    return table


class Coder:
    """Texts to sets of n-gram codes."""

    def __init__(self, letters: str):
        self.table = symbol_table(letters)
        self.base = max(BASE, len(letters) + 2)
        self.space = self.base + self.base ** 2 + self.base ** 3
        self.last = np.zeros(self.space, dtype=np.int32) if self.base == BASE else None

    def codes(self, text: str | None) -> np.ndarray:
        """The distinct n-gram codes, in order of last place; empty without a letter."""
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        s = self.table[points]
        if self.last is None:
            s = s.astype(np.int64)
        if not s.any():
            return s[:0]
        keep = np.ones(len(s), dtype=bool)
        keep[1:] = (s[1:] > 0) | (s[:-1] > 0)
        s = s[keep]
        base = self.base
        pairs = s[:-1] * base + s[1:]
        triples = pairs[:-1] * base + s[2:]
        all_codes = np.concatenate([s, pairs + base, triples + base + base ** 2])
        if self.last is None:
            places = np.unique(all_codes[::-1], return_index=True)[1]
            return all_codes[np.sort(len(all_codes) - 1 - places)]
        order = np.arange(len(all_codes), dtype=np.int32)
        self.last[all_codes] = order
        return all_codes[self.last[all_codes] == order]


class Rows:
    """The row of each code: its place in ``grams`` (ascending), or their number for any other."""

    def __init__(self, grams: np.ndarray, coder: Coder):
        self.grams, self.row_of = grams, None
        if coder.last is not None:
            self.row_of = np.full(coder.space, len(grams), dtype=np.int32)
            self.row_of[grams] = np.arange(len(grams), dtype=np.int32)

    def __getitem__(self, codes: np.ndarray) -> np.ndarray:
        if self.row_of is not None:
            return self.row_of[codes]
        at = np.searchsorted(self.grams, codes)
        known = at < len(self.grams)
        known[known] = self.grams[at[known]] == codes[known]
        return np.where(known, at, len(self.grams))


def kernel(sets: list[np.ndarray], presence: np.ndarray, row_of: Rows, sizes: np.ndarray) -> np.ndarray:
    """Texts against landmarks. ``presence``: n-gram rows by landmark; ``row_of``: row of each code,
    the last (a row of zeros) for codes that no landmark has."""
    out = np.zeros((len(sets), presence.shape[1]))
    for i, codes in enumerate(sets):
        if len(codes):
            out[i] = presence[row_of[codes]].sum(axis=0) / np.sqrt(len(codes) * sizes)
    return out


def train(pieces: list[tuple[str, str]], landmarks: int, ridge: float) -> Model:
    """``pieces``: (language, text) in a fixed order."""
    langs = tuple(sorted({lang for lang, _ in pieces}))
    counts = Counter(c for _, text in pieces for c in text.lower() if c.isalpha())
    letters = "".join(c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])))
    coder = Coder(letters)
    kept = [(lang, codes) for lang, text in pieces if len(codes := coder.codes(text))]
    if not kept:
        return Model((), "", b"", b"")
    each, taken, marks = max(1, landmarks // len(langs)), Counter(), []
    for lang, codes in kept:
        if taken[lang] < each:
            taken[lang] += 1
            marks.append(codes)
    grams = np.unique(np.concatenate(marks)).astype(np.int64)
    row_of = Rows(grams, coder)
    presence = np.zeros((len(grams) + 1, len(marks)), dtype=np.float32)
    for j, codes in enumerate(marks):
        presence[row_of[codes], j] = 1
    sizes = np.array([len(c) for c in marks], dtype=float)
    own = kernel(marks, presence, row_of, sizes)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    good = values > 1e-8 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi = kernel([codes for _, codes in kept], presence, row_of, sizes) @ root
    y = np.array([[1.0 if lang == other else 0.0 for other in langs] for lang, _ in kept])
    beta = np.linalg.solve(phi.T @ phi + ridge * len(kept) * np.eye(phi.shape[1]), phi.T @ y)
    alpha = root @ beta / np.sqrt(sizes)[:, None]
    weights = (presence[:-1].astype(float) @ alpha).astype(np.float32)
    return Model(langs, letters, grams.tobytes(), weights.tobytes())


class Scorer:
    def __init__(self, model: Model):
        self.langs, self.coder = model.langs, Coder(model.letters)
        width, grams = max(1, len(model.langs)), np.frombuffer(model.grams, dtype=np.int64)
        weights = np.frombuffer(model.weights, dtype=np.float32).reshape(-1, width)
        if self.coder.last is not None:  # a row for every code
            self.rows, self.weights = None, np.zeros((self.coder.space, width), dtype=np.float32)
            self.weights[grams] = weights
        else:
            self.rows, self.weights = Rows(grams, self.coder), np.concatenate([weights, np.zeros((1, width), dtype=np.float32)])

    def outputs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Regression outputs (text by language), and whether a text has a letter."""
        out, some = np.zeros((len(texts), self.weights.shape[1])), np.zeros(len(texts), dtype=bool)
        for i, text in enumerate(texts):
            codes = self.coder.codes(text)
            if len(codes):
                some[i] = True
                out[i] = self.weights[codes if self.rows is None else self.rows[codes]].sum(axis=0, dtype=np.float64) / np.sqrt(len(codes))
        return out, some

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        out, some = self.outputs(texts)
        if not self.langs:
            return [UND] * len(texts), np.zeros(len(texts))
        best = out.argmax(axis=1)
        score = np.clip(out[np.arange(len(texts)), best], 0, 1) * some
        return [self.langs[b] if s else UND for b, s in zip(best, some)], score


_SCORERS: dict[Model, Scorer] = {}


def scorer_of(model: Model) -> Scorer:
    """The scorer of a model; a Python worker keeps the latest."""
    if model not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model] = Scorer(model)
    return _SCORERS[model]


def fit(docs: DataFrame, held_out: Column, per_lang: int = 300, pieces: int = 400, landmarks: int = 256,
        max_langs: int = 256, ridge: float = 1e-4) -> Model:
    """Learn from text and lang of the rows of ``docs`` that are not held out (over doc_id)."""
    usable = pick(docs, doc_id="long", lang="string").where("doc_id is not null and lang is not null").where(~held_out)
    frequent = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).select("lang")
    by_lang = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = (usable.join(F.broadcast(frequent), "lang").withColumn("h", F.xxhash64("doc_id"))
              .withColumn("n", F.row_number().over(by_lang)).where(F.col("n") <= per_lang).select("doc_id", "h").distinct())
    # at most per_lang * max_langs narrow rows are broadcast
    sample = pick(docs, doc_id="long", lang="string", text="string").where("lang is not null").join(F.broadcast(chosen), "doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lang, h, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "h", "text"))):
                at, n, text = 0, h % len(PIECES), text or ""
                while at < len(text):
                    size = PIECES[n % len(PIECES)]
                    rows.append((lang, h, n, text[at:at + size]))
                    at, n = at + size, n + 1
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in
                                              enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                             names=["lang", "h", "n", "piece"])

    cuts = sample.select("lang", "h", "text").mapInArrow(cut, "lang string, h long, n long, piece string")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("h", "n"), "h", "n", "piece")
    rows = staged(cuts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= pieces), "pieces")
    got = sorted((r.lang, r["rank"], r.piece) for r in rows.select("lang", "rank", "piece").collect())
    return train([(lang, piece) for lang, _, piece in got], landmarks, ridge)


def predict(text: Column, model: Model) -> Column:
    """struct(lang, score)."""

    @F.pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        langs, scores = scorer_of(model).predict(list(texts))
        return pd.DataFrame({"lang": langs, "score": scores})

    return run(text)
