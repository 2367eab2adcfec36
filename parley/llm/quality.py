"""Compression classifier for text quality.

Two zstandard dictionaries are built, from passages of good and of bad labelled documents. A text,
cut into blocks so that all of it meets the dictionary, is compressed with each; the normalised
difference (bad size - good size) / (bad size + good size) says which it resembles. A logistic
curve, fitted on other labelled documents in their natural proportion, turns it into the
probability of label 1. The curve also sees the compressed share of the text, (bad size + good
size) / (2 * size): words said over and over compress to next to nothing with any dictionary, so
that their difference alone is noise.

What is learned comes from a bounded sample of labelled rows, chosen by a hash of doc_id:
``dict_docs`` documents a label and at most ``dict_passages`` passages a label for the
dictionaries, ``fit_docs`` documents for the curve. Scores read the text only.

Defined results: text null or empty: the score of a text with the sample's mean difference and
share; a label value other
than 0 and 1, or different ones for one doc_id: not used; one class or none in the sample: every
score is that class's share (0.5 without any); empty tables: no rows; further columns are ignored
or handed through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import pick, staged

BLOCK = 2048
LEVEL = 3
#: Segment and word length of the dictionary builder's cover algorithm.
COVER_K, COVER_D = 256, 8


@dataclass(frozen=True)
class Model:
    """A score is logistic(weights . ((features - means) / scales) + offset)."""

    good: bytes
    bad: bytes
    means: tuple[float, ...]
    scales: tuple[float, ...]
    weights: tuple[float, ...]
    offset: float


def blocks(text: str | None) -> list[bytes]:
    data = (text or "").encode()
    return [data[at:at + BLOCK] for at in range(0, len(data), BLOCK)]


def build_dictionary(passages: list[bytes], size: int) -> bytes:
    """A trained dictionary; the passages themselves where they are too few to train on."""
    if sum(map(len, passages)) >= 8 * size and len(passages) >= 64:
        return zstandard.train_dictionary(size, passages, k=COVER_K, d=COVER_D).as_bytes()
    return b"".join(passages)[-size:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    plain = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
    if len(dictionary) < 8:
        return zstandard.ZstdCompressor(**plain)
    held = zstandard.ZstdCompressionDict(dictionary)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=held, **plain)


def features(texts: list[str | None], good: bytes, bad: bytes) -> np.ndarray:
    """Normalised difference and compressed share of each text; not a number without text."""
    by_good, by_bad = _compressor(good), _compressor(bad)
    out = np.full((len(texts), 2), np.nan)
    for i, text in enumerate(texts):
        pieces = blocks(text)
        if pieces:
            g, b = sum(len(by_good.compress(p)) for p in pieces), sum(len(by_bad.compress(p)) for p in pieces)
            out[i] = (b - g) / (b + g), (b + g) / (2 * sum(map(len, pieces)))
    return out


def fit_curve(good: bytes, bad: bytes, x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> Model:
    """A logistic curve over the features, by Newton's method."""
    some = ~np.isnan(x).any(axis=1)
    x, y = x[some], y[some]
    none = (0.0,) * x.shape[1]
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model(good, bad, none, (1.0,) * x.shape[1], none, math.log(share / (1 - share)))
    means, scales = x.mean(axis=0), x.std(axis=0)
    scales[scales == 0] = 1.0
    z = np.column_stack([(x - means) / scales, np.ones(len(x))])
    w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge * len(y))
    penalty[-1] = 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-z @ w))
        hessian = z.T @ (z * (p * (1 - p))[:, None]) + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, z.T @ (y - p) - penalty * w)
        w = w + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return Model(good, bad, *(tuple(map(float, v)) for v in (means, scales, w[:-1])), float(w[-1]))


def probabilities(x: np.ndarray, model: Model) -> np.ndarray:
    z = (x - np.array(model.means)) / np.array(model.scales)
    return 1 / (1 + np.exp(-np.clip(np.nan_to_num(z) @ np.array(model.weights) + model.offset, -700, 700)))


def labelled(labels: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, label, h of the rows one may learn from. ``held_out`` is over doc_id."""
    given = pick(labels, doc_id="long", quality="int").where("doc_id is not null and quality in (0, 1)")
    return (given.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
            .where("label = other").where(~held_out).select("doc_id", "label", F.xxhash64("doc_id").alias("h")))


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, dict_docs: int = 800, dict_passages: int = 2000,
        fit_docs: int = 3000, dict_bytes: int = 65536) -> Model:
    """Learn a model from the labelled rows that are not held out."""
    usable = labelled(labels, held_out)
    for_dict = F.pmod("h", F.lit(3)) > 0
    by_label = Window.partitionBy("label").orderBy("h", "doc_id")
    chosen = (usable.where(for_dict).withColumn("n", F.row_number().over(by_label)).where(F.col("n") <= dict_docs)
              .select("doc_id", "label", "h", F.lit(True).alias("for_dict"))
              .union(usable.where(~for_dict).orderBy("h", "doc_id").limit(fit_docs)
                     .select("doc_id", "label", "h", F.lit(False).alias("for_dict"))))
    # at most 2 * dict_docs + fit_docs narrow rows are broadcast
    sample = staged(pick(docs, doc_id="long", text="string").join(F.broadcast(chosen), "doc_id"), "labelled")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(label, h, n, piece) for label, h, text in zip(*(batch.column(c).to_pylist() for c in ("label", "h", "text")))
                    for n, piece in enumerate(blocks(text))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in
                                              enumerate((pa.int32(), pa.int64(), pa.int32(), pa.binary()))],
                                             names=["label", "h", "n", "piece"])

    passages = sample.where("for_dict").select("label", "h", "text").mapInArrow(cut, "label int, h long, n int, piece binary")
    spread = passages.withColumn("order", F.xxhash64("h", "n"))
    of = lambda label: [bytes(r.piece) for r in spread.where(F.col("label") == label)
                        .orderBy("order", "h", "n", "piece").limit(dict_passages).select("piece").collect()]
    good, bad = build_dictionary(of(1), dict_bytes), build_dictionary(of(0), dict_bytes)
    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series(list(features(list(texts), good, bad)))

    # a bounded number of rows; of either part if one class has none for its dictionary
    points = (sample if not good or not bad else sample.where("not for_dict")).limit(2 * dict_docs + fit_docs)
    points = points.select("label", measured("text").alias("x")).collect()
    points = sorted((tuple(r.x), r.label) for r in points)
    x = np.array([p[0] for p in points], dtype=float).reshape(len(points), 2)
    return fit_curve(good, bad, x, np.array([p[1] for p in points], dtype=float))


def score(text: Column, model: Model) -> Column:
    """The probability of label 1, 0 to 1."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(probabilities(features(list(texts), model.good, model.bad), model))

    return scored(text)


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))
