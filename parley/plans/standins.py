"""Deterministic stand-ins for the services that callers inject, for the registered queries."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd

from parley.constants import LARGE_MODEL
from parley.operators.model_stage import ModelFn
from parley.schemas import RESPONSES

STUB_TAGS = re.compile("</?(?:transcription|dem|res)>")


def stub_model(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Deterministic stand-in model for tests, by the md5 of the user content: none for a first
    ``0`` (a failed call), too large for a first ``1`` (on the larger model only with a second
    digit under ``4``), else ``a`` + 8 digits + the whole content without tags."""
    for b in batches:
        rows = []
        for request, messages, model, attempt in zip(b["request_id"], b["messages"], b["model"], b["attempt"]):
            user = messages[-1]["content"]
            h = hashlib.md5(user.encode()).hexdigest()
            big = h[0] == "1" and (model != LARGE_MODEL or h[1] < "4")
            if h[0] == "0":
                continue
            text = None if big else f"a{h[:8]} " + STUB_TAGS.sub("", user)
            rows.append((request, attempt, model, "too_large" if big else "ok", text, len(user.split()), 0 if big else len(text.split())))
        yield pd.DataFrame(rows, columns=[f.name for f in RESPONSES]).astype({"attempt": "int32", "tokens_in": "int64", "tokens_out": "int64"})


def refusing_model(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A stand-in for a stage that another run has been through: calls that failed then may be tried
    again (and fail), any other is an error."""
    for b in stub_model(batches):
        if len(b):
            raise RuntimeError(f"asked again: {list(b['request_id'])[:3]}")
        yield b


def stub_embedder() -> ModelFn:
    """Deterministic stand-in embedder for tests: the 16 bytes of the text's md5, over 255."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            vecs = [[x / 255 for x in hashlib.md5((t or "").encode()).digest()] for t in b["text"]]
            yield pd.DataFrame({"text_key": b["text_key"], "embed": vecs, "tokens": [len((t or "").split()) for t in b["text"]]})
    return run
