"""SentencePiece encoding and decoding with N-best segmentation.

The pieces of a model that match a text make a lattice. Forward Viterbi gives the best score from
the start to every place; these scores are an exact heuristic for a backward A* search from the
end, which therefore yields the segmentations in order of score and touches no place that none of
them uses.

A piece may hold the blank mark only in front, so the lattice falls apart at blanks into chunks
(a run of blanks and what follows it). Each chunk is solved once a worker; frequent ones stay in a
cache of bounded size. With each chunk goes the smallest loss of leaving its best path, known from
the forward pass. The N best segmentations of a text leave the best path in the N - 1 chunks of
smallest loss at most, so the search over the text runs on a lattice of those chunks, whose arcs
are the chunks' own N best segmentations.

A character without a piece is one unknown arc (the lowest score less 10) and is written as its
bytes' pieces if the model has them.

The model is read once, on the driver, from the given path and travels with the query.

Defined results: text null: as empty; an empty text: one segmentation without pieces, score 0;
fewer than n segmentations: all of them; equal scores: the longer last piece first; decoding gives
the normalised text back, so the blank mark itself (U+2581) in a text comes back as a blank;
empty table: no rows; further columns are ignored or handed through.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
UNKNOWN_LESS = 10.0
CACHED_CHUNKS = 200_000
CACHED_LENGTH = 48
#: Chunks of texts whose new ones are solved together, and how many of these in one step.
TOGETHER, AT_ONCE = 50_000, 4096

Arc = tuple[int, float, bytes]   # where it starts, its score, its ids (4 bytes each)


@dataclass(frozen=True)
class Segmentation:
    score: float
    ids: bytes

    def as_ids(self) -> list[int]:
        return np.frombuffer(self.ids, dtype="<i4").tolist()


def best_first(into: list[list[Arc]], forward: list[float], n: int) -> list[tuple[float, list[bytes]]]:
    """The n best paths from place 0 to the last one: score and labels. ``into``: the arcs that end
    at each place; ``forward``: the best score from 0 to it. Backward A* with exact heuristics."""
    out, end, count = [], len(into) - 1, 0
    heap: list = [(-forward[end], end, 0, 0.0, None)]
    while heap and len(out) < n:
        _, at, _, behind, path = heapq.heappop(heap)
        if at == 0:
            labels = []
            while path is not None:
                labels.append(path[0])
                path = path[1]
            out.append((behind, labels))
            continue
        for start, score, label in into[at]:
            count += 1
            total = score + behind
            # of equal ones, the place nearer to the start first, so that the first path is Viterbi's
            heapq.heappush(heap, (-(forward[start] + total), start, count, total, (label, path)))
    return out


class PieceModel:
    def __init__(self, model: bytes):
        sp = self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        #: A trie: by character, (the children, the piece that ends here as (score, ids) or None).
        self.trie: dict[str, tuple] = {}
        self.spelled: list[bytes] = []
        byte_ids, scores = {}, []
        label = lambda i: int(i).to_bytes(4, "little")
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = label(i)
                self.spelled.append(bytes([int(piece[3:5], 16)]))
                continue
            if sp.is_control(i) or sp.is_unknown(i):
                self.spelled.append(b"" if sp.is_control(i) else " ⁇ ".encode())
                continue
            self.spelled.append(piece.replace(MARK, " ").encode())
            if MARK in piece.lstrip(MARK):
                raise ValueError("a piece with the blank mark after another character")
            scores.append(sp.get_score(i))
            if not sp.is_unused(i):
                self._add(piece, (sp.get_score(i), label(i)))
        self.unknown = min(scores, default=0.0) - UNKNOWN_LESS
        self.bytes = byte_ids if len(byte_ids) == 256 else None
        self.unknown_id = label(sp.unk_id())
        self.leading = sp.normalize("a").startswith(MARK)
        self.arrays: tuple[np.ndarray, ...] | None = None
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def _add(self, piece: str, entry: tuple[float, bytes]) -> None:
        kids = self.trie
        for c in piece[:-1]:
            if c not in kids:
                kids[c] = ({}, None)
            kids = kids[c][0]
        kids[piece[-1]] = (kids[piece[-1]][0] if piece[-1] in kids else {}, entry)

    def _unknown_ids(self, c: str) -> bytes:
        return b"".join(self.bytes[b] for b in c.encode()) if self.bytes else self.unknown_id

    def lattice(self, chunk: str) -> list[list[Arc]]:
        """For each place, the arcs that end there, by start."""
        n = len(chunk)
        into: list[list[Arc]] = [[] for _ in range(n + 1)]
        for i in range(n):
            kids = self.trie
            if chunk[i] not in kids or kids[chunk[i]][1] is None:
                into[i + 1].append((i, self.unknown, self._unknown_ids(chunk[i])))
            for j in range(i, n):
                found = kids.get(chunk[j])
                if found is None:
                    break
                kids, entry = found
                if entry is not None:
                    into[j + 1].append((i, *entry))
        return into

    @staticmethod
    def forward(into: list[list[Arc]]) -> list[float]:
        """Viterbi: the best score from the start to each place."""
        best = [0.0]
        for arcs in into[1:]:
            best.append(max(best[arc[0]] + arc[1] for arc in arcs))
        return best

    def solve(self, chunk: str) -> tuple[bytes, float, float]:
        """Ids and score of a chunk's best segmentation, and the smallest loss of leaving it: the
        forward pass without a list of arcs, since nearly all chunks need no more than that."""
        n, trie, low = len(chunk), self.trie, float("-inf")
        best, second, back = [0.0] + [low] * n, [low] * (n + 1), [None] * (n + 1)
        for i in range(n):
            so_far, kids, j = best[i], trie, i
            found = kids.get(chunk[i])
            if found is None or found[1] is None:
                j1 = i + 1
                total = so_far + self.unknown
                if total > best[j1]:
                    second[j1], best[j1], back[j1] = best[j1], total, (i, self._unknown_ids(chunk[i]))
                elif total > second[j1]:
                    second[j1] = total
            while found is not None:
                j += 1
                kids, entry = found
                if entry is not None:
                    total = so_far + entry[0]
                    if total > best[j]:
                        second[j], best[j], back[j] = best[j], total, (i, entry[1])
                    elif total > second[j]:
                        second[j] = total
                if j == n:
                    break
                found = kids.get(chunk[j])
        at, ids, least = n, [], float("inf")
        while at:
            loss = best[at] - second[at]
            if loss < least:
                least = loss
            at, label = back[at]
            ids.append(label)
        ids.reverse()
        return b"".join(ids), best[n], least

    def _tables(self) -> tuple[np.ndarray, ...]:
        """The trie as arrays: steps (node << 21 | character, ascending) and where they lead; by node, its piece's score
        and id (none: minus infinity). The last step is none."""
        if self.arrays is None:
            steps, scores, ids, todo = [], [float("-inf")], [0], [(0, self.trie)]
            while todo:
                node, kids = todo.pop()
                for c, (more, entry) in kids.items():
                    steps.append((node << 21 | ord(c), len(scores)))
                    todo.append((len(scores), more))
                    scores.append(entry[0] if entry else float("-inf"))
                    ids.append(int.from_bytes(entry[1], "little") if entry else 0)
            steps.sort()
            keys = np.array([*(k for k, _ in steps), np.iinfo(np.int64).max], np.int64)
            self.arrays = keys, np.array([*(to for _, to in steps), 0], np.int64), np.array(scores), np.array(ids, "<i4")
        return self.arrays

    def solve_all(self, chunks: list[str]) -> list[tuple[bytes, float, float]]:
        """:meth:`solve` of many chunks, the same steps for all of them at once. No chunk is empty."""
        keys, leads, scores, ids = self._tables()
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        n, longest = len(chunks), int(lengths.max())
        points = np.full((n, longest), 0x1FFFFF, np.int64)  # beyond the end: no character
        points[np.arange(longest) < lengths[:, None]] = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4")
        best, second = np.full((longest + 1, n), -np.inf), np.full((longest + 1, n), -np.inf)
        came, label = np.zeros((longest + 1, n), np.int64), np.zeros((longest + 1, n), np.int64)
        best[0] = 0.0

        def offer(rows: np.ndarray, start: int, end: int, score: np.ndarray | float, mark: np.ndarray | int) -> None:
            total, held = best[start, rows] + score, best[end, rows]
            up = total > held
            second[end, rows] = np.where(up, held, np.maximum(second[end, rows], total))
            best[end, rows] = np.where(up, total, held)
            came[end, rows] = np.where(up, start, came[end, rows])
            label[end, rows] = np.where(up, mark, label[end, rows])

        for start in range(longest):
            rows = np.flatnonzero(lengths > start)
            node = np.zeros(len(rows), np.int64)
            for end in range(start + 1, longest + 1):
                step = node << 21 | points[rows, end - 1]
                at = np.searchsorted(keys, step)
                there = keys[at] == step
                node = leads[at]
                if end == start + 1:
                    alone = there & (scores[node] > -np.inf)
                    offer(rows[~alone], start, end, self.unknown, -1)
                rows, node = rows[there], node[there]
                piece = scores[node] > -np.inf
                offer(rows[piece], start, end, scores[node[piece]], node[piece])
                if not len(rows):
                    break
        at, every, least, path = lengths.copy(), np.arange(n), np.full(n, np.inf), []
        while at.any():
            going = at > 0
            least = np.where(going, np.minimum(least, best[at, every] - second[at, every]), least)
            path.append((np.where(going, label[at, every], -2), at))
            at = np.where(going, came[at, every], 0)
        marks = np.stack([m for m, _ in path[::-1]], axis=1)
        flat, counts = ids[np.maximum(marks, 0)][marks != -2].tobytes(), (marks != -2).sum(axis=1)
        ends = 4 * np.cumsum(counts)
        out = [flat[b - 4 * k:b] for b, k in zip(ends.tolist(), counts.tolist())]
        for i in np.flatnonzero((marks == -1).any(axis=1)).tolist():
            parts = [self._unknown_ids(chunks[i][e[i] - 1]) if m[i] == -1 else ids[m[i]].tobytes() for m, e in path[::-1] if m[i] != -2]
            out[i] = b"".join(parts)
        return list(zip(out, best[lengths, every].tolist(), least.tolist()))

    def _learn(self, chunks: set[str]) -> None:
        """Solve and keep the chunks that are not known."""
        new = sorted((c for c in chunks if 0 < len(c) <= CACHED_LENGTH and c not in self.young and c not in self.old), key=len)
        for at in range(0, len(new), AT_ONCE):
            part = new[at:at + AT_ONCE]
            for chunk, got in zip(part, self.solve_all(part)):
                if len(self.young) >= CACHED_CHUNKS:
                    self.young, self.old = {}, self.young
                self.young[chunk] = got

    def solved(self, chunk: str) -> tuple[bytes, float, float]:
        got = self.young.get(chunk)
        if got is None:
            got = self.old.get(chunk) or self.solve(chunk)
            if len(chunk) <= CACHED_LENGTH:
                if len(self.young) >= CACHED_CHUNKS:
                    self.young, self.old = {}, self.young
                self.young[chunk] = got
        return got

    def chunk_best(self, chunk: str, n: int) -> list[tuple[float, bytes]]:
        into = self.lattice(chunk)
        return [(score, b"".join(labels)) for score, labels in best_first(into, self.forward(into), n)]

    def chunks(self, text: str) -> list[str]:
        """The normalised text cut before each run of blank marks."""
        norm = self.sp.normalize(text)
        if MARK + MARK in norm or " " in norm:
            return CHUNK.findall(norm)
        found = norm.replace(MARK, " " + MARK).split(" ")
        return found if found[0] else found[1:]

    def segment(self, text: str | None, n: int = 1) -> list[Segmentation]:
        """The n best segmentations of a text, best first."""
        return self._segment(self.chunks(text or ""), n)

    def segments(self, texts: Iterable[str | None], n: int = 1) -> Iterator[list[Segmentation]]:
        """:meth:`segment` of many texts, whose new chunks are solved together."""
        held, size = [], 0
        for text in texts:
            held.append(self.chunks(text or ""))
            size += len(held[-1])
            if size >= TOGETHER:
                yield from self._segments(held, n)
                held, size = [], 0
        yield from self._segments(held, n)

    def _segments(self, held: list[list[str]], n: int) -> Iterator[list[Segmentation]]:
        self._learn(set().union(*held))
        for chunks in held:
            yield self._segment(chunks, n)

    def _segment(self, chunks: list[str], n: int) -> list[Segmentation]:
        known, solved = self.young.get, self.solved
        if not chunks:
            return [Segmentation(0.0, b"")]
        ids, scores, losses = zip(*[known(c) or solved(c) for c in chunks])
        total = float(sum(scores))
        out = [Segmentation(total, b"".join(ids))]
        if n < 2:
            return out
        places, rest = [], list(losses)
        for _ in range(min(n - 1, len(rest))):
            least = min(rest)
            if least == float("inf"):
                break
            places.append(rest.index(least))
            rest[places[-1]] = float("inf")
        places.sort()
        into: list[list[Arc]] = [[]]
        into += [[(k, score, label) for score, label in self.chunk_best(chunks[i], n)] for k, i in enumerate(places)]
        forward = [total - sum(scores[i] for i in places)]
        for i in places:
            forward.append(forward[-1] + scores[i])
        parts = list(ids)
        for score, labels in best_first(into, forward, n)[1:]:
            for i, label in zip(places, labels):
                parts[i] = label
            out.append(Segmentation(forward[0] + score, b"".join(parts)))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of a segmentation."""
        spelled = self.spelled
        text = b"".join([spelled[i] for i in np.frombuffer(ids, dtype="<i4").tolist()]).decode("utf-8", "replace")
        return text[1:] if self.leading and text.startswith(" ") else text


_MODELS: dict[str, PieceModel] = {}


def loaded(model: bytes) -> PieceModel:
    """The model; a Python worker keeps the latest."""
    name = hashlib.sha256(model).hexdigest()
    if name not in _MODELS:
        _MODELS.clear()
        _MODELS[name] = PieceModel(model)
    return _MODELS[name]


def read_model(path: str = DEFAULT_MODEL) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(text: Column, model: bytes) -> Column:
    """The ids of the best segmentation: array<int>."""

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        use = loaded(model)
        return pd.Series([np.frombuffer(found[0].ids, dtype="<i4") for found in use.segments(texts)])

    return run(text)


def add_pieces(docs: DataFrame, model: bytes, n: int, at_once: int = 256) -> DataFrame:
    """``docs`` with ``piece_ids`` (ids of the best segmentation of ``text``) and ``nbest_scores`` (scores
    of the n best); columns of these names are replaced. A worker holds the ids of ``at_once`` texts."""
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("piece_ids", "nbest_scores")))
    place = [c.lower() for c in kept.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = loaded(model)
        for batch in batches:
            for at in range(0, batch.num_rows, at_once):
                part = batch.slice(at, at_once)
                found = list(use.segments(part.column(place).to_pylist(), n))
                ids = pa.array([np.frombuffer(f[0].ids, dtype="<i4") for f in found], pa.list_(pa.int32()))
                scores = pa.array([[s.score for s in f] for f in found], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns, ids, scores], names=[*part.schema.names, "piece_ids", "nbest_scores"])

    schema = T.StructType([*kept.schema.fields, T.StructField("piece_ids", T.ArrayType(T.IntegerType())),
                           T.StructField("nbest_scores", T.ArrayType(T.DoubleType()))])
    return kept.mapInArrow(run, schema)


def encode_nbest(text: Column, model: bytes, n: int) -> Column:
    """The n best segmentations, best first: struct(scores array<double>, ids array<array<int>>)."""

    @F.pandas_udf("scores array<double>, ids array<array<int>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = list(loaded(model).segments(texts, n))
        return pd.DataFrame({"scores": [[s.score for s in f] for f in found], "ids": [[s.as_ids() for s in f] for f in found]})

    return run(text)


def decode(ids: Column, model: bytes) -> Column:
    """The text of an array<int> of ids; null for null."""

    @F.pandas_udf("string")
    def run(lists: pd.Series) -> pd.Series:
        use = loaded(model)
        return pd.Series([None if x is None else use.decode(np.asarray(x, dtype="<i4").tobytes()) for x in lists])

    return run(ids)


def nbest_digest(text: Column, model: bytes, n: int) -> Column:
    """What :func:`encode_nbest` and :func:`decode` give, as digests, so that no ids leave the worker:
    struct(scores, n_pieces, ids_sha256 (of 4-byte little-endian ids), decoded_sha256, round_trip)."""
    kind = "scores array<double>, n_pieces array<int>, ids_sha256 array<string>, decoded_sha256 string, round_trip boolean"

    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.DataFrame:
        use, rows = loaded(model), []
        for text, found in zip(texts, use.segments(texts, n)):
            plain = (text or "").replace(MARK, " ")
            back = use.decode(found[0].ids)
            rows.append(([s.score for s in found], [len(s.ids) // 4 for s in found], [hashlib.sha256(s.ids).hexdigest() for s in found],
                         hashlib.sha256(back.encode()).hexdigest(), back == plain))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in kind.split(", ")])

    return run(text)
