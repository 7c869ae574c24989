"""SentencePiece encoding and decoding in numpy batches inside tasks.

A text becomes units, runs of spaces with the word that follows.  No piece goes
on into a space after a word, so units are encoded on their own and each
distinct unit once per task.  Units of equal length advance together: hashes of
substrings are running-hash differences that probe the sorted hashes of the
pieces, and vectorised maxima decide each step.

* Unigram models: Viterbi over character positions; the best score of each end
  position and the backpointer are maxima over the piece lengths.
* BPE models: the best-scored path is not the model's segmentation, which is
  defined by merges.  There each step takes, in every unit of the batch, the
  best-scored neighbouring pair (leftmost of equals) and merges it.

Characters without a piece become their UTF-8 bytes' pieces where the model has
byte pieces, else the unknown piece.  Decoding gathers piece bytes by id.

Defined results: null and empty texts have no ids and decode to an empty text;
U+2581 is the model's own space sign and decodes to a space; texts of any
length are encoded whole; of pairs with one score the leftmost is merged, as the
model defines; rows with one doc_id or none, and repeated rows, are encoded each
by itself; an empty table gives an empty result; only ``doc_id`` and ``text`` are
looked at, whatever other columns are called.  Units of more than ``_LONG``
characters are merged with a heap, which gives the same ids.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import textkit as tk

MODEL = "/opt/tokenizers/piece_bpe_32k.model"

_NORMAL, _UNKNOWN, _USER, _UNUSED, _BYTE = 1, 2, 4, 5, 6
_SIGN = "▁".encode()
#: characters of a unit from which on it is encoded alone, with a heap
_LONG = 48
#: distinct units that a task remembers
_REMEMBER = 400_000
_NONE = np.float32(-np.inf)


@dataclass
class Pieces:
    """Tables of a model; small (the vocabulary), sent to the tasks with the code."""

    surface: list[bytes]
    scores: np.ndarray
    kinds: np.ndarray
    unigram: bool
    dummy_prefix: bool

    @staticmethod
    def load(path: str = MODEL) -> Pieces:
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        return Pieces.of(model)

    @staticmethod
    def of(model) -> Pieces:
        norm, kinds = model.normalizer_spec, np.array([p.type for p in model.pieces])
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models with the identity normaliser are supported")
        if model.trainer_spec.model_type not in (1, 2) or (kinds == _USER).any() or (kinds == _UNUSED).any():
            raise ValueError("only unigram and BPE models without user-defined or unused pieces are supported")
        surface = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == _BYTE else p.piece.encode().replace(_SIGN, b" ")
            for p in model.pieces
        ]
        if any(b" " in s.lstrip(b" ") for s, k in zip(surface, kinds, strict=True) if k == _NORMAL):
            raise ValueError("a piece goes on into a space after a word")
        scores = np.array([p.score for p in model.pieces], dtype=np.float32)
        return Pieces(surface, scores, kinds, model.trainer_spec.model_type == 1, norm.add_dummy_prefix)

    @cached_property
    def unknown(self) -> int:
        return int(np.flatnonzero(self.kinds == _UNKNOWN)[0])

    @cached_property
    def byte_ids(self) -> np.ndarray | None:
        out = np.full(256, -1, dtype=np.int32)
        for i in np.flatnonzero(self.kinds == _BYTE):
            out[self.surface[i][0]] = i
        return out if (out >= 0).all() else None

    @cached_property
    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the normal pieces and their ids."""
        ids = np.flatnonzero(self.kinds == _NORMAL)
        size = np.array([len(self.surface[i]) for i in ids])
        ends = np.cumsum(size)
        run = tk.prefix_hash(np.frombuffer(b"".join(self.surface[i] for i in ids), np.uint8))
        h = _raw_hash(run, ends - size, ends)
        order = np.argsort(h)
        return h[order], ids[order].astype(np.int32)

    @cached_property
    def longest(self) -> int:
        return max(len(self.surface[i].decode()) for i in np.flatnonzero(self.kinds == _NORMAL))

    @cached_property
    def by_bytes(self) -> dict[bytes, int]:
        return {self.surface[i]: int(i) for i in np.flatnonzero(self.kinds == _NORMAL)}

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, -1 where there is none."""
        keys, ids = self.keys
        k = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[k] == hashes, ids[k], np.int32(-1))

    def score(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids >= 0, self.scores[ids], _NONE)


def _raw_hash(run: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Polynomial hash of spans, not mixed: hashes of neighbours can be joined."""
    _, down = tk.powers(len(run) - 1)
    return (run[e] - run[s]) * down[s]


def _merge_batch(p: Pieces, h: np.ndarray, size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """BPE of units of one length: (units, ids, byte lengths) in groups of one number of symbols.

    ``h`` and ``size`` are hashes and byte lengths of the characters, units x characters.
    """
    up, _ = tk.powers(int(size.sum(axis=1).max()) if size.size else 1)
    unit, ids = np.arange(len(h)), p.find(h.ravel()).reshape(h.shape)
    pair = p.find((h[:, :-1] + h[:, 1:] * up[size[:, :-1]]).ravel()).reshape(len(h), -1)
    out = []
    while True:
        k = h.shape[1]
        if k == 1:
            out.append((unit, ids, size))
            return out
        score = p.score(pair)
        best = score.argmax(axis=1)
        row = np.arange(len(h))
        done = score[row, best] == _NONE
        if done.any():
            out.append((unit[done], ids[done], size[done]))
            go = ~done
            if not go.any():
                return out
            unit, h, size, ids, pair, best = unit[go], h[go], size[go], ids[go], pair[go], best[go]
            row = np.arange(len(h))
        h[row, best] += h[row, best + 1] * up[size[row, best]]
        size[row, best] += size[row, best + 1]
        ids[row, best] = pair[row, best]
        cols = np.arange(k - 1)
        keep = cols + (cols > best[:, None])
        h, size, ids = (np.take_along_axis(x, keep, 1) for x in (h, size, ids))
        cols = np.arange(k - 2)
        pair = np.take_along_axis(pair, cols + (cols >= best[:, None]), 1)
        for j, ok in ((best - 1, best > 0), (best, best < k - 2)):
            r, c = row[ok], j[ok]
            pair[r, c] = p.find(h[r, c] + h[r, c + 1] * up[size[r, c]])


def _viterbi_batch(p: Pieces, run: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Unigram best path of units of one length; ``at`` has their character offsets, units x (n + 1)."""
    units, n = len(at), at.shape[1] - 1
    worst = np.float32(p.scores[p.kinds == _NORMAL].min() - 10)
    best = np.zeros((units, n + 1), dtype=np.float64)
    back = np.zeros((units, n + 1), dtype=np.int64)
    piece = np.full((units, n + 1), -1, dtype=np.int32)
    for end in range(1, n + 1):
        lengths = np.arange(min(end, p.longest), 0, -1)  # of equal scores the longest last piece
        begin = end - lengths
        ids = p.find(_raw_hash(run, at[:, begin].ravel(), np.repeat(at[:, end], len(lengths)))).reshape(units, -1)
        score = p.score(ids).astype(np.float64)
        score[:, -1] = np.where(ids[:, -1] < 0, worst, score[:, -1])
        score += best[:, begin]
        pick = score.argmax(axis=1)
        row = np.arange(units)
        best[:, end], back[:, end], piece[:, end] = score[row, pick], begin[pick], ids[row, pick]
    out = []
    for u in range(units):
        end, ids, size = n, [], []
        while end:
            ids.append(piece[u, end])
            size.append(at[u, end] - at[u, back[u, end]])
            end = back[u, end]
        out.append((np.array([u]), np.array([ids[::-1]], np.int32), np.array([size[::-1]], np.int64)))
    return out


def _merge_long(p: Pieces, unit: bytes) -> tuple[list[int], list[int]]:
    """BPE of one long unit with a heap of pairs; the same order of merges."""
    parts = [c.encode() for c in unit.decode("utf-8", "surrogatepass")]
    left, right, live = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1)), [True] * len(parts)
    heap: list[tuple[float, int, int, bytes]] = []

    def offer(i: int) -> None:
        j = right[i]
        if j < len(parts) and (k := p.by_bytes.get(parts[i] + parts[j])) is not None:
            heapq.heappush(heap, (-float(p.scores[k]), i, j, parts[i] + parts[j]))

    for i in range(len(parts) - 1):
        offer(i)
    while heap:
        _, i, j, whole = heapq.heappop(heap)
        if not live[i] or right[i] != j or not live[j] or parts[i] + parts[j] != whole:
            continue
        parts[i], live[j], right[i] = whole, False, right[j]
        if right[j] < len(parts):
            left[right[j]] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    kept = [x for x, ok in zip(parts, live, strict=True) if ok]
    return [p.by_bytes.get(x, -1) for x in kept], [len(x) for x in kept]


class Encoder:
    """Encodes chunks of texts; remembers the ids of units seen before in the task."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.where = np.zeros((0, 2), dtype=np.int64)  # begin and number of ids
        self.store = np.zeros(0, dtype=np.int32)

    def _encode_units(self, buf: np.ndarray, run: np.ndarray, s: np.ndarray, e: np.ndarray):
        """(numbers of ids, ids) of the units at s..e of the bytes."""
        lead = (buf & 0xC0) != 0x80
        chars = np.concatenate(([0], np.cumsum(lead)))
        starts = np.append(np.flatnonzero(lead), len(buf))
        first = chars[s]
        n = chars[e] - first
        count = np.zeros(len(s), dtype=np.int64)
        groups = []
        for size in np.unique(n[n < _LONG] if not self.p.unigram else n):
            units = np.flatnonzero(n == size)
            at = starts[first[units][:, None] + np.arange(size + 1)]
            if self.p.unigram:
                got = _viterbi_batch(self.p, run, at)
            else:
                h = _raw_hash(run, at[:, :-1].ravel(), at[:, 1:].ravel()).reshape(len(units), size)
                got = _merge_batch(self.p, h, np.diff(at, axis=1))
            groups += [(units[u], ids, width) for u, ids, width in got]
        if not self.p.unigram:
            for u in np.flatnonzero(n >= _LONG):
                ids, width = _merge_long(self.p, buf[s[u] : e[u]].tobytes())
                groups.append((np.array([u]), np.array([ids], np.int32), np.array([width], np.int64)))
        flat = []
        for units, ids, width in groups:
            if (ids < 0).any():
                for u, row, w in zip(units, ids, width, strict=True):
                    row = self._spell(row, w, buf[s[u] : e[u]])
                    count[u] = len(row)
                    flat.append((np.array([u]), row[None, :]))
            else:
                count[units] = ids.shape[1]
                flat.append((units, ids))
        begin = np.cumsum(count) - count
        out = np.empty(int(count.sum()), dtype=np.int32)
        for units, ids in flat:
            out[begin[units][:, None] + np.arange(ids.shape[1])] = ids
        return count, out

    def _spell(self, ids: np.ndarray, width: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """Byte pieces (or the unknown piece) for characters without a piece."""
        out, at, last = [], 0, None
        for i, w in zip(ids, width, strict=True):
            if i >= 0:
                out.append(int(i))
            elif self.p.byte_ids is not None:
                out += self.p.byte_ids[raw[at : at + w]].tolist()
            elif last != -1:  # a run of unknown characters is one unknown piece
                out.append(self.p.unknown)
            last, at = i, at + int(w)
        return np.array(out, dtype=np.int32)

    def encode(self, buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, where each document's ids begin) of a chunk of texts."""
        sign = np.frombuffer(_SIGN, np.uint8)
        if len(buf) >= 3 and ((buf[:-2] == sign[0]) & (buf[1:-1] == sign[1]) & (buf[2:] == sign[2])).any():
            texts = [buf[a:b].tobytes().replace(_SIGN, b" ") for a, b in zip(starts[:-1], starts[1:], strict=True)]
            buf = np.frombuffer(b"".join(texts), np.uint8)
            starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        if self.p.dummy_prefix:
            full = np.diff(starts) > 0
            buf = np.insert(buf, starts[:-1][full], 0x20)
            starts = starts + np.concatenate(([0], np.cumsum(full)))
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(len(starts), np.int64)
        space = buf == 0x20
        begin = space.copy()
        begin[1:] &= ~space[:-1]
        begin[starts[:-1][np.diff(starts) > 0]] = True
        s = np.flatnonzero(begin)
        e = np.append(s[1:], len(buf))
        run = tk.prefix_hash(buf)
        keys, one, back = np.unique(tk.span_hash(run, s, e), return_index=True, return_inverse=True)
        if len(self.known) > _REMEMBER:
            self._forget()
        k = np.minimum(np.searchsorted(self.known, keys), max(0, len(self.known) - 1))
        new = self.known[k] != keys if len(self.known) else np.ones(len(keys), dtype=bool)
        if new.any():
            count, ids = self._encode_units(buf, run, s[one[new]], e[one[new]])
            where = np.stack((len(self.store) + np.cumsum(count) - count, count), axis=1)
            self.store = np.concatenate((self.store, ids))
            known = np.concatenate((self.known, keys[new]))
            order = np.argsort(known, kind="stable")
            self.known, self.where = known[order], np.concatenate((self.where, where))[order]
        at = self.where[np.searchsorted(self.known, keys)][back]
        ends = np.concatenate(([0], np.cumsum(at[:, 1])))
        take = np.repeat(at[:, 0] - ends[:-1], at[:, 1]) + np.arange(ends[-1])
        return self.store[take], ends[np.searchsorted(s, starts)]


class Decoder:
    def __init__(self, pieces: Pieces):
        shown = np.isin(pieces.kinds, (_NORMAL, _BYTE, _UNKNOWN))
        surface = [x if ok else b"" for x, ok in zip(pieces.surface, shown, strict=True)]
        surface[pieces.unknown] = " ⁇ ".encode()
        self.raw = np.frombuffer(b"".join(surface), np.uint8)
        self.size = np.array([len(x) for x in surface])
        self.begin = np.cumsum(self.size) - self.size
        self.dummy_prefix = pieces.dummy_prefix

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, document offsets) of the texts; the prefixed space goes."""
        size = self.size[ids]
        ends = np.concatenate(([0], np.cumsum(size)))
        buf = self.raw[np.repeat(self.begin[ids] - ends[:-1], size) + np.arange(ends[-1])]
        starts = ends[first]
        if self.dummy_prefix:
            full = np.flatnonzero(np.diff(starts) > 0)
            drop = starts[:-1][full]
            drop, full = drop[buf[drop] == 0x20], full[buf[drop] == 0x20]
            buf = np.delete(buf, drop)
            less = np.zeros(len(starts), dtype=np.int64)
            less[full + 1] = 1
            starts = starts - np.cumsum(less)
        return buf, starts


def _encode_batches(p: Pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(p), Decoder(p)
        for batch in batches:
            for lo, hi, buf, starts in tk.chunks(batch.column(1)):
                ids, first = encoder.encode(buf, starts)
                text, at = decoder.decode(ids, first)
                same = np.array(
                    [
                        np.array_equal(text[at[i] : at[i + 1]], buf[starts[i] : starts[i + 1]])
                        or text[at[i] : at[i + 1]].tobytes()
                        == buf[starts[i] : starts[i + 1]].tobytes().replace(_SIGN, b" ")
                        for i in range(hi - lo)
                    ],
                    dtype=bool,
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(np.diff(first)),
                        pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids)),
                        pa.array(np.diff(at)),
                        pa.array(same),
                    ],
                    names=["doc_id", "n_tokens", "token_ids", "n_bytes", "round_trip"],
                )

    return run


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, token_ids, n_bytes and round_trip (the ids decode to the text) of every row."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        tk.frugal(_encode_batches(Pieces.load(model))),
        "doc_id long, n_tokens long, token_ids array<int>, n_bytes long, round_trip boolean",
    )


def _decode_batches(p: Pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(p)
        for batch in batches:
            lists = batch.column(1)
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            first = np.concatenate(([0], np.cumsum(sizes)))
            buf, at = decoder.decode(lists.flatten().to_numpy(zero_copy_only=False), first)
            texts = [buf[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decode(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of rows with token_ids."""
    return tokens.select("doc_id", "token_ids").mapInArrow(
        tk.frugal(_decode_batches(Pieces.load(model))), "doc_id long, text string"
    )
