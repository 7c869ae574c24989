"""Alignment of two tokenizers' tokens, with corpus-wide counts of the id pairs that end together.

A text is encoded by A (a byte-level BPE, with a space before the text) and by B
(a SentencePiece model, which adds that space).  Byte offsets where a token of A
and one of B end cut both sequences into groups; the tokens that end there are
linked.  Counts of linked id pairs are kept in dense vectors indexed by a minimal
perfect hash of the distinct pairs:

1. First pass: documents are aligned; each task reports its pairs with counts.
2. The distinct pairs are dealt into slices of bounded size.  Each slice gets a
   minimal perfect hash (bit arrays by level: a key is placed at the first level
   where it stands alone, its index is the rank of its bit) and its keys in that
   order, so that every lookup is verified.
3. Leaves of a tree turn reported pairs into count vectors of their slice; nodes
   of ``fan`` add vectors until one per slice is left.
4. Second pass: documents are aligned again and look up the counts of their pairs.
   Slices are sent to the tasks with the code, up to ``load_keys`` keys; if there
   are more, the documents are passed once per load and sums are carried along.

Tokenizers work on units: texts are cut before a single space between characters
that are not white space.  Neither tokenizer has a token across such a place, so
units are encoded on their own, and a task encodes a distinct unit once while it
remembers it (``remember``).

Defined results: null and empty texts, and texts whose tokens' bytes differ from
space and text (U+2581 in a text), have no tokens: zeros and ''; rows with one
doc_id or none are rows of their own, and repeated rows count repeatedly; texts of
any length are aligned whole; an empty table gives an empty result; strings of
special tokens are plain text; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import textkit as tk
from quire.llm.common import written

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


@dataclass(frozen=True)
class AlignParams:
    a_file: str = A_FILE
    b_file: str = B_FILE
    #: pairs of a slice: the largest hash or vector that a task builds
    slice_keys: int = 1 << 18
    #: pairs whose counts are sent to the tasks at a time
    load_keys: int = 1 << 20
    #: vectors that a node of the tree adds, and tasks' reports in a leaf
    fan: int = 8
    #: distinct units, and bytes of them, that a task remembers
    remember: int = 800_000
    remember_bytes: int = 64 << 20


# -- tokenizers --------------------------------------------------------------------


def _byte_of_sign() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for U+0100 and on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


#: the split of byte-level BPE into words (fixed value)
_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: ASCII and Latin letters, and no character four times in a row
_USUAL = re.compile("(?!.*(.)\\1{3})[\n\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\u024f]+", re.DOTALL).fullmatch


def _ranked(model: dict, surface: list[bytes]):
    """The merges as ranks of their results; None where the ids do not rise with the merges."""
    import tiktoken

    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in pairs]
    if made != sorted(set(made)) or made[0] <= max(i for i, x in enumerate(surface) if len(x) == 1):
        return None
    ranks = {surface[i]: i for i in [*made, *(i for i, x in enumerate(surface) if len(x) == 1)]}
    return tiktoken.Encoding("a", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})


def _flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(x) for x in parts], dtype=np.int64)
    return np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum(size) - size, size


class Tokenizers:
    """Both tokenizers, from the contents of their files, and the bytes of their tokens."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        signs = _byte_of_sign()
        surface: list[bytes] = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            surface[i] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode()
        self.a_bytes = _flat(surface)
        self.a_ranks = _ranked(json.loads(a_json)["model"], surface)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(" " in p.replace("▁", " ").lstrip(" ") for p in pieces):
            raise ValueError("a piece goes on into a space after a word")
        self.b_bytes = _flat(
            [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        )

    def encode_a(self, units: list[str], size: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in order, and each unit's number of them; ``plain``: may be encoded joined.

        Units of letters that every version of the character tables knows go
        through the merges by rank, which is several times faster than the
        tokenizer's own encoding and gives the same ids; the others go through that.
        """
        if self.a_ranks is not None:
            plain = plain & np.fromiter((_USUAL(u) is not None for u in units), dtype=bool, count=len(units))
        order = np.argsort(~plain, kind="stable")
        n_plain = int(plain.sum())
        joined = ["".join([units[i] for i in order[k : min(k + 512, n_plain)].tolist()]) for k in range(0, n_plain, 512)]
        alone = [units[i] for i in order[n_plain:].tolist()]
        own = lambda texts: (
            e.ids for k in range(0, len(texts), 64) for e in self.a.encode_batch(texts[k : k + 64], add_special_tokens=False)
        )
        by_rank = map(self.a_ranks.encode_ordinary, joined) if self.a_ranks is not None else own(joined)
        ids = np.fromiter(itertools.chain.from_iterable(itertools.chain(by_rank, own(alone))), dtype=np.int32)
        # tokens end where units end: the byte lengths tell whose they are
        ends = np.cumsum(self.a_bytes[2][ids])
        upto = np.searchsorted(ends, np.cumsum(size[order]), side="right")
        counts = np.diff(np.concatenate(([0], upto)))
        back = np.empty(len(units), dtype=np.int64)
        back[order] = np.arange(len(units))
        return _gather(ids, (upto - counts)[back], counts[back]), counts[back]

    def encode_b(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same by B, which adds the space that every unit begins with."""
        out = self.b.encode([u[1:] for u in units], num_threads=1)
        counts = np.fromiter(map(len, out), dtype=np.int64, count=len(out))
        return np.fromiter(itertools.chain.from_iterable(out), dtype=np.int32, count=int(counts.sum())), counts


@lru_cache(maxsize=1)
def _tokenizers(a_json: str, b_model: bytes) -> Tokenizers:
    return Tokenizers(a_json, b_model)


def _gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The concatenation of ``values[start : start + size]`` of all spans."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(start, size) + np.arange(total) - np.repeat(ends - size, size)]


# -- alignment of units ------------------------------------------------------------


@dataclass
class Aligned:
    """Units in a row: numbers of tokens, links (keys, by unit) and, where asked for, their groups as text."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_links: np.ndarray
    links: np.ndarray
    text: list[bytes]


@lru_cache(maxsize=1)
def _digit_table(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal digits of 0..n-1."""
    return _flat([b"%d" % i for i in range(n)])


def align(t: Tokenizers, units: list[bytes], plain: np.ndarray, spell: bool) -> Aligned:
    """Groups and links of units (each begins with a space)."""
    texts = [u.decode() for u in units]
    buf, _, size = _flat(units)
    a, n_a = t.encode_a(texts, size, plain)
    b, n_b = t.encode_b(texts)
    good = np.ones(len(units), dtype=bool)
    for ids, n, table in ((a, n_a, t.a_bytes), (b, n_b, t.b_bytes)):
        own = np.repeat(np.arange(len(units)), n)
        length = np.bincount(own, weights=table[2][ids], minlength=len(units)).astype(np.int64)
        good &= length == size
        # bytes are compared where the lengths fit
        fits = good[own]
        inside = np.cumsum(table[2][ids[fits]]) - table[2][ids[fits]]
        kept = np.flatnonzero(good)
        flat = _gather(buf, (np.cumsum(size) - size)[kept], size[kept])
        same = tk.equal_spans(flat, inside, table[0], table[1][ids[fits]], table[2][ids[fits]])
        good[own[fits][~same]] = False
    own_a, own_b = np.repeat(np.arange(len(units)), n_a), np.repeat(np.arange(len(units)), n_b)
    a, own_a, b, own_b = a[good[own_a]], own_a[good[own_a]], b[good[own_b]], own_b[good[own_b]]
    n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
    end_a, end_b = np.cumsum(t.a_bytes[2][a]), np.cumsum(t.b_bytes[2][b])
    # both are ascending: no token is empty
    _, at_a, at_b = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
    links = (a[at_a].astype(np.int64) << 32) | b[at_b]
    n_links = np.bincount(own_a[at_a], minlength=len(units))
    text = _spell(a, b, at_a, at_b, n_links) if spell else []
    return Aligned(good, n_a, n_b, n_links, links, text)


def _spell(a, b, at_a, at_b, n_links) -> list[bytes]:
    """Each unit's groups as ``a1,a2|b1;a3|b2,b3``."""
    group_a = np.searchsorted(at_a, np.arange(len(a)))
    group_b = np.searchsorted(at_b, np.arange(len(b)))
    order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
    ids = np.concatenate((a, b))[order]
    sign = np.full(len(ids), ord(","), dtype=np.uint8)
    # the last token of A and of B in each group
    size = np.stack((np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)), axis=1).reshape(-1)
    last = np.cumsum(size) - 1
    sign[last[0::2]], sign[last[1::2]] = ord("|"), ord(";")
    digits, start, length = _digit_table(int(max(a.max(initial=0), b.max(initial=0))) // 65536 * 65536 + 65536)
    n = length[ids] + 1
    ends = np.cumsum(n)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    body = np.ones(len(out), dtype=bool)
    body[ends - 1] = False
    out[body] = _gather(digits, start[ids], length[ids])
    out[~body] = sign
    # where each unit's last group ends
    upto = np.concatenate(([0], ends[last[1::2]]))[np.cumsum(n_links)]
    raw, begin = out.tobytes(), np.concatenate(([0], upto[:-1]))
    return [raw[s : e - 1] if e > s else b"" for s, e in zip(begin.tolist(), upto.tolist(), strict=True)]


_UNSAFE_LEAD = np.zeros(256, dtype=bool)
#: white space and other controls; characters that begin so may be white space beyond ASCII
_UNSAFE_LEAD[[*range(0x21), 0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = True


def unit_starts(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units begin (document starts and cuts), and for every byte whether it cannot be white space."""
    lead = (buf & 0xC0) != 0x80
    char = np.cumsum(lead) - 1
    safe = ~_UNSAFE_LEAD[buf[lead]][char]
    cut = np.zeros(len(buf), dtype=bool)
    cut[1:-1] = (buf[1:-1] == 0x20) & safe[:-2] & safe[2:]
    cut[starts] = True
    return np.flatnonzero(cut), safe


class Store:
    """Units that a task has aligned: their numbers by index."""

    def __init__(self, t: Tokenizers, p: AlignParams, spell: bool):
        self.t, self.p, self.spell = t, p, spell
        self.clear()

    def clear(self) -> None:
        self.at: dict[bytes, int] = {}
        self.bytes = 0
        self.parts: list[Aligned] = []
        self.text: list[bytes] = []

    @property
    def full(self) -> bool:
        return len(self.at) > self.p.remember or self.bytes > self.p.remember_bytes

    def columns(self) -> Aligned:
        if len(self.parts) > 1:
            join = lambda k: np.concatenate([getattr(x, k) for x in self.parts])
            self.parts = [Aligned(*(join(k) for k in ("good", "n_a", "n_b", "n_links", "links")), [])]
        return self.parts[0]

    def index(self, units: list[bytes], plain: np.ndarray) -> np.ndarray:
        """Index of each unit (distinct ones), aligning those that are new."""
        out = np.array([self.at.get(u, -1) for u in units], dtype=np.int64)
        new = np.flatnonzero(out < 0)
        if len(new):
            fresh = [units[i] for i in new]
            x = align(self.t, fresh, plain[new], self.spell)
            out[new] = len(self.at) + np.arange(len(new))
            self.at.update(zip(fresh, out[new].tolist(), strict=True))
            self.bytes += sum(map(len, fresh)) + sum(map(len, x.text))
            self.text += x.text
            x.text = []
            self.parts.append(x)
        return out


def _chunk_units(raw: np.ndarray, off: np.ndarray):
    """Distinct units of a chunk: (bytes of each, plain, which unit stands where, first unit of each document)."""
    some = off[1:] > off[:-1]
    buf = np.insert(raw, off[:-1][some], 0x20)
    shift = np.concatenate(([0], np.cumsum(some)))
    begin = off + shift
    if not len(buf):
        return [], np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    s, safe = unit_starts(buf, begin[:-1][some])
    e = np.append(s[1:], len(buf))
    first = np.searchsorted(s, begin)
    h = tk.span_hash(tk.prefix_hash(buf), s, e)
    _, at, which = np.unique(h, return_index=True, return_inverse=True)
    if not tk.equal_spans(buf, s, buf, s[at[which]], np.minimum(e - s, (e - s)[at[which]])).all() or (
        (e - s) != (e - s)[at[which]]
    ).any():  # units of one hash: told apart by their bytes
        data = buf.tobytes()
        seen: dict[bytes, int] = {}
        which = np.array([seen.setdefault(data[x:y], len(seen)) for x, y in zip(s.tolist(), e.tolist(), strict=True)])
        at = np.unique(which, return_index=True)[1]
    data = buf.tobytes()
    units = [data[x:y] for x, y in zip(s[at].tolist(), e[at].tolist(), strict=True)]
    # a unit that begins with one space and ends with a character can stand among others
    second = np.minimum(s[at] + 1, len(buf) - 1)
    plain = (e[at] - s[at] > 1) & safe[second] & safe[e[at] - 1]
    return units, plain, which, first


# -- first pass: pairs -------------------------------------------------------------


def _key_hash(keys: np.ndarray) -> np.ndarray:
    return tk.mix(keys.astype(np.uint64) + tk.U64(0x9E3779B97F4A7C15))


def _report_pairs(files: tuple[str, bytes], p: AlignParams):
    """Pairs and counts of a task: pair, slice hash, part, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(_tokenizers(*files), p, spell=False)
        times = np.zeros(0, dtype=np.int64)
        part = TaskContext.get().partitionId()

        def pairs() -> pa.RecordBatch:
            x = store.columns()
            keys, which = np.unique(x.links, return_inverse=True)
            n = np.bincount(which, weights=np.repeat(times, x.n_links), minlength=len(keys)).astype(np.int64)
            keys, n = keys[n > 0], n[n > 0]
            return pa.record_batch(
                [pa.array(keys), pa.array(_key_hash(keys).view(np.int64)), pa.array(np.full(len(keys), part, np.int32)), pa.array(n)],
                names=["pair", "h", "part", "n"],
            )

        for b in batches:
            for _, _, raw, off in tk.chunks(b.column(0)):
                units, plain, which, first = _chunk_units(raw, off)
                if not units:
                    continue
                at = store.index(units, plain)
                # a document with a unit that does not come back has no tokens
                bad = np.concatenate(([0], np.cumsum(~store.columns().good[at][which])))
                clean = bad[first[1:]] == bad[first[:-1]]
                counted = np.repeat(clean, np.diff(first))
                times = np.concatenate((times, np.zeros(len(store.at) - len(times), np.int64)))
                times[at] += np.bincount(which[counted], minlength=len(units))
                if store.full:
                    yield pairs()
                    store.clear()
                    times = times[:0]
        if store.parts:
            yield pairs()

    return run


# -- minimal perfect hash ----------------------------------------------------------


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: bit arrays by level, index by rank."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        left, sizes, levels = keys, [], []
        while len(left):
            if len(sizes) == 64:
                raise ValueError("keys are not distinct")
            m = 2 * len(left) + 1
            at = PerfectHash._place(left, len(sizes), m)
            alone = np.bincount(at, minlength=m) == 1
            sizes.append(m)
            levels.append(alone)
            left = left[~alone[at]]
        return PerfectHash(np.array(sizes, dtype=np.int64), np.concatenate([np.zeros(0, bool), *levels]))

    @staticmethod
    def _place(keys: np.ndarray, level: int, m: int) -> np.ndarray:
        return (_key_hash(keys ^ np.int64(level * 0x5851F42D4C957F2D & 0x7FFFFFFFFFFFFFFF)) % tk.U64(m)).astype(np.int64)

    @cached_property
    def rank(self) -> np.ndarray:
        """Set bits before each multiple of 64 bits."""
        full = np.concatenate((self.bits, np.zeros(-len(self.bits) % 64, bool))).reshape(-1, 64).sum(axis=1)
        return np.concatenate(([0], np.cumsum(full)))[:-1]

    def index(self, keys: np.ndarray) -> np.ndarray:
        """0..n-1 for the keys it was built of; others get any index or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        start = 0
        for level, m in enumerate(self.sizes.tolist()):
            at = start + self._place(keys[open_], level, m)
            hit = self.bits[at]
            pos = at[hit]
            block = pos // 64 * 64
            inside = np.arange(64) < (pos - block)[:, None]
            wide = self.bits[np.minimum(block[:, None] + np.arange(64), len(self.bits) - 1)]
            out[open_[hit]] = self.rank[pos // 64] + (wide & inside).sum(axis=1)
            open_ = open_[~hit]
            start += m
            if not len(open_):
                break
        return out

    def dump(self) -> dict[str, bytes]:
        return {"sizes": self.sizes.tobytes(), "bits": np.packbits(self.bits).tobytes()}

    @staticmethod
    def load(sizes: bytes, bits: bytes) -> PerfectHash:
        s = np.frombuffer(sizes, dtype=np.int64)
        return PerfectHash(s, np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=int(s.sum())).astype(bool))


def verified(h: PerfectHash, keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Index of each asked key; -1 where the key at its index is another."""
    if not len(keys):
        return np.full(len(asked), -1, dtype=np.int64)
    at = h.index(asked)
    return np.where((at >= 0) & (keys[np.maximum(at, 0)] == asked), at, -1)


SLICE = "slice int, sizes binary, bits binary, keys binary"


def _build_slice(group: pa.Table) -> pa.Table:
    keys = group["pair"].to_numpy()
    h = PerfectHash.build(keys)
    ordered = np.empty(len(keys), dtype=np.int64)
    ordered[h.index(keys)] = keys
    return pa.table(
        {"slice": pa.array([group["slice"][0].as_py()], pa.int32())}
        | {k: pa.array([v], pa.binary()) for k, v in h.dump().items()}
        | {"keys": pa.array([ordered.tobytes()], pa.binary())}
    )


VECTOR = "slice int, node int, vector binary"


def _vector_row(slice_: int, node: int, v: np.ndarray) -> pa.Table:
    return pa.table(
        {"slice": pa.array([slice_], pa.int32()), "node": pa.array([node], pa.int32()), "vector": pa.array([v.tobytes()], pa.binary())}
    )


def _leaf(reported: pa.Table, hashed: pa.Table) -> pa.Table:
    """The dense count vector of some tasks' reports."""
    if not reported.num_rows:
        return _vector_row(0, 0, np.zeros(0, np.int64)).slice(0, 0)
    x = hashed.to_pylist()[0]
    keys = np.frombuffer(x["keys"], dtype=np.int64)
    at = verified(PerfectHash.load(x["sizes"], x["bits"]), keys, reported["pair"].to_numpy())
    if (at < 0).any():
        raise ValueError("a pair is missing in its slice")
    v = np.zeros(len(keys), dtype=np.int64)
    np.add.at(v, at, reported["n"].to_numpy())
    return _vector_row(x["slice"], reported["node"][0].as_py(), v)


def _add_vectors(fan: int):
    def node(group: pa.Table) -> pa.Table:
        total = None
        for b in group["vector"]:
            v = np.frombuffer(b.as_buffer(), dtype=np.int64)
            total = v.copy() if total is None else np.add(total, v, out=total)
        return _vector_row(group["slice"][0].as_py(), group["node"][0].as_py(), total)

    return node


def pair_counts(docs: DataFrame, p: AlignParams = AlignParams()) -> DataFrame:
    """One row per slice of the distinct pairs: its hash, keys, and their counts (``SLICE`` and vector)."""
    reported = written(
        docs.select(F.col("text").cast("string")).mapInArrow(
            tk.frugal(_report_pairs(_files(p), p)), "pair long, h long, part int, n long"
        ),
        "pair-reports",
    )
    distinct = written(reported.select("pair", "h").distinct(), "distinct-pairs")
    n_pairs, parts = distinct.count(), (reported.agg(F.max("part")).first()[0] or 0) + 1
    slices = max(1, -(-n_pairs // p.slice_keys))
    slice_ = F.pmod("h", F.lit(slices)).cast("int").alias("slice")
    hashed = written(
        distinct.select("pair", slice_).groupBy("slice").applyInArrow(tk.frugal_group(_build_slice), SLICE), "pair-hash"
    )
    nodes = -(-parts // p.fan)
    leaves = reported.select("pair", "n", slice_, (F.col("part") / p.fan).cast("int").alias("node"))
    copies = hashed.select("*", F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))).alias("node"))
    vectors = (
        leaves.groupBy("slice", "node")
        .cogroup(copies.groupBy("slice", "node"))
        .applyInArrow(tk.frugal_groups(_leaf), VECTOR)
    )
    while nodes > 1:
        nodes = -(-nodes // p.fan)
        up = vectors.select("slice", (F.col("node") / p.fan).cast("int").alias("node"), "vector")
        vectors = up.groupBy("slice", "node").applyInArrow(tk.frugal_group(_add_vectors(p.fan)), VECTOR)
    return written(hashed.join(vectors.drop("node"), "slice"), "pair-counts")


def _largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The largest count of each id of B in a slice."""
    for batch in batches:
        for x in batch.to_pylist():
            b = np.frombuffer(x["keys"], dtype=np.int64) & 0xFFFFFFFF
            n = np.frombuffer(x["vector"], dtype=np.int64)
            order = np.lexsort((n, b))
            last = np.flatnonzero(np.append(b[order][1:] != b[order][:-1], True)) if len(b) else order
            yield pa.record_batch([pa.array(b[order][last]), pa.array(n[order][last])], names=["b", "n"])


def best_counts(counts: DataFrame, size: int) -> np.ndarray:
    """The largest count of every id of B: a vector of the vocabulary's size."""
    out = np.zeros(size, dtype=np.int64)
    for r in counts.select("keys", "vector").mapInArrow(_largest, "b long, n long").groupBy("b").agg(F.max("n")).collect():
        out[r[0]] = r[1]
    return out


# -- second pass -------------------------------------------------------------------


class Load:
    """Some slices' hashes, keys and counts."""

    def __init__(self, rows: list[dict], slices: int):
        self.slices = slices
        self.rows = {
            r["slice"]: (
                PerfectHash.load(r["sizes"], r["bits"]),
                np.frombuffer(r["keys"], dtype=np.int64),
                np.frombuffer(r["vector"], dtype=np.int64),
            )
            for r in rows
        }

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Count of each key; -1 where its slice is in another load."""
        distinct, which = np.unique(keys, return_inverse=True)
        own = np.mod(_key_hash(distinct).view(np.int64), self.slices)
        out = np.full(len(distinct), -1, dtype=np.int64)
        for s, (h, known, n) in self.rows.items():
            mine = np.flatnonzero(own == s)
            at = verified(h, known, distinct[mine])
            # a pair that is not counted stands only in documents without tokens
            out[mine] = np.where(at >= 0, n[at], 0) if len(n) else 0
        return out[which]


def _score(files: tuple[str, bytes], p: AlignParams, load_rows: list[dict], slices: int, best: np.ndarray, last: bool):
    """Aligned documents with the counts of one load, added to what earlier loads gave.

    Batches hold doc_id, text and, after the first load, the other columns of
    ``RESULT``; all but the last load hand the text on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = Load(load_rows, slices)
        store, sums = None, []
        for b in batches:
            again = b.num_columns > 2
            if store is None:
                store = Store(_tokenizers(*files), p, spell=not again)
            for lo, hi, raw, off in tk.chunks(b.column(1)):
                units, plain, which, first = _chunk_units(raw, off)
                if not store.at:
                    sums = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
                seen = len(store.at)
                at = store.index(units, plain)
                if len(store.at) > seen:
                    more = _unit_sums(store.parts[-1], load, best)
                    sums = [np.concatenate(x) for x in zip(sums, more, strict=True)]
                rows = b.slice(lo, hi - lo)
                columns = _later(rows, *_counted(store, sums, at, which, first)[4:]) if again else _first(
                    rows, store, at, which, first, sums
                )
                names = [c.strip().split(" ")[0] for c in RESULT.split(",")]
                columns = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
                yield pa.record_batch(
                    columns if last else [columns[0], rows.column(1), *columns[1:]],
                    names=names if last else [names[0], "text", *names[1:]],
                )
                if store.full:
                    store.clear()

    return run


def _unit_sums(x: Aligned, load: Load, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with their id's best count, and sums of counts, of each unit."""
    n = load.counts(x.links)
    owner = np.repeat(np.arange(len(x.good)), x.n_links)
    out = np.zeros((2, len(x.good)), dtype=np.int64)
    np.add.at(out[0], owner, (n >= 0) & (n == best[x.links & 0xFFFFFFFF]))
    np.add.at(out[1], owner, np.maximum(n, 0))
    return out[0], out[1]


def _counted(store: Store, sums: list, at, which, first):
    """Per document: whether it has tokens, n_a, n_b, n_links, n_best, count_sum."""
    n = len(first) - 1
    if not len(at):
        zero = np.zeros(n, dtype=np.int64)
        return zero > 0, zero, zero, zero, zero, zero
    x, unit = store.columns(), at[which]
    per = lambda v: np.diff(np.concatenate(([0], np.cumsum(v[unit])))[first])
    clean = (per(~x.good) == 0) & (np.diff(first) > 0)
    return clean, *(np.where(clean, per(v), 0) for v in (x.n_a, x.n_b, x.n_links, *sums))


def _first(rows, store, at, which, first, sums) -> list:
    clean, n_a, n_b, n_links, n_best, count = _counted(store, sums, at, which, first)
    digest = [""] * len(clean)
    for d in np.flatnonzero(clean).tolist():
        spelled = b";".join([store.text[k] for k in at[which[first[d] : first[d + 1]]].tolist()])
        digest[d] = hashlib.sha256(spelled).hexdigest()
    # each group ends with one link
    return [rows.column(0), n_a, n_b, n_links, n_links, n_best, count, digest]


def _later(rows: pa.RecordBatch, n_best: np.ndarray, count: np.ndarray) -> list:
    add = {"n_best": n_best, "count_sum": count}
    own = {c: rows.column(k) for k, c in enumerate(rows.schema.names) if c != "text"}
    return [v.to_numpy() + add[c] if c in add else v for c, v in own.items()]


@lru_cache(maxsize=2)
def _read_files(a_file: str, b_file: str) -> tuple[str, bytes]:
    with open(a_file) as f:
        a = f.read()
    with open(b_file, "rb") as f:
        return a, f.read()


def _files(p: AlignParams) -> tuple[str, bytes]:
    """Contents of the tokenizers' files, read by the driver and sent with the code."""
    return _read_files(p.a_file, p.b_file)


def score_alignment(docs: DataFrame, p: AlignParams = AlignParams()) -> DataFrame:
    """Tokens, groups, links and the counts of the linked pairs of every document (``RESULT``)."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = pair_counts(texts, p)
    size = _tokenizers(*_files(p)).b.get_piece_size()
    best = best_counts(counts, size)
    sizes = {r[0]: r[1] for r in counts.select("slice", F.length("keys") / 8).collect()}
    # slices are numbered by the same modulus everywhere, empty ones too
    slices = max(1, -(-int(sum(sizes.values())) // p.slice_keys))
    loads: list[list[int]] = [[]]
    for s in sorted(sizes):
        if loads[-1] and sum(sizes[x] for x in loads[-1]) + sizes[s] > p.load_keys:
            loads.append([])
        loads[-1].append(s)
    work = texts
    for k, own in enumerate(loads):
        rows = [
            {c: bytes(v) if isinstance(v, bytearray) else v for c, v in r.asDict().items()}
            for r in (counts.filter(F.col("slice").isin(own)).collect() if own else [])
        ]
        last = k == len(loads) - 1
        step = tk.frugal(_score(_files(p), p, rows, slices, best, last))
        work = work.mapInArrow(step, RESULT if last else RESULT.replace("doc_id long", "doc_id long, text string"))
        if not last:
            work = written(work, f"aligned-{k}")
    return work
