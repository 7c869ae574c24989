import collections
import hashlib
import random

import numpy as np
import pytest

from quire.llm import token_alignment as t
from quire.llm.common import read_table
from tests.conftest import SF_SMALL
from tests.llm.common import documents, messy_rows

FILES = t._files(t.AlignParams())
SMALL = t.AlignParams(slice_keys=50, load_keys=120, fan=2, remember=40)


def brute(texts):
    """The result of each text by whole-text encoding and the definitions."""
    tools = t.Tokenizers(*FILES)
    token = lambda table, i: bytes(table[0][table[1][i] : table[1][i] + table[2][i]])
    groups, counts = [], collections.Counter()
    for text in texts:
        out = []
        if text:
            a = tools.a.encode(" " + text, add_special_tokens=False).ids
            b = tools.b.encode(text)
            raw = (" " + text).encode()
            if raw == b"".join(token(tools.a_bytes, i) for i in a) == b"".join(token(tools.b_bytes, i) for i in b):
                ends_a, ends_b = np.cumsum(tools.a_bytes[2][a]), np.cumsum(tools.b_bytes[2][b])
                ia = ib = 0
                for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
                    ja, jb = ends_a.tolist().index(end) + 1, ends_b.tolist().index(end) + 1
                    out.append((a[ia:ja], b[ib:jb]))
                    ia, ib = ja, jb
                counts.update((x[-1], y[-1]) for x, y in out)
        groups.append(out)
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    rows = []
    for out in groups:
        links = [(x[-1], y[-1]) for x, y in out]
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in out)
        rows.append((
            sum(len(x) for x, _ in out), sum(len(y) for _, y in out), len(out), len(links),
            sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links),
            hashlib.sha256(spelled.encode()).hexdigest() if out else "",
        ))
    return rows


def table(spark, rows, p=t.AlignParams()):
    return sorted((tuple(r) for r in t.score_alignment(documents(spark, rows, clash=True), p).collect()), key=repr)


def nasty(rng):
    parts = ["a", "le", " ", "  ", "\n", "\t", " x", "é", "ç ", " ", "　", " ", "漢字", "😀", "don't", "12", ".",
             "<|endoftext|>", "<s>", "<0x41>", "\x00", "\u0085", " \n", "The", " the", " ", "​"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))


@pytest.mark.parametrize("p", [t.AlignParams(), SMALL])
def test_equals_brute_force(spark, p):
    rng = random.Random(4)
    rows = [r for r in messy_rows() if len(r[1] or "") < 100_000]
    rows += [(1000 + k, nasty(rng), "n") for k in range(300)]
    rows += [(2000, "an own ▁ sign", "n"), (2001, " ", "n"), (2002, "▁", "n"), (2003, "x" * 3000, "n"), (2003, None, "n")]
    want = [(r[0], *w) for r, w in zip(rows, brute([r[1] for r in rows]), strict=True)]
    assert table(spark, rows, p) == sorted(want, key=repr)


def test_very_long_text(spark):
    rows = [(1, "one long text of many words " * 60_000, "a"), (2, "long words", "a")]
    want = [(r[0], *w) for r, w in zip(rows, brute_long([r[1] for r in rows]), strict=True)]
    assert table(spark, rows) == sorted(want, key=repr)


def brute_long(texts):
    """As ``brute``, with whole-text sets instead of searches."""
    tools = t.Tokenizers(*FILES)
    all_links, counts = [], collections.Counter()
    for text in texts:
        a = np.array(tools.a.encode(" " + text, add_special_tokens=False).ids)
        b = np.array(tools.b.encode(text))
        ends_a, ends_b = np.cumsum(tools.a_bytes[2][a]), np.cumsum(tools.b_bytes[2][b])
        _, ia, ib = np.intersect1d(ends_a, ends_b, return_indices=True)
        links = list(zip(a[ia].tolist(), b[ib].tolist(), strict=True))
        x = np.split(a, ia + 1)[:-1]
        y = np.split(b, ib + 1)[:-1]
        spelled = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in zip(x, y, strict=True))
        counts.update(links)
        all_links.append((len(a), len(b), links, hashlib.sha256(spelled.encode()).hexdigest()))
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (n_a, n_b, len(k), len(k), sum(counts[x] == best[x[1]] for x in k), sum(counts[x] for x in k), h)
        for n_a, n_b, k, h in all_links
    ]


def test_whole_table(spark):
    """Every document of the small table, encoded whole by both libraries."""
    docs = read_table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(i, *w) for (i, _), w in zip(rows, brute_long_or_none([x for _, x in rows]), strict=True)]
    assert sorted(tuple(r) for r in t.score_alignment(docs).collect()) == sorted(want)


def brute_long_or_none(texts):
    full = [x for x in texts if x]
    done = iter(brute_long(full))
    return [next(done) if x else (0, 0, 0, 0, 0, 0, "") for x in texts]


def test_empty_table(spark):
    assert t.score_alignment(documents(spark, [])).collect() == []


def test_perfect_hash():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(-(1 << 62), 1 << 62, 20_000))
    h = t.PerfectHash.build(keys)
    at = h.index(keys)
    assert sorted(at.tolist()) == list(range(len(keys)))
    ordered = np.empty_like(keys)
    ordered[at] = keys
    back = t.PerfectHash.load(**h.dump())
    assert (t.verified(back, ordered, keys) == at).all()
    others = np.setdiff1d(rng.integers(-(1 << 62), 1 << 62, 5_000), keys)
    assert (t.verified(back, ordered, others) == -1).all()
    assert len(t.PerfectHash.build(keys[:0]).index(keys[:0])) == 0
    with pytest.raises(ValueError):
        t.PerfectHash.build(np.array([5, 5, 7]))
