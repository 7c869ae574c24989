import hashlib
import random

import pytest

from quire.llm import suffix_dedup as s
from tests.llm.common import documents, messy_rows, sentence


def brute(rows, length=50):
    first = {}
    for i, t, _ in rows:
        b = (t or "").encode()
        if i is not None:
            for k in range(len(b) - length + 1):
                w = b[k : k + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t, _ in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        if i is not None:
            for k in range(len(b) - length + 1):
                if first[b[k : k + length]] < i:
                    gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows_with_passages():
    rng = random.Random(4)
    passages = [sentence(rng, n) for n in (12, 14, 20, 60)]
    rows = [(i, t, x) for i, t, x in messy_rows() if i != 9]
    for k in range(40):
        parts = []
        for _ in range(4):
            p = rng.choice(passages)
            cut = rng.randrange(0, 20)
            parts += [sentence(rng, rng.randrange(0, 12)), p[cut : len(p) - rng.randrange(0, 20)]]
        rows.append((200 + k, " ".join(parts), "p"))
    rows += [(300, "a" * 500, "p"), (301, "b" + "a" * 300, "p"), (302, "a" * 49, "p"), (303, "ab" * 200, "p")]
    rows += [(304, "ab" * 90 + "c", "p"), (2, passages[3], "p"), (1, passages[3], "p")]
    return rows


@pytest.mark.parametrize(
    "p",
    [
        s.RepeatParams(),
        s.RepeatParams(bucket_bytes=4000),
        s.RepeatParams(bucket_bytes=4000, spans_in_task=2),
        s.RepeatParams(length=30, gram=12, bucket_bytes=9000),
    ],
)
def test_equals_brute_force(spark, p):
    rows = rows_with_passages()
    got = [tuple(r) for r in s.remove_repeats(documents(spark, rows, clash=True), p).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, p.length), key=str)


def test_very_long_text(spark):
    rows = [(9, dict((i, t) for i, t, _ in messy_rows())[9], "a")]
    rows.append((10, "start " + rows[0][1][1000:1300] + " end", "a"))
    out = {r.doc_id: r.n_removed for r in s.remove_repeats(documents(spark, rows)).collect()}
    assert out[9] == 0 and 300 <= out[10] <= 304


def test_empty_table(spark):
    assert s.remove_repeats(documents(spark, [])).collect() == []
    assert s.drop_repeats(documents(spark, [])).collect() == []


def test_drop_returns_document_columns(spark):
    rows = rows_with_passages()
    docs = documents(spark, rows, clash=True)
    out = s.drop_repeats(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == len(rows)
    want = {}
    for (i, t, _), (_, _, _, _, sha) in zip(rows, brute(rows), strict=True):
        want.setdefault(i, set()).add(sha)
    for r in got:
        if r.text is not None and r.text.isascii():
            assert hashlib.sha256(r.text.encode()).hexdigest() in want[r.doc_id]


def test_text_is_shuffled_once(spark):
    plan = s.remove_repeats(documents(spark, messy_rows()))._jdf.queryExecution().toString()
    assert "Cartesian" not in plan
