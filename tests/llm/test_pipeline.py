"""The stages of the corpus pipeline, each on what its predecessor kept."""

import collections

import pytest
import sentencepiece

import corpus_pipeline as c
from quire.llm import sentence_pieces, source_mix
from tests.llm.common import WORD, documents, messy_rows
from tests.llm.test_minhash_dedup import brute as components
from tests.llm.test_quality_rules import verdicts
from tests.llm.test_suffix_dedup import brute as repeats

ROWS = [r for r in messy_rows() if r[0] != 9]  # the long text is in the operators' own tests


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = documents(spark, ROWS, clash=True), []
    for name, stage in c.STAGES:
        before = docs
        docs = stage(spark, docs, "").cache()
        out.append((name, before, docs))
    return out


def rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_columns_and_names(stages):
    assert [n for n, _, _ in stages] == [n for n, _ in c.STAGES]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns


def test_quality(stages):
    _, before, after = stages[0]
    from quire.llm.quality_rules import RULES

    kept = collections.Counter(v[0] for v in verdicts(rows(before), RULES) if v[-1])
    assert collections.Counter(r.doc_id for r in after.collect()) == kept


def test_lines_of_a_large_host_are_removed(spark):
    """Ten documents of a host share a line, whatever the host's size."""
    shared = "subscribe to our daily letter now"
    own = lambda k: " ".join(f"own{k}x{j}" for j in range(25))
    for size in (100, 2_500):
        docs = documents(spark, [(k, own(k) + ("\n" + shared) * (k < 10), "h") for k in range(size)])
        out = c.quality(spark, docs, "")
        assert out.count() == size
        assert [r.doc_id for r in out.filter(out.text.contains(shared)).collect()] == [0]


def test_near_duplicates(stages):
    _, before, after = stages[1]
    want = {i for i, _, _, kept in components(rows(before), 80) if kept and i is not None}
    got = [r.doc_id for r in after.collect() if r.doc_id is not None]
    assert sorted(got) == sorted(want)


def test_texts_of_a_shared_id_are_kept(spark):
    """a stands under 1 and 5; b, under 5 and 7, is a near duplicate of nothing that is kept."""
    a, b, other = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    docs = [(1, a, "s"), (5, a, "s"), (5, b, "s"), (7, b, "s"), (9, other, "s"), (9, other, "s"), (None, a, "s")]
    out = c.near_dedup(spark, documents(spark, docs, clash=True), "")
    assert sorted(rows(out), key=str) == sorted([(1, a, "s"), (5, b, "s"), (9, other, "s"), (None, a, "s")], key=str)


def test_repeated_passages(stages):
    _, before, after = stages[2]
    lost = {i: n for i, _, n, _, _ in repeats(rows(before))}
    size = {r[0]: len((r[1] or "").encode()) for r in rows(before)}
    for i, text, _ in rows(after):
        if i is not None and text.isascii():
            assert len(text) == size[i] - lost[i]


def test_mix_and_tokens(stages):
    _, before, after = stages[3]
    taken = {r.doc_id: r.taken for r in source_mix.mix(before).collect() if r.taken}
    assert {i: len(WORD.findall(t)) for i, t, _ in rows(after)} == taken
    lib = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)
    texts = {i: t for i, t, _ in rows(after)}
    out = stages[4][2].collect()
    assert len(out) == len(texts) and all(list(r.token_ids) == lib.encode(texts[r.doc_id]) for r in out)


def through(spark, docs):
    for _, stage in c.STAGES:
        docs = stage(spark, docs, "")
    return docs


def test_empty_table(spark):
    docs = documents(spark, [], clash=True)
    for _, stage in c.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.collect() == []
        docs = out
    assert through(spark, documents(spark, [])).collect() == []


def test_very_long_text_goes_through_whole(spark):
    """Two long texts of distinct words and short ones: every stage keeps all words, the mix takes whole blocks."""
    long = {i: " ".join(f"{i}x{k}" for k in range(60_000)) for i in (1, 2)}
    rows_ = [(i, t, "a") for i, t in long.items()] + [(10 + k, " ".join(f"s{k}y{j}" for j in range(40)), "b") for k in range(5)]
    docs = documents(spark, rows_, clash=True)
    for stage in (c.quality, c.near_dedup, c.repeated_passages):
        docs = stage(spark, docs, "")
        assert {r.doc_id: r.text for r in docs.collect()} == {i: t for i, t, _ in rows_}
    taken = {r.doc_id: r.taken for r in source_mix.mix(docs).collect()}
    mixed = {r.doc_id: r.text for r in c.mixed_sources(spark, docs, "").collect()}
    assert {i: len(WORD.findall(t)) for i, t in mixed.items()} == {i: n for i, n in taken.items() if n}
    lib = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)
    out = through(spark, documents(spark, rows_)).collect()
    assert {r.doc_id: list(r.token_ids) for r in out} == {i: lib.encode(t) for i, t in mixed.items()}
