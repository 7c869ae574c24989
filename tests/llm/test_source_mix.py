import collections

import pytest

from quire.llm import source_mix as m
from tests.llm.common import WORD, documents, messy_rows


def targets(sizes, weights=(5, 2, 1), percent=150, repeats=2):
    """Reshare step by step until no target is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, out, free = percent / 100 * sum(sizes.values()), {}, set(names)
    while free:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > repeats * sizes[s]]
        if not over:
            out |= {s: left * w[s] / total for s in free}
            break
        for s in over:
            out[s] = repeats * sizes[s]
            free.discard(s)
        left = percent / 100 * sum(sizes.values()) - sum(out.values())
    return out


def check(rows, got, p):
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = targets(dict(sizes))
    taken = collections.Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-12, abs=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= p.block_words


@pytest.mark.parametrize("p", [m.PARAMS, m.MixParams(block_words=8, shard_slots=16)])
def test_targets_and_taken_words(spark, p):
    rows = messy_rows()
    docs = documents(spark, rows, clash=True)
    first = m.mix(docs, p).collect()
    check(rows, first, p)
    again = m.mix(docs.repartition(7), p).collect()
    assert sorted(first, key=str) == sorted(again, key=str)


def mixed(spark, rows, p):
    t = m.source_targets(m.document_sizes(documents(spark, rows)), p)
    return {r.idx: r for r in t.collect()}, t


def test_slots_blocks_and_shards(spark):
    """Each source fills its slots once, a pass is a permutation of its blocks, shards hold their positions."""
    p = m.MixParams(block_words=8, shard_slots=64)
    want, t = mixed(spark, messy_rows(), p)
    out, shards = collections.defaultdict(list), collections.Counter()
    for r in m.slot_blocks(t, p).collect():
        out[r.idx].append((r.slot, r.block))
        shards[r.shard] += 1
    total = sum(r.slots for r in want.values())
    assert shards == {k: min(64, total - 64 * k) for k in range(-(-total // 64))}
    for i, r in want.items():
        assert sorted(x for x, _ in out[i]) == list(range(r.slots))
        for turn in range(2):
            got = [b for x, b in out[i] if x // r.blocks == turn]
            assert len(set(got)) == len(got) and all(0 <= b < r.blocks for b in got)
    big = max(want, key=lambda i: want[i].blocks)
    order = [b for _, b in sorted(out[big])[: want[big].blocks]]
    steps = {(y - x) % want[big].blocks for x, y in zip(order, order[1:])}
    assert len(steps) > len(order) // 3  # no fixed stride


@pytest.mark.parametrize("blocks", [1, 2, 3, 5, 16, 17, 100, 1601, 30_000])
def test_permutation_of_any_number_of_blocks(spark, blocks):
    t = spark.createDataFrame([(0, "a", 1, 1.0, blocks, 2 * blocks)], "idx int, source string, source_size long, target double, blocks long, slots long")
    got = {r.slot: r.block for r in m.slot_blocks(t).collect()}
    first, second = [got[k] for k in range(blocks)], [got[blocks + k] for k in range(blocks)]
    assert sorted(first) == sorted(second) == list(range(blocks))
    if blocks > 1000:
        assert first != second
        # neighbours are scattered, and the two passes are unlike each other
        steps = collections.Counter((y - x) % blocks for x, y in zip(first, first[1:]))
        assert max(steps.values()) < 20 and sum(x == y for x, y in zip(first, second)) < 20


def test_counts_of_shards_are_multinomial_draws(spark):
    """Chi-squared of the shards' counts against the shares is what it is for independent draws."""
    rows = [(k, " ".join(["w"] * 4000), s) for k, s in enumerate("abcaab")]
    p = m.MixParams(block_words=4, shard_slots=50)
    want, t = mixed(spark, rows, p)
    total = sum(r.slots for r in want.values())
    counts = m.shard_counts(t, p).collect()
    n = collections.Counter()
    for r in counts:
        n[r.shard, r.idx] += r.n
    full = total // 50
    chi = sum(
        (n[k, i] - 50 * r.slots / total) ** 2 / (50 * r.slots / total) for k in range(full) for i, r in want.items()
    )
    freedom = full * (len(want) - 1)
    assert abs(chi - freedom) < 5 * (2 * freedom) ** 0.5
    for i in want:  # slots are numbered through the shards
        runs = sorted((r.start, r.n, r.shard) for r in counts if r.idx == i)
        assert [x[2] for x in runs] == sorted(x[2] for x in runs)
        assert all(a[0] + a[1] == b[0] for a, b in zip(runs, runs[1:])) and runs[0][0] == 0


def test_another_seed_is_another_mix_of_the_same_totals(spark):
    rows = [r for r in messy_rows() if len(r[1] or "") < 100_000]
    out = []
    for seed in (7, 8):
        p = m.MixParams(block_words=8, shard_slots=16, seed=seed)
        _, t = mixed(spark, rows, p)
        blocks = sorted(tuple(r) for r in m.mixed_blocks(t, p).select("shard", "position", "idx", "block").collect())
        assert [x[1] for x in blocks if x[0] == 0] == list(range(16))
        check(rows, m.mix(documents(spark, rows), p).collect(), p)
        out.append(blocks)
    per_source = [collections.Counter(x[2] for x in blocks) for blocks in out]
    assert per_source[0] == per_source[1] and out[0] != out[1]
    assert [x[2] for x in out[0]] != [x[2] for x in out[1]]


def test_many_sources_and_null_ids(spark):
    rows = [(None, f"a b c {k}", f"s{k % 300}") for k in range(900)] + [(1, "one two three", None)]
    check(rows, m.mix(documents(spark, rows)).collect(), m.PARAMS)


def test_mixed_documents_hold_the_taken_words(spark):
    rows = messy_rows()
    docs = documents(spark, rows, clash=True)
    out = m.mixed_documents(docs)
    assert out.columns == docs.columns
    texts = collections.Counter((r.doc_id, r.source, len(WORD.findall(r.text))) for r in out.collect())
    want = collections.Counter((r.doc_id, r.source, r.taken) for r in m.mix(docs).collect() if r.taken)
    assert texts == want
    words = {}
    for i, t, s in rows:
        words.setdefault((i, s), set()).update(WORD.findall(t or ""))
    assert all(set(WORD.findall(r.text)) <= words[r.doc_id, r.source] for r in out.collect())


def test_empty_tables(spark):
    assert m.mix(documents(spark, [])).collect() == []
    got = m.mix(documents(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    assert m.mixed_documents(documents(spark, [(1, None, "a")])).collect() == []
