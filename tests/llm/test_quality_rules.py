import collections

import pytest

from quire.llm import quality_rules as q
from tests.llm.common import WORD, documents, messy_rows

RULES = q.QualityRules(min_line_docs=5)


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    runs = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
    }


def verdicts(rows, rules):
    key = lambda x: " ".join(WORD.findall(x)).lower()
    held = collections.defaultdict(set)
    for i, t, s in rows:
        for x in (t or "").split("\n"):
            if WORD.search(x):
                held[s, key(x)].add(i)
    hot = {}
    for (s, k), ids in held.items():
        n = len(ids - {None})
        if n >= rules.min_line_docs:
            hot[s, k] = min(ids - {None})
    out = []
    for i, t, s in rows:
        m = measures(t)
        lost = sum(
            len(WORD.findall(x))
            for x in (t or "").split("\n")
            if WORD.search(x) and (s, key(x)) in hot and hot[s, key(x)] != i
        )
        failed = m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]
        depleted = 100 * (m["n_words"] - lost) < rules.min_left_percent * m["n_words"]
        out.append((i, *m.values(), failed, m["n_words"] - lost, not failed and not depleted))
    return out


@pytest.mark.parametrize("rules", [RULES, q.QualityRules(min_line_docs=3, min_left_percent=60)])
def test_equals_brute_force(spark, rules):
    rows = messy_rows() + [(100 + k, "shared boiler plate line of words\n" * 2 + f"own {k} " * 9, "d") for k in range(8)]
    got = q.score_documents(documents(spark, rows, clash=True), rules)
    got = [
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.left_words, r.kept)
        for r in got.collect()
    ]
    key = lambda x: (x[0] is None, x)
    fix = lambda xs: sorted(((-1 if x[0] is None else x[0], *x[1:]) for x in xs), key=key)
    assert fix(got) == fix(verdicts(rows, rules))


@pytest.mark.parametrize("size", [3_000, 6_000])
def test_the_limit_does_not_follow_the_host(spark, size):
    """A line of 20 documents goes in a host of any size."""
    own = "\n".join(f"own line {k} of this document" for k in range(6))
    rows = [(k, own.replace("own", f"o{k}") + ("\nthe shared line" if k < 20 else ""), "h") for k in range(size)]
    gone = q.removed_lines(documents(spark, rows))
    assert sorted(r.doc_id for r in gone.collect()) == list(range(1, 20))


def test_rejects_depleted_but_keeps_the_first(spark):
    text = "\n".join(" ".join(f"w{k}{j}" for j in range(10)) for k in range(6))
    rows = [(k, text, "h") for k in range(10)] + [(50, " ".join(f"own{j}" for j in range(30)), "h")]
    out = {r.doc_id: r.kept for r in q.score_documents(documents(spark, rows), RULES).collect()}
    assert out[0] and out[50] and not any(out[k] for k in range(1, 10))


def test_apply_returns_document_columns(spark):
    docs = documents(spark, messy_rows(), clash=True)
    out = q.apply_rules(docs, RULES)
    assert out.columns == docs.columns
    kept = {r.doc_id for r in q.score_documents(docs, RULES).filter("kept").collect()}
    rows = out.collect()
    assert {r.doc_id for r in rows} == kept and len(rows) == len([r for r in messy_rows() if r[0] in kept and r[1]])
    assert all(r.n_chars == len(r.text) for r in rows)


def test_empty_table(spark):
    docs = documents(spark, [])
    assert q.score_documents(docs).collect() == [] and q.apply_rules(docs).collect() == []


def test_no_python_on_the_path(spark):
    docs = documents(spark, messy_rows())
    for df in (q.score_documents(docs), q.apply_rules(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
