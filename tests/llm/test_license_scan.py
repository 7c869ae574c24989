import re

from quire.llm import license_scan as lic
from tests.llm.common import ASCII_LOWER, documents, messy_rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

FILLER = "alpha beta gamma delta epsilon zeta eta theta " * 6


def base(text):
    w = WORD.findall((text or "").translate(ASCII_LOWER))
    at, labels = [], set()
    for phrase, label in lic.BASE_PHRASES.items():
        p = phrase.split()
        hits = [k for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def rows():
    out = messy_rows()
    for k, (_, text, _) in enumerate(lic.TEMPLATES):
        out.append((100 + k, FILLER + text + " " + FILLER, "t"))
    edited = lic.TEMPLATES[0][1].replace("sublicense, ", "").replace("merge", "merge and join")
    out += [
        (200, edited, "t"),
        (201, "MIT-License, mit license; Mit  LICENSE\nApache\nlicense", "t"),
        (202, "the license of mit and a general, public licence", "t"),
        (203, "software software permission notice copyright any person hereby " * 40, "t"),
        (204, "général public license é general public license", "t"),
    ]
    return out


def test_base_columns_equal_brute_force(spark):
    got = lic.scan(documents(spark, rows(), clash=True)).collect()
    mine = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got]
    assert sorted(mine, key=str) == sorted(((i, *base(t)) for i, t, _ in rows()), key=str)
    for r in got:
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))


def test_templates_are_found_and_scattered_words_are_not(spark):
    got = {r.doc_id: r for r in lic.scan(documents(spark, rows())).collect() if r.doc_id is not None}
    for k, (label, _, _) in enumerate(lic.TEMPLATES):
        assert label in got[100 + k].labels.split(","), label
        assert got[100 + k].score > 0.95
    assert "mit" in got[200].labels.split(",") and 0.75 <= got[200].score < 1
    assert got[203].labels == "" and got[203].score == 0


def every_alignment(index, words):
    """Template -> best share over all places, by the definition."""
    out, n, p = {}, len(words), index.p
    for t, text in enumerate(index.texts):
        weight = [index.weight[k] + 1e-9 for k in index.place[t]]
        for off in range(-len(text) - p.slack, n + p.slack):
            near = lambda k: words[max(0, k - p.slack) : max(0, k + p.slack + 1)]
            share = sum(w for i, (x, w) in enumerate(zip(text, weight, strict=True)) if x in near(off + i)) / sum(weight)
            if share >= p.min_share - 1e-12 and index._has_keys(t, off, words):
                out[t] = max(share, out.get(t, 0.0))
    return out


def test_texts_without_the_rarest_words_are_found(spark):
    """Three of the four rarest words of a template outside its key phrases edited, and six words put in the middle."""
    docs = documents(spark, rows())
    index = lic.Index(lic.word_weights(docs))
    changed = []
    for t, (_, text, keys) in enumerate(lic.TEMPLATES):
        words = WORD.findall(text.translate(ASCII_LOWER))
        mandatory = {w for k in keys for w in k.split()}
        order = sorted(range(len(words)), key=lambda i: (-index.weight[index.place[t][i]], i))
        for i in [i for i in order[:4] if words[i] not in mandatory][:3]:
            words[i] = f"edited{i}"
        changed.append(words)
        changed.append(words[: len(words) // 2] + ["six", "words", "more", "put", "in", "there"] + words[len(words) // 2 :])
    found = 0
    for words in changed:
        hashed = lic._words(" ".join(["alpha"] * 9 + words + ["omega"] * 9))
        want = every_alignment(index, hashed)
        got = {t: share for t, (share, _) in index.templates(hashed, index.find(hashed)).items()}
        assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-9 for t in want)
        found += len(want)
    assert found > len(lic.TEMPLATES) // 2
    # the opening of the MIT licence with three of its four first words of equal weight replaced
    flat = lic.Index({int(w): 1.0 for w in index.vocabulary.view("int64")})
    edited = lic.TEMPLATES[4][1].replace("This program is free", "That tool was free")
    hashed = lic._words(edited)
    assert 4 in flat.templates(hashed, flat.find(hashed))


def test_empty_table(spark):
    assert lic.scan(documents(spark, [])).collect() == []
