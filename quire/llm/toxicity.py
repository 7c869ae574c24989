"""Toxic passages: maximum-scoring segments of token log-odds, calibrated as extreme values.

Model: words get, from the documents that hold them, the log-odds of the toxic against the clean class under a
Dirichlet prior proportional to the words' overall counts; words whose z-score
is large enough score ``log-odds - drift``, all others ``-drift``, so scores
drift down in clean text.  Stems (the first characters of words) are counted
alike, and a word that is too rare to score by itself scores as its stem, so a
family of many endings is one token.  A linear scan finds a document's best segment, and,
where it is significant, all maximal segments.  In clean text the best score of
n words follows an extreme-value law with parameters lambda and K, fitted on
clean labelled documents; normalised scores ``lambda * S - ln(K n)`` of the
segments are summed and mapped to a probability by a logistic curve.

Learned from labelled documents only, a bounded sample of at most
``max_labelled`` rows (those of smallest hash), so what the driver holds is
bounded.  The calibration uses scores of documents by the half of the sample
that they are not in.  doc_id, lang, source and labels are no inputs of a score.

Defined results: null and wordless texts score as a text without any segment;
labels of several rows for a document count as toxic if any says so; null
labels are not used; a null doc_id is not held out and never learned from;
without both classes in the sample every score is the share of toxic labels;
repeated rows are scored alike, and equal texts get equal scores; texts of any
length are scored whole; an empty table gives an empty result; of the documents
only ``doc_id`` and ``text`` are looked at, whatever other columns are called.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import textkit as tk
from quire.llm.common import written


@dataclass(frozen=True)
class ToxicParams:
    max_labelled: int = 40_000
    #: characters of the word beginnings that are scored besides whole words, longest first
    stems: tuple[int, ...] = (6,)
    #: pseudo-counts of the Dirichlet prior
    prior: float = 10_000.0
    #: words and stems with a smaller |z| are unknown
    min_z: float = 3.0
    #: words and stems in a model at most, those of largest |z|
    max_words: int = 65_536
    drift: float = 0.05
    #: segments up to this many expected in clean text are significant
    max_expected: float = 0.05
    threshold: float = 0.7


PARAMS = ToxicParams()


@dataclass
class Model:
    """Word scores and calibration; bounded by the parameters, sent with the code."""

    words: np.ndarray
    scores: np.ndarray
    lam: float = 1.0
    log_k: float = 0.0
    coef: tuple[float, ...] = field(default=(0.0, 0.0, 0.0))
    drift: float = PARAMS.drift
    max_expected: float = PARAMS.max_expected
    stems: tuple[int, ...] = PARAMS.stems

    def word_scores(self, tokens: np.ndarray) -> np.ndarray:
        """Score of every word: of the whole word where that is known, else of its longest known beginning."""
        out = np.zeros(tokens.shape[1])
        if len(self.words):
            for hashes in tokens[::-1]:
                k = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
                out = np.where(self.words[k] == hashes, self.scores[k], out)
        return out - self.drift


def token_hashes(buf: np.ndarray, starts: np.ndarray, stems: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """A row of hashes of the chunk's words, a row for each length of stem; and where each document's words begin.

    A stem is a word's first characters (not bytes), the whole word if it has no more; it is
    another token than the word of the same letters.
    """
    low = tk.LOWER[buf]
    s, e, first = tk.word_spans(low, starts, tk.NOT_ALNUM)
    run = tk.prefix_hash(low)
    rows = [tk.span_hash(run, s, e)]
    letters = np.append(np.flatnonzero((low & 0xC0) != 0x80), len(low))
    at = np.searchsorted(letters, s)
    for n in stems:
        end = np.minimum(e, letters[np.minimum(at + n, len(letters) - 1)])
        rows.append(tk.mix(tk.span_hash(run, s, end) + tk.U64(n)))
    return np.stack(rows), first


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves the remainder 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def best_segment(scores: np.ndarray) -> float:
    """Largest sum of a run of scores; 0 for none."""
    if not len(scores):
        return 0.0
    run = np.cumsum(scores)
    before = np.minimum.accumulate(np.concatenate(([0.0], run[:-1])))
    return max(0.0, float((run - before).max()))


def all_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, sum), in one pass.

    A stack of candidate segments with the running sums at their two ends: a new
    positive score looks back for the last candidate that starts lower; if that
    one ends lower than the new one does, everything from it on is one segment.
    """
    stack: list[list] = []  # begin, end, sum before, sum after
    run = 0.0
    for i, x in enumerate(scores.tolist()):
        before, run = run, run + x
        if x <= 0:
            continue
        new = [i, i + 1, before, run]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j -= 1
            if j < 0 or stack[j][3] >= new[3]:
                stack.append(new)
                break
            new = [stack[j][0], new[1], stack[j][2], new[3]]
            del stack[j:]
    return [(b, e, after - before) for b, e, before, after in stack]


def _compressed(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours of one sign summed: the same segments from fewer scores; and where each run begins."""
    up = scores > 0
    at = np.flatnonzero(np.concatenate(([True], up[1:] != up[:-1])))
    return np.add.reduceat(scores, at), np.append(at, len(scores))


def document_features(scores: np.ndarray, m: Model) -> tuple[float, float, list[tuple[int, int, float]]]:
    """(normalised best score, sum over significant segments, those segments) of a document's words."""
    size = math.log(max(1, len(scores)))
    raw = best_segment(scores)
    best = m.lam * raw - m.log_k - size
    limit = -math.log(m.max_expected)
    if best < limit or not raw:
        return best, 0.0, []
    sums, at = _compressed(scores)
    found = []
    for b, e, s in all_segments(sums):
        if (x := m.lam * s - m.log_k - size) >= limit:
            found.append((int(at[b]), int(at[e]), x))
    return best, sum(x for _, _, x in found), found


def _probability(m: Model, best: float, total: float) -> float:
    a, b, c = m.coef
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, a + b * best + c * math.log1p(total)))))


def _count_batches(stems: tuple[int, ...]):
    """Documents that hold a word or stem, of every chunk, by half of the sample and class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()
            for lo, hi, buf, starts in tk.chunks(batch.column(2)):
                tokens, first = token_hashes(buf, starts, stems)
                for kind, words in enumerate(tokens):
                    doc = np.repeat(np.arange(hi - lo), np.diff(first))
                    order = np.lexsort((doc, words))
                    words, doc = words[order], doc[order]
                    one = np.ones(len(words), dtype=bool)
                    one[1:] = (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])
                    keys, back = np.unique(words[one], return_inverse=True)
                    n = np.bincount(back * 4 + group[lo:hi][doc[one]], minlength=4 * len(keys)).reshape(-1, 4)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(keys), kind, np.int32)),
                            pa.array(keys.view(np.int64)),
                            *[pa.array(n[:, i]) for i in range(4)],
                        ],
                        names=["kind", "word", "n0", "n1", "n2", "n3"],
                    )

    return run


def _word_model(counts: DataFrame, totals, clean: str, toxic: str, p: ToxicParams) -> Model:
    """Words and stems of significant log-odds; ``clean`` and ``toxic`` are SQL sums of the count columns."""
    sums = [[sum(row[x.strip()] for x in e.split("+")) for row in totals] for e in (clean, toxic)]
    n_c, n_t = (F.element_at(F.array(*[F.lit(float(n)) for n in x]), F.col("kind") + 1) for x in sums)
    c, t = F.expr(clean), F.expr(toxic)
    prior = p.prior * (c + t) / F.greatest(F.lit(1.0), n_c + n_t)
    odds = F.log((t + prior) / (n_t + p.prior - t - prior)) - F.log((c + prior) / (n_c + p.prior - c - prior))
    z = odds / F.sqrt(1 / (t + prior) + 1 / (c + prior))
    top = (
        counts.filter(c + t > 0)
        .select("word", odds.alias("odds"), z.alias("z"))
        .filter(F.abs("z") >= p.min_z)
        .orderBy(F.abs("z").desc(), "word")
        .limit(p.max_words)
        .toPandas()
    )
    words = top["word"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(words)
    return Model(
        words[order],
        top["odds"].to_numpy(dtype=np.float64)[order],
        drift=p.drift,
        max_expected=p.max_expected,
        stems=p.stems,
    )


def _feature_batches(models: list[Model]):
    """(toxic, words, best segment score, normalised best, sum of significant ones) by the other half's model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = batch.column(0).to_numpy()
            for lo, hi, buf, starts in tk.chunks(batch.column(2)):
                tokens, first = token_hashes(buf, starts, models[0].stems)
                by = [m.word_scores(tokens) for m in models]
                own = [by[half[lo + d]][first[d] : first[d + 1]] for d in range(hi - lo)]
                raw = [best_segment(x) for x in own]
                both = [document_features(x, models[half[lo + d]])[:2] for d, x in enumerate(own)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(lo, hi - lo),
                        pa.array(np.diff(first)),
                        pa.array(raw, pa.float64()),
                        pa.array([x[0] for x in both], pa.float64()),
                        pa.array([x[1] for x in both], pa.float64()),
                    ],
                    names=["toxic", "n", "best", "norm", "total"],
                )

    return run


def _fit_extremes(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """lambda and ln K by moments: best - ln(n) / lambda has the spread pi / (lambda sqrt 6)."""
    size = np.log(np.maximum(1, n))
    lam = 1.0
    for _ in range(50):
        spread = float(np.std(best - size / lam))
        lam = min(5.0, max(0.05, math.pi / (max(spread, 1e-6) * math.sqrt(6))))
    return lam, lam * float(np.mean(best - size / lam)) - 0.5772156649


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Newton steps for the coefficients of (1, columns of x)."""
    a = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(a.shape[1])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (q - y) + ridge * w
        step = np.linalg.solve(a.T @ (a * (q * (1 - q))[:, None]) + ridge * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame, p: ToxicParams = PARAMS) -> Model:
    """The model from labelled documents that are not held out."""
    sample = (
        labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("label_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("label_id")))
        .groupBy("label_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(p.max_labelled)
    )
    # bounded by max_labelled rows of two numbers: small enough to send to every executor
    train = docs.select(F.col("doc_id").cast("long").alias("label_id"), F.col("text").cast("string").alias("text"))
    half = F.pmod(F.xxhash64("label_id", F.lit(1)), F.lit(2)).cast("int")
    train = written(
        train.join(F.broadcast(sample), "label_id").select(
            half.alias("half"), (F.col("toxic") > 0).cast("int").alias("toxic"), "text"
        ),
        "toxic-train",
    )
    names = ["n0", "n1", "n2", "n3"]
    counts = train.mapInArrow(_count_batches(p.stems), "kind int, word long, n0 long, n1 long, n2 long, n3 long")
    counts = written(counts.groupBy("kind", "word").agg(*[F.sum(n).alias(n) for n in names]), "toxic-counts")
    by_kind = counts.groupBy("kind").agg(*[F.sum(n).alias(n) for n in names]).collect()
    totals = [dict.fromkeys(names, 0) for _ in range(1 + len(p.stems))]
    for row in by_kind:
        totals[row["kind"]] = row.asDict()
    # group = half * 2 + class: each half is scored by the model of the other one
    halves = [_word_model(counts, totals, "n2", "n3", p), _word_model(counts, totals, "n0", "n1", p)]
    model = _word_model(counts, totals, "n0 + n2", "n1 + n3", p)
    raw = _features(train, halves)
    toxic = raw["toxic"].to_numpy()
    if not len(toxic) or toxic.min() == toxic.max():
        share = float(toxic.mean()) if len(toxic) else 0.0
        model.coef = (math.log((share + 1e-6) / (1 - share + 1e-6)), 0.0, 0.0)
        return model
    clean = raw[toxic == 0]
    for m in (model, *halves):
        m.lam, m.log_k = _fit_extremes(clean["best"].to_numpy(), clean["n"].to_numpy())
    raw = _features(train, halves)
    y, norm, more = raw["toxic"].to_numpy(float), raw["norm"].to_numpy(), np.log1p(raw["total"].to_numpy())
    a, b, c = _fit_logistic(np.column_stack((norm, more)), y)
    if min(b, c) < 0:  # a curve that falls is not one of evidence: the other feature alone
        a, x = _fit_logistic((more if b < c else norm)[:, None], y)
        b, c = (0.0, x) if b < c else (x, 0.0)
    model.coef = (a, b, c)
    return model


def _features(train: DataFrame, halves: list[Model]):
    """One row of numbers per document of the bounded sample, on the driver."""
    return train.mapInArrow(
        _feature_batches(halves), "toxic int, n long, best double, norm double, total double"
    ).toPandas()


def _score_batches(m: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("strength", pa.float64())]))
        for batch in batches:
            for lo, hi, buf, starts in tk.chunks(batch.column(1)):
                tokens, first = token_hashes(buf, starts, m.stems)
                scores = m.word_scores(tokens)
                out, segments = [], []
                for d in range(hi - lo):
                    best, total, found = document_features(scores[first[d] : first[d + 1]], m)
                    out.append(_probability(m, best, total))
                    segments.append([{"begin": b, "end": e, "strength": x} for b, e, x in found])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(out, pa.float64()), pa.array(segments, kind)],
                    names=["doc_id", "score", "segments"],
                )

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and the significant segments (word positions) of every row."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _score_batches(model),
        "doc_id long, score double, segments array<struct<begin:long,end:long,strength:double>>",
    )


def classify(docs: DataFrame, labels: DataFrame, p: ToxicParams = PARAMS) -> DataFrame:
    """doc_id, held_out, score, predicted, n_segments and segments of every row."""
    return score(docs, learn(docs, labels, p)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= p.threshold).cast("int").alias("predicted"),
        F.size("segments").alias("n_segments"),
        "segments",
    )
