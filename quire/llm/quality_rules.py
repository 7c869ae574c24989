"""Quality rules with cross-document line frequency (native DataFrame functions only).

Method: each document's lines are normalised and hashed; per host (``source``)
the distinct documents that hold a line are counted; a line above the limits is
removed from every document but the first (smallest ``doc_id``) that holds it;
a document that loses most of its words is rejected.

Defined results: null text counts as empty; a null ``source`` is a host of its
own; a null ``doc_id`` is kept as a document of its own that is never the first
holder of a line; repeated rows are scored alike and count as one document;
texts of any length are measured whole; an empty table gives an empty result;
columns other than ``doc_id``, ``text`` and ``source`` are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import WORD, let, written


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    #: a line is above the limit in a host if that many documents hold it, whatever the host's size
    min_line_docs: int = 10
    #: documents left with fewer words than this percentage are rejected
    min_left_percent: int = 30


RULES = QualityRules()


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _line_key(line: Column) -> Column:
    """Hash of the normalised line: lower case, runs of white space as one space."""
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))))


def _repeated_words(words: Column, window: int) -> Column:
    """Words covered by a ``window``-word run that occurs twice or more in the array."""

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts,
            lambda p, k: F.least(
                F.lit(window), F.coalesce(F.get(starts, k + 1), p + window) - p
            ),
        )
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def by_sorting(runs: Column) -> Column:
        pairs = F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            twice = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
            return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

        return let(pairs, repeated)

    def of_runs(runs: Column) -> Column:
        # sorting only where a run repeats at all
        return F.when(F.size(F.array_distinct(runs)) < F.size(runs), by_sorting(runs)).otherwise(0)

    def of_hashes(hashes: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (window - 1)),
            lambda i: F.xxhash64(F.slice(hashes, i, window)),
        )
        return F.when(F.size(hashes) > window, let(runs, of_runs)).otherwise(0)

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def base_measures(docs: DataFrame, rules: QualityRules = RULES) -> DataFrame:
    """doc_id, source, text_key and the base counts of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = docs.select("doc_id", "source", text.alias("text"))

    def measures(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            _repeated_words(words, rules.window).cast("long").alias("n_repeat_words"),
        )

    lines = _lines_with_words(F.col("text"))
    counted = plain.select(
        "doc_id",
        "source",
        F.xxhash64("text").alias("text_key"),
        let(_words(F.col("text")), measures).alias("m"),
        F.char_length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", "#*$%&|<>", "")))
        .cast("long")
        .alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
        .cast("long")
        .alias("n_dup_lines"),
    )
    n, r = F.col("m.n_words"), F.col("m.n_repeat_words")
    return counted.select(
        "doc_id",
        "source",
        "text_key",
        n.alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        r.alias("n_repeat_words"),
        ((n < rules.min_words) | (100 * r > rules.max_repeat_percent * n)).alias("base_failed"),
    )


def document_lines(docs: DataFrame) -> DataFrame:
    """One row per document and distinct line: doc_id, source, text_key, line_key, line_words.

    ``line_words`` are the words of all the document's lines with that key; a
    row that is repeated counts once.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = docs.select("doc_id", "source", text.alias("text"))
    each = F.transform(
        _lines_with_words(F.col("text")),
        lambda x, i: F.struct(_line_key(x).alias("k"), F.size(_words(x)).alias("w"), i.alias("i")),
    )
    return (
        plain.select("doc_id", "source", F.xxhash64("text").alias("text_key"), F.explode(each).alias("x"))
        .groupBy("doc_id", "source", "text_key", F.col("x.k").alias("line_key"))
        .agg(F.sum("x.w").alias("w"), F.count("*").alias("n"), F.countDistinct("x.i").alias("once"))
        .selectExpr("doc_id", "source", "text_key", "line_key", "w * once div n as line_words")
    )


def frequent_lines(lines: DataFrame, rules: QualityRules = RULES) -> DataFrame:
    """Lines above the limit: source, line_key, first_doc.

    The limit is a number of distinct documents; a share of the host's documents
    would let boilerplate of a large host pass.
    """
    counts = lines.groupBy("source", "line_key").agg(
        F.countDistinct("doc_id").alias("n_docs"), F.min("doc_id").alias("first_doc")
    )
    return counts.filter(F.col("n_docs") >= rules.min_line_docs).drop("n_docs")


def removed_lines(docs: DataFrame, rules: QualityRules = RULES) -> DataFrame:
    """The lines to remove: doc_id, source, text_key, line_key, line_words.

    The line table is written once: it is counted and then joined with the counts.
    """
    lines = written(document_lines(docs), "document-lines")
    hot = frequent_lines(lines, rules).alias("f")
    return (
        lines.alias("l")
        .join(
            hot,
            (F.col("l.line_key") == F.col("f.line_key"))
            & F.col("l.source").eqNullSafe(F.col("f.source"))
            & ~F.col("l.doc_id").eqNullSafe(F.col("f.first_doc")),
        )
        .select("l.*")
    )


def score_documents(docs: DataFrame, rules: QualityRules = RULES, removed: DataFrame | None = None) -> DataFrame:
    """Base counts, words left after line removal and the verdict of every row.

    ``removed``: the table of ``removed_lines`` where the caller has it already.
    An empty table gives an empty result.  Texts of any length are one row each,
    measured whole.
    """
    base = base_measures(docs, rules).alias("b")
    if removed is None:
        removed = removed_lines(docs, rules)
    lost = removed.groupBy("doc_id", "source", "text_key").agg(F.sum("line_words").alias("lost"))
    keys = ("doc_id", "source", "text_key")
    same = [F.col(f"b.{k}").eqNullSafe(F.col(f"x.{k}")) for k in keys]
    left = F.col("n_words") - F.coalesce(F.col("lost"), F.lit(0))
    return (
        base.join(lost.alias("x"), same, "left")
        .withColumn("left_words", left)
        .withColumn("depleted", 100 * F.col("left_words") < rules.min_left_percent * F.col("n_words"))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
        .select("b.*", "left_words", "depleted", "kept")
    )


def apply_rules(docs: DataFrame, rules: QualityRules = RULES) -> DataFrame:
    """Documents that pass, all their columns, without the lines above the limits.

    ``text`` loses the removed lines and ``n_chars``, where there is one, follows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(
        row, "doc_id", "source", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")
    )
    removed = written(removed_lines(docs, rules), "removed-lines")
    gone = removed.groupBy("doc_id", "source", "text_key").agg(F.collect_set("line_key").alias("keys"))
    verdict = score_documents(docs, rules, removed).groupBy("doc_id", "source", "text_key").agg(
        F.first("kept").alias("kept")
    )
    keys = ("doc_id", "source", "text_key")
    on = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    plan = (
        verdict.filter("kept").alias("v").join(gone.alias("g"), on("v", "g"), "left").select("v.*", "keys")
    )
    kept = keyed.alias("d").join(plan.alias("p"), on("d", "p")).select("row", "keys")
    clean = F.when(F.col("keys").isNull(), F.col("row.text")).otherwise(
        F.array_join(
            F.filter(
                F.split(F.col("row.text"), "\n", -1),
                lambda x: ~F.array_contains(F.col("keys"), _line_key(x)),
            ),
            "\n",
        )
    )
    kept = kept.select("row", clean.alias("clean"))
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("clean").alias("text"))
        elif c == "n_chars":
            out.append(
                F.when(F.col("row.n_chars").isNotNull(), F.char_length("clean"))
                .cast(docs.schema["n_chars"].dataType)
                .alias("n_chars")
            )
        else:
            out.append(F.col(f"row.`{c}`").alias(c))
    return kept.select(*out)
