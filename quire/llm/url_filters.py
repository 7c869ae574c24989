"""URL filters as a temporal list join (native DataFrame functions only).

List entries are dated: on a day a domain is added to or removed from a list.
They become validity intervals, from an addition up to the domain's next entry
on the same list, and every capture is held against the intervals that are
valid on the day it was fetched.  A host is matched by itself and by each of
its parent domains.  The most specific valid entry decides; of equally specific
ones an allowing list wins, then the list's name.

Captures of one host and day are evaluated once.  Intervals and captures meet
on (domain, period of ``period_days``), so a long history of a domain is not
compared with every capture of it.

Defined results: a url without a host, or null, has a null host and is kept; a
null fetch day matches nothing; of entries of one day a removal comes last;
entries with a null list, domain or day are not used; repeated rows are
evaluated alike; without captures the result is empty, without entries every
capture is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PERIOD_DAYS = 32


def url_host(url: Column) -> Column:
    """Lower-case host of a url, without user, port and final dot; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    return F.nullif(F.regexp_replace(host, r"\.+$", ""), F.lit(""))


def parent_domains(host: Column, least_labels: int = 2) -> Column:
    """The host and its parent domains of at least ``least_labels`` labels."""
    labels = F.split(host, r"\.")
    return F.when(
        F.size(labels) >= least_labels,
        F.transform(
            F.sequence(F.lit(1), F.size(labels) - least_labels + 1),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
        ),
    )


def validity_intervals(entries: DataFrame) -> DataFrame:
    """list, allows, domain, valid_from, valid_to (exclusive; null: open) of dated entries.

    ``entries`` has list, allows (boolean), domain, day (int) and added (boolean).
    """
    usable = entries.filter(F.col("list").isNotNull() & F.col("domain").isNotNull() & F.col("day").isNotNull())
    usable = usable.groupBy("list", "domain", "day").agg(
        F.min("added").alias("added"), F.max("allows").alias("allows")
    )
    following = F.lead("day").over(W.partitionBy("list", "domain").orderBy("day"))
    return (
        usable.withColumn("valid_to", following)
        .filter("added")
        .select("list", "allows", "domain", F.col("day").alias("valid_from"), "valid_to")
    )


def evaluate(captures: DataFrame, entries: DataFrame, period: int = PERIOD_DAYS) -> DataFrame:
    """The captures with host, lists (valid at fetch, sorted), n_lists and verdict; columns of these names give way.

    ``captures`` has url and day (int) besides any other columns.
    """
    rows = captures.select(F.struct(*[F.col(f"`{c}`") for c in captures.columns]).alias("row"))
    rows = rows.select("row", url_host(F.col("row.url")).alias("host"), F.col("row.day").alias("day"))
    asked = rows.select("host", "day").filter("host is not null and day is not null").distinct()
    # open intervals end with the last capture; only periods with captures matter
    lo, hi = (F.lit(x if x is not None else 0) for x in asked.agg(F.min("day"), F.max("day")).first())
    valid = validity_intervals(entries)
    begin = F.floor(F.greatest(F.col("valid_from"), lo) / period)
    end = F.floor(F.least(F.coalesce(F.col("valid_to") - 1, hi), hi) / period)
    valid = valid.withColumn("period", F.explode(F.when(begin <= end, F.sequence(begin, end))))
    each = asked.select(
        "host", "day", F.floor(F.col("day") / period).alias("period"), F.explode(parent_domains(F.col("host"))).alias("domain")
    )
    met = each.join(valid, ["domain", "period"]).filter(
        (F.col("valid_from") <= F.col("day")) & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to")))
    )
    labels = F.size(F.split("domain", r"\."))
    judged = met.groupBy("host", "day").agg(
        F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"),
        F.count_distinct("list").alias("n_lists"),
        F.max(F.struct(labels.alias("labels"), "allows", "list")).alias("best"),
    )
    out = rows.join(judged, ["host", "day"], "left")
    allowed = F.col("best").isNull() | F.col("best.allows")
    own = [F.col(f"row.`{c}`").alias(c) for c in captures.columns if c not in ("host", "lists", "n_lists", "verdict")]
    return out.select(
        *own,
        "host",
        F.coalesce("lists", F.lit("")).alias("lists"),
        F.coalesce("n_lists", F.lit(0)).cast("long").alias("n_lists"),
        F.when(allowed, "keep").otherwise("drop").alias("verdict"),
    )


def _hash(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


#: names of the derived lists and whether they allow
LISTS = {"adult": False, "malware": False, "partners": True, "spam": False}


def page_captures(pages: DataFrame) -> DataFrame:
    """page_id, url and a fetch day (0-364) that follows from the page_id: the table has no dates."""
    return pages.select("page_id", "url", F.pmod(F.col("page_id") * 7919, F.lit(365)).cast("int").alias("day"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries for a fifth of the (list, domain) pairs of the pages' hosts, by hashes."""
    domains = (
        pages.select(url_host(F.col("url")).alias("host"))
        .filter("host is not null")
        .distinct()
        .select(F.explode(parent_domains(F.col("host"))).alias("domain"))
        .distinct()
    )
    named = F.explode(F.array(*[F.struct(F.lit(k).alias("list"), F.lit(v).alias("allows")) for k, v in LISTS.items()]))
    pairs = domains.select("domain", named.alias("x")).select("domain", "x.list", "x.allows")
    pairs = pairs.withColumn("b", _hash(F.concat_ws("|", "list", "domain"))).filter("b % 5 = 0")
    add = F.expr("cast((b div 5) % 330 as int)")
    gone = add + F.expr("cast(10 + (b div 7) % 90 as int)")
    events = F.array(
        F.struct(add.alias("day"), F.lit(True).alias("added")),
        F.when(F.expr("b % 2 = 0"), F.struct(gone.alias("day"), F.lit(False).alias("added"))),
        F.when(F.expr("b % 2 = 0 and b % 3 = 0"), F.struct((gone + 15).alias("day"), F.lit(True).alias("added"))),
    )
    each = pairs.select("list", "allows", "domain", F.explode(events).alias("e")).filter("e is not null")
    return each.select("list", "allows", "domain", "e.day", "e.added")
