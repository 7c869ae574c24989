"""Shared pieces of the query registry: fixture access and oracle CTEs.

Every registered query is a ``(spark, sf_dir) -> DataFrame`` callable built on
the library operators; its oracle is independent SQL (DuckDB dialect) over the
driver's pre-registered views.  Doubles are rounded to 6 decimals on both
sides, integer widths are pinned with casts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import ENGLISH_STOP_WORDS, sql_string_list
from quire.operators import split as S
from quire.sources import fixtures as FX

ROUND = 6


def r6(c: Column | str, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    out = F.round(col.cast("double"), ROUND)
    return out.alias(name or (c if isinstance(c, str) else "value"))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.interactions(spark, sf_dir)


def parts(spark: SparkSession, sf_dir: str):
    """(train, val, test) of the default split, read from the staged split table.

    Like the original's train/val/test Parquet files: the split is computed
    once per application (by ``split.split_table``) and every query that only
    consumes it reads pruned partitions.
    """
    table = FX.staged(
        spark, sf_dir, "split", lambda s, d: S.split_table(FX.interactions(s, d)),
        partition_by="part",
    )
    cols = ICOLS.split(", ")
    return tuple(table.where(F.col("part") == p).select(*cols) for p in ("train", "val", "test"))


def scored(df: DataFrame) -> DataFrame:
    """Attach the deterministic stand-in prediction as ``prediction``."""
    return df.withColumn("prediction", FX.score())


# ---------------------------------------------------------------- oracle SQL


def _hb(key_sql: str) -> str:
    return f"cast('0x' || substr(md5({key_sql}), 1, 8) as bigint)"


ICOLS = "user_id, book_id, is_read, rating, is_reviewed"

CTES: dict[str, str] = {
    "interactions": f"""
        select user_id, book_id, is_read,
               cast(case when is_read = 0 then 0 else 1 + floor((q - 1) / 10) end as double) as rating,
               cast(case when {_hb("concat('rev:', user_id, ':', book_id)")} % 20 = 0
                         then 1 else 0 end as int) as is_reviewed
        from (select cast(o_custkey as int) as user_id, cast(l_partkey as int) as book_id,
                     cast(max(case when l_returnflag <> 'N' then 1 else 0 end) as int) as is_read,
                     max(l_quantity) as q
              from lineitem join orders on l_orderkey = o_orderkey
              group by 1, 2) t""",
    "split_rows": f"""
        select {ICOLS},
               case when ub < 6 then 'train' when ub < 8 then 'val' else 'test' end as part,
               case when rb < 1 then 0 else 1 end as half
        from (select *,
                     {_hb("concat('2020:', user_id)")} % 10 as ub,
                     {_hb("concat('2020:', user_id, ':', book_id)")} % 2 as rb
              from interactions) x""",
    "observed": "select * from split_rows where part <> 'train' and half = 0",
    "train": f"select {ICOLS} from split_rows where part = 'train' or half = 0",
    "val": f"""select {ICOLS} from split_rows
               where part = 'val' and half = 1
                 and user_id in (select user_id from observed)""",
    "test": f"""select {ICOLS} from split_rows
                where part = 'test' and half = 1
                  and user_id in (select user_id from observed)""",
    "val_scored": """select *, cast((cast(user_id as bigint) * 7919
                                   + cast(book_id as bigint) * 104729) % 1000 as double) / 200
                               as prediction
                     from val""",
    "test_scored": """select *, cast((cast(user_id as bigint) * 7919
                                    + cast(book_id as bigint) * 104729) % 1000 as double) / 200
                                as prediction
                      from test""",
    "reviews": f"""
        select i.user_id, i.book_id, cast(i.rating as float) as rating, d.text as review_text,
               concat(i.user_id, ':', i.book_id) as review_id
        from interactions i
        join documents d
          on d.doc_id = {_hb("concat('doc:', i.user_id, ':', i.book_id)")}
                        % (select count(*) from documents)
        where i.is_reviewed = 1""",
    "stop_words": "select unnest(["
    + sql_string_list(ENGLISH_STOP_WORDS)
    + "]) as word",
    "doc_tokens": r"""
        select doc_id, unnest(tokens) as term
        from (select doc_id,
                     case when stripped = '' and t <> '' then []::varchar[]
                          else string_split_regex(stripped, '[ \t\n\x0B\f\r]') end as tokens
              from (select doc_id, t,
                           regexp_replace(t, '[ \t\n\x0B\f\r]+$', '') as stripped
                    from (select doc_id,
                                 lower(regexp_replace(text, '[,.:!"?;()#$~&]', '', 'g')) as t
                          from documents) a) b) c""",
    "doc_terms": """select doc_id, term from doc_tokens
                    where term not in (select word from stop_words)""",
}

# dependencies between CTEs, in definition order
DEPS: dict[str, tuple[str, ...]] = {
    "interactions": (),
    "split_rows": ("interactions",),
    "observed": ("split_rows",),
    "train": ("split_rows",),
    "val": ("observed",),
    "test": ("observed",),
    "val_scored": ("val",),
    "test_scored": ("test",),
    "reviews": ("interactions",),
    "stop_words": (),
    "doc_tokens": (),
    "doc_terms": ("doc_tokens", "stop_words"),
}


def sql_with(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the named CTEs (and their dependencies) in order."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for d in DEPS.get(n, ()):
            visit(d)
        ordered.append(n)

    for n in names:
        visit(n)
    defs = {**CTES, **(extra or {})}
    parts = [f"{n} as ({defs[n]})" for n in ordered]
    for n, q in (extra or {}).items():
        if n not in ordered:
            parts.append(f"{n} as ({q})")
    if not parts:
        return body
    return "with " + ",\n".join(parts) + "\n" + body
