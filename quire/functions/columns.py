"""Column expressions (all JVM-side, codegen-friendly; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_bucket(seed: int | str, *keys: ColumnLike) -> Column:
    """Unsigned 32-bit hash of ``"{seed}:k1:k2..."`` taken from the md5 prefix.

    Depends only on the key values, never on partition layout, so samples and
    splits are reproducible across cluster sizes and in SQL engines with md5.
    """
    parts = [F.lit(str(seed))] + [_col(k).cast("string") for k in keys]
    text = F.concat_ws(":", *parts)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def typed_interactions(df: DataFrame) -> DataFrame:
    """Cast a raw (string) interaction table to the typed rating triple + flags.

    ``try_cast`` turns dirty values into nulls instead of failing the job under
    ANSI mode; the rating is float as the ALS estimator expects.
    """
    out = df
    for name, dtype in (
        ("user_id", "int"),
        ("book_id", "int"),
        ("is_read", "int"),
        ("rating", "float"),
        ("is_reviewed", "int"),
    ):
        if name in df.columns:
            out = out.withColumn(name, F.col(name).try_cast(dtype))
    return out


def clamp_zero(c: ColumnLike) -> Column:
    """Lower-clamp at 0; nulls stay null (unlike ``greatest``)."""
    c = _col(c)
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def first_present(*cols: ColumnLike) -> Column:
    """Blend: first non-null prediction in priority order."""
    return F.coalesce(*[_col(c) for c in cols])
