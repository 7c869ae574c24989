"""Query registry: one Spark query per operator plus its independent SQL oracle."""

from __future__ import annotations

from quire.registry import (
    aggregates,
    extensions,
    joins,
    metrics,
    models,
    scalar,
    setops,
    sources,
    split,
    text,
    tuning,
    windows,
)

MODULES = (sources, scalar, joins, aggregates, windows, setops, split, text, metrics, models,
           tuning, extensions)


def all_queries() -> dict:
    out: dict = {}
    for m in MODULES:
        out.update(m.QUERIES)
    return out


def all_oracles() -> dict:
    out: dict = {}
    for m in MODULES:
        out.update(getattr(m, "ORACLE", {}))
    return out
