"""Operators of a training-data pipeline: ten dealt methods, their queries and SQL.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when the subpackage is present.
"""
