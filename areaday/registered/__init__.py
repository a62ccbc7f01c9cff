"""Queries over the given tables, each with the SQL that computes the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
Registered = dict[str, tuple[Query, str | None]]


def all_queries() -> Registered:
    from areaday.registered import files, models, panels, relational, scalars, streams

    merged: Registered = {}
    for module in (panels, relational, scalars, files, models, streams):
        merged.update(module.QUERIES)
    return merged
