"""The queries of the engine's own operators, by name, and their SQL.

A query is a public function of a query module that takes (spark, sf_dir); its SQL is the module's
constant of the same name in capitals."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexiloom.plans import candidate_queries, relation_queries, source_queries, text_queries

MODULES = (text_queries, source_queries, candidate_queries, relation_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in vars(m).items() if inspect.isfunction(f) and f.__module__ == m.__name__ and not name.startswith("_")}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name in queries() if (sql := getattr(m, name.upper(), None)) is not None}
