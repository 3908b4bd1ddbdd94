"""Registered queries and the end-to-end pipeline."""

import functools
import importlib

from sigspark.session import ship

MODULES = ("signal_queries", "table_queries", "model_queries")


def _load():
    from sigspark.plans import book

    for name in MODULES:
        importlib.import_module(f"sigspark.plans.{name}")
    return book


def _on_workers(fn):
    @functools.wraps(fn)
    def run(spark, sf_dir):
        ship(spark)
        return fn(spark, sf_dir)

    return run


def all_queries() -> dict:
    return {name: _on_workers(fn) for name, fn in _load().QUERIES.items()}


def all_sql() -> dict:
    return dict(_load().SQL)
