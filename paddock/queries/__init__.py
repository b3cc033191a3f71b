"""Queries over the given tables, one or more per operator of the inventory."""

import importlib

_MODULES = ("columns", "keyed", "texts", "relational", "graphs", "events", "functions", "files", "streams", "league", "models", "transformers")


def load() -> None:
    for name in _MODULES:
        importlib.import_module(f"paddock.queries.{name}")
