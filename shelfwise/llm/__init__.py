"""Operators for preparing training data."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship(module: str) -> None:
    """Send the functions of a module to Python workers by value, so executors need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
