"""Column expressions shared by the operators."""

from __future__ import annotations

import functools


def per_context(fn):
    """Memoise a function that builds Column expressions, per SparkContext.

    Columns are immutable expression trees and can be reused by any number
    of DataFrames; building a large one costs one JVM round trip per node, so
    expressions that every query needs are built once per context."""
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args):
        from pyspark import SparkContext
        sc = SparkContext._active_spark_context
        key = (id(sc._jsc) if sc is not None else None, args)
        if sc is None:
            return fn(*args)
        if key not in cache:
            cache.clear() if len(cache) > 64 else None
            cache[key] = fn(*args)
        return cache[key]

    return wrapper
