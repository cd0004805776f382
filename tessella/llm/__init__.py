"""Operators for preparing training data at scale, and their queries."""

import sys

from pyspark import cloudpickle

from . import decontaminate, html, infill, lines, mixing, near, negatives, pii, quality, rules, sharding, urls, vectors
from .registry import EXTRA, ORACLES, QUERIES

# Functions go to the executors whole, so this package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "EXTRA",
    "ORACLES",
    "QUERIES",
    "decontaminate",
    "html",
    "infill",
    "lines",
    "mixing",
    "near",
    "negatives",
    "pii",
    "quality",
    "rules",
    "sharding",
    "urls",
    "vectors",
]
